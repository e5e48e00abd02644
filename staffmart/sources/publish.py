"""Tables that appear when they are whole: write aside, check, then swap.

``overwrite`` empties a table before its successor is written, so a job that
fails half-way leaves nothing to read. Here every output is written to a
hidden folder beside its table (the same file system, so that a rename moves
it) and takes the table's place once the block has ended well. A failed block
leaves the old tables as they were; only outputs marked ``always``, such as a
quarantine that explains the failure, appear nevertheless.

A swap is two renames per table. A run that dies between them leaves the old
table under a hidden name, from which the next run, or ``recover``, restores it.
On object stores a rename is a copy; point ``path`` at a versioned folder there.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, by the file system that it names."""
    fs, where = _fs(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, where = _fs(spark, source)
    to = _fs(spark, target)[1]
    fs.mkdirs(to.getParent())
    if not fs.rename(where, to):
        raise OSError(f"can't move {source} to {target}")


def _beside(path: str, kind: str) -> str:
    """A name that Spark's listing of the parent folder skips, also that of a partition."""
    folder, name = os.path.split(path.rstrip("/"))
    return os.path.join(folder, f".{kind}_{name}")


def recover(spark: SparkSession, path: str) -> None:
    """Put a table back that a dead run had moved aside."""
    before = _beside(path, "previous")
    if path_exists(spark, before):
        if path_exists(spark, path):
            remove(spark, before)  # the swap was done, only the old table was left over
        else:
            move(spark, before, path)


def swap(spark: SparkSession, source: str, path: str) -> None:
    """``source`` takes the place of the table (or partition) at ``path``."""
    recover(spark, path)
    before = _beside(path, "previous")
    if path_exists(spark, path):
        move(spark, path, before)
    try:
        move(spark, source, path)
    except Exception:
        if path_exists(spark, before):
            move(spark, before, path)
        raise
    if path_exists(spark, before):
        remove(spark, before)


@dataclass
class Stage:
    """The outputs of one block: ``stage(path)`` gives the folder to write to."""

    spark: SparkSession
    tables: dict[str, tuple[str, bool]] = field(default_factory=dict)

    def __call__(self, path: str, always: bool = False) -> str:
        recover(self.spark, path)
        aside = f"{_beside(path, 'staging')}_{uuid.uuid4().hex[:12]}"
        self.tables[path] = (aside, always)
        return aside

    def publish(self, failed: bool) -> None:
        for path, (aside, always) in self.tables.items():
            if path_exists(self.spark, aside):
                if always or not failed:
                    swap(self.spark, aside, path)
                else:
                    remove(self.spark, aside)


@contextmanager
def publishing(spark: SparkSession) -> Iterator[Stage]:
    """Tables written inside the block appear together at its end, or not at all."""
    stage = Stage(spark)
    try:
        yield stage
    except BaseException:
        stage.publish(failed=True)
        raise
    stage.publish(failed=False)
