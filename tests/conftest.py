from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from staffmart.session import get_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="staffmart-test-ckpt-")
    session = get_session("staffmart-tests", master="local[4]", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": ckpt,
        "spark.driver.memory": "4g",
    })
    yield session
    session.stop()


def write_lines(directory, name: str, lines: list[str], bom: bool = True,
                crlf: bool = True) -> str:
    """Write a raw text file the way the HR exports come: BOM and CRLF."""
    os.makedirs(str(directory), exist_ok=True)
    path = os.path.join(str(directory), name)
    text = ("\r\n" if crlf else "\n").join(lines) + ("\r\n" if crlf else "\n")
    with open(path, "w", encoding="utf-8") as f:
        f.write(("\ufeff" if bom else "") + text)
    return path


def rows_as_dicts(df, key: str | None = None) -> list[dict]:
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: str(r[key])) if key else rows
