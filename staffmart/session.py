"""Session construction and the shared scratch area.

``get_session`` only fills in settings that were not given explicitly or by
the submit; partition counts and memory defaults apply to local masters
only. Intermediate tables go under the shared folder named by
``spark.checkpoint.dir``; a private folder is created only when that setting
is absent on a local master (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied to every session unless given explicitly (here or by the
# submit): adaptive execution with skew handling, UTC session clock. The UI
# is off unless asked for.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
STATIC_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# Only for local masters (tests, bench): partitions sized to the cores and a
# driver heap for single-JVM runs. A cluster keeps its own values.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
}
LOCAL_STATIC_DEFAULTS = {
    "spark.driver.memory": "8g",
}


def get_session(app: str = "staffmart", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    explicit = dict(conf or {})
    builder = SparkSession.builder.appName(app)
    static = dict(STATIC_DEFAULTS)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            static.update(LOCAL_STATIC_DEFAULTS)
    for key, value in {**static, **explicit}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    runtime = dict(SESSION_DEFAULTS)
    if spark.sparkContext.master.startswith("local"):
        runtime.update(LOCAL_DEFAULTS)
    for key, value in runtime.items():
        if key not in explicit and not submitted.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context); only when neither exists on a local master does it create a
    private one, which is what happens in tests on a single machine. Works
    with classic and Spark Connect sessions (no context on the latter).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="staffmart-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scratch_folders: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the checkpoint root.

    All of an application's tables lie in one folder, which goes with what it
    holds (clear identifiers among it) when the driver's JVM ends.
    """
    root = checkpoint_root(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no context
        return os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex}")
    folder = os.path.join(root, "tables", sc.applicationId)
    if folder not in _scratch_folders:
        where = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = where.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(where)
        fs.deleteOnExit(where)
        _scratch_folders.add(folder)
    return os.path.join(folder, f"{name}-{uuid.uuid4().hex}")
