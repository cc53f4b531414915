"""Session defaults and the shared work folder.

The library never hard-codes cluster sizing. ``configure`` only fills in
settings the caller left unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the plans rely on. AQE re-plans joins from runtime sizes (a shuffle
# join becomes a broadcast join only when the measured side is small), splits
# skewed shuffle partitions, and coalesces tiny ones.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``DEFAULTS`` for every key the session has not set."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tierwise") -> SparkSession:
    """A local session for tests and benches; clusters build their own.

    Catalog tables go to a fresh temporary warehouse, not the working folder.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tierwise-warehouse-"))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at storage every executor can reach. Only
    when it is unset (local tests) is a local folder created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no context on the client
        sc = None
    if sc is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("spark.checkpoint.dir is unset; set it to a folder every executor can reach")
        return current
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset; set it to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="tierwise-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Have the session's file system delete ``path`` when the application ends."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def store(spark: SparkSession, df, name: str):
    """``df`` written once to a fresh folder below the shared checkpoint folder and
    read back: cuts the lineage with files any executor can read, and the folder
    goes when the application ends."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    drop_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def _byte_count(size: str) -> int:
    """Of a setting such as ``67108864b`` or ``64m``."""
    number = size.lower().rstrip("bkmgtp")
    unit = size.lower()[len(number) :].rstrip("b") or "b"
    return int(number) * 1024 ** "bkmgtp".index(unit)


@contextmanager
def short_rows(spark: SparkSession, row_bytes: int):
    """For jobs run inside that send rows of at most ``row_bytes`` to Python: Spark measures
    an Arrow batch after every row to keep it below a limit in bytes, which for short rows
    takes longer than all else. Batches get as many rows as cannot reach that limit, and it
    is not measured; rows of which not even a thousand fit are sent as ever."""
    rows = int(spark.conf.get(BATCH_ROWS))
    fitting = _byte_count(spark.conf.get(BATCH_BYTES)) // max(row_bytes, 1)
    fitting = min(rows, fitting) if rows > 0 else fitting
    if fitting < min(rows, 1000) or fitting < 1:
        yield
        return
    changed = {BATCH_ROWS: str(fitting), BATCH_BYTES: str(2**31 - 1)}
    before = {name: spark.conf.get(name, None) for name in changed}  # null: not set, so Spark's own default
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
