"""Session settings and the shared working folder.

Large jobs cut lineage by writing to the folder the cluster names in
``spark.checkpoint.dir``. We read that setting from the session and only set
our own when it is unset (local runs and tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings that matter at scale. They are session-level and
# safe to apply on any session: adaptive execution re-plans joins from real
# shuffle sizes, splits skewed partitions and coalesces small ones.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # a hot key is split even where a later step then needs a shuffle of its own
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # documents are read whole: shredded into a column per field, a VARIANT is taken apart and put together again
    "spark.sql.variant.writeShredding.enabled": "false",
}

PARQUET_CODEC = "zstd"  # of all tables that are written: about a third smaller than with the default


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wellspring") -> SparkSession:
    """Session for tests and local benchmarks (no UI, UTC clock)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Uses ``spark.checkpoint.dir`` when the session sets it. Without one, a
    local master gets a fresh temporary folder; any other master is an error,
    since executors would each write to their own disk.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="wellspring-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def _setting(df: DataFrame, name: str, value: str, default: str) -> Iterator[None]:
    conf = df.sparkSession.conf
    before = conf.get(name, default)
    conf.set(name, value)
    try:
        yield
    finally:
        conf.set(name, before)


def dropping_shuffles(df: DataFrame):
    """Writes of ``df`` in this block drop their shuffle files when they end: the written table replaces them."""
    return _setting(df, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false")


def unsorted_partitions(df: DataFrame, n: int):
    """Writes of ``df`` in this block keep a file open for each of up to ``n`` partitions instead of sorting rows by them."""
    return _setting(df, "spark.sql.maxConcurrentOutputFileWriters", str(n + 1), "0")  # Spark sorts as soon as that many are open


def materializer(spark: SparkSession, tag: str = "stage"):
    """A function that writes a DataFrame to the shared folder and reads it back.

    Used for tables several consumers read (staging bases): the work runs
    once, later readers get a parquet scan with pruning and pushdown, and
    the lineage is cut, so a lost executor does not replay the whole chain.
    """
    root = scratch_path(spark, tag)
    counter = {"n": 0}

    def write(df):
        counter["n"] += 1
        path = f"{root}/t{counter['n']:03d}"
        with dropping_shuffles(df):
            df.write.mode("overwrite").option("compression", PARQUET_CODEC).parquet(path)
        return spark.read.parquet(path)

    return write
