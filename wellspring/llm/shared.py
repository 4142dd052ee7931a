"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only for a local master without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="wellspring-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


class Workspace:
    """Written tables of one run. A written table cuts lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        schema, conf = df.schema, self.spark.conf
        before = conf.get(_CLEANUP, "false")
        conf.set(_CLEANUP, "true")  # the table replaces the shuffles that made it
        try:
            df.write.mode("overwrite").parquet(self.path(name))
        finally:
            conf.set(_CLEANUP, before)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def settle(self) -> None:
        """Collect garbage, so that Spark's cleaner drops shuffle files of plans that are written and done."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Delete tables that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
