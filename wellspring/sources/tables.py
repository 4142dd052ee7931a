"""Readers for the driver's parquet tables.

Reads are lazy: Catalyst prunes columns and pushes filters into the parquet
scan, so callers just select what they need. Splits, join strategies and
broadcasts are left to Spark's statistics and adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
