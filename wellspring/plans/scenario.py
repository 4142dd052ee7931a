"""Fixed two-batch scenario over the driver's tables, for the registered queries.

Batch 1 is every raw row loaded before ``CUTOFF_1``; batch 2 re-delivers
everything (the strict append bound keeps only the new rows). Clocks that
the source reads from the system (current date, snapshot time, freshness
"now") are fixed here so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import TableStore
from ..session import scratch_path
from ..sources.bindings import LazyRaw, RawFrames, bind_raw
from .build import build_full
from .increment import run_increment

CUTOFF_1 = "2000-01-01 00:00:00"
AS_OF = "2001-08-01"
SNAPSHOT_1 = "2000-01-01 00:00:00"
SNAPSHOT_2 = "2001-09-01 00:00:00"
FRESHNESS_NOW = "2001-08-15 00:00:00"
BACKFILL_START, BACKFILL_END = "1998-01-01", "1998-12-31"


def batch_before(raw: RawFrames | LazyRaw, cutoff: str) -> LazyRaw:
    bound = F.lit(cutoff).cast("timestamp_ntz")
    return LazyRaw(raw, lambda df: df.where(F.col("_loaded_at") < bound))


def raw_pair(spark: SparkSession, sf_dir: str, raw: RawFrames | LazyRaw | None = None) -> tuple[LazyRaw, RawFrames | LazyRaw]:
    """(batch 1, everything) of the bound raw tables, or of ``raw``: the same tables, stored for their many readers."""
    raw = raw or bind_raw(spark, sf_dir)
    return batch_before(raw, CUTOFF_1), raw


def full_pair(spark: SparkSession, sf_dir: str, materialize=None, raw: RawFrames | LazyRaw | None = None):
    """(full build over batch 1, full build over everything)."""
    b1, allr = raw_pair(spark, sf_dir, raw)
    return build_full(b1, materialize), build_full(allr, materialize)


def two_increments(spark: SparkSession, sf_dir: str, materialize=None):
    """Run the incremental build twice into a fresh store; return (store, run1, run2)."""
    b1, allr = raw_pair(spark, sf_dir)
    store = TableStore(spark, scratch_path(spark, "increment"))
    r1 = run_increment(store, b1, AS_OF, materialize)
    r2 = run_increment(store, allr, AS_OF, materialize)
    return store, r1, r2
