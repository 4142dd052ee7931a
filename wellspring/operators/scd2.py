"""Type-2 slowly changing dimension: check-strategy snapshot and its views.

``scd2_snapshot`` is pure: (stored versions, new source state, run time) ->
all versions after the run. One full outer join on the key compares the
open version with the source (null-safe on the check columns) and emits up
to two rows per key (the old version, possibly closed, and a newly opened
one). Both sides hold at most one row per key, so the join cannot fan out
or skew on a hot key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.valuesets import OPEN_END_TS
from ..session import scratch_path
from .incremental import TableStore

VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
UPDATED_AT = "dbt_updated_at"
OPEN_PART = "open"


def _ts(v):
    return F.lit(str(v)).cast("timestamp_ntz")


def scd2_snapshot(current: DataFrame | None, source: DataFrame, key: str, check_cols: Sequence[str],
                  snapshot_ts, carry_cols: Sequence[str] = (), hard_deletes: bool = True) -> DataFrame:
    """Versions after one snapshot run at ``snapshot_ts``.

    New key: open a version. Any check column differs (null-safe): close the
    open version at ``snapshot_ts`` and open a new one. Key gone from the
    source: close it when ``hard_deletes``. Carried columns are stored but not
    compared, so an unchanged version keeps its old values.
    """
    cols = [key, *check_cols, *carry_cols]
    ts = _ts(snapshot_ts)
    src = source.select(*cols)
    if current is None:
        return src.select(*cols, ts.alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
                          ts.alias(UPDATED_AT))
    closed = current.where(F.col(VALID_TO).isNotNull()).select(*cols, VALID_FROM, VALID_TO, UPDATED_AT)
    return closed.unionByName(_changes(current.where(F.col(VALID_TO).isNull()), src, key, check_cols, carry_cols, ts,
                                       hard_deletes))


def scd2_snapshot_run(store: TableStore, name: str, source: DataFrame, key: str, check_cols: Sequence[str],
                      snapshot_ts, carry_cols: Sequence[str] = (), hard_deletes: bool = True) -> DataFrame:
    """One snapshot run over the stored table ``name``; returns all its versions.

    Open versions are one part of the table, versions that a run closes another
    one of their own. A run reads open versions only and writes both parts
    in one commit; parts closed earlier keep their files. A retry of a run that
    did not commit starts from the same open versions.
    """
    opened = store.read(name, lambda part: part == OPEN_PART)
    if opened is None:
        after = scd2_snapshot(None, source, key, check_cols, snapshot_ts, carry_cols)
    else:
        src = source.select(key, *check_cols, *carry_cols)
        after = _changes(opened, src, key, check_cols, carry_cols, _ts(snapshot_ts), hard_deletes)
    path = scratch_path(store.spark, "snapshot")
    after.write.parquet(path)  # one join, read for both parts
    after = store.spark.read.schema(after.schema).parquet(path)
    parts = {OPEN_PART: after.where(F.col(VALID_TO).isNull())}
    if opened is not None:
        parts[f"closed-{uuid.uuid4().hex}"] = after.where(F.col(VALID_TO).isNotNull())
    return store.put(name, parts)


def _changes(opened: DataFrame, src: DataFrame, key: str, check_cols: Sequence[str], carry_cols: Sequence[str], ts,
             hard_deletes: bool) -> DataFrame:
    """The open versions after a run, some of them closed by it, and the versions it opens."""
    cols = [key, *check_cols, *carry_cols]
    out_cols = cols + [VALID_FROM, VALID_TO, UPDATED_AT]
    o = opened.select(
        *[F.col(c).alias("o__" + c) for c in out_cols], F.lit(True).alias("__o_row"))
    s = src.select(*[F.col(c).alias("s__" + c) for c in cols], F.lit(True).alias("__s_row"))
    j = o.join(s, F.col("o__" + key) == F.col("s__" + key), "full")

    # presence markers: a row may carry a NULL key
    o_present = F.col("__o_row").isNotNull()
    s_present = F.col("__s_row").isNotNull()
    same = None
    for c in check_cols:
        t = F.col("o__" + c).eqNullSafe(F.col("s__" + c))
        same = t if same is None else (same & t)
    same = same if same is not None else F.lit(True)
    changed = o_present & s_present & ~same

    old_to = (F.when(changed, ts)
              .when(~s_present & F.lit(hard_deletes), ts)
              .otherwise(F.col("o__" + VALID_TO)))
    old_updated = F.when(changed | (~s_present & F.lit(hard_deletes)), ts).otherwise(F.col("o__" + UPDATED_AT))
    old = F.when(o_present, F.struct(*[F.col("o__" + c).alias(c) for c in cols],
                                     F.col("o__" + VALID_FROM).alias(VALID_FROM),
                                     old_to.alias(VALID_TO), old_updated.alias(UPDATED_AT)))
    new = F.when(s_present & (~o_present | changed),
                 F.struct(*[F.col("s__" + c).alias(c) for c in cols], ts.alias(VALID_FROM),
                          F.lit(None).cast("timestamp_ntz").alias(VALID_TO), ts.alias(UPDATED_AT)))
    emitted = j.select(F.inline(F.filter(F.array(old, new), lambda x: x.isNotNull())))
    return emitted.select(*out_cols)


def scd2_current(history: DataFrame) -> DataFrame:
    return history.where(F.col(VALID_TO).isNull())


def one_current_row_violations(history: DataFrame, key: str) -> DataFrame:
    """Keys with more than one open version."""
    return (scd2_current(history).groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("current_rows"))
            .where(F.col("current_rows") > 1))


def overlapping_window_violations(history: DataFrame, key: str) -> DataFrame:
    """Versions that start before the previous version of the key ends."""
    h = history.select(key, VALID_FROM,
                       F.coalesce(F.col(VALID_TO), F.lit(OPEN_END_TS).cast("timestamp_ntz")).alias(VALID_TO))
    w = Window.partitionBy(key).orderBy(F.col(VALID_FROM).asc_nulls_first(), F.col(VALID_TO).asc_nulls_first())
    h = h.withColumn("prev_valid_to", F.lag(VALID_TO).over(w))
    return h.where(F.col("prev_valid_to").isNotNull() & (F.col(VALID_FROM) < F.col("prev_valid_to")))


def valid_range_violations(history: DataFrame, key: str) -> DataFrame:
    """Closed versions whose end is not after their start."""
    return history.where(F.col(VALID_TO).isNotNull() & (F.col(VALID_TO) <= F.col(VALID_FROM))) \
        .select(key, VALID_FROM, VALID_TO)
