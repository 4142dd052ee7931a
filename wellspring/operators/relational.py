"""Generic relational operators: top-1 dedupe, existence flags, unions, as-of join.

All of them are plain DataFrame compositions, so Catalyst plans them:
``dedupe_latest`` becomes a window with a partial ``WindowGroupLimit``
before the shuffle (a hot key is cut to one row per map task before it
moves); ``orphan_flag`` is a left join to a de-duplicated key set (adaptive
execution turns it into a broadcast when the key set is small at run time,
and splits a skewed probe side otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _desc_first(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_first()


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order``.

    ``order`` entries given as names sort DESC NULLS FIRST (the warehouse's
    default for DESC); pass ``Column`` sort expressions for anything else.
    ``tie_breakers`` make the choice deterministic where the source rule is
    not. NULL keys form one group, as in SQL window partitions.
    """
    sort = [_desc_first(c) if isinstance(c, str) else c for c in list(order) + list(tie_breakers)]
    w = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def key_set(ref: DataFrame, ref_key: str | Column, alias: str = "__ref_key") -> DataFrame:
    """Distinct non-NULL keys of ``ref`` with a presence marker."""
    k = F.col(ref_key) if isinstance(ref_key, str) else ref_key
    return (ref.select(k.alias(alias)).where(F.col(alias).isNotNull()).distinct()
            .withColumn("__ref_hit", F.lit(True)))


def orphan_flag(df: DataFrame, key: str, ref: DataFrame, ref_key: str, name: str,
                non_blank: bool = False) -> DataFrame:
    """Add ``name`` = key is set but has no match in ``ref`` (NOT EXISTS as a column).

    ``non_blank`` also requires ``key <> ''`` before it can be an orphan.
    The flag is never NULL, like ``x IS NOT NULL AND NOT EXISTS (...)``.
    """
    ks = key_set(ref, ref_key)
    # NULL keys match nothing; as NULLs they would all meet in one partition
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*df.columns), F.lit(1024)).cast("string"))
    probe = F.coalesce(F.col(key).cast("string"), spread)
    joined = df.join(ks, probe == F.col("__ref_key").cast("string"), "left")
    return joined.withColumn(name, _absent(key, non_blank)).drop("__ref_key", "__ref_hit")


def _absent(key: str, non_blank: bool) -> Column:
    cond = F.col(key).isNotNull()
    if non_blank:
        cond = cond & (F.col(key) != F.lit(""))
    return cond & F.col("__ref_hit").isNull()


def latest_with_orphan_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], tie_breakers: Sequence[str | Column],
                            key: str, ref: DataFrame, ref_key: str, name: str, non_blank: bool = False) -> DataFrame:
    """``orphan_flag`` of the rows that ``dedupe_latest`` keeps, with one shuffle of the rows.

    ``key`` is one of ``keys``, so equal dedupe keys lie together where the
    rows are dealt by ``key`` for the join, and the window needs no shuffle of
    its own. NULL keys are dealt by the other keys. A hot key's partition is
    split by adaptive execution, which then shuffles for the window after all.
    """
    others = [k for k in keys if k != key]
    spread = F.concat(F.lit("\0"), F.xxhash64(*others).cast("string"))
    probe = F.coalesce(F.col(key).cast("string"), spread)
    joined = df.join(key_set(ref, ref_key), probe == F.col("__ref_key").cast("string"), "left").drop("__ref_key")
    latest = dedupe_latest(joined.withColumn("__probe", probe), ["__probe", *keys], order, tie_breakers)  # a column after the shuffle only
    return latest.withColumn(name, _absent(key, non_blank)).drop("__probe", "__ref_hit")


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str) -> DataFrame:
    """``SELECT keys, count(*) AS name GROUP BY keys`` (partial + final agg)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias(name))


def having_count(df: DataFrame, keys: Sequence[str], name: str = "n", more_than: int = 1) -> DataFrame:
    """Groups whose row count exceeds ``more_than``."""
    return count_by(df, keys, name).where(F.col(name) > more_than)


def asof_join(fact: DataFrame, history: DataFrame, key: str, ts: str,
              from_col: str, to_col: str, cols: Sequence[str],
              open_end: str = "9999-12-31 00:00:00", split_rows: int = 1_000_000) -> DataFrame:
    """Left join each fact row to the history version valid at ``fact.ts``.

    Validity is half-open ``[from, to)``; a NULL ``to`` means open-ended. Facts
    and versions of a key are one union sorted by time; a forward fill carries
    the newest started version to each fact, which keeps it if it has not
    ended. Versions of a key don't overlap (``overlapping_window_violations``
    finds those that do; of such ones the latest started counts).

    A key with more than ``split_rows`` facts is dealt over that many parts
    more, each with a copy of the key's versions, so no task holds a hot key.
    The table of such keys is broadcast: it has fewer than facts / split_rows
    rows. Facts without key or time match nothing and stay out of the sort.
    """
    vals = [*cols, from_col, to_col]
    hot = (fact.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))
           .where(F.col("__n") > split_rows).select("__hot", F.ceil(F.col("__n") / split_rows).alias("__parts")))
    hot = F.broadcast(hot)
    n_parts = F.coalesce(F.col("__parts"), F.lit(1))
    version = F.struct(*[F.col(c) for c in vals])
    names = fact.columns
    row = F.struct(*[F.col(c) for c in names])

    placed = fact.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    placed = placed.join(hot, F.col(key) == F.col("__hot"), "left").select(
        F.col(key).alias("__key"), F.pmod(F.xxhash64(*names), n_parts).alias("__part"), F.col(ts).cast("timestamp_ntz").alias("__at"),
        F.lit(1).alias("__kind"), row.alias("__row"))
    versions = history.where(F.col(key).isNotNull() & F.col(from_col).isNotNull())
    versions = versions.join(hot, F.col(key) == F.col("__hot"), "left").select(
        F.col(key).alias("__key"), F.explode(F.sequence(F.lit(0).cast("long"), n_parts - 1)).alias("__part"),
        F.col(from_col).cast("timestamp_ntz").alias("__at"), F.lit(0).alias("__kind"), version.alias("__version"))
    both = placed.unionByName(versions, allowMissingColumns=True)
    w = Window.partitionBy("__key", "__part").orderBy("__at", "__kind", "__version").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("__version", F.last("__version", ignorenulls=True).over(w)).where(F.col("__kind") == 1)
    end = F.coalesce(F.col("__version")[to_col], F.lit(open_end).cast("timestamp_ntz"))
    held = F.when(F.col("__at") < end, F.col("__version"))
    matched = filled.withColumn("__version", held).select("__row.*", *[F.col("__version")[c].alias(c) for c in vals])
    types = {f.name: f.dataType for f in history.schema.fields}
    lone = fact.where(F.col(key).isNull() | F.col(ts).isNull()).select(*names, *[F.lit(None).cast(types[c]).alias(c) for c in vals])
    return matched.unionByName(lone)
