"""Monitoring operators: per-model daily counts, rates, reason buckets, freshness.

All are grouped aggregates (partial aggregation before the shuffle), so a
hot model or day costs one pre-aggregated row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import base_model_name, safe_ratio
from .relational import union_all


def count_by_model_day(frames: Mapping[str, DataFrame], count_name: str,
                       load_col: str = "record_loaded_at") -> DataFrame:
    """For each named frame: ``model_name, event_date(load), count``, unioned.

    ``event_date`` is the load date; NULL load times form their own group.
    """
    parts = []
    for name, df in frames.items():
        parts.append(
            df.groupBy(F.to_date(F.col(load_col)).alias("event_date"))
            .agg(F.count(F.lit(1)).cast("long").alias(count_name))
            .select(F.lit(name).alias("model_name"), "event_date", count_name))
    out = union_all(parts)
    return out.withColumn("base_model_name", base_model_name("model_name"))


def rejection_rate_by_day(bases: Mapping[str, tuple[DataFrame, Column]], load_col: str = "record_loaded_at",
                          scale: int = 4) -> DataFrame:
    """Totals, rejections and their rate per model and load date, one aggregate per base.

    ``bases`` maps a model name to its base and the predicate of its rejected
    rows. Rejections of the NULL-date group count as 0: in the join form
    (``rejection_rate``) NULL dates match nothing.
    """
    parts = []
    for name, (df, rejected) in bases.items():
        hit = F.when(rejected & F.col(load_col).isNotNull(), 1).otherwise(0)
        parts.append(
            df.groupBy(F.to_date(F.col(load_col)).alias("event_date"))
            .agg(F.count(F.lit(1)).cast("long").alias("base_row_count"), F.sum(hit).cast("long").alias("rejected_row_count"))
            .select(base_model_name(F.lit(name)).alias("model_name"), "event_date", "base_row_count", "rejected_row_count"))
    return union_all(parts).withColumn("rejection_rate", safe_ratio("rejected_row_count", "base_row_count", scale))


def rejection_rate(total: DataFrame, rejected: DataFrame, scale: int = 4) -> DataFrame:
    """Totals left-joined to rejections per base model and day; rate rounded."""
    t = total.select(F.col("base_model_name").alias("model_name"), "event_date", "base_row_count")
    r = rejected.select(F.col("base_model_name").alias("__r_model"), F.col("event_date").alias("__r_date"),
                        "rejected_row_count")
    j = t.join(r, (F.col("model_name") == F.col("__r_model")) & (F.col("event_date") == F.col("__r_date")),
               "left")
    j = j.select("model_name", "event_date", "base_row_count",
                 F.coalesce(F.col("rejected_row_count"), F.lit(0)).cast("long").alias("rejected_row_count"))
    return j.withColumn("rejection_rate", safe_ratio("rejected_row_count", "base_row_count", scale))


def reason_bucket(ladder: Sequence[tuple[str, Column]], default: str = "other") -> Column:
    """First-match CASE ladder; a NULL condition counts as not true."""
    out = None
    for bucket, cond in ladder:
        out = F.when(cond, F.lit(bucket)) if out is None else out.when(cond, F.lit(bucket))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def reason_counts(frames: Mapping[str, tuple[DataFrame, Sequence[tuple[str, Column]]]],
                  load_col: str = "record_loaded_at") -> DataFrame:
    """Rejected rows per base model, load date and first matching reason."""
    parts = []
    for name, (df, ladder) in frames.items():
        parts.append(df.select(
            F.lit(name).alias("model_name"),
            base_model_name(F.lit(name)).alias("base_model_name"),
            F.to_date(F.col(load_col)).alias("event_date"),
            reason_bucket(ladder).alias("reason_bucket")))
    return (union_all(parts).groupBy("base_model_name", "event_date", "reason_bucket")
            .agg(F.count(F.lit(1)).cast("long").alias("rejected_rows")))


def unknown_rate(fact: DataFrame, scale: int = 3) -> DataFrame:
    """Unknown diarrhoea answers per ward and event day (BIGINT sums, Q12)."""
    g = fact.groupBy("ward_id", "event_date").agg(
        F.sum("member_count").cast("long").alias("member_count"),
        F.sum(F.col("total_diarrhoea_unknown_14d").cast("long")).alias("unknown_diarrhoea_count"))
    return g.withColumn("unknown_rate", safe_ratio("unknown_diarrhoea_count", "member_count", scale))


def late_rate(submitted: DataFrame, event_col: str = "submitted_at", load_col: str = "record_loaded_at") -> DataFrame:
    """Share of submissions whose load date is after their event date."""
    base = submitted.where(F.col(event_col).isNotNull() & F.col(load_col).isNotNull())
    late = F.when(F.to_date(F.col(event_col)) < F.to_date(F.col(load_col)), 1).otherwise(0)
    g = base.groupBy("ward_id", F.to_date(F.col(event_col)).alias("event_date")).agg(
        F.count(F.lit(1)).cast("long").alias("submissions_total"),
        F.sum(late).cast("long").alias("submissions_late"))
    rate = (F.when(F.col("submissions_total") == 0, F.lit(0.0))
            .otherwise(F.col("submissions_late").cast("double") / F.col("submissions_total").cast("double")))
    return g.withColumn("late_arrival_rate", rate)


def freshness(frames: Mapping[str, DataFrame], col: str, now, warn_hours: float, error_hours: float) -> DataFrame:
    """Age of the newest row per source against warn / error thresholds.

    ``now`` is injected (a TIMESTAMP_NTZ literal string or Column) so the
    result is reproducible.
    """
    now_c = F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now
    parts = []
    for name, df in frames.items():
        parts.append(df.agg(F.max(F.col(col)).alias("max_loaded_at"))
                     .select(F.lit(name).alias("source_name"), "max_loaded_at"))
    out = union_all(parts).withColumn("snapshotted_at", now_c)
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.col("snapshotted_at"))
    out = out.withColumn("age_seconds", age.cast("long"))
    status = (F.when(F.col("age_seconds").isNull(), F.lit("error"))
              .when(F.col("age_seconds") > F.lit(int(error_hours * 3600)), F.lit("error"))
              .when(F.col("age_seconds") > F.lit(int(warn_hours * 3600)), F.lit("warn"))
              .otherwise(F.lit("pass")))
    return out.withColumn("status", status)
