"""Integration and marts: household events, member rollup, KPI fact, ward-day KPI.

Grains: household x submission for events, rollup, safe inputs and the
fact; ward x event date for the headline aggregate. Joins are equi-joins on
those keys (unique per side), aggregates are partial + final hash
aggregates, so every shuffle is keyed and map-side combined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import iff, safe_ratio
from ..functions.valuesets import SAFE_FILTERS_CODE, SAFE_SOURCES_CODE
from ..operators.relational import dedupe_latest

KEYS = ["household_id", "submission_id"]


def household_event(accepted_households: DataFrame, submitted: DataFrame) -> DataFrame:
    """Accepted household joined to its submitted submission.

    Ward, municipality, district, submitted time and load time come from the
    submission (Q15).
    """
    hh = accepted_households.select(
        "household_id", F.col("submission_id").alias("__hh_sub"), "hh_size_reported",
        "water_filter_type", "primary_water_source", "has_toilet")
    ss = submitted.select("submission_id", "ward_id", "municipality", "district", "submitted_at",
                          "record_loaded_at")
    j = hh.join(ss, F.col("__hh_sub") == F.col("submission_id"), "inner")
    return j.select("household_id", "submission_id", "ward_id", "municipality", "district",
                    "submitted_at", "hh_size_reported", "water_filter_type", "primary_water_source",
                    "has_toilet", "record_loaded_at")


def impacted_keys(members: DataFrame, since=None, load_col: str = "record_loaded_at") -> DataFrame:
    """Distinct (household, submission) keys, optionally only those loaded since ``since``."""
    m = members if since is None else members.where(F.col(load_col) >= since)
    return m.select(*KEYS).distinct()


def member_rollup(accepted_members: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Per household x submission: member counts and tri-state diarrhoea sums.

    With ``keys``, only those groups are recomputed, over all their members
    (a left-semi join: the key set is distinct).
    """
    m = accepted_members
    if keys is not None:
        m = m.join(keys, KEYS, "left_semi")
    d = F.col("member_had_diarrhoea_14d")
    g = m.groupBy(*KEYS).agg(
        F.max("record_loaded_at").alias("record_loaded_at"),
        F.countDistinct("member_index").cast("long").alias("member_count"),
        F.sum((d == "yes").cast("long")).alias("total_diarrhoea_case_count_14d"),
        F.sum((d == "no").cast("long")).alias("total_no_diarrhoea_count_14d"),
        F.sum((d == "unknown").cast("long")).alias("total_unknown_diarrhoea_count_14d"),
    )
    return rollup_flags(rollup_total_recorded(g))


def rollup_total_recorded(g: DataFrame) -> DataFrame:
    return g.withColumn("total_recorded_cases",
                        F.col("total_diarrhoea_case_count_14d") + F.col("total_no_diarrhoea_count_14d")
                        + F.col("total_unknown_diarrhoea_count_14d"))


def strict_no_diarrhoea(yes: str, unknown: str, no: str, members: str):
    """yes = 0 AND unknown = 0 AND no > 0 AND no = member_count."""
    return ((F.col(yes) == 0) & (F.col(unknown) == 0)
            & ((F.col(no) > 0) & (F.col(no) == F.col(members))))


def rollup_flags(g: DataFrame) -> DataFrame:
    return g.withColumns({
        "dq_invalid_member_count": F.col("member_count") > 15,
        "dq_invalid_diarrhoea_case_count": F.col("total_recorded_cases") > F.col("member_count"),
        "has_no_diarrhoea_14d_members": strict_no_diarrhoea(
            "total_diarrhoea_case_count_14d", "total_unknown_diarrhoea_count_14d",
            "total_no_diarrhoea_count_14d", "member_count"),
    })


def safe_inputs(events: DataFrame, rollup: DataFrame) -> DataFrame:
    """Events with their member rollup; events without members drop out."""
    e = events.select("household_id", "submission_id", "submitted_at", "ward_id", "hh_size_reported",
                      "water_filter_type", "primary_water_source", "record_loaded_at", "has_toilet")
    r = rollup.select(*KEYS, "member_count", "total_diarrhoea_case_count_14d",
                      "total_unknown_diarrhoea_count_14d", "total_no_diarrhoea_count_14d",
                      "has_no_diarrhoea_14d_members")
    return e.join(r, KEYS, "inner")


def kpi_flags(df: DataFrame, safe_sources: Sequence[str] = SAFE_SOURCES_CODE,
              safe_filters: Sequence[str] = SAFE_FILTERS_CODE) -> DataFrame:
    """Add the three KPI flags; the safe lists are parameters (code lists by default)."""
    df = df.withColumns({
        "has_safe_primary_source": F.col("primary_water_source").isin(list(safe_sources)),
        "has_safe_water_filter": F.col("water_filter_type").isin(list(safe_filters)),
    })
    return df.withColumn("is_safe_drinking",
                         (F.col("has_safe_primary_source") == True)  # noqa: E712
                         & (F.col("has_safe_water_filter") == True)  # noqa: E712
                         & (F.col("has_no_diarrhoea_14d_members") == True))  # noqa: E712


def eligible_events(df: DataFrame) -> DataFrame:
    return df.where(F.col("member_count") >= 1)


FACT_COLUMNS = (
    "household_id", "submission_id", "ward_id", "submitted_at", "event_date", "hh_size_reported",
    "has_toilet", "water_filter_type", "primary_water_source", "member_count",
    "total_diarrhoea_yes_14d", "total_diarrhoea_no_14d", "total_diarrhoea_unknown_14d",
    "has_no_diarrhoea_14d_members", "has_safe_primary_source", "has_safe_water_filter",
    "is_safe_drinking",
)


def fact_household_wash_event(inputs: DataFrame, safe_sources: Sequence[str] = SAFE_SOURCES_CODE,
                              safe_filters: Sequence[str] = SAFE_FILTERS_CODE) -> DataFrame:
    src = inputs.select(
        "household_id", "submission_id", "ward_id", "submitted_at",
        F.to_date("submitted_at").alias("event_date"),
        "hh_size_reported", "has_toilet", "water_filter_type", "primary_water_source", "member_count",
        F.col("total_diarrhoea_case_count_14d").alias("total_diarrhoea_yes_14d"),
        F.col("total_no_diarrhoea_count_14d").alias("total_diarrhoea_no_14d"),
        F.col("total_unknown_diarrhoea_count_14d").alias("total_diarrhoea_unknown_14d"),
        "has_no_diarrhoea_14d_members",
    )
    return eligible_events(kpi_flags(src, safe_sources, safe_filters)).select(*FACT_COLUMNS)


def ward_day(fact: DataFrame) -> DataFrame:
    """Safe drinking water by ward and day: total, safe, rounded share."""
    safe = F.sum(iff("is_safe_drinking", F.lit(1), F.lit(0))).cast("long")
    g = fact.groupBy("ward_id", "event_date").agg(
        F.count(F.lit(1)).cast("long").alias("household_events_total"),
        safe.alias("household_events_safe"),
    )
    return g.withColumn("pct_safe", safe_ratio("household_events_safe", "household_events_total", 2))


CURRENT_SOURCE_COLUMNS = ("household_id", "ward_id", "district", "municipality", "hh_size_reported",
                          "has_toilet", "water_filter_type", "primary_water_source", "submission_id",
                          "record_loaded_at")


def household_current_source(events: DataFrame) -> DataFrame:
    """Latest event per household (load time, then submitted time, then id; all DESC NULLS FIRST)."""
    top = dedupe_latest(events, ["household_id"], ["record_loaded_at", "submitted_at", "submission_id"])
    return top.select(*CURRENT_SOURCE_COLUMNS)


ENRICHED_FACT_COLUMNS = ("household_id", "submission_id", "submitted_at", "event_date",
                         "total_diarrhoea_yes_14d", "total_diarrhoea_no_14d", "total_diarrhoea_unknown_14d",
                         "has_no_diarrhoea_14d_members", "has_safe_primary_source", "has_safe_water_filter",
                         "is_safe_drinking")
ENRICHED_DIM_COLUMNS = ("ward_id", "district", "municipality", "hh_size_reported", "has_toilet",
                        "water_filter_type", "primary_water_source")
