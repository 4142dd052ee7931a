"""One incremental build over stored tables (raw append -> staging -> upserts).

Order matches the model dependencies; each model reads its upstream
*table* after that table's update. The staging bases are written once per run
(by ``materialize``, if given) and read by all their consumers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.valuesets import SAFE_FILTERS_CODE, SAFE_SOURCES_CODE
from ..operators import incremental as I
from ..session import materializer
from ..sources.bindings import RawFrames
from . import marts, staging

KEYS = ["household_id", "submission_id"]
RAW_NAMES = ("raw_kobo_submission", "raw_kobo_household", "raw_kobo_member", "raw_kobo_waterpoint")


@dataclass
class IncrementResult:
    raw: RawFrames
    staged: staging.Staged
    events: DataFrame
    rollup: DataFrame
    safe_inputs: DataFrame
    fact: DataFrame
    ward_day: DataFrame


def append_raw(store: I.TableStore, frames: RawFrames, batch: str | None = None) -> RawFrames:
    """Append to the raw tables and return them whole.

    A named batch (a micro-batch: each record is delivered once) is added as it
    is; otherwise only rows newer than the table are, by the strict bound.
    """
    out = []
    for name, df in zip(RAW_NAMES, (frames.submissions, frames.households, frames.members, frames.water_points)):
        new = I.append_new(df, store.read(name)) if batch is None else df
        out.append(store.append(name, new, batch))
    return RawFrames(*out)


def changed_groups(raw: RawFrames, since_submission, since_member) -> RawFrames:
    """The raw rows that decide what the load windows of events and rollup let through.

    Keys flow down the staging levels from the newly loaded rows. A submission
    that survives its dedupe inside the window has a row loaded inside it, and
    so has a member; their submission and household ids are the changed keys.
    Every group that a dedupe or a flag of theirs looks at is taken whole,
    with all its history: all rows of these submissions, their households, all
    members of the changed households, and the households and submissions that
    those refer to. Rows without a key are never accepted and stay out.
    """
    def keys(df: DataFrame, column: str, since=None) -> DataFrame:
        rows = df if since is None else df.where(F.col("_loaded_at") >= since)
        return rows.select(F.col(column).try_cast("string").alias("__key")).where(F.col("__key").isNotNull()).distinct()

    def of(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
        return df.join(wanted, F.col(column).try_cast("string") == F.col("__key"), "left_semi")

    new_subs = keys(raw.submissions, "submission_id", since_submission)
    new_homes = keys(raw.members, "household_id", since_member)
    members = of(raw.members, "household_id", new_homes)
    homes = of(raw.households, "household_id", new_homes)
    refs = keys(members, "submission_id").unionByName(keys(homes, "submission_id")).unionByName(new_subs).distinct()
    # a household row belongs to a new submission or to a changed household, or to both: take each once
    sub_key, home_key = F.col("submission_id").try_cast("string"), F.col("household_id").try_cast("string")
    marked = raw.households.join(new_subs.select(F.col("__key").alias("__s")), sub_key == F.col("__s"), "left") \
        .join(new_homes.select(F.col("__key").alias("__h")), home_key == F.col("__h"), "left")
    households = marked.where(F.col("__s").isNotNull() | F.col("__h").isNotNull()).drop("__s", "__h")
    return RawFrames(of(raw.submissions, "submission_id", refs), households, members, of(raw.water_points, "submission_id", refs))


def run_increment(store: I.TableStore, frames: RawFrames, as_of, materialize=None,
                  safe_sources=SAFE_SOURCES_CODE, safe_filters=SAFE_FILTERS_CODE,
                  fact_grain: str | None = "month", load_grain: str = "month",
                  batch: str | None = None) -> IncrementResult:
    """One incremental run.

    Every upserted table is partitioned and only touched partitions are
    rewritten: facts by event date at ``fact_grain`` ("month" suits small
    daily volumes; None partitions by day, for large tables), integration
    tables by load date at ``load_grain`` (their 7-day load window touches
    one or two months). Later runs stage only the groups that the load windows
    can let through (``changed_groups``); ``staged`` holds those.
    """
    raw = append_raw(store, frames, batch)
    ev_t, ro_t = store.read("int_household_event"), store.read("int_household_member_health_rollup")
    to_stage = raw
    if ev_t is not None and ro_t is not None:
        to_stage = changed_groups(raw, I.window_start(I.target_max(ev_t, "record_loaded_at")),
                                  I.window_start(I.target_max(ro_t, "record_loaded_at")))
    # each base has several readers: staged once
    st = staging.stage_all(to_stage, materialize or materializer(store.spark, "increment-bases"))
    submitted = staging.submitted_only(st.submission.accepted)

    ev_src = marts.household_event(st.household.accepted, submitted)
    if ev_t is not None:
        ev_src = I.load_window(ev_src, I.target_max(ev_t, "record_loaded_at"))
    events = store.upsert_partitions("int_household_event", ev_src, KEYS, "record_loaded_at", load_grain)

    members = st.member.accepted
    if ro_t is None:
        ro_src = marts.member_rollup(members)
    else:
        since = I.window_start(I.target_max(ro_t, "record_loaded_at"))
        ro_src = marts.member_rollup(members, marts.impacted_keys(members, since))
    rollup = store.upsert_partitions("int_household_member_health_rollup", ro_src, KEYS, "record_loaded_at",
                                     load_grain)

    si_t = store.read("int_household_safe_inputs")
    si_src = marts.safe_inputs(events, rollup)
    if si_t is not None:
        si_src = I.load_window(si_src, I.target_max(si_t, "record_loaded_at"))
    inputs = store.upsert_partitions("int_household_safe_inputs", si_src, KEYS, "record_loaded_at", load_grain)

    fa_t = store.read("fact_household_wash_event")
    fa_src = marts.fact_household_wash_event(inputs, safe_sources, safe_filters)
    if fa_t is not None:
        fa_src = I.event_window(fa_src, as_of)
    # facts are partitioned by event date: the 30-day window rewrites the partitions it
    # touches, not the table
    fact = store.upsert_partitions("fact_household_wash_event", fa_src, KEYS, "event_date", fact_grain)

    wd_t = store.read("fact_agg_safe_drinking_ward_day")
    wd_src = marts.ward_day(fact)
    if wd_t is not None:
        wd_src = I.event_window(wd_src, as_of)
    ward_day = store.upsert_partitions("fact_agg_safe_drinking_ward_day", wd_src, ["ward_id", "event_date"],
                                       "event_date", fact_grain)

    return IncrementResult(raw, st, events, rollup, inputs, fact, ward_day)
