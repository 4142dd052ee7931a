"""Registered queries: one Spark callable per operator ID, bound to the driver's tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables. ``ORACLE`` (in ``oracle_queries.py``) holds the matching
DuckDB SQL for each name that has one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache as cached

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .plans import marts, staging
from .plans.build import build_full
from .session import dropping_shuffles, materializer, tune
from .sources.bindings import LazyRaw, bind_raw

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def finish(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles so results compare across engines."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return finish(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# Model definitions are lazy plans; they are defined once per session and
# input folder and shared by every query (like registering views). Each
# query still executes its whole plan from the input tables.
_MODELS: dict = {}


def model(spark, sf_dir: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _MODELS:
        _MODELS[key] = build()
    return _MODELS[key]


def clear_models() -> None:
    _MODELS.clear()


def _raw(spark, sf_dir):
    return model(spark, sf_dir, "raw", lambda: bind_raw(spark, sf_dir))


def _built(spark, sf_dir):
    return model(spark, sf_dir, "built", lambda: build_full(_raw(spark, sf_dir)))


def _pair(spark, sf_dir):
    return model(spark, sf_dir, "pair", lambda: SC.full_pair(spark, sf_dir))


# ------------------------------------------------------------- flagship ---
@query("safe_drinking_ward_day")
def q_safe_drinking_ward_day(spark, sf_dir):
    """Safe drinking water by ward and day over the whole pipeline."""
    return _built(spark, sf_dir).ward_day


# ---------------------------------------------------------------- dedupe ---
@query("dedupe_submission")
def q_dedupe_submission(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return staging.dedupe_submission(staging.standardise_submission(raw.submissions))


@query("dedupe_household")
def q_dedupe_household(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return staging.dedupe_household(staging.standardise_household(raw.households))


@query("dedupe_member")
def q_dedupe_member(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return staging.dedupe_member(staging.standardise_member(raw.members))


@query("dedupe_water_point")
def q_dedupe_water_point(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return staging.dedupe_water_point(staging.standardise_water_point(raw.water_points))


@query("latest_household_state")
def q_latest_household_state(spark, sf_dir):
    return marts.household_current_source(_built(spark, sf_dir).events)


# ------------------------------------------------------------- dq flags ---
@query("dq_flags_submission")
def q_dq_flags_submission(spark, sf_dir):
    return _built(spark, sf_dir).staged.submission_base


@query("dq_flags_household")
def q_dq_flags_household(spark, sf_dir):
    return _built(spark, sf_dir).staged.household_base


@query("dq_flags_member")
def q_dq_flags_member(spark, sf_dir):
    return _built(spark, sf_dir).staged.member_base


@query("dq_flags_water_point")
def q_dq_flags_water_point(spark, sf_dir):
    return _built(spark, sf_dir).staged.water_point_base


@query("dq_flags_rollup")
def q_dq_flags_rollup(spark, sf_dir):
    return _built(spark, sf_dir).rollup


# ------------------------------------------------------- accept / reject ---
def _split(entity: str, part: str):
    def fn(spark, sf_dir):
        st = _built(spark, sf_dir).staged
        return getattr(getattr(st, entity), part)
    return fn


for _entity in ("submission", "household", "member", "water_point"):
    query(f"accept_{_entity}")(_split(_entity, "accepted"))
    query(f"reject_{_entity}")(_split(_entity, "rejected"))


@query("limbo_rows")
def q_limbo_rows(spark, sf_dir):
    """Rows in neither output, all four entities, keyed by entity name."""
    st = _built(spark, sf_dir).staged
    parts = []
    for name, split in (("submission", st.submission), ("household", st.household),
                        ("member", st.member), ("water_point", st.water_point)):
        keys = {
            "submission": ["submission_id", F.lit(None).cast("string").alias("household_id"),
                           F.lit(None).cast("long").alias("member_index"),
                           F.lit(None).cast("string").alias("water_point_id")],
            "household": ["submission_id", "household_id", F.lit(None).cast("long").alias("member_index"),
                          F.lit(None).cast("string").alias("water_point_id")],
            "member": ["submission_id", "household_id", "member_index",
                       F.lit(None).cast("string").alias("water_point_id")],
            "water_point": ["submission_id", F.lit(None).cast("string").alias("household_id"),
                            F.lit(None).cast("long").alias("member_index"), "water_point_id"],
        }[name]
        parts.append(split.limbo.select(F.lit(name).alias("entity"), *keys, "record_loaded_at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("submitted_only")
def q_submitted_only(spark, sf_dir):
    return _built(spark, sf_dir).submitted


# ----------------------------------------------------------------- joins ---
@query("orphan_flag")
def q_orphan_flag(spark, sf_dir):
    """Households whose submission is not an accepted one (the existence join)."""
    b = _built(spark, sf_dir).staged.household_base
    return b.select("household_id", "submission_id", "dq_orphan_submission_id")


@query("household_event_join")
def q_household_event_join(spark, sf_dir):
    return _built(spark, sf_dir).events


@query("safe_inputs_join")
def q_safe_inputs_join(spark, sf_dir):
    return _built(spark, sf_dir).safe_inputs


@query("member_health_rollup")
def q_member_health_rollup(spark, sf_dir):
    return _built(spark, sf_dir).rollup.select(
        "household_id", "submission_id", "record_loaded_at", "member_count",
        "total_diarrhoea_case_count_14d", "total_no_diarrhoea_count_14d", "total_unknown_diarrhoea_count_14d",
        "total_recorded_cases")


@query("strict_no_diarrhoea")
def q_strict_no_diarrhoea(spark, sf_dir):
    return _built(spark, sf_dir).rollup.select("household_id", "submission_id", "has_no_diarrhoea_14d_members")


@query("kpi_flags")
def q_kpi_flags(spark, sf_dir):
    return _built(spark, sf_dir).fact


@query("eligible_events")
def q_eligible_events(spark, sf_dir):
    b = _built(spark, sf_dir)
    return marts.eligible_events(b.safe_inputs).select("household_id", "submission_id", "member_count")


# ------------------------------------------------------------ monitoring ---
from .operators import incremental as I  # noqa: E402
from .operators.relational import union_all  # noqa: E402
from .operators import scd2  # noqa: E402
from .operators.expectations import ROW_LEVEL, read_failures, run_expectations, store_failures  # noqa: E402
from .plans import checks as CK  # noqa: E402
from .plans import monitors as MON  # noqa: E402
from .plans import scenario as SC  # noqa: E402


@query("mon_total_by_model_day")
def q_mon_total(spark, sf_dir):
    return MON.total_by_model_day(_built(spark, sf_dir).staged)


@query("mon_rejections_by_model_day")
def q_mon_rejections(spark, sf_dir):
    return MON.rejections_by_model_day(_built(spark, sf_dir).staged)


@query("mon_rejection_rate_day")
def q_mon_rejection_rate(spark, sf_dir):
    return MON.rejection_rate_day(_built(spark, sf_dir).staged)


@query("rejection_rate_join")
def q_rejection_rate_join(spark, sf_dir):
    """The rate from the two count tables, joined by model and day."""
    st = staging.stage_all(_raw(spark, sf_dir), materializer(spark, "rates"))  # each base is counted twice and read by others
    return MON.rejection_rate_join(MON.total_by_model_day(st), MON.rejections_by_model_day(st))


@query("mon_rejection_by_reason_day")
def q_mon_reason(spark, sf_dir):
    return MON.rejection_by_reason_day(_built(spark, sf_dir).staged)


@query("mon_unknown_diarrhoea_rate_ward_day")
def q_mon_unknown(spark, sf_dir):
    return MON.unknown_diarrhoea_rate_ward_day(_built(spark, sf_dir).fact)


@query("mon_late_arrival_rate_ward_day")
def q_mon_late(spark, sf_dir):
    return MON.late_arrival_rate_ward_day(_built(spark, sf_dir).submitted)


@query("source_freshness")
def q_source_freshness(spark, sf_dir):
    return MON.source_freshness(_raw(spark, sf_dir), SC.FRESHNESS_NOW)


# ----------------------------------------------------------- incremental ---
@query("incremental_append")
def q_incremental_append(spark, sf_dir):
    """Raw submissions after appending batch 1 and then a full re-delivery."""
    from .plans.increment import append_raw
    b1, allr = SC.raw_pair(spark, sf_dir)
    store = I.TableStore(spark, SC.scratch_path(spark, "append"))
    append_raw(store, b1)
    return append_raw(store, allr).submissions


@query("incremental_append_all")
def q_incremental_append_all(spark, sf_dir):
    """Keys and load times of all four raw tables after the same two deliveries."""
    from .plans.increment import RAW_NAMES, append_raw
    b1, allr = SC.raw_pair(spark, sf_dir)
    store = I.TableStore(spark, SC.scratch_path(spark, "append-all"))
    append_raw(store, b1)
    append_raw(store, allr)
    own = {"household_id": F.col("household_id"), "member_index": F.col("member_index"), "water_point_id": F.col("water_point_id")}
    tables = []
    for name in RAW_NAMES:
        df = store.read(name)
        keys = [c if n in df.columns else F.lit(None).cast("long" if n == "member_index" else "string") for n, c in own.items()]
        tables.append(df.select(F.lit(name).alias("table_name"), "submission_id", *(c.alias(n) for c, n in zip(keys, own)), "_loaded_at"))
    return union_all(tables)


@query("scan_ref")
def q_scan_ref(spark, sf_dir):
    """A stored model read by its name, after a second version was published over the first."""
    first, full = _pair(spark, sf_dir)
    store = I.TableStore(spark, SC.scratch_path(spark, "ref"))
    store.publish("int_household_event", first.events)
    store.publish("int_household_event", full.events)
    return store.read("int_household_event")


@query("incremental_load_window")
def q_incremental_load_window(spark, sf_dir):
    first, full = _pair(spark, sf_dir)
    return I.load_window(full.events, I.target_max(first.events, "record_loaded_at"))


@query("incremental_event_window")
def q_incremental_event_window(spark, sf_dir):
    return I.event_window(_built(spark, sf_dir).fact, SC.AS_OF)


@query("impacted_keys_join")
def q_impacted_keys_join(spark, sf_dir):
    first, full = _pair(spark, sf_dir)
    since = I.window_start(I.target_max(first.rollup, "record_loaded_at"))
    members = full.staged.member.accepted
    return marts.member_rollup(members, marts.impacted_keys(members, since))


@query("distinct_keys")
def q_distinct_keys(spark, sf_dir):
    return marts.impacted_keys(_built(spark, sf_dir).staged.member.accepted)


@query("scalar_max")
def q_scalar_max(spark, sf_dir):
    ev = _built(spark, sf_dir).events
    return ev.agg(F.max("record_loaded_at").alias("max_record_loaded_at"))


@query("merge_upsert")
def q_merge_upsert(spark, sf_dir):
    """int_household_event after two incremental runs (load-window upsert)."""
    _, _, r2 = SC.two_increments(spark, sf_dir)
    return r2.events


@query("impacted_group_recompute")
def q_impacted_group_recompute(spark, sf_dir):
    """Member rollup after two incremental runs (impacted groups recomputed)."""
    _, _, r2 = SC.two_increments(spark, sf_dir)
    return r2.rollup


@query("merge_upsert_ward_day")
def q_merge_upsert_ward_day(spark, sf_dir):
    """Ward-day KPI after two incremental runs (every window applied)."""
    _, _, r2 = SC.two_increments(spark, sf_dir)
    return r2.ward_day


@query("schema_sync")
def q_schema_sync(spark, sf_dir):
    """Ward-day upsert whose source adds a column: history rows get NULL."""
    first, full = _pair(spark, sf_dir)
    src = I.event_window(full.ward_day, SC.AS_OF).withColumn(
        "household_events_unsafe", F.col("household_events_total") - F.col("household_events_safe"))
    store = I.TableStore(spark, SC.scratch_path(spark, "schema-sync"))
    store.publish("ward_day", first.ward_day)
    return store.upsert("ward_day", src, ["ward_id", "event_date"])


@query("backfill_range")
def q_backfill_range(spark, sf_dir):
    """Facts of 1998 from the second build merged into the first's; written step by step, so that no shuffle outlives its step."""
    stored = materializer(spark, "backfill")
    first, full = SC.full_pair(spark, sf_dir, stored, LazyRaw(_raw(spark, sf_dir), stored))
    src = I.backfill_range(full.fact, SC.BACKFILL_START, SC.BACKFILL_END)
    return I.upsert(first.fact, src, ["household_id", "submission_id"])


@query("full_rebuild")
def q_full_rebuild(spark, sf_dir):
    """Ward-day table written as a new full version and read back."""
    store = I.TableStore(spark, SC.scratch_path(spark, "rebuild"))
    return store.publish("fact_agg_safe_drinking_ward_day", _built(spark, sf_dir).ward_day)


# ------------------------------------------------------------------ scd2 ---
CHECK_COLS = ("ward_id", "district", "municipality", "hh_size_reported", "has_toilet", "water_filter_type",
              "primary_water_source")


def _snapshots(spark, sf_dir, materialize=None):
    if materialize is None:
        return model(spark, sf_dir, "snapshots", lambda: _snapshots_of(*_pair(spark, sf_dir)))
    return _snapshots_of(*SC.full_pair(spark, sf_dir, materialize))


def _snapshots_of(first, full):
    s1 = scd2.scd2_snapshot(None, marts.household_current_source(first.events), "household_id", CHECK_COLS,
                            SC.SNAPSHOT_1, carry_cols=("submission_id",))
    s2 = scd2.scd2_snapshot(s1, marts.household_current_source(full.events), "household_id", CHECK_COLS,
                            SC.SNAPSHOT_2, carry_cols=("submission_id",))
    return full, s2


HISTORY_COLUMNS = ("household_id", "ward_id", "district", "municipality", "hh_size_reported", "has_toilet",
                   "water_filter_type", "primary_water_source", "submission_id", "dbt_valid_to", "dbt_valid_from")


@query("scd2_snapshot")
def q_scd2_snapshot(spark, sf_dir):
    """The dimension after two runs over its stored versions; the second reads open ones only."""
    store = I.TableStore(spark, SC.scratch_path(spark, "snapshots"))
    for built, at in zip(_pair(spark, sf_dir), (SC.SNAPSHOT_1, SC.SNAPSHOT_2)):
        scd2.scd2_snapshot_run(store, "dim_household", marts.household_current_source(built.events), "household_id",
                               CHECK_COLS, at, carry_cols=("submission_id",))
    return store.read("dim_household")


@query("scd2_history")
def q_scd2_history(spark, sf_dir):
    return _snapshots(spark, sf_dir)[1].select(*HISTORY_COLUMNS)


@query("scd2_current")
def q_scd2_current(spark, sf_dir):
    return scd2.scd2_current(_snapshots(spark, sf_dir)[1]).select(*HISTORY_COLUMNS)


@query("asof_scd2_join")
def q_asof_scd2_join(spark, sf_dir):
    from .operators.relational import asof_join
    full, snap = _snapshots(spark, sf_dir)
    stored = materializer(spark, "asof")  # the join's two inputs are tables
    fact, snap = stored(full.fact.select(*marts.ENRICHED_FACT_COLUMNS)), stored(snap)
    return asof_join(fact, snap, "household_id", "submitted_at", "dbt_valid_from", "dbt_valid_to",
                     marts.ENRICHED_DIM_COLUMNS)


@query("lag")
def q_lag(spark, sf_dir):
    """Previous version end per household (the overlap test's window)."""
    from pyspark.sql import Window
    snap = _snapshots(spark, sf_dir)[1]
    w = Window.partitionBy("household_id").orderBy(F.col("dbt_valid_from").asc_nulls_first())
    end = F.coalesce(F.col("dbt_valid_to"), F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))
    return snap.select("household_id", "dbt_valid_from", end.alias("dbt_valid_to")) \
        .withColumn("prev_valid_to", F.lag("dbt_valid_to").over(w))


@query("singular_one_current_row")
def q_singular_one_current(spark, sf_dir):
    return scd2.one_current_row_violations(_snapshots(spark, sf_dir)[1], "household_id")


@query("singular_no_overlapping_windows")
def q_singular_overlap(spark, sf_dir):
    return scd2.overlapping_window_violations(_snapshots(spark, sf_dir)[1], "household_id")


@query("singular_valid_range")
def q_singular_range(spark, sf_dir):
    return scd2.valid_range_violations(_snapshots(spark, sf_dir)[1], "household_id")


def _planted(spark, sf_dir):
    """The snapshot with violations planted for some households."""
    snap = _snapshots(spark, sf_dir)[1]
    now = snap.where(F.col("dbt_valid_to").isNull())
    key = F.col("household_id").cast("long")
    second = now.where(key % 7 == 0).withColumn("dbt_valid_from", F.timestamp_add("HOUR", F.lit(1), F.col("dbt_valid_from")))
    reversed_ = now.where(key % 11 == 0).withColumn("dbt_valid_to", F.timestamp_add("DAY", F.lit(-1), F.col("dbt_valid_from")))
    return snap.unionByName(second).unionByName(reversed_)


@query("singular_one_current_row_planted")
def q_singular_one_current_planted(spark, sf_dir):
    return scd2.one_current_row_violations(_planted(spark, sf_dir), "household_id")


@query("singular_no_overlapping_windows_planted")
def q_singular_overlap_planted(spark, sf_dir):
    return scd2.overlapping_window_violations(_planted(spark, sf_dir), "household_id")


@query("singular_valid_range_planted")
def q_singular_range_planted(spark, sf_dir):
    return scd2.valid_range_violations(_planted(spark, sf_dir), "household_id")


@query("having_count")
def q_having_count(spark, sf_dir):
    from .operators.relational import having_count
    return having_count(_built(spark, sf_dir).events, ["household_id"], "n_events", 1)


# ---------------------------------------------------------- expectations ---
class Models(Mapping):
    """Models by name, each defined when it is first read: a report builds what its checks look at."""

    def __init__(self, define: dict[str, Callable[[], DataFrame]]):
        self._define, self._made = define, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._define[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._define)

    def __len__(self) -> int:
        return len(self._define)



def counted_landing(land: DataFrame, columns: list[str], stored) -> tuple[DataFrame, DataFrame]:
    """(landing, flattened) rows to count: documents are made, parsed and read once, and only what is counted is written.

    ``payload`` tells whether there is one, only corrupt rows keep their text,
    and the flattened rows have ``columns``.
    """
    rows = stored(land.select(F.when(F.col("payload").isNotNull(), True).alias("payload"), "file_name", "ingested_at",
                              F.when(L.is_corrupt(), F.col("payload_text")).alias("payload_text"),
                              L.submissions(columns).alias("__subs")))
    return rows.drop("__subs"), L.flatten_read(L.split_corrupt(rows)[0], columns)


def survey_frames(spark, sf_dir, counted: list | None = None) -> Models:
    """Every model of one full build plus the two-run snapshot, by model name.

    ``counted``: the checks whose failing rows are only counted. Where they look
    at landing's and the flattened table's columns by name, as declared, both
    are ``counted_landing``.
    """
    from .operators.relational import asof_join
    m = materializer(spark, "checks")
    first, full = SC.full_pair(spark, sf_dir, m)
    st = full.staged
    raw = _raw(spark, sf_dir)
    ext_columns = CK.columns_read(counted, "ext_kobo_source_flattened") if counted else None
    if ext_columns and CK.only_presence(counted, "landing"):
        slim = cached(lambda: counted_landing(_landing(spark, sf_dir)[1], ext_columns, m))
        land, ext = lambda: slim()[0], lambda: slim()[1]
    else:
        land = lambda: _landing(spark, sf_dir)[1]
        ext = lambda: L.flatten(L.split_corrupt(land())[0])
    frames = Models({
        "landing": land, "ext_kobo_source_flattened": ext,
        "raw_kobo_submission": lambda: raw.submissions, "raw_kobo_household": lambda: raw.households,
        "raw_kobo_member": lambda: raw.members, "raw_kobo_waterpoint": lambda: raw.water_points,
        "stg_kobo_submission": lambda: st.submission.accepted, "stg_kobo_household": lambda: st.household.accepted,
        "stg_kobo_member": lambda: st.member.accepted, "stg_kobo_water_point": lambda: st.water_point.accepted,
        "int_household_event": lambda: full.events, "int_submission_submitted": lambda: full.submitted,
        "int_household_member_health_rollup": lambda: full.rollup, "int_household_safe_inputs": lambda: full.safe_inputs,
        "int_household_current_source": lambda: marts.household_current_source(full.events),
        "snap_dim_household": lambda: m(_snapshots_of(first, full)[1]),
        "dim_household_history": lambda: frames["snap_dim_household"].select(*HISTORY_COLUMNS),
        "dim_household_current": lambda: scd2.scd2_current(frames["snap_dim_household"]).select(*HISTORY_COLUMNS),
        "fact_household_wash_event": lambda: full.fact, "fact_agg_safe_drinking_ward_day": lambda: full.ward_day,
        "fact_household_wash_event_enriched_scd2": lambda: asof_join(
            full.fact.select(*marts.ENRICHED_FACT_COLUMNS), frames["snap_dim_household"], "household_id", "submitted_at",
            "dbt_valid_from", "dbt_valid_to", marts.ENRICHED_DIM_COLUMNS),
        "mon_total_by_model_day": lambda: MON.total_by_model_day(st),
        "mon_rejections_by_model_day": lambda: MON.rejections_by_model_day(st),
        "mon_rejection_rate_day": lambda: MON.rejection_rate_day(st),
        "mon_rejection_by_reason_day": lambda: MON.rejection_by_reason_day(st),
        "mon_unknown_diarrhoea_rate_ward_day": lambda: MON.unknown_diarrhoea_rate_ward_day(full.fact),
        "mon_late_arrival_rate_ward_day": lambda: MON.late_arrival_rate_ward_day(full.submitted),
    })
    return frames


def _report(kind):
    def fn(spark, sf_dir):
        frames = survey_frames(spark, sf_dir, [c for c in CK.declared_checks() if kind is None or c.kind == kind])
        return run_expectations(frames, [c for c in CK.checks_for(frames) if kind is None or c.kind == kind])
    return fn


for _kind in ("not_null", "unique", "unique_combination", "accepted_values", "relationship", "expression"):
    query(f"expect_{_kind}")(_report(_kind))
query("run_expectations")(_report(None))


@query("store_failures")
def q_store_failures(spark, sf_dir):
    """Kept failing rows of one check, read back from the audit folder of all row-level checks of its table."""
    frames = survey_frames(spark, sf_dir)
    table = "stg_kobo_household"
    root = SC.scratch_path(spark, "audit")
    store_failures(frames, [c for c in CK.declared_checks() if c.table == table], root)
    kept = read_failures(frames, root, table)
    return kept.where(F.col("check_name") == "expression_stg_kobo_household_hh_size").drop("check_name")


@query("store_failures_all")
def q_store_failures_all(spark, sf_dir):
    """Kept failing rows of every row-level check of every table, counted from the audit folder."""
    frames = survey_frames(spark, sf_dir)
    checks = [c for c in CK.checks_for(frames) if c.kind in ROW_LEVEL]
    root = SC.scratch_path(spark, "audit")
    store_failures(frames, checks, root)
    tables = dict.fromkeys(c.table for c in checks)
    kept = [read_failures(frames, root, t).select(F.lit(t).alias("table_name"), "check_name") for t in tables]
    return union_all(kept).groupBy("table_name", "check_name").agg(F.count(F.lit(1)).alias("failures"))


# --------------------------------------------------------------- landing ---
from .sources import batches as B  # noqa: E402
from .sources import landing as L  # noqa: E402
from .streaming import ingest as S  # noqa: E402

EXT_COLUMNS = [c for c in L.SUBMISSION_FIELDS if c not in ("members", "water_point")]


def corrupt_copies(docs: DataFrame, text: F.Column | None = None) -> DataFrame:
    """Truncated copies of some documents (orders with key % 211 = 0): unparseable records."""
    return docs.where(_is_copied()).withColumn("json", _cut(text))


def with_corrupt_copies(docs: DataFrame, text: F.Column | None = None) -> DataFrame:
    """The documents and their truncated copies, in one pass over the documents."""
    texts = F.when(_is_copied(), F.array(F.col("json"), _cut(text))).otherwise(F.array(F.col("json")))
    return docs.select(*[c for c in docs.columns if c != "json"], F.explode(texts).alias("json"))


def _is_copied() -> F.Column:
    return F.pmod(F.split(F.col("doc_key"), ":").getItem(0).cast("long"), F.lit(211)) == 0


def _cut(text: F.Column | None) -> F.Column:
    return F.substring(F.col("json"), 1, 40) if text is None else text


def _landing(spark, sf_dir):
    def build():
        docs = L.landing_documents(spark, sf_dir)
        return docs, L.landing_table(with_corrupt_copies(docs))
    return model(spark, sf_dir, "landing", build)


def _submission_ids() -> F.Column:
    """The payload's submissions, by their ids: as many elements as the array has, which is not built anew as VARIANT."""
    return F.try_variant_get(F.col("payload"), "$.submissions", "array<struct<submission_id:string>>")


@query("scan_landing")
def q_scan_landing(spark, sf_dir):
    """Landing rows with the size of their submissions array (NULL when corrupt)."""
    _, land = _landing(spark, sf_dir)
    subs = _submission_ids()
    # NULL (not -1) for a corrupt payload whatever the session's ANSI setting
    n = F.when(subs.isNotNull(), F.size(subs))
    return land.select("file_name", "ingested_at", n.alias("n_submissions"))


@query("landing_corrupt")
def q_landing_corrupt(spark, sf_dir):
    """Records whose payload does not parse, split off to the side table."""
    allr = with_corrupt_copies(L.landing_documents(spark, sf_dir))
    land = allr.select("doc_key", "file_name", "ingested_at", F.explode(F.array(F.try_parse_json("json"))).alias("payload"),
                       F.col("json").alias("payload_text"))
    _, corrupt = L.split_corrupt(land)
    return corrupt.select("doc_key", "file_name", "ingested_at")


@query("explode_outer_submissions")
def q_explode_outer_submissions(spark, sf_dir):
    _, land = _landing(spark, sf_dir)
    good, _ = L.split_corrupt(land)
    return L.flatten(good, EXT_COLUMNS)


def _landing_raw(spark, sf_dir):
    def build():
        _, land = _landing(spark, sf_dir)
        good, _ = L.split_corrupt(land)
        return L.raw_from_landing(good)
    return model(spark, sf_dir, "landing_raw", build)


@query("json_path_cast")
def q_json_path_cast(spark, sf_dir):
    return _landing_raw(spark, sf_dir).submissions


@query("raw_household_model")
def q_raw_household_model(spark, sf_dir):
    return _landing_raw(spark, sf_dir).households


@query("audit_columns")
def q_audit_columns(spark, sf_dir):
    return _landing_raw(spark, sf_dir).households.select("household_id", "submission_id", "_loaded_at",
                                                         "_batch_id", "_source_file", "_is_deleted")


@query("explode_outer_members")
def q_explode_outer_members(spark, sf_dir):
    return _landing_raw(spark, sf_dir).members


@query("nested_object_to_table")
def q_nested_object_to_table(spark, sf_dir):
    return _landing_raw(spark, sf_dir).water_points


@query("child_parent_keys")
def q_child_parent_keys(spark, sf_dir):
    """Members whose own copy of a parent key differs from the parent's (null-safe)."""
    m = _landing_raw(spark, sf_dir).members
    return m.where(~F.col("household_id").eqNullSafe(F.col("fla_household_id"))
                   | ~F.col("submission_id").eqNullSafe(F.col("fla_submission_id"))) \
        .select("household_id", "submission_id", "member_index", "fla_household_id", "fla_submission_id")


# Documents of several submissions and members: rounds of visits.
def _rounds(spark, sf_dir):
    def build():
        docs = B.batch_documents(spark, sf_dir)
        unclosed = F.expr("left(json, length(json) - 1)")  # an empty round is shorter than the other cut
        return L.landing_table(with_corrupt_copies(docs, unclosed))
    return model(spark, sf_dir, "rounds", build)


def _rounds_raw(spark, sf_dir):
    def build():
        good, _ = L.split_corrupt(_rounds(spark, sf_dir))
        return L.raw_from_landing(good)
    return model(spark, sf_dir, "rounds_raw", build)


@query("scan_landing_rounds")
def q_scan_landing_rounds(spark, sf_dir):
    """Landing rows of rounds: 0 to 3 submissions, NULL without the array and for corrupt payloads."""
    subs = _submission_ids()
    return _rounds(spark, sf_dir).select("file_name", "ingested_at", F.when(subs.isNotNull(), F.size(subs)).alias("n_submissions"))


@query("explode_rounds_submissions")
def q_explode_rounds_submissions(spark, sf_dir):
    """One row per submission of a round, one NULL row for a round without any."""
    good, _ = L.split_corrupt(_rounds(spark, sf_dir))
    return L.flatten(good, EXT_COLUMNS)


@query("explode_rounds_members")
def q_explode_rounds_members(spark, sf_dir):
    """One row per member of every submission, one NULL row for an empty or missing roster."""
    return _rounds_raw(spark, sf_dir).members


@query("nested_object_rounds")
def q_nested_object_rounds(spark, sf_dir):
    """The nested water point of every submission of a round; NULL where a submission has none."""
    return _rounds_raw(spark, sf_dir).water_points


@query("child_parent_mismatch")
def q_child_parent_mismatch(spark, sf_dir):
    """Members whose own copy of a parent key is wrong or missing."""
    m = _rounds_raw(spark, sf_dir).members.where(F.col("member_index").isNotNull())
    keys = [(k, f"fla_{k}") for k in ("household_id", "submission_id")]
    wrong = [F.coalesce(F.col(own) != F.col(k), F.lit(False)).alias(f"{k}_differs") for k, own in keys]
    missing = [F.col(own).isNull().alias(f"{k}_missing") for k, own in keys]
    out = m.select("household_id", "submission_id", "member_index", *(own for _, own in keys), *wrong, *missing)
    return out.where("household_id_differs or submission_id_differs or household_id_missing or submission_id_missing")


@query("landing_to_ward_day")
def q_landing_to_ward_day(spark, sf_dir):
    """Ward-day KPI from landing documents: parsed, flattened, staged, integrated and published in one batch."""
    stored = materializer(spark, "rounds")  # documents are parsed once, bases staged once
    good, _ = L.split_corrupt(_rounds(spark, sf_dir))
    return build_full(L.raw_from_flat(stored(L.flatten(good))), stored).ward_day


# ------------------------------------------------------------- streaming ---
LINES = {"glob": "part-*", "whole_files": False}  # test files hold one document per line
FILES_PER_TRIGGER = 3
# a gzip file is read by one task, so landing files are many
LANDING_FILES, LANDING_FILES_PER_TRIGGER = 144, 48


def _write_landing_files(spark, sf_dir) -> str:
    """Landing documents as compressed files, dealt by order; gzip's fastest level, as its default takes as long as the JSON."""
    docs = L.landing_documents(spark, sf_dir, LANDING_FILES)
    src = SC.scratch_path(spark, "landing-src")
    texts = with_corrupt_copies(docs).select(F.col("json").alias("value"))
    with dropping_shuffles(texts):
        texts.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(src)
    return src


def _ingested(spark, sf_dir) -> I.TableStore:
    """Landing tables after three triggers, a run without new files, and all batches replayed from a lost checkpoint."""
    src = _write_landing_files(spark, sf_dir)
    store = I.TableStore(spark, SC.scratch_path(spark, "landing"))
    kept, lost = SC.scratch_path(spark, "landing-ckpt"), SC.scratch_path(spark, "landing-ckpt")
    for checkpoint in (kept, kept, lost):
        S.ingest_landing(spark, src, checkpoint, store, max_files=LANDING_FILES_PER_TRIGGER, **LINES)
    return store


@query("landing_ingest")
def q_landing_ingest(spark, sf_dir):
    """Stream ingest of landing files, each once, flattened."""
    return L.flatten(S.read_landing(_ingested(spark, sf_dir)), EXT_COLUMNS)


@query("landing_ingest_corrupt")
def q_landing_ingest_corrupt(spark, sf_dir):
    """Records that the stream split off."""
    return _ingested(spark, sf_dir).read("landing_corrupt").select("payload_text")


@query("stream_increment")
def q_stream_increment(spark, sf_dir):
    """Ward-day KPI after the streamed landing files ran through a foreachBatch increment."""
    src = _write_landing_files(spark, sf_dir)
    store = I.TableStore(spark, SC.scratch_path(spark, "stream"))
    S.stream_increment(spark, src, SC.scratch_path(spark, "stream-ckpt"), store, SC.AS_OF, **LINES)
    return store.read("fact_agg_safe_drinking_ward_day")


@query("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    """Latest submission per id over three triggers."""
    src = _write_landing_files(spark, sf_dir)
    store = I.TableStore(spark, SC.scratch_path(spark, "dedupe"))
    S.stream_dedupe(spark, src, SC.scratch_path(spark, "dedupe-ckpt"), store, max_files=LANDING_FILES_PER_TRIGGER, **LINES)
    return store.read("submission_latest")


def _write_fact_files(spark, sf_dir) -> tuple[str, T.StructType]:
    """Facts in three deliveries: the older half, the newer one, then a tenth of all days' rows, long after the watermark."""
    fact = materializer(spark, "facts")(_built(spark, sf_dir).fact.select(
        "household_id", "submission_id", "ward_id", "submitted_at", "event_date", "is_safe_drinking"))
    src = SC.scratch_path(spark, "fact-src")
    delayed = F.pmod(F.xxhash64("household_id", "submission_id"), F.lit(10)) == 0
    newer = F.coalesce(F.col("event_date") >= F.lit("1995-06-01").cast("date"), F.lit(False))
    for n, rows in enumerate((fact.where(~delayed & ~newer), fact.where(~delayed & newer), fact.where(delayed))):
        rows.repartition(FILES_PER_TRIGGER, "household_id").write.parquet(f"{src}/{n}")
    return src, fact.schema


@query("stream_ward_kpi")
def q_stream_ward_kpi(spark, sf_dir):
    """Ward-day KPI as windows under a watermark over three triggers, late rows computed again from stored ones."""
    src, schema = _write_fact_files(spark, sf_dir)
    store = I.TableStore(spark, SC.scratch_path(spark, "ward-kpi"))
    S.ward_kpi(spark, src, schema, SC.scratch_path(spark, "ward-kpi-ckpt"), store, max_files=FILES_PER_TRIGGER)
    return S.read_ward_kpi(store)


@query("late_data_window")
def q_late_data_window(spark, sf_dir):
    """Daily event counts per type from the events stream, read in place."""
    store = I.TableStore(spark, SC.scratch_path(spark, "windows"))
    S.windowed_counts(spark, f"{sf_dir.rstrip('/')}/events.parque[t]", SC.scratch_path(spark, "windows-ckpt"), store)
    return store.read("event_windows")


# --------------------------------------------------------------- scalars ---
from .sources.tables import table as _table  # noqa: E402


@query("try_cast")
def q_try_cast(spark, sf_dir):
    """NULL instead of an error for text that does not cast (ids, numbers, times)."""
    from .functions.columns import try_boolean, try_number
    o = _table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").try_cast("long").alias("submission_key"),
        F.substring("o_orderpriority", 1, 1).try_cast("long").alias("priority_rank"),
        F.col("o_orderpriority").try_cast("long").alias("priority_as_number"),
        try_number(F.concat(F.col("o_orderkey"), F.lit(".5"))).alias("half_up"),
        try_number(F.concat(F.lit("-"), F.col("o_orderkey"), F.lit(".5"))).alias("half_down"),
        try_number(F.concat(F.col("o_orderkey"), F.lit(".4"))).alias("below_half"),
        try_number(F.concat(F.lit("9" * 24), F.lit("."), F.col("o_orderkey") % 10)).alias("over_range"),
        try_boolean(F.element_at(F.array(*map(F.lit, ("on", "off", " Yes", "maybe"))), (F.col("o_orderkey") % 4 + 1).cast("int"))).alias("flag_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").try_cast("timestamp_ntz").alias("iso_time"),
        F.concat(F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit(" 10:00")).try_cast("timestamp_ntz")
         .alias("day_first_time"))


@query("text_scalars")
def q_text_scalars(spark, sf_dir):
    """lower/trim canonical text, model base names, coalesce defaults."""
    from .functions.columns import base_model_name, canonical_text
    c = _table(spark, sf_dir, "customer")
    model = F.concat(F.lit("stg_"), F.lower("c_mktsegment"), F.lit("__base"))
    return c.select(
        "c_custkey",
        canonical_text(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))).alias("segment"),
        model.alias("model_name"),
        base_model_name(model).alias("base_model_name"),
        F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("unknown")).alias("segment_or_unknown"))


@query("date_scalars")
def q_date_scalars(spark, sf_dir):
    """to_date, day arithmetic and the late-arrival comparison on the order clock."""
    o = _table(spark, sf_dir, "orders")
    loaded = F.timestamp_add("DAY", F.pmod(F.col("o_orderkey"), F.lit(10)), F.col("o_orderdate"))
    return o.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("event_date"),
        F.date_sub(F.to_date("o_orderdate"), 30).alias("lookback_from"),
        loaded.alias("loaded_at"),
        (F.to_date("o_orderdate") < F.to_date(loaded)).alias("is_late"))


@query("pii_projection")
def q_pii_projection(spark, sf_dir):
    """Accepted households without head name and phone (PII never leaves staging)."""
    hh = _built(spark, sf_dir).staged.household.accepted
    return hh.drop("household_head_name", "phone_last4")


@query("pii_projection_member")
def q_pii_projection_member(spark, sf_dir):
    """Accepted members without their names."""
    return _built(spark, sf_dir).staged.member.accepted.drop("member_name")


@query("union_all")
def q_union_all(spark, sf_dir):
    """Submission keys of the four accepted entity sets, by name (UNION ALL)."""
    st = staging.stage_all(_raw(spark, sf_dir), materializer(spark, "union"))  # bases with several readers
    return union_all([
        st.submission.accepted.select(F.lit("submission").alias("entity"), "submission_id"),
        st.household.accepted.select(F.lit("household").alias("entity"), "submission_id"),
        st.member.accepted.select(F.lit("member").alias("entity"), "submission_id"),
        st.water_point.accepted.select(F.lit("water_point").alias("entity"), "submission_id"),
    ])


# --------------------------------------------------------- small models ---
@query("constant_column")
def q_constant_column(spark, sf_dir):
    """Raw submissions carry the form id and version as typed constants."""
    return _raw(spark, sf_dir).submissions.select("submission_id", "form_id", "form_version")


@query("not_null_times")
def q_not_null_times(spark, sf_dir):
    """Submitted submissions with both clocks present (the late-arrival base)."""
    s = _built(spark, sf_dir).submitted
    return s.where(F.col("submitted_at").isNotNull() & F.col("record_loaded_at").isNotNull()) \
        .select("ward_id", F.to_date("submitted_at").alias("event_date"), "submitted_at", "record_loaded_at")


@query("landing_freshness")
def q_landing_freshness(spark, sf_dir):
    """Age of the newest landing row against the landing thresholds (24 h / 48 h)."""
    _, land = _landing(spark, sf_dir)
    return MON.landing_freshness(land, SC.FRESHNESS_NOW)
