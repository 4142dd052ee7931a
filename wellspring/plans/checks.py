"""The declared data tests of the survey models, as ``Check`` values.

Table names are the model names; ``frames`` passed to ``run_expectations``
maps them to DataFrames (see ``survey_frames``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import valuesets as V
from ..operators import scd2
from ..operators.expectations import Check

AUDIT = ("_loaded_at", "_batch_id", "_source_file", "_is_deleted")


def _nn(table: str, cols, severity: str = "error", where: str | None = None) -> list[Check]:
    return [Check(f"not_null_{table}_{c}", table, "not_null", {"column": c}, severity, where) for c in cols]


def _uc(table: str, cols, severity: str = "error") -> Check:
    return Check(f"unique_combination_{table}_{'_'.join(cols)}", table, "unique_combination",
                 {"columns": list(cols)}, severity)


def _ex(table: str, name: str, expression: str, severity: str = "error", where: str | None = None) -> Check:
    return Check(f"expression_{table}_{name}", table, "expression", {"expression": expression}, severity, where)


def _rel(table: str, col: str, to: str, field: str, where: str | None = None) -> Check:
    return Check(f"relationship_{table}_{col}_{to}", table, "relationship",
                 {"column": col, "to": to, "field": field}, "error", where)


def _av(table: str, col: str, values, severity="error", warn_if="!= 0", error_if="!= 0") -> Check:
    return Check(f"accepted_values_{table}_{col}", table, "accepted_values", {"column": col, "values": list(values)},
                 severity, None, warn_if, error_if)


def declared_checks() -> list[Check]:
    # fixed rules: names, expressions and thresholds are those the models declare
    c: list[Check] = []
    c += _nn("landing", ("payload", "file_name", "ingested_at"))
    c += _nn("ext_kobo_source_flattened", ("_loaded_at", "_source_file", "_is_deleted"))
    for raw in ("raw_kobo_submission", "raw_kobo_household", "raw_kobo_member", "raw_kobo_waterpoint"):
        c += _nn(raw, AUDIT)
    # staging
    t = "stg_kobo_submission"
    c += [_ex(t, "submitted_has_time", "(status <> 'submitted') OR (submitted_at IS NOT NULL)",
              where="is_deleted = false"),
          Check(f"unique_{t}_submission_id", t, "unique", {"column": "submission_id"}),
          _av(t, "status", V.SUBMISSION_STATUSES, error_if="> 10")]
    c += _nn(t, ("submission_id", "ward_id", "municipality", "district", "enumerator_id"))
    t = "stg_kobo_household"
    c += [_ex(t, "hh_size", "hh_size_reported > 0 and hh_size_reported < 15"),
          _ex(t, "household_id", "household_id is not null and trim(household_id) <> ''"),
          _ex(t, "submission_id", "submission_id is not null and trim(submission_id) <> ''"),
          _uc(t, ("household_id", "submission_id")),
          _rel(t, "submission_id", "stg_kobo_submission", "submission_id",
               "submission_id is not null and submission_id <> ''"),
          _av(t, "water_filter_type", V.WATER_FILTER_TYPES),
          _av(t, "primary_water_source", V.WATER_SOURCES)]
    c += _nn(t, ("household_id", "ward_id", "hh_size_reported"))
    t = "stg_kobo_member"
    c += [_uc(t, ("household_id", "member_index")),
          _ex(t, "age", "member_age_in_years >= 0 and member_age_in_years <= 120"),
          _ex(t, "household_id", "household_id is not null and trim(household_id) <> ''"),
          _ex(t, "submission_id", "submission_id is not null and trim(submission_id) <> ''"),
          _rel(t, "household_id", "stg_kobo_household", "household_id",
               "household_id is not null and household_id <> ''"),
          _rel(t, "submission_id", "stg_kobo_submission", "submission_id",
               "submission_id is not null and submission_id <> ''"),
          _av(t, "member_sex", V.MEMBER_SEXES),
          _av(t, "member_had_diarrhoea_14d", V.DIARRHOEA_STATES)]
    c += _nn(t, ("member_index",))
    t = "stg_kobo_water_point"
    c += [_uc(t, ("water_point_id", "submission_id")),
          _ex(t, "distance", "distance_minutes is not null and distance_minutes >= 0"),
          _ex(t, "water_point_id", "water_point_id is not null and trim(water_point_id) <> ''"),
          _ex(t, "submission_id", "submission_id is not null and trim(submission_id) <> ''"),
          _rel(t, "submission_id", "stg_kobo_submission", "submission_id",
               "submission_id is not null and submission_id <> ''"),
          _av(t, "source_type", V.WATER_SOURCES)]
    c += _nn(t, ("water_point_id", "ward_id", "distance_minutes", "source_type"))
    # intermediate
    t = "int_household_event"
    c += [_uc(t, ("household_id", "submission_id")),
          _rel(t, "submission_id", "stg_kobo_submission", "submission_id")]
    c += _nn(t, ("household_id", "submission_id", "ward_id", "submitted_at"))
    t = "int_submission_submitted"
    c += [_ex(t, "status", "status = 'submitted'"),
          Check(f"unique_{t}_submission_id", t, "unique", {"column": "submission_id"})]
    c += _nn(t, ("submission_id",))
    t = "int_household_member_health_rollup"
    c += [_uc(t, ("household_id", "submission_id")),
          _ex(t, "cases", "total_diarrhoea_case_count_14d >= 0 and total_diarrhoea_case_count_14d <= member_count")]
    c += _nn(t, ("household_id", "submission_id", "member_count", "total_diarrhoea_case_count_14d",
                 "has_no_diarrhoea_14d_members"))
    t = "int_household_safe_inputs"
    c += [_uc(t, ("household_id", "submission_id")),
          _ex(t, "counts_add_up", "member_count = (total_diarrhoea_case_count_14d + "
              "total_unknown_diarrhoea_count_14d + total_no_diarrhoea_count_14d)"),
          _ex(t, "strict_rule", "has_no_diarrhoea_14d_members = ((total_diarrhoea_case_count_14d = 0 and "
              "total_unknown_diarrhoea_count_14d = 0) and (total_no_diarrhoea_count_14d = member_count))")]
    c += _nn(t, ("household_id", "submission_id", "has_no_diarrhoea_14d_members"))
    t = "int_household_current_source"
    c += [_uc(t, ("household_id",)), Check(f"unique_{t}_household_id", t, "unique", {"column": "household_id"})]
    c += _nn(t, ("household_id", "ward_id", "municipality", "district"))
    # marts
    t = "dim_household_current"
    c += [Check(f"unique_{t}_household_id", t, "unique", {"column": "household_id"})]
    c += _nn(t, ("household_id", "ward_id", "municipality", "district"))
    t = "dim_household_history"
    c += [_uc(t, ("household_id", "dbt_valid_from"), "warn")]
    c += _nn(t, ("household_id", "dbt_valid_from"), "warn")
    t = "fact_household_wash_event"
    c += [_uc(t, ("household_id", "submission_id")),
          _ex(t, "kpi", "is_safe_drinking = (has_safe_primary_source and has_safe_water_filter and "
              "has_no_diarrhoea_14d_members)"),
          _ex(t, "members", "member_count >= 1")]
    c += _nn(t, ("household_id", "submission_id", "has_safe_water_filter", "has_safe_primary_source",
                 "is_safe_drinking"))
    t = "fact_agg_safe_drinking_ward_day"
    c += [_uc(t, ("ward_id", "event_date")),
          _ex(t, "safe_le_total", "household_events_safe <= household_events_total"),
          _ex(t, "pct", "pct_safe between 0 and 1")]
    c += _nn(t, ("ward_id", "event_date", "household_events_total", "household_events_safe", "pct_safe"))
    t = "fact_household_wash_event_enriched_scd2"
    c += [_uc(t, ("household_id", "submission_id")),
          _ex(t, "asof_bounds", "dbt_valid_from is null or ( submitted_at >= dbt_valid_from and "
              "(dbt_valid_to is null or submitted_at < dbt_valid_to) )")]
    c += _nn(t, ("household_id", "submission_id"))
    # monitoring
    t = "mon_rejections_by_model_day"
    c += [_uc(t, ("base_model_name", "event_date"))]
    c += _nn(t, ("base_model_name", "event_date", "rejected_row_count"), "warn")
    t = "mon_total_by_model_day"
    c += [_uc(t, ("base_model_name", "event_date"))]
    c += _nn(t, ("base_model_name", "event_date", "base_row_count"), "warn")
    t = "mon_rejection_rate_day"
    c += [_uc(t, ("model_name", "event_date"), "warn"),
          _ex(t, "base", "base_row_count >= 0", "warn"), _ex(t, "rejected", "rejected_row_count >= 0", "warn"),
          _ex(t, "rate", "rejection_rate between 0 and 1", "warn"),
          _ex(t, "le", "rejected_row_count <= base_row_count", "warn")]
    c += _nn(t, ("model_name", "event_date", "base_row_count", "rejected_row_count", "rejection_rate"), "warn")
    t = "mon_unknown_diarrhoea_rate_ward_day"
    c += [_uc(t, ("ward_id", "event_date"), "warn"),
          _ex(t, "count", "unknown_diarrhoea_count >= 0", "warn"),
          _ex(t, "rate", "unknown_rate between 0 and 1", "warn")]
    t = "mon_rejection_by_reason_day"
    c += [_uc(t, ("base_model_name", "event_date", "reason_bucket")),
          _ex(t, "rows", "rejected_rows >= 0", "warn"),
          _av(t, "reason_bucket", V.REASON_BUCKETS, "warn")]
    c += _nn(t, ("base_model_name", "event_date", "reason_bucket", "rejected_rows"), "warn")
    t = "mon_late_arrival_rate_ward_day"
    c += [_ex(t, "rate", "late_arrival_rate between 0 and 1")]
    # snapshot singular tests
    c += [Check("one_current_row_per_household", "snap_dim_household", "custom",
                {"fn": lambda f: scd2.one_current_row_violations(f["snap_dim_household"], "household_id")}),
          Check("snapshot_no_overlapping_windows", "snap_dim_household", "custom",
                {"fn": lambda f: scd2.overlapping_window_violations(f["snap_dim_household"], "household_id")}),
          Check("snapshot_valid_from_valid_to_range_valid", "snap_dim_household", "custom",
                {"fn": lambda f: scd2.valid_range_violations(f["snap_dim_household"], "household_id")})]
    return c


def columns_read(checks: list[Check], table: str) -> list[str] | None:
    """The columns of ``table`` that ``checks`` read; None where they aren't known by name (expressions, conditions, functions)."""
    out: dict[str, None] = {}
    for c in checks:
        if c.table == table:
            if c.where is not None or c.kind in ("expression", "custom"):
                return None
            out |= dict.fromkeys(c.args["columns"] if c.kind == "unique_combination" else [c.args["column"]])
        if c.kind == "relationship" and c.args["to"] == table:
            out[c.args["field"]] = None
    return list(out)


def only_presence(checks: list[Check], table: str) -> bool:
    """True if the checks of ``table`` only look whether values are there."""
    own = [c for c in checks if c.table == table]
    return all(c.kind == "not_null" and c.where is None for c in own) and not any(c.args.get("to") == table for c in checks)


def checks_for(frames: dict[str, DataFrame]) -> list[Check]:
    """Declared checks whose tables (and parents) are present in ``frames``."""
    out = []
    for ch in declared_checks():
        need = {ch.table} | ({ch.args["to"]} if ch.kind == "relationship" else set())
        if need <= set(frames):
            out.append(ch)
    return out
