"""DuckDB SQL for each registered query name (see ``oracle.py`` for the CTEs)."""

from __future__ import annotations

from .oracle import render

ORACLE: dict[str, str] = {}


def oracle(name: str, final: str) -> None:
    ORACLE[name] = render(final)


oracle("safe_drinking_ward_day", "SELECT * FROM ward_day")

oracle("dedupe_submission", "SELECT * FROM sub_dedup")
oracle("dedupe_household", "SELECT * FROM hh_dedup")
oracle("dedupe_member", "SELECT * FROM mem_dedup")
oracle("dedupe_water_point", """
SELECT * REPLACE (CAST(distance_minutes AS DOUBLE) AS distance_minutes) FROM wp_dedup
""")
oracle("latest_household_state", """
SELECT household_id, ward_id, district, municipality, hh_size_reported, has_toilet, water_filter_type,
       primary_water_source, submission_id, record_loaded_at
FROM hh_event
QUALIFY row_number() OVER (PARTITION BY household_id ORDER BY record_loaded_at DESC NULLS FIRST,
                           submitted_at DESC NULLS FIRST, submission_id DESC NULLS FIRST) = 1
""")

oracle("dq_flags_submission", "SELECT * FROM sub_base")
oracle("dq_flags_household", "SELECT * FROM hh_base")
oracle("dq_flags_member", "SELECT * FROM mem_base")
oracle("dq_flags_water_point", """
SELECT * REPLACE (CAST(distance_minutes AS DOUBLE) AS distance_minutes) FROM wp_base
""")
oracle("dq_flags_rollup", "SELECT * FROM mem_rollup")

oracle("accept_submission", "SELECT * FROM sub_acc")
oracle("reject_submission", "SELECT * FROM sub_rej")
oracle("accept_household", "SELECT * FROM hh_acc")
oracle("reject_household", "SELECT * FROM hh_rej")
oracle("accept_member", "SELECT * FROM mem_acc")
oracle("reject_member", "SELECT * FROM mem_rej")
oracle("accept_water_point", "SELECT * FROM wp_acc")
oracle("reject_water_point", "SELECT * FROM wp_rej")

oracle("limbo_rows", """
SELECT 'submission' AS entity, submission_id, CAST(NULL AS VARCHAR) AS household_id,
       CAST(NULL AS BIGINT) AS member_index, CAST(NULL AS VARCHAR) AS water_point_id, record_loaded_at
FROM sub_base b
WHERE NOT EXISTS (SELECT 1 FROM sub_acc a WHERE a.submission_id IS NOT DISTINCT FROM b.submission_id)
  AND NOT EXISTS (SELECT 1 FROM sub_rej r WHERE r.submission_id IS NOT DISTINCT FROM b.submission_id)
UNION ALL
SELECT 'household', submission_id, household_id, NULL, NULL, record_loaded_at
FROM hh_base b
WHERE NOT EXISTS (SELECT 1 FROM hh_acc a WHERE a.household_id IS NOT DISTINCT FROM b.household_id
                  AND a.submission_id IS NOT DISTINCT FROM b.submission_id)
  AND NOT EXISTS (SELECT 1 FROM hh_rej r WHERE r.household_id IS NOT DISTINCT FROM b.household_id
                  AND r.submission_id IS NOT DISTINCT FROM b.submission_id)
UNION ALL
SELECT 'member', submission_id, household_id, member_index, NULL, record_loaded_at
FROM mem_base b
WHERE NOT EXISTS (SELECT 1 FROM mem_acc a WHERE a.household_id IS NOT DISTINCT FROM b.household_id
                  AND a.member_index IS NOT DISTINCT FROM b.member_index)
  AND NOT EXISTS (SELECT 1 FROM mem_rej r WHERE r.household_id IS NOT DISTINCT FROM b.household_id
                  AND r.member_index IS NOT DISTINCT FROM b.member_index)
UNION ALL
SELECT 'water_point', submission_id, NULL, NULL, water_point_id, record_loaded_at
FROM wp_base b
WHERE NOT EXISTS (SELECT 1 FROM wp_acc a WHERE a.water_point_id IS NOT DISTINCT FROM b.water_point_id
                  AND a.submission_id IS NOT DISTINCT FROM b.submission_id)
  AND NOT EXISTS (SELECT 1 FROM wp_rej r WHERE r.water_point_id IS NOT DISTINCT FROM b.water_point_id
                  AND r.submission_id IS NOT DISTINCT FROM b.submission_id)
""")

oracle("submitted_only", "SELECT * FROM sub_submitted")

oracle("orphan_flag", "SELECT household_id, submission_id, dq_orphan_submission_id FROM hh_base")
oracle("household_event_join", "SELECT * FROM hh_event")
oracle("safe_inputs_join", "SELECT * FROM safe_inputs")
oracle("member_health_rollup", """
SELECT household_id, submission_id, record_loaded_at, member_count, total_diarrhoea_case_count_14d,
       total_no_diarrhoea_count_14d, total_unknown_diarrhoea_count_14d, total_recorded_cases
FROM mem_rollup
""")
oracle("strict_no_diarrhoea", "SELECT household_id, submission_id, has_no_diarrhoea_14d_members FROM mem_rollup")
oracle("kpi_flags", "SELECT * FROM fact")
oracle("eligible_events", "SELECT household_id, submission_id, member_count FROM safe_inputs WHERE member_count >= 1")


# ------------------------------------------------------------ monitoring ---
import datetime as _dt  # noqa: E402

from .functions import valuesets as V  # noqa: E402
from .oracle import CTES, clone, cte, fact_select, ratio_sql, ROLLUP_FLAGS, ROLLUP_SELECT, WARD_DAY_SELECT, _list  # noqa: E402
from .sources.bindings import FILTER_CYCLE, POINT_TYPE_CYCLE, SOURCE_CYCLE  # noqa: E402
from .plans import scenario as SC  # noqa: E402
from .plans.increment import RAW_NAMES  # noqa: E402

BASE = f"TIMESTAMP '{V.INCREMENTAL_BASE_TS}'"
EVENT_FROM = (_dt.date.fromisoformat(SC.AS_OF) - _dt.timedelta(days=V.EVENT_LOOKBACK_DAYS)).isoformat()


def _count_union(parts, count_name):
    return "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model_name, CAST(record_loaded_at AS DATE) AS event_date, "
        f"CAST(count(*) AS BIGINT) AS {count_name} FROM {t} GROUP BY 1, 2" for m, t in parts)


cte("mon_total", "SELECT *, split_part(model_name, '__', 1) AS base_model_name FROM (\n" + _count_union([
    ("stg_kobo_submission__base", "sub_base"), ("stg_kobo_household__base", "hh_base"),
    ("stg_kobo_member__base", "mem_base"), ("stg_kobo_water_point__base", "wp_base")], "base_row_count") + ")")
cte("mon_rej", "SELECT *, split_part(model_name, '__', 1) AS base_model_name FROM (\n" + _count_union([
    ("stg_kobo_submission__rejected", "sub_rej"), ("stg_kobo_household__rejected", "hh_rej"),
    ("stg_kobo_member__rejected", "mem_rej"), ("stg_kobo_water_point__rejected", "wp_rej")],
    "rejected_row_count") + ")")
cte("mon_rate", f"""
SELECT *, {ratio_sql('rejected_row_count', 'base_row_count', 4)} AS rejection_rate
FROM (SELECT t.base_model_name AS model_name, t.event_date, t.base_row_count,
             CAST(coalesce(r.rejected_row_count, 0) AS BIGINT) AS rejected_row_count
      FROM mon_total t LEFT JOIN mon_rej r
        ON t.base_model_name = r.base_model_name AND t.event_date = r.event_date)
""")
cte("mon_reason", """
SELECT base_model_name, event_date, reason_bucket, CAST(count(*) AS BIGINT) AS rejected_rows FROM (
  SELECT 'stg_kobo_submission' AS base_model_name, CAST(record_loaded_at AS DATE) AS event_date,
         CASE WHEN dq_missing_submission_id THEN 'missing_keys'
              WHEN dq_submitted_missing_submitted_at THEN 'invalid_required_field'
              WHEN dq_invalid_gps THEN 'invalid_range' WHEN is_deleted THEN 'soft_deleted'
              ELSE 'other' END AS reason_bucket
  FROM sub_rej
  UNION ALL
  SELECT 'stg_kobo_household', CAST(record_loaded_at AS DATE),
         CASE WHEN dq_missing_blank_household_id OR dq_missing_blank_submission_id THEN 'missing_keys'
              WHEN dq_orphan_submission_id THEN 'orphan_fk'
              WHEN dq_invalid_water_filter_type OR dq_invalid_primary_water_source THEN 'invalid_canonical'
              WHEN dq_invalid_hh_size THEN 'invalid_range'
              WHEN dq_unknown_other_filter_type OR dq_unknown_other_primary_water_source THEN 'unknown_other'
              WHEN is_deleted THEN 'soft_deleted' ELSE 'other' END
  FROM hh_rej
  UNION ALL
  SELECT 'stg_kobo_member', CAST(record_loaded_at AS DATE),
         CASE WHEN dq_missing_household_id OR dq_missing_submission_id OR dq_missing_member_index THEN 'missing_keys'
              WHEN dq_orphan_household_id OR dq_orphan_submission_id THEN 'orphan_fk'
              WHEN dq_invalid_member_sex THEN 'invalid_canonical'
              WHEN dq_invalid_age_in_years THEN 'invalid_range'
              WHEN dq_blank_member_name THEN 'unknown_other'
              WHEN is_deleted THEN 'soft_deleted' ELSE 'other' END
  FROM mem_rej
  UNION ALL
  SELECT 'stg_kobo_water_point', CAST(record_loaded_at AS DATE),
         CASE WHEN dq_missing_blank_water_point_id OR dq_missing_blank_submission_id THEN 'missing_keys'
              WHEN dq_orphan_submission_id THEN 'orphan_fk'
              WHEN dq_missing_blank_source_type THEN 'invalid_canonical'
              WHEN dq_negative_distance_minutes THEN 'invalid_range'
              WHEN is_deleted THEN 'soft_deleted' ELSE 'other' END
  FROM wp_rej)
GROUP BY base_model_name, event_date, reason_bucket
""")
cte("mon_unknown", f"""
SELECT *, {ratio_sql('unknown_diarrhoea_count', 'member_count', 3)} AS unknown_rate
FROM (SELECT ward_id, event_date, CAST(sum(member_count) AS BIGINT) AS member_count,
             CAST(sum(total_diarrhoea_unknown_14d) AS BIGINT) AS unknown_diarrhoea_count
      FROM fact GROUP BY ward_id, event_date)
""")
cte("mon_late", """
SELECT ward_id, event_date, submissions_total, submissions_late,
       CASE WHEN submissions_total = 0 THEN 0.0
            ELSE CAST(submissions_late AS DOUBLE) / CAST(submissions_total AS DOUBLE) END AS late_arrival_rate
FROM (SELECT ward_id, CAST(submitted_at AS DATE) AS event_date, CAST(count(*) AS BIGINT) AS submissions_total,
             CAST(sum(CASE WHEN CAST(submitted_at AS DATE) < CAST(record_loaded_at AS DATE) THEN 1 ELSE 0 END)
                  AS BIGINT) AS submissions_late
      FROM sub_submitted WHERE submitted_at IS NOT NULL AND record_loaded_at IS NOT NULL
      GROUP BY 1, 2)
""")

oracle("mon_total_by_model_day", "SELECT * FROM mon_total")
oracle("mon_rejections_by_model_day", "SELECT * FROM mon_rej")
oracle("mon_rejection_rate_day", "SELECT * FROM mon_rate")
oracle("rejection_rate_join", "SELECT * FROM mon_rate")
oracle("mon_rejection_by_reason_day", "SELECT * FROM mon_reason")
oracle("mon_unknown_diarrhoea_rate_ward_day", "SELECT * FROM mon_unknown")
oracle("mon_late_arrival_rate_ward_day", "SELECT * FROM mon_late")

warn_s, err_s = V.FRESHNESS_SOURCE_HOURS[0] * 3600, V.FRESHNESS_SOURCE_HOURS[1] * 3600
oracle("source_freshness", f"""
SELECT source_name, max_loaded_at, snapshotted_at, age_seconds,
       CASE WHEN age_seconds IS NULL THEN 'error' WHEN age_seconds > {err_s} THEN 'error'
            WHEN age_seconds > {warn_s} THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT source_name, max_loaded_at, TIMESTAMP '{SC.FRESHNESS_NOW}' AS snapshotted_at,
             CAST(date_diff('second', max_loaded_at, TIMESTAMP '{SC.FRESHNESS_NOW}') AS BIGINT) AS age_seconds
      FROM (SELECT 'raw_kobo_submission' AS source_name, max(_loaded_at) AS max_loaded_at FROM raw_submission
            UNION ALL SELECT 'raw_kobo_household', max(_loaded_at) FROM raw_household
            UNION ALL SELECT 'raw_kobo_member', max(_loaded_at) FROM raw_member
            UNION ALL SELECT 'raw_kobo_waterpoint', max(_loaded_at) FROM raw_water_point))
""")

# ----------------------------------------------------------- incremental ---
clone("_b1", ["hh_event", "mem_rollup", "safe_inputs", "fact", "ward_day"],
      f"_loaded_at < TIMESTAMP '{SC.CUTOFF_1}'")

oracle("incremental_append", f"""
SELECT * FROM raw_submission_b1
UNION ALL
SELECT * FROM raw_submission
WHERE _loaded_at > (SELECT coalesce(max(_loaded_at), {BASE}) FROM raw_submission_b1)
""")
if "raw_water_point_b1" not in CTES:
    clone("_b1", ["raw_water_point"], f"_loaded_at < TIMESTAMP '{SC.CUTOFF_1}'")


def _appended(raw: str, table: str, keys: dict[str, str]) -> str:
    cols = ", ".join(f"{c} AS {n}" for n, c in keys.items())
    return f"""SELECT '{table}' AS table_name, submission_id, {cols}, _loaded_at FROM (
SELECT * FROM {raw}_b1 UNION ALL
SELECT * FROM {raw} WHERE _loaded_at > (SELECT coalesce(max(_loaded_at), {BASE}) FROM {raw}_b1))"""


_NONE = {"household_id": "CAST(NULL AS VARCHAR)", "member_index": "CAST(NULL AS BIGINT)", "water_point_id": "CAST(NULL AS VARCHAR)"}
oracle("incremental_append_all", "\nUNION ALL\n".join(
    _appended(raw, name, _NONE | {c: c for c in own}) for raw, name, own in (
        ("raw_submission", RAW_NAMES[0], ()), ("raw_household", RAW_NAMES[1], ("household_id",)),
        ("raw_member", RAW_NAMES[2], ("household_id", "member_index")), ("raw_water_point", RAW_NAMES[3], ("water_point_id",)))))
oracle("scan_ref", "SELECT * FROM hh_event")
oracle("incremental_load_window", """
SELECT * FROM hh_event
WHERE record_loaded_at >= (SELECT coalesce(max(record_loaded_at), %s) FROM hh_event_b1) - INTERVAL 7 DAY
""" % BASE)
oracle("incremental_event_window", f"SELECT * FROM fact WHERE event_date >= DATE '{EVENT_FROM}'")

cte("impacted_keys", f"""
SELECT DISTINCT household_id, submission_id FROM mem_acc
WHERE record_loaded_at >= (SELECT coalesce(max(record_loaded_at), {BASE}) FROM mem_rollup_b1) - INTERVAL 7 DAY
""")
cte("impacted_members", """
SELECT m.* FROM mem_acc m
WHERE EXISTS (SELECT 1 FROM impacted_keys k WHERE k.household_id = m.household_id
              AND k.submission_id = m.submission_id)
""")
cte("impacted_grouped", ROLLUP_SELECT.format(src="impacted_members"))
cte("impacted_rollup", ROLLUP_FLAGS.format(src="impacted_grouped"))
oracle("impacted_keys_join", "SELECT * FROM impacted_rollup")
oracle("distinct_keys", "SELECT DISTINCT household_id, submission_id FROM mem_acc")
oracle("scalar_max", "SELECT max(record_loaded_at) AS max_record_loaded_at FROM hh_event")


def _upsert(target: str, source: str, keys) -> str:
    cond = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return f"SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {cond})\n" \
           f"UNION ALL BY NAME\nSELECT * FROM {source}"


KEYS = ("household_id", "submission_id")
cte("ev_src2", f"""
SELECT * FROM hh_event
WHERE record_loaded_at >= (SELECT coalesce(max(record_loaded_at), {BASE}) FROM hh_event_b1) - INTERVAL 7 DAY
""")
cte("ev_final", _upsert("hh_event_b1", "ev_src2", KEYS))
cte("ro_final", _upsert("mem_rollup_b1", "impacted_rollup", KEYS))
cte("si_src2", f"""
SELECT * FROM (
  SELECT he.household_id, he.submission_id, he.submitted_at, he.ward_id, he.hh_size_reported,
         he.water_filter_type, he.primary_water_source, he.record_loaded_at, he.has_toilet,
         r.member_count, r.total_diarrhoea_case_count_14d, r.total_unknown_diarrhoea_count_14d,
         r.total_no_diarrhoea_count_14d, r.has_no_diarrhoea_14d_members
  FROM ev_final he JOIN ro_final r ON he.household_id = r.household_id AND he.submission_id = r.submission_id)
WHERE record_loaded_at >= (SELECT coalesce(max(record_loaded_at), {BASE}) FROM safe_inputs_b1) - INTERVAL 7 DAY
""")
cte("si_final", _upsert("safe_inputs_b1", "si_src2", KEYS))
cte("fact_src2", f"SELECT * FROM ({fact_select('si_final')}) WHERE event_date >= DATE '{EVENT_FROM}'")
cte("fact_final", _upsert("fact_b1", "fact_src2", KEYS))
cte("wd_src2", f"SELECT * FROM ({WARD_DAY_SELECT.format(src='fact_final')}) WHERE event_date >= DATE '{EVENT_FROM}'")
cte("wd_final", _upsert("ward_day_b1", "wd_src2", ("ward_id", "event_date")))

oracle("merge_upsert", "SELECT * FROM ev_final")
oracle("impacted_group_recompute", "SELECT * FROM ro_final")
oracle("merge_upsert_ward_day", "SELECT * FROM wd_final")

cte("wd_sync_src", f"""
SELECT *, household_events_total - household_events_safe AS household_events_unsafe
FROM ward_day WHERE event_date >= DATE '{EVENT_FROM}'
""")
oracle("schema_sync", """
SELECT t.*, CAST(NULL AS BIGINT) AS household_events_unsafe FROM ward_day_b1 t
WHERE NOT EXISTS (SELECT 1 FROM wd_sync_src s WHERE s.ward_id = t.ward_id AND s.event_date = t.event_date)
UNION ALL BY NAME
SELECT * FROM wd_sync_src
""")
cte("fact_backfill", f"SELECT * FROM fact WHERE event_date BETWEEN DATE '{SC.BACKFILL_START}' "
                     f"AND DATE '{SC.BACKFILL_END}'")
oracle("backfill_range", _upsert("fact_b1", "fact_backfill", KEYS))
oracle("full_rebuild", "SELECT * FROM ward_day")

# ------------------------------------------------------------------ scd2 ---
CHECK = ("ward_id", "district", "municipality", "hh_size_reported", "has_toilet", "water_filter_type",
         "primary_water_source")
CUR_COLS = ("household_id, ward_id, district, municipality, hh_size_reported, has_toilet, water_filter_type, "
            "primary_water_source, submission_id")
_CUR = """
SELECT household_id, ward_id, district, municipality, hh_size_reported, has_toilet, water_filter_type,
       primary_water_source, submission_id, record_loaded_at
FROM {src}
QUALIFY row_number() OVER (PARTITION BY household_id ORDER BY record_loaded_at DESC NULLS FIRST,
                           submitted_at DESC NULLS FIRST, submission_id DESC NULLS FIRST) = 1
"""
cte("cur_src", _CUR.format(src="hh_event"))
cte("cur_src_b1", _CUR.format(src="hh_event_b1"))
T1, T2 = f"TIMESTAMP '{SC.SNAPSHOT_1}'", f"TIMESTAMP '{SC.SNAPSHOT_2}'"
cte("snap1", f"SELECT {CUR_COLS}, {T1} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to, "
             f"{T1} AS dbt_updated_at FROM cur_src_b1")
_same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM s.{c}" for c in CHECK)
_o = ", ".join(f"o.{c}" for c in CUR_COLS.split(", "))
_s = ", ".join(f"s.{c}" for c in CUR_COLS.split(", "))
cte("snap2", f"""
SELECT {_o}, o.dbt_valid_from,
       CASE WHEN s.household_id IS NULL THEN {T2} WHEN NOT ({_same}) THEN {T2} ELSE o.dbt_valid_to END
         AS dbt_valid_to,
       CASE WHEN s.household_id IS NULL OR NOT ({_same}) THEN {T2} ELSE o.dbt_updated_at END AS dbt_updated_at
FROM snap1 o LEFT JOIN cur_src s ON o.household_id = s.household_id
UNION ALL
SELECT {_s}, {T2} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to, {T2} AS dbt_updated_at
FROM cur_src s LEFT JOIN snap1 o ON o.household_id = s.household_id
WHERE o.household_id IS NULL OR NOT ({_same})
""")
HIST = (f"{CUR_COLS}, dbt_valid_to, dbt_valid_from")
cte("enriched", """
SELECT f.household_id, f.submission_id, f.submitted_at, f.event_date, f.total_diarrhoea_yes_14d,
       f.total_diarrhoea_no_14d, f.total_diarrhoea_unknown_14d, f.has_no_diarrhoea_14d_members,
       f.has_safe_primary_source, f.has_safe_water_filter, f.is_safe_drinking,
       s.ward_id, s.district, s.municipality, s.hh_size_reported, s.has_toilet, s.water_filter_type,
       s.primary_water_source, s.dbt_valid_from, s.dbt_valid_to
FROM fact f LEFT JOIN snap2 s
  ON f.household_id = s.household_id AND f.submitted_at >= s.dbt_valid_from
 AND f.submitted_at < coalesce(s.dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00')
""")
cte("snap_lag", """
SELECT household_id, dbt_valid_from, dbt_valid_to,
       lag(dbt_valid_to) OVER (PARTITION BY household_id ORDER BY dbt_valid_from ASC NULLS FIRST) AS prev_valid_to
FROM (SELECT household_id, dbt_valid_from,
             coalesce(dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00') AS dbt_valid_to FROM snap2)
""")
oracle("scd2_snapshot", "SELECT * FROM snap2")
oracle("scd2_history", f"SELECT {HIST} FROM snap2")
oracle("scd2_current", f"SELECT {HIST} FROM snap2 WHERE dbt_valid_to IS NULL")
oracle("asof_scd2_join", "SELECT * FROM enriched")
oracle("lag", "SELECT * FROM snap_lag")
oracle("singular_one_current_row", """
SELECT household_id, CAST(count(*) AS BIGINT) AS current_rows FROM snap2 WHERE dbt_valid_to IS NULL
GROUP BY household_id HAVING count(*) > 1
""")
oracle("singular_no_overlapping_windows",
       "SELECT * FROM snap_lag WHERE prev_valid_to IS NOT NULL AND dbt_valid_from < prev_valid_to")
oracle("singular_valid_range", """
SELECT household_id, dbt_valid_from, dbt_valid_to FROM snap2
WHERE dbt_valid_to IS NOT NULL AND dbt_valid_to <= dbt_valid_from
""")
# planted violations: a second open version, a version inside another one, and one that ends before it starts
cte("snap_planted", f"""
SELECT * FROM snap2
UNION ALL BY NAME
SELECT * REPLACE (dbt_valid_from + INTERVAL 1 HOUR AS dbt_valid_from) FROM snap2
WHERE dbt_valid_to IS NULL AND CAST(household_id AS BIGINT) % 7 = 0
UNION ALL BY NAME
SELECT * REPLACE (dbt_valid_from - INTERVAL 1 DAY AS dbt_valid_to) FROM snap2
WHERE dbt_valid_to IS NULL AND CAST(household_id AS BIGINT) % 11 = 0
""")
oracle("singular_one_current_row_planted", """
SELECT household_id, CAST(count(*) AS BIGINT) AS current_rows FROM snap_planted WHERE dbt_valid_to IS NULL
GROUP BY household_id HAVING count(*) > 1
""")
oracle("singular_no_overlapping_windows_planted", """
SELECT * FROM (
  SELECT household_id, dbt_valid_from, dbt_valid_to,
         lag(dbt_valid_to) OVER (PARTITION BY household_id ORDER BY dbt_valid_from ASC NULLS FIRST,
                                 dbt_valid_to ASC NULLS FIRST) AS prev_valid_to
  FROM (SELECT household_id, dbt_valid_from,
               coalesce(dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00') AS dbt_valid_to FROM snap_planted))
WHERE prev_valid_to IS NOT NULL AND dbt_valid_from < prev_valid_to
""")
oracle("singular_valid_range_planted", """
SELECT household_id, dbt_valid_from, dbt_valid_to FROM snap_planted
WHERE dbt_valid_to IS NOT NULL AND dbt_valid_to <= dbt_valid_from
""")
oracle("having_count", """
SELECT household_id, CAST(count(*) AS BIGINT) AS n_events FROM hh_event GROUP BY household_id HAVING count(*) > 1
""")

# ---------------------------------------------------------- expectations ---
from .plans.checks import declared_checks  # noqa: E402

TABLE_SQL = {
    "raw_kobo_submission": "raw_submission", "raw_kobo_household": "raw_household",
    "raw_kobo_member": "raw_member", "raw_kobo_waterpoint": "raw_water_point",
    "stg_kobo_submission": "sub_acc", "stg_kobo_household": "hh_acc", "stg_kobo_member": "mem_acc",
    "stg_kobo_water_point": "wp_acc", "int_household_event": "hh_event", "int_submission_submitted": "sub_submitted",
    "int_household_member_health_rollup": "mem_rollup", "int_household_safe_inputs": "safe_inputs",
    "int_household_current_source": "cur_src", "snap_dim_household": "snap2",
    "dim_household_history": f"(SELECT {HIST} FROM snap2)",
    "dim_household_current": f"(SELECT {HIST} FROM snap2 WHERE dbt_valid_to IS NULL)",
    "fact_household_wash_event": "fact", "fact_agg_safe_drinking_ward_day": "ward_day",
    "fact_household_wash_event_enriched_scd2": "enriched",
    "mon_total_by_model_day": "mon_total", "mon_rejections_by_model_day": "mon_rej",
    "mon_rejection_rate_day": "mon_rate", "mon_rejection_by_reason_day": "mon_reason",
    "mon_unknown_diarrhoea_rate_ward_day": "mon_unknown", "mon_late_arrival_rate_ward_day": "mon_late",
}
# corrupt documents have no payload; they are no part of the flattened table
TABLE_SQL["landing"] = ("(SELECT 'doc' AS payload, file_name, ingested_at FROM docs UNION ALL "
                        "SELECT NULL, file_name, ingested_at FROM docs WHERE o_orderkey % 211 = 0)")
TABLE_SQL["ext_kobo_source_flattened"] = "ext_rows"
SINGULAR_SQL = {
    "one_current_row_per_household":
        "SELECT household_id FROM snap2 WHERE dbt_valid_to IS NULL GROUP BY household_id HAVING count(*) > 1",
    "snapshot_no_overlapping_windows":
        "SELECT * FROM snap_lag WHERE prev_valid_to IS NOT NULL AND dbt_valid_from < prev_valid_to",
    "snapshot_valid_from_valid_to_range_valid":
        "SELECT * FROM snap2 WHERE dbt_valid_to IS NOT NULL AND dbt_valid_to <= dbt_valid_from",
}


def _failing_sql(c) -> str:
    t = TABLE_SQL.get(c.table)
    a = c.args
    w = f"({c.where})" if c.where else "TRUE"
    if c.kind == "not_null":
        return f"SELECT * FROM {t} WHERE {w} AND {a['column']} IS NULL"
    if c.kind == "unique":
        col = a["column"]
        return f"SELECT {col} FROM {t} WHERE {w} AND {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1"
    if c.kind == "unique_combination":
        cols = ", ".join(a["columns"])
        return f"SELECT {cols} FROM {t} WHERE {w} GROUP BY {cols} HAVING count(*) > 1"
    if c.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in a["values"])
        return (f"SELECT * FROM (SELECT {a['column']} AS value_field FROM {t} WHERE {w} GROUP BY 1) "
                f"WHERE value_field NOT IN ({vals})")
    if c.kind == "relationship":
        p = TABLE_SQL[a["to"]]
        return (f"SELECT * FROM {t} c WHERE {w} AND c.{a['column']} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {p} p WHERE p.{a['field']} = c.{a['column']})")
    if c.kind == "expression":
        return f"SELECT * FROM {t} WHERE {w} AND NOT ({a['expression']})"
    if c.kind == "custom":
        return SINGULAR_SQL[c.name]
    raise ValueError(c.kind)


def _cond(cond: str) -> str:
    op, _, v = cond.strip().partition(" ")
    return f"failures {'<>' if op == '!=' else op} {int(v)}"


def _report_sql(kind) -> str:
    parts = []
    for c in declared_checks():
        if kind is not None and c.kind != kind:
            continue
        err = _cond(c.error_if) if c.severity == "error" else "FALSE"
        parts.append(
            f"SELECT '{c.name}' AS check_name, '{c.table}' AS table_name, '{c.kind}' AS kind, "
            f"'{c.severity}' AS severity, failures, "
            f"CASE WHEN {err} THEN 'error' WHEN {_cond(c.warn_if)} THEN 'warn' ELSE 'pass' END AS status "
            f"FROM (SELECT CAST(count(*) AS BIGINT) AS failures FROM ({_failing_sql(c)}))")
    return "\nUNION ALL\n".join(parts)


oracle("store_failures", "SELECT * FROM hh_acc WHERE NOT (hh_size_reported > 0 and hh_size_reported < 15)")

# --------------------------------------------------------------- landing ---
cte("docs", """
SELECT oc.*, li.l_orderkey, li.l_partkey, li.l_suppkey, li.l_linenumber, li.l_quantity, li.l_discount,
       li.l_returnflag, li.l_linestatus, li.s_nationkey,
       concat_ws(':', CAST(oc.o_orderkey AS VARCHAR), coalesce(CAST(li.l_linenumber AS VARCHAR), '-'),
                 coalesce(CAST(li.l_partkey AS VARCHAR), '-'), coalesce(CAST(li.l_suppkey AS VARCHAR), '-'))
         AS doc_key,
       'raw/' || strftime(oc.a_loaded_at, '%Y/%m/%d') || '/wash_submissions_' || CAST(oc.o_orderkey % 7 AS VARCHAR)
         || '.json' AS file_name,
       oc.a_loaded_at + INTERVAL 1 HOUR AS ingested_at
FROM order_ctx oc
LEFT JOIN (SELECT l.*, s.s_nationkey FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey) li
  ON oc.o_orderkey = li.l_orderkey
""")
oracle("scan_landing", """
SELECT file_name, ingested_at, 1 AS n_submissions FROM docs
UNION ALL
SELECT file_name, ingested_at, CAST(NULL AS INTEGER) FROM docs WHERE o_orderkey % 211 = 0
""")
oracle("landing_corrupt", "SELECT doc_key, file_name, ingested_at FROM docs WHERE o_orderkey % 211 = 0")
cte("ext_rows", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS submission_id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS submitted_at,
       CASE WHEN o_orderstatus = 'P' THEN 'draft' WHEN o_orderstatus = 'F' THEN ' Submitted '
            ELSE 'submitted' END AS status,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS collected_at,
       CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE o_orderpriority END AS enumerator_id,
       'd' || CAST(o_custkey % 50 AS VARCHAR) AS device_id,
       g_ward AS ward_id, g_municipality AS municipality, g_district AS district,
       CASE WHEN o_orderkey % 83 = 0 THEN 123.456 WHEN o_orderkey % 79 = 0 THEN NULL ELSE 27.5 END::DOUBLE AS gps_lat,
       85.3::DOUBLE AS gps_lon, (o_orderkey % 13 <> 0) AS consent,
       CAST(o_custkey AS VARCHAR) AS household_id, g_ward AS household_ward_id, c_name AS household_head_name,
       lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS phone_last4,
       CAST(o_orderkey % 17 AS BIGINT) AS hh_size_reported,
       list_element({_list(FILTER_CYCLE)}, CAST(o_orderkey % {len(FILTER_CYCLE)} AS INTEGER) + 1) AS water_filter_type,
       list_element({_list(SOURCE_CYCLE)}, CAST(o_orderkey % {len(SOURCE_CYCLE)} AS INTEGER) + 1) AS primary_water_source,
       (c_acctbal > 0) AS has_toilet,
       a_batch_id AS _batch_id, a_is_deleted AS _is_deleted,
       strftime(a_loaded_at, '%Y-%m-%dT%H:%M:%S') AS _loaded_at, a_source_file AS _source_file
FROM docs
""")
for _k in ("not_null", "unique", "unique_combination", "accepted_values", "relationship", "expression"):
    oracle(f"expect_{_k}", _report_sql(_k))
oracle("run_expectations", _report_sql(None))
oracle("store_failures_all", f"""
SELECT table_name, check_name, failures FROM ({_report_sql(None)}) WHERE kind IN ('not_null', 'expression') AND failures > 0
""")

oracle("explode_outer_submissions", "SELECT * FROM ext_rows")
oracle("landing_ingest", "SELECT * FROM ext_rows")
oracle("landing_ingest_corrupt", """
SELECT substr('{"batch_meta":{"batch_id":"' || a_batch_id || '","generated_at":"', 1, 40) AS payload_text
FROM docs WHERE o_orderkey % 211 = 0
""")
cte("lraw_submission", """
SELECT rs.* FROM docs d JOIN raw_submission rs ON rs.submission_id = CAST(d.o_orderkey AS VARCHAR)
""")
cte("lraw_household", """
SELECT rh.* FROM docs d JOIN raw_household rh ON rh.submission_id = CAST(d.o_orderkey AS VARCHAR)
""")
cte("lraw_member", """
SELECT CAST(o_custkey AS VARCHAR) AS household_id, CAST(o_orderkey AS VARCHAR) AS submission_id,
       CAST(l_linenumber AS BIGINT) AS member_index,
       CASE WHEN l_orderkey IS NULL THEN NULL ELSE 'm' || CAST(l_partkey AS VARCHAR) END AS member_name,
       CASE WHEN l_linestatus = 'O' THEN 'male' WHEN l_linestatus = 'F' THEN 'female' END AS sex,
       CAST(l_quantity AS BIGINT) + CASE WHEN l_partkey % 50 = 0 THEN 100 ELSE 0 END AS age_years,
       CASE WHEN l_returnflag = 'R' THEN TRUE WHEN l_returnflag = 'A' THEN FALSE END AS had_diarrhoea_14d,
       CASE WHEN l_orderkey IS NULL THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS fla_submission_id,
       CASE WHEN l_orderkey IS NULL THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS fla_household_id,
       a_loaded_at AS _loaded_at, a_batch_id AS _batch_id, a_source_file AS _source_file,
       a_is_deleted AS _is_deleted
FROM docs
""")
cte("lraw_water_point", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS submission_id, CAST(l_suppkey AS VARCHAR) AS water_point_id,
       CAST(s_nationkey AS BIGINT) AS ward_id,
       CASE WHEN l_orderkey IS NULL THEN NULL ELSE
         list_element({_list(POINT_TYPE_CYCLE)}, CAST(l_partkey % {len(POINT_TYPE_CYCLE)} AS INTEGER) + 1) END
         AS source_type,
       CASE WHEN l_orderkey IS NULL THEN NULL ELSE (l_returnflag <> 'R') END AS functional,
       CAST(round(l_discount * 100) AS BIGINT) - 1 AS distance_minutes,
       CAST(NULL AS DOUBLE) AS gps_lat, CAST(NULL AS DOUBLE) AS gps_lon,
       CASE WHEN l_orderkey IS NULL THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS fla_submission_id,
       a_loaded_at AS _loaded_at, a_batch_id AS _batch_id, a_source_file AS _source_file,
       a_is_deleted AS _is_deleted
FROM docs
""")
oracle("json_path_cast", "SELECT * FROM lraw_submission")
oracle("raw_household_model", "SELECT * FROM lraw_household")
oracle("audit_columns",
       "SELECT household_id, submission_id, _loaded_at, _batch_id, _source_file, _is_deleted FROM lraw_household")
oracle("explode_outer_members", "SELECT * FROM lraw_member")
oracle("nested_object_to_table", "SELECT * FROM lraw_water_point")
oracle("child_parent_keys", """
SELECT household_id, submission_id, member_index, fla_household_id, fla_submission_id FROM lraw_member
WHERE household_id IS DISTINCT FROM fla_household_id OR submission_id IS DISTINCT FROM fla_submission_id
""")
clone("_l", ["ward_day", "sub_dedup"], replace={
    "raw_submission": "lraw_submission", "raw_household": "lraw_household",
    "raw_member": "lraw_member", "raw_water_point": "lraw_water_point"})
# Rounds of visits: one document per order, with 0 to 3 submissions of 0 to 3 members.
cte("v_docs", """
SELECT o_orderkey AS k, o_orderkey % 4 AS n, o.*,
       'rounds/' || strftime(o_orderdate, '%Y/%m/%d') || '/' || CAST(o_orderkey % 7 AS VARCHAR) || '.json' AS v_file,
       o_orderdate + INTERVAL 8 DAY AS v_ingested
FROM order_ctx o
""")
oracle("scan_landing_rounds", """
SELECT v_file AS file_name, v_ingested AS ingested_at,
       CASE WHEN k % 8 = 0 THEN NULL ELSE CAST(n AS INTEGER) END AS n_submissions FROM v_docs
UNION ALL
SELECT v_file, v_ingested, NULL FROM v_docs WHERE k % 211 = 0
""")
cte("v_sub", """
SELECT d.*, v.i, CAST(k AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS sid,
       CASE WHEN i IS NOT NULL THEN CAST(o_custkey AS VARCHAR) END AS hid,
       CAST((k // 4 + i) % 4 AS BIGINT) AS n_members,
       o_orderdate + to_days(CAST(i AS INTEGER)) AS visited, o_orderdate + to_days(CAST(i + 4 AS INTEGER)) AS v_loaded,
       CASE WHEN i IS NOT NULL THEN 'round_' || CAST(k % 10 AS VARCHAR) END AS v_batch,
       CASE WHEN i IS NOT NULL THEN 'f' || CAST(k % 7 AS VARCHAR) END AS v_source, (k + i) % 101 = 0 AS v_deleted,
       CASE WHEN i IS NOT NULL THEN g_ward END AS v_ward
FROM v_docs d LEFT JOIN (SELECT unnest([1, 2, 3]) AS i) v ON v.i <= d.n
""")
cte("v_raw_submission", f"""
SELECT sid AS submission_id, CASE WHEN i IS NULL THEN NULL WHEN (k + i) % 9 = 0 THEN 'draft' ELSE 'submitted' END AS status,
       '{V.FORM_ID}' AS form_id, CAST({V.FORM_VERSION} AS BIGINT) AS form_version,
       visited AS submitted_at, visited AS collected_at,
       CASE WHEN i IS NOT NULL THEN o_orderpriority END AS enumerator_id,
       CASE WHEN i IS NOT NULL THEN 'd' || CAST(o_custkey % 50 AS VARCHAR) END AS device_id, v_ward AS ward_id,
       CASE WHEN i IS NOT NULL THEN g_municipality END AS municipality,
       CASE WHEN i IS NOT NULL THEN g_district END AS district,
       CASE WHEN i IS NOT NULL THEN 27.5::DOUBLE END AS gps_lat, CASE WHEN i IS NOT NULL THEN 85.3::DOUBLE END AS gps_lon,
       CASE WHEN i IS NOT NULL THEN TRUE END AS consent,
       v_loaded AS _loaded_at, v_batch AS _batch_id, v_source AS _source_file, v_deleted AS _is_deleted
FROM v_sub
""")
cte("v_raw_household", f"""
SELECT hid AS household_id, sid AS submission_id, v_ward AS ward_id,
       CASE WHEN i IS NOT NULL THEN c_name END AS household_head_name,
       CASE WHEN i IS NOT NULL THEN lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS phone_last4,
       n_members AS hh_size_reported,
       list_element({_list(FILTER_CYCLE)}, CAST((k + i) % {len(FILTER_CYCLE)} AS INTEGER) + 1) AS water_filter_type,
       list_element({_list(SOURCE_CYCLE)}, CAST((k + i) % {len(SOURCE_CYCLE)} AS INTEGER) + 1) AS primary_water_source,
       CASE WHEN i IS NOT NULL THEN c_acctbal > 0 END AS has_toilet,
       v_loaded AS _loaded_at, v_batch AS _batch_id, v_source AS _source_file, v_deleted AS _is_deleted
FROM v_sub
""")
cte("v_raw_member", """
SELECT hid AS household_id, sid AS submission_id, CAST(j AS BIGINT) AS member_index,
       'v' || CAST(k AS VARCHAR) || '-' || CAST(j AS VARCHAR) AS member_name,
       CASE WHEN j IS NULL THEN NULL WHEN (k + i + j) % 2 = 0 THEN 'female' ELSE 'male' END AS sex,
       CAST((k * i + j * 7) % 125 AS BIGINT) AS age_years,
       CASE WHEN (k + i + j) % 5 <> 0 THEN (k + i + j) % 7 = 0 END AS had_diarrhoea_14d,
       CASE WHEN (k + i + j) % 13 <> 0 THEN sid END AS fla_submission_id,
       CASE WHEN j IS NOT NULL THEN CAST(o_custkey + CASE WHEN (k + i + j) % 11 = 0 THEN 1 ELSE 0 END AS VARCHAR) END
         AS fla_household_id,
       v_loaded AS _loaded_at, v_batch AS _batch_id, v_source AS _source_file, v_deleted AS _is_deleted
FROM v_sub s LEFT JOIN (SELECT unnest([1, 2, 3]) AS j) m ON m.j <= s.n_members
""")
cte("v_raw_water_point", f"""
SELECT sid AS submission_id, CASE WHEN i < 3 THEN 'w' || CAST((k + i) % 500 AS VARCHAR) END AS water_point_id,
       CASE WHEN i < 3 THEN g_ward END AS ward_id,
       CASE WHEN i < 3 THEN
         list_element({_list(POINT_TYPE_CYCLE)}, CAST((k + i) % {len(POINT_TYPE_CYCLE)} AS INTEGER) + 1) END AS source_type,
       CASE WHEN i < 3 THEN (k + i) % 5 <> 0 END AS functional,
       CASE WHEN i < 3 THEN CAST((k + i) % 45 AS BIGINT) END AS distance_minutes,
       CAST(NULL AS DOUBLE) AS gps_lat, CAST(NULL AS DOUBLE) AS gps_lon,
       CASE WHEN i < 3 THEN sid END AS fla_submission_id,
       v_loaded AS _loaded_at, v_batch AS _batch_id, v_source AS _source_file, v_deleted AS _is_deleted
FROM v_sub
""")
oracle("explode_rounds_submissions", """
SELECT s.submission_id, strftime(s.submitted_at, '%Y-%m-%dT%H:%M:%S') AS submitted_at, s.status,
       strftime(s.collected_at, '%Y-%m-%dT%H:%M:%S') AS collected_at, s.enumerator_id, s.device_id, s.ward_id,
       s.municipality, s.district, s.gps_lat, s.gps_lon, s.consent, h.household_id, h.ward_id AS household_ward_id,
       h.household_head_name, h.phone_last4, h.hh_size_reported, h.water_filter_type, h.primary_water_source, h.has_toilet,
       s._batch_id, s._is_deleted, strftime(s._loaded_at, '%Y-%m-%dT%H:%M:%S') AS _loaded_at, s._source_file
FROM (SELECT * FROM v_raw_submission WHERE submission_id IS NOT NULL) s
JOIN v_raw_household h ON h.submission_id = s.submission_id
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       NULL, NULL, NULL, NULL FROM v_docs WHERE n = 0
""")
oracle("explode_rounds_members", "SELECT * FROM v_raw_member")
oracle("nested_object_rounds", "SELECT * FROM v_raw_water_point")
oracle("child_parent_mismatch", """
SELECT * FROM (
  SELECT household_id, submission_id, member_index, fla_household_id, fla_submission_id,
         coalesce(fla_household_id <> household_id, FALSE) AS household_id_differs,
         coalesce(fla_submission_id <> submission_id, FALSE) AS submission_id_differs,
         fla_household_id IS NULL AS household_id_missing, fla_submission_id IS NULL AS submission_id_missing
  FROM v_raw_member WHERE member_index IS NOT NULL)
WHERE household_id_differs OR submission_id_differs OR household_id_missing OR submission_id_missing
""")
clone("_v", ["ward_day"], replace={
    "raw_submission": "v_raw_submission", "raw_household": "v_raw_household",
    "raw_member": "v_raw_member", "raw_water_point": "v_raw_water_point"})
oracle("landing_to_ward_day", "SELECT * FROM ward_day_v")
oracle("stream_increment", "SELECT * FROM ward_day_l")
oracle("stream_dedupe", "SELECT * FROM sub_dedup_l")
oracle("stream_ward_kpi", "SELECT * FROM ward_day")
oracle("late_data_window", """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type,
       CAST(count(*) AS BIGINT) AS n_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2, 3
""")

# --------------------------------------------------------------- scalars ---
oracle("try_cast", """
SELECT TRY_CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS submission_key,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority_rank,
       TRY_CAST(o_orderpriority AS BIGINT) AS priority_as_number,
       o_orderkey + 1 AS half_up, -(o_orderkey + 1) AS half_down, o_orderkey AS below_half,
       CAST(NULL AS BIGINT) AS over_range,
       CASE o_orderkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE END AS flag_text,
       TRY_CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS iso_time,
       TRY_CAST(strftime(o_orderdate, '%d-%m-%Y') || ' 10:00' AS TIMESTAMP) AS day_first_time
FROM orders
""")
oracle("text_scalars", """
SELECT c_custkey, lower(trim('  ' || c_mktsegment || ' ')) AS segment,
       'stg_' || lower(c_mktsegment) || '__base' AS model_name,
       split_part('stg_' || lower(c_mktsegment) || '__base', '__', 1) AS base_model_name,
       coalesce(nullif(c_mktsegment, 'BUILDING'), 'unknown') AS segment_or_unknown
FROM customer
""")
oracle("date_scalars", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 30 DAY AS DATE) AS lookback_from,
       o_orderdate + to_days(CAST(o_orderkey % 10 AS INTEGER)) AS loaded_at,
       (CAST(o_orderdate AS DATE) < CAST(o_orderdate + to_days(CAST(o_orderkey % 10 AS INTEGER)) AS DATE)) AS is_late
FROM orders
""")
oracle("pii_projection_member", "SELECT * EXCLUDE (member_name) FROM mem_acc")
oracle("pii_projection", "SELECT * EXCLUDE (household_head_name, phone_last4) FROM hh_acc")
oracle("union_all", """
SELECT 'submission' AS entity, submission_id FROM sub_acc
UNION ALL SELECT 'household', submission_id FROM hh_acc
UNION ALL SELECT 'member', submission_id FROM mem_acc
UNION ALL SELECT 'water_point', submission_id FROM wp_acc
""")

# --------------------------------------------------------- small models ---
oracle("constant_column", "SELECT submission_id, form_id, form_version FROM raw_submission")
oracle("not_null_times", """
SELECT ward_id, CAST(submitted_at AS DATE) AS event_date, submitted_at, record_loaded_at FROM sub_submitted
WHERE submitted_at IS NOT NULL AND record_loaded_at IS NOT NULL
""")
_lw, _le = V.FRESHNESS_LANDING_HOURS[0] * 3600, V.FRESHNESS_LANDING_HOURS[1] * 3600
oracle("landing_freshness", f"""
SELECT source_name, max_loaded_at, snapshotted_at, age_seconds,
       CASE WHEN age_seconds IS NULL THEN 'error' WHEN age_seconds > {_le} THEN 'error'
            WHEN age_seconds > {_lw} THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT 'landing' AS source_name, max_loaded_at, TIMESTAMP '{SC.FRESHNESS_NOW}' AS snapshotted_at,
             CAST(date_diff('second', max_loaded_at, TIMESTAMP '{SC.FRESHNESS_NOW}') AS BIGINT) AS age_seconds
      FROM (SELECT max(ingested_at) AS max_loaded_at FROM docs))
""")
