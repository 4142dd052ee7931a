"""Independent SQL statements of every registered query, for the DuckDB oracle.

Each query is a chain of named CTEs over the driver's tables (``orders``,
``lineitem`` ...). ``render(final, *ctes)`` pulls in the CTEs a statement
needs, dependencies first. The SQL is written from the rules directly, not
generated from the Spark code, so the two implementations check each other.
"""

from __future__ import annotations

import re

from .functions import valuesets as V
from .sources.bindings import FILTER_CYCLE, POINT_TYPE_CYCLE, SOURCE_CYCLE


def _list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def _deps(body: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", body))
    return [n for n in CTES if n in words]


def render(final: str, *extra: str) -> str:
    order: list[str] = []

    def visit(n: str, stack=()):
        if n in order:
            return
        for d in _deps(CTES[n]):
            if d != n and d not in stack:
                visit(d, stack + (n,))
        order.append(n)

    for n in [d for d in _deps(final)] + list(extra):
        visit(n)
    if not order:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order) + "\n" + final.strip()


# ---------------------------------------------------------------- binding --
cte("geo", """
SELECT CAST(n_nationkey AS BIGINT) AS g_ward, n_name AS g_municipality, r_name AS g_district
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""")

cte("order_ctx", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority,
       c.c_name, c.c_nationkey, c.c_acctbal, g.g_ward, g.g_municipality, g.g_district,
       o.o_orderdate + to_days(CAST(o.o_orderkey % 10 AS INTEGER)) AS a_loaded_at,
       'batch_' || CAST(o.o_orderkey % 10 AS VARCHAR) AS a_batch_id,
       'f' || CAST(o.o_orderkey % 7 AS VARCHAR) AS a_source_file,
       (o.o_orderkey % 101 = 0) AS a_is_deleted
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN geo g ON CAST(c.c_nationkey AS BIGINT) = g.g_ward
""")

cte("raw_submission", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS submission_id,
       CASE WHEN o_orderstatus = 'P' THEN 'draft' WHEN o_orderstatus = 'F' THEN ' Submitted '
            ELSE 'submitted' END AS status,
       '{V.FORM_ID}' AS form_id, CAST({V.FORM_VERSION} AS BIGINT) AS form_version,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END AS submitted_at,
       o_orderdate AS collected_at,
       CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE o_orderpriority END AS enumerator_id,
       'd' || CAST(o_custkey % 50 AS VARCHAR) AS device_id,
       g_ward AS ward_id, g_municipality AS municipality, g_district AS district,
       CASE WHEN o_orderkey % 83 = 0 THEN 123.456 WHEN o_orderkey % 79 = 0 THEN NULL
            ELSE 27.5 END::DOUBLE AS gps_lat,
       85.3::DOUBLE AS gps_lon,
       (o_orderkey % 13 <> 0) AS consent,
       a_loaded_at AS _loaded_at, a_batch_id AS _batch_id, a_source_file AS _source_file,
       a_is_deleted AS _is_deleted
FROM order_ctx
""")

cte("raw_household", f"""
SELECT CAST(o_custkey AS VARCHAR) AS household_id, CAST(o_orderkey AS VARCHAR) AS submission_id,
       g_ward AS ward_id, c_name AS household_head_name,
       lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS phone_last4,
       CAST(o_orderkey % 17 AS BIGINT) AS hh_size_reported,
       list_element({_list(FILTER_CYCLE)}, CAST(o_orderkey % {len(FILTER_CYCLE)} AS INTEGER) + 1) AS water_filter_type,
       list_element({_list(SOURCE_CYCLE)}, CAST(o_orderkey % {len(SOURCE_CYCLE)} AS INTEGER) + 1) AS primary_water_source,
       (c_acctbal > 0) AS has_toilet,
       a_loaded_at AS _loaded_at, a_batch_id AS _batch_id, a_source_file AS _source_file,
       a_is_deleted AS _is_deleted
FROM order_ctx
""")

cte("raw_member", """
SELECT CAST(o.o_custkey AS VARCHAR) AS household_id, CAST(l.l_orderkey AS VARCHAR) AS submission_id,
       CAST(l.l_linenumber AS BIGINT) AS member_index,
       'm' || CAST(l.l_partkey AS VARCHAR) AS member_name,
       CASE WHEN l.l_linestatus = 'O' THEN 'male' WHEN l.l_linestatus = 'F' THEN 'female' END AS sex,
       CAST(l.l_quantity AS BIGINT) + CASE WHEN l.l_partkey % 50 = 0 THEN 100 ELSE 0 END AS age_years,
       CASE WHEN l.l_returnflag = 'R' THEN TRUE WHEN l.l_returnflag = 'A' THEN FALSE END AS had_diarrhoea_14d,
       CAST(l.l_orderkey AS VARCHAR) AS fla_submission_id,
       CAST(o.o_custkey AS VARCHAR) AS fla_household_id,
       l.l_shipdate AS _loaded_at,
       'batch_' || CAST(l.l_orderkey % 10 AS VARCHAR) AS _batch_id,
       'f' || CAST(l.l_orderkey % 7 AS VARCHAR) AS _source_file,
       (l.l_orderkey % 101 = 0) AS _is_deleted
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
""")

cte("raw_water_point", f"""
SELECT CAST(l.l_orderkey AS VARCHAR) AS submission_id,
       CASE WHEN l.l_partkey % 11 = 0 THEN ' ' || CAST(l.l_suppkey AS VARCHAR)
            ELSE CAST(l.l_suppkey AS VARCHAR) END AS water_point_id,
       CAST(s.s_nationkey AS BIGINT) AS ward_id,
       list_element({_list(POINT_TYPE_CYCLE)}, CAST(l.l_partkey % {len(POINT_TYPE_CYCLE)} AS INTEGER) + 1) AS source_type,
       (l.l_returnflag <> 'R') AS functional,
       CASE WHEN l.l_partkey % 61 = 0 THEN NULL
            ELSE CAST(round(l.l_discount * 100) AS BIGINT) - 1 END AS distance_minutes,
       27.5::DOUBLE AS gps_lat, 85.3::DOUBLE AS gps_lon,
       CAST(l.l_orderkey AS VARCHAR) AS fla_submission_id,
       l.l_shipdate AS _loaded_at,
       'batch_' || CAST(l.l_orderkey % 10 AS VARCHAR) AS _batch_id,
       'f' || CAST(l.l_orderkey % 7 AS VARCHAR) AS _source_file,
       (l.l_orderkey % 101 = 0) AS _is_deleted
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
""")

# ---------------------------------------------------------------- staging --
AUDIT_STD = """_loaded_at AS record_loaded_at, CAST(_batch_id AS VARCHAR) AS batch_id,
       CAST(_source_file AS VARCHAR) AS source_file,
       coalesce(TRY_CAST(_is_deleted AS BOOLEAN), FALSE) AS is_deleted"""

cte("sub_std", f"""
SELECT CAST(submission_id AS VARCHAR) AS submission_id, lower(trim(status)) AS status,
       submitted_at, collected_at, enumerator_id, device_id, CAST(ward_id AS BIGINT) AS ward_id,
       municipality, district, CAST(gps_lat AS DOUBLE) AS gps_lat, CAST(gps_lon AS DOUBLE) AS gps_lon,
       consent, {AUDIT_STD}
FROM raw_submission
""")

cte("sub_dedup", """
SELECT * FROM sub_std
QUALIFY row_number() OVER (PARTITION BY submission_id
                           ORDER BY record_loaded_at DESC NULLS FIRST, source_file DESC NULLS FIRST) = 1
""")

cte("sub_base", """
SELECT *,
       (submission_id IS NULL) AS dq_missing_submission_id,
       (municipality IS NULL OR trim(municipality) = '') AS dq_missing_blank_municipality,
       (district IS NULL OR trim(district) = '') AS dq_missing_blank_district,
       (status = 'submitted' AND submitted_at IS NULL) AS dq_submitted_missing_submitted_at,
       ((gps_lat IS NOT NULL AND gps_lat < -90) OR gps_lat > 90
         OR (gps_lon IS NOT NULL AND gps_lon < -180) OR gps_lon > 180) AS dq_invalid_gps,
       (enumerator_id IS NULL OR trim(enumerator_id) = '') AS dq_missing_blank_enumerator_id
FROM sub_dedup
""")

cte("sub_acc", """
SELECT * FROM sub_base
WHERE dq_missing_submission_id = FALSE AND status = 'submitted'
  AND dq_submitted_missing_submitted_at = FALSE AND dq_missing_blank_municipality = FALSE
  AND dq_missing_blank_district = FALSE AND dq_invalid_gps = FALSE AND is_deleted = FALSE
  AND dq_missing_blank_enumerator_id = FALSE
""")

cte("sub_rej", """
SELECT * FROM sub_base
WHERE dq_missing_submission_id = TRUE OR dq_submitted_missing_submitted_at = TRUE
   OR dq_missing_blank_municipality = TRUE OR dq_missing_blank_district = TRUE
   OR dq_invalid_gps = TRUE OR is_deleted = TRUE OR dq_missing_blank_enumerator_id = TRUE
""")

cte("sub_submitted", "SELECT * FROM sub_acc WHERE status = 'submitted'")

cte("hh_std", f"""
SELECT CAST(household_id AS VARCHAR) AS household_id, CAST(submission_id AS VARCHAR) AS submission_id,
       CAST(ward_id AS BIGINT) AS ward_id, CAST(hh_size_reported AS BIGINT) AS hh_size_reported,
       trim(household_head_name) AS household_head_name, phone_last4,
       lower(trim(water_filter_type)) AS water_filter_type,
       lower(trim(primary_water_source)) AS primary_water_source,
       has_toilet, {AUDIT_STD}
FROM raw_household
""")

cte("hh_dedup", """
SELECT * FROM hh_std
QUALIFY row_number() OVER (PARTITION BY household_id, submission_id
                           ORDER BY record_loaded_at DESC NULLS FIRST, source_file DESC NULLS FIRST) = 1
""")

cte("hh_base", f"""
SELECT h.*,
       (household_id IS NULL OR trim(household_id) = '') AS dq_missing_blank_household_id,
       (submission_id IS NULL OR trim(submission_id) = '') AS dq_missing_blank_submission_id,
       (submission_id IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM sub_acc s WHERE s.submission_id = h.submission_id)) AS dq_orphan_submission_id,
       (ward_id IS NULL) AS dq_missing_ward_id,
       (water_filter_type IS NULL OR trim(water_filter_type) = '') AS dq_missing_blank_water_filter_type,
       (primary_water_source IS NULL OR trim(primary_water_source) = '') AS dq_missing_blank_primary_water_source,
       (hh_size_reported IS NOT NULL AND (hh_size_reported < 0 OR hh_size_reported > 15)) AS dq_invalid_hh_size,
       (water_filter_type IS NOT NULL AND trim(water_filter_type) = ''
         AND (water_filter_type = 'unknown' OR water_filter_type = 'other')) AS dq_unknown_other_filter_type,
       (water_filter_type IS NOT NULL AND trim(water_filter_type) <> ''
         AND water_filter_type NOT IN {_in(V.WATER_FILTER_TYPES)}) AS dq_invalid_water_filter_type,
       (primary_water_source IS NOT NULL AND trim(primary_water_source) <> ''
         AND (primary_water_source = 'unknown' OR primary_water_source = 'other')) AS dq_unknown_other_primary_water_source,
       (primary_water_source IS NOT NULL AND trim(primary_water_source) <> ''
         AND primary_water_source NOT IN {_in(V.WATER_SOURCES)}) AS dq_invalid_primary_water_source
FROM hh_dedup h
""")

HH_FLAGS = ("is_deleted", "dq_missing_blank_household_id", "dq_missing_blank_submission_id",
            "dq_orphan_submission_id", "dq_missing_ward_id", "dq_missing_blank_water_filter_type",
            "dq_missing_blank_primary_water_source", "dq_invalid_hh_size", "dq_unknown_other_filter_type",
            "dq_invalid_water_filter_type", "dq_unknown_other_primary_water_source",
            "dq_invalid_primary_water_source")

cte("hh_acc", "SELECT * FROM hh_base WHERE " + " AND ".join(f"{f} = FALSE" for f in HH_FLAGS))
cte("hh_rej", "SELECT * FROM hh_base WHERE " + " OR ".join(f"{f} = TRUE" for f in HH_FLAGS))

cte("mem_std", f"""
SELECT CAST(household_id AS VARCHAR) AS household_id, CAST(submission_id AS VARCHAR) AS submission_id,
       CAST(member_index AS BIGINT) AS member_index, CAST(age_years AS BIGINT) AS member_age_in_years,
       trim(member_name) AS member_name, lower(trim(sex)) AS member_sex,
       CASE WHEN TRY_CAST(had_diarrhoea_14d AS BOOLEAN) = TRUE THEN 'yes'
            WHEN TRY_CAST(had_diarrhoea_14d AS BOOLEAN) = FALSE THEN 'no'
            ELSE 'unknown' END AS member_had_diarrhoea_14d,
       {AUDIT_STD}
FROM raw_member
""")

cte("mem_dedup", """
SELECT * FROM mem_std
QUALIFY row_number() OVER (PARTITION BY household_id, member_index
                           ORDER BY record_loaded_at DESC NULLS FIRST, source_file DESC NULLS FIRST,
                                    submission_id DESC NULLS FIRST, member_name DESC NULLS FIRST,
                                    member_sex DESC NULLS FIRST, member_age_in_years DESC NULLS FIRST,
                                    member_had_diarrhoea_14d DESC NULLS FIRST) = 1
""")

cte("mem_base", f"""
SELECT m.*,
       (household_id IS NULL) AS dq_missing_household_id,
       (submission_id IS NULL) AS dq_missing_submission_id,
       (member_index IS NULL) AS dq_missing_member_index,
       (member_sex IS NULL OR trim(member_sex) = '') AS dq_missing_blank_member_sex,
       (member_sex IS NOT NULL AND member_sex NOT IN {_in(V.MEMBER_SEXES)}) AS dq_invalid_member_sex,
       (trim(member_name) = '') AS dq_blank_member_name,
       (member_age_in_years < 0 OR member_age_in_years > 120) AS dq_invalid_age_in_years,
       (household_id IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM hh_acc h WHERE h.household_id = m.household_id)) AS dq_orphan_household_id,
       (submission_id IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM sub_acc s WHERE s.submission_id = m.submission_id)) AS dq_orphan_submission_id
FROM mem_dedup m
""")

MEM_FLAGS = ("dq_missing_household_id", "dq_missing_submission_id", "dq_missing_member_index",
             "dq_missing_blank_member_sex", "dq_invalid_member_sex", "dq_blank_member_name",
             "dq_invalid_age_in_years", "dq_orphan_household_id", "dq_orphan_submission_id")

cte("mem_acc", "SELECT * FROM mem_base WHERE " + " AND ".join(f"{f} = FALSE" for f in MEM_FLAGS))
cte("mem_rej", "SELECT * FROM mem_base WHERE " + " OR ".join(f"{f} = TRUE" for f in MEM_FLAGS))

cte("wp_std", f"""
SELECT trim(CAST(water_point_id AS VARCHAR)) AS water_point_id,
       trim(CAST(submission_id AS VARCHAR)) AS submission_id,
       CAST(ward_id AS BIGINT) AS ward_id,
       CAST(distance_minutes AS DECIMAL(10,2)) AS distance_minutes,
       CAST(gps_lat AS DOUBLE) AS gps_lat, CAST(gps_lon AS DOUBLE) AS gps_lon,
       lower(trim(source_type)) AS source_type,
       TRY_CAST(functional AS BOOLEAN) AS water_source_functional,
       {AUDIT_STD}
FROM raw_water_point
""")

cte("wp_dedup", """
SELECT * FROM wp_std
QUALIFY row_number() OVER (PARTITION BY water_point_id, submission_id
                           ORDER BY record_loaded_at DESC NULLS FIRST, source_file DESC NULLS FIRST,
                                    source_type DESC NULLS FIRST, distance_minutes DESC NULLS FIRST,
                                    water_source_functional DESC NULLS FIRST, ward_id DESC NULLS FIRST) = 1
""")

cte("wp_base", f"""
SELECT w.*,
       (water_point_id IS NULL OR trim(water_point_id) = '') AS dq_missing_blank_water_point_id,
       (submission_id IS NULL OR trim(submission_id) = '') AS dq_missing_blank_submission_id,
       (ward_id IS NULL) AS dq_missing_ward_id,
       (source_type IS NULL OR trim(source_type) = '') AS dq_missing_blank_source_type,
       (source_type IS NOT NULL AND source_type NOT IN {_in(V.WATER_SOURCES)}) AS dq_invalid_source_type,
       (distance_minutes IS NOT NULL AND distance_minutes < 0) AS dq_negative_distance_minutes,
       (submission_id IS NOT NULL AND submission_id <> '' AND NOT EXISTS (
            SELECT 1 FROM sub_acc s WHERE s.submission_id = w.submission_id)) AS dq_orphan_submission_id,
       (distance_minutes IS NULL) AS dq_missing_distance_minutes
FROM wp_dedup w
""")

WP_FLAGS = ("dq_missing_blank_water_point_id", "dq_missing_blank_submission_id", "dq_missing_ward_id",
            "dq_missing_blank_source_type", "dq_invalid_source_type", "dq_negative_distance_minutes",
            "dq_orphan_submission_id", "dq_missing_distance_minutes")

WP_ACC_COLS = ("water_point_id, submission_id, ward_id, CAST(distance_minutes AS DOUBLE) AS distance_minutes, "
               "source_type, water_source_functional, record_loaded_at, batch_id, source_file, "
               + ", ".join(WP_FLAGS))
WP_REJ_COLS = ("water_point_id, submission_id, ward_id, CAST(distance_minutes AS DOUBLE) AS distance_minutes, "
               "source_type, water_source_functional, record_loaded_at, batch_id, is_deleted, source_file, "
               + ", ".join(WP_FLAGS))

cte("wp_acc", f"SELECT {WP_ACC_COLS} FROM wp_base WHERE " + " AND ".join(f"{f} = FALSE" for f in WP_FLAGS))
cte("wp_rej", f"SELECT {WP_REJ_COLS} FROM wp_base WHERE " + " OR ".join(f"{f} = TRUE" for f in WP_FLAGS))

# ---------------------------------------------------------- integration ---
cte("hh_event", """
SELECT hh.household_id, ss.submission_id, ss.ward_id, ss.municipality, ss.district, ss.submitted_at,
       hh.hh_size_reported, hh.water_filter_type, hh.primary_water_source, hh.has_toilet,
       ss.record_loaded_at
FROM hh_acc hh JOIN sub_submitted ss ON hh.submission_id = ss.submission_id
""")

ROLLUP_SELECT = """
SELECT household_id, submission_id, max(record_loaded_at) AS record_loaded_at,
       CAST(count(DISTINCT member_index) AS BIGINT) AS member_count,
       CAST(sum(CAST(member_had_diarrhoea_14d = 'yes' AS INTEGER)) AS BIGINT) AS total_diarrhoea_case_count_14d,
       CAST(sum(CAST(member_had_diarrhoea_14d = 'no' AS INTEGER)) AS BIGINT) AS total_no_diarrhoea_count_14d,
       CAST(sum(CAST(member_had_diarrhoea_14d = 'unknown' AS INTEGER)) AS BIGINT) AS total_unknown_diarrhoea_count_14d
FROM {src}
GROUP BY household_id, submission_id
"""

ROLLUP_FLAGS = """
SELECT *, (member_count > 15) AS dq_invalid_member_count,
       (total_recorded_cases > member_count) AS dq_invalid_diarrhoea_case_count,
       (total_diarrhoea_case_count_14d = 0 AND total_unknown_diarrhoea_count_14d = 0
        AND (total_no_diarrhoea_count_14d > 0 AND total_no_diarrhoea_count_14d = member_count))
         AS has_no_diarrhoea_14d_members
FROM (SELECT *, total_diarrhoea_case_count_14d + total_no_diarrhoea_count_14d
                + total_unknown_diarrhoea_count_14d AS total_recorded_cases
      FROM {src})
"""

cte("rollup_grouped", ROLLUP_SELECT.format(src="mem_acc"))
cte("mem_rollup", ROLLUP_FLAGS.format(src="rollup_grouped"))

cte("safe_inputs", """
SELECT he.household_id, he.submission_id, he.submitted_at, he.ward_id, he.hh_size_reported,
       he.water_filter_type, he.primary_water_source, he.record_loaded_at, he.has_toilet,
       r.member_count, r.total_diarrhoea_case_count_14d, r.total_unknown_diarrhoea_count_14d,
       r.total_no_diarrhoea_count_14d, r.has_no_diarrhoea_14d_members
FROM hh_event he JOIN mem_rollup r ON he.household_id = r.household_id AND he.submission_id = r.submission_id
""")

FACT_SELECT = f"""
SELECT household_id, submission_id, ward_id, submitted_at, event_date, hh_size_reported, has_toilet,
       water_filter_type, primary_water_source, member_count, total_diarrhoea_yes_14d,
       total_diarrhoea_no_14d, total_diarrhoea_unknown_14d, has_no_diarrhoea_14d_members,
       has_safe_primary_source, has_safe_water_filter,
       (has_safe_primary_source = TRUE AND has_safe_water_filter = TRUE
        AND has_no_diarrhoea_14d_members = TRUE) AS is_safe_drinking
FROM (
  SELECT household_id, submission_id, ward_id, submitted_at, CAST(submitted_at AS DATE) AS event_date,
         hh_size_reported, has_toilet, water_filter_type, primary_water_source, member_count,
         total_diarrhoea_case_count_14d AS total_diarrhoea_yes_14d,
         total_no_diarrhoea_count_14d AS total_diarrhoea_no_14d,
         total_unknown_diarrhoea_count_14d AS total_diarrhoea_unknown_14d,
         has_no_diarrhoea_14d_members,
         (primary_water_source IN {{sources}}) AS has_safe_primary_source,
         (water_filter_type IN {{filters}}) AS has_safe_water_filter
  FROM {{src}})
WHERE member_count >= 1
"""


def fact_select(src: str, sources=V.SAFE_SOURCES_CODE, filters=V.SAFE_FILTERS_CODE) -> str:
    return FACT_SELECT.format(src=src, sources=_in(sources), filters=_in(filters))


cte("fact", fact_select("safe_inputs"))


def ratio_sql(n: str, d: str, scale: int | None) -> str:
    """div0 with exact half-away-from-zero rounding on integers."""
    if scale is None:
        body = f"CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE)"
    else:
        p = 10 ** scale
        body = f"CAST((CAST({n} AS BIGINT) * {2 * p} + {d}) // (2 * CAST({d} AS BIGINT)) AS DOUBLE) / {float(p)}"
    return f"CASE WHEN {n} IS NULL OR {d} IS NULL THEN NULL WHEN {d} = 0 THEN 0.0 ELSE {body} END"


WARD_DAY_SELECT = f"""
SELECT ward_id, event_date, household_events_total, household_events_safe,
       {ratio_sql('household_events_safe', 'household_events_total', 2)} AS pct_safe
FROM (SELECT ward_id, event_date, CAST(count(*) AS BIGINT) AS household_events_total,
             CAST(sum(CASE WHEN is_safe_drinking THEN 1 ELSE 0 END) AS BIGINT) AS household_events_safe
      FROM {{src}} GROUP BY ward_id, event_date)
"""

cte("ward_day", WARD_DAY_SELECT.format(src="fact"))


# --------------------------------------------------------------- variants --
def closure(names) -> list[str]:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in _deps(CTES[n]):
            if d != n:
                visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def clone(suffix: str, roots, raw_where: str | None = None, replace: dict | None = None) -> None:
    """Copy the CTE chain behind ``roots`` under ``name + suffix``, with
    every raw entity restricted by ``raw_where`` or replaced by another CTE."""
    names = closure(roots)
    raws = {"raw_submission", "raw_household", "raw_member", "raw_water_point"}
    for n in names:
        if n in raws:
            if replace:
                CTES[n + suffix] = f"SELECT * FROM {replace[n]}"
            else:
                CTES[n + suffix] = f"SELECT * FROM (\n{CTES[n]}\n) WHERE {raw_where}"
            continue
        body = CTES[n]
        for m in names:
            body = re.sub(rf"\b{m}\b", m + suffix, body)
        CTES[n + suffix] = body
