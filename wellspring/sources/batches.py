"""Landing documents with several submissions and members each.

One document per order: a round of visits to the customer's household. It holds
0 to 3 submissions, each with 0 to 3 members, by rules on the order's key (they
choose values and sizes; no order is dropped). An empty round is an empty
``submissions`` array or none at all, an empty roster an empty ``members`` array
or none. Members carry their own copies of the parent keys, and some of these
copies are wrong or missing. Arrays are made inside the row, so no group is
collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bindings import FILTER_CYCLE, GPS_LAT, GPS_LON, POINT_TYPE_CYCLE, SOURCE_CYCLE, order_context, pick
from .landing import ISO


def _mod(c: Column, m: int) -> Column:
    return F.pmod(c, F.lit(m))


def _text(c: Column) -> Column:
    return c.cast("string")


def _each(n: Column, build: Callable[[Column], Column]) -> Column:
    """array(build(1), .., build(n)); empty for n = 0."""
    return F.transform(F.slice(F.array(*map(F.lit, (1, 2, 3))), F.lit(1), n.cast("int")), build)


def _member(k: Column, i: Column, j: Column, submission_id: Column) -> Column:
    at = k + i + j
    wrong = F.col("o_custkey") + F.when(_mod(at, 11) == 0, 1).otherwise(0)
    return F.struct(
        _text(wrong).alias("household_id"),
        F.when(_mod(at, 13) != 0, submission_id).alias("submission_id"),
        j.cast("long").alias("member_index"),
        F.concat(F.lit("v"), _text(k), F.lit("-"), _text(j)).alias("member_name"),
        F.when(_mod(at, 2) == 0, "female").otherwise("male").alias("sex"),
        _mod(k * i + j * 7, 125).alias("age_years"),
        F.when(_mod(at, 5) != 0, _mod(at, 7) == 0).alias("had_diarrhoea_14d"),
    )


def _submission(k: Column, i: Column) -> Column:
    at, n_members = k + i, _mod(F.floor(k / 4) + i, 4)
    submission_id = F.concat_ws("-", _text(k), _text(i))
    visited = F.date_format(F.timestamp_add("DAY", i, F.col("o_orderdate")), ISO)
    no_roster = (n_members == 0) & (_mod(at, 2) == 0)
    household = F.struct(
        _text(F.col("o_custkey")).alias("household_id"),
        submission_id.alias("submission_id"),
        F.col("_ward").alias("ward_id"),
        F.col("c_name").alias("household_head_name"),
        F.lpad(_text(_mod(F.col("o_custkey"), 10000)), 4, "0").alias("phone_last4"),
        n_members.cast("long").alias("hh_size_reported"),
        pick(FILTER_CYCLE, _mod(at, len(FILTER_CYCLE))).alias("water_filter_type"),
        pick(SOURCE_CYCLE, _mod(at, len(SOURCE_CYCLE))).alias("primary_water_source"),
        (F.col("c_acctbal") > 0).alias("has_toilet"),
        F.when(~no_roster, _each(n_members, lambda j: _member(k, i, j, submission_id))).alias("members"),
    )
    water_point = F.struct(
        F.concat(F.lit("w"), _text(_mod(at, 500))).alias("water_point_id"),
        submission_id.alias("submission_id"),
        F.col("_ward").alias("ward_id"),
        pick(POINT_TYPE_CYCLE, _mod(at, len(POINT_TYPE_CYCLE))).alias("source_type"),
        (_mod(at, 5) != 0).alias("functional"),
        _mod(at, 45).cast("long").alias("distance_minutes"),
    )
    return F.struct(
        submission_id.alias("submission_id"),
        F.when(_mod(at, 9) == 0, "draft").otherwise("submitted").alias("status"),
        visited.alias("submitted_at"),
        visited.alias("collected_at"),
        F.col("o_orderpriority").alias("enumerator_id"),
        F.concat(F.lit("d"), _text(_mod(F.col("o_custkey"), 50))).alias("device_id"),
        _text(F.col("_ward")).alias("ward_id"),
        F.col("_municipality").alias("municipality"),
        F.col("_district").alias("district"),
        F.lit(GPS_LAT).alias("gps_lat"),
        F.lit(GPS_LON).alias("gps_lon"),
        F.lit(True).alias("consent"),
        F.date_format(F.timestamp_add("DAY", i + F.lit(4), F.col("o_orderdate")), ISO).alias("_loaded_at"),
        F.concat(F.lit("round_"), _text(_mod(k, 10))).alias("_batch_id"),
        F.concat(F.lit("f"), _text(_mod(k, 7))).alias("_source_file"),
        (_mod(at, 101) == 0).alias("_is_deleted"),
        household.alias("household"),
        F.when(i < 3, water_point).alias("water_point"),
    )


def batch_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, file_name, ingested_at, json), one row per order."""
    k = F.col("o_orderkey")
    n = _mod(k, 4)
    submissions = F.when((n > 0) | (_mod(k, 8) != 0), _each(n, lambda i: _submission(k, i)))
    return order_context(spark, sf_dir).select(
        _text(k).alias("doc_key"),
        F.concat(F.lit("rounds/"), F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("/"), _text(_mod(k, 7)), F.lit(".json")).alias("file_name"),
        F.timestamp_add("DAY", F.lit(8), F.col("o_orderdate")).alias("ingested_at"),
        F.to_json(F.struct(submissions.alias("submissions"))).alias("json"),
    )
