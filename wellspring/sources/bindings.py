"""Bind the driver's TPC-H-style tables to the four raw survey entities.

The test data has no survey tables, so each raw entity is derived from the
driver's tables with deterministic rules (orders are submissions and
households, line items are members and water points). Every row of the
inputs is used; the modulo rules only choose values, they never drop rows.

    submission   one per order; ward/municipality/district from the
                 customer's nation and region
    household    one per order, household = customer
    member       one per line item (household = the order's customer,
                 member_index = line number)
    water point  one per line item (water point = supplier)

The result frames have the typed shape of the raw tables (what the flatten
step produces from landing JSON), so staging runs on them unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.valuesets import FORM_ID, FORM_VERSION, WATER_FILTER_TYPES, WATER_SOURCES
from .tables import table

# Value lists the binding cycles through: the canonical sets plus one
# non-canonical label each (and a blank for water points).
FILTER_CYCLE = WATER_FILTER_TYPES + ("ro",)
SOURCE_CYCLE = WATER_SOURCES + ("piped",)
POINT_TYPE_CYCLE = WATER_SOURCES + ("tapstand", "")

GPS_LAT = 27.5
GPS_LON = 85.3
BAD_GPS_LAT = 123.456


def pick(values: tuple[str, ...], index: Column) -> Column:
    """``values[index]`` as a literal array lookup (JVM side)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + F.lit(1)).cast("int"))


def _mod(c: str, m: int) -> Column:
    return F.pmod(F.col(c), F.lit(m))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ward / municipality / district per nation key (25 rows in TPC-H)."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("long").alias("_ward"),
        F.col("n_name").alias("_municipality"),
        F.col("r_name").alias("_district"),
    )


def order_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined to their customer and geography (one row per order)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    oc = o.join(c, o.o_custkey == c.c_custkey, "left")
    return oc.join(_geo(spark, sf_dir), F.col("c_nationkey").cast("long") == F.col("_ward"), "left")


def _order_audit() -> list[Column]:
    return [
        F.timestamp_add("DAY", _mod("o_orderkey", 10), F.col("o_orderdate")).alias("_loaded_at"),
        F.concat(F.lit("batch_"), _mod("o_orderkey", 10).cast("string")).alias("_batch_id"),
        F.concat(F.lit("f"), _mod("o_orderkey", 7).cast("string")).alias("_source_file"),
        (_mod("o_orderkey", 101) == 0).alias("_is_deleted"),
    ]


def _line_audit() -> list[Column]:
    return [
        F.col("l_shipdate").alias("_loaded_at"),
        F.concat(F.lit("batch_"), _mod("l_orderkey", 10).cast("string")).alias("_batch_id"),
        F.concat(F.lit("f"), _mod("l_orderkey", 7).cast("string")).alias("_source_file"),
        (_mod("l_orderkey", 101) == 0).alias("_is_deleted"),
    ]


def raw_submissions(spark: SparkSession, sf_dir: str, ctx: DataFrame | None = None) -> DataFrame:
    ctx = ctx if ctx is not None else order_context(spark, sf_dir)
    k = F.col("o_orderkey")
    status = (F.when(F.col("o_orderstatus") == "P", "draft")
              .when(F.col("o_orderstatus") == "F", " Submitted ")
              .otherwise("submitted"))
    gps_lat = (F.when(_mod("o_orderkey", 83) == 0, F.lit(BAD_GPS_LAT))
               .when(_mod("o_orderkey", 79) == 0, F.lit(None).cast("double"))
               .otherwise(F.lit(GPS_LAT)))
    return ctx.select(
        k.cast("string").alias("submission_id"),
        status.alias("status"),
        F.lit(FORM_ID).alias("form_id"),
        F.lit(FORM_VERSION).cast("long").alias("form_version"),
        F.when(_mod("o_orderkey", 97) == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("o_orderdate")).alias("submitted_at"),
        F.col("o_orderdate").alias("collected_at"),
        F.when(_mod("o_orderkey", 89) == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("enumerator_id"),
        F.concat(F.lit("d"), _mod("o_custkey", 50).cast("string")).alias("device_id"),
        F.col("_ward").alias("ward_id"),
        F.col("_municipality").alias("municipality"),
        F.col("_district").alias("district"),
        gps_lat.alias("gps_lat"),
        F.lit(GPS_LON).alias("gps_lon"),
        (_mod("o_orderkey", 13) != 0).alias("consent"),
        *_order_audit(),
    )


def raw_households(spark: SparkSession, sf_dir: str, ctx: DataFrame | None = None) -> DataFrame:
    ctx = ctx if ctx is not None else order_context(spark, sf_dir)
    return ctx.select(
        F.col("o_custkey").cast("string").alias("household_id"),
        F.col("o_orderkey").cast("string").alias("submission_id"),
        F.col("_ward").alias("ward_id"),
        F.col("c_name").alias("household_head_name"),
        F.lpad(_mod("o_custkey", 10000).cast("string"), 4, "0").alias("phone_last4"),
        _mod("o_orderkey", 17).cast("long").alias("hh_size_reported"),
        pick(FILTER_CYCLE, _mod("o_orderkey", len(FILTER_CYCLE))).alias("water_filter_type"),
        pick(SOURCE_CYCLE, _mod("o_orderkey", len(SOURCE_CYCLE))).alias("primary_water_source"),
        (F.col("c_acctbal") > 0).alias("has_toilet"),
        *_order_audit(),
    )


def raw_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    age = F.col("l_quantity").cast("long") + F.when(_mod("l_partkey", 50) == 0, F.lit(100)).otherwise(F.lit(0))
    return j.select(
        F.col("o_custkey").cast("string").alias("household_id"),
        F.col("l_orderkey").cast("string").alias("submission_id"),
        F.col("l_linenumber").cast("long").alias("member_index"),
        F.concat(F.lit("m"), F.col("l_partkey").cast("string")).alias("member_name"),
        F.when(F.col("l_linestatus") == "O", "male").when(F.col("l_linestatus") == "F", "female").alias("sex"),
        age.alias("age_years"),
        F.when(F.col("l_returnflag") == "R", F.lit(True))
         .when(F.col("l_returnflag") == "A", F.lit(False)).alias("had_diarrhoea_14d"),
        F.col("l_orderkey").cast("string").alias("fla_submission_id"),
        F.col("o_custkey").cast("string").alias("fla_household_id"),
        *_line_audit(),
    )


def raw_water_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_discount", "l_returnflag", "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey, "left")
    wp_id = F.when(_mod("l_partkey", 11) == 0, F.concat(F.lit(" "), F.col("l_suppkey").cast("string"))) \
        .otherwise(F.col("l_suppkey").cast("string"))
    distance = F.when(_mod("l_partkey", 61) == 0, F.lit(None).cast("long")) \
        .otherwise(F.round(F.col("l_discount") * 100).cast("long") - 1)
    return j.select(
        F.col("l_orderkey").cast("string").alias("submission_id"),
        wp_id.alias("water_point_id"),
        F.col("s_nationkey").cast("long").alias("ward_id"),
        pick(POINT_TYPE_CYCLE, _mod("l_partkey", len(POINT_TYPE_CYCLE))).alias("source_type"),
        (F.col("l_returnflag") != "R").alias("functional"),
        distance.alias("distance_minutes"),
        F.lit(GPS_LAT).alias("gps_lat"),
        F.lit(GPS_LON).alias("gps_lon"),
        F.col("l_orderkey").cast("string").alias("fla_submission_id"),
        *_line_audit(),
    )


@dataclass
class RawFrames:
    submissions: DataFrame
    households: DataFrame
    members: DataFrame
    water_points: DataFrame


class LazyRaw:
    """The raw entities, each made by ``make`` from that of ``raw`` when it is first read."""

    def __init__(self, raw: RawFrames | LazyRaw, make: Callable[[DataFrame], DataFrame]):
        self._raw, self._make = raw, make

    @cached_property
    def submissions(self) -> DataFrame:
        return self._make(self._raw.submissions)

    @cached_property
    def households(self) -> DataFrame:
        return self._make(self._raw.households)

    @cached_property
    def members(self) -> DataFrame:
        return self._make(self._raw.members)

    @cached_property
    def water_points(self) -> DataFrame:
        return self._make(self._raw.water_points)


def bind_raw(spark: SparkSession, sf_dir: str) -> RawFrames:
    ctx = order_context(spark, sf_dir)
    return RawFrames(
        submissions=raw_submissions(spark, sf_dir, ctx),
        households=raw_households(spark, sf_dir, ctx),
        members=raw_members(spark, sf_dir),
        water_points=raw_water_points(spark, sf_dir),
    )
