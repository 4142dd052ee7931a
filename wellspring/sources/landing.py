"""Landing: semi-structured survey documents, their flattening and raw projections.

A landing row is one JSON document (``payload`` VARIANT), its file and its
ingest time. ``flatten`` explodes ``payload.submissions`` (outer: an empty
or missing array keeps one all-NULL row) and extracts typed fields with
``try_variant_get``; ``raw_*`` project the four raw entities, the members
by a second outer explode of ``household.members``.

``landing_documents`` derives documents from the driver's tables: one
document per line item (a submission whose household has that one member
and whose water point is the line's supplier), and one per order without
line items (an empty roster). No group is collected, so no hot key can pile
up in one task.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import audit_columns, try_boolean, try_number
from ..functions.valuesets import FORM_ID, FORM_VERSION
from .bindings import RawFrames, order_context, pick, POINT_TYPE_CYCLE, FILTER_CYCLE, SOURCE_CYCLE
from .tables import table

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def _mod(c: str, m: int) -> Column:
    return F.pmod(F.col(c), F.lit(m))


def landing_documents(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """(doc_key, file_name, ingested_at, json) rows built from orders and line items.

    ``files`` deals orders and line items over that many partitions by order, for
    the join and the files at once: the shuffle holds the tables' columns, not the
    JSON, and the documents of an order lie together, which packs them well.
    """
    ctx = order_context(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag",
        "l_linestatus")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    li = li.join(s, li.l_suppkey == s.s_suppkey, "left")
    if files:
        ctx, li = ctx.repartition(files, "o_orderkey"), li.repartition(files, "l_orderkey")
    j = ctx.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    loaded = F.timestamp_add("DAY", _mod("o_orderkey", 10), F.col("o_orderdate"))
    has_line = F.col("l_orderkey").isNotNull()
    member = F.struct(
        F.col("o_custkey").cast("string").alias("household_id"),
        F.col("o_orderkey").cast("string").alias("submission_id"),
        F.col("l_linenumber").cast("long").alias("member_index"),
        F.concat(F.lit("m"), F.col("l_partkey").cast("string")).alias("member_name"),
        F.when(F.col("l_linestatus") == "O", "male").when(F.col("l_linestatus") == "F", "female").alias("sex"),
        (F.col("l_quantity").cast("long")
         + F.when(_mod("l_partkey", 50) == 0, F.lit(100)).otherwise(F.lit(0))).alias("age_years"),
        F.when(F.col("l_returnflag") == "R", F.lit(True))
         .when(F.col("l_returnflag") == "A", F.lit(False)).alias("had_diarrhoea_14d"),
    )
    members = F.when(has_line, F.array(member)).otherwise(F.array().cast(F.ArrayType(member_type())))
    household = F.struct(
        F.col("o_custkey").cast("string").alias("household_id"),
        F.col("o_orderkey").cast("string").alias("submission_id"),
        F.col("_ward").alias("ward_id"),
        F.col("c_name").alias("household_head_name"),
        F.lpad(_mod("o_custkey", 10000).cast("string"), 4, "0").alias("phone_last4"),
        _mod("o_orderkey", 17).cast("long").alias("hh_size_reported"),
        pick(FILTER_CYCLE, _mod("o_orderkey", len(FILTER_CYCLE))).alias("water_filter_type"),
        pick(SOURCE_CYCLE, _mod("o_orderkey", len(SOURCE_CYCLE))).alias("primary_water_source"),
        (F.col("c_acctbal") > 0).alias("has_toilet"),
        members.alias("members"),
    )
    water_point = F.when(has_line, F.struct(
        F.col("l_suppkey").cast("string").alias("water_point_id"),
        F.col("o_orderkey").cast("string").alias("submission_id"),
        F.col("s_nationkey").cast("long").alias("ward_id"),
        pick(POINT_TYPE_CYCLE, _mod("l_partkey", len(POINT_TYPE_CYCLE))).alias("source_type"),
        (F.col("l_returnflag") != "R").alias("functional"),
        (F.round(F.col("l_discount") * 100).cast("long") - 1).alias("distance_minutes"),
    ))
    status = (F.when(F.col("o_orderstatus") == "P", "draft")
              .when(F.col("o_orderstatus") == "F", " Submitted ").otherwise("submitted"))
    submission = F.struct(
        F.col("o_orderkey").cast("string").alias("submission_id"),
        status.alias("status"),
        F.when(_mod("o_orderkey", 97) == 0, F.lit(None).cast("string"))
         .otherwise(F.date_format("o_orderdate", ISO)).alias("submitted_at"),
        F.date_format("o_orderdate", ISO).alias("collected_at"),
        F.when(_mod("o_orderkey", 89) == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("enumerator_id"),
        F.concat(F.lit("d"), _mod("o_custkey", 50).cast("string")).alias("device_id"),
        F.col("_ward").cast("string").alias("ward_id"),
        F.col("_municipality").alias("municipality"),
        F.col("_district").alias("district"),
        F.when(_mod("o_orderkey", 83) == 0, F.lit(123.456))
         .when(_mod("o_orderkey", 79) == 0, F.lit(None).cast("double")).otherwise(F.lit(27.5)).alias("gps_lat"),
        F.lit(85.3).alias("gps_lon"),
        (_mod("o_orderkey", 13) != 0).alias("consent"),
        F.date_format(loaded, ISO).alias("_loaded_at"),
        F.concat(F.lit("batch_"), _mod("o_orderkey", 10).cast("string")).alias("_batch_id"),
        F.concat(F.lit("f"), _mod("o_orderkey", 7).cast("string")).alias("_source_file"),
        (_mod("o_orderkey", 101) == 0).alias("_is_deleted"),
        household.alias("household"),
        water_point.alias("water_point"),
    )
    doc = F.struct(
        F.struct(F.concat(F.lit("batch_"), _mod("o_orderkey", 10).cast("string")).alias("batch_id"),
                 F.date_format(loaded, ISO).alias("generated_at")).alias("batch_meta"),
        F.array(submission).alias("submissions"),
    )
    doc_key = F.concat_ws(":", F.col("o_orderkey").cast("string"),
                          F.coalesce(F.col("l_linenumber").cast("string"), F.lit("-")),
                          F.coalesce(F.col("l_partkey").cast("string"), F.lit("-")),
                          F.coalesce(F.col("l_suppkey").cast("string"), F.lit("-")))
    return j.select(
        doc_key.alias("doc_key"),
        F.concat(F.lit("raw/"), F.date_format(loaded, "yyyy/MM/dd"), F.lit("/wash_submissions_"),
                 _mod("o_orderkey", 7).cast("string"), F.lit(".json")).alias("file_name"),
        F.timestamp_add("HOUR", F.lit(1), loaded).alias("ingested_at"),
        F.to_json(doc).alias("json"),
    )


def member_type():
    from pyspark.sql import types as T
    return T.StructType([
        T.StructField("household_id", T.StringType()), T.StructField("submission_id", T.StringType()),
        T.StructField("member_index", T.LongType()), T.StructField("member_name", T.StringType()),
        T.StructField("sex", T.StringType()), T.StructField("age_years", T.LongType()),
        T.StructField("had_diarrhoea_14d", T.BooleanType()),
    ])


def landing_table(docs: DataFrame) -> DataFrame:
    """Landing rows: payload VARIANT parsed from the JSON text (NULL when corrupt).

    The payload comes out of a one-element explode: filters and fields read its
    value. As a plain column, each of them would be merged with the parser and
    parse the text again.
    """
    return docs.select(F.explode(F.array(F.try_parse_json(F.col("json")))).alias("payload"), "file_name", "ingested_at",
                       F.col("json").alias("payload_text"))


def is_corrupt(text_col: str = "payload_text") -> Column:
    """True for a row whose text does not parse, else false (never NULL)."""
    return F.col("payload").isNull() & F.col(text_col).isNotNull()


def split_corrupt(landing: DataFrame, text_col: str = "payload_text"):
    """(good, bad): rows whose text does not parse go to the side table."""
    bad_cond = is_corrupt(text_col)
    return landing.where(~bad_cond), landing.where(bad_cond)


def vget(v: str | Column, path: str, typ: str) -> Column:
    """Typed value at a path, NULL where it does not cast; whole numbers and booleans also from text."""
    c = F.col(v) if isinstance(v, str) else v
    if typ == "long":
        return try_number(F.try_variant_get(c, path, "string"))
    if typ == "boolean":
        return try_boolean(F.try_variant_get(c, path, "string"))
    return F.try_variant_get(c, path, typ)


def explode_outer(df: DataFrame, variant_col: str, path: str, alias: str, keep: list | None = None) -> DataFrame:
    """Outer-explode the array at ``path``: an empty or missing array keeps one row with NULL."""
    keep = keep if keep is not None else [c for c in df.columns]
    # explode_outer over an array<variant> keeps one NULL row for empty/NULL arrays
    return df.select(*keep, F.explode_outer(F.try_variant_get(F.col(variant_col), path, "array<variant>")).alias(alias))


SUBMISSION_FIELDS = {
    "submission_id": ("$.submission_id", "string"),
    "submitted_at": ("$.submitted_at", "string"),
    "status": ("$.status", "string"),
    "collected_at": ("$.collected_at", "string"),
    "enumerator_id": ("$.enumerator_id", "string"),
    "device_id": ("$.device_id", "string"),
    "ward_id": ("$.ward_id", "long"),
    "municipality": ("$.municipality", "string"),
    "district": ("$.district", "string"),
    "gps_lat": ("$.gps_lat", "double"),
    "gps_lon": ("$.gps_lon", "double"),
    "consent": ("$.consent", "boolean"),
    "household_id": ("$.household.household_id", "string"),
    "household_ward_id": ("$.household.ward_id", "long"),
    "household_head_name": ("$.household.household_head_name", "string"),
    "phone_last4": ("$.household.phone_last4", "string"),
    "hh_size_reported": ("$.household.hh_size_reported", "long"),
    "water_filter_type": ("$.household.water_filter_type", "string"),
    "primary_water_source": ("$.household.primary_water_source", "string"),
    "has_toilet": ("$.household.has_toilet", "boolean"),
    "members": ("$.household.members", "variant"),
    "water_point": ("$.water_point", "variant"),
    "_batch_id": ("$._batch_id", "string"),
    "_is_deleted": ("$._is_deleted", "boolean"),
    "_loaded_at": ("$._loaded_at", "string"),
    "_source_file": ("$._source_file", "string"),
}


def _read_type(typ: str) -> str:
    """The type a value is read as: whole numbers and booleans come from its text (see ``vget``)."""
    return "string" if typ in ("long", "boolean") else typ


def object_type(fields: dict) -> str:
    """The struct that holds the values at ``fields``' paths, nested as the paths are.

    A cast to it reads an object in one pass and leaves NULL what does not cast,
    as ``try_variant_get`` does path by path. An object taken out as VARIANT is
    built anew, so only values that stay VARIANT are.
    """
    tree: dict = {}
    for path, typ in fields.values():
        *parents, leaf = path.removeprefix("$.").split(".")
        at = tree
        for p in parents:
            at = at.setdefault(p, {})
        at[leaf] = _read_type(typ)
    spell = lambda t: t if isinstance(t, str) else f"struct<{','.join(f'`{k}`:{spell(v)}' for k, v in t.items())}>"
    return spell(tree)


def extract(df: DataFrame, struct_col: str, fields: dict, keep: list | None = None) -> DataFrame:
    """Typed columns from a struct of ``object_type(fields)`` (NULL where a value does not cast)."""
    def value(path: str, typ: str) -> Column:
        c = F.col(f"{struct_col}.{path.removeprefix('$.')}")
        return try_number(c) if typ == "long" else try_boolean(c) if typ == "boolean" else c
    return df.select(*(keep or []), *[value(p, t).alias(n) for n, (p, t) in fields.items()])


def flatten(landing: DataFrame, columns: Collection[str] = tuple(SUBMISSION_FIELDS)) -> DataFrame:
    """ext_kobo_source_flattened: one row per submission element (outer: none keeps one row of NULLs).

    Every value of the cast costs about a microsecond and Spark does not prune
    the cast, so a reader of some columns names these.
    """
    return flatten_read(landing.select(submissions(columns).alias("__subs")), columns)


def submissions(columns: Collection[str]) -> Column:
    """The payload's submissions, read as structs of the named columns' values."""
    fields = {n: f for n, f in SUBMISSION_FIELDS.items() if n in columns}
    return F.try_variant_get(F.col("payload"), "$.submissions", f"array<{object_type(fields)}>")


def flatten_read(landing: DataFrame, columns: Collection[str]) -> DataFrame:
    """``flatten`` of landing rows whose ``submissions(columns)`` are in ``__subs``."""
    fields = {n: f for n, f in SUBMISSION_FIELDS.items() if n in columns}
    return extract(landing.select(F.explode_outer("__subs").alias("__sub")), "__sub", fields)


MEMBER_FIELDS = {
    "member_index": ("$.member_index", "long"),
    "member_name": ("$.member_name", "string"),
    "sex": ("$.sex", "string"),
    "age_years": ("$.age_years", "long"),
    "had_diarrhoea_14d": ("$.had_diarrhoea_14d", "boolean"),
    "fla_submission_id": ("$.submission_id", "string"),
    "fla_household_id": ("$.household_id", "string"),
}

WATER_POINT_FIELDS = {
    "water_point_id": ("$.water_point_id", "string"),
    "ward_id": ("$.ward_id", "long"),
    "source_type": ("$.source_type", "string"),
    "functional": ("$.functional", "boolean"),
    "distance_minutes": ("$.distance_minutes", "long"),
    "gps_lat": ("$.gps_lat", "double"),
    "gps_lon": ("$.gps_lon", "double"),
    "fla_submission_id": ("$.submission_id", "string"),
}


AUDIT = ("_loaded_at", "_batch_id", "_source_file", "_is_deleted")
RAW_SUBMISSION_READS = ("submission_id", "status", "submitted_at", "collected_at", "enumerator_id", "device_id", "ward_id",
                        "municipality", "district", "gps_lat", "gps_lon", "consent", *AUDIT)
RAW_HOUSEHOLD_READS = ("household_id", "submission_id", "household_ward_id", "household_head_name", "phone_last4",
                       "hh_size_reported", "water_filter_type", "primary_water_source", "has_toilet", *AUDIT)
RAW_MEMBER_READS = ("household_id", "submission_id", "members", *AUDIT)
RAW_WATER_POINT_READS = ("submission_id", "water_point", *AUDIT)


def raw_submission(ext: DataFrame) -> DataFrame:
    return ext.select(
        F.col("submission_id"), F.col("status"), F.lit(FORM_ID).alias("form_id"),
        F.lit(FORM_VERSION).cast("long").alias("form_version"),
        F.col("submitted_at").try_cast("timestamp_ntz").alias("submitted_at"),
        F.col("collected_at").try_cast("timestamp_ntz").alias("collected_at"),
        "enumerator_id", "device_id", "ward_id", "municipality", "district", "gps_lat", "gps_lon", "consent",
        *audit_columns())


def raw_household(ext: DataFrame) -> DataFrame:
    return ext.select(
        "household_id", "submission_id", F.col("household_ward_id").alias("ward_id"), "household_head_name",
        "phone_last4", "hh_size_reported", "water_filter_type", "primary_water_source", "has_toilet",
        *audit_columns())


def raw_member(ext: DataFrame) -> DataFrame:
    members = F.try_variant_get(F.col("members"), "$", f"array<{object_type(MEMBER_FIELDS)}>")
    mem = ext.select("household_id", "submission_id", *AUDIT, F.explode_outer(members).alias("__m"))
    mem = extract(mem, "__m", MEMBER_FIELDS, ["household_id", "submission_id", *audit_columns()])
    return mem.select("household_id", "submission_id", *MEMBER_FIELDS, *AUDIT)


def raw_water_point(ext: DataFrame) -> DataFrame:
    wp = ext.select("submission_id", *AUDIT, F.try_variant_get(F.col("water_point"), "$", object_type(WATER_POINT_FIELDS)).alias("__w"))
    wp = extract(wp, "__w", WATER_POINT_FIELDS, ["submission_id", *audit_columns()])
    return wp.select("submission_id", *WATER_POINT_FIELDS, *AUDIT)


def raw_from_flat(ext: DataFrame) -> RawFrames:
    return RawFrames(raw_submission(ext), raw_household(ext), raw_member(ext), raw_water_point(ext))


def raw_from_landing(landing: DataFrame) -> RawFrames:
    """The raw entities, each from a flattening of the columns that it reads."""
    return RawFrames(raw_submission(flatten(landing, RAW_SUBMISSION_READS)), raw_household(flatten(landing, RAW_HOUSEHOLD_READS)),
                     raw_member(flatten(landing, RAW_MEMBER_READS)), raw_water_point(flatten(landing, RAW_WATER_POINT_READS)))
