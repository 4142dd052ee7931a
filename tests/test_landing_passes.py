"""Landing documents: one pass over a micro-batch, payloads in one piece, casts of the columns that are read."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from wellspring.operators.incremental import TableStore
from wellspring.session import scratch_path, unsorted_partitions
from wellspring.sources import landing as L
from wellspring.streaming.ingest import land_batch

GOOD = '{"submissions":[{"submission_id":"s","status":"draft","gps_lat":2,"household":{"household_id":"h","ward_id":4}}]}'


def _landing(spark, *texts, read=None):
    docs = spark.createDataFrame([(t,) for t in texts], "json string")
    docs = docs.select(read("json").alias("json") if read else "json", F.lit("f").alias("file_name"),
                       F.lit("2000-01-01").cast("timestamp_ntz").alias("ingested_at"))
    return L.landing_table(docs)


def test_batch_is_read_once(spark):
    rows = spark.sparkContext.accumulator(0)

    def counted(text):
        rows.add(1)
        return text

    store = TableStore(spark, scratch_path(spark, "test-once"))
    land_batch(store, _landing(spark, GOOD, "{", None, GOOD, read=F.udf(counted, "string")), 0)
    assert rows.value == 4  # 8 when good and corrupt rows were written apart
    assert store.read("landing").columns == ["payload", "file_name", "ingested_at"] and store.read("landing").count() == 3
    assert [r.payload_text for r in store.read("landing_corrupt").collect()] == ["{"]
    assert store.read("landing_corrupt").columns == ["file_name", "ingested_at", "payload_text"]


def test_batches_without_good_or_corrupt_rows(spark):
    store = TableStore(spark, scratch_path(spark, "test-split"))
    counts = lambda: (store.read("landing").count(), store.read("landing_corrupt").count())
    land_batch(store, _landing(spark, "{", "["), 0)
    assert counts() == (0, 2)
    land_batch(store, _landing(spark, GOOD), 1)
    assert counts() == (1, 2)
    land_batch(store, _landing(spark, GOOD, GOOD), 0)  # a replay replaces its own rows in both tables
    assert counts() == (3, 0)
    assert store.read_batch("landing", "0").count() == 2


def test_stored_payloads_are_in_one_piece(spark):
    store = TableStore(spark, scratch_path(spark, "test-piece"))
    land_batch(store, _landing(spark, GOOD, GOOD), 0)
    files = glob.glob(f"{store.root.removeprefix('file:')}/landing/d-*/*/*.parquet")
    held = [pq.read_schema(f).field("payload").type for f in files]
    assert held and all({t.field(i).name for i in range(t.num_fields)} == {"value", "metadata"} for t in held)


def test_split_write_does_not_sort(spark):
    df = spark.range(10)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with unsorted_partitions(df, 2):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "3"
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_flatten_casts_named_columns(spark):
    landing = _landing(spark, GOOD, '{"submissions":[null,{"gps_lat":"x","ward_id":"7"}]}', "[]", None)
    whole = L.flatten(landing)
    for names in (["_loaded_at"], ["ward_id", "gps_lat"], ["household_id", "members"], list(L.RAW_HOUSEHOLD_READS)):
        some = L.flatten(landing, names)
        assert sorted(some.columns) == sorted(names)
        rows = lambda df: sorted(map(repr, df.select(*names).collect()))
        assert rows(some) == rows(whole)
    plan = L.flatten(landing, ["_loaded_at"])._jdf.queryExecution().optimizedPlan().toString()
    assert "gps_lat" not in plan and "household" not in plan


def test_raw_entities_from_landing(spark):
    text = ('{"submissions":[{"submission_id":"s","_loaded_at":"2000-01-02T00:00:00","household":{"household_id":"h","members":'
            '[{"member_index":1},{"member_index":2}]},"water_point":{"water_point_id":"w"}},{}]}')
    landing = _landing(spark, text, GOOD, '{"submissions":[]}')
    flat, apart = L.raw_from_flat(L.flatten(landing)), L.raw_from_landing(landing)
    for name in ("submissions", "households", "members", "water_points"):
        a, b = getattr(flat, name), getattr(apart, name)
        assert a.schema == b.schema
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    plan = apart.submissions._jdf.queryExecution().optimizedPlan().toString()
    assert "household" not in plan and "water_point" not in plan


def test_counted_landing_gives_the_same_failures(spark):
    from wellspring import registry as R
    from wellspring.operators.expectations import run_expectations
    from wellspring.plans import checks as CK
    from wellspring.session import materializer

    whole = _landing(spark, GOOD, "{", None, '{"submissions":[{"_loaded_at":"t","_is_deleted":"no"},{"_source_file":4}]}', "[]", '{"submissions":[]}')
    checks = [c for c in CK.declared_checks() if c.table in ("landing", "ext_kobo_source_flattened")]
    columns = CK.columns_read(checks, "ext_kobo_source_flattened")
    assert sorted(columns) == ["_is_deleted", "_loaded_at", "_source_file"] and CK.only_presence(checks, "landing")
    written = []
    keep = materializer(spark, "test-counted")
    landing, flat = R.counted_landing(whole, columns, lambda df: written.append(keep(df)) or written[-1])
    assert len(written) == 1 and "variant" not in dict(written[0].dtypes).values()
    frames = {"landing": whole, "ext_kobo_source_flattened": L.flatten(L.split_corrupt(whole)[0])}
    slim = {"landing": landing, "ext_kobo_source_flattened": flat}
    rows = lambda f: sorted(map(tuple, run_expectations(f, checks).collect()))
    assert rows(slim) == rows(frames) and sum(r[4] for r in rows(slim)) > 0


def test_columns_of_checks():
    from wellspring.operators.expectations import Check
    from wellspring.plans import checks as CK

    named = [Check("a", "t", "not_null", {"column": "x"}), Check("b", "t", "unique_combination", {"columns": ["y", "z"]}),
             Check("c", "u", "relationship", {"column": "k", "to": "t", "field": "id"})]
    assert CK.columns_read(named, "t") == ["x", "y", "z", "id"] and not CK.only_presence(named, "t")
    for unknown in (Check("d", "t", "expression", {"expression": "x > 1"}), Check("e", "t", "not_null", {"column": "x"}, where="w > 1")):
        assert CK.columns_read([*named, unknown], "t") is None and not CK.only_presence([unknown], "t")


def test_raw_entities_are_made_when_read():
    from wellspring.sources.bindings import LazyRaw, RawFrames

    made = []
    raw = LazyRaw(RawFrames(1, 2, 3, 4), lambda df: made.append(df) or df * 10)
    half = LazyRaw(raw, lambda df: df // 2)
    assert not made and (half.members, raw.members, half.members) == (15, 30, 15) and made == [3]
