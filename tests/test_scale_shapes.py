"""Shapes that keep shuffles and written tables small: few exchanges, nothing staged that no one reads, texts parsed once."""

from __future__ import annotations

from survey_rows import hh, mem, raw_frames, sub

from pyspark.sql import functions as F

from wellspring import registry as R
from wellspring.functions.columns import try_boolean
from wellspring.operators.incremental import TableStore
from wellspring.operators.relational import dedupe_latest, latest_with_orphan_flag, orphan_flag
from wellspring.plans.build import build_full
from wellspring.session import dropping_shuffles, scratch_path
from wellspring.sources import landing as L
from wellspring.streaming.ingest import land_batch


def test_latest_with_orphan_flag_shuffles_rows_once(spark):
    rows = [("h1", "a", 1), ("h1", "a", 2), ("h2", "a", 1), ("h1", "z", 1), ("h1", None, 1), ("h1", None, 3), (None, None, 1),
            (None, None, 2), (None, "", 1)]
    df = spark.createDataFrame(rows, "h string, s string, n int")
    ref = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for non_blank in (False, True):
            got = latest_with_orphan_flag(df, ["h", "s"], ["n"], [], "s", ref, "k", "orphan", non_blank)
            apart = orphan_flag(dedupe_latest(df, ["h", "s"], ["n"]), "s", ref, "k", "orphan", non_blank)
            assert got.columns == apart.columns
            assert sorted(map(repr, got.collect())) == sorted(map(repr, apart.collect()))
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 4  # initial and final plan
        fresh = latest_with_orphan_flag(df, ["h", "s"], ["n"], [], "s", ref, "k", "orphan")
        assert fresh._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # rows, keys
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_build_writes_what_is_read(spark):
    raw = raw_frames(spark, [sub("a")], [hh("h", "a")], [mem("h", "a", 1)])
    written = []
    built = build_full(raw, lambda df: written.append(df) or df)
    assert not written
    assert built.events.count() == 1 and len(written) == 3  # submissions, households, events; no members, rollup or fact
    assert built.ward_day.count() == 1 and len(written) == 6


def test_models_are_defined_when_read():
    made = []
    models = R.Models({"a": lambda: made.append("a") or 1, "b": lambda: made.append("b") or models["a"] + 1})
    assert set(models) == {"a", "b"} and not made
    assert models["b"] == 2 and models["b"] == 2 and made == ["b", "a"]


def _docs(spark):
    rows = [("211:1", '{"submissions": [{"submission_id": "s"}]}'), ("7:1", '{"submissions": []}'), (None, "{}")]
    return spark.createDataFrame(rows, "doc_key string, json string").select(
        "doc_key", F.lit("f").alias("file_name"), F.lit("2000-01-01").cast("timestamp_ntz").alias("ingested_at"), "json")


def test_landing_texts_are_parsed_once(spark):
    docs = _docs(spark)
    both = R.with_corrupt_copies(docs)
    assert sorted(map(repr, both.collect())) == sorted(map(repr, docs.unionByName(R.corrupt_copies(docs)).collect()))
    good, bad = L.split_corrupt(L.landing_table(both))
    flat = L.flatten(good)
    assert [r.submission_id for r in flat.collect() if r.submission_id] == ["s"] and flat.count() == 3 and bad.count() == 0 + 1
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1


def test_landing_files_are_compressed(spark, monkeypatch):
    docs = _docs(spark)
    monkeypatch.setattr(L, "landing_documents", lambda spark, sf_dir, files=None: docs)
    lines = spark.read.text(R._write_landing_files(spark, "none"))
    assert lines.count() == 4
    assert all(r.f.endswith(".gz") for r in lines.select(F.col("_metadata.file_path").alias("f")).collect())


def test_try_boolean_texts(spark):
    df = spark.createDataFrame([(" On ",), ("OFF",), ("yes",), ("0",), ("maybe",), (None,)], "c string")
    assert [r[0] for r in df.select(try_boolean("c")).collect()] == [True, False, True, False, None, None]


def _by_path(docs):
    """Submissions, members and water points read path by path, each object taken out as VARIANT."""
    def read(df, v, fields):
        return [L.vget(v, p, t).alias(n) for n, (p, t) in fields.items()]
    good, _ = L.split_corrupt(L.landing_table(docs))
    flat = L.explode_outer(good, "payload", "$.submissions", "s", keep=[])
    flat = flat.select(*read(flat, "s", L.SUBMISSION_FIELDS))
    members = L.explode_outer(flat, "members", "$", "m")
    return flat, members.select(*read(members, "m", L.MEMBER_FIELDS)), flat.select(*read(flat, "water_point", L.WATER_POINT_FIELDS))


def test_objects_are_read_in_one_pass(spark):
    texts = ['{"submissions":[null,3,"x",[1],{"submission_id":{"x":1},"ward_id":"04","gps_lat":"x","consent":"on","household":[1],"water_point":[]}]}',
             '{"submissions":[{"submission_id":12,"ward_id":2.5,"gps_lat":1,"household":{"household_id":null,"ward_id":true,"members":['
             'null,4,{"member_index":"1","sex":{"a":1},"age_years":1.5}]},"water_point":{"water_point_id":7,"ward_id":"x","functional":"off","gps_lat":2}}]}',
             '{"submissions":[{"household":{"members":{"member_index":1}},"water_point":"w"}]}', '{"submissions":{}}', '{"submissions":[]}', '[]', "null"]
    docs = spark.createDataFrame([(t,) for t in texts], "json string").select(
        "json", F.lit("f").alias("file_name"), F.lit(None).cast("timestamp_ntz").alias("ingested_at"))
    flat = L.flatten(L.split_corrupt(L.landing_table(docs))[0])
    raw = L.raw_from_flat(flat)
    want = _by_path(docs)
    got = (flat, raw.members.select(*L.MEMBER_FIELDS), raw.water_points.select(*L.WATER_POINT_FIELDS))
    for a, b in zip(got, want):
        assert a.schema == b.schema
        rows = [sorted(map(repr, d.select(*[F.to_json(c) if t == "variant" else F.col(c) for c, t in d.dtypes]).collect())) for d in (a, b)]
        assert rows[0] == rows[1]
    plan = raw.water_points._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_get") == 2  # the submissions and the water point, not each field of theirs


def test_landing_files_shuffle_columns_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda files: L.landing_documents(spark, "/root/testdata/sf0.001", files)._jdf.queryExecution().executedPlan().toString()
        assert plan(12).count("Exchange ") == plan(None).count("Exchange ")  # dealt by the shuffles of the join
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _folders(store, name):
    return [n for n in store._names(f"{store.root}/{name}") if n.startswith("d-")]


def test_replaced_batches_leave_no_files(spark):
    store = TableStore(spark, scratch_path(spark, "test-vacuum"))
    docs = L.landing_table(_docs(spark))
    for batch in (0, 1, 0, 1, 0):
        land_batch(store, docs, batch)
    assert len(_folders(store, "landing")) == len(_folders(store, "landing_corrupt")) == 2
    assert store.read("landing").count() == 6


def test_vacuum_keeps_live_partitions(spark):
    store = TableStore(spark, scratch_path(spark, "test-vacuum"))
    rows = lambda *r: spark.createDataFrame(list(r), "k int, p string, v int")
    for batch in (rows((1, "a b", 1), (2, "c/d", 1), (3, None, 1)), rows((1, "a b", 2)), rows((4, "e", 3))):
        store.upsert_partitions("t", batch, ["k"], "p")
        store.vacuum("t")
    assert sorted(tuple(r) for r in store.read("t").select("k", "v").collect()) == [(1, 2), (2, 1), (3, 1), (4, 3)]
    assert len(_folders(store, "t")) == 3 and not [n for n in _folders(store, "t") if n.endswith("-source")]


def test_written_tables_drop_their_shuffles(spark):
    df = spark.range(100).repartition(3, "id")
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen, before = [], spark.conf.get(name, "false")
    with dropping_shuffles(df):
        seen.append(spark.conf.get(name))
    assert seen == ["true"] and spark.conf.get(name) == before
