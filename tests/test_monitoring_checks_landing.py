"""Monitors, expectations, landing JSON and the driver contract."""

from __future__ import annotations

import datetime as dt
import json

from survey_rows import hh, raw_frames, sub, ts

from pyspark.sql import functions as F

from wellspring.operators import expectations as X
from wellspring.operators import monitoring as M
from wellspring.plans import monitors, staging
from wellspring.sources import landing as L


def test_rejection_rate_and_null_dates(spark):
    subs = [sub("a"), sub("b", deleted=True), sub("c", loaded=None), sub("d", loaded=ts("2026-02-05 00:00:00"))]
    st = staging.stage_all(raw_frames(spark, subs, [hh("h", "a")]))
    rate = {(r.model_name, r.event_date): r for r in monitors.rejection_rate_day(st).collect()}
    r = rate[("stg_kobo_submission", dt.date(2026, 2, 4))]
    assert (r.base_row_count, r.rejected_row_count, r.rejection_rate) == (2, 1, 0.5)
    assert rate[("stg_kobo_submission", None)].rejected_row_count == 0  # NULL dates do not join
    assert rate[("stg_kobo_submission", dt.date(2026, 2, 5))].rejection_rate == 0.0


def test_late_rate(spark):
    df = spark.createDataFrame(
        [(1, ts("2026-02-01 23:59:00"), ts("2026-02-02 00:01:00")),
         (1, ts("2026-02-01 08:00:00"), ts("2026-02-01 09:00:00"))],
        "ward_id long, submitted_at timestamp_ntz, record_loaded_at timestamp_ntz")
    r = M.late_rate(df).collect()[0]
    assert (r.submissions_total, r.submissions_late, r.late_arrival_rate) == (2, 1, 0.5)


def test_freshness(spark):
    df = spark.createDataFrame([(ts("2026-02-01 00:00:00"),)], "_loaded_at timestamp_ntz")
    out = {r.source_name: r.status for r in M.freshness(
        {"a": df}, "_loaded_at", "2026-02-01 04:00:00", 5, 24).collect()}
    assert out == {"a": "pass"}
    assert M.freshness({"a": df}, "_loaded_at", "2026-02-01 06:00:00", 5, 24).first().status == "warn"
    assert M.freshness({"a": df}, "_loaded_at", "2026-02-03 00:00:00", 5, 24).first().status == "error"


def test_expectations(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "y", None), (None, "bad", 20)], "k long, v string, n long")
    parent = spark.createDataFrame([(1,)], "k long")
    assert X.expect_not_null(df, "k").count() == 1
    assert X.expect_unique(df, "k").count() == 1
    assert X.expect_unique_combination(df, ["k", "v"]).count() == 0
    assert [r.value_field for r in X.expect_accepted_values(df, "v", ["x", "y"]).collect()] == ["bad"]
    assert X.expect_relationship(df, "k", parent, "k").count() == 0
    assert X.expect_expression(df, "n < 10").count() == 1  # NULL passes
    checks = [X.Check("nn", "t", "not_null", {"column": "k"}),
              X.Check("ex", "t", "expression", {"expression": "n < 10"}, severity="warn"),
              X.Check("av", "t", "accepted_values", {"column": "v", "values": ["x", "y"]}, error_if="> 10")]
    rep = {r.check_name: (r.failures, r.status) for r in X.run_expectations({"t": df}, checks).collect()}
    assert rep == {"nn": (1, "error"), "ex": (1, "warn"), "av": (1, "warn")}


def test_one_shuffle_counts_equal_failing_rows(spark):
    child = spark.createDataFrame([(1, "a", 5, None), (1, "a", None, "p"), (2, "b", 1, "p"), (None, "b", 1, "q"), (3, None, 2, None), (7, "z", 9, "q")],
                                  "k long, v string, n long, w string")
    parent = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k long, v string")
    frames = {"child": child, "parent": parent}
    checks = [X.Check("nn", "child", "not_null", {"column": "k"}), X.Check("nn_w", "child", "not_null", {"column": "n"}, where="v = 'a'"),
              X.Check("u", "child", "unique", {"column": "k"}), X.Check("u_w", "child", "unique", {"column": "w"}, where="n < 9"),
              X.Check("uc", "child", "unique_combination", {"columns": ["v", "w"]}),
              X.Check("uc2", "child", "unique_combination", {"columns": ["k", "v"]}),
              X.Check("av", "child", "accepted_values", {"column": "v", "values": ["a"]}),
              X.Check("rel", "child", "relationship", {"column": "k", "to": "parent", "field": "k"}),
              X.Check("rel_w", "child", "relationship", {"column": "v", "to": "parent", "field": "v"}, where="n > 1"),
              X.Check("ex", "child", "expression", {"expression": "n < 9"}), X.Check("pu", "parent", "unique", {"column": "k"}),
              X.Check("custom", "child", "custom", {"fn": lambda f: f["child"].where("k = 3")})]
    got = {r.check_name: r.failures for r in X.run_expectations(frames, checks).collect()}
    assert got == {c.name: X.failing_rows(c, frames).count() for c in checks}
    assert sum(got.values()) > 10
    plan = X.count_failures(frames, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 3  # each table once, and the custom check's own


def test_failing_rows_of_all_row_level_checks_are_kept_in_one_pass(spark):
    from wellspring.session import scratch_path

    df = spark.createDataFrame([(1, 5), (None, 20), (3, 30), (None, None)], "k long, n long")
    frames = {"t": df, "clean": df.where("k = 1")}
    checks = [X.Check("nn", "t", "not_null", {"column": "k"}), X.Check("ex", "t", "expression", {"expression": "n < 10"}),
              X.Check("never", "t", "expression", {"expression": "n > 0"}), X.Check("ok", "clean", "not_null", {"column": "k"})]
    root = scratch_path(spark, "audit-test")
    assert X.store_failures(frames, checks, root) == {"nn": 2, "ex": 2, "never": 0, "ok": 0}
    kept = X.read_failures(frames, root, "t")
    assert sorted(((r.check_name, r.k, r.n) for r in kept.collect() if r.n), key=repr) == [("ex", 3, 30), ("ex", None, 20), ("nn", None, 20)]
    assert kept.columns == ["k", "n", "check_name"] and kept.count() == 4
    assert X.read_failures(frames, root, "clean").count() == 0


def test_landing_flatten(spark):
    member = {"household_id": "h1", "submission_id": "s1", "member_index": 1, "member_name": "A", "sex": "f",
              "age_years": 30, "had_diarrhoea_14d": False}
    doc = {"batch_meta": {"batch_id": "b"}, "submissions": [
        {"submission_id": "s1", "status": "submitted", "submitted_at": "2026-02-04T08:00:00",
         "ward_id": "04", "gps_lat": 27.5, "_loaded_at": "2026-02-04T08:00:00", "_is_deleted": False,
         "household": {"household_id": "h1", "submission_id": "s1", "members": [member]},
         "water_point": {"water_point_id": "w1", "distance_minutes": 12}},
        {"submission_id": "s2", "submitted_at": "02-02-2026 10:00", "household": {"household_id": "h2"}}]}
    empty = {"batch_meta": {"batch_id": "c"}, "submissions": []}
    docs = spark.createDataFrame([(json.dumps(doc), "raw/a.json"), (json.dumps(empty), "raw/b.json"),
                                  ('{"submissions": [', "raw/c.json")], "json string, file_name string") \
        .withColumn("ingested_at", F.lit("2026-02-04 09:00:00").cast("timestamp_ntz"))
    land = L.landing_table(docs)
    good, bad = L.split_corrupt(land)
    assert bad.count() == 1
    ext = L.flatten(good)
    rows = ext.collect()
    assert len(rows) == 3  # the empty array keeps one all-NULL row (outer)
    raw = L.raw_from_flat(ext)
    subs = {r.submission_id: r for r in raw.submissions.collect()}
    assert subs["s1"].ward_id == 4 and subs["s1"].submitted_at == ts("2026-02-04 08:00:00")
    assert subs["s2"].submitted_at is None  # non-ISO text does not cast
    members = {(r.submission_id, r.member_index) for r in raw.members.collect()}
    assert ("s1", 1) in members and ("s2", None) in members  # memberless household keeps a NULL row
    wps = {r.submission_id: r.water_point_id for r in raw.water_points.collect()}
    assert wps["s1"] == "w1" and wps["s2"] is None


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"ward_id", "event_date", "household_events_total", "household_events_safe",
                               "pct_safe"}
    own = {k for k in E.queries() if not k.startswith("op") and k != "pipeline"}
    assert own <= set(E.oracle_sql()) and len(own) >= 85  # every one of them has an oracle


def test_stream_ingest_each_file_once(spark):
    from wellspring.operators.incremental import TableStore
    from wellspring.session import scratch_path
    from wellspring.streaming import ingest as S

    src = scratch_path(spark, "test-landing-src")
    docs = [json.dumps({"submissions": [{"submission_id": f"s{i}", "_loaded_at": "2026-02-04T08:00:00"}]})
            for i in range(3)] + ['{"submissions": [']
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.text(src)
    store = TableStore(spark, scratch_path(spark, "test-landing"))
    ckpt = scratch_path(spark, "test-landing-ckpt")
    lines = {"glob": "part-*", "whole_files": False}
    S.ingest_landing(spark, src, ckpt, store, **lines)
    S.ingest_landing(spark, src, ckpt, store, **lines)  # nothing new: no rows added
    S.ingest_landing(spark, src, ckpt + "-lost", store, **lines)  # the batch is replayed: still no rows added
    landing = S.read_landing(store)
    assert landing.count() == 3
    assert store.read("landing_corrupt").count() == 1
    ids = sorted(r.submission_id for r in L.flatten(landing).collect())
    assert ids == ["s0", "s1", "s2"]


def test_documents_of_several_submissions_fan_out(spark):
    """0 to 3 submissions of 0 to 3 members, from the documents' own JSON."""
    import os

    from wellspring.sources import batches as B
    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    docs = B.batch_documents(spark, sf)
    want_subs, want_members, wrong = [], [], 0
    sizes, rosters, absent = set(), set(), 0
    for r in docs.collect():
        doc = json.loads(r.json)
        absent += "submissions" not in doc
        subs = doc.get("submissions", [])
        sizes.add(len(subs))
        for s in subs or [None]:
            want_subs.append((s or {}).get("submission_id"))
            members = ((s or {}).get("household") or {}).get("members", [])
            rosters.add(len(members) if s else None)
            for m in members or [{}]:
                want_members.append((want_subs[-1] or "", m.get("member_index") or 0))
                wrong += bool(m) and m["household_id"] != s["household"]["household_id"]
    good, bad = L.split_corrupt(L.landing_table(docs))
    flat = L.flatten(good)
    raw = L.raw_from_flat(flat)
    key = lambda x: x or ""
    assert bad.count() == 0 and absent > 0 and wrong > 0
    assert sizes == {0, 1, 2, 3} and rosters >= {0, 1, 2, 3}
    assert sorted((r[0] for r in flat.select("submission_id").collect()), key=key) == sorted(want_subs, key=key)
    got = raw.members.select("submission_id", "member_index").collect()
    assert sorted((r[0] or "", r[1] or 0) for r in got) == sorted(want_members)
    assert raw.members.where("fla_household_id <> household_id").count() == wrong


def test_missing_parts_of_a_document_keep_one_null_row(spark):
    texts = ['{}', '{"submissions":[]}', '{"submissions":null}', '{"submissions":[{"submission_id":"a"}]}',
             '{"submissions":[{"submission_id":"b","household":{"members":[]}},{"submission_id":"c"}]}', '{"submissions":[']
    docs = spark.createDataFrame([(t,) for t in texts], "json string").select(
        "json", F.lit("f").alias("file_name"), F.lit(None).cast("timestamp_ntz").alias("ingested_at"))
    good, bad = L.split_corrupt(L.landing_table(docs))
    flat = L.flatten(good)
    assert bad.count() == 1
    assert sorted((r[0] or "") for r in flat.select("submission_id").collect()) == ["", "", "", "a", "b", "c"]
    assert L.raw_from_flat(flat).members.where("member_index is null").count() == 6
