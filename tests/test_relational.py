"""Generic relational operators: bounded broadcast, dedupe ordering, orphan flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellspring.operators.relational import dedupe_latest, orphan_flag


def test_dedupe_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("k", 1, "a", "x"), ("k", 1, "b", "y"), ("n", None, "a", "p"), ("n", 5, "z", "q"), (None, 1, "a", "r"),
         (None, 2, "a", "s")],
        "key string, loaded int, source_file string, payload string")
    out = {r.key: r.payload for r in dedupe_latest(df, ["key"], ["loaded", "source_file"]).collect()}
    assert out == {"k": "y", "n": "p", None: "s"}  # larger file wins a tie; NULL load first; NULL keys group


def test_orphan_flag_three_cases(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,), ("",)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    f = {r.k: r.orphan for r in orphan_flag(child, "k", parent.withColumnRenamed("k", "pk"), "pk", "orphan")
         .collect()}
    assert f == {"a": False, "b": True, None: False, "": True}
    g = {r.k: r.orphan for r in orphan_flag(child, "k", parent.withColumnRenamed("k", "pk"), "pk", "orphan",
                                             non_blank=True).collect()}
    assert g[""] is False and g["b"] is True
