"""Queries whose steps are written one by one, so that the shuffles of a step go with it."""

from __future__ import annotations

from survey_rows import hh, mem, raw_frames, sub, ts, wp

from wellspring import registry as R
from wellspring.operators import incremental as I
from wellspring.plans import monitors as MON
from wellspring.plans import scenario as SC
from wellspring.plans import staging
from wellspring.plans.build import build_full


def _raw(spark):
    day = lambda s: ts(f"{s} 08:00:00")
    subs = [sub("a", submitted_at=day("1998-03-01"), loaded=day("1998-03-02")), sub("b", submitted_at=day("1998-05-01"), loaded=day("2001-03-02")),
            sub("c", submitted_at=day("1997-01-01"), loaded=day("1997-01-01")), sub(None), sub("d", status="draft", loaded=None)]
    hhs = [hh("h", s, loaded=day("1998-03-02")) for s in ("a", "b", "c", "zz")] + [hh(None, "a")]
    mems = [mem("h", s, n, loaded=day("1998-03-02")) for n, s in enumerate(("a", "b", "c"), 1)] + [mem("h", "a", None, loaded=None)]
    return raw_frames(spark, subs, hhs, mems, [wp("a", "w"), wp("zz", "w", loaded=None)])


def _counting(monkeypatch, raw):
    written = []
    monkeypatch.setattr(R, "_raw", lambda spark, sf_dir: raw)
    monkeypatch.setattr(R, "materializer", lambda spark, tag="stage": lambda df: written.append(df) or df)
    return written


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_rejection_rate_join_stores_each_base_once(spark, monkeypatch):
    raw = _raw(spark)
    st = staging.stage_all(raw)
    want = MON.rejection_rate_join(MON.total_by_model_day(st), MON.rejections_by_model_day(st))
    written = _counting(monkeypatch, raw)
    got = R.q_rejection_rate_join(spark, "none")
    assert len(written) == 4  # the bases of four entities; none before
    assert _rows(got) == _rows(want) and got.count() > 0


def test_backfill_stores_raw_tables_and_builds(spark, monkeypatch):
    raw = _raw(spark)
    first, full = build_full(SC.batch_before(raw, SC.CUTOFF_1)), build_full(raw)
    src = I.backfill_range(full.fact, SC.BACKFILL_START, SC.BACKFILL_END)
    want = I.upsert(first.fact, src, ["household_id", "submission_id"])
    written = _counting(monkeypatch, raw)
    got = R.q_backfill_range(spark, "none")
    # three raw tables for both builds (water points are not read); three bases, events, rollup and fact of each; none before
    assert len(written) == 3 + 2 * 6
    assert _rows(got) == _rows(want) and sorted(r.submission_id for r in got.collect()) == ["a", "b", "c"]
