"""Staging rules on hand-made fixtures (flags, dedupe, quarantine, reason buckets)."""

from __future__ import annotations

from survey_rows import T0, hh, mem, raw_frames, sub, ts, wp

from wellspring.plans import monitors, staging


def _by(df, key):
    return {r[key]: r for r in df.collect()}


def test_submission_cases(spark):
    subs = [
        sub("ok", status=" Submitted "),
        sub("draft", status="draft"),
        sub(None),
        sub("badtime", submitted_at=None),
        sub("badgps", lat=123.456, lon=987.654),
        sub("nogps", lat=None),
        sub("halfgps", lat=None, lon=200.0),
        sub("blankmuni", muni="  "),
        sub("deleted", deleted=True),
        sub("delnull", deleted=None),
    ]
    st = staging.stage_all(raw_frames(spark, subs))
    base = _by(st.submission_base, "submission_id")
    acc = {r.submission_id for r in st.submission.accepted.collect()}
    rej = {r.submission_id for r in st.submission.rejected.collect()}
    limbo = {r.submission_id for r in st.submission.limbo.collect()}
    assert base["ok"].status == "submitted"
    assert acc == {"ok", "delnull"}
    assert rej == {None, "badtime", "badgps", "halfgps", "blankmuni", "deleted"}
    assert limbo == {"draft", "nogps"}
    assert base["nogps"].dq_invalid_gps is None  # three-valued flag
    reasons = {(r.reason_bucket, r.rejected_rows) for r in monitors.rejection_by_reason_day(st).collect()
               if r.base_model_name == "stg_kobo_submission"}
    assert ("missing_keys", 1) in reasons and ("invalid_required_field", 1) in reasons
    assert ("invalid_range", 2) in reasons and ("other", 1) in reasons and ("soft_deleted", 1) in reasons


def test_submission_dedupe_order(spark):
    subs = [
        sub("a", loaded=ts("2026-02-01 00:00:00"), enum="old"),
        sub("a", loaded=ts("2026-02-02 00:00:00"), enum="new"),
        sub("b", loaded=T0, source_file="f1", enum="small"),
        sub("b", loaded=T0, source_file="f2", enum="large"),
        sub("c", loaded=T0, enum="dated"),
        sub("c", loaded=None, enum="nullload"),
        sub("d", loaded=ts("2026-02-01 00:00:00"), enum="good"),
        sub("d", loaded=ts("2026-02-02 00:00:00"), muni=""),
    ]
    st = staging.stage_all(raw_frames(spark, subs))
    base = _by(st.submission_base, "submission_id")
    assert base["a"].enumerator_id == "new"
    assert base["b"].enumerator_id == "large"
    assert base["c"].enumerator_id == "nullload"  # NULL load time sorts first on DESC
    acc = {r.submission_id for r in st.submission.accepted.collect()}
    assert "d" not in acc  # a bad newest record hides a good older one


def test_household_cases(spark):
    subs = [sub("s1"), sub("s2"), sub("s3", deleted=True)]
    hhs = [
        hh("h1", "s1"),
        hh("h2", "s3"),  # orphan: submission rejected
        hh("h3", "s1", size=-3), hh("h4", "s1", size=16), hh("h5", "s1", size=0), hh("h6", "s1", size=None),
        hh("h7", "s1", filt="ro"), hh("h8", "s1", filt="unknown"), hh("h9", "s1", filt=""),
        hh("h10", "s1", src="piped"), hh("h11", "s1", src="other"), hh("h12", "s1", src=None),
        hh("h13", "s1", ward=None),
        hh("h14", "s3", size=-3),  # two faults: orphan wins the bucket
    ]
    st = staging.stage_all(raw_frames(spark, subs, hhs))
    acc = {r.household_id for r in st.household.accepted.collect()}
    assert acc == {"h1", "h5", "h6", "h8"}
    reasons = {}
    for r in st.household.rejected.collect():
        reasons[r.household_id] = r
    rb = {r.household_id: r.reason for r in st.household.rejected.select(
        "household_id", monitors.ladder_column(monitors.HOUSEHOLD_LADDER).alias("reason")).collect()}
    assert rb["h2"] == "orphan_fk" and rb["h14"] == "orphan_fk"
    assert rb["h3"] == "invalid_range" and rb["h4"] == "invalid_range"
    assert rb["h7"] == "invalid_canonical" and rb["h10"] == "invalid_canonical"
    assert rb["h9"] == "other" and rb["h12"] == "other" and rb["h13"] == "other"
    assert rb["h11"] == "unknown_other"


def test_member_cases(spark):
    subs = [sub("s1"), sub("s2")]
    hhs = [hh("h1", "s1"), hh("h1", "s2"), hh("hbad", "s1", filt="ro")]
    mems = [
        mem("h1", "s1", 1, "true"), mem("h1", "s1", 2, "false"), mem("h1", "s1", 3, None),
        mem("h1", "s1", 4, "yes"),
        mem("h1", "s1", 5, sex="X"), mem("h1", "s1", 6, sex=""), mem("h1", "s1", 7, sex=None),
        mem("h1", "s1", 8, age=121), mem("h1", "s1", 9, age=-1), mem("h1", "s1", 10, age=None),
        mem("h1", "s1", 11, name="  "), mem("h1", "s1", 12, name=None),
        mem("h1", "s1", 13, deleted=True),
        mem("hbad", "s1", 1),
        mem("hnone", "s1", None),
    ]
    st = staging.stage_all(raw_frames(spark, subs, hhs, mems))
    base = {(r.household_id, r.member_index): r for r in st.member_base.collect()}
    assert [base[("h1", i)].member_had_diarrhoea_14d for i in (1, 2, 3, 4)] == ["yes", "no", "unknown", "yes"]
    acc = {(r.household_id, r.member_index) for r in st.member.accepted.collect()}
    assert ("h1", 13) in acc  # soft-deleted members are accepted (Q7)
    limbo = {(r.household_id, r.member_index) for r in st.member.limbo.collect()}
    assert {("h1", 10), ("h1", 12)} <= limbo
    rb = {(r.household_id, r.member_index): r.reason for r in st.member.rejected.select(
        "household_id", "member_index",
        monitors.ladder_column(monitors.MEMBER_LADDER).alias("reason")).collect()}
    assert rb[("h1", 5)] == "invalid_canonical" and rb[("h1", 6)] == "invalid_canonical"
    assert rb[("h1", 7)] == "other"
    assert rb[("h1", 8)] == "invalid_range" and rb[("h1", 9)] == "invalid_range"
    assert rb[("h1", 11)] == "unknown_other"
    assert rb[("hbad", 1)] == "orphan_fk"
    assert rb[("hnone", None)] == "missing_keys"


def test_member_dedupe_ignores_submission(spark):
    subs = [sub("s1"), sub("s2")]
    hhs = [hh("h1", "s1"), hh("h1", "s2")]
    mems = [mem("h1", "s1", 1, loaded=ts("2026-02-01 00:00:00")),
            mem("h1", "s2", 1, loaded=ts("2026-02-03 00:00:00"))]
    st = staging.stage_all(raw_frames(spark, subs, hhs, mems))
    rows = st.member_base.collect()
    assert len(rows) == 1 and rows[0].submission_id == "s2"  # Q4


def test_water_point_cases(spark):
    subs = [sub("s1")]
    wps = [wp("s1", "w1"), wp("s1", "w2", src="tapstand"), wp("s1", "w3", src=""), wp("s1", "w4", src=None),
           wp("s1", "w5", dist=-5), wp("s1", "w6", dist=None), wp("s1", "w7", deleted=True),
           wp(" s1 ", " w8 ")]
    st = staging.stage_all(raw_frames(spark, subs, wps=wps))
    acc = {r.water_point_id for r in st.water_point.accepted.collect()}
    assert acc == {"w1", "w7", "w8"}  # trimmed ids (Q25), deleted accepted (Q7)
    rb = {r.water_point_id: r.reason for r in st.water_point.rejected.select(
        "water_point_id", monitors.ladder_column(monitors.WATER_POINT_LADDER).alias("reason")).collect()}
    assert rb == {"w2": "other", "w3": "invalid_canonical", "w4": "invalid_canonical", "w5": "invalid_range",
                  "w6": "other"}
