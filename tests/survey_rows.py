"""Raw survey rows for the fixtures of the tests."""

from __future__ import annotations

import datetime as dt


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


SUB_SCHEMA = ("submission_id string, status string, form_id string, form_version long, "
              "submitted_at timestamp_ntz, collected_at timestamp_ntz, enumerator_id string, device_id string, "
              "ward_id long, municipality string, district string, gps_lat double, gps_lon double, "
              "consent boolean, _loaded_at timestamp_ntz, _batch_id string, _source_file string, "
              "_is_deleted boolean")
HH_SCHEMA = ("household_id string, submission_id string, ward_id long, household_head_name string, "
             "phone_last4 string, hh_size_reported long, water_filter_type string, primary_water_source string, "
             "has_toilet boolean, _loaded_at timestamp_ntz, _batch_id string, _source_file string, "
             "_is_deleted boolean")
MEM_SCHEMA = ("household_id string, submission_id string, member_index long, member_name string, sex string, "
              "age_years long, had_diarrhoea_14d string, fla_submission_id string, fla_household_id string, "
              "_loaded_at timestamp_ntz, _batch_id string, _source_file string, _is_deleted boolean")
WP_SCHEMA = ("submission_id string, water_point_id string, ward_id long, source_type string, functional boolean, "
             "distance_minutes long, gps_lat double, gps_lon double, fla_submission_id string, "
             "_loaded_at timestamp_ntz, _batch_id string, _source_file string, _is_deleted boolean")

T0 = ts("2026-02-04 08:00:00")


def sub(sid, status="submitted", submitted_at=T0, enum="e1", muni="m", dist="d", lat=27.5, lon=85.3,
        loaded=T0, source_file="f1", deleted=False, ward=4):
    return (sid, status, "wash_hh_v3", 3, submitted_at, submitted_at, enum, "dev", ward, muni, dist, lat, lon,
            True, loaded, "b1", source_file, deleted)


def hh(hid, sid, filt="boil", src="rainwater", size=5, ward=4, loaded=T0, deleted=False, source_file="f1"):
    return (hid, sid, ward, "Head", "1234", size, filt, src, True, loaded, "b1", source_file, deleted)


def mem(hid, sid, idx, diarrhoea="false", sex="f", age=30, name="A", loaded=T0, deleted=False):
    return (hid, sid, idx, name, sex, age, diarrhoea, sid, hid, loaded, "b1", "f1", deleted)


def wp(sid, wid, src="rainwater", dist=12, ward=4, loaded=T0, deleted=False):
    return (sid, wid, ward, src, True, dist, 27.5, 85.3, sid, loaded, "b1", "f1", deleted)


def raw_frames(spark, subs=(), hhs=(), mems=(), wps=()):
    from wellspring.sources.bindings import RawFrames

    return RawFrames(
        spark.createDataFrame(list(subs), SUB_SCHEMA),
        spark.createDataFrame(list(hhs), HH_SCHEMA),
        spark.createDataFrame(list(mems), MEM_SCHEMA),
        spark.createDataFrame(list(wps), WP_SCHEMA),
    )
