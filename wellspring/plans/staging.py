"""Staging: standardise, flag and de-duplicate each raw entity, then split.

Each ``base_*`` function returns the ``__base`` table: standardised columns,
the data-quality flags (three-valued) and one row per dedupe key (newest
load first, NULL load time first, larger source file first). Flags are a
per-row function of the row and the accepted parent sets, so they are
computed after the dedupe: same result, fewer rows through the orphan joins.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.valuesets import MEMBER_SEXES, WATER_FILTER_TYPES, WATER_SOURCES
from ..operators.quarantine import Split, quarantine
from ..operators.relational import dedupe_latest, latest_with_orphan_flag, orphan_flag

LOAD_ORDER = ("record_loaded_at", "source_file")


def _audit_std() -> list:
    return [
        F.col("_loaded_at").alias("record_loaded_at"),
        F.col("_batch_id").try_cast("string").alias("batch_id"),
        F.col("_source_file").try_cast("string").alias("source_file"),
        F.coalesce(C.try_boolean("_is_deleted"), F.lit(False)).alias("is_deleted"),
    ]


# ------------------------------------------------------------ submission --
SUBMISSION_FLAGS = (
    "dq_missing_submission_id",
    "dq_missing_blank_municipality",
    "dq_missing_blank_district",
    "dq_submitted_missing_submitted_at",
    "dq_invalid_gps",
    "dq_missing_blank_enumerator_id",
)


def standardise_submission(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("submission_id").try_cast("string").alias("submission_id"),
        C.canonical_text("status").alias("status"),
        F.col("submitted_at"),
        F.col("collected_at"),
        F.col("enumerator_id").try_cast("string").alias("enumerator_id"),
        F.col("device_id").try_cast("string").alias("device_id"),
        C.try_number("ward_id").alias("ward_id"),
        F.col("municipality").try_cast("string").alias("municipality"),
        F.col("district").try_cast("string").alias("district"),
        F.col("gps_lat").try_cast("double").alias("gps_lat"),
        F.col("gps_lon").try_cast("double").alias("gps_lon"),
        C.try_boolean("consent").alias("consent"),
        *_audit_std(),
    )


def flags_submission(df: DataFrame) -> DataFrame:
    lat, lon = F.col("gps_lat"), F.col("gps_lon")
    return df.withColumns({
        "dq_missing_submission_id": C.missing("submission_id"),
        "dq_missing_blank_municipality": C.missing_or_blank("municipality"),
        "dq_missing_blank_district": C.missing_or_blank("district"),
        "dq_submitted_missing_submitted_at": (F.col("status") == "submitted") & F.col("submitted_at").isNull(),
        # precedence as written in the source rule: (a AND b) OR c OR (d AND e) OR f
        "dq_invalid_gps": ((lat.isNotNull() & (lat < -90)) | (lat > 90)
                           | (lon.isNotNull() & (lon < -180)) | (lon > 180)),
        "dq_missing_blank_enumerator_id": C.missing_or_blank("enumerator_id"),
    })


def _latest(df: DataFrame, keys: list[str], first: tuple[str, ...] = ()) -> DataFrame:
    """Newest row per key. Ties on the load order are broken on every other
    column (``first`` ones first), so the choice does not depend on the input's
    order (the source rule leaves ties open)."""
    return dedupe_latest(df, keys, LOAD_ORDER, tie_breakers=_ties(df, keys, first))


def _ties(df: DataFrame, keys: list[str], first: tuple[str, ...] = ()) -> list[str]:
    return [*first, *(c for c in df.columns if c not in (*keys, *LOAD_ORDER, *first))]


def dedupe_submission(df: DataFrame) -> DataFrame:
    return _latest(df, ["submission_id"])


def base_submission(raw: DataFrame) -> DataFrame:
    return flags_submission(dedupe_submission(standardise_submission(raw)))


def split_submission(base: DataFrame) -> Split:
    return quarantine(
        base,
        accept_flags=SUBMISSION_FLAGS + ("is_deleted",),
        reject_flags=SUBMISSION_FLAGS + ("is_deleted",),
        accept_extra=F.col("status") == "submitted",
    )


def submitted_only(accepted: DataFrame) -> DataFrame:
    return accepted.where(F.col("status") == "submitted")


# ------------------------------------------------------------- household --
HOUSEHOLD_FLAGS = (
    "dq_missing_blank_household_id",
    "dq_missing_blank_submission_id",
    "dq_orphan_submission_id",
    "dq_missing_ward_id",
    "dq_missing_blank_water_filter_type",
    "dq_missing_blank_primary_water_source",
    "dq_invalid_hh_size",
    "dq_unknown_other_filter_type",
    "dq_invalid_water_filter_type",
    "dq_unknown_other_primary_water_source",
    "dq_invalid_primary_water_source",
)


HOUSEHOLD_KEYS = ["household_id", "submission_id"]


def standardise_household(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("household_id").try_cast("string").alias("household_id"),
        F.col("submission_id").try_cast("string").alias("submission_id"),
        C.try_number("ward_id").alias("ward_id"),
        C.try_number("hh_size_reported").alias("hh_size_reported"),
        F.trim(F.col("household_head_name").try_cast("string")).alias("household_head_name"),
        F.col("phone_last4").try_cast("string").alias("phone_last4"),
        C.canonical_text("water_filter_type").alias("water_filter_type"),
        C.canonical_text("primary_water_source").alias("primary_water_source"),
        C.try_boolean("has_toilet").alias("has_toilet"),
        *_audit_std(),
    )


def flags_household(df: DataFrame) -> DataFrame:
    """The flags of rows that have ``dq_orphan_submission_id``."""
    wf, ps = F.col("water_filter_type"), F.col("primary_water_source")
    return df.withColumns({
        "dq_missing_blank_household_id": C.missing_or_blank("household_id"),
        "dq_missing_blank_submission_id": C.missing_or_blank("submission_id"),
        "dq_missing_ward_id": C.missing("ward_id"),
        "dq_missing_blank_water_filter_type": C.missing_or_blank("water_filter_type"),
        "dq_missing_blank_primary_water_source": C.missing_or_blank("primary_water_source"),
        "dq_invalid_hh_size": C.out_of_range_not_null("hh_size_reported", 0, 15),
        # as shipped: requires blank AND 'unknown'/'other', so it is never true
        "dq_unknown_other_filter_type": (wf.isNotNull() & (F.trim(wf) == "")
                                         & ((wf == "unknown") | (wf == "other"))),
        "dq_invalid_water_filter_type": C.present_not_in_set(wf, WATER_FILTER_TYPES, non_blank=True),
        "dq_unknown_other_primary_water_source": (ps.isNotNull() & (F.trim(ps) != "")
                                                  & ((ps == "unknown") | (ps == "other"))),
        "dq_invalid_primary_water_source": C.present_not_in_set(ps, WATER_SOURCES, non_blank=True),
    }).select(*_household_columns())


def _household_columns() -> list[str]:
    return ["household_id", "submission_id", "ward_id", "hh_size_reported", "household_head_name",
            "phone_last4", "water_filter_type", "primary_water_source", "has_toilet",
            "record_loaded_at", "batch_id", "source_file", "is_deleted", *HOUSEHOLD_FLAGS]


def dedupe_household(df: DataFrame) -> DataFrame:
    return _latest(df, HOUSEHOLD_KEYS)


def base_household(raw: DataFrame, accepted_submissions: DataFrame) -> DataFrame:
    df = standardise_household(raw)
    return flags_household(latest_with_orphan_flag(
        df, HOUSEHOLD_KEYS, LOAD_ORDER, _ties(df, HOUSEHOLD_KEYS), "submission_id", accepted_submissions, "submission_id",
        "dq_orphan_submission_id"))


def split_household(base: DataFrame) -> Split:
    flags = ("is_deleted",) + HOUSEHOLD_FLAGS
    return quarantine(base, accept_flags=flags, reject_flags=flags)


# ---------------------------------------------------------------- member --
MEMBER_FLAGS = (
    "dq_missing_household_id",
    "dq_missing_submission_id",
    "dq_missing_member_index",
    "dq_missing_blank_member_sex",
    "dq_invalid_member_sex",
    "dq_blank_member_name",
    "dq_invalid_age_in_years",
    "dq_orphan_household_id",
    "dq_orphan_submission_id",
)

MEMBER_TIE_BREAKERS = ("submission_id", "member_name", "member_sex", "member_age_in_years",
                       "member_had_diarrhoea_14d")


def standardise_member(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("household_id").try_cast("string").alias("household_id"),
        F.col("submission_id").try_cast("string").alias("submission_id"),
        C.try_number("member_index").alias("member_index"),
        C.try_number("age_years").alias("member_age_in_years"),
        F.trim(F.col("member_name").try_cast("string")).alias("member_name"),
        C.canonical_text("sex").alias("member_sex"),
        C.tri_state("had_diarrhoea_14d").alias("member_had_diarrhoea_14d"),
        *_audit_std(),
    )


def dedupe_member(df: DataFrame) -> DataFrame:
    # keyed on household and index only: a later round replaces the roster (Q4)
    return _latest(df, ["household_id", "member_index"], MEMBER_TIE_BREAKERS)


def flags_member(df: DataFrame, accepted_households: DataFrame, accepted_submissions: DataFrame) -> DataFrame:
    sex = F.col("member_sex")
    df = orphan_flag(df, "household_id", accepted_households, "household_id", "dq_orphan_household_id")
    df = orphan_flag(df, "submission_id", accepted_submissions, "submission_id", "dq_orphan_submission_id")
    df = df.withColumns({
        "dq_missing_household_id": C.missing("household_id"),
        "dq_missing_submission_id": C.missing("submission_id"),
        "dq_missing_member_index": C.missing("member_index"),
        "dq_missing_blank_member_sex": C.missing_or_blank(sex),
        "dq_invalid_member_sex": sex.isNotNull() & ~sex.isin(list(MEMBER_SEXES)),
        "dq_blank_member_name": C.blank("member_name"),
        "dq_invalid_age_in_years": C.out_of_range("member_age_in_years", 0, 120),
    })
    return df.select("household_id", "submission_id", "member_index", "member_age_in_years", "member_name",
                     "member_sex", "member_had_diarrhoea_14d", "record_loaded_at", "batch_id",
                     "source_file", "is_deleted", *MEMBER_FLAGS)


def base_member(raw: DataFrame, accepted_households: DataFrame, accepted_submissions: DataFrame) -> DataFrame:
    return flags_member(dedupe_member(standardise_member(raw)), accepted_households, accepted_submissions)


def split_member(base: DataFrame) -> Split:
    # soft-deleted members are accepted as shipped (Q7)
    return quarantine(base, accept_flags=MEMBER_FLAGS, reject_flags=MEMBER_FLAGS)


# ----------------------------------------------------------- water point --
WATER_POINT_FLAGS = (
    "dq_missing_blank_water_point_id",
    "dq_missing_blank_submission_id",
    "dq_missing_ward_id",
    "dq_missing_blank_source_type",
    "dq_invalid_source_type",
    "dq_negative_distance_minutes",
    "dq_orphan_submission_id",
    "dq_missing_distance_minutes",
)

WATER_POINT_KEYS = ["water_point_id", "submission_id"]
WATER_POINT_TIE_BREAKERS = ("source_type", "distance_minutes", "water_source_functional", "ward_id")


def standardise_water_point(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim(F.col("water_point_id").try_cast("string")).alias("water_point_id"),
        F.trim(F.col("submission_id").try_cast("string")).alias("submission_id"),
        C.try_number("ward_id").alias("ward_id"),
        # a hard cast in the source, which fails there; here a value out of range is NULL and flagged
        F.col("distance_minutes").try_cast("decimal(10,2)").alias("distance_minutes"),
        F.col("gps_lat").try_cast("double").alias("gps_lat"),
        F.col("gps_lon").try_cast("double").alias("gps_lon"),
        C.canonical_text("source_type").alias("source_type"),
        C.try_boolean("functional").alias("water_source_functional"),
        *_audit_std(),
    )


def dedupe_water_point(df: DataFrame) -> DataFrame:
    return _latest(df, WATER_POINT_KEYS, WATER_POINT_TIE_BREAKERS)


def flags_water_point(df: DataFrame) -> DataFrame:
    """The flags of rows that have ``dq_orphan_submission_id``."""
    st, dist = F.col("source_type"), F.col("distance_minutes")
    df = df.withColumns({
        "dq_missing_blank_water_point_id": C.missing_or_blank("water_point_id"),
        "dq_missing_blank_submission_id": C.missing_or_blank("submission_id"),
        "dq_missing_ward_id": C.missing("ward_id"),
        "dq_missing_blank_source_type": C.missing_or_blank(st),
        "dq_invalid_source_type": st.isNotNull() & ~st.isin(list(WATER_SOURCES)),
        "dq_negative_distance_minutes": dist.isNotNull() & (dist < 0),
        "dq_missing_distance_minutes": dist.isNull(),
    })
    return df.select("water_point_id", "submission_id", "ward_id", "distance_minutes", "gps_lat", "gps_lon",
                     "source_type", "water_source_functional", "record_loaded_at", "batch_id",
                     "source_file", "is_deleted", *WATER_POINT_FLAGS)


def base_water_point(raw: DataFrame, accepted_submissions: DataFrame) -> DataFrame:
    df = standardise_water_point(raw)
    return flags_water_point(latest_with_orphan_flag(
        df, WATER_POINT_KEYS, LOAD_ORDER, _ties(df, WATER_POINT_KEYS, WATER_POINT_TIE_BREAKERS), "submission_id",
        accepted_submissions, "submission_id", "dq_orphan_submission_id", non_blank=True))


ACCEPTED_WATER_POINT_COLUMNS = (
    "water_point_id", "submission_id", "ward_id", "distance_minutes", "source_type",
    "water_source_functional", "record_loaded_at", "batch_id", "source_file", *WATER_POINT_FLAGS,
)
REJECTED_WATER_POINT_COLUMNS = (
    "water_point_id", "submission_id", "ward_id", "distance_minutes", "source_type",
    "water_source_functional", "record_loaded_at", "batch_id", "is_deleted", "source_file",
    *WATER_POINT_FLAGS,
)


def split_water_point(base: DataFrame) -> Split:
    # soft-deleted water points are accepted as shipped (Q7); outputs are narrower
    s = quarantine(base, accept_flags=WATER_POINT_FLAGS, reject_flags=WATER_POINT_FLAGS)
    return Split(s.accepted.select(*ACCEPTED_WATER_POINT_COLUMNS),
                 s.rejected.select(*REJECTED_WATER_POINT_COLUMNS),
                 s.limbo)


# ------------------------------------------------------------------ all ---
class Staged:
    """Staged bases and their splits, each staged on first use: what a caller
    does not read is not written."""

    def __init__(self, raw, materialize=None):
        self._m = materialize or (lambda d: d)
        self._raw = raw

    @cached_property
    def submission_base(self) -> DataFrame:
        return self._m(base_submission(self._raw.submissions))

    @cached_property
    def submission(self) -> Split:
        return split_submission(self.submission_base)

    @cached_property
    def household_base(self) -> DataFrame:
        return self._m(base_household(self._raw.households, self.submission.accepted))

    @cached_property
    def household(self) -> Split:
        return split_household(self.household_base)

    @cached_property
    def member_base(self) -> DataFrame:
        return self._m(base_member(self._raw.members, self.household.accepted, self.submission.accepted))

    @cached_property
    def member(self) -> Split:
        return split_member(self.member_base)

    @cached_property
    def water_point_base(self) -> DataFrame:
        return self._m(base_water_point(self._raw.water_points, self.submission.accepted))

    @cached_property
    def water_point(self) -> Split:
        return split_water_point(self.water_point_base)


def stage_all(raw, materialize=None) -> Staged:
    """Run staging for the four entities.

    ``materialize`` (DataFrame -> DataFrame) is applied to each base, e.g. a
    write to the shared folder, because each base is read by the accepted
    view, the rejected view and the monitors.
    """
    return Staged(raw, materialize)
