"""The six survey monitors and source freshness, built from staged frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import valuesets as V
from ..functions.columns import any_true
from ..operators import monitoring as M
from .staging import HOUSEHOLD_FLAGS, MEMBER_FLAGS, SUBMISSION_FLAGS, WATER_POINT_FLAGS, Staged

# Reason ladders, first match wins (NULL counts as not true): (bucket, flags OR-ed).
SUBMISSION_LADDER = (
    ("missing_keys", ("dq_missing_submission_id",)),
    ("invalid_required_field", ("dq_submitted_missing_submitted_at",)),
    ("invalid_range", ("dq_invalid_gps",)),
    ("soft_deleted", ("is_deleted",)),
)
HOUSEHOLD_LADDER = (
    ("missing_keys", ("dq_missing_blank_household_id", "dq_missing_blank_submission_id")),
    ("orphan_fk", ("dq_orphan_submission_id",)),
    ("invalid_canonical", ("dq_invalid_water_filter_type", "dq_invalid_primary_water_source")),
    ("invalid_range", ("dq_invalid_hh_size",)),
    ("unknown_other", ("dq_unknown_other_filter_type", "dq_unknown_other_primary_water_source")),
    ("soft_deleted", ("is_deleted",)),
)
MEMBER_LADDER = (
    ("missing_keys", ("dq_missing_household_id", "dq_missing_submission_id", "dq_missing_member_index")),
    ("orphan_fk", ("dq_orphan_household_id", "dq_orphan_submission_id")),
    ("invalid_canonical", ("dq_invalid_member_sex",)),
    ("invalid_range", ("dq_invalid_age_in_years",)),
    ("unknown_other", ("dq_blank_member_name",)),
    ("soft_deleted", ("is_deleted",)),
)
WATER_POINT_LADDER = (
    ("missing_keys", ("dq_missing_blank_water_point_id", "dq_missing_blank_submission_id")),
    ("orphan_fk", ("dq_orphan_submission_id",)),
    ("invalid_canonical", ("dq_missing_blank_source_type",)),
    ("invalid_range", ("dq_negative_distance_minutes",)),
    ("soft_deleted", ("is_deleted",)),
)


def ladder(spec) -> list:
    """(bucket, flag names) -> (bucket, OR of the flags) with SQL three-valued OR."""
    out = []
    for bucket, flags in spec:
        cond = None
        for f in flags:
            cond = F.col(f) if cond is None else (cond | F.col(f))
        out.append((bucket, cond))
    return out


def total_by_model_day(st: Staged) -> DataFrame:
    return M.count_by_model_day({
        f"{V.MODEL_SUBMISSION}__base": st.submission_base,
        f"{V.MODEL_HOUSEHOLD}__base": st.household_base,
        f"{V.MODEL_MEMBER}__base": st.member_base,
        f"{V.MODEL_WATER_POINT}__base": st.water_point_base,
    }, "base_row_count")


def rejections_by_model_day(st: Staged) -> DataFrame:
    return M.count_by_model_day({
        f"{V.MODEL_SUBMISSION}__rejected": st.submission.rejected,
        f"{V.MODEL_HOUSEHOLD}__rejected": st.household.rejected,
        f"{V.MODEL_MEMBER}__rejected": st.member.rejected,
        f"{V.MODEL_WATER_POINT}__rejected": st.water_point.rejected,
    }, "rejected_row_count")


def rejection_rate_day(st: Staged) -> DataFrame:
    """One pass over each base; ``rejection_rate_join`` is the same from the two count tables."""
    return M.rejection_rate_by_day({
        f"{V.MODEL_SUBMISSION}__base": (st.submission_base, any_true(SUBMISSION_FLAGS + ("is_deleted",))),
        f"{V.MODEL_HOUSEHOLD}__base": (st.household_base, any_true(("is_deleted",) + HOUSEHOLD_FLAGS)),
        f"{V.MODEL_MEMBER}__base": (st.member_base, any_true(MEMBER_FLAGS)),
        f"{V.MODEL_WATER_POINT}__base": (st.water_point_base, any_true(WATER_POINT_FLAGS)),
    })


def rejection_rate_join(total: DataFrame, rejections: DataFrame) -> DataFrame:
    return M.rejection_rate(total, rejections)


def rejection_by_reason_day(st: Staged) -> DataFrame:
    return M.reason_counts({
        f"{V.MODEL_SUBMISSION}__rejected": (st.submission.rejected, ladder(SUBMISSION_LADDER)),
        f"{V.MODEL_HOUSEHOLD}__rejected": (st.household.rejected, ladder(HOUSEHOLD_LADDER)),
        f"{V.MODEL_MEMBER}__rejected": (st.member.rejected, ladder(MEMBER_LADDER)),
        f"{V.MODEL_WATER_POINT}__rejected": (st.water_point.rejected, ladder(WATER_POINT_LADDER)),
    })


def unknown_diarrhoea_rate_ward_day(fact: DataFrame) -> DataFrame:
    return M.unknown_rate(fact)


def late_arrival_rate_ward_day(submitted: DataFrame) -> DataFrame:
    return M.late_rate(submitted)


def source_freshness(raw, now: str) -> DataFrame:
    warn, err = V.FRESHNESS_SOURCE_HOURS
    return M.freshness({
        "raw_kobo_submission": raw.submissions,
        "raw_kobo_household": raw.households,
        "raw_kobo_member": raw.members,
        "raw_kobo_waterpoint": raw.water_points,
    }, "_loaded_at", now, warn, err)


def landing_freshness(landing: DataFrame, now: str) -> DataFrame:
    warn, err = V.FRESHNESS_LANDING_HOURS
    return M.freshness({"landing": landing}, "ingested_at", now, warn, err)


def ladder_column(spec):
    """The reason-bucket CASE column for a ladder spec."""
    return M.reason_bucket(ladder(spec))
