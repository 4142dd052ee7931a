"""Fixed value sets of the survey domain.

Fixed values: these must equal the source project's lists for results to
match. They are stated once here, in their natural order, and used as
parameters everywhere else.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
WATER_FILTER_TYPES = (
    "none", "boil", "candle", "chlorine", "sodis", "ceramic", "biosand",
    "cloth", "ro_uv", "other", "unknown",
)

WATER_SOURCES = (
    "piped_to_dwelling", "piped_to_yard_plot", "public_tap_standpipe",
    "tubewell_borehole", "protected_dug_well", "unprotected_dug_well",
    "protected_spring", "unprotected_spring", "rainwater", "tanker_truck_cart",
    "bottled_water", "surface_water", "other", "unknown",
)

MEMBER_SEXES = ("m", "f", "male", "female", "other", "unknown")

DIARRHOEA_STATES = ("yes", "no", "unknown")

SUBMISSION_STATUSES = ("submitted", "draft")

# Safe lists as the shipped code has them (quirks Q1, Q2).
SAFE_SOURCES_CODE = (
    "piped_to_dwelling", "piped_to_yard", "public_tap", "borehole",
    "protected_well", "protected_spring", "rainwater", "bottled",
)
SAFE_FILTERS_CODE = (
    "boil", "chlorine", "sodis", "ceramic", "biosand", "ro_uv", "candle",
)

# Safe lists as the data contract states them.
SAFE_SOURCES_CONTRACT = (
    "piped_to_dwelling", "piped_to_yard_plot", "public_tap_standpipe",
    "tubewell_borehole", "protected_dug_well", "protected_spring", "rainwater",
    "bottled_water",
)
SAFE_FILTERS_CONTRACT = (
    "boil", "chlorine", "sodis", "ceramic", "biosand", "ro_uv",
)

REASON_BUCKETS = (
    "missing_keys", "orphan_fk", "invalid_required_field", "invalid_canonical",
    "invalid_range", "unknown_other", "soft_deleted", "other",
)

FORM_ID = "wash_hh_v3"
FORM_VERSION = 3

# Base timestamp used when an incremental target is empty.
INCREMENTAL_BASE_TS = "2025-01-01 00:00:00"
# Open end of a validity window in as-of joins.
OPEN_END_TS = "9999-12-31 00:00:00"

LOAD_LOOKBACK_DAYS = 7
EVENT_LOOKBACK_DAYS = 30

# Freshness thresholds in hours: (warn, error).
FRESHNESS_SOURCE_HOURS = (5, 24)
FRESHNESS_LANDING_HOURS = (24, 48)

# Model names as they appear in the monitoring tables.
MODEL_SUBMISSION = "stg_kobo_submission"
MODEL_HOUSEHOLD = "stg_kobo_household"
MODEL_MEMBER = "stg_kobo_member"
MODEL_WATER_POINT = "stg_kobo_water_point"
# --- end of fixed values ----------------------------------------------------
