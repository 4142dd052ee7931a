"""First-run (full) build of the survey models from raw entity frames.

A first run has no incremental filters: every model is the whole result of
its query. Incremental runs over stored tables are in ``increment.py``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from ..functions.valuesets import SAFE_FILTERS_CODE, SAFE_SOURCES_CODE
from . import marts, staging


class Built:
    """The models of one build, each defined (and written by ``materialize``) on first use."""

    def __init__(self, raw, materialize=None, safe_sources=SAFE_SOURCES_CODE, safe_filters=SAFE_FILTERS_CODE):
        self._m = materialize or (lambda d: d)
        self._safe = (safe_sources, safe_filters)
        self.staged = staging.stage_all(raw, materialize)

    @cached_property
    def submitted(self) -> DataFrame:
        return staging.submitted_only(self.staged.submission.accepted)

    @cached_property
    def events(self) -> DataFrame:
        return self._m(marts.household_event(self.staged.household.accepted, self.submitted))

    @cached_property
    def rollup(self) -> DataFrame:
        # first run: every key is impacted, so the rollup needs no key filter
        return self._m(marts.member_rollup(self.staged.member.accepted))

    @cached_property
    def safe_inputs(self) -> DataFrame:
        return marts.safe_inputs(self.events, self.rollup)

    @cached_property
    def fact(self) -> DataFrame:
        return self._m(marts.fact_household_wash_event(self.safe_inputs, *self._safe))

    @cached_property
    def ward_day(self) -> DataFrame:
        return marts.ward_day(self.fact)


def build_full(raw, materialize=None, safe_sources=SAFE_SOURCES_CODE, safe_filters=SAFE_FILTERS_CODE) -> Built:
    """``materialize`` writes bases and marts, which have many readers."""
    return Built(raw, materialize, safe_sources, safe_filters)
