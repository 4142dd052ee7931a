"""Split a flagged base into accepted, rejected and limbo rows.

Accepted rows have every accept flag equal to false (and pass the extra
condition); rejected rows have any reject flag equal to true. Because the
flags are three-valued, a row with a NULL flag and no true flag is in
neither set: that is the ``limbo`` output, kept for audit.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import all_false, any_true


class Split(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame
    limbo: DataFrame


def accept_condition(accept_flags: Sequence[str], accept_extra: Column | None = None) -> Column:
    cond = all_false(accept_flags)
    return cond if accept_extra is None else (cond & accept_extra)


def quarantine(base: DataFrame, accept_flags: Sequence[str], reject_flags: Sequence[str] | None = None,
               accept_extra: Column | None = None) -> Split:
    reject_flags = list(accept_flags) if reject_flags is None else list(reject_flags)
    acc = accept_condition(accept_flags, accept_extra)
    rej = any_true(reject_flags)
    accepted = base.where(acc)
    rejected = base.where(rej)
    # neither: NOT coalesce(acc, false) AND NOT coalesce(rej, false), one pass
    limbo = base.where(~F.coalesce(acc, F.lit(False)) & ~F.coalesce(rej, F.lit(False)))
    return Split(accepted, rejected, limbo)
