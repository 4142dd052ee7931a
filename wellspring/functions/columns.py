"""Column-level helpers: flag builders, exact ratios, audit columns.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen. Flags keep SQL three-valued logic:
nothing is wrapped in ``coalesce`` unless the source rule does so.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- flags ----
def missing(c: str | Column) -> Column:
    """True when NULL."""
    return col(c).isNull()


def blank(c: str | Column) -> Column:
    """True when trimmed text is empty; NULL stays NULL."""
    return F.trim(col(c)) == F.lit("")


def missing_or_blank(c: str | Column) -> Column:
    """True when NULL or blank (never NULL itself)."""
    return col(c).isNull() | blank(c)


def out_of_range(c: str | Column, lo, hi) -> Column:
    """``c < lo OR c > hi``; NULL when ``c`` is NULL."""
    x = col(c)
    return (x < F.lit(lo)) | (x > F.lit(hi))


def out_of_range_not_null(c: str | Column, lo, hi) -> Column:
    """``c IS NOT NULL AND (c < lo OR c > hi)``; never NULL."""
    x = col(c)
    return x.isNotNull() & ((x < F.lit(lo)) | (x > F.lit(hi)))


def present_not_in_set(c: str | Column, values: Iterable[str], non_blank: bool = False) -> Column:
    """``c IS NOT NULL [AND trim(c) <> ''] AND c NOT IN (values)``."""
    x = col(c)
    cond = x.isNotNull()
    if non_blank:
        cond = cond & (F.trim(x) != F.lit(""))
    return cond & ~x.isin(list(values))


def any_true(flags: Sequence[str | Column]) -> Column:
    """``f1 = true OR f2 = true ...`` (three-valued)."""
    out = None
    for f in flags:
        term = col(f) == F.lit(True)
        out = term if out is None else (out | term)
    return out if out is not None else F.lit(False)


def all_false(flags: Sequence[str | Column]) -> Column:
    """``f1 = false AND f2 = false ...`` (three-valued)."""
    out = None
    for f in flags:
        term = col(f) == F.lit(False)
        out = term if out is None else (out & term)
    return out if out is not None else F.lit(True)


# ------------------------------------------------------------ text / cast --
def canonical_text(c: str | Column) -> Column:
    """``lower(trim(try_cast(c as string)))``."""
    return F.lower(F.trim(col(c).try_cast("string")))


def try_number(c: str | Column) -> Column:
    """Whole number of a value or text, rounding half away from zero; NULL if it is none or over range."""
    return F.round(col(c).try_cast("decimal(38,9)")).try_cast("long")


def try_boolean(c: str | Column) -> Column:
    """Boolean of a value or text (true/t/yes/y/on/1 and their opposites, any case); NULL otherwise."""
    text = F.lower(F.trim(col(c).try_cast("string")))
    # coalesce stops at the first value, so the text is worked out once for all but "on", "off" and what is no boolean
    return F.coalesce(text.try_cast("boolean"), F.when(text.isin("on", "off"), text == "on"))


def tri_state(c: str | Column) -> Column:
    """Boolean-ish value to 'yes' / 'no' / 'unknown'."""
    b = try_boolean(c)
    return F.when(b == F.lit(True), "yes").when(b == F.lit(False), "no").otherwise("unknown")


def base_model_name(c: str | Column) -> Column:
    """``split(name, '__')[0]``: model name without its suffix."""
    return F.split(col(c), "__").getItem(0)


def iff(cond: str | Column, a, b) -> Column:
    """Two-way choice; a NULL condition takes the else branch."""
    return F.when(col(cond), a).otherwise(b)


# ----------------------------------------------------------------- ratios --
def safe_ratio(n: str | Column, d: str | Column, scale: int | None = None) -> Column:
    """``div0(n, d)`` optionally rounded half away from zero to ``scale`` digits.

    0 when ``d = 0``; NULL when either side is NULL. With a scale the value is
    computed exactly on integers, ``(n * 2 * 10^k + d) div (2 * d) / 10^k``,
    so it does not depend on how an engine rounds binary doubles. Inputs are
    non-negative integer counts.
    """
    n_, d_ = col(n).cast("long"), col(d).cast("long")
    if scale is None:
        ratio = n_.cast("double") / d_.cast("double")
    else:
        p = 10 ** scale
        q = int_div(n_ * F.lit(2 * p) + d_, d_ * F.lit(2))
        ratio = q.cast("double") / F.lit(float(p))
    return (F.when(n_.isNull() | d_.isNull(), F.lit(None).cast("double"))
            .when(d_ == 0, F.lit(0.0))
            .otherwise(ratio))


def int_div(a: Column, b: Column) -> Column:
    """Exact integral division ``a div b`` of non-negative longs."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def audit_columns(loaded_at: str | Column = "_loaded_at",
                  batch_id: str | Column = "_batch_id",
                  source_file: str | Column = "_source_file",
                  is_deleted: str | Column = "_is_deleted") -> list[Column]:
    """Lineage columns every raw table carries, with overridable inputs."""
    return [
        col(loaded_at).try_cast("timestamp_ntz").alias("_loaded_at"),
        col(batch_id).cast("string").alias("_batch_id"),
        col(source_file).cast("string").alias("_source_file"),
        try_boolean(is_deleted).alias("_is_deleted"),
    ]

