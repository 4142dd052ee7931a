"""Declarative data checks. Each ``expect_*`` returns the failing rows.

``run_expectations`` counts many checks in one scan per table and one shuffle
and applies severity and ``warn_if`` / ``error_if`` thresholds.
``store_failures`` keeps the failing rows of all row-level checks in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import PARQUET_CODEC
from .relational import union_all


def _where(df: DataFrame, where: str | Column | None) -> DataFrame:
    if where is None:
        return df
    return df.where(F.expr(where) if isinstance(where, str) else where)


def expect_not_null(df: DataFrame, column: str, where=None) -> DataFrame:
    return _where(df, where).where(F.col(column).isNull())


def expect_unique(df: DataFrame, column: str, where=None) -> DataFrame:
    """Duplicated non-NULL values with their counts."""
    d = _where(df, where).where(F.col(column).isNotNull())
    return d.groupBy(column).agg(F.count(F.lit(1)).cast("long").alias("n_records")) \
        .where(F.col("n_records") > 1)


def expect_unique_combination(df: DataFrame, columns: Sequence[str], where=None) -> DataFrame:
    """Duplicated key combinations (NULLs group together)."""
    return _where(df, where).groupBy(*columns).agg(F.count(F.lit(1)).cast("long").alias("n_records")) \
        .where(F.col("n_records") > 1)


def expect_accepted_values(df: DataFrame, column: str, values: Sequence, where=None) -> DataFrame:
    """Distinct values outside the set, with their counts (NULL passes)."""
    g = _where(df, where).groupBy(F.col(column).alias("value_field")) \
        .agg(F.count(F.lit(1)).cast("long").alias("n_records"))
    return g.where(~F.col("value_field").isin(list(values)))


def expect_relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str, where=None) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    child = _where(df, where).where(F.col(column).isNotNull())
    keys = parent.select(F.col(parent_column).alias("__parent_key")).where(F.col("__parent_key").isNotNull()) \
        .distinct()
    return child.join(keys, F.col(column) == F.col("__parent_key"), "left_anti")


def expect_expression(df: DataFrame, expression: str | Column, where=None) -> DataFrame:
    """Rows where the expression is false (a NULL result passes)."""
    e = F.expr(expression) if isinstance(expression, str) else expression
    return _where(df, where).where(~e)


@dataclass
class Check:
    name: str
    table: str
    kind: str  # not_null | unique | unique_combination | accepted_values | relationship | expression | custom
    args: dict = field(default_factory=dict)
    severity: str = "error"
    where: str | None = None
    warn_if: str = "!= 0"
    error_if: str = "!= 0"


def failing_rows(check: Check, frames: Mapping[str, DataFrame]) -> DataFrame:
    df = frames[check.table]
    a = check.args
    if check.kind == "not_null":
        return expect_not_null(df, a["column"], check.where)
    if check.kind == "unique":
        return expect_unique(df, a["column"], check.where)
    if check.kind == "unique_combination":
        return expect_unique_combination(df, a["columns"], check.where)
    if check.kind == "accepted_values":
        return expect_accepted_values(df, a["column"], a["values"], check.where)
    if check.kind == "relationship":
        return expect_relationship(df, a["column"], frames[a["to"]], a["field"], check.where)
    if check.kind == "expression":
        return expect_expression(df, a["expression"], check.where)
    if check.kind == "custom":
        return a["fn"](frames)
    raise ValueError(f"unknown check kind {check.kind}")


def _threshold(cond: str, n: Column) -> Column:
    op, _, v = cond.strip().partition(" ")
    v = int(v)
    return {"!=": n != v, ">": n > v, ">=": n >= v, "=": n == v, "<": n < v, "<=": n <= v}[op]


ROW_LEVEL = ("not_null", "expression")


def _violation(c: Check) -> Column:
    """Row-level predicate that is true exactly for a failing row of ``c``."""
    if c.kind == "not_null":
        bad = F.col(c.args["column"]).isNull()
    else:
        e = c.args["expression"]
        bad = ~(F.expr(e) if isinstance(e, str) else e)
    if c.where is not None:
        w = F.expr(c.where) if isinstance(c.where, str) else c.where
        bad = w & bad
    return bad


def _status(c: Check, n: Column) -> Column:
    err = _threshold(c.error_if, n) if c.severity == "error" else F.lit(False)
    return F.when(err, "error").when(_threshold(c.warn_if, n), "warn").otherwise("pass")


def _result(c: Check, failures: Column) -> Column:
    return F.struct(F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"),
                    F.lit(c.kind).alias("kind"), F.lit(c.severity).alias("severity"),
                    failures.cast("long").alias("failures"), _status(c, failures).alias("status"))


_KEYED = "struct<check:int,key:array<string>,parent:boolean>"


def _keyed(i: int, when: Column | None, key: Sequence[str] | None, parent: bool = False) -> Column:
    """The row's entry for check ``i``: its key where the check looks at the row, else NULL."""
    values = F.lit(None).cast("array<string>") if key is None else F.array(*[F.col(k).cast("string") for k in key])
    entry = F.struct(F.lit(i).alias("check"), values.alias("key"), F.lit(parent).alias("parent")).cast(_KEYED)
    return entry if when is None else F.when(when, entry)


def _both(a: Column | None, b: Column) -> Column:
    return b if a is None else a & b


def _entries(checks: Sequence[Check]) -> dict[str, list[Column]]:
    """For each table, the entries that one of its rows gives."""
    out: dict[str, list[Column]] = {}
    for i, c in enumerate(checks):
        own = out.setdefault(c.table, [])
        scope = (F.expr(c.where) if isinstance(c.where, str) else c.where) if c.where is not None else None
        if c.kind in ROW_LEVEL:
            own.append(_keyed(i, _violation(c), None))
        elif c.kind == "unique":
            own.append(_keyed(i, _both(scope, F.col(c.args["column"]).isNotNull()), [c.args["column"]]))
        elif c.kind == "unique_combination":
            own.append(_keyed(i, scope, c.args["columns"]))
        elif c.kind == "accepted_values":
            own.append(_keyed(i, _both(scope, ~F.col(c.args["column"]).isin(list(c.args["values"]))), [c.args["column"]]))
        elif c.kind == "relationship":
            own.append(_keyed(i, _both(scope, F.col(c.args["column"]).isNotNull()), [c.args["column"]]))
            parent = out.setdefault(c.args["to"], [])
            parent.append(_keyed(i, F.col(c.args["field"]).isNotNull(), [c.args["field"]], parent=True))
    return out


def count_failures(frames: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(check, failures) of the checks that fail, by position in ``checks``.

    Every table is scanned once: a row gives one entry for each check that
    looks at it (its key for uniqueness, accepted values and relationships, on
    the parent's side too; no key for a failing row-level check). One shuffle
    of all tables' entries, counted before it on the map side, brings equal
    keys of a check together. Failures are then duplicated keys, values outside
    the set, children without a parent, or rows.
    """
    parts = []
    for table, entries in _entries(checks).items():
        if entries:
            found = F.filter(F.array(*entries), lambda e: e.isNotNull())
            parts.append(frames[table].select(F.explode(found).alias("e")).select("e.*"))
    for i, c in enumerate(checks):
        if c.kind == "custom":
            parts.append(failing_rows(c, frames).select(_keyed(i, None, None).alias("e")).select("e.*"))
    by_key = union_all(parts).groupBy("check", "key").agg(
        F.count(F.when(~F.col("parent"), 1)).alias("n"), F.count(F.when(F.col("parent"), 1)).alias("parents"))
    ids = lambda *kinds: F.col("check").isin([i for i, c in enumerate(checks) if c.kind in kinds])
    failures = (F.when(ids("unique", "unique_combination"), (F.col("n") > 1).cast("long"))
                .when(ids("accepted_values"), F.lit(1).cast("long"))
                .when(ids("relationship"), F.when(F.col("parents") == 0, F.col("n")).otherwise(0))
                .otherwise(F.col("n")))
    return by_key.groupBy("check").agg(F.sum(failures).alias("failures"))


def run_expectations(frames: Mapping[str, DataFrame], checks: Sequence[Check], store: str | None = None) -> DataFrame:
    """One result row per check: name, table, kind, severity, failures, status.

    All checks are counted in one scan per table and one shuffle
    (``count_failures``). Severity ``error``: error when ``error_if`` holds,
    else warn when ``warn_if`` holds; severity ``warn``: warn when ``warn_if``
    holds. ``store`` keeps the failing rows of row-level checks
    (``store_failures``).
    """
    if store:
        store_failures(frames, checks, store)
    counts = count_failures(frames, checks)
    # one row: a map of at most as many entries as there are checks
    by_check = counts.agg(F.map_from_entries(F.collect_list(F.struct("check", "failures"))).alias("m"))
    rows = F.array(*[_result(c, F.coalesce(F.element_at("m", F.lit(i)), F.lit(0))) for i, c in enumerate(checks)])
    return by_check.select(F.inline(rows))


def store_failures(frames: Mapping[str, DataFrame], checks: Sequence[Check], root: str) -> dict[str, int]:
    """Keep the failing rows of all row-level checks; returns the failures by check name.

    One pass over each table: a row carries the names of the checks it fails,
    is exploded once and goes to ``root/<table>/check_name=<check>``. The same
    pass counts. A table whose rows all pass has an empty folder.
    """
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in ROW_LEVEL:
            by_table.setdefault(c.table, []).append(c)
    counted: dict[str, int] = {}
    for table, own in by_table.items():
        failed = F.filter(F.array(*[F.when(_violation(c), F.lit(c.name)) for c in own]), lambda name: name.isNotNull())
        seen = Observation(f"failures of {table}")
        rows = frames[table].withColumn("check_name", F.explode(failed))
        rows = rows.observe(seen, *[F.count_if(F.col("check_name") == c.name).alias(c.name) for c in own])
        rows.write.mode("overwrite").option("compression", PARQUET_CODEC).partitionBy("check_name").parquet(f"{root.rstrip('/')}/{table}")
        counted |= seen.get
    return counted


def read_failures(frames: Mapping[str, DataFrame], root: str, table: str) -> DataFrame:
    """The kept rows of a table with the name of the check they fail."""
    schema = frames[table].schema.add("check_name", "string")
    return frames[table].sparkSession.read.schema(schema).parquet(f"{root.rstrip('/')}/{table}")
