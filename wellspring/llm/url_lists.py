"""URL filters: dated list entries as validity intervals, and an as-of join over captures.

A list's entries are dated changes (add or remove) of values of three kinds:
``domain`` (the host or any host below it), ``host`` (exactly it) and
``prefix`` (host and leading path segments). Changes become half-open intervals
[valid_from, valid_to). Every capture is held against the entries that were
active when it was fetched: its host's suffixes, its host and its path prefixes
are joined with the intervals by value, on the interval holding the fetch time.
The active entry of the longest value decides, allow before block on a tie.

The join evaluates each different (url, fetch time) once and deals every value
over ``salts`` tasks, so a host with a third of all captures is no hot key. The
sizes of both sides are left to Spark, which broadcasts a list only when its
statistics bound it.

Defined results: a null url, or one without a valid host (at most 253
characters), is "no_host"; a null fetch time meets no entry; on one day, the
removal of an entry wins over its addition; changes without a date, value, kind
or action are no changes; repeated rows are judged alike and all stay; output
columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without port, user, final dot and leading www; null if there is none."""
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(F.lower(url), HOST, 1), r"\.$", ""), r"^www\.", "")
    return F.when((F.length(host) > 0) & (F.length(host) <= 253), host)


def intervals(changes: DataFrame) -> DataFrame:
    """(list, kind, value, valid_from, valid_to) of changes(list, kind, value, action, changed_at); valid_to null is open."""
    usable = F.col("changed_at").isNotNull() & F.col("value").isNotNull() & F.col("kind").isNotNull() & F.col("action").isin("add", "remove")
    days = changes.where(usable).groupBy("list", "kind", "value", "changed_at").agg(F.max(F.col("action") == "remove").alias("removed"))
    nxt = F.lead("changed_at").over(Window.partitionBy("list", "kind", "value").orderBy("changed_at"))
    return days.withColumn("valid_to", nxt).where(~F.col("removed")).select("list", "kind", "value", F.col("changed_at").alias("valid_from"), "valid_to")


def _keys(host: Column, path: Column, depth: int) -> Column:
    """All (kind, value) under which a capture can be listed."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value")))
    out = [suffixes, F.array(F.struct(F.lit("host").alias("kind"), host.alias("value")))]
    if depth:
        segments = F.filter(F.split(path, "/"), lambda s: s != "")
        many = F.least(F.size(segments), F.lit(depth))
        prefixes = F.transform(F.sequence(F.lit(1), many), lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")).alias("value")))
        out.append(F.when(many > 0, prefixes).otherwise(F.array().cast("array<struct<kind:string,value:string>>")))
    return F.concat(*out)


def evaluate(
    captures: DataFrame,
    changes: DataFrame,
    url_col: str = "url",
    fetched_col: str = "fetched_at",
    allow_list: str = "allow",
    salts: int = 8,
) -> DataFrame:
    """captures with verdict (allowed, blocked, unlisted, no_host), matched_list, matched_value and n_active."""
    active = intervals(changes)
    depth = active.where("kind = 'prefix'").agg(F.max(F.size(F.split("value", "/")) - 1)).first()[0] or 0
    fetches = captures.select(F.col(url_col).alias("_url"), F.col(fetched_col).alias("_fetched")).distinct()
    fetches = fetches.withColumn("_host", host_of(F.col("_url")))
    keyed = (
        fetches.where("_host is not null and _fetched is not null")
        .select("_url", "_fetched", F.explode(_keys(F.col("_host"), F.regexp_extract("_url", PATH, 1), int(depth))).alias("_k"))
        .select("_url", "_fetched", F.col("_k.kind").alias("kind"), F.col("_k.value").alias("value"))
        .withColumn("salt", F.pmod(F.xxhash64("_url", "_fetched"), F.lit(salts)).cast("int"))
    )
    dealt = active.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = keyed.join(dealt, ["kind", "value", "salt"]).where(
        (F.col("_fetched") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_fetched") < F.col("valid_to")))
    )
    rank = F.struct(F.length("value").alias("long"), (F.col("list") == allow_list).alias("allow"), F.col("list").alias("list"), F.col("value").alias("value"))
    best = hits.groupBy("_url", "_fetched").agg(F.max(rank).alias("_best"), F.count("*").alias("_n"))
    judged = fetches.join(best, ["_url", "_fetched"], "left").select(
        F.col("_url").alias("_u"), F.col("_fetched").alias("_f"), "_host", "_best", "_n"
    )
    base = [c for c in captures.columns if c not in ("verdict", "matched_list", "matched_value", "n_active")]
    out = captures.join(judged, captures[url_col].eqNullSafe(F.col("_u")) & captures[fetched_col].eqNullSafe(F.col("_f")))
    verdict = F.when(F.col("_host").isNull(), "no_host").when(F.col("_best").isNull(), "unlisted").when(F.col("_best.allow"), "allowed").otherwise("blocked")
    return out.select(
        *(captures[c] for c in base), verdict.alias("verdict"), F.col("_best.list").alias("matched_list"), F.col("_best.value").alias("matched_value"),
        F.coalesce("_n", F.lit(0)).alias("n_active"),
    )


def _number(value: str) -> str:
    return f"CAST(conv(substring(md5({value}), 1, 7), 16, 10) AS INT)"


def dated_changes(pages: DataFrame) -> DataFrame:
    """A dated block list and allow list over the hosts, domains and path prefixes of pages, set by hashes of the values."""
    hosts = pages.select(host_of(F.col("url")).alias("host"), F.filter(F.split(F.regexp_extract("url", PATH, 1), "/"), lambda s: s != "").alias("seg")).where("host is not null")
    values = (
        hosts.selectExpr("'host' AS kind", "host AS value")
        .unionByName(hosts.selectExpr("'domain' AS kind", "regexp_extract(host, '([^.]+[.][^.]+)$', 1) AS value"))
        .unionByName(hosts.where("size(seg) > 0").selectExpr("'prefix' AS kind", "concat(host, '/', seg[0]) AS value"))
        .where("value <> ''")
        .distinct()
        .withColumn("h", F.expr(_number("concat(kind, ':', value)")))
    )
    rows = values.selectExpr("kind", "value", "h", "CASE WHEN h % 3 = 0 THEN 'block' WHEN h % 5 = 1 THEN 'allow' END AS list").where("list is not null")
    day = "date_add(DATE'2024-01-01', {})"
    first, gone, again = "h % 500", "h % 500 + 20 + h % 170", "h % 500 + 60 + h % 170 + h % 190"
    added = rows.selectExpr("list", "kind", "value", "'add' AS action", f"{day.format(first)} AS changed_at")
    removed = rows.where("h % 7 < 4").selectExpr("list", "kind", "value", "'remove' AS action", f"{day.format(gone)} AS changed_at")
    back = rows.where("h % 7 < 2").selectExpr("list", "kind", "value", "'add' AS action", f"{day.format(again)} AS changed_at")
    return added.unionByName(removed).unionByName(back)


ORACLE_SQL = r"""
WITH c AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 730 AS INTEGER) AS fetched_at,
         CASE WHEN length(h) BETWEEN 1 AND 253 THEN h END AS host,
         list_filter(string_split(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS seg
  FROM (SELECT *, regexp_replace(regexp_replace(regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1), '\.$', ''), '^www\.', '') AS h FROM pages)),
v AS (
  SELECT kind, value, CAST('0x' || substr(md5(kind || ':' || value), 1, 7) AS BIGINT) AS h FROM (
    SELECT 'host' AS kind, host AS value FROM c WHERE host IS NOT NULL
    UNION SELECT 'domain', regexp_extract(host, '([^.]+[.][^.]+)$', 1) FROM c WHERE host IS NOT NULL
    UNION SELECT 'prefix', host || '/' || seg[1] FROM c WHERE host IS NOT NULL AND len(seg) > 0)
  WHERE value <> ''),
r AS (SELECT *, CASE WHEN h % 3 = 0 THEN 'block' WHEN h % 5 = 1 THEN 'allow' END AS list FROM v),
ch AS (
  SELECT list, kind, value, 'add' AS action, DATE '2024-01-01' + CAST(h % 500 AS INTEGER) AS changed_at FROM r WHERE list IS NOT NULL
  UNION ALL SELECT list, kind, value, 'remove', DATE '2024-01-01' + CAST(h % 500 + 20 + h % 170 AS INTEGER) FROM r WHERE list IS NOT NULL AND h % 7 < 4
  UNION ALL SELECT list, kind, value, 'add', DATE '2024-01-01' + CAST(h % 500 + 60 + h % 170 + h % 190 AS INTEGER) FROM r WHERE list IS NOT NULL AND h % 7 < 2),
d AS (SELECT list, kind, value, changed_at, bool_or(action = 'remove') AS removed FROM ch GROUP BY ALL),
i AS (SELECT *, lead(changed_at) OVER (PARTITION BY list, kind, value ORDER BY changed_at) AS upto FROM d),
k AS (
  SELECT DISTINCT url, fetched_at, kind, value FROM (
    SELECT url, fetched_at, 'host' AS kind, host AS value FROM c WHERE host IS NOT NULL
    UNION ALL SELECT url, fetched_at, 'domain', unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda n: array_to_string(string_split(host, '.')[n:], '.'))) FROM c WHERE host IS NOT NULL
    UNION ALL SELECT url, fetched_at, 'prefix', host || '/' || seg[1] FROM c WHERE host IS NOT NULL AND len(seg) > 0)),
hit AS (
  SELECT k.url, k.fetched_at, i.list, i.value FROM k JOIN i ON k.kind = i.kind AND k.value = i.value
  WHERE NOT i.removed AND k.fetched_at >= i.changed_at AND (i.upto IS NULL OR k.fetched_at < i.upto)),
best AS (
  SELECT url, fetched_at, count(*) OVER (PARTITION BY url, fetched_at) AS n, list, value,
         row_number() OVER (PARTITION BY url, fetched_at ORDER BY length(value) DESC, list = 'allow' DESC, list DESC, value DESC) AS rn
  FROM hit)
SELECT c.page_id, c.url, c.fetched_at,
       CASE WHEN c.host IS NULL THEN 'no_host' WHEN b.list IS NULL THEN 'unlisted' WHEN b.list = 'allow' THEN 'allowed' ELSE 'blocked' END AS verdict,
       b.list AS matched_list, b.value AS matched_value, coalesce(b.n, 0) AS n_active
FROM c LEFT JOIN best b ON b.rn = 1 AND b.url = c.url AND b.fetched_at = c.fetched_at
"""
