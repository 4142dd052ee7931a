"""Merkle manifest of a dataset: one tree of row hashes per group, one tree of group roots.

H is the lowercase hex SHA-256 of its inputs one after another, digests as
their hex text. Rows of a group (null is a group of its own) are its leaves in
ascending order; every three consecutive nodes become their H, level by level,
until one node, the group's subroot, remains. The subroots in ascending order
of the group (null first, UTF-8 bytewise) give the root in the same way.

Nested-struct rollup: a leaf's rank is written in base three. Within blocks of
3**block_levels leaves its digit columns are grouped away one after another,
each grouping nesting the child structs in their parent's. A block's top node
is a leaf of the next tier, so a group of any size needs bounded structs only.
On the way down a block's struct and the path above it meet in one grouping on
(group, block); nested transforms walk the struct and an explode emits every
leaf with its proof. No join makes a proof. Ranks come from a range sort: the
positions in its partitions plus the partitions' running totals (one row a
partition) less the position of the group's first row.

Memory: one block's struct a row, whatever the size of a group. All steps are
DataFrame functions; every tier is a written table, so lost executors cost one
tier's task. Only the largest group's size comes to the driver.

Results: null fields hash as ``-``; an empty text as ``0:``. Rows of equal
order are placed by their hash, so repeated rows have equal leaves next to each
other, each with its own proof. An empty table has no rows. Very long texts are
hashed before the first shuffle and never move. Columns of the input keep their
names only in ``carry`` (of orderable types); a carried column named like the
result column is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.shared import Workspace

ARITY = 3


def encoded(col: str | Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(*fields: str | Column) -> Column:
    """H of the encoded fields."""
    return F.sha2(F.concat(*map(encoded, fields)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_hash(proof: Column) -> Column:
    """H of a proof's siblings."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _ranked(leaves: DataFrame, work: Workspace, name: str) -> DataFrame:
    """leaves(tree, ord, h, row) with rank, from 0, and n, the leaves of the tree."""
    order = [F.col(c).asc_nulls_first() for c in ("tree", "ord", "h")]
    placed = leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    placed = work.write(placed, f"{name}-sorted")
    part, at = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = placed.groupBy(part.alias("part")).agg(F.count("*").alias("held"))
    bases = bases.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    placed = placed.withColumn("part", part).join(F.broadcast(bases), "part").withColumn("at", F.col("base") + at)
    firsts = placed.groupBy(F.col("tree").alias("of")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    both = placed.join(firsts, F.col("tree").eqNullSafe(F.col("of")))
    return both.select("tree", "n", (F.col("at") - F.col("first")).alias("rank"), "h", "row")


def _rollup(nodes: DataFrame, levels: int) -> DataFrame:
    """(tree, n, block, h, kids): nodes(tree, n, rank, h, row) nested in blocks of ARITY**levels."""
    digits = [f"d{j}" for j in range(levels)]
    cols = [F.expr(f"rank div {ARITY**levels}").alias("block")]
    cols += [F.expr(f"cast(rank div {ARITY**j} % {ARITY} as int)").alias(d) for j, d in enumerate(digits)]
    out = nodes.select("tree", "n", *cols, "h", F.col("row").alias("below")).repartition("tree", "block")
    for j, digit in enumerate(digits):
        below = F.struct(F.col(digit).alias("d"), "h", "below")
        out = out.groupBy("tree", "n", "block", *digits[j + 1 :]).agg(F.sort_array(F.collect_list(below)).alias("below"))
        joined = F.sha2(F.array_join(F.transform("below", lambda k: k["h"]), ""), 256)
        out = out.withColumn("h", F.when(F.col("n") > ARITY**j, joined).otherwise(F.col("below")[0]["h"]))
    return out


def _walk(kids: Column, level: int, n: Column, path: Column) -> Column:
    """Array of (row, h, path) of the leaves under kids, the nodes of a level."""

    def one(kid: Column, i: Column) -> Column:
        left = F.array_join(F.transform(F.slice(kids, F.lit(1), i), lambda k: k["h"]), "")
        right = F.array_join(F.transform(F.slice(kids, i + 2, F.lit(ARITY)), lambda k: k["h"]), "")
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        down = F.when(n > ARITY**level, F.concat(step, path)).otherwise(path)
        if level:
            return _walk(kid["below"], level - 1, n, down)
        return F.struct(kid["below"].alias("row"), kid["h"].alias("h"), down.alias("path"))

    out = F.transform(kids, one)
    return F.flatten(out) if level else out


class _Tree:
    """Tiers of blocks over leaves(tree, ord, h, row); the last tier has one block a tree."""

    def __init__(self, leaves: DataFrame, work: Workspace, name: str, levels: int):
        self.levels = levels
        nodes = _ranked(leaves, work, name)
        most = None
        self.tiers: list[DataFrame] = []
        while most is None or most > 1:
            tier = work.write(_rollup(nodes, levels), f"{name}-{len(self.tiers)}")
            self.tiers.append(tier)
            size = F.expr(f"(n + {ARITY**levels - 1}) div {ARITY**levels}")
            most = tier.agg(F.max(size)).first()[0] or 0
            nodes = tier.select("tree", size.alias("n"), F.col("block").alias("rank"), "h", F.struct("block").alias("row"))

    @property
    def tops(self) -> DataFrame:
        return self.tiers[-1].select("tree", "h")

    def emit(self, above: DataFrame) -> DataFrame:
        """(row, h, up) of every leaf; above(tree, up): up.path is what lies over a tree's top."""
        above = above.select("tree", F.lit(0).cast("long").alias("block"), "up")
        for t in range(len(self.tiers) - 1, -1, -1):
            tier = self.tiers[t].select("tree", "block", F.struct("n", "below").alias("node"), F.lit(None).cast(above.schema["up"].dataType).alias("up"))
            down = above.select("tree", "block", F.lit(None).cast(tier.schema["node"].dataType).alias("node"), "up")
            met = tier.unionByName(down).groupBy("tree", "block").agg(F.first("node", True).alias("node"), F.first("up", True).alias("up"))
            leaves = _walk(F.col("node.below"), self.levels - 1, F.col("node.n"), F.col("up.path"))
            out = met.select("tree", "up", F.explode(leaves).alias("leaf"))
            up = F.col("up").withField("path", F.col("leaf.path"))
            above = out.select("tree", F.col("leaf.row.block").alias("block"), up.alias("up")) if t else out.select("leaf.row", "leaf.h", up.alias("up"))
        return above


def manifest(docs: DataFrame, leaf: Column, group: str = "source", order: str = "doc_id", carry: tuple[str | Column, ...] = ("doc_id",),
             out_col: str = "merkle", block_levels: int = 6) -> DataFrame:
    """The carried columns and out_col: struct(leaf, subroot, root, proof).

    proof is an array of (left, right), the concatenated siblings of each
    level from the leaf to the root; a level on which the node is alone in its
    run has two empty texts.
    """
    work = Workspace(docs.sparkSession, "merkle")
    flat = docs.select(F.col(group).alias("tree"), F.col(order).alias("ord"), leaf.alias("h"), F.struct(*carry).alias("row"))
    names = flat.schema["row"].dataType.names
    if out_col in names:
        raise ValueError(f"a carried column is named {out_col}")
    trees = _Tree(work.write(flat, "leaves"), work, "groups", block_levels)
    subroots = trees.tops.select(F.lit(0).alias("tree"), F.col("tree").alias("ord"), "h", F.struct("tree").alias("row"))
    top = _Tree(subroots, work, "root", block_levels)
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    roots = top.emit(top.tops.select("tree", F.struct(no_path.alias("path"), F.col("h").alias("root")).alias("up")))
    above = roots.select("row.tree", F.struct("up.path", F.col("h").alias("subroot"), "up.root").alias("up"))
    leaves = trees.emit(work.write(above, "above"))
    result = F.struct(F.col("h").alias("leaf"), "up.subroot", "up.root", F.col("up.path").alias("proof"))
    return leaves.select(*[F.col("row").getField(c).alias(c) for c in names], result.alias(out_col))


# The registered query's rows in DuckDB. The trees of sources (trees 1 and up, by order of source)
# and the tree of subroots (tree 0) are built level by level.
ORACLE_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, source, text,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
           || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
           || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
           || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head,
         list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
           lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, c: list_reduce(list_prepend(xor(crc, c), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
             lambda r, z: xor(r >> 1, (r & 1) * CAST(3988292384 AS BIGINT)))) AS crc
  FROM documents
), hashed AS (
  SELECT doc_id, source,
         sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         CASE WHEN xor(crc, CAST(4294967295 AS BIGINT)) % 2 = 0 AND text IS NOT NULL
              THEN sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''))
              ELSE sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) END AS shown
  FROM docs
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n
  FROM hashed
), low(tree, lvl, place, n, h) AS (
  SELECT tree, 0, place, n, leaf FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, place // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY place))
  FROM low WHERE n > 1 GROUP BY tree, lvl, place // 3
), subroots AS (
  SELECT tree, h, tree - 1 AS place, count(*) OVER () AS n, lvl AS height FROM low WHERE n = 1
), high(lvl, place, n, h) AS (
  SELECT 0, place, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, place // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY place))
  FROM high WHERE n > 1 GROUP BY lvl, place // 3
), nodes AS (
  SELECT tree, lvl, place, h FROM low WHERE n > 1
  UNION ALL SELECT 0, lvl, place, h FROM high WHERE n > 1
), steps AS (
  SELECT a.tree, a.lvl, a.place,
         coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.lvl = b.lvl AND a.place // 3 = b.place // 3
  GROUP BY ALL
), paths AS (
  SELECT v.tree, v.place, s.lvl AS k, s.l, s.r FROM leaves v
  JOIN steps s ON s.tree = v.tree AND s.place = v.place // CAST(pow(3, s.lvl) AS BIGINT)
  UNION ALL
  SELECT v.tree, v.place, t.height + s.lvl, s.l, s.r FROM leaves v JOIN subroots t ON t.tree = v.tree
  JOIN steps s ON s.tree = 0 AND s.place = t.place // CAST(pow(3, s.lvl) AS BIGINT)
), walks(tree, place, k, node) AS (
  SELECT tree, place, 0, shown FROM leaves
  UNION ALL
  SELECT w.tree, w.place, w.k + 1, sha256(p.l || w.node || p.r)
  FROM walks w JOIN paths p ON p.tree = w.tree AND p.place = w.place AND p.k = w.k
), ends AS (
  SELECT tree, place, max_by(node, k) AS node FROM walks GROUP BY ALL
), proofs AS (
  SELECT tree, place, sha256(string_agg(l || r, '' ORDER BY k)) AS proof_sha256 FROM paths GROUP BY ALL
)
SELECT v.doc_id, v.leaf, t.h AS subroot, (SELECT h FROM high WHERE n = 1) AS root,
       coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.node AS folded_root,
       e.node = (SELECT h FROM high WHERE n = 1) AS verified
FROM leaves v JOIN subroots t ON t.tree = v.tree
JOIN ends e ON e.tree = v.tree AND e.place = v.place
LEFT JOIN proofs p ON p.tree = v.tree AND p.place = v.place
"""
