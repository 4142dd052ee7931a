"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct k-word shingles (fewer words: the whole
sequence as one; no words: empty, linked with nothing). Two documents link when
100 * intersection >= threshold * union. The result has one row per document
with its component under these links.

Order. One pass counts shingles into a sketch of 2**sketch_bits counters, which
is summed over the cluster and broadcast compressed (at most 16 bits each). All documents order their
shingles by the class of the sketched frequency, then by hash, so that rare ones
come first. The order only has to be the same everywhere to be correct.

Prefixes. A set of n shingles overlaps each partner in at least ceil(t*n). If
its first n - ceil(t*n) + m shingles are indexed, partners share at least m of
them. Each document chooses m (1 to max_match) with the least estimated cost:
the sketched lengths of the lists its longer prefix meets, plus verification of
the candidates that m matches leave. Two documents become candidates when they
share min(m1, m2) prefix shingles and the place of the first one they share
leaves room for enough overlap.

Groups. Documents of equal sets are one vertex. In each round every long list
proposes only links between its pivot and members of other components, which
are verified on the whole sets and merged; large groups of near copies collapse
without their pairs being listed. After the rounds, all remaining candidate
pairs between different components are listed, without their sets; each set
tries one partner at a time for some rounds, and then all pairs still between
different components are verified, so no link between components is lost. Rounds end when no pair is left. There is no cap on lists,
candidates or partners. Whole
sets are made again from the texts, for those documents alone that some
candidate pair can have.

Defined results: null or blank texts have n_shingles 0 and their own id as
component; repeated rows fall into one component; a null id never becomes a
component id if another member has one. Vertices and shingles are 64-bit
hashes; two given ones collide with a chance of 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm import words as W
from wellspring.llm.components import components
from wellspring.llm.shared import Workspace

_CHUNK = 1 << 16
_MOST = (1 << 16) - 1
_PART_NAMES = ["id", "text_hash", "n_shingles", "sig", "chunk", "counts"]
_MEMBER = ("sig", "n", "matches", "pos", "tail")


@dataclass(frozen=True)
class JoinParams:
    """threshold: Jaccard similarity in hundredths. split_rows: an estimated list length from which a shingle is dealt over many tasks.
    star_from: a list length from which a list proposes pairs with pivots before all its pairs."""

    k: int = 5
    threshold: int = 75
    max_match: int = 4
    sketch_bits: int = 24
    rounds: int = 3
    split_rows: int = 4096
    star_from: int = 64


def _sets(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each row in ascending order, row offsets)."""
    data, offs = W.text_bytes(col)
    words = W.find_words(data, offs)
    value, _, row = W.windows(W.hash_spans(data, words.start, words.end, lower=True), words.split, k, whole_short=True)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    keep = np.ones(len(value), dtype=bool)
    keep[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[keep], row[keep]
    return value, np.searchsorted(row, np.arange(len(col) + 1))


def _signatures(value: np.ndarray, cut: np.ndarray) -> np.ndarray:
    total = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(W.mix(value), out=total[1:])
    return W.mix(total[cut[1:]] - total[cut[:-1]] + np.diff(cut).astype(np.uint64)).view(np.int64)


def _signed_and_counted(docs: DataFrame, id_col: str, text_col: str, p: JoinParams) -> DataFrame:
    """Rows of documents (id, n_shingles, sig) and, with chunk set, rows of each task's shingle counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << p.sketch_bits, dtype=np.uint16)
        seen = False
        for batch in batches:
            for part in W.slices(batch, text_col):
                seen, n = True, part.num_rows
                value, cut = _sets(part.column(text_col), p.k)
                at, more = np.unique(value >> np.uint64(64 - p.sketch_bits), return_counts=True)
                counts[at] = np.minimum(counts[at] + more, _MOST)
                size = np.diff(cut)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(id_col),
                        part.column("text_hash"),
                        pa.array(size),
                        pa.array(_signatures(value, cut), mask=size == 0),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    names=_PART_NAMES,
                )
        if seen:
            step = min(_CHUNK, len(counts))
            chunks = [pa.compress(counts[i : i + step].tobytes(), codec="zstd", asbytes=True) for i in range(0, len(counts), step)]
            m = len(chunks)
            none = [pa.nulls(m, kind) for kind in (id_type, pa.int64(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(range(m), pa.int32()), pa.array(chunks, pa.binary())], names=_PART_NAMES)

    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    return docs.select(id_col, text_col, F.xxhash64(text_col).alias("text_hash")).mapInArrow(
        run, f"id {kind.simpleString()}, text_hash long, n_shingles long, sig long, chunk int, counts binary"
    )


def _sketch(parts: DataFrame, p: JoinParams) -> tuple[dict[int, bytes], float]:
    """Counters of the whole corpus in compressed chunks, and their median: chunks are dealt over tasks and added up as they stream in."""
    size = 2 * min(_CHUNK, 1 << p.sketch_bits)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                more = np.frombuffer(pa.decompress(counts, size, codec="zstd"), dtype=np.uint16)
                total[chunk] = total.get(chunk, 0) + more.astype(np.uint32)
        for chunk, counts in total.items():
            packed = pa.compress(np.minimum(counts, _MOST).astype(np.uint16).tobytes(), codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([packed])], names=["chunk", "counts"])

    summed = parts.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary")
    chunks: dict[int, bytes] = {}
    having = np.zeros(_MOST + 1, dtype=np.int64)  # counters of each value
    for chunk, counts in summed.toLocalIterator():
        chunks[chunk] = bytes(counts)
        having += np.bincount(np.frombuffer(pa.decompress(chunks[chunk], size, codec="zstd"), dtype=np.uint16), minlength=_MOST + 1)
    having[0] += (1 << p.sketch_bits) - having.sum()
    middle = [((1 << p.sketch_bits) - 1) // 2, (1 << p.sketch_bits) // 2]
    return chunks, float(np.searchsorted(np.cumsum(having), middle, side="right").mean())


def _counters(chunks: dict[int, bytes], p: JoinParams) -> np.ndarray:
    out = np.zeros(1 << p.sketch_bits, dtype=np.uint16)
    step = min(_CHUNK, len(out))
    for chunk, counts in chunks.items():
        out[chunk * step : (chunk + 1) * step] = np.frombuffer(pa.decompress(counts, 2 * step, codec="zstd"), dtype=np.uint16)
    return out


def choose_prefix(order_est: np.ndarray, n: int, p: JoinParams) -> tuple[int, int]:
    """(prefix length, matches) of least estimated cost, from list lengths in shingle order."""
    need = -(-p.threshold * n // 100)
    best = (np.inf, n - need + 1, 1)
    total = np.cumsum(order_est)
    for m in range(1, min(p.max_match, need) + 1):
        length = n - need + m
        lists = float(total[length - 1])
        cost = lists + lists / m * (n / 16)
        if cost < best[0]:
            best = (cost, length, m)
    return best[1], best[2]


def _index(docs: DataFrame, text_col: str, sketch: tuple[dict[int, bytes], float], p: JoinParams) -> DataFrame:
    """(token, sig, n, matches, pos, salt, hot): the prefix shingles of every non-empty document, pos in their order."""
    chunks, median = sketch
    noise = max(1.0, median)
    hot_from = max(p.split_rows, 8 * noise)
    shared = docs.sparkSession.sparkContext.broadcast(chunks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        est_all = _counters(shared.value, p)
        turn = 0
        for batch in batches:
            for part in W.slices(batch, text_col):
                value, cut = _sets(part.column(text_col), p.k)
                sig = _signatures(value, cut)
                est = est_all[value >> np.uint64(64 - p.sketch_bits)].astype(np.float32)
                rank = np.where(est > 2 * noise, np.log2(np.maximum(est / noise, 1)).astype(np.int8) + 1, 0)
                lists = np.maximum(est - noise, 0)
                picked, sizes, matches, places, salts, rows = [], [], [], [], [], []
                for i in range(part.num_rows):
                    lo, hi = cut[i], cut[i + 1]
                    if lo == hi:
                        continue
                    order = np.argsort(rank[lo:hi], kind="stable")
                    length, m = choose_prefix(lists[lo:hi][order], hi - lo, p)
                    picked.append(lo + order[:length])
                    rows.append(np.full(length, i))
                    sizes.append(np.full(length, hi - lo))
                    matches.append(np.full(length, m))
                    places.append(np.arange(length))
                    salts.append(np.full(length, turn & 63))
                    turn += 1
                if not picked:
                    continue
                at = np.concatenate(picked)
                hot = est[at] > hot_from
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value[at].view(np.int64)),
                        pa.array(sig[np.concatenate(rows)]),
                        pa.array(np.concatenate(sizes).astype(np.int32)),
                        pa.array(np.concatenate(matches).astype(np.int8)),
                        pa.array(np.concatenate(places).astype(np.int32)),
                        pa.array(np.where(hot, np.concatenate(salts), 0).astype(np.int8)),
                        pa.array(hot),
                    ],
                    names=["token", "sig", "n", "matches", "pos", "salt", "hot"],
                )

    return docs.select(text_col).mapInArrow(run, "token long, sig long, n int, matches byte, pos int, salt byte, hot boolean")


def _whole_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, p: JoinParams) -> DataFrame:
    """(sig, shingles) of the wanted(id, text_hash, sig) documents, null ids included; shingles are sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text_col):
                value, cut = _sets(part.column(text_col), p.k)
                right = np.flatnonzero(_signatures(value, cut) == part.column("sig").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [part.column("sig").take(pa.array(right)), pa.array([value[cut[i] : cut[i + 1]].tobytes() for i in right], pa.binary())],
                    names=["sig", "shingles"],
                )

    own = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias(text_col), F.xxhash64(text_col).alias("__hash"))
    rows = own.join(wanted, F.col("__hash").eqNullSafe(F.col("text_hash")) & F.col("__id").eqNullSafe(F.col("id")))
    sets = rows.select("sig", text_col).mapInArrow(run, "sig long, shingles binary")
    return sets.groupBy("sig").agg(F.first("shingles").alias("shingles"))  # repeated rows of one id and text give one set


def _verified(pairs: DataFrame, sets: DataFrame, p: JoinParams) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                u, v = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                if len(u) > len(v):
                    u, v = v, u
                at = np.searchsorted(v, u)
                both = int((v[np.minimum(at, len(v) - 1)] == u).sum())
                keep.append(100 * both >= p.threshold * (len(u) + len(v) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.select(F.col("sig").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("sig").alias("b"), F.col("shingles").alias("y")), "b"
    )
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _sizes_fit(a: str, b: str, p: JoinParams) -> F.Column:
    return 100 * F.least(a, b) >= p.threshold * F.greatest(a, b)


def _merged(comp: DataFrame, links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """comp(sig, comp) after joining the components of linked vertices; the same table if nothing is linked."""
    if links.isEmpty():
        return comp
    named = links.join(comp.select(F.col("sig").alias("a"), F.col("comp").alias("ca")), "a").join(
        comp.select(F.col("sig").alias("b"), F.col("comp").alias("cb")), "b"
    )
    roots = components(named.select(F.col("ca").alias("a"), F.col("cb").alias("b")), work, f"{name}-star")
    out = comp.join(roots, comp.comp == roots.node, "left").select("sig", F.coalesce("root", "comp").alias("comp"))
    return work.write(out, f"{name}-comp")


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: JoinParams = JoinParams()) -> DataFrame:
    """(id_col, n_shingles, component_id) for every row of docs."""
    p, spark = params, docs.sparkSession
    work = Workspace(spark, "ngram-join")
    parts = work.write(_signed_and_counted(docs, id_col, text_col, p), "parts")
    signed = parts.where("chunk is null").select("id", "text_hash", "n_shingles", "sig")

    _write_lists(docs, text_col, _sketch(parts, p), p, work)
    lists = work.read("lists")
    # one row of each set: the least id, nulls last
    first = signed.where("sig is not null").groupBy("sig").agg(F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("row"))
    first = first.select("sig", "row.id", "row.text_hash")
    work.write(_whole_sets(docs, _wanted(lists, p).join(first, "sig"), id_col, text_col, p), "sets")
    work.settle()
    sets = work.read("sets")
    comp = work.write(sets.select("sig").distinct().withColumn("comp", F.col("sig")), "comp")

    for r in range(p.rounds):
        links = work.write(_verified(_star_pairs(lists, comp, r, p), sets, p), f"links-{r}")
        comp = _merged(comp, links, work, f"round-{r}")
        work.settle()

    pairs = work.write(_remaining_pairs(lists, comp, p, work), "pairs-0")
    for r in range(p.rounds + 1):
        if pairs.isEmpty():
            break
        # one partner of each set first, then, between components that are left, all pairs
        one = F.min(F.struct(F.xxhash64("a", "b", F.lit(r)).alias("h"), "a")).getField("a").alias("a")
        tried = pairs.groupBy("b").agg(one) if r < p.rounds else pairs
        tried = work.write(tried.select("a", "b"), f"tried-{r}")
        links = work.write(_verified(tried, sets, p), f"pair-links-{r}")
        comp = _merged(comp, links, work, f"pairs-{r}")
        work.settle()
        if r < p.rounds:
            left = pairs.join(tried, ["a", "b"], "left_anti").join(comp.select(F.col("sig").alias("a"), F.col("comp").alias("ca")), "a")
            left = left.join(comp.select(F.col("sig").alias("b"), F.col("comp").alias("cb")), "b").where("ca <> cb")
            pairs = work.write(left.select("a", "b"), f"pairs-{r + 1}")
    work.drop("lists", "sets", "named")

    first = first.join(comp, "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    least = first.groupBy("comp").agg(F.min("id").alias("component_id"))
    named = first.select("sig", "comp").join(least, "comp").select("sig", "component_id")
    return signed.join(named, "sig", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id")
    )


def _write_lists(docs: DataFrame, text_col: str, sketch: tuple[dict[int, bytes], float], p: JoinParams, work: Workspace) -> None:
    """Table ``lists``: (token, sig, n, matches, pos, df, tail) of the prefix shingles that several sets have.

    tail: how many shingles of the set stand from its first one with a long
    list on; null if it has none. Sets that share long lists alone can't have
    more in common than the smaller of their tails.
    """
    index = _index(docs, text_col, sketch, p)
    met = index.withColumn("c", F.count("*").over(Window.partitionBy("token", "salt"))).where("c > 1 or hot")
    met = work.write(met.select("token", "sig", "n", "matches", "pos").distinct(), "met")
    work.settle()
    several = met.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    lists = work.write(met.join(several, "token"), "counted")
    tails = lists.where(F.col("df") > p.star_from).groupBy("sig").agg((F.first("n") - F.min("pos")).alias("tail"))
    work.write(lists.join(tails, "sig", "left"), "lists")
    work.drop("met", "counted")


def _wanted(lists: DataFrame, p: JoinParams) -> DataFrame:
    """(sig) of all sets that any candidate pair can have.

    Pairs of lists up to ``star_from`` are few and counted here; every set with
    a longer list is wanted, so that those lists' pairs need no counting.
    """
    long = lists.where(F.col("tail").isNotNull()).select("sig")
    one, two = (lists.where(F.col("df") <= p.star_from).select("token", *(F.col(c).alias(f"{c}_{s}") for c in _MEMBER)) for s in "ab")
    pairs = _enough(one.join(two, "token").where((F.col("sig_a") < F.col("sig_b")) & _sizes_fit("n_a", "n_b", p)), p)
    return long.unionByName(pairs.select(F.explode(F.array("a", "b")).alias("sig"))).distinct()


def _overlap_fits(most: F.Column, n_a: str | F.Column, n_b: str | F.Column, p: JoinParams) -> F.Column:
    """Whether sets of these sizes with at most so much in common can be similar enough."""
    size = (F.col(n_a) if isinstance(n_a, str) else n_a) + (F.col(n_b) if isinstance(n_b, str) else n_b)
    return (100 + p.threshold) * most >= p.threshold * size


def _enough(met: DataFrame, p: JoinParams) -> DataFrame:
    """Candidate pairs (a, b) among the shared prefix shingles.

    A pair must share as many as the set with fewer matches asks for. Where it
    has long lists that were not listed (tails too small), what they share
    there is unknown and one shared shingle is enough. In both cases the first
    one they share (the order is the same for all sets) bounds their overlap.
    So does, where all is listed, what they do not share: of the two prefixes
    the one that ends first in the order has no shingle in common with the
    other set but the shared ones, so at most those and the shingles after that
    prefix are in common.
    """
    after = F.greatest(*(F.expr(f"(first(n_{s}) * {p.threshold} + 99) div 100 - first(matches_{s})") for s in "ab"))
    tails = F.least(F.first("tail_a"), F.first("tail_b"))
    listed = F.first("tail_a").isNull() | F.first("tail_b").isNull() | _overlap_fits(tails, F.first("n_a"), F.first("n_b"), p)
    pairs = met.groupBy(F.col("sig_a").alias("a"), F.col("sig_b").alias("b")).agg(
        F.count("*").alias("shared"),
        F.when(listed, F.least(F.first("matches_a"), F.first("matches_b"))).otherwise(1).alias("need"),
        F.least(
            F.first("n_a") - F.min("pos_a"), F.first("n_b") - F.min("pos_b"), F.when(listed, after + F.count("*"))
        ).alias("most"),
        F.first("n_a").alias("n_a"),
        F.first("n_b").alias("n_b"),
    )
    return pairs.where((F.col("shared") >= F.col("need")) & _overlap_fits(F.col("most"), "n_a", "n_b", p)).select("a", "b")


def _star_pairs(lists: DataFrame, comp: DataFrame, r: int, p: JoinParams) -> DataFrame:
    """Pairs of each long list's pivot with members of other components, where their tails allow enough in common.

    Every list has its own pivot in every round. Members of a group of near
    copies meet in many lists, so each is tried with many others, also where
    only a small share of the group's pairs are links.
    """
    named = lists.where(F.col("df") > p.star_from).join(comp, "sig")
    pivot = named.groupBy("token").agg(
        F.min(F.struct(F.xxhash64("sig", "token", F.lit(r)).alias("h"), "sig", "n", "tail", "comp")).alias("p"),
        F.min("comp").alias("lo"),
        F.max("comp").alias("hi"),
    )
    fits = _sizes_fit("n", "p.n", p) & _overlap_fits(F.least("tail", "p.tail"), "n", "p.n", p)
    star = named.join(pivot.where("lo < hi"), "token").where((F.col("p.comp") != F.col("comp")) & fits)
    return star.select(F.least("sig", "p.sig").alias("a"), F.greatest("sig", "p.sig").alias("b")).distinct()


def _remaining_pairs(lists: DataFrame, comp: DataFrame, p: JoinParams, work: Workspace) -> DataFrame:
    """All candidate pairs between different components, from the components that meet in each list.

    In long lists only those meet whose tails allow enough in common; other
    pairs share a shingle of a short list too, or are not similar.
    """
    named = work.write(lists.join(comp, "sig").withColumn("long", F.col("df") > p.star_from), "named")
    sides = named.groupBy("token", "long", "comp").agg(F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.max("tail").alias("tail"))
    left, right = (sides.select("token", "long", *(F.col(c).alias(f"{c}_{s}") for c in ("comp", "least_n", "most_n", "tail"))) for s in "ab")
    apart = left.join(right.drop("long"), "token").where(
        (F.col("comp_a") < F.col("comp_b"))
        & (100 * F.col("most_n_a") >= p.threshold * F.col("least_n_b"))
        & (100 * F.col("most_n_b") >= p.threshold * F.col("least_n_a"))
        & (~F.col("long") | _overlap_fits(F.least("tail_a", "tail_b"), "least_n_a", "least_n_b", p))
    )
    one, two = (named.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("comp", *_MEMBER))) for s in "ab")
    met = _first_members(apart, one, p).join(two, ["token", "comp_b"])
    fits = ~F.col("long") | _overlap_fits(F.least("tail_a", "tail_b"), "n_a", "n_b", p)
    return _enough(met.where(_sizes_fit("n_a", "n_b", p) & fits), p)


def _first_members(apart: DataFrame, one: DataFrame, p: JoinParams) -> DataFrame:
    """The lists' members of each comp_a that, by size and tail, some member of comp_b may be similar to.

    Next to a component of one set this is the bound of the pair itself, so a
    large component does not bring all its members to every set it meets.
    """
    others = apart.select("token", "long", "comp_a", "comp_b", "least_n_b", "most_n_b", F.col("tail_b").alias("most_tail_b"))
    fits = (100 * F.col("n_a") >= p.threshold * F.col("least_n_b")) & (100 * F.col("most_n_b") >= p.threshold * F.col("n_a"))
    fits &= ~F.col("long") | _overlap_fits(F.least("tail_a", "most_tail_b"), "n_a", "least_n_b", p)
    return others.join(one, ["token", "comp_a"]).where(fits).drop("least_n_b", "most_n_b", "most_tail_b")
