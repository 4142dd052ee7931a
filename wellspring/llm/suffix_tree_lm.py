"""Language-model scoring with a probabilistic suffix tree over words.

Tokens are lower-cased words and one end per text. A context is up to ``depth``
tokens, with a start mark before the first. A context is a candidate if it is
seen at least ``least_context`` times (the start mark always), and a
continuation is listed if it is seen at least ``least_edge`` times; these floors
are the same at every size of the corpus, so the tree grows with it. Floors as
shares of all training tokens (``context_share``, ``edge_share``) are off unless
asked for. All counts are exact and cover all training texts.

The tree is kept in Spark tables: counts are combined in the tasks, and a level
is joined with the one before. A longer sequence is counted only where its
shorter parts may be frequent enough, told from a filter of fixed size whose
false hits cost rows, never results. Most sequences are rare, so tasks combine
little; they hand them on as packed ranges of keys, one row for each of about
N / 2**19 ranges, and a range is summed in one piece. A range's size depends on
how many sequences it has, not on the corpus, and a frequent one is in it once
for each million tokens.

A candidate is retained if its next-token distribution diverges from its
parent's (the longest retained shorter suffix): Kullback-Leibler divergence of
at least ``divergence`` nats, and that times its count at least ``evidence``.

Smoothing: P(w|s) = (c(s,w) - d) / c(s) for listed continuations, plus the mass
left over times P(w|parent); the root is (c + 1) / (N + V + 1). Each
distribution sums to one. A token is scored from its longest retained suffix.

As logarithms this is a sum over a text's sequences of 1 to depth + 1 tokens:
a listed continuation gives what it adds to its suffix's, a retained context the
mass left over. At most ``_NEAR`` of the most counted of these gains are
broadcast; a row's other sequences meet theirs in a join.

Defined results: null and blank texts are one end token; rows with a null id
are scored and never learned from; without training texts N = V = 0 and every
token has probability 1; equal rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm import words as W
from wellspring.llm.shared import Workspace

_END, _START = np.uint64(0x5BD1E9955BD1E995), np.uint64(0x27D4EB2F165667C5)
_FACTOR, _LEVEL = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_HELD = 1_000_000
_NEAR = 1 << 20
_FILTER_WORDS = 1 << 21
_SLICES = 4
_RANGE_BITS = 19
_HEAD_BITS = 21


@dataclass(frozen=True)
class TreeParams:
    depth: int = 2
    context_share: float = 0.0
    edge_share: float = 0.0
    least_context: int = 8
    least_edge: int = 2
    discount: float = 0.75
    divergence: float = 0.01
    evidence: float = 12.0


def is_held_out(id_col: str, folds: int = 7, fold: int = 2) -> F.Column:
    """Rows whose crc32(id as text) leaves fold; a null id counts as one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


def _joined(context: np.ndarray, suffix: np.ndarray, level: int) -> np.ndarray:
    """Key of a sequence with level tokens before the last, from the keys of all but its last and all but its first."""
    return W.mix(context * _FACTOR + suffix + np.uint64(level) * _LEVEL)


@dataclass
class Tokens:
    """A chunk's tokens, row offsets, and each token's place in its row."""

    token: np.ndarray
    split: np.ndarray
    place: np.ndarray

    @staticmethod
    def of(col: pa.Array) -> Tokens:
        data, offs = W.text_bytes(col)
        words = W.find_words(data, offs)
        token = np.insert(W.hash_spans(data, words.start, words.end, lower=True), words.split[1:], _END)
        split = words.split + np.arange(len(words.split))
        return Tokens(token, split, np.arange(len(token)) - np.repeat(split[:-1], np.diff(split)))

    def sequences(self, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per level from 1: (level, last tokens that have that many tokens or the start before, context, suffix keys)."""
        key = self.token
        for level in range(1, depth + 1):
            at = np.flatnonzero(self.place >= level - 1)
            context = np.where(self.place[at] > 0, key[at - 1], _START) if level == 1 else key[at - 1]
            suffix = key[at]
            yield level, at, context, suffix
            key = np.zeros_like(key)
            key[at] = _joined(context, suffix, level)


def _heads(keys: np.ndarray) -> np.ndarray:
    """Where the sorted keys with each value of the first _HEAD_BITS bits start."""
    starts = np.arange(1 << _HEAD_BITS, dtype=np.uint64) << np.uint64(64 - _HEAD_BITS)
    return np.append(np.searchsorted(keys, starts), len(keys)).astype(np.int32)


def _find(keys: np.ndarray, heads: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key in the sorted keys, or -1."""
    out = np.full(len(wanted), -1)
    head = (wanted >> np.uint64(64 - _HEAD_BITS)).view(np.int64)
    at, end, left = heads[head], heads[head + 1], np.arange(len(wanted))
    while len(left):
        more = at < end
        at, end, left = at[more], end[more], left[more]
        same = keys[at] == wanted[left]
        out[left[same]] = at[same]
        at, end, left = at[~same] + 1, end[~same], left[~same]
    return out


def _key_filter(keys: DataFrame, key: str, work: Workspace) -> np.ndarray:
    """Bloom filter of fixed size: three bits in one of its words for each key."""
    bits = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned({key}, {n}) & 63 AS int))" for n in (40, 46, 52))
    words = keys.select(F.expr(f"{key} & {_FILTER_WORDS - 1}L").alias("word"), F.expr(bits).alias("bits"))
    got = work.write(words.groupBy("word").agg(F.bit_or("bits").alias("bits")), "filter").toArrow()
    work.drop("filter")
    out = np.zeros(_FILTER_WORDS, dtype=np.uint64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def _may_have(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = np.zeros(len(keys), dtype=np.uint64)
    for n in (40, 46, 52):
        bits |= np.uint64(1) << (keys >> np.uint64(n) & np.uint64(63))
    return words[(keys & np.uint64(_FILTER_WORDS - 1)).view(np.int64)] & bits == bits


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts the keys, where each different one starts in it)."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return order, np.flatnonzero(new)


class _Counter:
    """Counts of keys with their attributes, given out when many are held."""

    def __init__(self, names: list[str]):
        self.names, self.held, self.size = names, [], 0

    def add(self, key: np.ndarray, *cols: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((key, *cols))
        self.size += len(key)
        if self.size >= _HELD:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        key, *cols = [np.concatenate(x) for x in zip(*self.held)]
        order, starts = _runs(key)
        first, count = order[starts], np.diff(starts, append=len(key))
        self.held, self.size = [], 0
        return self.batch(key[first], count, [c[first] for c in cols])

    def batch(self, key: np.ndarray, count: np.ndarray, cols: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(c.view(np.int64)) for c in cols), pa.array(count)], names=[*self.names, "n"])


class _RangeCounter(_Counter):
    """Counts given out as one row for each range of keys, its columns packed."""

    def __init__(self, names: list[str], ranges: int):
        super().__init__(names)
        self.ranges = ranges

    def batch(self, key: np.ndarray, count: np.ndarray, cols: list[np.ndarray]) -> pa.RecordBatch:
        of = ((key >> np.uint64(32)) * np.uint64(self.ranges) >> np.uint64(32)).view(np.int64)  # ascending, as the keys are
        cut = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
        packed = [
            pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((cut * c.itemsize).astype(np.int32)), pa.py_buffer(c)])
            for c in (*cols, count.astype(np.int32))
        ]
        return pa.RecordBatch.from_arrays([pa.array(of[cut[:-1]]), *packed], names=["range", *self.names, "n"])


def _counting(texts: DataFrame, text_col: str, counter, keys_of, schema: str) -> DataFrame:
    """What each task's counter() gives out for the columns after the key that keys_of(Tokens) gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = counter()
        for batch in batches:
            for part in W.slices(batch, text_col):
                yield from held.add(*keys_of(Tokens.of(part.column(text_col))))
        if held.size:
            yield held.flush()

    return texts.select(text_col).mapInArrow(run, schema)


def _word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(key, n) of all tokens."""
    parts = _counting(texts, text_col, lambda: _Counter(["key"]), lambda t: (t.token, t.token), "key long, n long")
    return parts.groupBy("key").agg(F.sum("n").alias("n"))


def _sequence_counts(texts: DataFrame, text_col: str, level: int, keys_of, least: int, ranges: int) -> DataFrame:
    """(key, context, suffix, n) of the sequences seen at least so often."""

    def total(table: pa.Table) -> pa.Table:
        read = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)
        context, suffix, n = read("context", np.uint64), read("suffix", np.uint64), read("n", np.int32)
        key = _joined(context, suffix, level)
        order, starts = _runs(key)
        sums = np.add.reduceat(n[order].astype(np.int64), starts)
        keep = sums >= least
        at = order[starts[keep]]
        cols = [*(pa.array(c[at].view(np.int64)) for c in (key, context, suffix)), pa.array(sums[keep])]
        return pa.Table.from_arrays(cols, names=["key", "context", "suffix", "n"])

    names = ["context", "suffix"]
    parts = _counting(texts, text_col, lambda: _RangeCounter(names, ranges), keys_of, "range long, context binary, suffix binary, n binary")
    return parts.groupBy("range").applyInArrow(total, "key long, context long, suffix long, n long")


def _long(key: np.uint64) -> F.Column:
    return F.lit(int(key.view(np.int64)))


def _retained(edges: DataFrame, sizes: DataFrame, p: TreeParams) -> DataFrame:
    """(context, total, left) of the contexts that pass the tests; sizes: (context, total) of the candidates."""
    sums = edges.groupBy("context").agg(
        F.sum("n").alias("listed"),
        F.sum(F.col("n") - F.lit(p.discount)).alias("taken"),
        F.sum(F.col("n") * F.ln(F.col("n") / F.col("above"))).alias("gain"),
        F.sum("above").alias("above"),
    )
    rest = F.greatest(1 - F.col("listed") / F.col("total"), F.lit(0.0))
    rest_above = F.greatest(1 - F.col("above"), F.lit(1e-12))
    kl = F.col("gain") / F.col("total") - F.col("listed") / F.col("total") * F.ln("total")
    kl += F.when(rest > 0, rest * F.ln(rest / rest_above)).otherwise(0.0)
    tested = sums.join(sizes, "context").withColumn("kl", kl)
    kept = tested.where((F.col("kl") >= p.divergence) & (F.col("kl") * F.col("total") >= p.evidence))
    return kept.select("context", "total", (1 - F.col("taken") / F.col("total")).alias("left"))


@dataclass
class SuffixTree:
    """gains: (key, n, gain, base), what a sequence adds to log10 of score and base score, less a word's log10 1 / (N + V + 1); base is above 0 for words only; start: of the start mark."""

    gains: DataFrame
    n_tokens: int
    n_words: int
    start: float


def fit(texts: DataFrame, text_col: str, work: Workspace, params: TreeParams = TreeParams()) -> SuffixTree:
    p, spark = params, texts.sparkSession
    if p.depth < 0 or not 0 < p.discount <= 1:
        raise ValueError("depth must be 0 or more, discount above 0 and at most 1")
    counts = work.write(_word_counts(texts, text_col), "counts")
    total, distinct, texts_n = counts.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("key") == _long(_END), F.col("n")))).first()
    n_tokens = total or 0
    least_edge = max(p.least_edge, int(np.ceil(p.edge_share * n_tokens)))
    least_context = max(p.least_context, int(np.ceil(p.context_share * n_tokens)))

    log_n = F.log10(F.col("n") + 1)
    gains = counts.select("key", "n", log_n.alias("gain"), log_n.alias("base"))
    below = counts.where(F.col("n") >= least_edge).select("key", "n", ((F.col("n") + 1) / F.lit(float(n_tokens + distinct + 1))).alias("p"))
    start = 0.0
    for level in range(1, p.depth + 1):
        able = below.where(F.col("n") >= least_context).select(F.col("key").alias("context"), F.col("n").alias("total"))
        contexts, listed = _key_filter(able, "context", work), _key_filter(below, "key", work)
        if level == 1:
            able = able.union(spark.range(1).select(_long(_START), F.lit(texts_n or 0).cast("long")))
        shared = spark.sparkContext.broadcast((contexts, listed))

        def keys(t: Tokens, level=level, shared=shared) -> tuple[np.ndarray, ...]:
            contexts, listed = shared.value
            *_, (_, _, context, suffix) = t.sequences(level)
            ok = _may_have(contexts, context) & _may_have(listed, suffix) if level > 1 else ((context == _START) | _may_have(contexts, context)) & _may_have(listed, suffix)
            context, suffix = context[ok], suffix[ok]
            return _joined(context, suffix, level), context, suffix

        found = _sequence_counts(texts, text_col, level, keys, least_edge, (n_tokens >> _RANGE_BITS) + 1)
        found = found.join(below.select(F.col("key").alias("suffix"), F.col("p").alias("above")), "suffix")
        edges = work.write(found.select("key", "context", "n", "above"), f"edges{level}")
        shared.destroy()
        states = work.write(_retained(edges, able, p), f"states{level}")
        smooth = (F.col("n") - F.lit(p.discount)) / F.col("total") + F.col("left") * F.col("above")
        rise = F.log10(smooth) - F.log10("above") - F.log10("left")
        below = work.write(edges.join(states, "context", "left").select("key", "n", F.coalesce(smooth, "above").alias("p"), rise.alias("gain")), f"level{level}")
        work.drop(f"edges{level}")
        none = F.lit(0.0).alias("base")
        if level == 1:
            start = next((np.log10(r["left"]) for r in states.where(F.col("context") == _long(_START)).collect()), 0.0)
            states = states.where(F.col("context") != _long(_START))
        gains = gains.union(below.where(F.col("gain").isNotNull()).select("key", "n", "gain", none))
        gains = gains.union(states.select("context", "total", F.log10("left"), none))
    each = gains.groupBy("key").agg(F.max("n").alias("n"), *(F.sum(c).alias(c) for c in ("gain", "base")))
    tree = SuffixTree(work.write(each, "gains"), n_tokens, distinct, float(start))
    work.drop("counts", *(f"{x}{level}" for x in ("states", "level") for level in range(1, p.depth + 1)))
    return tree


def _near(gains: DataFrame) -> tuple[list[np.ndarray], DataFrame]:
    """Keys, their heads and the other columns of the most counted gains, at most _NEAR, and the table of the others."""
    size = F.least("n", F.lit(1 << 16))
    held = least = 0
    for r in sorted(gains.groupBy(size.alias("size")).count().collect(), reverse=True):
        held += r["count"]
        if held > _NEAR:
            least = r["size"] + 1
            break
    got = gains.where(size >= least).select("key", "gain", "base").toArrow()
    key = got.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    return [key[order], _heads(key[order]), *(got.column(c).to_numpy()[order] for c in ("gain", "base"))], gains.where(size < least)


def score(
    docs: DataFrame, learn_from: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: TreeParams = TreeParams()
) -> DataFrame:
    """(id_col, n_tokens, n_known, train_tokens, base_score, score) of every row of docs."""
    spark, depth = docs.sparkSession, params.depth
    work = Workspace(spark, "suffix-tree")
    tree = fit(learn_from, text_col, work, params)
    near, far = _near(tree.gains)
    shared = spark.sparkContext.broadcast((near, _key_filter(tree.gains, "key", work)))
    start, unseen = tree.start, -float(np.log10(tree.n_tokens + tree.n_words + 1))
    sliced = [f"{x}{i}" for i in range(_SLICES) for x in ("key", "tf")]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (keys, heads, gain, base), able = shared.value
        for batch in batches:
            for part in W.slices(batch, text_col):
                t = Tokens.of(part.column(text_col))
                size, n = np.diff(t.split), part.num_rows
                of = np.repeat(np.arange(n), size)
                full, low, known = size * unseen + start, size * unseen, np.zeros(n, dtype=np.int64)
                rows, rest = [], []
                for key, row in [(t.token, of)] + [(_joined(c, s, level), of[at]) for level, at, c, s in t.sequences(depth)]:
                    may = _may_have(able, key)
                    key, row = key[may], row[may]
                    at = _find(keys, heads, key)
                    hit = at >= 0
                    at, near_row = at[hit], row[hit]
                    full += np.bincount(near_row, gain[at], n)
                    low += np.bincount(near_row, base[at], n)
                    known += np.bincount(near_row[base[at] > 0], minlength=n)
                    rows.append(row[~hit])
                    rest.append(key[~hit])
                row, h = np.concatenate(rows), np.concatenate(rest)
                bits = np.uint64(n.bit_length())  # rows in order, equal keys of a row together (but for ones equal in all bits left)
                order = np.argsort(row.astype(np.uint64) << (np.uint64(64) - bits) | h >> bits)
                r, h = row[order], h[order]
                new = np.ones(len(r), dtype=bool)
                new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
                first = np.flatnonzero(new)
                tf = np.diff([*first, len(r)]).astype(np.int32)
                r, h = r[first], h[first]
                lists = []
                for i in range(_SLICES):
                    at = np.flatnonzero(h >> np.uint64(32) & np.uint64(_SLICES - 1) == i)
                    cut = pa.array(np.searchsorted(r[at], np.arange(n + 1)).astype(np.int32))
                    lists += [pa.ListArray.from_arrays(cut, pa.array(h[at].view(np.int64))), pa.ListArray.from_arrays(cut, pa.array(tf[at]))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("id"), pa.array(size), pa.array(known), pa.array(low), pa.array(full), *lists],
                    names=["row", "id", "n_tokens", "n_known", "base", "full", *sliced],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_col)
    schema = f"row long, id {kind}, n_tokens long, n_known long, base double, full double"
    schema += "".join(f", key{i} array<long>, tf{i} array<int>" for i in range(_SLICES))
    parts = work.write(rows.mapInArrow(run, schema), "parts")
    more = []
    for i in range(_SLICES):  # one after the other, so that the shuffles of one are on disk at a time
        rest = parts.select("row", F.explode(F.arrays_zip(f"key{i}", f"tf{i}")).alias("x"))
        rest = rest.select("row", F.col(f"x.key{i}").alias("key"), F.col(f"x.tf{i}").alias("tf"))
        part = far.where(F.expr(f"shiftrightunsigned(key, 32) & {_SLICES - 1}") == i).select("key", "gain", "base")
        sums = rest.join(part, "key").groupBy("row").agg(
            F.sum(F.col("tf") * F.col("gain")).alias("more_gain"),
            F.sum(F.col("tf") * F.col("base")).alias("more_base"),
            F.sum(F.when(F.col("base") > 0, F.col("tf")).otherwise(0)).alias("more_known"),
        )
        more.append(work.write(sums, f"more{i}"))
    more = reduce(DataFrame.union, more).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("more_gain", "more_base", "more_known")))
    plus = lambda c, m: F.col(c) + F.coalesce(F.col(m), F.lit(0))
    return parts.drop(*sliced).join(more, "row", "left").select(
        F.col("id").alias(id_col),
        "n_tokens",
        plus("n_known", "more_known").alias("n_known"),
        F.lit(tree.n_tokens).cast("long").alias("train_tokens"),
        plus("base", "more_base").alias("base_score"),
        plus("full", "more_gain").alias("score"),
    )
