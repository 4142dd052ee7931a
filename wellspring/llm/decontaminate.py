"""Benchmark decontamination: SimHash windows, multi-index Hamming blocks, exact verification.

Item lengths fall into classes; each class has a window width of about two
fifths of its items' words and a stride of a quarter of the width. Every
window position of every item is indexed, and every text is windowed at the
stride, so a passage that holds an item has windows lying exactly on windows of
the item, also beside an edited word. A window's 64-bit SimHash adds its words'
hashes, longer words weighing more.

Index. The 64 bits are four blocks of 16. Two fingerprints within ``radius``
differ by at most radius // 4 bits in one block, so looking each window's four
blocks up in tables filled with all such neighbours of the items' blocks finds
every fingerprint within the radius. Fingerprints so found are compared in full.

Verification. A found pair sets the item's place in the text; the item-sized
window there is compared by its 5-word shingles (fewer words: the whole item),
each weighing as many bytes as its words have: sum of minima over sum of maxima
must reach ``similarity``.

Items are taken in blocks of ``items_per_block``, each with one bounded
broadcast index and one pass over the texts, without any shuffle of texts.

Defined results: null and blank texts and items match nothing; repeated items
match alike; a text's matches are listed once per item, with the most similar
place, the first of equals; items with null ids are matched and reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wellspring.llm import words as W

_SEGMENT = 1 << 14


@dataclass(frozen=True)
class DecontaminationParams:
    k: int = 5
    similarity: float = 0.75
    radius: int = 7
    width_share: float = 0.4
    items_per_block: int = 1024


def window_width(n_words: int, share: float) -> int:
    """Window width of items of n_words: a step of 1.25 in a geometric ladder, below the share."""
    most, width = max(3.0, share * n_words), 3
    while (step := max(width + 1, int(width * 1.25))) <= most:
        width = step
    return min(width, n_words)


def fingerprints(hashes: np.ndarray, weights: np.ndarray, starts: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """SimHash of the width words from each start, for ascending starts by width.

    Running sums of the 64 signed bits are made once per segment of the words
    and shared by all widths; a window's sum is a difference of two of them.
    """
    out = {width: np.zeros(len(start), dtype=np.uint64) for width, start in starts.items()}
    reach = max(starts, default=0)
    for lo in range(0, len(hashes), _SEGMENT):
        lanes = np.unpackbits(hashes[lo : lo + _SEGMENT + reach].view(np.uint8).reshape(-1, 8), axis=1).astype(np.int16)
        lanes *= 2
        lanes -= 1
        lanes *= weights[lo : lo + len(lanes), None]
        total = np.zeros((len(lanes) + 1, 64), dtype=np.int16)
        np.cumsum(lanes, axis=0, dtype=np.int16, out=total[1:])
        for width, start in starts.items():
            i, j = np.searchsorted(start, (lo, lo + _SEGMENT))
            at = start[i:j] - lo
            out[width][i:j] = np.packbits(total[at + width] > total[at], axis=1).view(np.uint64).ravel()
    return out


def _weights(words: W.Words) -> np.ndarray:
    return np.clip((words.end - words.start + 2) // 3, 1, 3).astype(np.int16)


def _weighted(hashes: np.ndarray, sizes: np.ndarray, k: int) -> dict[int, int]:
    """Shingle to total weight."""
    value, first, _ = W.windows(hashes, np.array([0, len(hashes)]), k)
    total = np.concatenate([[0], np.cumsum(sizes)])
    out: dict[int, int] = {}
    for h, w in zip(value.tolist(), (total[first + k] - total[first]).tolist()):
        out[h] = out.get(h, 0) + w
    return out


def _in_order(hashes: np.ndarray, weights: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    order = np.argsort(start, kind="stable")
    out = np.empty(len(start), dtype=np.uint64)
    out[order] = fingerprints(hashes, weights, {width: start[order]})[width]
    return out


class HammingIndex:
    """Fingerprints of one width, found by any of four blocks of 16 bits."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        masks = [0] + [sum(1 << b for b in bits) for n in range(1, radius // 4 + 1) for bits in combinations(range(16), n)]
        masks = np.array(masks, dtype=np.uint16)
        self.tables = []
        for block in range(4):
            keys = (self._block(prints, block)[:, None] ^ masks).ravel()
            order = np.argsort(keys, kind="stable")
            cut = np.searchsorted(keys[order], np.arange(65537))
            self.tables.append((cut, (order // len(masks)).astype(np.int32)))

    @staticmethod
    def _block(prints: np.ndarray, block: int) -> np.ndarray:
        return (prints >> np.uint64(16 * block)).astype(np.uint16)

    def search(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query position, indexed position, distance) of all pairs within the radius."""
        found = []
        for block, (cut, members) in enumerate(self.tables):
            key = self._block(prints, block).astype(np.int64)
            count = cut[key + 1] - cut[key]
            q = np.repeat(np.arange(len(prints)), count)
            at = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count) + cut[key][q]
            m = members[at]
            gap = np.bitwise_count(prints[q] ^ self.prints[m])
            near = gap <= self.radius
            found.append(np.stack([q[near], m[near], gap[near]]))
        found = np.unique(np.concatenate(found, axis=1), axis=1)
        return found[0], found[1], found[2]


class ItemIndex:
    """Items of one block: fingerprints by width, and weighted shingles."""

    def __init__(self, texts: list[str | None], p: DecontaminationParams):
        self.p = p
        data, offs = W.text_bytes(pa.array(texts, pa.string()))
        words = W.find_words(data, offs)
        hashes, sizes, weights = W.hash_spans(data, words.start, words.end, lower=True), words.end - words.start, _weights(words)
        self.size = np.diff(words.split)
        self.shingles, self.total = [], []
        by_width: dict[int, list[tuple[int, int]]] = {}
        for i, (a, b) in enumerate(zip(words.split, words.split[1:])):
            self.shingles.append(_weighted(hashes[a:b], sizes[a:b], min(p.k, b - a)) if a < b else {})
            self.total.append(sum(self.shingles[-1].values()))
            if a < b:
                by_width.setdefault(window_width(b - a, p.width_share), []).append((i, a))
        self.widths = {}
        for width, members in sorted(by_width.items()):
            item = np.repeat([i for i, _ in members], [self.size[i] - width + 1 for i, _ in members])
            start = np.concatenate([np.arange(a, a + self.size[i] - width + 1) for i, a in members])
            offset = start - words.split[:-1][item]
            self.widths[width] = (HammingIndex(_in_order(hashes, weights, start, width), p.radius), item, offset)

    def matches(self, col: pa.Array) -> list[tuple[int, int, int, int, int, float]]:
        """(row, item, first word, words, distance, similarity): the best place of each row and item."""
        data, offs = W.text_bytes(col)
        words = W.find_words(data, offs)
        hashes, sizes, weights = W.hash_spans(data, words.start, words.end, lower=True), words.end - words.start, _weights(words)
        row = words.row
        place = np.arange(len(hashes)) - words.split[:-1][row]
        left = words.split[1:][row] - np.arange(len(hashes))
        gaps: dict[tuple[int, int, int], int] = {}
        starts = {width: np.flatnonzero((place % max(1, width // 4) == 0) & (left >= width)) for width in self.widths}
        for width, prints in fingerprints(hashes, weights, starts).items():
            index, item, offset = self.widths[width]
            start = starts[width]
            q, m, gap = index.search(prints)
            r = row[start[q]]
            # the item's place, moved inside the text where the text cuts the item off
            first = np.maximum(start[q] - offset[m], words.split[r])
            for key, g in zip(zip(r.tolist(), item[m].tolist(), first.tolist()), gap.tolist()):
                gaps[key] = min(g, gaps.get(key, 64))
        best: dict[tuple[int, int], tuple] = {}
        for (r, i, first), gap in sorted(gaps.items()):
            last = min(first + int(self.size[i]), int(words.split[r + 1]))
            k = min(self.p.k, int(self.size[i]))
            own, mine = self.shingles[i], _weighted(hashes[first:last], sizes[first:last], k)
            both = sum(min(w, own[h]) for h, w in mine.items() if h in own)
            score = both / (self.total[i] + sum(mine.values()) - both)
            if score >= self.p.similarity and score > best.get((r, i), (0, 0, 0, 0.0))[3]:
                best[r, i] = (first - int(words.split[r]), last - first, gap, score)
        return [(r, i, *found) for (r, i), found in sorted(best.items())]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    out_col: str = "item_matches",
    params: DecontaminationParams = DecontaminationParams(),
) -> DataFrame:
    """docs with out_col: the items found in the text, as an array of structs."""
    spark, id_type = docs.sparkSession, items.schema[item_id_col].dataType
    match = T.StructType([T.StructField("item_id", id_type), T.StructField("first_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
                          T.StructField("distance", T.IntegerType()), T.StructField("similarity", T.DoubleType())])
    base = [f for f in docs.schema.fields if f.name != out_col]
    schema = T.StructType([*base, T.StructField(out_col, T.ArrayType(match))])
    arrow = pa.list_(to_arrow_type(match))

    def finder(shared, more: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, index = shared.value
            for batch in batches:
                for part in W.slices(batch, text_col):
                    out = part.column(out_col).to_pylist() if more else [[] for _ in range(part.num_rows)]
                    for r, i, *found in index.matches(part.column(text_col)):
                        out[r].append(dict(zip(match.names, (ids[i], *found))))
                    yield pa.RecordBatch.from_arrays([part.column(f.name) for f in base] + [pa.array(out, arrow)], names=schema.names)

        return run

    out, first = docs, True
    for ids, texts in item_blocks(items, item_id_col, item_text_col, params.items_per_block):
        shared = spark.sparkContext.broadcast((ids, ItemIndex(texts, params)))
        out, first = out.mapInArrow(finder(shared, not first), schema), False
    return out.withColumn(out_col, F.array().cast(T.ArrayType(match))) if first else out


def item_blocks(items: DataFrame, id_col: str, text_col: str, size: int) -> Iterator[tuple[list, list]]:
    """The items in blocks of bounded size, in order of id and text."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t is not null").orderBy("id", "t")
    ids, texts = [], []
    for r in rows.toLocalIterator():
        ids.append(r.id)
        texts.append(r.t)
        if len(ids) == size:
            yield ids, texts
            ids, texts = [], []
    if ids:
        yield ids, texts
