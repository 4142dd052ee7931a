"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates.

Features of a text are its word unigrams and bigrams under two views, the
lower-cased word and the word's shape (runs of upper case, lower case, other
letters, digits and each punctuation mark), hashed into ``2**bits`` slots with
value log(1 + count), scaled to unit length. A repeated word's bigram is one
feature of its own. A score is the logistic function of one sparse dot product.

Training takes a bounded sample of labelled rows (``max_train``: those of the
smallest hash of the id), computes their features in parallel, and runs the
sequential updates in one task. Weights are at most ``2**bits`` numbers, which
is the bound of what is collected and broadcast. Scoring covers all rows.

Defined results: a null or blank text has the score of the intercept alone;
without any usable label every score is 0.5; repeated label rows vote, ties
count as 1; rows with a null id are scored and never trained on; an output
column replaces an input column of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.llm import words as W

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("0") : ord("9") + 1] = ord("0")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[128:] = ord("a")


@dataclass(frozen=True)
class FtrlParams:
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    updates: int = 30_000
    max_train: int = 10_000


def _shape_hashes(data: np.ndarray, words: W.Words) -> np.ndarray:
    """Hash of each word's shape: its character classes with runs collapsed."""
    kind = _SHAPE[data]
    keep = np.ones(len(kind), dtype=bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[words.start] = True
    at = np.zeros(len(kind) + 1, dtype=np.int64)
    np.cumsum(keep, out=at[1:])
    return W.hash_spans(kind[keep], at[words.start], at[words.end])


def features(col: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of a text column, ordered by row and slot."""
    data, offs = W.text_bytes(col)
    words = W.find_words(data, offs)
    row, parts, rows = words.row, [], []
    same_row = row[1:] == row[:-1]
    for view, h in enumerate((W.hash_spans(data, words.start, words.end, lower=True), _shape_hashes(data, words))):
        pair = W.mix(h[:-1] * np.uint64(0x9DDFEA08EB382D69) + h[1:])
        if view == 0:
            pair[h[1:] == h[:-1]] = 1
        for salt, x, r in ((1, h, row), (2, pair[same_row], row[1:][same_row])):
            parts.append(W.mix(x + np.uint64(salt + 2 * view)) >> np.uint64(64 - bits))
            rows.append(r)
    key = (np.concatenate(rows).astype(np.uint64) << np.uint64(bits)) | np.concatenate(parts)
    key, count = np.unique(key, return_counts=True)
    row = (key >> np.uint64(bits)).astype(np.int64)
    value = np.log1p(count)
    length = np.sqrt(np.bincount(row, value * value, minlength=len(col)))
    return row, (key & np.uint64((1 << bits) - 1)).astype(np.int64), (value / length[row]).astype(np.float32)


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], p: FtrlParams) -> np.ndarray:
    """Weights after whole passes over (slots, values, label), p.updates updates or a little more; the last one is the intercept."""
    size = (1 << p.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(slots: np.ndarray) -> np.ndarray:
        zs = z[slots]
        w = -(zs - np.sign(zs) * p.l1) / ((p.beta + np.sqrt(n[slots])) / p.alpha + p.l2)
        return np.where(np.abs(zs) <= p.l1, 0.0, w)

    for _ in range(-(-p.updates // len(examples)) if examples else 0):
        for slots, values, label in examples:
            slots, values = np.append(slots, size - 1), np.append(values, 1.0)
            w = weights(slots)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
            z[slots] += g - (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / p.alpha * w
            n[slots] += g * g
    return weights(np.arange(size))


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    params: FtrlParams

    def score(self, docs: DataFrame, text_col: str = "text", out_col: str = "score") -> DataFrame:
        """docs with a double column out_col from 0 to 1."""
        shared = docs.sparkSession.sparkContext.broadcast(self.weights.astype(np.float32))
        bits = self.params.bits
        base = [f for f in docs.schema.fields if f.name != out_col]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = shared.value
            for batch in batches:
                for part in W.slices(batch, text_col):
                    row, slot, value = features(part.column(text_col), bits)
                    dot = np.bincount(row, w[slot] * value, minlength=part.num_rows) + w[-1]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(f.name) for f in base] + [pa.array(1.0 / (1.0 + np.exp(-dot)))],
                        names=[f.name for f in base] + [out_col],
                    )

        return docs.mapInArrow(run, T.StructType([*base, T.StructField(out_col, T.DoubleType())]))


def is_held_out(id_col: str, folds: int = 5) -> F.Column:
    """Rows whose crc32(id as text) is divisible by folds; a null id counts as one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    params: FtrlParams = FtrlParams(),
) -> QualityModel:
    """Fit on labelled documents that are not held out."""
    spark: SparkSession = docs.sparkSession
    sample = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~is_held_out(id_col))
        .groupBy(F.col(id_col).alias("_id"))
        .agg((F.avg(label_col) >= 0.5).cast("int").alias("_label"))
        .withColumn("_rank", F.xxhash64(F.col("_id"), F.lit(11)))
        .orderBy("_rank", "_id")
        .limit(params.max_train)
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "_text"):
                row, slot, value = features(part.column("_text"), params.bits)
                cut = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_rank"),
                        part.column("_id"),
                        part.column("_label"),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(slot.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(value)),
                    ],
                    names=["_rank", "_id", "_label", "slots", "vals"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    encoded = rows.mapInArrow(extract, f"_rank long, _id {id_type}, _label int, slots array<int>, vals array<float>")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            cut_s, cut_v = batch.column("slots"), batch.column("vals")
            for i, label in enumerate(batch.column("_label").to_pylist()):
                examples.append((cut_s[i].values.to_numpy(), cut_v[i].values.to_numpy().astype(np.float64), label))
        w = ftrl(examples, params)
        used = np.flatnonzero(w)
        for lo in range(0, len(used), 65536):
            part = used[lo : lo + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(w[part])], names=["slot", "weight"])

    # max_train rows at most, in the order of the hash: the updates are sequential
    fitted = encoded.repartition(1).sortWithinPartitions("_rank", "_id").mapInArrow(fit, "slot int, weight double").toArrow()
    weights = np.zeros((1 << params.bits) + 1)
    weights[fitted.column("slot").to_numpy()] = fitted.column("weight").to_numpy()
    return QualityModel(weights, params)
