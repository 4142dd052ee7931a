"""Quality rules from tokeniser fertility.

Each word (with the space before it) is encoded by public vocabularies. Per
text: characters per token under each vocabulary, the share of byte-fallback
tokens, and the entropy of its token distribution as a share of the most that
its length allows. Rejection bands depend on the row's language, or, where no
band is given for that language, on the script of most of its letters.

Base measures follow the words ``[^\\x20\\x09-\\x0D]+``; see ``measure``. A text
fails the base rules with fewer than 10 words or with more than 20 % of words
inside repeated 5-word windows. A text that passes is kept when every measure
lies in its bands; measures of texts under ``min_tokens`` tokens are too noisy
and are not judged, except for characters per token and byte fallback. Under
``sure_tokens`` tokens characters per token have a lower minimum.

Defined results: null, empty and blank texts have zero counts, null measures
and fail the base rules; a null language takes the script's band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.llm import words as W
from wellspring.llm.word_pieces import piece_vocabulary

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class Vocabularies:
    """Paths of a sentencepiece model and of byte-level BPE ranks, with the latter's split pattern."""

    piece_model: str
    byte_ranks: str
    byte_pattern: str


@dataclass(frozen=True)
class Band:
    """Limits of one language or script; chars_* are (piece, byte) vocabularies; short_min: chars_min of short texts, if another."""

    chars_min: tuple[float, float]
    chars_max: tuple[float, float]
    fallback_max: float
    entropy_min: float
    short_min: tuple[float, float] | None = None


@dataclass(frozen=True)
class FertilityRules:
    """bands: by language code; scripts: by script, with "other" as the last resort."""

    bands: dict[str, Band] = field(default_factory=lambda: dict(LANGUAGES))
    scripts: dict[str, Band] = field(default_factory=lambda: dict(SCRIPTS))
    min_tokens: int = 64
    sure_tokens: int = 200


# Bands of characters per token, byte-fallback share and entropy share. Minima of languages lie at the
# lowest 0.2 to 1 % of documents labelled good (sf0.1, of 200 tokens or more; short_min: of fewer), entropy below all of
# them. Maxima are above what was seen (3.7), since words of plain prose are often one token.
LANGUAGES = {
    "en": Band((2.09, 2.11), (6.0, 6.0), 0.02, 0.57, (1.80, 1.90)),
    "de": Band((2.11, 1.94), (6.0, 6.0), 0.02, 0.555, (1.50, 1.66)),
    "fr": Band((1.84, 1.75), (6.0, 6.0), 0.02, 0.55, (1.65, 1.62)),
    "es": Band((1.80, 1.645), (6.0, 6.0), 0.02, 0.56, (1.60, 1.60)),
}
SCRIPTS = {
    "latin": Band((1.10, 1.00), (9.0, 9.0), 0.15, 0.48),
    "cyrillic": Band((0.90, 0.45), (8.0, 8.0), 0.20, 0.48),
    "greek": Band((0.70, 0.45), (8.0, 8.0), 0.40, 0.45),
    "cjk": Band((0.30, 0.30), (4.0, 4.0), 0.85, 0.40),
    "other": Band((0.25, 0.20), (9.0, 9.0), 0.95, 0.35),
}

MEASURES = (
    T.StructType()
    .add("n_words", "long").add("word_chars", "long").add("n_symbols", "long")
    .add("n_dup_lines", "long").add("n_repeat_words", "long").add("n_piece_tokens", "long")
    .add("chars_per_piece", "double").add("chars_per_byte_token", "double")
    .add("fallback_share", "double").add("entropy_share", "double").add("script", "string")
)


def _distinct_per_row(hashes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    _, first = np.unique(W.in_row(hashes, row), return_index=True)
    return np.bincount(row[first], minlength=n)


def base_measures(data: np.ndarray, offs: np.ndarray, words: W.Words) -> dict[str, np.ndarray]:
    n = len(offs) - 1
    chars = (data & 0xC0) != 0x80
    inside = ~W.SPACE[data]
    out = {
        "n_words": np.diff(words.split),
        "word_chars": W.per_row(chars & inside, offs),
        "n_symbols": W.per_row(_SYMBOL[data], offs),
    }
    lines = W.find_lines(data, offs)
    filled = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(inside, out=filled[1:])
    real = filled[lines.end] > filled[lines.start]
    row = lines.row[real]
    h = W.hash_spans(data, lines.start[real], lines.end[real])
    out["n_dup_lines"] = np.bincount(row, minlength=n) - _distinct_per_row(h, row, n)

    h = W.hash_spans(data, words.start, words.end)
    value, first, row = W.windows(h, words.split, 5)
    _, inverse, count = np.unique(W.in_row(value, row), return_inverse=True, return_counts=True)
    hit = first[count[inverse] > 1]
    cover = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + 5, -1)
    out["n_repeat_words"] = W.per_row(np.cumsum(cover)[:-1] > 0, words.split)
    return out


def _scripts(data: np.ndarray, offs: np.ndarray) -> list[str]:
    """Script of most letters, told from the lead bytes of UTF-8."""
    latin = ((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128) | (data >= 0xC3) & (data <= 0xC9)
    counts = np.stack([
        W.per_row(latin, offs),
        W.per_row((data >= 0xD0) & (data <= 0xD4), offs),
        W.per_row((data >= 0xCD) & (data <= 0xCF), offs),
        W.per_row((data >= 0xE3) & (data <= 0xED), offs),
        W.per_row((data >= 0xD5) & (data <= 0xE2) | (data >= 0xEE), offs),
    ])
    names = ("latin", "cyrillic", "greek", "cjk", "other")
    return [names[i] if t else "other" for i, t in zip(counts.argmax(axis=0), counts.sum(axis=0))]


def measure(docs: DataFrame, vocabularies: Vocabularies, text_col: str = "text", out_col: str = "measures") -> DataFrame:
    """docs with a struct of the base measures and the fertility measures."""
    base = [f for f in docs.schema.fields if f.name != out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_vocabulary(vocabularies.piece_model, vocabularies.byte_ranks, vocabularies.byte_pattern)
        for batch in batches:
            for part in W.slices(batch, text_col, 1 << 20):
                n = part.num_rows
                data, offs = W.text_bytes(part.column(text_col))
                words = W.find_words(data, offs)
                out = base_measures(data, offs, words)
                raw = data.tobytes()
                spelled = [raw[s:e] for s, e in zip(words.start.tolist(), words.end.tolist())]
                at = pieces.index(spelled)
                ids, cut = pieces.gather(at)
                row = np.repeat(words.row, np.diff(cut))
                total = np.bincount(row, minlength=n)
                fallback = np.bincount(row, pieces.is_byte[ids], minlength=n)
                n_bytes = np.bincount(words.row, pieces.byte_tokens[at], minlength=n)
                key, count = np.unique(row.astype(np.int64) << 20 | ids, return_counts=True)
                share = count / total[key >> 20]
                entropy = np.bincount(key >> 20, -share * np.log2(share), minlength=n)
                most = np.log2(np.clip(total, 2, 1 << 12))
                some = total > 0
                blank = lambda x, some=some: pa.array(np.where(some, x, 0.0), mask=~some)
                one = np.maximum(total, 1)
                values = [
                    *(pa.array(out[k].astype(np.int64)) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                    pa.array(total.astype(np.int64)),
                    blank(out["word_chars"] / one),
                    blank(out["word_chars"] / np.maximum(n_bytes, 1)),
                    blank(fallback / one),
                    blank(np.minimum(entropy / most, 1.0)),
                    pa.array(_scripts(data, offs)),
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) for f in base] + [pa.StructArray.from_arrays(values, names=MEASURES.names)],
                    names=[f.name for f in base] + [out_col],
                )
        piece_vocabulary.cache_clear()  # a reused worker takes no words into the next stage

    return docs.mapInArrow(run, T.StructType([*base, T.StructField(out_col, MEASURES)]))


def base_failed(m: str = "measures") -> F.Column:
    c = F.col
    return (c(f"{m}.n_words") < 10) | (100 * c(f"{m}.n_repeat_words") > 20 * c(f"{m}.n_words"))


def in_bands(rules: FertilityRules, lang_col: str | None, m: str = "measures") -> F.Column:
    """Whether all measures lie in the bands of the row's language, else of its script."""
    def ok(b: Band) -> F.Column:
        least = [F.when(F.col(f"{m}.n_piece_tokens") < rules.sure_tokens, x).otherwise(y) for x, y in zip(b.short_min or b.chars_min, b.chars_min)]
        return (
            F.col(f"{m}.chars_per_piece").between(least[0], b.chars_max[0])
            & F.col(f"{m}.chars_per_byte_token").between(least[1], b.chars_max[1])
            & (F.col(f"{m}.fallback_share") <= b.fallback_max)
            & ((F.col(f"{m}.n_piece_tokens") < rules.min_tokens) | (F.col(f"{m}.entropy_share") >= b.entropy_min))
        )

    out = ok(rules.scripts["other"])
    for name, band in rules.scripts.items():
        out = F.when(F.col(f"{m}.script") == name, ok(band)).otherwise(out)
    if lang_col:
        for name, band in rules.bands.items():
            out = F.when(F.col(lang_col) == name, ok(band)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def judge(docs: DataFrame, vocabularies: Vocabularies, rules: FertilityRules = FertilityRules(),
          text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """docs with columns measures, base_failed and kept."""
    return (
        measure(docs, vocabularies, text_col)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & in_bands(rules, lang_col))
    )
