"""Maximal periodic runs of words, found in tiles, one size of tiles for each octave of periods.

A run of period q is a stretch of words in which words q apart are equal, q is
the smallest such period, no neighbouring word extends it, and it is at least
``min_exponent`` periods and ``min_words`` words long. Its match positions (i
with word i equal to word i + q) are an unbroken interval at least
``(min_exponent - 1) * q`` long.

For periods in [2**k, 2**(k+1)) the document is exploded into overlapping tiles
around the multiples of a span of 2**(k+1) words. A match interval is longer
than a span, so it contains a tile's centre. In each tile, on its own, two
Z-functions give, for every period of the octave at once, how far the match
reaches to the right and to the left of the centre, at most one span (``LOOK``
words in short spans) each way. A full reach may go on in the next tile, whose
fragment then overlaps or abuts, so fragments are shuffled by document and
period and stitched into whole intervals. Periods whose block is a power of a
shorter one are left out in the tile.

Tiles without a chance are not emitted: those in which no period of the octave
matches over ``LOOK`` words to one side of the centre, or over as many as a run
needs, vectorised over a batch. The Z-functions are linear, so a text costs
about its length for each octave, however repetitive it is.

Memory: a tile, or the words of one document where its own words are read. Long
documents fall into many tiles, dealt over all tasks; the only groups are those
of one document and period, and the runs of one document. The scan and the
fragments are written tables, so lost executors cost single tasks.

Results: null and empty texts have no words and no runs. Rows are told apart by
their position in the scan, so null ids and repeated rows each give their own
row. An empty table has no rows. Columns beside id, text and the pattern never
enter. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm import words as W
from wellspring.llm.shared import Workspace

MIN_WORDS = 6
MIN_EXPONENT = 4
LOOK = 16
_HELD_CODES = 1 << 20
_SCAN_NAMES = ["key", "doc_id", "n_words", "words_sha256", "words", "octave", "centre", "left", "codes"]


def z_function(seq: list[int]) -> list[int]:
    """z[i]: length of the longest common prefix of seq and seq[i:]."""
    n = len(seq)
    z = [0] * n
    if n:
        z[0] = n
    lo = hi = 0
    for i in range(1, n):
        k = 0
        if i < hi:
            k = z[i - lo]
            if k < hi - i:
                z[i] = k
                continue
            k = hi - i
        while i + k < n and seq[k] == seq[i + k]:
            k += 1
        z[i] = k
        lo, hi = i, i + k
    return z


def _prime_factors(q: int) -> list[int]:
    out, r = [], 2
    while r * r <= q:
        if q % r == 0:
            out.append(r)
            while q % r == 0:
                q //= r
        r += 1
    return out + [q] if q > 1 else out


def _reach(octave: int) -> int:
    return max(2 << octave, LOOK)


def solve_tile(octave: int, codes: list[int], left: int) -> list[tuple[int, int, int]]:
    """(period, reach to the left, reach to the right) of the octave's fragments through word ``left``, the centre.

    Fragments whose matches end inside the tile and are too short for a run are dropped.
    """
    full = _reach(octave)
    right = codes[left:]
    z = z_function(right)
    most = min(2 << octave, len(right))
    back = codes[:left][::-1]
    # left reach of period q: common prefix of the words before the centre and of those before centre + q, both reversed
    behind = z_function(back + [-1] + codes[: left + most][::-1]) if left else []
    out = []
    for q in range(1 << octave, most):
        reach = min(z[q], full)
        if not reach:
            continue
        ahead = behind[left + 1 + most - q] if left else 0
        if reach < full and ahead < full and reach + ahead < max(MIN_WORDS, MIN_EXPONENT * q) - q:
            continue
        if any(z[q // r] >= q - q // r for r in _prime_factors(q)):
            continue
        out.append((q, ahead, reach))
    return out


def _matches(hashes: np.ndarray, at: np.ndarray, q: np.ndarray, way: int, bound: np.ndarray) -> np.ndarray:
    """How many words, up to LOOK, equal those q on, one after another from ``at`` one way; bound: the row's end or start."""
    out = np.zeros(len(at), dtype=np.int64)
    alive = np.arange(len(at))
    for j in range(LOOK):
        i = at[alive] + way * j
        inside = i + q[alive] < bound[alive] if way > 0 else i >= bound[alive]
        alive, i = alive[inside], i[inside]
        same = hashes[i] == hashes[i + q[alive]]
        alive = alive[same]
        if not len(alive):
            break
        out[alive] += 1
    return out


def candidate_tiles(hashes: np.ndarray, split: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(row, octave, centre in the row, its tile's words) of the tiles that may hold a fragment."""
    size = np.diff(split)
    octave = 0
    while (rows := np.flatnonzero(size >= max(MIN_WORDS, MIN_EXPONENT << octave))).size:
        low, span = 1 << octave, 2 << octave
        count = -(-size[rows] // span)
        row = np.repeat(rows, count)
        centre = split[:-1][row] + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * span
        kept = []
        step = max(1, (1 << 20) // low)
        for lo in range(0, len(row), step):
            c, end = centre[lo : lo + step, None], split[1:][row[lo : lo + step], None]
            other = c + np.arange(low, span)[None, :]
            at, lag = np.nonzero((other < end) & (hashes[np.minimum(other, len(hashes) - 1)] == hashes[c]))
            b, q, r = centre[lo + at], lag + low, row[lo + at]
            ahead = _matches(hashes, b, q, 1, split[1:][r])
            behind = _matches(hashes, b - 1, q, -1, split[:-1][r])
            enough = ahead + behind >= np.maximum(MIN_WORDS, MIN_EXPONENT * q) - q
            kept.append(np.unique(at[enough | (ahead == LOOK) | (behind == LOOK)]) + lo)
        for i in np.concatenate(kept).tolist():
            r, b = int(row[i]), int(centre[i])
            reach = _reach(octave)
            yield r, octave, b - int(split[r]), hashes[max(int(split[r]), b - reach) : min(int(split[r + 1]), b + reach + span)]
        octave += 1


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, altered by the row's pattern, and candidate tiles of every text."""
    for batch in batches:
        for part in W.slices(batch, "text"):
            data, offs = W.text_bytes(part.column("text"))
            found = W.find_words(data, offs)
            hashes = W.hash_spans(data, found.start, found.end)
            altered: dict[int, np.ndarray] = {}
            pattern = part.column("pattern").to_pylist()
            n_words = np.diff(found.split).tolist()
            for i, p in enumerate(pattern):
                if p is not None and n_words[i]:
                    order = np.arange(n_words[i])
                    order[p["first"] :] = p["first"] + (order[p["first"] :] - p["first"]) % p["period"]
                    altered[i] = order
                    lo = int(found.split[i])
                    hashes[lo : lo + n_words[i]] = hashes[lo : lo + n_words[i]][order]
            tiled: set[int] = set()
            held: list[tuple] = []
            n_codes = 0
            for r, octave, centre, span in candidate_tiles(hashes, found.split):
                tiled.add(r)
                codes = np.unique(span, return_inverse=True)[1].astype(np.int32)
                held.append((r, octave, centre, min(centre, _reach(octave)), codes))
                n_codes += len(codes)
                if n_codes > _HELD_CODES:
                    yield _tile_rows(part, held)
                    held, n_codes = [], 0
            if held:
                yield _tile_rows(part, held)
            joined, digest = [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                own = (text or "").encode().split()
                if i in altered:
                    own = [own[j] for j in altered[i].tolist()]
                whole = b" ".join(own)
                digest.append(hashlib.sha256(whole).hexdigest())
                joined.append(whole.decode() if i in tiled else None)
            n = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key"),
                    part.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(joined, pa.string()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.list_(pa.int32())),
                ],
                names=_SCAN_NAMES,
            )


def _tile_rows(part: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
    row, octave, centre, left, codes = zip(*held)
    cut = pa.array(np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int32))
    n = len(held)
    return pa.RecordBatch.from_arrays(
        [
            part.column("key").take(pa.array(row)),
            pa.nulls(n, part.schema.field("doc_id").type),
            pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.string()),
            pa.nulls(n, pa.string()),
            pa.array(octave, pa.int32()),
            pa.array(centre, pa.int64()),
            pa.array(left, pa.int32()),
            pa.ListArray.from_arrays(cut, pa.array(np.concatenate(codes))),
        ],
        names=_SCAN_NAMES,
    )


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[int, int, int, int]] = []
        codes, cut = batch.column("codes").flatten().to_numpy(zero_copy_only=False), batch.column("codes").offsets.to_pylist()
        place = zip(*[batch.column(c).to_pylist() for c in ("key", "octave", "centre", "left")])
        base = cut[0]
        for (key, octave, centre, left), lo, hi in zip(place, cut, cut[1:]):
            for q, back, ahead in solve_tile(octave, codes[lo - base : hi - base].tolist(), left):
                out.append((key, q, centre - back, centre + ahead))
        arrays = [pa.array([row[k] for row in out], pa.int64()) for k in range(4)]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "period", "first", "last"])


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the words that no run drops."""
    for batch in batches:
        digests = []
        for text, runs in zip(batch.column("words").to_pylist(), batch.column("runs").to_pylist()):
            words = text.encode().split(b" ")
            drop = np.zeros(len(words) + 1, dtype=np.int64)
            for run in runs:
                drop[run["start"] + run["period"]] += 1
                drop[run["start"] + run["length"]] -= 1
            kept = np.flatnonzero(np.cumsum(drop)[:-1] == 0).tolist()
            digests.append(hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("runs"), pa.array(digests, pa.string())], names=["key", "runs", "collapsed_sha256"]
        )


def stitch(fragments: DataFrame) -> DataFrame:
    """(key, start, length, period) of whole runs; fragments(key, period, first, last) are match intervals of tiles."""
    own = Window.partitionBy("key", "period").orderBy("first", "last")
    reached = F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments.withColumn("opens", F.coalesce(F.col("first") > reached, F.lit(True)).cast("int"))
    islands = marked.withColumn("island", F.sum("opens").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy("key", "period", "island").agg(F.min("first").alias("start"), F.max("last").alias("last"))
    length = F.col("last") - F.col("start") + F.col("period")
    runs = whole.select("key", "start", length.alias("length"), "period")
    return runs.where(F.col("length") >= F.greatest(F.lit(MIN_WORDS), F.lit(MIN_EXPONENT) * F.col("period")))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: Column | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed_sha256) of every row.

    runs: array of (start, period, length) in that order. collapsed_sha256: digest
    of the words, one space apart, without those that a run contains after its
    first period. pattern: struct(first, period) or null; from word ``first`` on,
    the words repeat with that period before runs are looked for.
    """
    work = Workspace(docs.sparkSession, "runs")
    none = F.lit(None).cast("struct<first:long,period:long>")
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"),
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        (none if pattern is None else pattern.cast("struct<first:long,period:long>")).alias("pattern"),
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"key long, doc_id {id_type}, n_words long, words_sha256 string, words string, octave int, centre long, left int, codes array<int>"
    scan = work.write(rows.mapInArrow(_scan, schema), "scan")
    tiles = scan.where("octave IS NOT NULL").select("key", "octave", "centre", "left", "codes").repartition("key", "octave", "centre")
    runs = stitch(tiles.mapInArrow(_solve, "key long, period long, first long, last long"))
    texts = scan.where("octave IS NULL")
    of_doc = runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    # merge joins at every size: texts of repetitive documents only, then digests of all
    repetitive = texts.where("words IS NOT NULL").select("key", "words").hint("merge").join(of_doc, "key")
    listed = of_doc.schema["runs"].dataType
    collapsed = repetitive.mapInArrow(_collapse, f"key long, runs {listed.simpleString()}, collapsed_sha256 string")
    collapsed = work.write(collapsed, "collapsed")
    facts = texts.select("key", "doc_id", "n_words", "words_sha256").hint("merge").join(collapsed, "key", "left")
    return facts.select(
        "doc_id",
        "n_words",
        F.coalesce("runs", F.array().cast(listed)).alias("runs"),
        F.coalesce("collapsed_sha256", "words_sha256").alias("collapsed_sha256"),
    )


def planted(id_col: str, text_col: str) -> Column:
    """struct(first, period): every tenth id, by its hash, repeats its text's words from a place and with a period set by the hash."""
    h = F.crc32(F.col(id_col).cast("string"))
    n = F.regexp_count(text_col, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    g = F.floor(h / 10)
    first = g % n
    period = 1 + F.floor((n - first) / (3 + g % 8))
    return F.when(h % 10 == 0, F.when(n > 0, F.struct(first.alias("first"), period.alias("period"))))


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period; of equal ones the first. Null without runs."""
    better = lambda best, r: best["period"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:bigint,period:bigint,length:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


# The registered query's rows in DuckDB: all pairs of equal words up to a quarter of the text apart, and their islands.
ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), CAST([] AS VARCHAR[])) AS own,
         xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, c: list_reduce(list_prepend(xor(crc, c), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
             lambda r, z: xor(r >> 1, (r & 1) * CAST(3988292384 AS BIGINT))))) AS h
  FROM documents
), sized AS (
  SELECT *, len(own) AS n, h % 10 = 0 AND len(own) > 0 AS planted, (h // 10) % greatest(len(own), 1) AS a,
         1 + (len(own) - (h // 10) % greatest(len(own), 1)) // (3 + (h // 10) % 8) AS p
  FROM docs
), texts AS (
  SELECT k, doc_id, n, CASE WHEN planted
    THEN list_transform(range(n), lambda i: own[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE own END AS w
  FROM sized
), words AS (
  SELECT k, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM texts
), equals AS (
  SELECT x.k, y.i - x.i AS q, x.i FROM words x JOIN words y
  ON x.k = y.k AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM equals
), stretches AS (
  SELECT k, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY k, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT k, start, length, min(q) AS period FROM stretches GROUP BY k, start, length
), listed AS (
  SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY k
), best AS (
  SELECT k, start, length, period FROM runs r
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY CAST(length AS DECIMAL(38, 18)) / period DESC, start, period) = 1
), kept AS (
  SELECT k, string_agg(word, ' ' ORDER BY i) AS text FROM words w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.k = w.k AND w.i >= r.start + r.period AND w.i < r.start + r.length)
  GROUP BY k
)
SELECT t.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
       sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed l ON l.k = t.k LEFT JOIN best b ON b.k = t.k LEFT JOIN kept c ON c.k = t.k
"""
