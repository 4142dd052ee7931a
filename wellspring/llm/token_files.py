"""Binary token files: concatenated ids with Elias-Fano document boundaries.

A corpus is a folder of files in ascending document order and a Parquet table
``manifest`` with one row per file. A file holds, in little-endian order:

    8 bytes   magic "WSTOKEF1"
    7 uint64  documents, documents with a null id, ids, bytes per id (2 or 4),
              least document id (two's complement), bytes of the first and of
              the second Elias-Fano part
    ids       the ids of all documents one after another
    part 1    Elias-Fano list of the n+1 boundaries 0 .. ids
    part 2    Elias-Fano list of the document ids less the least one

An Elias-Fano list of n ascending numbers up to u keeps the low
floor(log2(u / n)) bits of each packed, the rest as unary gaps in a bit vector,
and the place of every 64th one of that vector: about 2 + log2(u / n) bits a
number, against 64 in a table of offsets. ``select(i)`` starts from the sampled
place and counts ones in at most a few words.

Writing is one range-partitioned sort of the texts by id; each task encodes its
range and closes a file at ``max_ids`` ids. A file gets its name only when it
is whole, and only files in the manifest count, so lost tasks leave no trace.
Reading adds up the manifest's counts for the global offsets and reads one file
at a time.

Defined results: null and empty texts hold the end id alone; null document ids
come first; equal ids are ordered by text.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellspring.llm import words as W
from wellspring.llm.word_pieces import spaceless_vocabulary

MAGIC = b"WSTOKEF1"
SAMPLE = 64
_HEAD = struct.Struct("<8s7Q")
_LIST = struct.Struct("<4Q")


class EliasFano:
    """A non-decreasing list of non-negative integers."""

    def __init__(self, blob: bytes):
        self.n, self.low_bits, low_size, high_size = _LIST.unpack_from(blob)
        at = _LIST.size
        self.low = blob[at : at + low_size]
        self.high = blob[at + low_size : at + low_size + high_size]
        self.samples = np.frombuffer(blob, dtype="<u4", offset=at + low_size + high_size)

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = max(0, int(int(values[-1]) // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        vector = np.zeros(-(-(int(place[-1]) + 1 if n else 0) // 64) * 64, dtype=np.uint8)
        vector[place] = 1
        high = np.packbits(vector, bitorder="little").tobytes()
        return _LIST.pack(n, low_bits, len(low), len(high)) + low + high + place[::SAMPLE].astype("<u4").tobytes()

    def select(self, i: int) -> int:
        """The i-th number."""
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        word = place >> 6
        bits = int.from_bytes(self.high[8 * word : 8 * word + 8], "little") >> (place & 63) << (place & 63)
        while (ones := bits.bit_count()) <= left:
            left -= ones
            word += 1
            bits = int.from_bytes(self.high[8 * word : 8 * word + 8], "little")
        for _ in range(left):
            bits &= bits - 1
        place = 64 * word + (bits & -bits).bit_length() - 1
        at = i * self.low_bits
        chunk = int.from_bytes(self.low[at >> 3 : (at + self.low_bits + 7) >> 3], "little") >> (at & 7)
        return (place - i) << self.low_bits | chunk & ((1 << self.low_bits) - 1)


def pack_file(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    bounds = EliasFano.pack(np.concatenate([[0], np.cumsum(sizes)]))
    # ids as differences modulo 2**64, which also holds for the widest range
    names = EliasFano.pack(known.view(np.uint64) - np.uint64(least & 0xFFFFFFFFFFFFFFFF))
    head = _HEAD.pack(MAGIC, len(doc_ids), len(doc_ids) - len(known), len(ids), width, least & 0xFFFFFFFFFFFFFFFF, len(bounds), len(names))
    return head + ids.astype(f"<u{width}").tobytes() + bounds + names


class TokenFile:
    """One file's documents."""

    def __init__(self, blob: bytes):
        magic, self.n_docs, self.n_null, self.n_ids, self.width, least, size, _ = _HEAD.unpack_from(blob)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.least = least - (1 << 64) if least >> 63 else least
        at = _HEAD.size
        self.ids = np.frombuffer(blob, dtype=f"<u{self.width}", count=self.n_ids, offset=at)
        at += self.n_ids * self.width
        self.bounds, self.names = EliasFano(blob[at : at + size]), EliasFano(blob[at + size :])

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.least + self.names.select(i - self.n_null)

    def span(self, i: int) -> tuple[int, int]:
        return self.bounds.select(i), self.bounds.select(i + 1)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def write_corpus(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 max_ids: int = 1 << 22) -> None:
    """Encode and write all documents with a vocabulary as SpacelessVocabulary describes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = spaceless_vocabulary(tokenizer)
        files, root = _filesystem(folder)
        files.create_dir(root, recursive=True)
        partition, seq = TaskContext.get().partitionId(), 0
        names, sizes, parts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal seq, names, sizes, parts, held
            blob = pack_file(names, np.concatenate(sizes), np.concatenate(parts))
            name = f"part-{partition:06d}-{seq:06d}.tok"
            draft = f"{root}/.{name}.{uuid.uuid4().hex}"
            with files.open_output_stream(draft) as out:
                out.write(blob)
            files.move(draft, f"{root}/{name}")
            row = pa.RecordBatch.from_pylist([{"file": name, "n_docs": len(names), "n_ids": held, "n_bytes": len(blob)}])
            seq, names, sizes, parts, held = seq + 1, [], [], [], 0
            return row

        for batch in batches:
            for part in W.slices(batch, text_col, 1 << 20):
                ids, cut = vocabulary.encode_texts(*W.text_bytes(part.column(text_col)))
                names += part.column(id_col).to_pylist()
                sizes.append(np.diff(cut) + 1)
                parts.append(np.insert(ids, cut[1:], end_id).astype(np.uint32))
                held += len(parts[-1])
                if held >= max_ids:
                    yield close()
        if names:
            yield close()

    # ranges by the first characters of the text inside equal ids, so that the sample on the driver holds no texts
    id_order, text_order = F.col(id_col).asc(), F.col(text_col).asc()
    rows = docs.select(id_col, text_col).repartitionByRange(id_order, F.substring(text_col, 1, 16).asc())
    rows = rows.sortWithinPartitions(id_order, text_order)
    rows.mapInArrow(run, "file string, n_docs long, n_ids long, n_bytes long").write.mode("overwrite").parquet(f"{folder}/manifest")


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_le): global offset, count and little-endian 32-bit ids of every document."""
    manifest = spark.read.schema("file string, n_docs long, n_ids long, n_bytes long").parquet(f"{folder}/manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(folder)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                with files.open_input_stream(os.path.join(root, name)) as f:
                    held = TokenFile(f.read())
                for lo in range(0, held.n_docs, 256):
                    rows = range(lo, min(lo + 256, held.n_docs))
                    spans = [held.span(i) for i in rows]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([held.doc_id(i) for i in rows], pa.int64()),
                            pa.array([base + a for a, _ in spans], pa.int64()),
                            pa.array([b - a for a, b in spans], pa.int64()),
                            pa.array([held.ids[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_le"],
                    )

    return placed.repartition("file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_le binary")
