"""SentencePiece encoding with byte offsets into the original text, and decoding.

Encoding first normalises as the model says: at each position the longest
prefix found in the compiled character map is replaced, otherwise one
character is kept; spaces become U+2581 and one is put in front. Every
normalised byte keeps the position of the original byte it comes from, and the
pieces, laid end to end over the normalised bytes, are projected through that
alignment to spans of the original UTF-8 bytes.

The normalised text is cut where no piece can span (before a space and around a
newline, each only if no piece of the model does); the parts are encoded by the
sentencepiece library without its own normaliser, each different part once per
worker. A model in which pieces span spaces is encoded whole.

Defined results: null and empty texts have empty lists and decode to "";
output columns replace input columns of the same name; ids null decode to null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wellspring.llm import words as W
from wellspring.llm.word_pieces import WordCache

SPACE_MARK = "▁".encode()
_CODED = ("ids", "starts", "ends")


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 bytes and its replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.text = blob[4 + size :]

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest entry that is a prefix of raw[at:]."""
        units, found = self.units, None
        unit = units[0]
        node = _offset(unit)
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != raw[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.text[found[1] : self.text.index(b"\0", found[1])]


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


def _character(raw: bytes, at: int) -> int:
    lead = raw[at]
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normalizer:
    """The normaliser of a model, with alignment to the original bytes."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, original position of each of them and of the end)."""
        if not raw:
            return b"", np.zeros(1, dtype=np.int32)
        if not self.map and not self.squeeze and self.escape:
            return self._plain(raw)
        return self._mapped(raw)

    def _plain(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        data = np.frombuffer(raw, dtype=np.uint8)
        at = np.arange(len(data), dtype=np.int32)
        first = np.maximum.accumulate(np.where(data & 0xC0 != 0x80, at, 0))
        align = np.repeat(first, np.where(data == 0x20, len(SPACE_MARK), 1))
        head = SPACE_MARK if self.prefix else b""
        return head + raw.replace(b" ", SPACE_MARK), np.concatenate([np.zeros(len(head), np.int32), align, [np.int32(len(data))]])

    def _mapped(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        mark = SPACE_MARK if self.escape else b" "
        parts: list[tuple[int, int, bytes]] = []
        at = 0
        while at < len(raw):
            hit = self.map.longest(raw, at) if self.map else None
            n = hit[0] if hit else _character(raw, at)
            parts.append((at, n, hit[1] if hit else raw[at : at + n]))
            at += n
        if self.squeeze:
            while parts and parts[0][2] == b" ":
                parts.pop(0)
            if not parts:
                return b"", np.zeros(1, dtype=np.int32)
        out, align = bytearray(), []
        if self.prefix:
            out += mark
            align += [parts[0][0]] * len(mark)
        after_space, end = self.squeeze, len(raw)
        for at, _, put in parts:
            if after_space:
                put = put.lstrip(b" ")
            if put:
                spelled = put.replace(b" ", mark)
                out += spelled
                align += [at] * len(spelled)
                after_space = self.squeeze and put.endswith(b" ")
        if self.squeeze:
            while out.endswith(mark):
                del out[-len(mark) :]
                end = align[len(out)]
                del align[len(out) :]
        return bytes(out), np.array([*align, end], dtype=np.int32)


class PieceCodec(WordCache):
    """A sentencepiece model: encoding of normalised parts, and surfaces for decoding."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.normalizer = Normalizer(proto.normalizer_spec)
        normal = [p.piece.encode() for p in proto.pieces if p.type == pb.ModelProto.SentencePiece.NORMAL]
        if any(p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in proto.pieces):
            raise ValueError("models with user-defined symbols are not supported")
        self.cut_spaces = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in normal)
        self.cut_lines = self.cut_spaces and not any(b"\n" in p for p in normal)
        self.whole = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = pb.NormalizerSpec(name="identity", add_dummy_prefix=False, remove_extra_whitespaces=False, escape_whitespaces=False)
        proto.normalizer_spec.CopyFrom(spec)
        inner = sentencepiece.SentencePieceProcessor()
        inner.LoadFromSerializedProto(proto.SerializeToString())
        kinds = pb.ModelProto.SentencePiece
        surface, self.piece_bytes = [], []
        for i, p in enumerate(proto.pieces):
            byte = bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else None
            spelled = byte or p.piece.encode()
            hidden = p.type in (kinds.CONTROL, kinds.UNKNOWN)
            surface.append(b"" if hidden else spelled if byte else spelled.replace(SPACE_MARK, b" "))
            self.piece_bytes.append(len(spelled))
        self.piece_bytes = np.array(self.piece_bytes)
        self.unknown = {i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN}
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.surface_cut = np.concatenate([[0], np.cumsum([len(x) for x in surface])])
        self.opens_space = np.array([x[:1] == b" " for x in surface])
        super().__init__(lambda new: inner.encode([x.decode("utf-8") for x in new], num_threads=1))

    def parts(self, norm: bytes) -> list[bytes]:
        """Cut normalised bytes where no piece can span."""
        if not norm:
            return []
        if not self.cut_spaces:
            return [norm]
        data = np.frombuffer(norm, dtype=np.uint8)
        mark = np.zeros(len(data) + 3, dtype=bool)
        mark[3:] = False
        is_mark = np.zeros(len(data), dtype=bool)
        is_mark[: max(len(data) - 2, 0)] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
        mark[3:] = is_mark
        cut = is_mark & ~mark[: len(data)]
        if self.cut_lines:
            line = data == 10
            cut |= line
            cut[1:] |= line[:-1]
        cut[0] = True
        at = [*np.flatnonzero(cut).tolist(), len(norm)]
        return [norm[a:b] for a, b in zip(at, at[1:])]

    def encode_texts(self, data: bytes, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, end, row offsets) of all rows' pieces; spans count original bytes from the row's start."""
        spelled, rows, aligns = [], [], []
        for a, b in zip(offs.tolist(), offs[1:].tolist()):
            norm, align = self.normalizer(data[a:b])
            parts = self.parts(norm)
            spelled += parts
            rows.append(len(parts))
            aligns.append(align)
        ids, part_cut = self.encode(spelled)
        cut = part_cut[np.concatenate([[0], np.cumsum(rows, dtype=np.int64)])]
        size = self.piece_bytes[ids]
        if self.unknown and np.isin(ids, list(self.unknown)).any():
            raise ValueError("a model without byte fallback leaves unknown characters, whose length its ids don't tell")
        ends = np.cumsum(size)
        starts = ends - size
        base = np.concatenate([[0], ends])[cut]
        shift = np.concatenate([[0], np.cumsum([len(x) for x in aligns])])
        row = np.repeat(np.arange(len(rows)), np.diff(cut))
        align = np.concatenate(aligns) if aligns else np.zeros(0, np.int32)
        to = shift[row] - base[row]
        return ids, align[starts + to], align[ends + to], cut

    def decode_ids(self, ids: np.ndarray, cut: np.ndarray) -> list[str]:
        """Texts of the rows' ids."""
        start, size = self.surface_cut[ids], np.diff(self.surface_cut)[ids]
        at = np.concatenate([[0], np.cumsum(size)])
        raw = self.surface[np.arange(at[-1]) + np.repeat(start - at[:-1], size)].tobytes()
        out = []
        for i, (a, b) in enumerate(zip(cut.tolist(), cut[1:].tolist())):
            skip = int(self.normalizer.prefix and a < b and bool(self.opens_space[ids[a]]))
            try:
                out.append(raw[at[a] + skip : at[b]].decode("utf-8"))
            except UnicodeDecodeError:  # byte pieces that are no whole characters
                out.append(self.whole.decode(ids[a:b].tolist()))
        return out


@lru_cache(maxsize=2)
def piece_codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode(docs: DataFrame, model: str, text_col: str = "text", drop_text: bool = False, decoded_col: str | None = None) -> DataFrame:
    """docs with ids, starts and ends (lists of int): each piece and its span of the text's UTF-8 bytes.

    decoded_col: a further column with the text that the ids decode to.
    """
    base = [f for f in docs.schema.fields if f.name not in (*_CODED, decoded_col) and not (drop_text and f.name == text_col)]
    more = [decoded_col] if decoded_col else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for batch in batches:
            for part in W.slices(batch, text_col, 1 << 20):
                data, offs = W.text_bytes(part.column(text_col))
                ids, start, end, cut = codec.encode_texts(data.tobytes(), offs)
                at = pa.array(cut.astype(np.int32))
                out = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (ids, start, end)]
                out += [pa.array(codec.decode_ids(ids, cut), pa.string()) for _ in more]
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in base] + out, names=[f.name for f in base] + [*_CODED, *more])

    coded = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in _CODED] + [T.StructField(c, T.StringType()) for c in more]
    return docs.mapInArrow(run, T.StructType([*base, *coded]))


def decode(coded: DataFrame, model: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """coded with the text of its ids."""
    base = [f for f in coded.schema.fields if f.name != out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                col = part.column(ids_col)
                ids = pc.cast(pc.list_flatten(col), pa.int64()).to_numpy(zero_copy_only=False)
                sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
                texts = codec.decode_ids(ids, np.concatenate([[0], np.cumsum(sizes)]))
                texts = pa.array(texts, pa.string(), mask=col.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in base] + [texts], names=[f.name for f in base] + [out_col])

    return coded.mapInArrow(run, T.StructType([*base, T.StructField(out_col, T.StringType())]))
