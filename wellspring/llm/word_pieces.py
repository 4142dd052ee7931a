"""Public vocabularies applied word by word, with a bounded cache in each Python worker.

No piece of these vocabularies spans a space, so a text's tokens are those of
its words, and each different word needs encoding only once per worker.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np

CACHE_WORDS = 600_000
CACHE_BYTES = 160 << 20
_ENTRY_BYTES = 150  # a word's object, its place in the index and its ids


class WordCache:
    """Ids of words. encode_new gets the words not seen yet and returns a list of id lists."""

    def __init__(self, encode_new: Callable[[list], list[list[int]]], cache_words: int = CACHE_WORDS):
        self._encode_new, self._most = encode_new, cache_words
        self._clear()

    def _clear(self) -> None:
        self._index: dict = {}
        self._bytes = 0
        self._ids = np.zeros(1 << 16, dtype=np.int32)
        self._cut = np.zeros(1 << 16, dtype=np.int64)

    @property
    def is_full(self) -> bool:
        return len(self._index) > self._most or self._bytes > CACHE_BYTES

    def index(self, words: Sequence) -> np.ndarray:
        """Cache positions of the words, after encoding those that are new."""
        if self.is_full:
            self._clear()
        new = [w for w in dict.fromkeys(words) if w not in self._index]
        if new:
            first = len(self._index)
            self._index.update(zip(new, range(first, first + len(new))))
            self._bytes += sum(map(len, new)) + _ENTRY_BYTES * len(new)
            encoded = self._encode_new(new)
            cut = self._cut[first] + np.cumsum([len(x) for x in encoded])
            while len(self._cut) <= first + len(new):
                self._cut = np.concatenate([self._cut, np.zeros_like(self._cut)])
            while len(self._ids) < cut[-1]:
                self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
            self._ids[self._cut[first] : cut[-1]] = [i for x in encoded for i in x]
            self._cut[first + 1 : first + 1 + len(new)] = cut
        return np.fromiter(map(self._index.__getitem__, words), dtype=np.int64, count=len(words))

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, offsets of each word's ids)."""
        start, count = self._cut[at], self._cut[at + 1] - self._cut[at]
        cut = np.zeros(len(at) + 1, dtype=np.int64)
        np.cumsum(count, out=cut[1:])
        return self._ids[np.arange(cut[-1]) + np.repeat(start - cut[:-1], count)], cut

    def encode(self, words: Sequence) -> tuple[np.ndarray, np.ndarray]:
        return self.gather(self.index(words))


class PieceVocabulary(WordCache):
    """A sentencepiece model; a word stands for the word with one space before it.

    byte_ranks, pattern: a byte-level BPE whose token counts of the same words
    are kept beside the pieces, in ``byte_tokens``.
    """

    def __init__(self, path: str, byte_ranks: str | None = None, pattern: str = ""):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.byte_tokens = np.zeros(1 << 16, dtype=np.int32)
        self._byte_bpe = _byte_bpe(byte_ranks, pattern) if byte_ranks else None
        super().__init__(self._encode)

    def _encode(self, new: list[bytes]) -> list[list[int]]:
        text = [w.decode("utf-8", "replace") for w in new]
        if self._byte_bpe:
            first = len(self._index) - len(new)
            while len(self.byte_tokens) < first + len(new):
                self.byte_tokens = np.concatenate([self.byte_tokens, np.zeros_like(self.byte_tokens)])
            encode = self._byte_bpe.encode_ordinary
            self.byte_tokens[first : first + len(new)] = [len(encode(" " + w)) for w in text]
        return self.model.encode(text, num_threads=1)


def _byte_bpe(path: str, pattern: str):
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class SpacelessVocabulary(WordCache):
    """A vocabulary of the tokenizers library that lower-cases, drops white space and splits letters from punctuation.

    With such a vocabulary a text's ids are those of its words, ASCII capitals
    may be folded beforehand, and a word may be cut between an ASCII letter and
    the punctuation after it. Special tokens spelled in a text keep their case.
    """

    _MARKS = b".,;:!?|"

    def __init__(self, path: str, cache_words: int):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        super().__init__(
            lambda new: [e.ids for e in tok.encode_batch_fast([w.decode("utf-8") for w in new], add_special_tokens=False)], cache_words
        )
        self._fold = np.arange(256, dtype=np.uint8)
        self._fold[65:91] += 32
        self._letter = np.zeros(256, dtype=bool)
        self._letter[65:91] = self._letter[97:123] = True
        self._mark = np.zeros(256, dtype=bool)
        self._mark[list(self._MARKS)] = True

    def encode_texts(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, offsets of each row's ids)."""
        from wellspring.llm import words as W

        if b"<|" not in data.tobytes():
            data = self._fold[data]
            at = np.flatnonzero(self._letter[data[:-1]] & self._mark[data[1:]]) + 1
            at = at[~np.isin(at, offs)]
            offs = offs + np.searchsorted(at, offs)
            data = np.insert(data, at, 0x20)
        words = W.find_words(data, offs)
        raw = data.tobytes()
        ids, cut = self.encode([raw[a:b] for a, b in zip(words.start.tolist(), words.end.tolist())])
        return ids, cut[words.split]


@lru_cache(maxsize=2)
def spaceless_vocabulary(path: str, cache_words: int = 900_000) -> SpacelessVocabulary:
    return SpacelessVocabulary(path, cache_words)


@lru_cache(maxsize=2)
def piece_vocabulary(path: str, byte_ranks: str | None = None, pattern: str = "") -> PieceVocabulary:
    return PieceVocabulary(path, byte_ranks, pattern)
