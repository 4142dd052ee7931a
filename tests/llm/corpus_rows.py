"""Documents with edge cases for the tests."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, sig long, measures string"


def words(n, seed, pool=400):
    r = random.Random(seed)
    return [f"w{r.randrange(pool)}" for _ in range(n)]


def edge_texts():
    """Nulls, blanks, ties, repeated rows, odd characters, short and very long texts."""
    base = words(300, 1)
    near = base[:]
    near[20] = "changed"
    far = [w if i % 6 else f"x{i}" for i, w in enumerate(base)]
    long = words(60_000, 2, 5_000)
    return [
        (10_001, None), (10_002, ""), (10_003, " \t\n\x0b"), (10_004, "one two three"), (10_005, "ONE Two three"),
        (10_006, " ".join(base)), (10_007, " ".join(near)), (10_008, " ".join(far)), (10_009, " ".join(base).upper()),
        (10_009, " ".join(base).upper()), (None, " ".join(near)), (None, "a lone text without an id"),
        (10_010, " ".join(long)), (10_011, " ".join(long[:-200])), (10_012, "日本語 текст ελληνικά 🙂 é ﻿ ▁x <|endoftext|> <|ENDOFTEXT|>"),
        (10_013, "a a a a a a a a a a a a a a a a a a a a a a a a"), (10_014, "\n".join(["same line here of words"] * 6)),
        (10_015, "it's we'LL x.'s a,b a.,b !!a.! <s> </s> <unk> <0x0A> İ İ"), (10_016, "x" * 50_000), (10_017, "é ü z\x00"),
    ]
