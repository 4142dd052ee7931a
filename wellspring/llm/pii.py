"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

Each kind has a pattern, a check of the matched text and a score. The check
drops what it refuses (octets over 255, Luhn, mod 97, weighted digits of bank
routing numbers, counts of digits). A word near the span that speaks for or
against the kind, up to ``REACH`` code points before it or half as many after
it, raises or lowers the score. Kinds whose pattern says little on its own
(identity numbers, phone numbers without a country code) reach the least score
only with such a word.

The base kinds email, ip, card and phone match leftmost and without overlap
per kind, and a match that fails its check is dropped without a second try.
They are kept whatever the words around them; the score says how sure they
are. Spans of the other kinds are kept from ``min_score`` up, unless they
overlap a base span or a surer one.

All patterns take time linear in the text: repeats are possessive or bounded,
and an email is found from its ``@`` outwards. Documents are independent, so
there is no shuffle, and memory holds one batch.

Results: null and empty texts have no spans. Positions are code points, the
end exclusive. Null ids and repeated rows keep their rows. An empty table gives
an empty one. All input columns are kept; one named like the result column is
replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.llm import words as W

BASE_KINDS = ("email", "ip", "card", "phone")
REACH = 48
MIN_SCORE = 0.5
_SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])
)
SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"

# Length of an international bank account number by country.
IBAN_LENGTH = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
    "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IBAN_HEAD = re.compile(rf"(?<![A-Za-z0-9])(?:{'|'.join(IBAN_LENGTH)})[0-9]{{2}}(?=[ A-Z0-9])")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9])*+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The check of account numbers: moved by four, letters as 10 to 35, the rest modulo 97 is 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def routing(digits: str) -> bool:
    """The weighted check digit of US bank routing numbers."""
    return sum(w * int(c) for w, c in zip((3, 7, 1) * 3, digits)) % 10 == 0 and digits != "0" * 9


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start, step = at, 64
        while start > end:
            lo = max(end, start - step)
            start = lo + len(text[lo:start].rstrip(_LOCAL))
            if start > lo:
                break
            step *= 2
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", at + 1)


def _by(pattern: str) -> Callable[[str], Iterator[tuple[int, int]]]:
    find = re.compile(pattern).finditer
    return lambda text: (m.span() for m in find(text))


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    for head in _IBAN_HEAD.finditer(text):
        start, size = head.start(), IBAN_LENGTH[head.group()[:2]]
        rest = _IBAN_REST.match(text, head.end(), head.end() + 2 * size)
        end, held = head.end(), 4
        while held < size and end < rest.end():
            held += text[end] != " "
            end += 1
        if held == size and not text[end : end + 1].isalnum():
            yield start, end


class Kind(NamedTuple):
    name: str
    propose: Callable[[str], Iterator[tuple[int, int]]]
    check: Callable[[str], bool]
    score: float
    words_for: str = ""
    words_against: str = ""


# The kinds with their patterns and context words, in the order in which spans of one start are listed.
KINDS = (
    Kind("email", _emails, lambda s: True, 0.8, "e-?mail|mail|contact|kontakt|correo|courriel|write|schreib"),
    Kind("ip", _by(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"), lambda s: all(len(p.lstrip("0")) < 4 and int(p[-3:]) < 256 for p in s.split(".")),
         0.6, "ip|address|adresse|host|server|client|login", "version|release|section|chapter"),
    Kind("card", _by(r"[0-9](?:[ -]?[0-9])++"), lambda s: 12 <= len(d := _digits(s)) <= 19 and luhn(d),
         0.6, "card|karte|carte|tarjeta|visa|master|amex|credit|debit", "isbn|serial|order|tracking"),
    Kind("phone", _by(r"\+[0-9][ ().0-9-]+[0-9]"), lambda s: 9 <= len(_digits(s)) <= 15,
         0.7, "phone|tel|call|fax|mobile|cell|handy|anruf|appel|llam"),
    Kind("iban", _accounts, lambda s: mod97(s.replace(" ", "")), 0.7, "iban|account|konto|compte|cuenta|bank|bic"),
    Kind("routing", _by(r"(?<![0-9A-Za-z.-])[0-9]{9}(?![0-9A-Za-z-])"), routing, 0.2, "routing|aba|wire|transfer"),
    Kind("ssn", _by(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"), lambda s: True,
         0.3, "ssn|social security|security (?:no|number)|tax(?:payer)? id"),
    Kind("local_phone", _by(r"(?<![0-9+().-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3}[ .-][0-9]{3,4}(?![0-9])"),
         lambda s: 8 <= len(_digits(s)) <= 11, 0.3, "phone|tel|call|fax|mobile|cell|handy|anruf|appel|llam", "isbn|order|version|date"),
)
_RANK = {k.name: i for i, k in enumerate(KINDS)}
_NEAR = {
    k.name: tuple(re.compile(rf"(?<![a-z])(?:{p})") if p else None for p in (k.words_for, k.words_against)) for k in KINDS
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float
    base: bool


def _score(kind: Kind, text: str, start: int, end: int) -> float:
    around = text[max(0, start - REACH) : start].lower() + " " + text[end : end + REACH // 2].lower()
    good, bad = _NEAR[kind.name]
    score = kind.score + (0.3 if good and good.search(around) else 0) - (0.3 if bad and bad.search(around) else 0)
    return round(min(1.0, max(0.0, score)), 3)


def spans_of(text: str, min_score: float = MIN_SCORE) -> list[Span]:
    """All spans of a text by start, then kind as listed."""
    base: list[Span] = []
    more: list[Span] = []
    for kind in KINDS:
        own = kind.name in BASE_KINDS
        for start, end in kind.propose(text):
            if kind.check(text[start:end]):
                score = _score(kind, text, start, end)
                if own:
                    base.append(Span(kind.name, start, end, score, True))
                elif score >= min_score:
                    more.append(Span(kind.name, start, end, score, False))
    if more:
        taken = bytearray(len(text))
        for span in base:
            taken[span.start : span.end] = b"\1" * (span.end - span.start)
        for span in sorted(more, key=lambda s: (-s.score, s.start, _RANK[s.kind])):
            if taken.find(1, span.start, span.end) < 0:
                base.append(span)
                taken[span.start : span.end] = b"\1" * (span.end - span.start)
    return sorted(base, key=lambda s: (s.start, _RANK[s.kind]))


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii", min_score: float = MIN_SCORE, drop_text: bool = False) -> DataFrame:
    """The rows with out_col, the array of their spans; drop_text leaves the text out."""
    drop = [out_col] + ([text_col] if drop_text else [])
    kept = [c for c in docs.columns if c not in drop]
    source = docs.select(*kept, F.col(text_col).alias("__text"))
    schema = source.select(*kept, F.lit(None).cast(SPANS).alias(out_col)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "__text"):
                found = [[s._asdict() for s in spans_of(t, min_score)] if t else [] for t in part.column("__text").to_pylist()]
                columns = [part.column(i) for i in range(len(kept))] + [pa.array(found, _SPANS_ARROW)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, out_col])

    return source.mapInArrow(run, schema)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
