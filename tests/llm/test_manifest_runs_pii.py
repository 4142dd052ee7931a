"""The Merkle manifest, periodic runs and personal data against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from wellspring.llm import merkle_manifest, periodic_runs, pii, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    root = tmp_path_factory.mktemp("edge")
    docs.write.parquet(f"{root}/documents.parquet")
    return str(root)


@pytest.fixture(scope="module")
def empty_folder(no_docs, tmp_path_factory):
    root = tmp_path_factory.mktemp("empty")
    no_docs.write.parquet(f"{root}/documents.parquet")
    return str(root)


# op11


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    out = []
    for level in tree[:-1]:
        lo = i // 3 * 3
        out.append(("".join(level[lo:i]), "".join(level[i + 1 : lo + 3])))
        i //= 3
    return out


def brute_manifest(rows):
    """rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, sha(*map(field, r)), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda x: x[:3])
    trees = {s: levels([x[2] for x in groups[s]]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, leaf, row) in enumerate(groups[s]):
            proof, shown = path(trees[s], i) + path(top, k), list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                shown[4] = row[4].replace("\n", "")
            node = sha(*map(field, shown))
            for left, right in proof:
                node = sha(left, node, right)
            out.append((row[0], leaf, trees[s][-1][0], top[-1][0], sha(*[a + b for a, b in proof]), node, node == top[-1][0]))
    return in_order(out)


def as_fields(rows):
    return [(i, source, lang, n, text) for i, text, lang, source, n, *_ in rows]


def test_manifest_query_equals_brute_force(spark, folder, rows):
    assert in_order(queries.op11_merkle_manifest(spark, folder).collect()) == brute_manifest(as_fields(rows))


@pytest.mark.parametrize("block_levels", [1, 2])
def test_manifest_blocks_of_any_size_give_the_same_proofs(spark, rows, block_levels):
    many = [(k % 40, "big" if k % 3 else None, None, k, f"t{k % 7}\n") for k in range(300)] + [(None, "lone", "x", None, None)]
    many += [many[0], many[0], (5, "é", "x", 0, "")]
    docs = spark.createDataFrame(many, "doc_id long, source string, lang string, n_chars long, text string")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    made = merkle_manifest.manifest(docs, merkle_manifest.row_hash(*fields), carry=fields, block_levels=block_levels)
    again = made.where(merkle_manifest.fold(F.col("merkle.leaf"), F.col("merkle.proof")) == F.col("merkle.root"))
    got = in_order(again.select("doc_id", "merkle.leaf", merkle_manifest.proof_hash(F.col("merkle.proof"))).collect())
    assert got == in_order((r[0], r[1], r[4]) for r in brute_manifest(many))


def test_manifest_sql_equals_brute_force(folder, rows):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert in_order(duckdb.sql(merkle_manifest.ORACLE_SQL).fetchall()) == brute_manifest(as_fields(rows))


def test_manifest_of_nothing_and_of_one_row(spark, empty_folder):
    assert queries.op11_merkle_manifest(spark, empty_folder).collect() == []
    one = spark.createDataFrame([(1, "a")], "doc_id long, source string")
    (row,) = merkle_manifest.manifest(one, merkle_manifest.row_hash("doc_id", "source")).collect()
    assert row.merkle.leaf == row.merkle.subroot == row.merkle.root == sha("1:11:a") and row.merkle.proof == []
    with pytest.raises(ValueError):
        merkle_manifest.manifest(one.withColumnRenamed("source", "merkle"), F.sha2("merkle", 256), group="merkle", carry=("merkle",))


# op12


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, q, size) for (s, size), q in found.items())


def altered(doc_id, words):
    n = len(words)
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_run_row(doc_id, text):
    words = altered(doc_id, WORD.findall(text or ""))
    runs = brute_runs(words)
    dropped = {i for s, q, size in runs for i in range(s + q, s + size)}
    best = None
    for s, q, size in runs:
        if best is None or size * best[1] > best[2] * q:
            best = (s, q, size)
    top = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    listed = "".join(f"{s},{size},{q}\n" for s, q, size in runs)
    return (doc_id, len(runs), *top, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def repetitive_texts(seed, n):
    r = random.Random(seed)
    for k in range(n):
        words = []
        for _ in range(r.randrange(7)):
            block = [r.choice("ab" if r.random() < 0.5 else "abcdefgh") for _ in range(r.randrange(1, 14))]
            words += block * r.randrange(1, 4) * r.randrange(1, 9)
        yield (k if k % 7 else None, " \t".join(words))


def test_runs_equal_brute_force(spark, rows, tmp_path):
    texts = list(repetitive_texts(5, 900))
    texts += [(1, "a " * 3000), (2, "q " * 6), (3, "q " * 5), (9, " ".join([f"w{i}" for i in range(700)] * 5)), (9, "x y x y x y x y")]
    texts += [(i, t) for i, t, *_ in rows if len(t or "") < 60_000]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = in_order(queries.op12_periodic_runs(spark, str(tmp_path)).collect())
    assert got == in_order(brute_run_row(*t) for t in texts)


def test_a_long_run_is_stitched_from_many_tiles(spark, docs, no_docs):
    long = [(i, " ".join(f"w{j % period}" for j in range(40_000))) for i, period in enumerate((1, 3, 1000, 10_000, 10_001))]
    found = {r.doc_id: r.runs for r in periodic_runs.find_runs(spark.createDataFrame(long, "doc_id long, text string")).collect()}
    assert [[tuple(x) for x in found[i]] for i in range(5)] == [[(0, p, 40_000)] for p in (1, 3, 1000, 10_000)] + [[]]
    assert periodic_runs.find_runs(docs).count() == docs.count()
    assert periodic_runs.find_runs(no_docs).collect() == []


def test_z_function():
    r = random.Random(1)
    for _ in range(200):
        seq = [r.randrange(3) for _ in range(r.randrange(30))]
        want = [next((k for k in range(len(seq) - i) if seq[k] != seq[i + k]), len(seq) - i) for i in range(len(seq))]
        assert periodic_runs.z_function(seq) == want


# op13


def plain_luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and plain_luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


PARTS = ["a", "Z", "@", "@", ".", ".", "-", "+", " ", "(", ")", "é", "1", "25", "255", "256", "007", "4111111111111111", "1.2.3.4", "x@y.z", "_", "日"]


def odd_texts(n):
    r = random.Random(3)
    return ["".join(r.choice(PARTS) for _ in range(r.randrange(40))) for _ in range(n)]


def test_base_spans_equal_plain_patterns():
    for text in odd_texts(5000):
        assert [f"{s.kind}:{s.start}:{s.end}" for s in pii.spans_of(text) if s.base] == brute_spans(text)


def test_pii_query_equals_plain_patterns(spark, folder, empty_folder, rows):
    got = in_order(r[:6] for r in queries.op13_pii(spark, folder).collect())
    want = []
    for doc_id, text, *_ in rows:
        spans = brute_spans(text or "")
        want.append((doc_id, *(sum(s.startswith(k + ":") for s in spans) for k in ("email", "ip", "card", "phone")), sha(",".join(spans))))
    assert got == in_order(want)
    assert queries.op13_pii(spark, empty_folder).collect() == []


def kinds(text):
    return [s.kind for s in pii.spans_of(text) if not s.base]


def test_checksums_confirm_and_words_decide():
    assert kinds("to DE89 3704 0044 0532 0130 00 AND on") == ["iban"]
    assert kinds("to DE89 3704 0044 0532 0130 01 AND on") == []
    assert kinds("DE89370400440532013000X") == []
    assert kinds("call 555-123-4567 now") == ["local_phone"] and kinds("lines 555-123-4567 here") == []
    assert kinds("her SSN is 078-05-1120") == ["ssn"] and kinds("part 078-05-1120") == []
    assert kinds("routing 021000021") == ["routing"] and kinds("routing 021000022") == []
    near, far = pii.spans_of("server 1.2.3.4"), pii.spans_of("version 1.2.3.4")
    assert near[0].score > far[0].score and near[0].base and far[0].base


def test_pii_keeps_other_columns_and_replaces_its_own(spark):
    docs = spark.createDataFrame([(1, "x@y.zz", "old", 3), (None, None, "old", None)], "doc_id long, text string, pii string, start int")
    got = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    assert got[1].start == 3 and got[1].text == "x@y.zz" and [s.kind for s in got[1].pii] == ["email"]
    assert got[None].pii == []


def test_pii_is_linear_in_long_texts():
    for text in ("1." * 50_000, "a@" * 50_000, "@" * 100_000, "+1 " * 50_000, "a" * 200_000, "1" * 200_000, "DE12 " * 20_000):
        assert all(s.base for s in pii.spans_of(text))
