"""Operators on single texts against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wellspring.llm import decontaminate, piece_codec, quality_classifier, quality_rules, token_files
from wellspring.llm.queries import FERTILITY, PIECE_MODEL, WORD_BPE, piece_digests
from wellspring.llm.shared import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    w = WORD.findall(text)
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    cover = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))


def test_quality_rules_base_measures(docs, rows):
    got = quality_rules.judge(docs, FERTILITY).select("doc_id", "text", "measures.*", "base_failed", "kept").collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_base(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
        assert (r.chars_per_piece is None) == (want[0] == 0)


def test_quality_rules_fertility_by_definition(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for r in quality_rules.judge(docs, FERTILITY).select("text", "measures.*").collect():
        w = WORD.findall(r.text or "")
        if not w:
            continue
        ids = [i for x in sp.encode(w) for i in x]
        assert r.n_piece_tokens == len(ids)
        assert r.chars_per_piece == pytest.approx(sum(map(len, w)) / len(ids))
        assert r.fallback_share == pytest.approx(sum(sp.is_byte(i) for i in ids) / len(ids))
        _, n = np.unique(ids, return_counts=True)
        p = n / len(ids)
        most = np.log2(min(max(len(ids), 2), 4096))
        assert r.entropy_share == pytest.approx(min(-(p * np.log2(p)).sum() / most, 1.0), abs=1e-9)


def test_quality_rules_script_bands(spark):
    texts = [("ελληνικό κείμενο " * 8,), ("русский текст слова " * 8,), ("日本語の文章です " * 8,), ("plain latin words " * 8,)]
    got = quality_rules.judge(spark.createDataFrame(texts, "text string"), FERTILITY, lang_col=None).select("measures.script").collect()
    assert sorted(r.script for r in got) == ["cjk", "cyrillic", "greek", "latin"]


def test_quality_rules_each_band_decides(spark):
    r = random.Random(3)
    draw = lambda pool, n: " ".join(r.choice(pool) for _ in range(n))
    letters = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(3, 9))) for _ in range(300))
    small = "the and for you was with that this from have not are but his her they one all she there been their would who what more".split()
    large = ("information government development international university administration environment understanding particularly "
             "communication organization responsibility significant relationship opportunity").split()  # fmt: skip
    prose = ("Rain had fallen through the night, and by morning the lower road was closed. Two farmers brought their carts to the "
             "bridge, looked at the brown water and turned back without a word. Later that week the council met to decide who "
             "should pay for repairs; nobody had kept the old accounts, so the clerk was sent to search the attic.")  # fmt: skip
    cases = {
        "letters": letters,
        "low entropy": draw(small, 400),
        "long words": draw(large, 400),
        "fallback": draw(small + ["water", "river", "stone", "house", "green", "paper", "night"] * 3, 150) + " " + draw(["𓀀", "𓂀", "𓃒"], 3),
        "prose": prose,
    }
    frame = spark.createDataFrame([(k, v, "en") for k, v in cases.items()], "doc_id string, text string, lang string")
    got = {x.doc_id: x for x in quality_rules.judge(frame, FERTILITY).select("doc_id", "measures.*", "base_failed", "kept").collect()}
    assert not any(x.base_failed for x in got.values())
    assert {k for k, x in got.items() if x.kept} == {"prose"}
    band = quality_rules.LANGUAGES["en"]
    assert got["letters"].chars_per_piece < band.chars_min[0] and got["letters"].chars_per_byte_token < band.chars_min[1]
    assert got["letters"].entropy_share >= band.entropy_min and got["letters"].fallback_share <= band.fallback_max
    out = lambda x: (x.entropy_share < band.entropy_min, x.chars_per_piece > band.chars_max[0], x.fallback_share > band.fallback_max)
    assert out(got["low entropy"]) == (True, False, False)
    assert out(got["long words"])[1]
    assert out(got["fallback"]) == (False, False, True)


def test_quality_rules_agree_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality is not null")
    got = quality_rules.judge(docs, FERTILITY).where("not base_failed").join(labels, "doc_id").select("quality", "kept", "lang").collect()
    share = lambda q, langs: np.mean([r.kept for r in got if r.quality == q and r.lang in langs])
    assert share(1, ("en", "de", "fr", "es")) > 0.97
    assert share(0, ("en",)) < 0.2


def test_empty_tables(spark, no_docs, tmp_path):
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.judge(no_docs, FERTILITY).count() == 0
    assert piece_codec.decode(piece_codec.encode(no_docs, PIECE_MODEL), PIECE_MODEL).count() == 0
    assert decontaminate.find_items(no_docs, items).count() == 0
    assert quality_classifier.train(no_docs, labels).score(no_docs).count() == 0
    token_files.write_corpus(no_docs, str(tmp_path / "c"), WORD_BPE, 2)
    assert token_files.read_corpus(spark, str(tmp_path / "c")).count() == 0


def test_piece_codec_is_the_library(docs, rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    coded = piece_codec.decode(piece_codec.encode(docs, PIECE_MODEL, decoded_col="at_once"), PIECE_MODEL)
    assert coded.where("not at_once <=> decoded").count() == 0
    assert coded.columns[: len(docs.columns)] == docs.columns
    for r in coded.collect():
        text = r.text or ""
        want = sp.encode(text)
        assert r.ids == want and r.decoded == sp.decode(want)
        size = len(text.encode())
        if want:
            assert r.starts[0] == 0 and r.ends[-1] == size
            assert all(a <= b for a, b in zip(r.starts, r.ends)) and all(e == s for e, s in zip(r.ends, r.starts[1:]))
    for r in piece_digests(coded).where("doc_id is not null").dropDuplicates(["doc_id"]).collect():
        ids = sp.encode(next(x[1] for x in rows if x[0] == r.doc_id) or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_piece_spans_are_the_text(docs):
    """Pieces of whole characters spell the bytes of their span, but for the space mark put in front."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for r in piece_codec.encode(docs, PIECE_MODEL).collect():
        raw = (r.text or "").replace("▁", " ").encode()
        if "▁" in (r.text or ""):
            continue
        for n, (i, a, b) in enumerate(zip(r.ids, r.starts, r.ends)):
            if not sp.is_byte(i):
                spelled = sp.id_to_piece(i).replace("▁", " ").encode()
                assert raw[a:b] == (spelled[1:] if n == 0 else spelled)


def test_piece_spans_in_the_query(spark, docs, monkeypatch):
    """covered_bytes is the size of the text, spans_crc32 that of the pieces' spans by the library."""
    from wellspring.llm import queries

    monkeypatch.setattr(queries, "table", lambda *_: docs.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"]))
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    text = {r.doc_id: r.text or "" for r in queries.table().collect()}
    got = queries.op8_sentencepiece_codec(spark, "").collect()
    assert len(got) == len(text)
    for r in got:
        raw = text[r.doc_id]
        assert r.covered_bytes == len(raw.encode())
        if not any(map(sp.is_byte, sp.encode(raw))):  # the library gives all bytes of a character to its last byte piece
            spans = ",".join(f"{p.begin}:{p.end}" for p in sp.encode(raw, return_type="proto").pieces)
            assert r.spans_crc32 == zlib.crc32(spans.encode()), r.doc_id


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_encoding_through_a_character_map(spark, tmp_path, rule):
    """A model with a compiled map that squeezes spaces: ids, spans and decoded texts are the library's."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model, spec = pb.ModelProto(), pb.NormalizerSpec()
    with open(PIECE_MODEL, "rb") as f:
        model.ParseFromString(f.read())
    spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())
    model.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = True
    path = str(tmp_path / "mapped.model")
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["ﬁne ① words", "  a  b  ", "Ａｂ　ｃ Straße", "é and é", "½ cup, ㍿", "", "   ", None, "a\tb c\n\nd", "x" * 3000, " ".join(["Ｗide ﬁsh"] * 500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = piece_codec.decode(piece_codec.encode(frame, path), path).collect()
    assert len(got) == len(texts)
    for r in got:
        text = r.text or ""
        proto = sp.encode(text, return_type="proto")
        assert r.ids == [p.id for p in proto.pieces] and r.decoded == sp.decode(r.ids)
        for p, a, b in zip(proto.pieces, r.starts, r.ends):
            assert sp.is_byte(p.id) or (a, b) == (p.begin, p.end), text[:20]
        assert all(a <= b for a, b in zip(r.starts, r.ends)) and list(r.starts) == sorted(r.starts)


def test_compiled_character_map():
    from sentencepiece import sentencepiece_model_pb2 as pb

    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = pb.NormalizerSpec()
    spec.ParseFromString(library.serialized_normalizer_spec())
    own = piece_codec.Normalizer(spec)
    for text in ("ﬁ ①", "  a  b  ", "Ａｂ　ｃ", "é", "ｶﾞ x", "", "   ", "a\tb​ c", "½ ㍿", "日本 語"):
        norm, align = own(text.encode())
        want, offsets = library.normalize(text, with_offsets=True)
        assert norm.decode() == want
        chars = [len(text.encode()[: align[i]].decode()) for i, b in enumerate(norm) if b & 0xC0 != 0x80]
        assert chars == list(offsets)[: len(chars)]


def test_token_files_round_trip(spark, docs, rows, tmp_path):
    tok = Tokenizer.from_file(WORD_BPE)
    folder = str(tmp_path / "corpus")
    token_files.write_corpus(docs, folder, WORD_BPE, 2, max_ids=5_000)
    got = token_files.read_corpus(spark, folder).orderBy("start").collect()
    want = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r.doc_id for r in got] == [w[0] for w in want]
    start = 0
    for r, (_, text) in zip(got, want):
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        assert (r.start, r.n_tokens, bytes(r.ids_le)) == (start, len(ids), ids.tobytes())
        start += len(ids)
    assert spark.read.parquet(f"{folder}/manifest").count() > 1


def test_elias_fano_select():
    r = np.random.default_rng(1)
    for n, top in ((1, 0), (1, 10**9), (5, 3), (1000, 10), (1000, 10**12), (4097, 5000)):
        values = np.sort(r.integers(0, top + 1, n))
        blob = token_files.EliasFano.pack(values)
        packed = token_files.EliasFano(blob)
        assert [packed.select(i) for i in range(n)] == values.tolist()
    n, u = 100_000, 60_000_000
    blob = token_files.EliasFano.pack(np.sort(r.integers(0, u, n)))
    assert 8 * len(blob) / n < 2 + np.log2(u / n) + 1.5


def test_token_file_ids_of_any_range():
    ids = [None, -(2**63), -5, 0, 2**63 - 1]
    held = token_files.TokenFile(token_files.pack_file(ids, np.array([1, 2, 1, 3, 1]), np.arange(8) + 70_000))
    assert [held.doc_id(i) for i in range(5)] == ids and held.width == 4
    assert [held.span(i) for i in range(5)] == [(0, 1), (1, 3), (3, 4), (4, 7), (7, 8)]


def test_decontamination_finds_every_item_passage(spark, docs, rows):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = {r.item_id: r.text for r in items.collect()}
    planted = [(20_000 + i, " ".join(["intro"] * (i % 7)) + " " + t + " and more words after it") for i, t in texts.items()]
    edited = []
    for i, t in texts.items():
        w = t.split()
        w[len(w) // 2] = "edited"
        edited.append((30_000 + i, "before it " + " ".join(w) + " after it"))
    clean = [(40_000 + i, " ".join(reversed(t.split()))) for i, t in texts.items()]
    frame = spark.createDataFrame(planted + edited + clean, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    found = decontaminate.find_items(frame, items).select("doc_id", "text", F.explode("item_matches").alias("m")).collect()
    hit = {(r.doc_id, r.m.item_id): r.m.similarity for r in found}
    for i in texts:
        assert hit[20_000 + i, i] == 1.0
        assert not any(d == 40_000 + i for d, _ in hit)
    sized = {i: len(t.split()) for i, t in texts.items()}
    near = [i for i in texts if sized[i] >= 45]
    assert all((30_000 + i, i) in hit for i in near)
    # every document that holds an item's words in a row
    grams = {i: " " + " ".join(t.lower().split()) + " " for i, t in texts.items()}
    for d, text in ((r[0], r[1]) for r in rows):
        flat = " " + " ".join((text or "").lower().split()) + " "
        assert {i for i, g in grams.items() if g in flat} <= {i for dd, i in hit if dd == d}


def test_decontamination_in_blocks_and_with_edges(spark):
    items = [(1, "a b c"), (2, None), (3, "  "), (4, "the quick brown fox jumps over the lazy dog today"), (4, "the quick brown fox jumps over the lazy dog today"), (None, "zeta eta theta iota kappa lambda mu nu")]
    texts = [(1, "x a b c y"), (2, "a b"), (3, None), (4, "so the quick brown fox jumps over the lazy dog today"), (5, "zeta eta theta iota kappa lambda mu nu")]
    p = decontaminate.DecontaminationParams(items_per_block=2)
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = decontaminate.find_items(frame, spark.createDataFrame(items, "item_id long, text string"), params=p).collect()
    assert {r.doc_id: sorted({m.item_id or 0 for m in r.item_matches}) for r in got} == {1: [1], 2: [], 3: [], 4: [4], 5: [0]}


def test_hamming_index_finds_all_within_radius():
    r = np.random.default_rng(3)
    held = r.integers(0, 1 << 63, 300, dtype=np.uint64)
    asked = held.copy()
    for i in range(len(asked)):
        for b in r.choice(64, i % 8, replace=False):
            asked[i] ^= np.uint64(1) << np.uint64(b)
    q, m, gap = decontaminate.HammingIndex(held, 7).search(asked)
    want = {(i, j) for i in range(300) for j in range(300) if bin(int(asked[i] ^ held[j])).count("1") <= 7}
    assert set(zip(q.tolist(), m.tolist())) == want and gap.max() <= 7


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_classifier.train(docs, labels)
    got = model.score(docs).join(labels, "doc_id").where(quality_classifier.is_held_out("doc_id")).select("quality", "score").collect()
    right = sum((r.score >= 0.3) == (r.quality == 1) for r in got)
    assert right / len(got) > 0.95


def test_classifier_edges(spark, docs, rows):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    votes = [(i, i % 2) for i in ids] + [(ids[0], None), (None, 1), (ids[1], 1), (ids[1], 0)]
    model = quality_classifier.train(docs, spark.createDataFrame(votes, "doc_id long, quality int"), params=quality_classifier.FtrlParams(max_train=50))
    got = model.score(docs)
    assert got.schema["score"].dataType.typeName() == "double" and got.count() == len(rows)
    blank = {r.score for r in got.where("doc_id in (10001, 10002, 10003)").collect()}
    assert len(blank) == 1 and 0 < blank.pop() < 1
    held = {r.doc_id for r in docs.where(quality_classifier.is_held_out("doc_id")).collect()}
    assert held == {r[0] for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 == 0}


def test_ftrl_matches_the_textbook_update():
    p = quality_classifier.FtrlParams(bits=3, updates=80)
    r = np.random.default_rng(0)
    examples = [(np.sort(r.choice(8, 3, replace=False)), r.random(3), int(r.integers(2))) for _ in range(40)]
    z, n = [0.0] * 9, [0.0] * 9

    def weight(i):
        if abs(z[i]) <= p.l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * p.l1) / ((p.beta + n[i] ** 0.5) / p.alpha + p.l2)

    for _ in range(2):
        for slots, values, label in examples:
            x = [*zip(slots.tolist(), values.tolist()), (8, 1.0)]
            w = {i: weight(i) for i, _ in x}
            prob = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x)))
            for i, v in x:
                g = (prob - label) * v
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / p.alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    assert quality_classifier.ftrl(examples, p) == pytest.approx([weight(i) for i in range(9)])


def test_shared_folder_is_the_sessions(spark):
    assert Workspace(spark, "x").root.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECE_MODEL
