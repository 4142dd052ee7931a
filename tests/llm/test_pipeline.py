"""The pipeline's stages on documents with edge cases."""

from __future__ import annotations

import hashlib

import sentencepiece
from corpus_rows import SF
from test_corpus_operators import brute_classes
from test_text_operators import brute_base

import corpus_pipeline as C
from wellspring.llm.queries import PIECE_MODEL


def test_stages_keep_columns_and_take_effect(spark, docs, tmp_path):
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece_codec"]
    frame, kept = docs.where("not doc_id <=> 10010 and not doc_id <=> 10011"), {}
    for name, stage in C.STAGES:
        before = frame
        stage(spark, frame, SF).write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        kept[name] = frame
        assert name == "sentencepiece_codec" or frame.columns == before.columns
    rows = lambda name: [(r.doc_id, r.text) for r in kept[name].collect()]
    ruled = rows("quality_rules")
    assert all(brute_base(t)[0] >= 10 for _, t in ruled)
    classes = brute_classes(ruled)
    one = rows("ngram_jaccard_join")
    with_id = sorted({c for (d, _), (_, c) in classes.items() if c is not None})
    assert sorted(d for d, _ in one if d is not None) == with_id and len(one) == len(set(one))
    items = [" " + " ".join(r.text.lower().split()) + " " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = rows("benchmark_decontamination")
    flat = lambda t: " " + " ".join(t.lower().split()) + " "
    assert {d for d, t in one if not any(i in flat(t) for i in items)} == {d for d, _ in clean}
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    want = {(d, hashlib.sha256(",".join(map(str, sp.encode(t))).encode()).hexdigest()) for d, t in clean}
    assert {(r.doc_id, r.ids_sha256) for r in kept["sentencepiece_codec"].collect()} == want
