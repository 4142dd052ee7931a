"""Registered queries of the subpackage: thin contracts over the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.llm import (
    balanced_shards,
    decontaminate,
    merkle_manifest,
    ngram_join,
    periodic_runs,
    perspectives,
    piece_codec,
    pii,
    quality_classifier,
    quality_rules,
    suffix_tree_lm,
    token_files,
    url_lists,
)
from wellspring.llm.shared import Workspace, table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
FERTILITY = quality_rules.Vocabularies(PIECE_MODEL, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
KEEP_SCORE = 0.3


def op1_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = perspectives.rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return views.withColumn("mask", F.array_join(spans, ","))


def op2_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.judge(docs, FERTILITY).select("doc_id", "measures.*", "base_failed", "kept")


def op3_balanced_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = balanced_shards.assign(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "first_shard", "n_links",
    )


def op4_elias_fano_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Workspace(spark, "token-files").root
    token_files.write_corpus(table(spark, sf_dir, "documents"), folder, WORD_BPE, end_id=2)
    return token_files.read_corpus(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids_le").alias("ids_crc32"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark")).select("doc_id", F.explode("item_matches").alias("m"))
    return found.select("doc_id", "m.*")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"))


def op7_suffix_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = suffix_tree_lm.is_held_out("doc_id")
    scored = suffix_tree_lm.score(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), *[c for c in scored.columns if c != "doc_id"])


def op8_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_codec.encode(docs, PIECE_MODEL, drop_text=True, decoded_col="decoded")
    spans = F.zip_with("starts", "ends", lambda a, b: F.concat_ws(":", a.cast("string"), b.cast("string")))
    covered = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda n, size: n + size)
    return piece_digests(coded, covered.alias("covered_bytes"), F.crc32(F.array_join(spans, ",").cast("binary")).alias("spans_crc32"))


def piece_digests(coded: DataFrame, *more: Column) -> DataFrame:
    """The contract's digests of encoded and decoded texts, and further columns of coded."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *more,
    )


def op9_temporal_list_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.expr("date_add(DATE'2024-01-01', CAST((page_id * 37) % 730 AS INT))"))
    return url_lists.evaluate(captures, url_lists.dated_changes(pages))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select(
        "doc_id",
        quality_classifier.is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, checked against texts of which some lost their line ends."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    torn = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaf = merkle_manifest.row_hash("doc_id", "source", "lang", "n_chars", "text")
    shown = merkle_manifest.row_hash("doc_id", "source", "lang", "n_chars", torn).alias("shown")
    proofs = merkle_manifest.manifest(table(spark, sf_dir, "documents"), leaf, carry=("doc_id", shown)).select("doc_id", "shown", "merkle.*")
    folded = proofs.withColumn("folded_root", merkle_manifest.fold(F.col("shown"), F.col("proof")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle_manifest.proof_hash(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all texts, every tenth of them made periodic from some word on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(docs, pattern=periodic_runs.planted("doc_id", "text"))
    best = periodic_runs.strongest(F.col("runs"))
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), drop_text=True)
    base = F.filter("pii", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, pii.BASE_KINDS), F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("pii")).alias("spans")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_perspective_rotation": op1_perspective_rotation,
    "op2_tokeniser_fertility": op2_tokeniser_fertility,
    "op3_balanced_label_propagation": op3_balanced_label_propagation,
    "op4_elias_fano_corpus": op4_elias_fano_corpus,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_suffix_tree_scoring": op7_suffix_tree_scoring,
    "op8_sentencepiece_codec": op8_sentencepiece_codec,
    "op9_temporal_list_join": op9_temporal_list_join,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_pii": op13_pii,
}

ORACLE: dict[str, str] = {
    "op1_perspective_rotation": perspectives.ORACLE_SQL,
    "op9_temporal_list_join": url_lists.ORACLE_SQL,
    "op11_merkle_manifest": merkle_manifest.ORACLE_SQL,
    "op12_periodic_runs": periodic_runs.ORACLE_SQL,
}
