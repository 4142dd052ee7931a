"""Cleaning pipeline over documents: five stages, each written as Parquet before the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of docs. Columns that a stage works with carry two
underscores in front, so they clash with none of the input's.

Null and blank texts fail the quality rules. Of each near-duplicate group the
document of the smallest id stays; rows of equal id and text count as one;
rows with a null id stay unless they are near copies of one with an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.llm import decontaminate, ngram_join, piece_codec, quality_classifier, quality_rules
from wellspring.llm.queries import FERTILITY, KEEP_SCORE, PIECE_MODEL, piece_digests
from wellspring.llm.shared import Workspace, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from their labels, accepts."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return model.score(docs, out_col="__score").where(F.col("__score") >= KEEP_SCORE).select(*docs.columns)


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands of their language or script."""
    m = "__measures"
    measured = quality_rules.measure(docs, FERTILITY, out_col=m)
    lang = "lang" if "lang" in docs.columns else None
    kept = ~quality_rules.base_failed(m) & quality_rules.in_bands(quality_rules.FertilityRules(), lang, m)
    return measured.where(kept).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    classes = ngram_join.similarity_classes(docs)
    first = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__id")).distinct()
    kept = docs.join(first, docs.doc_id.eqNullSafe(F.col("__id")), "left_semi")
    return kept.withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"]).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"), out_col="__items")
    return found.where(F.size("__items") == 0).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the encoded and decoded texts."""
    return piece_digests(piece_codec.encode(docs.select("doc_id", "text"), PIECE_MODEL, drop_text=True, decoded_col="decoded"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("quality_rules", keep_by_rules),
    ("ngram_jaccard_join", keep_one_of_each),
    ("benchmark_decontamination", drop_benchmark),
    ("sentencepiece_codec", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written and read again."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
