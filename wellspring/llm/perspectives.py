"""Chat formatting: every participant's perspective on a many-party dialogue.

For each participant of a dialogue (each speaker that is no system role), the
whole dialogue is rendered with that speaker as the assistant, the others as
named users and system turns as they are, with a mask of the character spans
that the speaker wrote (its texts with their end markers).

A row holds up to ``block_turns`` consecutive turns of one perspective, so that
no dialogue, however long, meets in one task or one row: usual dialogues are
one row, longer ones continue in further blocks, cut between turns. Positions
come from one range-partitioned sort and a sum over per-partition counts.

Defined results: turns are ordered by turn (nulls last), speaker and text, and
equal rows all stay; a null or blank speaker is "unknown"; a null text is
empty; null dialogue ids are one dialogue; markers inside a text are broken up,
so that no text can forge a turn. A dialogue of system turns alone has no
participant and gives no row. Further columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.shared import Workspace


@dataclass(frozen=True)
class ChatFormat:
    """start + role (+ name) + newline + text + end + newline is one rendered turn."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    marker: str = "<|im_"
    broken: str = "<| im_"
    system_roles: tuple[str, ...] = ("system",)
    block_turns: int = 64


def positions(turns: DataFrame, key: str, order: list[Column], name: str) -> DataFrame:
    """turns with the 0-based place ``pos`` of each row in its key's order, for keys of any size."""
    work = Workspace(turns.sparkSession, name)
    by = [F.col(key).asc_nulls_last(), *order, F.col("_source")]
    ranked = (
        turns.withColumn("_source", F.monotonically_increasing_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .drop("_source")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    ranked = work.write(ranked, "ranked").withColumn("_part", F.shiftright("_at", 33))
    counts = ranked.groupBy(F.col(key).alias("_key"), "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumnRenamed("_part", "_p")
    joined = ranked.join(counts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_p", "_key", "_first", "_n", "_before")


def rotate(
    turns: DataFrame,
    dialogue_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
    fmt: ChatFormat = ChatFormat(),
) -> DataFrame:
    """(dialogue_col, speaker, block, n_turns, text, mask); mask is an array of (start, end) in characters of text."""
    name = F.regexp_replace(F.coalesce(F.col(speaker_col).cast("string"), F.lit("")), "[^A-Za-z0-9_.-]+", "_")
    rows = turns.select(
        F.col(dialogue_col).alias("dialogue"),
        F.col(turn_col).alias("turn"),
        F.when(name.isin("", "_"), "unknown").otherwise(name).alias("who"),
        F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(fmt.marker), F.lit(fmt.broken)).alias("said"),
    )
    placed = positions(rows, "dialogue", [F.col("turn").asc_nulls_last(), F.col("who"), F.col("said")], "perspectives")
    blocks = (
        placed.withColumn("block", F.floor(F.col("pos") / fmt.block_turns))
        .groupBy("dialogue", "block")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "who", "said"))).alias("turns"))
    )
    speakers = placed.where(~F.col("who").isin(*fmt.system_roles)).select(F.col("dialogue").alias("of"), F.col("who").alias("speaker")).distinct()
    views = blocks.join(speakers, F.col("dialogue").eqNullSafe(F.col("of")))

    def head(t: Column) -> Column:
        role = (
            F.when(t["who"] == F.col("speaker"), "assistant")
            .when(t["who"].isin(*fmt.system_roles), t["who"])
            .otherwise(F.concat(F.lit("user name="), t["who"]))
        )
        return F.concat(F.lit(fmt.start), role, F.lit("\n"))

    views = views.withColumn("heads", F.transform("turns", head))
    views = views.withColumn("parts", F.zip_with("heads", "turns", lambda h, t: F.concat(h, t["said"], F.lit(fmt.end + "\n"))))
    sizes = F.transform("parts", F.length)
    views = views.withColumn("ends", F.aggregate(sizes, F.array().cast("array<int>"), lambda out, n: F.array_append(out, n + F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0)))))
    spans = F.transform(
        "turns",
        lambda t, i: F.struct(
            (t["who"] == F.col("speaker")).alias("own"),
            (F.get("ends", i) - F.length(F.get("parts", i)) + F.length(F.get("heads", i))).alias("start"),
            (F.get("ends", i) - 1).alias("end"),
        ),
    )
    mask = F.transform(F.filter(spans, lambda s: s["own"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return views.select(
        F.col("dialogue").alias(dialogue_col),
        "speaker",
        "block",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join("parts", "").alias("text"),
        mask.alias("mask"),
    )


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn,
         CASE WHEN regexp_replace(coalesce(role, ''), '[^A-Za-z0-9_.-]+', '_', 'g') IN ('', '_') THEN 'unknown'
              ELSE regexp_replace(coalesce(role, ''), '[^A-Za-z0-9_.-]+', '_', 'g') END AS who,
         replace(coalesce(text, ''), '<|im_', '<| im_') AS said
  FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, who, said) - 1 AS pos FROM t),
s AS (SELECT DISTINCT conv_id, who AS speaker FROM t WHERE who <> 'system'),
h AS (
  SELECT p.conv_id, s.speaker, p.pos // 64 AS block, p.pos, p.who = s.speaker AS own,
         '<|im_start|>' || CASE WHEN p.who = s.speaker THEN 'assistant' WHEN p.who = 'system' THEN 'system'
                                ELSE 'user name=' || p.who END || chr(10) AS head, p.said
  FROM p JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
r AS (SELECT *, head || said || '<|im_end|>' || chr(10) AS part FROM h),
e AS (SELECT *, sum(length(part)) OVER (PARTITION BY conv_id, speaker, block ORDER BY pos) AS stop FROM r)
SELECT conv_id, speaker, block, count(*) AS n_turns, string_agg(part, '' ORDER BY pos) AS text,
       string_agg((stop - length(part) + length(head))::BIGINT || ':' || (stop - 1)::BIGINT, ',' ORDER BY pos) FILTER (WHERE own) AS mask
FROM e GROUP BY conv_id, speaker, block
"""
