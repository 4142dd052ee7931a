"""Sharding by balanced label propagation.

Documents are linked through hubs: they share their whole text, a line of at
least ``min_line_words`` words, or one of the ``min_shingles`` smallest hashes
of their five-word shingles (near copies share most of these). Documents of one
text move as one unit (large groups as several units of at most ``unit_rows``
documents, dealt by a salt).

Start: units in the order of the hash of their largest hub that fits into a
shard (``hub_start`` false: of their own) take shards in equal quotas. Each
iteration joins units with their hubs' shard weights (a hub weighs one over its
size for each member), lets every unit ask for the shard where its links weigh
most, and moves the units of highest gain first, as far as the quotas go: a
shard takes in at most what leaves it, plus its room below ``(1 + slack)`` times
the even size (``first_slack`` at first, narrowing to ``slack``). Quotas are
settled on the shards x shards table of wishes; gains are counted in a fixed
number of levels, so nothing is ranked by one task. After each round the weight
of links inside shards is counted: a round that does not raise it is undone and
ends the iterations.

Finish: only the surplus of over-full shards moves, the documents of least
linked weight first and neighbours together, into the shards with room, until
counts differ by one at most. All others stay where propagation put them.

Hot hubs: weights are summed map-side into at most one row per hub, salt and
shard, and every hub is dealt over ``salts`` tasks in both joins.

Defined results: null and blank texts count 0 bytes plus 8 and have no lines or
shingles; repeated ids are placed like any rows; null ids come first among equal
keys. Further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.llm import words as W
from wellspring.llm.shared import Workspace


@dataclass(frozen=True)
class ShardParams:
    shards: int = 24
    iterations: int = 3
    slack: float = 0.05
    first_slack: float = 0.5
    min_line_words: int = 8
    min_shingles: int = 4
    unit_rows: int = 256
    salts: int = 16
    hub_start: bool = True
    levels: int = 16


def even_out(labelled: DataFrame, loads: dict[int, int], shards: int, work: Workspace, name: str) -> DataFrame:
    """labelled(label, loss, near, content, doc, ...) with shard and slot: the surplus of each label, least loss first, moves."""
    load = np.array([loads.get(s, 0) for s in range(shards)], dtype=np.int64)
    target = np.full(shards, load.sum() // shards)
    target[np.argsort(-load, kind="stable")[: load.sum() % shards]] += 1
    surplus, room = np.maximum(load - target, 0), np.maximum(target - load, 0)

    order = ["label", "loss", "near", "content", "doc", "size", "text_crc32"]
    ranked = labelled.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranked = work.write(ranked, name).withColumn("_part", F.shiftright("_at", 33))
    counts = ranked.groupBy("label", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("label").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    ranked = ranked.join(F.broadcast(counts), ["label", "_part"])  # at most partitions + shards rows
    at = lambda values, i: F.get(F.lit(np.asarray(values, dtype=np.int64).tolist()), i)
    rank = F.col("_at") - F.col("_first") + F.col("_before")
    ranked = ranked.withColumn("_rank", rank).withColumn("_moves", F.col("_rank") < at(surplus, F.col("label")))
    # movers in order of shard and rank fill the rooms in order of shard
    upto = np.cumsum(room)
    ranked = ranked.withColumn("_mover", at(np.cumsum(surplus) - surplus, F.col("label")) + F.col("_rank"))
    to = F.size(F.filter(F.lit(upto.tolist()), lambda e: e <= F.col("_mover")))
    ranked = ranked.withColumn("shard", F.when(F.col("_moves"), to).otherwise(F.col("label")).cast("int"))
    slot = F.when(F.col("_moves"), at(load, F.col("shard")) + F.col("_mover") - at(upto - room, F.col("shard")))
    ranked = ranked.withColumn("slot", slot.otherwise(F.col("_rank") - at(surplus, F.col("label"))).cast("long"))
    return ranked.drop("_at", "_part", "_first", "_n", "_before", "_rank", "_moves", "_mover")


def _text_hubs(data: np.ndarray, offs: np.ndarray, p: ShardParams) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of long lines and of each row's least five-word shingles."""
    words = W.find_words(data, offs)
    lines = W.find_lines(data, offs)
    first, stop = np.searchsorted(words.start, lines.start), np.searchsorted(words.start, lines.end)
    long = np.flatnonzero(stop - first >= p.min_line_words)
    line = W.hash_spans(data, words.start[first[long]], words.end[stop[long] - 1])
    value, _, row = W.windows(W.hash_spans(data, words.start, words.end, lower=True), words.split, 5)
    of, least = _least(value, row, len(offs) - 1, p.min_shingles)
    rows, hubs = np.concatenate([lines.row[long], of]), np.concatenate([line, least])
    by = np.argsort(rows, kind="stable")
    return rows[by], hubs[by].view(np.int64)


def _least(value: np.ndarray, row: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the k least different values (their upper 48 bits) of each row."""

    def pick(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = np.unique(row[some].astype(np.uint64) << np.uint64(48) | value[some] >> np.uint64(16))
        of = (key >> np.uint64(48)).astype(np.int64)
        first = np.arange(len(key)) - np.searchsorted(of, of) < k
        return of[first], key[first] << np.uint64(16)

    # few values lie below 8 k over the row's count; a row with too few of them is sorted whole
    share = 8 * k / np.maximum(np.bincount(row, minlength=n), 8 * k)
    low = value >> np.uint64(1) < (share * 2.0**63).astype(np.uint64)[row]
    of, least = pick(low)
    short = np.bincount(of, minlength=n) < k
    more_of, more = pick(short[row])
    good = ~short[of]
    return np.concatenate([of[good], more_of]), np.concatenate([least[good], more])


def documents_and_hubs(docs: DataFrame, id_col: str, text_col: str, p: ShardParams) -> tuple[DataFrame, DataFrame]:
    """(doc rows with text hash and salt, edges (content, hub)) of all documents."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("content"),
    )
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc", F.lit(5)), F.lit(64)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", 1 << 20):
                row, hub = _text_hubs(*W.text_bytes(part.column("text")), p)
                yield pa.RecordBatch.from_arrays([part.column("content").take(pa.array(row)), pa.array(hub)], names=["content", "hub"])

    texts = docs.select(F.xxhash64(text).alias("content"), text.alias("text"))
    edges = texts.mapInArrow(run, T.StructType([T.StructField("content", T.LongType()), T.StructField("hub", T.LongType())]))
    return rows, edges.distinct()


def quotas(demand: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The part of demand[from, to] that may move, so that no shard gains more than its room and what leaves it."""
    asked = np.maximum(demand.sum(axis=0), 1e-9)
    share = np.ones(len(room))
    for _ in range(200):
        leaving = demand @ share
        less = np.minimum(share, np.clip((room + leaving) / asked, 0, 1))
        if np.allclose(less, share):
            break
        share = less
    return demand * share


def _weights(members: DataFrame) -> DataFrame:
    """Per (hub, salt): documents of the hub under each shard, as an array over all salts of the hub."""
    part = members.groupBy("hub", "salt", "shard").agg(F.sum("w").alias("w"))
    per_hub = part.groupBy("hub", "shard").agg(F.sum("w").alias("w"))
    tally = per_hub.groupBy("hub").agg(F.map_from_entries(F.collect_list(F.struct("shard", "w"))).alias("tally"))
    return part.select("hub", "salt").distinct().join(tally, "hub")


def wishes(state: DataFrame, edges: DataFrame) -> DataFrame:
    """(content, part, shard, rows, to, best, stay): link weight of each linked unit at its best shard and its own."""
    linked = edges.join(state.select("content", "part", "rows", "shard"), "content")
    tally = _weights(linked.withColumn("w", F.col("rows")))
    votes = linked.join(tally, ["hub", "salt"]).select("content", "part", "shard", "rows", "degree", F.explode("tally").alias("to", "w"))
    # a unit's own documents are no vote for staying
    vote = F.sum((F.col("w") - F.when(F.col("to") == F.col("shard"), F.col("rows")).otherwise(0)) / F.col("degree"))
    votes = votes.groupBy("content", "part", "shard", "rows", "to").agg(vote.alias("w"))
    best = votes.groupBy("content", "part", "shard", "rows").agg(
        F.max(F.struct("w", F.col("to"))).alias("b"), F.max(F.when(F.col("to") == F.col("shard"), F.col("w"))).alias("stay")
    )
    return best.select("content", "part", "shard", "rows", "b.to", F.col("b.w").alias("best"), F.coalesce("stay", F.lit(0.0)).alias("stay"))


def kept_weight(wish: DataFrame) -> float:
    """Weight of all links inside shards; the weight of all links less this is what is cut."""
    return wish.agg(F.sum(F.col("stay") * F.col("rows"))).first()[0] or 0.0


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: ShardParams = ShardParams()) -> DataFrame:
    """(id, size, text_crc32, shard, slot, first_shard, wished_shard, n_links) for every document.

    first_shard: where it started; wished_shard: where propagation put it, before the shards were evened out.
    """
    p, spark = params, docs.sparkSession
    work = Workspace(spark, "shards")
    rows, edges = documents_and_hubs(docs, id_col, text_col, p)
    rows = work.write(rows, "rows")

    # units: documents of one text, large groups in parts of about unit_rows
    groups = rows.groupBy("content", "salt").agg(F.count("*").alias("n"))
    groups = groups.join(groups.groupBy("content").agg(F.sum("n").alias("all")), "content")
    parts = F.least(F.lit(64), F.ceil(F.col("all") / p.unit_rows)).cast("int")
    units = groups.withColumn("part", F.pmod("salt", parts)).groupBy("content", "part").agg(F.sum("n").alias("rows"), F.max("all").alias("copies"))

    # hubs that join several texts; hubs of one text need no edge
    hubs = edges.withColumn("salt", F.pmod(F.xxhash64("content", F.lit(3)), F.lit(p.salts)).cast("int"))
    sizes = hubs.groupBy("hub", "salt").agg(F.count("*").alias("k"))
    total = sizes.groupBy("hub").agg(F.sum("k").alias("degree")).where("degree > 1")
    shared = sizes.select("hub", "salt").join(total, "hub")
    edges = work.write(hubs.join(shared, ["hub", "salt"]).select("content", "hub", "salt", "degree"), "edges")
    all_rows = rows.count()
    fits = F.when(F.col("degree") <= max(2.0, all_rows / p.shards), F.col("degree"))
    heaviest = edges.groupBy("content").agg(F.max(F.struct(fits.alias("degree"), "hub")).alias("h"), F.count("*").alias("n_links"))
    hub = F.when(F.lit(p.hub_start) & F.col("h.degree").isNotNull(), F.col("h.hub"))
    units = units.join(heaviest, "content", "left").select(
        "content", "part", "rows", "copies", F.coalesce(hub, "content").alias("near"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    units = work.write(units, "units")

    # equal quotas along the order of those hubs
    near = units.groupBy("near").agg(F.sum("rows").alias("rows"))
    bucket = near.groupBy(F.shiftright("near", 48).alias("bucket")).agg(F.sum("rows").alias("rows"))
    run = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 65,536 rows
    bucket = bucket.withColumn("shard", F.least(F.floor(F.coalesce(F.sum("rows").over(run), F.lit(0)) * p.shards / max(all_rows, 1)), F.lit(p.shards - 1)).cast("int"))
    state = units.withColumn("bucket", F.shiftright("near", 48)).join(F.broadcast(bucket.select("bucket", "shard")), "bucket").drop("bucket")
    state = work.write(state.withColumn("first_shard", F.col("shard")), "state-0")

    even = all_rows / p.shards
    wish = work.write(wishes(state, edges), "wishes-0")
    kept = kept_weight(wish)
    for i in range(p.iterations):
        gain = F.col("best") - F.col("stay")
        asks = wish.where((F.col("to") != F.col("shard")) & (gain > 1e-9)).select(
            "content", "part", "to",
            # high gains first; equal gains by a hash, in fine steps
            F.least(F.floor(-F.log2(gain) + 4), F.lit(p.levels - 1)).cast("int").alias("g"),
            F.pmod(F.xxhash64("content", "part", F.lit(i)), F.lit(64)).cast("int").alias("step"),
        )
        asks = asks.withColumn("level", F.greatest("g", F.lit(0)) * 64 + F.col("step"))
        asked = work.write(state.join(asks.select("content", "part", "to", "level"), ["content", "part"], "left"), f"asked-{i}")
        flow = asked.where("to is not null").groupBy("shard", "to", "level").agg(F.sum("rows").alias("rows"))
        ahead = Window.partitionBy("shard", "to").orderBy("level")  # at most levels * 64 rows
        flow = flow.withColumn("upto", F.sum("rows").over(ahead))
        demand = np.zeros((p.shards, p.shards))
        for r in flow.groupBy("shard", "to").agg(F.sum("rows").alias("d")).collect():  # at most shards**2 rows
            demand[r.shard, r.to] = r.d
        load = np.zeros(p.shards)
        for s, n in shard_loads(asked).items():
            load[s] = n
        slack = p.slack + (p.first_slack - p.slack) * (1 - i / max(1, p.iterations - 1))
        allowed = quotas(demand, even * (1 + slack) - load)
        quota = spark.createDataFrame([(j, k, float(allowed[j, k])) for j in range(p.shards) for k in range(p.shards)], "shard int, to int, quota double")
        moving = flow.join(F.broadcast(quota), ["shard", "to"]).where("upto <= quota").select("shard", "to", "level", F.lit(True).alias("moves"))
        moved = asked.join(F.broadcast(moving), ["shard", "to", "level"], "left")  # at most shards**2 * levels * 64 rows
        after = F.when(F.col("moves"), F.col("to")).otherwise(F.col("shard")).alias("shard")
        next_state = work.write(moved.select("content", "part", "rows", "copies", "near", "n_links", after, "first_shard"), f"state-{i + 1}")
        next_wish = work.write(wishes(next_state, edges), f"wishes-{i + 1}")
        better = kept_weight(next_wish)
        if better <= kept:
            break
        state, wish, kept = next_state, next_wish, better

    # every document finds its unit by content and salt; a copy loses the other copies, a linked one its weight
    parts_of = groups.select("content", "salt", F.pmod("salt", parts).alias("part"))
    loss = F.coalesce("stay", F.lit(0.0)) + F.when(F.col("copies") > 1, 1).otherwise(0)
    last = state.join(wish.select("content", "part", "stay"), ["content", "part"], "left").withColumn("loss", F.ceil(4 * loss))
    homes = parts_of.join(last, ["content", "part"]).select("content", "salt", "near", "n_links", "first_shard", "loss", F.col("shard").alias("label"))
    out = even_out(rows.join(homes, ["content", "salt"]), shard_loads(state), p.shards, work, "ordered")
    work.drop("rows", "edges", "units", *(f"{t}-{i}" for t in ("asked", "state", "wishes") for i in range(p.iterations + 1)))
    return out.select(F.col("doc").alias(id_col), "size", "text_crc32", "shard", "slot", "first_shard", F.col("label").alias("wished_shard"), "n_links")


def shard_loads(state: DataFrame) -> dict[int, int]:
    return {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("rows").alias("n")).collect()}  # at most one row a shard


def cut_edges(placed: DataFrame, edges: DataFrame) -> DataFrame:
    """(hub members, members outside their hub's main shard) of placed(content, shard) and edges(content, hub)."""
    at = edges.join(placed.select("content", "shard"), "content").groupBy("hub", "shard").agg(F.count("*").alias("n"))
    return at.groupBy("hub").agg(F.sum("n").alias("n"), F.max("n").alias("m")).agg(F.sum("n").alias("members"), F.sum(F.col("n") - F.col("m")).alias("outside"))
