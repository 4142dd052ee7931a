"""Structured Streaming: landing file ingest and the micro-batch increment.

``ingest_landing`` reads new JSON files as they arrive (file source, each file
once, tracked by the checkpoint), splits unparseable records to a corrupt side
table and appends the good ones to the landing table. Every append is named by
its micro-batch, so a batch that is replayed replaces its own rows.
``stream_increment`` runs the incremental build for every micro-batch via
``foreachBatch``. Window functions such as ``row_number`` are not supported on
streams, so de-duplication happens inside ``foreachBatch`` on the static batch.
``max_files`` bounds the files of one micro-batch; results don't depend on it,
except where an increment's own load and event windows do.
``trigger(availableNow=True)`` processes what is there and stops. ``ward_kpi`` is
the stateful form of the headline aggregate: windows under a watermark, and a
recompute from stored rows for what comes after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import iff, safe_ratio
from ..operators.incremental import TableStore
from ..plans.increment import run_increment
from ..plans.marts import ward_day
from ..plans.staging import dedupe_submission, standardise_submission
from ..sources.landing import is_corrupt, raw_from_landing


def landing_stream(spark: SparkSession, src_dir: str, glob: str = "*.json", whole_files: bool = True,
                   max_files: int | None = None) -> DataFrame:
    """Streaming landing rows: payload VARIANT, raw text, source file, ingest time.

    ``whole_files``: a file is one document, however it is laid out; otherwise
    each line is one. ``src_dir`` is the landing prefix (``.../raw``), read with
    its sub-folders.
    """
    reader = (spark.readStream.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
              .option("wholetext", str(whole_files).lower()))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(src_dir).select(
        F.explode(F.array(F.try_parse_json(F.col("value")))).alias("payload"),  # parsed once, see landing_table
        F.col("value").alias("payload_text"),
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("ingested_at"),
    )


def _run(stream: DataFrame, batch, checkpoint: str, mode: str = "append") -> None:
    (stream.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def land_batch(store: TableStore, df: DataFrame, batch_id: int) -> None:
    """Append one micro-batch to ``landing`` and ``landing_corrupt``; what a replay replaces is deleted.

    The files are read and parsed once for both; only corrupt rows keep their text.
    """
    rows = df.withColumn("payload_text", F.when(is_corrupt(), F.col("payload_text")))
    columns = lambda without: [c for c in df.columns if c != without]
    store.append_split(rows, is_corrupt(), ("landing", columns("payload_text")), ("landing_corrupt", columns("payload")), str(batch_id))
    store.vacuum("landing")
    store.vacuum("landing_corrupt")


def ingest_landing(spark: SparkSession, src_dir: str, checkpoint: str, store: TableStore, glob: str = "*.json",
                   whole_files: bool = True, max_files: int | None = None) -> None:
    """Append new files' records to ``landing`` (corrupt ones to ``landing_corrupt``); run to completion."""
    stream = landing_stream(spark, src_dir, glob, whole_files, max_files)
    _run(stream, lambda df, batch_id: land_batch(store, df, batch_id), checkpoint)


def read_landing(store: TableStore) -> DataFrame | None:
    """The landing table (``payload`` is stored as VARIANT)."""
    return store.read("landing")


def stream_increment(spark: SparkSession, src_dir: str, checkpoint: str, store: TableStore, as_of,
                     glob: str = "*.json", whole_files: bool = True, max_files: int | None = None) -> None:
    """For each micro-batch of landing records: land it, flatten, then one incremental build."""
    stream = landing_stream(spark, src_dir, glob, whole_files, max_files)

    def batch(df: DataFrame, batch_id: int) -> None:
        land_batch(store, df, batch_id)
        landed = store.read_batch("landing", str(batch_id))
        run_increment(store, raw_from_landing(landed), as_of, batch=str(batch_id))

    _run(stream, batch, checkpoint)


def latest_submissions(store: TableStore, landed: DataFrame, buckets: int = 64) -> None:
    """Merge a batch's latest submission per id into ``submission_latest``.

    Whichever of (stored, new) comes first under the dedupe's total order
    stays; a NULL id is one key, as in the dedupe's window. The table is kept
    in hash buckets of the id: a batch reads and rewrites only those of its
    keys.
    """
    subs = dedupe_submission(standardise_submission(raw_from_landing(landed).submissions))
    bucket = F.pmod(F.xxhash64("submission_id"), F.lit(buckets))
    store.merge_partitions("submission_latest", subs, bucket, lambda old, new: dedupe_submission(old.unionByName(new)))
    store.vacuum("submission_latest")


def stream_dedupe(spark: SparkSession, src_dir: str, checkpoint: str, store: TableStore, glob: str = "*.json",
                  whole_files: bool = True, max_files: int | None = None) -> None:
    """Latest submission per id across micro-batches (dedupe in the batch, then merge)."""
    stream = landing_stream(spark, src_dir, glob, whole_files, max_files)

    def batch(df: DataFrame, batch_id: int) -> None:
        land_batch(store, df, batch_id)
        latest_submissions(store, store.read_batch("landing", str(batch_id)))

    _run(stream, batch, checkpoint)


def windowed_counts(spark: SparkSession, events_path: str, checkpoint: str, store: TableStore, window: str = "day",
                    max_files: int | None = None) -> None:
    """Late-data aware counts per window and event type from the ``events`` stream.

    Each micro-batch is stored, then every window it falls in is computed again
    from the stored rows and upserted. A row is never too late, and no state is
    held between batches. ``events_path`` may be a glob.
    """
    reader = spark.readStream.schema(spark.read.parquet(events_path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def batch(df: DataFrame, batch_id: int) -> None:
        start = F.date_trunc(window, F.col("ts")).cast("timestamp_ntz")
        rows = df.withColumn("window_start", start)
        stored = store.append("events", rows, batch=str(batch_id))
        touched = store.read_batch("events", str(batch_id)).select("window_start", "event_type").distinct()
        store.upsert("event_windows", window_totals(stored.join(touched, ["window_start", "event_type"], "left_semi"), window),
                     ["window_start", "event_type"])

    _run(reader.parquet(events_path), batch, checkpoint)


def window_totals(rows: DataFrame, window: str) -> DataFrame:
    """Counts and value totals per window_start and event type."""
    end = F.timestamp_add(window.upper(), F.lit(1), F.col("window_start"))
    return rows.groupBy("window_start", "event_type").agg(
        F.count(F.lit(1)).cast("long").alias("n_events"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value"),
    ).select("window_start", end.alias("window_end"), "event_type", "n_events", "total_value")


def ward_kpi(spark: SparkSession, src_dir: str, schema, checkpoint: str, store: TableStore, delay: str = "30 days",
             max_files: int | None = None) -> None:
    """Ward-by-day KPI of a stream of fact files, within and after the watermark; run to completion.

    Each micro-batch is stored, and a second, stateful query reads the stored
    batches, each whole as one micro-batch of its own: windows by ward and day
    that stay open until the watermark (``delay`` behind the newest event of
    earlier batches) has passed them, in update mode. Its changed ward days are
    merged into ``ward_day_stream``. Spark drops rows of closed windows, and
    rows without a time have no window: the ward days of such rows are computed
    again from all stored rows into ``ward_day_late``. A batch is stored once
    and its merges replace themselves, so a replay changes nothing.
    ``read_ward_kpi`` joins the two tables.
    """
    feed = f"{store.root}/ward_facts"

    def batch(df: DataFrame, batch_id: int) -> None:
        folder = f"{feed}/batch={batch_id}"
        # visible as a whole or not at all, and the same rows again in a replay: written once
        if not _is_written(spark, folder):
            month = F.coalesce(F.trunc("event_date", "month").cast("string"), F.lit("none"))
            rows = df.withColumn("event_month", month).hint("rebalance", "event_month")
            rows.write.mode("overwrite").partitionBy("event_month").parquet(folder)
        late_ward_days(spark, store, feed, schema, batch_id, delay)
        stored = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(feed)
        _run(open_ward_days(stored, delay), lambda changed, _: merge_ward_days(store, "ward_day_stream", changed),
             f"{checkpoint}/windows", "update")

    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    _run(reader.parquet(src_dir), batch, f"{checkpoint}/files")


def _is_written(spark: SparkSession, folder: str) -> bool:
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def open_ward_days(facts: DataFrame, delay: str) -> DataFrame:
    """Stateful counts by ward and one-day window of the event time.

    A watermark needs an instant; the wall-clock time is taken as UTC, whatever
    the session's zone, so windows are its days.
    """
    at = F.expr("timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', submitted_at))")
    timed = facts.withColumn("__at", at).withWatermark("__at", delay)
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.expr("cast(unix_seconds(day.start) div 86400 as int)"))
    safe = F.sum(iff("is_safe_drinking", F.lit(1), F.lit(0))).cast("long")
    return timed.groupBy(F.window("__at", "1 day").alias("day"), "ward_id").agg(
        F.count(F.lit(1)).cast("long").alias("household_events_total"), safe.alias("household_events_safe"),
    ).select("ward_id", date.alias("event_date"), "household_events_total", "household_events_safe")


def merge_ward_days(store: TableStore, name: str, changed: DataFrame) -> None:
    """Replace the changed ward days, in the event months that they fall in; a null ward or day is a key as any other."""
    key = lambda df: df.select(F.col("ward_id").alias("__w"), F.col("event_date").alias("__d"))
    same = F.col("ward_id").eqNullSafe(F.col("__w")) & F.col("event_date").eqNullSafe(F.col("__d"))
    store.merge_partitions(name, changed, F.trunc("event_date", "month"),
                           lambda old, new: old.join(key(new), same, "left_anti").unionByName(new))


def late_ward_days(spark: SparkSession, store: TableStore, feed: str, schema, batch_id: int, delay: str) -> None:
    """Compute the ward days of a stored batch's late and timeless rows again from the rows stored so far."""
    batch = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{feed}/batch={batch_id}")
    newest = store.append("ward_newest", batch.agg(F.max("submitted_at").alias("at"), F.lit(batch_id).alias("batch")), str(batch_id))
    newest = newest.where(F.col("batch") < batch_id).agg(F.max("at")).first()[0]  # one row per batch
    late = F.col("submitted_at").isNull()
    if newest is not None:
        bound = F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
        late = late | (F.timestamp_add("DAY", F.lit(1), F.to_date("submitted_at").cast("timestamp_ntz")) <= bound)
    keys = batch.where(late).select("ward_id", "event_date").distinct()
    month = F.coalesce(F.trunc("event_date", "month").cast("string"), F.lit("none"))
    months = [r[0] for r in keys.select(month).distinct().collect()]  # event months of late rows, not rows
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("event_month", T.StringType())])
    stored = spark.read.schema(whole).parquet(feed)  # by batch and event month: only late months' folders are read
    touched = stored.where((F.col("batch") <= batch_id) & F.col("event_month").isin(months)).drop("batch", "event_month")
    keys = keys.select(F.col("ward_id").alias("__w"), F.col("event_date").alias("__d"))
    same = F.col("ward_id").eqNullSafe(F.col("__w")) & F.col("event_date").eqNullSafe(F.col("__d"))
    again = ward_day(touched.join(keys, same, "left_semi"))
    merge_ward_days(store, "ward_day_late", again.drop("pct_safe"))


def read_ward_kpi(store: TableStore) -> DataFrame:
    """The KPI of all rows so far: ward days computed again where late rows came, else the stream's own."""
    late = store.read("ward_day_late")
    key = late.select(F.col("ward_id").alias("__w"), F.col("event_date").alias("__d"))
    same = F.col("ward_id").eqNullSafe(F.col("__w")) & F.col("event_date").eqNullSafe(F.col("__d"))
    both = store.read("ward_day_stream").join(key, same, "left_anti").unionByName(late)
    return both.withColumn("pct_safe", safe_ratio("household_events_safe", "household_events_total", 2))
