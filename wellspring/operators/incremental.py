"""Incremental table operators: lookback windows, append, upsert, versioned publish.

Spark's parquet tables have no MERGE, and a job cannot overwrite a path it
reads. An upsert is therefore a pure DataFrame step (``upsert``: target rows
whose key is not in the source, plus all source rows) written to *new
folders*, which one pointer file makes visible after their data is committed,
so a failed or retried job never exposes partial output.

Scalar bounds (max load time of a target) are one-row aggregates collected
once and passed back as literals, which lets parquet skip row groups.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.valuesets import EVENT_LOOKBACK_DAYS, INCREMENTAL_BASE_TS, LOAD_LOOKBACK_DAYS
from ..session import PARQUET_CODEC, dropping_shuffles, unsorted_partitions


def target_max(target: DataFrame | None, col: str):
    """``max(col)`` of a target table (None when empty or absent)."""
    if target is None:
        return None
    return target.agg(F.max(F.col(col)).alias("m")).first()["m"]


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return F.lit(v).cast("timestamp_ntz")
    return F.lit(str(v)).cast("timestamp_ntz")


def append_new(df: DataFrame, target: DataFrame | None, load_col: str = "_loaded_at",
               base_ts: str = INCREMENTAL_BASE_TS, target_col: str | None = None) -> DataFrame:
    """Rows to append to an append-only table.

    First run (no target): every row, NULL load times included. Later runs:
    only ``load_col > coalesce(max(target), base_ts)`` (strict, as shipped: a
    later batch with an equal load time is not appended).
    """
    if target is None:
        return df
    m = target_max(target, target_col or load_col)
    bound = _ts(m) if m is not None else _ts(base_ts)
    return df.where(F.col(load_col) > bound)


def window_start(target_max_value, days: int = LOAD_LOOKBACK_DAYS, base_ts: str = INCREMENTAL_BASE_TS) -> Column:
    """``coalesce(max(target), base_ts) - days``."""
    base = _ts(target_max_value) if target_max_value is not None else _ts(base_ts)
    return F.timestamp_add("DAY", F.lit(-days), base)


def load_window(df: DataFrame, target_max_value, load_col: str = "record_loaded_at",
                days: int = LOAD_LOOKBACK_DAYS, base_ts: str = INCREMENTAL_BASE_TS) -> DataFrame:
    """Rows loaded within ``days`` before the target's newest load time."""
    return df.where(F.col(load_col) >= window_start(target_max_value, days, base_ts))


def event_window(df: DataFrame, as_of, col: str = "event_date", days: int = EVENT_LOOKBACK_DAYS) -> DataFrame:
    """Rows whose event date is within ``days`` before ``as_of`` (injected current date)."""
    return df.where(F.col(col) >= F.date_sub(F.lit(str(as_of)).cast("date"), days))


def backfill_range(df: DataFrame, start, end, col: str = "event_date") -> DataFrame:
    """Rows with ``start <= col <= end`` (dates), to re-merge a past range."""
    return df.where(F.col(col).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))


def sync_schema(target: DataFrame, columns: Sequence, types: dict) -> DataFrame:
    """Target projected onto the source's columns: new ones NULL, dropped ones gone."""
    have = set(target.columns)
    return target.select(*[F.col(c).cast(types[c]) if c in have else F.lit(None).cast(types[c]).alias(c)
                           for c in columns])


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str], sync: bool = True) -> DataFrame:
    """MERGE on ``keys``: matched rows replaced, new rows inserted, nothing deleted.

    Keys compare with ``=`` as in MERGE, so NULL keys never match. With
    ``sync`` the result has exactly the source's columns (history rows get
    NULL in new columns).
    """
    if target is None:
        return source
    kept = target.join(source.select(*keys).where(_all_not_null(keys)).distinct(), list(keys), "left_anti")
    if sync:
        types = {f.name: f.dataType for f in source.schema.fields}
        kept = sync_schema(kept, source.columns, types)
        return kept.unionByName(source)
    return kept.unionByName(source, allowMissingColumns=True)


PART = "__part"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _by_partition(df: DataFrame, part: str = PART) -> DataFrame:
    """Cluster rows by the partition column before a partitioned write.

    A rebalance (not a plain repartition) lets adaptive execution split a hot
    partition value over several tasks and merge small ones, so each output
    partition gets few files and no task holds a whole skewed day.
    """
    return df.hint("rebalance", part)


def _all_not_null(keys: Sequence[str]) -> Column:
    c = None
    for k in keys:
        t = F.col(k).isNotNull()
        c = t if c is None else (c & t)
    return c


class TableStore:
    """Named parquet tables under one root in the shared folder.

    A table is a set of named parts (partitions, batches), each one folder. A
    change writes its rows to new folders, then one small pointer file, numbered
    one above the newest and created only if absent, lists the folders of all
    parts. A run that fails before that leaves the table as it was, also when it
    replays a batch that is already there; frames read earlier keep their files;
    of two runs at once the later one fails. No clock is read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def _state(self, name: str) -> tuple[int, dict[str, str], T.StructType | None]:
        """Number of the newest pointer, folder by part, schema."""
        pointers = [n for n in self._names(f"{self.root}/{name}/_pointers") if n.endswith(".json")]
        if not pointers:
            return 0, {}, None
        fs, p = self._fs(f"{self.root}/{name}/_pointers/{pointers[-1]}")
        stream = fs.open(p)
        held = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        return int(pointers[-1].split(".")[0]), held["parts"], T.StructType.fromJson(held["schema"])

    def _commit(self, name: str, number: int, parts: dict[str, str], schema: T.StructType) -> None:
        fs, p = self._fs(f"{self.root}/{name}/_pointers/{number:09d}.json")
        stream = fs.create(p, False)
        stream.write(bytearray(json.dumps({"parts": parts, "schema": json.loads(schema.json())}).encode()))
        stream.close()

    def _frame(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*dict.fromkeys(folders))

    def _new_folder(self, name: str) -> str:
        return f"{self.root}/{name}/d-{uuid.uuid4().hex}"

    def read(self, name: str, only=None) -> DataFrame | None:
        """The table, or its parts whose name ``only`` accepts; None before the first write."""
        _, parts, schema = self._state(name)
        return None if schema is None else self._frame([f for k, f in parts.items() if only is None or only(k)], schema)

    def put(self, name: str, frames: dict[str, DataFrame], replace: bool = False) -> DataFrame:
        """Write each frame as the named part, in one commit; ``replace`` drops all other parts."""
        number, parts, _ = self._state(name)
        new = {part: self._new_folder(name) for part in frames}
        for part, df in frames.items():
            with dropping_shuffles(df):
                df.write.mode("errorifexists").option("compression", PARQUET_CODEC).parquet(new[part])
        self._commit(name, number + 1, new if replace else parts | new, next(iter(frames.values())).schema)
        return self.read(name)

    def vacuum(self, name: str) -> None:
        """Delete the table's data that its newest pointer doesn't list.

        For a table's only writer, when it holds no frames read earlier: these
        may lose their files.
        """
        folders = self._state(name)[1].values()
        base = f"{self.root}/{name}"
        inside = {f.removeprefix(f"{base}/").split("/")[0]: [] for f in folders}
        for f in folders:
            inside[f.removeprefix(f"{base}/").split("/")[0]].append(f.rsplit("/", 1)[1])
        for found in self._names(base):
            if not found.startswith("d-"):
                continue
            if found not in inside:
                old = [found]
            else:  # a merge's folder: its partitions that later merges replaced
                old = [f"{found}/{n}" for n in self._names(f"{base}/{found}") if n.startswith(f"{PART}=") and n not in inside[found]]
            for n in old:
                fs, p = self._fs(f"{base}/{n}")
                fs.delete(p, True)

    def publish(self, name: str, df: DataFrame) -> DataFrame:
        return self.put(name, {"all": df}, replace=True)

    def upsert(self, name: str, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        return self.publish(name, upsert(self.read(name), source, keys))

    def append(self, name: str, df: DataFrame, batch: str | None = None) -> DataFrame:
        """Add rows. A named batch that is written again replaces its own rows."""
        return self.put(name, {f"batch-{batch}" if batch is not None else uuid.uuid4().hex: df})

    def append_split(self, df: DataFrame, apart: Column, kept: tuple[str, Sequence[str]], rest: tuple[str, Sequence[str]],
                     batch: str) -> None:
        """Append a named batch to two tables in one pass over ``df``.

        Both are (table, columns): rows for which ``apart`` is true go to
        ``rest``, all others to ``kept``. One write keeps the two apart, in a
        folder of the first table; the rest is copied from there to its own.
        """
        (name, columns), (other, other_columns) = kept, rest
        number, parts, _ = self._state(name)
        path = self._new_folder(name)
        rows = df.withColumn(PART, F.when(apart, F.lit("rest")).otherwise(F.lit("kept")))
        with dropping_shuffles(rows), unsorted_partitions(rows, 2):
            rows.write.mode("errorifexists").option("compression", PARQUET_CODEC).partitionBy(PART).parquet(path)
        folders = {p: f"{path}/{PART}={p}" for p in ("kept", "rest")}
        for folder in folders.values():  # a part without rows has none yet
            fs, p = self._fs(folder)
            fs.mkdirs(p)
        self._commit(name, number + 1, parts | {f"batch-{batch}": folders["kept"]}, df.select(*columns).schema)
        self.append(other, self._frame([folders["rest"]], df.select(*other_columns).schema), batch)

    def read_batch(self, name: str, batch: str) -> DataFrame:
        """Rows of one named batch."""
        return self.read(name, lambda part: part == f"batch-{batch}")

    def merge_partitions(self, name: str, source: DataFrame, part: Column, combine, moved=None) -> DataFrame:
        """Replace the partitions that ``source`` falls in by ``combine(their rows, source)``.

        ``part`` gives a row's partition; partitions that are not touched keep
        their files and are not read. ``moved(table, source)``, if given, returns
        rows elsewhere in the table that the source replaces; their partitions
        count as touched. Added columns need no rewrite (older files are read
        with the newest schema, NULL there); a column that goes or changes its
        type rewrites the table.
        """
        name_of = F.coalesce(part.cast("string"), F.lit(NULL_PARTITION))
        number, parts, schema = self._state(name)
        path = self._new_folder(name)
        if schema is None:
            schema = source.schema  # a new table: the source is read once
        else:
            # the source (an increment: small by design) is read up to three times below; write it once
            with dropping_shuffles(source):
                source.write.mode("errorifexists").option("compression", PARQUET_CODEC).parquet(f"{path}-source")
            source = self.spark.read.schema(source.schema).parquet(f"{path}-source")
        if not parts:
            touched, current = [], self._frame([], schema)
        elif any(f.name not in source.columns or source.schema[f.name].dataType != f.dataType for f in schema.fields):
            touched, current = list(parts), self._frame(list(parts.values()), schema)
        else:
            affected = source.select(name_of.alias("p"))
            if moved is not None:
                held = moved(self._frame(list(parts.values()), source.schema), source)
                affected = affected.unionByName(held.select(name_of.alias("p")))
            touched = [r.p for r in affected.distinct().collect()]  # partition names, not rows
            current = self._frame([parts[p] for p in touched if p in parts], source.schema)
        merged = combine(current, source)
        rows = _by_partition(merged.withColumn(PART, name_of))
        with dropping_shuffles(rows):
            rows.write.mode("errorifexists").option("compression", PARQUET_CODEC).partitionBy(PART).parquet(path)
        written = {unquote(n.split("=", 1)[1]): f"{path}/{n}" for n in self._names(path) if n.startswith(f"{PART}=")}
        live = {p: f for p, f in parts.items() if p not in touched} | written
        self._commit(name, number + 1, live, merged.schema)
        return self.read(name)

    def upsert_partitions(self, name: str, source: DataFrame, keys: Sequence[str], part: str,
                          grain: str | None = None) -> DataFrame:
        """MERGE into a table kept by ``part``, reading and writing only touched partitions.

        ``grain`` ("month", "year"...) partitions by ``trunc(to_date(part), grain)``
        instead of the value itself, for tables whose daily slices are small.
        A key may move partition, unless ``part`` is one of the keys.
        """
        pcol = F.trunc(F.to_date(F.col(part)), grain) if grain else F.col(part)
        in_keys = lambda table, new: table.join(new.select(*keys).where(_all_not_null(keys)).distinct(), list(keys), "left_semi")
        return self.merge_partitions(name, source, pcol, lambda old, new: upsert(old, new, keys), None if part in keys else in_keys)
