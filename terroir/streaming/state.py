"""Keyed state in Spark's state store: the latest row of a key, and a versioned archive.

Spark keeps the state in RocksDB on the executors and writes what a batch changes (a change log, with a snapshot now and
then) to the query's checkpoint. A restarted query goes on from the checkpoint; a batch that is run again starts from the
state before it and makes the same state. The state is read as a table by Spark's state data source, from the last
snapshot and the changes since.

The latest row of a key is a value of that key. A call of Python and of the state store costs as much as hundreds of rows,
so the archive's keys share them in groups by hash: a group's state is a list of what batches changed in it, in columns. A
batch writes what it changes and reads the groups that its keys lie in; a list that would be half outdated is written anew.

Defined results: a null key is a key; a null in the order column comes before all values; rows of a key that are equal in
it are ordered by a hash of the whole row, so that the outcome doesn't depend on how they arrive; late rows (below what
the state holds) change nothing; before the first row the state is an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ListState

SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_store(spark: SparkSession, **more: str):
    """Queries that start here keep their state in RocksDB; the session's own settings come back afterwards."""
    settings = SETTINGS | {f"spark.sql.streaming.{k}": v for k, v in more.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_state(spark: SparkSession, checkpoint: str, name: str, schema: T.StructType, parts: list[str]) -> DataFrame:
    """The rows of a state variable (``parts``: its structs, whose fields become columns) as of the last batch, without
    those whose time to live is over."""
    if not exists(spark, f"{checkpoint}/state"):
        return spark.createDataFrame([], schema)
    with state_store(spark):
        stored = spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
        if "value" in parts and "ttlExpirationMs" in stored.schema["value"].dataType.names:
            stored = stored.filter(F.col("value.ttlExpirationMs") > F.unix_millis(F.current_timestamp())).withColumn("value", F.col("value.value"))
        return stored.select(*[f"{p}.*" for p in parts]).select(*schema.names)


class Latest(StatefulProcessor):
    """Keeps the greatest row of a key by (order, hash of the row)."""

    def __init__(self, value: T.StructType, ttl: int | None, row: Row) -> None:
        self.kind, self.ttl, self.row = value, ttl, row

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("latest", self.kind, self.ttl)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        rank = lambda r: (r["__order"] is not None, r["__order"] if r["__order"] is not None else 0, r["__tie"])
        best, old = max(rows, key=rank), self.value.get()
        if old is None or rank(best) > rank(dict(zip(self.kind.names, old, strict=True))):
            values = tuple(best[n] for n in self.kind.names)
            self.value.update(values)
            yield self.row(*key, *values[:-2])

    def close(self) -> None:
        pass


def latest_state(stream: DataFrame, keys: list[str], order: str, checkpoint: str, out: str, ttl: int | None = None) -> DataFrame:
    """The latest row of each key by ``order``, after all that has landed; ``out`` gets a row for each key that a batch
    changed. With ``ttl`` (milliseconds) keys that nothing has changed for so long are forgotten."""
    spark, schema = stream.sparkSession, stream.schema
    rest = [f for f in schema.fields if f.name not in keys]
    value = T.StructType([*rest, T.StructField("__order", schema[order].dataType), T.StructField("__tie", T.LongType())])
    changed = T.StructType([*[schema[k] for k in keys], *rest])
    ranked = stream.withColumn("__order", F.col(order)).withColumn("__tie", F.xxhash64(*schema.names))
    # with processing time each batch asks for another one, which without new rows would never end
    with state_store(spark, **({"noDataMicroBatches.enabled": "false"} if ttl else {})):
        kept = ranked.groupBy(*keys).transformWithState(Latest(value, ttl, Row(*changed.names)), changed, "Append", "ProcessingTime" if ttl else "None")
        kept.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start().awaitTermination()
    return read_state(spark, checkpoint, "latest", schema, ["key", "value"])


ACTIONS = "version int, hash string, action string, run string"
RECORD = "hash string, version int, last_run string, top int, due long"
CONTENT = "hash string, version int, payload string"
OUT = ["id", "version", "hash", "action", "run"]

#: Keys without timers share a call of Python with those of equal hash modulo this number; a checkpoint needs it unchanged.
SLOTS = 4096

#: A key's columns as text and back, without loss.
AS_TEXT = {"ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def of_text(text: str, keys: list[T.StructField], *rest: str) -> list[Column]:
    read = F.from_json(text, T.StructType(keys), AS_TEXT)
    return [*[read[k.name].alias(k.name) for k in keys], *map(F.col, rest)]


def in_columns(ddl: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in T.StructType.fromDDL(f"id string, {ddl}").fields])


def logged(log: ListState) -> Iterator[tuple]:
    """The rows of a log, whose elements are what a batch added, in columns."""
    for part in log.get():
        yield from zip(*part, strict=True)


def part(rows: Iterable[tuple]) -> tuple:
    return tuple(map(list, zip(*rows, strict=True)))


class Archive(StatefulProcessor):
    """The current content and version of each key of a group, and the version number of every content it ever had."""

    def __init__(self, quiet: int | None) -> None:
        self.quiet, self.kinds = quiet, {"records": in_columns(RECORD), "versions": in_columns(CONTENT)}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records, self.versions = (handle.getListState(name, kind) for name, kind in self.kinds.items())

    def handleInputRows(self, group: Any, frames: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        arrived: dict[str, list[tuple]] = {}
        for frame in frames:
            frame = frame[["id", "run", "hash", "payload", "at"]].astype(object)
            for id, *row in frame.where(frame.notna(), None).itertuples(index=False, name=None):
                arrived.setdefault(id, []).append(row)
        records, length = {}, 0
        for id, *record in logged(self.records):
            records[id], length = record, length + 1
        done, changed, contents, added, numbers = [], {}, [], {}, None
        for id, rows in arrived.items():
            now = records.get(id)
            content, version, last, top, due = now or (None, 0, None, 0, None)
            latest = due - self.quiet if due is not None and self.quiet else None
            for run, hash, payload, at in sorted(rows, key=lambda r: (r[0] or "", r[1] or "")):
                if self.quiet and at is not None:
                    latest = max(latest or 0, int(at))
                if last is not None and (run or "") < last:
                    action = "late"
                elif version and content == hash:
                    action = "unchanged"
                else:
                    if top > 1 and numbers is None:
                        numbers = {(id, hash): version for id, hash, version, _ in logged(self.versions)}
                    old = (added.get((id, hash)) or numbers.get((id, hash))) if top > 1 else None
                    if old:
                        action, version = "reverted", old
                    else:
                        action = "updated" if version else "inserted"
                        version = top = added[id, hash] = top + 1
                        contents.append((id, hash, version, payload))
                if action != "late":
                    content, last = hash, run or ""
                done.append((id, version, hash, action, run))
            after = latest + self.quiet if latest is not None and self.quiet else None
            if after != due:
                if due is not None:
                    self.handle.deleteTimer(due)
                self.handle.registerTimer(after)
            record = [content, version, last, top, after]
            if record != now:
                changed[id] = record
        if contents:
            self.versions.appendValue(part(contents))
        self.keep(records, changed, length)
        yield pd.DataFrame(done, columns=OUT)

    def keep(self, records: dict[str, list], changed: dict[str, list], length: int) -> None:
        """Adds changes to the log of records; one that would be half outdated is written anew."""
        records |= changed
        rows = lambda of: part((id, *record) for id, record in of.items())
        if changed and length + len(changed) > 2 * len(records):
            self.records.put([rows(records)])
        elif changed:
            self.records.appendValue(rows(changed))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        every = list(logged(self.records))
        id, *record, _ = every[-1]
        self.keep({id: record}, {id: [*record, None]}, len(every))
        content, version, last, _ = record
        yield pd.DataFrame([(id, version, content, "silent", last)], columns=OUT)

    def close(self) -> None:
        pass


def archive_stream(stream: DataFrame, checkpoint: str, out: str, keys: list[str] = ("key",), time: str | None = None, delay: str = "0 seconds", quiet: int | None = None) -> DataFrame:
    """Rows (keys, hash, payload, run) upserted into a versioned archive: new content of a key gets the next version,
    content that it had before its old number, equal content only a newer run; rows of a run before the key's last are
    late and change nothing. ``out`` gets what was done with each row. With ``quiet`` (milliseconds), a key whose last
    row lies so long before the watermark of ``time`` is told there as silent. Returns the records."""
    spark, names, keys = stream.sparkSession, list(keys), [stream.schema[k] for k in keys]
    at = F.unix_millis(time) if quiet else F.lit(None).cast("long")
    slot = F.pmod(F.xxhash64(*names), F.lit(SLOTS)).cast("int").alias("slot")
    rows = (stream.withWatermark(time, delay) if quiet else stream).select(slot, F.to_json(F.struct(*names), AS_TEXT).alias("id"), "run", "hash", "payload", at.alias("at"))
    # a timer is a group's, so keys that have one are groups of their own
    groups = rows.groupBy("id" if quiet else "slot")
    with state_store(spark):
        done = groups.transformWithStateInPandas(Archive(quiet), f"id string, {ACTIONS}", "Append", "EventTime" if quiet else "None")
        done = done.select(*of_text("id", keys, *OUT[1:]))
        done.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start().awaitTermination()
    return archive_records(spark, checkpoint, keys)


def read_log(spark: SparkSession, checkpoint: str, name: str, ddl: str) -> DataFrame:
    """The rows of a log with their place in it."""
    if not exists(spark, f"{checkpoint}/state"):
        return spark.createDataFrame([], f"place int, id string, {ddl}")
    with state_store(spark):
        stored = spark.read.format("statestore").option("stateVarName", name).option("flattenCollectionTypes", "false").load(checkpoint)
        parts = stored.select(F.posexplode("list_value").alias("place", "part"))
        return parts.select("place", F.inline(F.arrays_zip(*[F.col(f"part.{n}") for n in in_columns(ddl).names])))


def archive_records(spark: SparkSession, checkpoint: str, keys: list[T.StructField]) -> DataFrame:
    """keys, hash, version, last_run of the archive's current records."""
    last = read_log(spark, checkpoint, "records", RECORD).groupBy("id").agg(F.max_by(F.struct("hash", "version", "last_run"), "place").alias("r"))
    return last.select(*of_text("id", keys, "r.hash", "r.version", "r.last_run"))


def archive_versions(spark: SparkSession, checkpoint: str, keys: list[T.StructField]) -> DataFrame:
    """keys, hash, version, payload of all contents that the archive ever had."""
    return read_log(spark, checkpoint, "versions", CONTENT).select(*of_text("id", keys, "hash", "version", "payload"))
