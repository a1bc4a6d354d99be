"""Queries of the streaming operators, over tables that land as files in several pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.plans.base import Tables
from terroir.sources.files import scratch
from terroir.streaming import state
from terroir.streaming import streams as S

QUERIES, SQL = {}, {}
c, lit = F.col, F.lit


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return keep


def events(t: Tables) -> DataFrame:
    return t.events.select("event_id", c("ts").cast("timestamp").alias("ts"), "user_id", "event_type")


@query("s02_stream_dedupe", "SELECT DISTINCT event_id, user_id FROM events")
def _(t):
    e = events(t)
    out, kept = scratch(t.spark, "out"), scratch(t.spark, "state")
    for stream in S.arriving(e.unionByName(e), "ts", 3):
        done = S.run_available(S.deduplicated(stream, "ts", ["event_id"], "1 day"), out, kept)
    return done.select("event_id", "user_id")


@query("s03_stream_windows", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events WHERE date_trunc('day', ts) < (SELECT date_trunc('day', max(ts)) FROM events) GROUP BY ALL")
def _(t):
    out, kept = scratch(t.spark, "out"), scratch(t.spark, "state")
    for stream in S.arriving(events(t), "ts", 3):
        done = S.run_available(S.windowed_counts(stream, "ts", ["event_type"], "1 day", None, "1 second"), out, kept)
    last = t.events.agg(F.to_date(F.max("ts")).alias("d"))
    return done.crossJoin(F.broadcast(last)).filter(F.to_date("start") < c("d")).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("s03_sliding_windows", "WITH w AS (SELECT event_type, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS s FROM events) SELECT strftime(s, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM w WHERE s < (SELECT date_trunc('day', max(ts)) - INTERVAL 1 DAY FROM events) GROUP BY ALL")
def _(t):
    out, kept = scratch(t.spark, "out"), scratch(t.spark, "state")
    for stream in S.arriving(events(t), "ts", 3):
        done = S.run_available(S.windowed_counts(stream, "ts", ["event_type"], "2 days", "1 day", "1 second"), out, kept)
    last = t.events.agg(F.date_sub(F.to_date(F.max("ts")), 1).alias("d"))
    return done.crossJoin(F.broadcast(last)).filter(F.to_date("start") < c("d")).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query(
    "s01_stream_archive",
    """SELECT o_orderkey AS key, 1 AS version, 'inserted' AS action, strftime(o_orderdate, '%Y-%m-%d') AS run FROM orders
       UNION ALL SELECT o_orderkey, 2, 'updated', 'again ' || strftime(o_orderdate, '%Y-%m-%d') FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, 1, 'reverted', 'later ' || strftime(o_orderdate, '%Y-%m-%d') FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%'
       UNION ALL SELECT o_orderkey, 2, 'unchanged', 'later ' || strftime(o_orderdate, '%Y-%m-%d') FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority NOT LIKE '1%'""",
)
def _(t):
    """Orders archived over three runs: all; those finished with changed content; those again, the urgent ones as at first."""
    hashed = lambda *more: F.sha2(F.concat_ws("|", c("o_orderkey").cast("string"), "o_orderstatus", *more), 256)
    day, finished = F.date_format("o_orderdate", "yyyy-MM-dd"), t.orders.filter("o_orderstatus = 'F'")
    first = t.orders.select(c("o_orderkey").alias("key"), hashed().alias("hash"), c("o_orderstatus").alias("payload"), day.alias("run"), lit(1).alias("nth"))
    again = finished.select(c("o_orderkey").alias("key"), hashed(lit("x")).alias("hash"), lit("x").alias("payload"), F.concat(lit("again "), day).alias("run"), lit(2).alias("nth"))
    later = finished.select(c("o_orderkey").alias("key"), F.when(c("o_orderpriority").like("1%"), hashed()).otherwise(hashed(lit("x"))).alias("hash"), lit("y").alias("payload"), F.concat(lit("later "), day).alias("run"), lit(3).alias("nth"))
    out, kept = scratch(t.spark, "out"), scratch(t.spark, "state")
    for stream in S.arriving(first.unionAll(again).unionAll(later), "nth", 3):
        state.archive_stream(stream, kept, out)
    return t.spark.read.parquet(out).select("key", "version", "action", "run")


@query("s04_stream_latest", "SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations) WHERE k = 1")
def _(t):
    rows, out, kept = t.conversations.select("conv_id", "turn", "role"), scratch(t.spark, "out"), scratch(t.spark, "state")
    for stream in S.arriving(rows, "turn", 3):
        latest = state.latest_state(stream, ["conv_id"], "turn", kept, out)
    return latest
