"""Streams against their batch forms: restarts, reruns, late rows, ties, nulls, timers, and what a batch writes."""

import os
import random
from datetime import datetime

from pyspark.sql import functions as F

from terroir.operators import common as C
from terroir.plans.base import Tables
from terroir.streaming import state
from terroir.streaming import streams as S

ROWS = "key long, hash string, payload string, run string, at timestamp"
ACTED = ["key", "version", "hash", "action", "run"]


def listed(df):
    return sorted(map(tuple, df.collect()), key=repr)


class Landing:
    """A folder in which rows land, and the stream over it."""

    def __init__(self, spark, path, schema=ROWS):
        self.spark, self.path, self.schema = spark, str(path), schema

    def __call__(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).write.mode("append").parquet(f"{self.path}/in")
        return self.spark.readStream.schema(self.schema).parquet(f"{self.path}/in")

    @property
    def places(self):
        return f"{self.path}/state", f"{self.path}/out"


def record(key, content, run, payload="p", at=None):
    return (key, content, payload, run, at)


def test_latest_equals_batch_over_pieces(spark, tmp_path):
    rows = Tables(spark, "/root/testdata/sf0.001").conversations.select("conv_id", "turn", "role")
    for stream in S.arriving(rows, "turn", 3):
        out = state.latest_state(stream, ["conv_id"], "turn", str(tmp_path / "state"), str(tmp_path / "out"))
    assert listed(out) == listed(C.latest(rows, ["conv_id"], F.desc("turn")))
    assert out.columns == rows.columns


def test_latest_with_nulls_ties_late_rows_and_restarts(spark, tmp_path):
    land = Landing(spark, tmp_path, "v double, key string, at long")
    get = lambda stream: listed(state.latest_state(stream, ["key"], "at", *land.places))
    empty = land()
    assert get(empty) == []
    first = [(1.0, "a", 5), (2.0, None, 1), (3.0, "b", None), (None, "b", None), (4.0, "a", 5)]
    one = get(land(*first))
    tie = max([(1.0, "a", 5), (4.0, "a", 5)], key=lambda r: spark.createDataFrame([r], land.schema).select(F.xxhash64("v", "key", "at")).first()[0])
    assert tie in one and (2.0, None, 1) in one and len(one) == 3
    assert get(land((9.0, "a", 4))) == one, "late"
    two = get(land((9.0, "a", 2**60 + 1), (8.0, "b", -3), (7.0, "c", 0)))
    assert two == listed(spark.createDataFrame([(9.0, "a", 2**60 + 1), (8.0, "b", -3), (7.0, "c", 0), (2.0, None, 1)], land.schema))
    assert get(land(*first)) == two, "the first rows again"


def test_latest_is_forgotten_after_its_time_to_live(spark, tmp_path):
    """With a millisecond to live, a's later row is forgotten when its earlier one comes, which therefore counts."""
    land = Landing(spark, tmp_path, "v long, key string, at long")
    assert listed(state.latest_state(land((1, "a", 5)), ["key"], "at", *land.places, ttl=1)) == []
    state.latest_state(land((3, "a", 1)), ["key"], "at", *land.places, ttl=1)
    assert listed(spark.read.parquet(land.places[1]).select("v", "at")) == [(1, 5), (3, 1)]


def test_archive_numbers_versions_and_reverts(spark, tmp_path):
    land = Landing(spark, tmp_path)
    run = lambda *rows: listed(state.archive_stream(land(*rows), *land.places).select("key", "hash", "version", "last_run"))
    assert run(record(1, "a", "r1"), record(2, "a", "r1"), record(None, "a", "r1")) == listed(spark.createDataFrame([(1, "a", 1, "r1"), (2, "a", 1, "r1"), (None, "a", 1, "r1")]))
    assert run(record(1, "b", "r2"), record(2, "a", "r2"))[0] == (1, "b", 2, "r2")
    assert run(record(1, "a", "r3"), record(1, "c", "r4"), record(3, "x", "r4")) == listed(spark.createDataFrame([(1, "c", 3, "r4"), (2, "a", 1, "r2"), (3, "x", 1, "r4"), (None, "a", 1, "r1")]))
    before = run(record(1, "b", "r5"))
    assert before[0] == (1, "b", 2, "r5"), "old content gets its old number"
    assert run(record(1, "zz", "r2")) == before, "a late run changes nothing"
    acted = listed(spark.read.parquet(land.places[1]).filter("key = 1").select("run", "version", "action"))
    assert acted == [("r1", 1, "inserted"), ("r2", 2, "late"), ("r2", 2, "updated"), ("r3", 1, "reverted"), ("r4", 3, "updated"), ("r5", 2, "reverted")]
    key = land(*[]).schema["key"]
    versions = listed(state.archive_versions(spark, land.places[0], [key]).filter("key = 1").select("hash", "version", "payload"))
    assert versions == [("a", 1, "p"), ("b", 2, "p"), ("c", 3, "p")]


def test_archive_tells_silent_keys(spark, tmp_path):
    at = lambda minutes: datetime(2026, 1, 1, 0, minutes)
    land = Landing(spark, tmp_path)
    go = lambda *rows: state.archive_stream(land(*rows), *land.places, time="at", quiet=10 * 60_000)
    go(record(1, "a", "r1", at=at(0)), record(2, "a", "r1", at=at(0)))
    go(record(2, "a", "r2", at=at(8)))
    go(record(3, "a", "r3", at=at(15)))
    acted = listed(spark.read.parquet(land.places[1]).filter("action = 'silent'").select("key", "hash", "run"))
    assert acted == [(1, "a", "r1")]
    assert go().filter("key = 1").select("hash", "version").first() == ("a", 1), "silent keys are kept"


def written(folder):
    """Bytes of change logs and of new tables in the state's folder."""
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(f"{folder}/state") for f in files if f.endswith((".changelog", ".zip", ".sst")))


def test_a_batch_writes_what_it_changes(spark, tmp_path):
    """A batch of a hundredth of the keys adds about a hundredth of what the first wrote."""
    land = Landing(spark, tmp_path, "key long, v string, at long")
    rows = lambda keys, at: land(*[(k, f"{k}-{at}" * 20, at) for k in keys])
    sizes = [0]
    for i, keys in enumerate([range(6000), range(0, 6000, 100), range(3, 6000, 100)]):
        out = state.latest_state(rows(keys, i), ["key"], "at", *land.places)
        sizes.append(written(land.places[0]))
    added = [b - a for a, b in zip(sizes, sizes[1:], strict=False)]
    assert out.count() == 6000
    assert max(added[1:]) < 0.1 * added[0], added
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != state.SETTINGS["spark.sql.streaming.stateStore.providerClass"]


def test_pieces_arrive_in_order_and_whole(spark):
    rows = [(i, None if i % 10 == 0 else float(i % 37)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, at double").repartition(5)
    seen, highest = 0, float("-inf")
    for stream in S.arriving(df, "at", 4):
        path = C.scratch(spark, "out")
        got = S.run_available(stream, path, C.scratch(spark, "state"))
        new = got.count()
        assert new >= seen
        seen, top = new, got.agg(F.max("at")).first()[0]
        assert top >= highest
        highest = top
    assert listed(got) == listed(df)
    alike = spark.createDataFrame([(i, 1.0) for i in range(5)], "id long, at double")
    assert [S.run_available(s, C.scratch(spark, "out"), C.scratch(spark, "state")).count() for s in S.arriving(alike, "at", 2)][-1] == 5


def test_archive_keys_share_groups(spark, tmp_path):
    """Python and the state store are called by group, of which there are no more however many keys come."""
    path, shape = tmp_path / "in", "key long, hash string, payload string, run string"
    spark.range(20_000).selectExpr("id key", "'a' hash", "'p' payload", "'r1' run").write.parquet(str(path))
    out = state.archive_stream(spark.readStream.schema(shape).parquet(str(path)), str(tmp_path / "state"), str(tmp_path / "out"))
    assert out.agg(F.count("key"), F.count_distinct("key"), F.min("version"), F.max("version")).first() == (20_000, 20_000, 1, 1)
    acted = spark.read.parquet(str(tmp_path / "out"))
    assert acted.filter("action = 'inserted'").count() == acted.count() == 20_000
    with state.state_store(spark):
        tables = [spark.read.format("statestore").option("stateVarName", v).option("flattenCollectionTypes", "false").load(str(tmp_path / "state")) for v in ("records", "versions")]
    assert all(0 < t.count() <= state.SLOTS for t in tables)


def archived(batches):
    """A plain archive: what is done with each row, the records, and all contents."""
    acted, records, contents = [], {}, {}
    for batch in batches:
        for *key, hash, payload, run in sorted(batch, key=lambda r: (r[-1] or "", r[-3] or "")):
            key = tuple(map(repr, key))
            now, version, last = records.get(key, (None, 0, ""))
            if (run or "") < last:
                action = "late"
            elif version and now == hash:
                action = "unchanged"
            elif (key, hash) in contents:
                action, version = "reverted", contents[key, hash][0]
            else:
                action, version = "updated" if version else "inserted", 1 + sum(k == key for k, _ in contents)
                contents[key, hash] = version, payload
            if action != "late":
                records[key] = hash, version, run or ""
            acted.append((*key, version, hash, action, run))
    return sorted(acted, key=repr), sorted(((*k, *r) for k, r in records.items()), key=repr), sorted(((*k, h, *v) for (k, h), v in contents.items()), key=repr)


def test_archive_of_groups_equals_a_plain_one(spark, tmp_path, monkeypatch):
    """All keys in two groups, whose logs are written anew in between; keys of several columns, with nulls, NaN, quotes,
    microseconds and large numbers."""
    monkeypatch.setattr(state, "SLOTS", 2)
    draw = random.Random(5)
    names = [None, "", "null", 'a"b', "a, b", "ä\n"]
    whole = [(draw.choice(names), 2**60 + draw.randrange(2), draw.choice([None, 0.1, float("nan")]), datetime(2026, 1, 1, 0, 0, 0, draw.randrange(2))) for _ in range(14)]
    schema = "name string, number long, rate double, day timestamp, hash string, payload string, run string"
    land = Landing(spark, tmp_path, schema)
    batches = [[(*draw.choice(whole), draw.choice(["a", "b", "c", None]), f"p{n}-{i}", draw.choice([f"r{n}", f"r{n + 1}", "r0" if i % 9 else None])) for i in range(draw.choice([3, 40]))] for n in range(6)]
    batches = [list({(*map(repr, r[:4]), r[4], r[6]): r for r in b}.values()) for b in batches]
    keys = land().schema.names[:4]
    for batch in batches:
        records = state.archive_stream(land(*batch), *land.places, keys=keys)
    acted, last, contents = archived(batches)
    plain = lambda df: sorted(((*map(repr, r[:4]), *r[4:]) for r in df.collect()), key=repr)
    assert plain(spark.read.parquet(land.places[1])) == acted
    assert {a[6] for a in acted} == {"inserted", "updated", "unchanged", "reverted", "late"}
    assert plain(records) == last
    fields = [records.schema[k] for k in keys]
    assert plain(state.archive_versions(spark, land.places[0], fields)) == contents


def test_an_archived_batch_writes_what_it_changes(spark, tmp_path, monkeypatch):
    """A batch of a hundredth of the keys, and one of late rows, which changes nothing."""
    monkeypatch.setattr(state, "SLOTS", 16)
    land = Landing(spark, tmp_path)
    sizes = [0]
    for run, keys in (("r2", range(6000)), ("r3", range(0, 6000, 100)), ("r1", range(3, 6000, 100))):
        state.archive_stream(land(*[record(k, f"{k}-{run}" * 20, run) for k in keys]), *land.places)
        sizes.append(written(land.places[0]))
    added = [b - a for a, b in zip(sizes, sizes[1:], strict=False)]
    assert max(added[1:]) < 0.1 * added[0], added
