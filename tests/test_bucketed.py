"""The archive in buckets: versions, reruns, what its plans shuffle, and agreement with the archive over snapshots."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from terroir.operators import snapshot as N
from terroir.sources.bucketed import BucketedArchive

BATCH = "key long, hash string, payload string"


@pytest.fixture
def archive(spark):
    made = BucketedArchive(spark, f"archive_{uuid.uuid4().hex}", spark.createDataFrame([], BATCH).schema["key"], buckets=4)
    yield made
    spark.sql(f"DROP TABLE {made.table}")


def listed(df):
    return sorted(map(tuple, df.collect()), key=repr)


def add(archive, run, *rows):
    return dict(listed(archive.upsert(archive.spark.createDataFrame([(k, h, f"{h}{k}") for k, h in rows], BATCH), run)))


def test_versions_reverts_and_reruns(archive):
    assert add(archive, 1, (1, "a"), (2, "a"), (None, "a")) == {"inserted": 2}
    assert add(archive, 2, (1, "b"), (2, "a"), (3, "z"), (3, "y")) == {"updated": 1, "unchanged": 1, "inserted": 1}
    assert add(archive, 3, (1, "a")) == {"reverted": 1}
    assert add(archive, 4, (1, "c"), (2, "b")) == {"updated": 2}
    before = listed(archive.log())
    assert add(archive, 3, (1, "never"), (9, "never")) == {"reverted": 1}, "a batch that is there already"
    assert listed(archive.log()) == before
    assert add(archive, 5, (1, "b")) == {"reverted": 1}
    assert listed(archive.records()) == [(1, "b", 2, 5), (2, "b", 2, 4), (3, "y", 1, 2)]
    assert listed(archive.current_view()) == [(1, 2, "b1"), (2, 2, "b2"), (3, 1, "y3")]
    assert add(archive, 6) == {}


def test_it_agrees_with_the_archive_of_snapshots(spark, archive):
    records, versions = (spark.createDataFrame([], x) for x in ("key long, hash string, version int, last_run string", "key long, version int, hash string, payload string"))
    for run in range(1, 5):
        batch = spark.range(60).filter(f"id % {run + 1} <> 1").select(F.col("id").alias("key"), F.expr(f"cast((id * {run}) % 3 as string)").alias("hash"), F.expr(f"concat('p', (id * {run}) % 3)").alias("payload"))
        archive.upsert(batch, run)
        records, versions, _ = N.archive_upsert(records, versions, batch, f"r{run}")
        records, versions = records.checkpoint(), versions.checkpoint()
    assert listed(archive.records().select("key", "hash", "version")) == listed(records.select("key", "hash", "version"))
    assert listed(archive.current_view()) == listed(N.current_view(records, versions).select("key", "version", "payload"))


def test_the_archive_is_not_shuffled(spark, archive):
    add(archive, 1, *[(k, "a") for k in range(100)])
    add(archive, 2, *[(k, "b") for k in range(0, 100, 9)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan(archive.current_view())
        assert "Exchange" not in plan(archive.records())
        batch = spark.createDataFrame([(3,)], "key long").repartition(4, "key")
        joined = plan(archive._states(archive.log().join(batch, "key", "left_semi")))
        assert len(re.findall("Exchange", joined)) == 1 and "REPARTITION_BY_NUM" in joined, "only the batch is dealt"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
