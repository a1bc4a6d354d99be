"""Faults that show on larger tables only."""

import duckdb
from pyspark.sql import functions as F

from terroir.functions import values as V
from terroir.operators import analyze as A
from terroir.operators import distinct as D
from terroir.operators import enrich as E
from terroir.operators import score as S
from terroir.plans import registry
from terroir.sources import files as L


def test_patches_without_rows_at_any_size(spark, tmp_path):
    """Keys of the table that are as large as those of patches without rows."""
    spark.createDataFrame([(k, "PROMO" if k % 8 == 0 else "STANDARD", k % 50) for n in (0, 1_000_000) for k in range(n, n + 401)], "p_partkey long, p_type string, p_size int").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    df = registry.queries()["c21_skipped_patches"](spark, str(tmp_path))
    found = sorted(tuple(r[c] for c in ("p_partkey", "reason")) for r in df.collect())
    sql = registry.oracle_sql()["c21_skipped_patches"].replace("FROM part", f"FROM '{tmp_path}/part.parquet/*.parquet'")
    assert found == sorted(duckdb.connect().execute(sql).fetchall())


def test_rates_and_gap_scores_are_rounded_as_in_sql(spark):
    """Counts up to 300: scaling some of the scores lands on a half that the decimal digits don't show."""
    df = spark.range(1, 301).select(F.col("id").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), "id")).alias("reg")).withColumn("rate", V.safe_rate(F.col("reg"), F.col("n")))
    out = df.select("n", "reg", "rate", *S.gap_score(F.col("n"), F.col("rate"), F.lit(True), F.lit("available"), F.lit(None).cast("double")))
    found = sorted(tuple(r) for r in out.select("n", "reg", "rate", "gap_score").collect())
    sql = """WITH r AS (SELECT n, reg, round(reg::DOUBLE / n, 4) AS rate FROM range(1, 301) a(n), range(0, 301) b(reg) WHERE reg <= n)
    SELECT n, reg, rate, round(1 - (0.7::DOUBLE * least(1.0::DOUBLE, n / 5.0::DOUBLE) + 0.3::DOUBLE * rate), 4) FROM r"""
    assert found == sorted(duckdb.connect().execute(sql).fetchall())


def test_distinct_counts_take_no_bitmap_for_each_cell(spark):
    """Few keys in each of many cells: nothing is sorted, and what is written has a row a key and cell."""
    df = spark.range(20_000).selectExpr("id % 4000 key", "id % 97 region", "id % 89 item", "id % 5 = 0 ok")
    levels = {"cell": ["region", "item"], "item": ["item"], "all": []}
    out = D.distinct_counts(df, "key", levels, {"n": F.lit(True), "ok_ones": F.col("ok")})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "bitmap" not in plan
    for level, cells in levels.items():
        plain = df.groupBy(*cells).agg(F.count_distinct("key").alias("n"), F.count_distinct(F.when(F.col("ok"), F.col("key"))).alias("ok_ones"))
        plain = plain.select(*[F.col(c).cast("string") if c in cells else F.lit("all").alias(c) for c in levels["cell"]], "n", "ok_ones")
        assert sorted(map(tuple, out.filter(F.col("level") == level).drop("level").collect())) == sorted(map(tuple, plain.collect()))


def test_pages_of_one_file_are_parsed_by_many_tasks_and_once(spark):
    pages = spark.range(0, 400, 1, 1).selectExpr("id", "concat('<r><resultCode>', if(id % 2 = 0, '00', '30'), '</resultCode></r>') x")
    good, bad = L.valid_responses(L.xml_headers(pages, "x"))
    assert bad.select(F.spark_partition_id()).distinct().count() > 8
    assert bad._jdf.queryExecution().optimizedPlan().toString().count("xpath_string(") <= 3
    assert (good.count(), sorted(r["id"] for r in bad.collect())) == (200, list(range(1, 400, 2)))


def test_rows_without_a_number_are_spread(spark):
    rows = spark.range(2000).selectExpr("id", "if(id % 2 = 0, null, id) number")
    cache = spark.range(2000).filter("id % 3 <> 0").selectExpr("cast(id as int) number", "'ok' status")
    for name, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(name, value)
    try:
        out = E.from_cache(rows, cache, "number").withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled"), spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len({r["part"] for r in out if r["number"] is None}) > 1
    assert {r["id"]: r["enrichment"] for r in out} == {i: "no_number" if i % 2 == 0 else "ok" if i % 3 else "not_collected" for i in range(2000)}
    assert len(out) == 2000


def test_examples_of_a_large_cell_are_chosen_in_pieces(spark):
    """One cell of many rows, one of few: the same examples as from windows over whole cells, which see few rows."""
    df = spark.range(6000).selectExpr("if(id < 5990, 'a', 'b') cell", "id app", "cast(id * 7919 % 83 as int) filed", "cast(id * 31 % 17 as int) - 5 class", "id % 13 = 0 ri")
    out = A.tiered_examples(df, ["cell"], "app", F.col("ri"), F.col("class"), "filed", 5)
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    expected = []
    for cell in "ab":
        rows = [r for r in df.collect() if r["cell"] == cell]
        first = min(rows, key=lambda r: (-r["ri"], -r["filed"], r["app"]))["app"]
        evident = [r["app"] for r in sorted(rows, key=lambda r: (-r["class"], -r["filed"], r["app"]))[:3]]
        tier = lambda r: 0 if r["ri"] and r["app"] == first else 1 if r["class"] > 0 and r["app"] in evident else 2  # noqa: E731, B023
        chosen = sorted(rows, key=lambda r: (tier(r), -r["filed"], r["app"]))[:5]
        expected += [(cell, r["app"], tier(r), i + 1) for i, r in enumerate(sorted(chosen, key=lambda r: (-r["filed"], r["app"])))]
    assert sorted(tuple(r) for r in out.select("cell", "app", "tier", "rank").collect()) == sorted(expected)


def test_hits_are_merged_in_a_fixed_number_of_parts(spark):
    old = spark.range(300).selectExpr("id % 3 k", "id hit", "if(id % 2 = 0, 'a', 'b') status")
    new = spark.range(200, 500).selectExpr("id % 3 k", "id hit", "'c' status")
    out = E.merge_hits(old, new, ["k"], "hit", F.col("status"), 90)
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    expected = {(k, h, "c" if h >= 200 else "ab"[h % 2], i + 1) for k in range(3) for i, h in enumerate(range(k, 500, 3)) if i < 90}
    assert {tuple(r) for r in out.select("k", "hit", "status", "pos").collect()} == expected


def test_goods_are_matched_once_a_row(spark):
    """The fields of the result don't each match the goods again."""
    row = spark.sql("select array(named_struct('name', 'a', 'notice', 'n', 'stage', 's')) t, array(named_struct('class', 1, 'name', 'ab', 'goods', 'AB')) p, array(1) c")
    found = row.select(E.goods_evidence(F.col("t"), F.col("p"), F.col("c")).alias("m")).select("m.*")
    assert found._jdf.queryExecution().analyzed().toString().count("array_contains(") <= 4
    assert [(r["method"], r["evidence"][0]["target"]) for r in found.collect()] == [("normalized_contains", "a")]
