"""Queries of the aggregation, scoring and ranking operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.functions.values import safe_rate
from terroir.operators import analyze as A
from terroir.operators import distinct as DC
from terroir.operators import reports as P
from terroir.operators import score as S
from terroir.operators.common import numbered, written
from terroir.plans.base import FIRSTS, RECORDS, Tables, records

ORDER = ["line", "part", "supp", "granted"]
QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return keep


def firsts(t: Tables) -> DataFrame:
    return A.first_wins(records(t), ["region", "item", "app"], ORDER)


RATE = "CASE WHEN {d} > 0 THEN round({n}::DOUBLE / {d}, 4) END"


@query("d03_bucket_counters", "WITH " + RECORDS + """
SELECT region, item, count(*) AS query_count, count(*) FILTER (WHERE status = 'registered') AS success_count,
       count(*) FILTER (WHERE status = 'pending') AS partial_count, count(*) FILTER (WHERE status = 'inactive') AS error_count,
       sum(coalesce(nullif(line, 1), class))::BIGINT AS source_total FROM rec GROUP BY region, item""")
def _(t):
    hits = F.coalesce(F.nullif("line", F.lit(1)), "class")
    return records(t).groupBy("region", "item").agg(
        F.count(F.lit(1)).alias("query_count"), F.count_if(F.col("status") == "registered").alias("success_count"),
        F.count_if(F.col("status") == "pending").alias("partial_count"), F.count_if(F.col("status") == "inactive").alias("error_count"), F.sum(hits).alias("source_total"),
    )


@query("d04_distinct_records", "WITH " + RECORDS + """
SELECT region, item, count(*) AS n, count(DISTINCT app) AS distinct_n, count(*) - count(DISTINCT app) AS duplicates FROM rec GROUP BY region, item""")
def _(t):
    n, d = F.count(F.lit(1)), F.count_distinct(A.record_key(F.col("app"), F.lit(None).cast("string")))
    return records(t).groupBy("region", "item").agg(n.alias("n"), d.alias("distinct_n"), (n - d).alias("duplicates"))


@query("d05_source_sets", "WITH " + RECORDS + """
SELECT region, string_agg(DISTINCT kind, '|' ORDER BY kind) AS sources, count(DISTINCT kind || '/' || segment) AS provenances FROM rec GROUP BY region""")
def _(t):
    return records(t).groupBy("region").agg(F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("sources"), F.count_distinct("kind", "segment").alias("provenances"))


@query("d06_output_caps", "WITH " + RECORDS + """,
q AS (SELECT item, least(count(*), 500) AS kept, count(*) > 500 AS capped FROM rec GROUP BY item)
SELECT item[1:1] AS initial, max(CASE WHEN capped THEN 500 END) AS cap, sum(CASE WHEN capped THEN kept END)::BIGINT AS collected FROM q GROUP BY 1""")
def _(t):
    per = records(t).groupBy("item").agg(F.count(F.lit(1)).alias("n")).withColumn("kept", F.least("n", F.lit(500)))
    capped = F.col("n") > 500
    return per.groupBy(F.substring("item", 1, 1).alias("initial")).agg(F.max(F.when(capped, 500)).alias("cap"), F.sum(F.when(capped, F.col("kept"))).alias("collected"))


@query("d07_status_counts", "WITH " + FIRSTS + f"""
SELECT region, item, count(*) FILTER (WHERE status = 'registered') AS registered, count(*) FILTER (WHERE status = 'pending') AS pending,
       count(*) FILTER (WHERE status = 'inactive') AS inactive, count(*) FILTER (WHERE status = 'unknown') AS "unknown",
       {RATE.format(n="count(*) FILTER (WHERE status = 'registered')", d="count(*)")} AS registration_rate FROM fst GROUP BY region, item""")
def _(t):
    return firsts(t).groupBy("region", "item").agg(*A.status_counts())


@query("d08_region_counts", "WITH " + FIRSTS + f"""
SELECT region, item, count(*) FILTER (WHERE relation = 'inside') AS inside, count(*) FILTER (WHERE relation = 'outside') AS outside,
       count(*) FILTER (WHERE relation = 'unverified') AS unverified, count(*) AS verified, 1.0::DOUBLE AS verification_rate,
       {RATE.format(n="count(*) FILTER (WHERE relation = 'inside')", d="count(*)")} AS local_share FROM fst GROUP BY region, item""")
def _(t):
    return firsts(t).groupBy("region", "item").agg(*A.relation_counts())


@query("d09_regional_status", "WITH " + FIRSTS + f"""
SELECT region, count(*) FILTER (WHERE relation = 'inside' AND status = 'registered') AS r_registered, count(*) FILTER (WHERE relation = 'inside' AND status = 'pending') AS r_pending,
       count(*) FILTER (WHERE relation = 'inside' AND status = 'inactive') AS r_inactive, 0::BIGINT AS r_unknown,
       {RATE.format(n="count(*) FILTER (WHERE relation = 'inside' AND status = 'registered')", d="count(*) FILTER (WHERE relation = 'inside')")} AS r_registration_rate
FROM fst GROUP BY region""")
def _(t):
    return firsts(t).groupBy("region").agg(*A.status_counts(where=F.col("relation") == "inside", prefix="r_"))


@query("d10_reference_counts", "WITH " + FIRSTS + f"""
SELECT region, count(*) FILTER (WHERE kind <> 'PROMO') AS not_referenced, count(*) FILTER (WHERE kind = 'PROMO' AND relation = 'inside') AS ref_inside,
       count(*) FILTER (WHERE kind = 'PROMO' AND relation = 'outside') AS ref_outside,
       {RATE.format(n="count(*) FILTER (WHERE kind = 'PROMO')", d="count(*)")} AS reference_rate FROM fst GROUP BY region""")
def _(t):
    ref = F.col("kind") == "PROMO"
    return firsts(t).groupBy("region").agg(
        F.count_if(~ref).alias("not_referenced"), F.count_if(ref & (F.col("relation") == "inside")).alias("ref_inside"),
        F.count_if(ref & (F.col("relation") == "outside")).alias("ref_outside"), safe_rate(F.count_if(ref), F.count(F.lit(1))).alias("reference_rate"),
    )


GOODS = "CASE WHEN class % 5 = 0 THEN 'normalized_exact' WHEN class % 5 = 1 THEN 'normalized_contains' WHEN class % 5 = 2 THEN 'class_only' WHEN class % 5 = 3 THEN 'mismatch' ELSE 'unverified' END"


@query("d11_goods_distribution", "WITH " + FIRSTS + f""", g AS (SELECT region, {GOODS} AS m FROM fst)
SELECT region, count(*) FILTER (WHERE m = 'normalized_exact') AS confirmed, count(*) FILTER (WHERE m IN ('normalized_contains', 'class_only')) AS review,
       count(*) FILTER (WHERE m = 'mismatch') AS mismatch, {RATE.format(n="count(*) FILTER (WHERE m <> 'unverified')", d="count(*)")} AS evaluated_rate FROM g GROUP BY region""")
def _(t):
    return firsts(t).withColumn("m", F.expr(GOODS)).groupBy("region").agg(*S.goods_counts("m"))


@query("d12_registry_distribution", "WITH " + FIRSTS + """
SELECT region, count(*) FILTER (WHERE app % 3 <> 0) AS complete, count(*) FILTER (WHERE app % 3 = 0) AS not_collected, count(*) FILTER (WHERE app % 3 = 1 AND class >= 35) AS from_source FROM fst GROUP BY region""")
def _(t):
    collected = F.col("app") % 3 != 0
    counts = {"complete": collected, "not_collected": ~collected, "from_source": (F.col("app") % 3 == 1) & (F.col("class") >= 35)}
    return firsts(t).groupBy("region").agg(*[F.count_if(when).alias(name) for name, when in counts.items()])


@query("d13_year_histogram", "WITH " + FIRSTS + """, y AS (SELECT region, year(filed) AS y, count(*) AS n FROM fst GROUP BY ALL)
SELECT region, string_agg(y || ':' || n, ',' ORDER BY y) AS years FROM y WHERE y BETWEEN 1800 AND 2200 GROUP BY region""")
def _(t):
    years = A.histogram(firsts(t), ["region"], F.when(F.year("filed").between(1800, 2200), F.year("filed")), "m")
    return years.select("region", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))), ",").alias("years"))


@query("d14_month_histogram", "WITH " + FIRSTS + """, m AS (SELECT item, strftime(filed, '%Y-%m') AS m, count(*) AS n FROM fst WHERE strftime(filed, '%Y-%m') >= '1996-01' GROUP BY ALL)
SELECT item, string_agg(m || '=' || n, ',' ORDER BY m) AS months FROM m GROUP BY item""")
def _(t):
    month = F.date_format("filed", "yyyy-MM")
    rows = A.histogram(firsts(t), ["item"], F.when(month >= "1996-01", month), "m")
    return rows.select("item", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("months"))


@query("d15_period_comparison", "WITH " + FIRSTS + """, c AS (SELECT region, item, count(*) FILTER (WHERE year(filed) BETWEEN 1996 AND 1997) AS recent, count(*) FILTER (WHERE year(filed) BETWEEN 1994 AND 1995) AS previous FROM fst GROUP BY region, item)
SELECT *, recent - previous AS change, CASE WHEN previous > 0 THEN round((recent - previous)::DOUBLE / previous, 4) END AS change_rate,
       CASE WHEN recent > previous THEN 'up' WHEN recent < previous THEN 'down' ELSE 'flat' END AS trend FROM c""")
def _(t):
    return firsts(t).groupBy("region", "item").agg(*A.period_comparison(F.year("filed"), 1998, 2))


@query("d16_local_applicants", "WITH " + FIRSTS + f""", c AS (SELECT region, count(DISTINCT applicant) FILTER (WHERE relation = 'inside') AS local_applicants,
       count(DISTINCT applicant) FILTER (WHERE relation = 'inside' AND segment = 'BUILDING') AS producers FROM fst GROUP BY region)
SELECT *, {RATE.format(n="producers", d="local_applicants")} AS producer_share FROM c""")
def _(t):
    inside = F.col("relation") == "inside"
    rows = DC.counted(DC.key_rows(firsts(t), "applicant", ["region"], {"local_applicants": inside, "producers": inside & (F.col("segment") == "BUILDING")}), ["region"], ["local_applicants", "producers"])
    return rows.withColumn("producer_share", safe_rate(F.col("producers"), F.col("local_applicants")))


@query("d17_raw_goods", "WITH " + FIRSTS + f""", c AS (SELECT item, count(*) FILTER (WHERE class IN (29, 30, 31)) AS candidates, count(*) FILTER (WHERE class IN (29, 30, 31) AND relation = 'inside') AS local FROM fst GROUP BY item)
SELECT *, {RATE.format(n="local", d="candidates")} AS share FROM c""")
def _(t):
    raw = F.exists(F.split(F.col("class").cast("string"), r"[|,]"), lambda x: F.regexp_replace(F.trim(x), "^0+(?=\\d)", "").isin("29", "30", "31"))
    rows = firsts(t).groupBy("item").agg(F.count_if(raw).alias("candidates"), F.count_if(raw & (F.col("relation") == "inside")).alias("local"))
    return rows.withColumn("share", safe_rate(F.col("local"), F.col("candidates")))


@query("d18_address_evidence", "WITH " + FIRSTS + f""", c AS (SELECT region, count(*) FILTER (WHERE app % 3 <> 0) AS evidenced, count(*) AS n FROM fst GROUP BY region)
SELECT *, {RATE.format(n="evidenced", d="n")} AS evidence_rate FROM c""")
def _(t):
    evidence = F.when(F.col("app") % 3 != 0, F.array("app_region")).otherwise(F.array().cast("array<string>"))
    rows = firsts(t).withColumn("e", evidence).groupBy("region").agg(F.count_if(F.exists("e", lambda x: x.isNotNull())).alias("evidenced"), F.count(F.lit(1)).alias("n"))
    return rows.withColumn("evidence_rate", safe_rate(F.col("evidenced"), F.col("n")))


@query("d19_rollup_distinct", "WITH " + RECORDS + """
SELECT 'cell' AS level, region, item, count(DISTINCT app) AS n, count(DISTINCT app) FILTER (WHERE relation = 'inside') AS inside FROM rec GROUP BY region, item
UNION ALL SELECT 'region', region, 'all', count(DISTINCT app), count(DISTINCT app) FILTER (WHERE relation = 'inside') FROM rec GROUP BY region
UNION ALL SELECT 'item', 'all', item, count(*), count(*) FILTER (WHERE relation = 'inside')
  FROM (SELECT *, row_number() OVER (PARTITION BY item, app ORDER BY region, line, part, supp, granted) AS rn FROM rec) WHERE rn = 1 GROUP BY item
UNION ALL SELECT 'total', 'all', 'all', count(*), count(*) FILTER (WHERE relation = 'inside')
  FROM (SELECT *, row_number() OVER (PARTITION BY app ORDER BY region, item, line, part, supp, granted) AS rn FROM rec) WHERE rn = 1""")
def _(t):
    return A.rollup_distinct(records(t), {"cell": ["region", "item"], "region": ["region"], "item": ["item"], "total": []}, "app", ORDER)


@query("d19_distinct_levels", "WITH " + RECORDS + " ".join(f"""{union} SELECT '{level}' AS level, {region} AS region, {item} AS item, count(DISTINCT app) AS n, count(DISTINCT app) FILTER (WHERE relation = 'inside') AS inside, count(DISTINCT app) FILTER (WHERE granted IS NOT NULL) AS granted_ones FROM rec GROUP BY ALL"""
  for union, level, region, item in (("", "cell", "region::VARCHAR", "item::VARCHAR"), ("UNION ALL", "region", "region::VARCHAR", "'all'"), ("UNION ALL", "item", "'all'", "item::VARCHAR"), ("UNION ALL", "total", "'all'", "'all'"))))
def _(t):
    """Distinct records of all levels: those of the cells from the records, those of regions, items and all from these."""
    where = {"n": F.lit(True), "inside": F.col("relation") == "inside", "granted_ones": F.col("granted").isNotNull()}
    return DC.distinct_counts(records(t), "app", {"cell": ["region", "item"], "region": ["region"], "item": ["item"], "total": []}, where)


@query("d20_summed_override", "WITH " + FIRSTS + """, cell AS (SELECT region, item, count(*) FILTER (WHERE relation = 'inside') AS inside FROM fst GROUP BY region, item)
SELECT item, (SELECT count(DISTINCT app) FROM rec r WHERE r.item = c.item) AS n, sum(inside)::BIGINT AS inside FROM cell c GROUP BY item""")
def _(t):
    rows = written(firsts(t).select("region", "item", "app", "relation"))
    cells = rows.groupBy("region", "item").agg(F.count_if(F.col("relation") == "inside").alias("inside"))
    items = DC.counted(DC.key_rows(rows, "app", ["item"], {"n": F.lit(True)}), ["item"], ["n"]).withColumn("inside", F.lit(0).cast("long"))
    return A.summed_override(items, cells, ["item"], ["inside"])


@query("d21_availability_gate", "WITH " + RECORDS + """, c AS (SELECT region, item, count(*) AS q, count(*) FILTER (WHERE status <> 'inactive') AS ok, count(*) FILTER (WHERE status = 'pending') AS part,
       count(*) FILTER (WHERE status = 'inactive') AS bad FROM rec GROUP BY region, item)
SELECT region, item, CASE WHEN ok > 0 AND bad = 0 AND (ok - part) / q >= 0.6 THEN 'available' WHEN ok > 0 AND bad = 0 THEN 'partial' ELSE 'blocked' END AS availability FROM c""")
def _(t):
    c = records(t).groupBy("region", "item").agg(
        F.count(F.lit(1)).alias("q"), F.count_if(F.col("status") != "inactive").alias("ok"), F.count_if(F.col("status") == "pending").alias("part"), F.count_if(F.col("status") == "inactive").alias("bad")
    )
    return c.select("region", "item", A.availability(F.col("ok"), F.col("part"), F.col("bad"), F.lit(0), F.col("q"), 0.6).alias("availability"))


@query("d22_run_warnings", "WITH " + RECORDS + """, c AS (SELECT count(*) FILTER (WHERE status = 'inactive') AS bad, count(*) FILTER (WHERE status = 'pending') AS part, count(*) - count(DISTINCT app) AS dup FROM rec)
SELECT warning FROM (SELECT unnest([CASE WHEN bad > 0 THEN 'errors:' || bad END, CASE WHEN part > 0 THEN 'partial:' || part END, CASE WHEN dup > 0 THEN 'duplicates:' || dup END]) AS warning FROM c) WHERE warning IS NOT NULL""")
def _(t):
    c = records(t).agg(F.count_if(F.col("status") == "inactive").alias("bad"), F.count_if(F.col("status") == "pending").alias("part"), (F.count(F.lit(1)) - F.count_distinct("app")).alias("dup"))
    return S.warnings(c, {"errors": "bad", "partial": "part", "duplicates": "dup"})


SCORED = FIRSTS + """,
bkt AS (SELECT region, item, count(*) FILTER (WHERE relation = 'inside') AS n, bool_or(kind = 'PROMO') AS flagged,
        count(*) FILTER (WHERE relation = 'inside' AND status = 'registered') AS reg FROM fst GROUP BY region, item),
rat AS (SELECT *, CASE WHEN n > 0 THEN round(reg::DOUBLE / n, 4) END AS rate FROM bkt),
scr AS (SELECT region, item, n, rate, flagged OR n >= 3 AS representative,
        CASE WHEN flagged OR n >= 3 THEN round(1 - (0.7::DOUBLE * least(1.0::DOUBLE, n / 5.0::DOUBLE) + 0.3::DOUBLE * coalesce(rate, 0.0::DOUBLE)), 4) END AS gap_score,
        CASE WHEN flagged OR n >= 3 THEN 'preview' ELSE 'not_applicable' END AS score_availability,
        n >= 5 AND coalesce(rate < 0.3, false) AS low_conversion FROM rat)"""


def scored(t: Tables) -> DataFrame:
    inside = F.col("relation") == "inside"
    cells = firsts(t).groupBy("region", "item").agg(F.count_if(inside).alias("n"), F.bool_or(F.col("kind") == "PROMO").alias("flagged"), safe_rate(F.count_if(inside & (F.col("status") == "registered")), F.count_if(inside)).alias("rate"))
    return cells.select("region", "item", "n", "rate", *S.gap_score(F.col("n"), F.col("rate"), F.col("flagged"), F.lit("available"), F.lit(None).cast("double")))


@query("d24_gap_score", "WITH " + SCORED + " SELECT * FROM scr")
def _(t):
    return scored(t)


@query("d25_gap_counters", "WITH " + SCORED + """ SELECT count(*) AS buckets, count(*) FILTER (WHERE score_availability = 'blocked') AS blocked,
  count(*) FILTER (WHERE NOT representative) AS not_representative, count(*) FILTER (WHERE low_conversion) AS low_conversion FROM scr""")
def _(t):
    return S.gap_counters(scored(t))


@query("gap_ranking", "WITH " + SCORED + """ SELECT row_number() OVER (ORDER BY gap_score DESC, region, item) AS rank, region, item, n, gap_score FROM scr WHERE representative""")
def _(t):
    return S.gap_ranking(scored(t))


@query("c39_threshold_comparison", "WITH " + SCORED.replace("scr AS", "old AS") + """, a AS (SELECT region, item FROM bkt WHERE flagged OR n >= 1), b AS (SELECT region, item FROM bkt WHERE flagged OR n >= 3)
SELECT region, item, 'only_at_1' AS side FROM a EXCEPT SELECT region, item, 'only_at_1' FROM b""")
def _(t):
    cells = written(scored(t))
    low, high = (cells.filter((F.col("score_availability") == "preview") | (F.col("n") >= k)).select("region", "item") for k in (1, 3))
    return S.set_differences(low, high, "only_at_1", "only_at_3")


@query("e01_first_wins", "WITH " + RECORDS + """ SELECT item, app, line, part, supp FROM (SELECT *, row_number() OVER (PARTITION BY item, app ORDER BY line, part, supp, region, granted) AS rn FROM rec) WHERE rn = 1""")
def _(t):
    return A.first_wins(records(t), ["item", "app"], ["line", "part", "supp", "region", "granted"]).select("item", "app", "line", "part", "supp")


@query("e05_hit_cap", "WITH " + RECORDS + """, k AS (SELECT item, app, row_number() OVER (PARTITION BY item ORDER BY filed, app, line, part, supp, region, granted) AS rn, count(*) OVER (PARTITION BY item) AS total FROM rec)
SELECT item, app, rn::INT AS pos, 50 AS cap, total FROM k WHERE rn <= 50""")
def _(t):
    return S.capped(records(t), ["item"], ["filed", "app", "line", "part", "supp", "region", "granted"], 50).select("item", "app", "pos", "cap", "total")


@query("e13_examples", "WITH " + FIRSTS + """, a AS (SELECT region, item, app, filed, class, relation = 'inside' AND status = 'registered' AS ri, row_number() OVER (PARTITION BY region, item ORDER BY (relation = 'inside' AND status = 'registered')::INT DESC, filed DESC, app) AS a,
  row_number() OVER (PARTITION BY region, item ORDER BY class DESC, filed DESC, app) AS b FROM fst),
c AS (SELECT *, CASE WHEN ri AND a = 1 THEN 0 WHEN class > 0 AND b <= 3 THEN 1 ELSE 2 END AS tier FROM a),
d AS (SELECT *, row_number() OVER (PARTITION BY region, item ORDER BY tier, filed DESC, app) AS rn FROM c)
SELECT region, item, app, tier, row_number() OVER (PARTITION BY region, item ORDER BY filed DESC, app)::INT AS rank FROM d WHERE rn <= 5""")
def _(t):
    inside = (F.col("relation") == "inside") & (F.col("status") == "registered")
    return A.tiered_examples(firsts(t), ["region", "item"], "app", inside, F.col("class"), "filed", 5).select("region", "item", "app", "tier", "rank")


@query("e14_recent_records", "WITH " + FIRSTS + """ SELECT region, item, app, rank FROM (SELECT *, row_number() OVER (PARTITION BY region, item ORDER BY filed DESC, app)::INT AS rank FROM fst) WHERE rank <= 3""")
def _(t):
    return A.ranked_examples(firsts(t), ["region", "item"], [F.desc("filed"), F.col("app")], 3).select("region", "item", "app", "rank")


@query("f01_aggregate_order", "WITH " + FIRSTS + """, c AS (SELECT region, item, count(*) AS n FROM fst GROUP BY region, item) SELECT row_number() OVER (ORDER BY n DESC, region, item) AS place, * FROM c""")
def _(t):
    return numbered(firsts(t).groupBy("region", "item").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), F.col("region"), F.col("item")], "place")


@query("f06_top_regions", "WITH " + RECORDS + """ SELECT region, count(*) AS n FROM rec GROUP BY region ORDER BY n DESC, region LIMIT 10""")
def _(t):
    return records(t).groupBy("region").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "region").limit(10)


@query("f09_multi_key_sort", "WITH " + SCORED + """ SELECT row_number() OVER (ORDER BY gap_score DESC NULLS LAST, rate ASC NULLS FIRST, region, item) AS place, region, item FROM scr""")
def _(t):
    return numbered(scored(t), [F.col("gap_score").desc_nulls_last(), F.col("rate").asc_nulls_first(), F.col("region"), F.col("item")], "place").select("place", "region", "item")


@query("f11_ordinal_sort", "WITH " + RECORDS + """ SELECT region, province, row_number() OVER (ORDER BY CASE province WHEN 'EUROPE' THEN 0 WHEN 'ASIA' THEN 1 ELSE 9 END, region) AS place FROM (SELECT DISTINCT region, province FROM rec)""")
def _(t):
    return S.ordinal_sort(records(t).select("region", "province").distinct(), "province", {"EUROPE": 0, "ASIA": 1}, ["region"])


@query("d69_document_counters", "WITH " + RECORDS + """ SELECT count(*) FILTER (WHERE status = 'registered') AS success, count(*) FILTER (WHERE status = 'pending') AS partial, count(*) FILTER (WHERE status = 'inactive') AS error, count(DISTINCT item) AS unique_queries, count(DISTINCT CASE WHEN status = 'pending' THEN item END) AS unique_partial FROM rec""")
def _(t):
    return P.document_counters(records(t), F.col("status"), F.col("item"))
