"""Queries of the enrichment, snapshot, review and archive operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.functions import text as X
from terroir.functions import values as V
from terroir.operators import enrich as E
from terroir.operators import reports as P
from terroir.operators import review as Q
from terroir.operators import rows as R
from terroir.operators import snapshot as N
from terroir.operators.common import checked_broadcast, numbered, written
from terroir.plans.base import FIRSTS, RECORDS, Tables, masters, records
from terroir.sources.bucketed import BucketedArchive

QUERIES, SQL = {}, {}
c, lit = F.col, F.lit


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return keep


def arrayed(x):
    return F.array_join(x, "|")


@query("d01_query_groups", "SELECT p_name AS query_key, count(*) AS n_rows, min(p_partkey) AS first_row, count(*) - 1 AS duplicates FROM part GROUP BY p_name")
def _(t):
    g = t.part.groupBy(R.query_key(c("p_name"), F.array(lit("1"))).alias("k"), "p_name").agg(F.array_sort(F.collect_list("p_partkey")).alias("rows"))
    return g.select(c("p_name").alias("query_key"), F.size("rows").cast("long").alias("n_rows"), c("rows")[0].alias("first_row"), (F.size("rows") - 1).cast("long").alias("duplicates"))


@query("d02_plan_summary", "SELECT count(*) FILTER (WHERE p_size <= 40) AS searchable, count(DISTINCT CASE WHEN p_size <= 40 THEN p_name END) AS unique_queries, count(*) FILTER (WHERE p_size <= 40) - count(DISTINCT CASE WHEN p_size <= 40 THEN p_name END) AS duplicates, count(*) FILTER (WHERE p_size > 40) AS skipped, count(DISTINCT CASE WHEN p_size <= 40 THEN p_name END) AS min_requests, least(5 * count(DISTINCT CASE WHEN p_size <= 40 THEN p_name END), 1000) AS max_requests FROM part")
def _(t):
    return P.plan_summary(t.part, c("p_size") <= 40, c("p_name"), 5, 1000)


@query("c10_reference_relations", """SELECT o_orderkey, CASE WHEN count(DISTINCT rel) = 1 THEN min(rel) ELSE 'unverified' END AS reference_relation FROM (SELECT o_orderkey, CASE WHEN s_nationkey = c_nationkey THEN 'inside' ELSE 'outside' END AS rel
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey) GROUP BY o_orderkey""")
def _(t):
    recs = t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).select(X.digits_only(F.concat(lit("40-"), c("o_orderkey").cast("string"))).alias("number"), "o_orderkey", "c_nationkey")
    refs = t.lineitem.join(t.supplier, c("l_suppkey") == c("s_suppkey")).select(F.concat(lit("40"), c("l_orderkey").cast("string")).alias("number"), "s_nationkey")
    out = E.reference_relations(recs, refs, "number", F.when(c("s_nationkey") == c("c_nationkey"), "inside").otherwise("outside"))
    return out.join(recs.select("number", "o_orderkey"), "number").select("o_orderkey", "reference_relation")


def cache(t):
    return t.orders.filter("o_orderkey % 3 <> 0").select(c("o_orderkey").alias("number"), F.when(c("o_orderkey") % 3 == 1, "ok").otherwise("not_found").alias("status"), "o_totalprice")


@query("c12_applicant_enrichment", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 4 = 0 THEN 'no_number' WHEN l_orderkey % 3 = 0 THEN 'not_collected' WHEN l_orderkey % 3 = 1 THEN 'ok' ELSE 'not_found' END AS enrichment FROM lineitem")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.when(c("l_linenumber") % 4 != 0, c("l_orderkey")).alias("number"))
    return E.from_cache(rows, cache(t), "number").select("l_orderkey", "l_linenumber", "l_partkey", "enrichment")


@query("c13_registry_enrichment", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'not_applicable' WHEN l_orderkey % 3 = 0 THEN 'not_collected' WHEN l_orderkey % 3 = 1 THEN 'ok' ELSE 'not_found' END AS enrichment FROM lineitem")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", c("l_orderkey").alias("number"))
    return E.from_cache(rows, cache(t), "number", c("l_returnflag") != "R").select("l_orderkey", "l_linenumber", "l_partkey", "enrichment")


@query("c14_goods_precedence", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN 'normalized_exact' WHEN l_orderkey % 3 <> 0 THEN 'normalized_contains' ELSE 'class_only' END AS method FROM lineitem")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.when(c("l_returnflag") == "A", "normalized_exact").otherwise("class_only").alias("old"), c("l_orderkey").alias("number"))
    j = E.from_cache(rows, cache(t), "number")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", E.keep_confirmed(c("old"), F.when(c("enrichment").isin("ok", "not_found"), "normalized_contains")).alias("method"))


@query("c16_goods_match", """WITH g AS (SELECT l_orderkey, list_distinct(list(p_name)) AS p, list_distinct(list(p_size)) AS k FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1), x AS (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN ['red bolt', 'gear'] ELSE ['old', 'x'] END AS t FROM g)
SELECT l_orderkey, CASE WHEN list_has_any(p, t) THEN 'normalized_exact' WHEN len([1 FOR a IN p IF contains(a, t[1]) OR contains(a, t[2])]) > 0 THEN 'normalized_contains' WHEN list_contains(k, 30) THEN 'class_only' ELSE 'mismatch' END AS method FROM x""")
def _(t):
    g = t.lineitem.join(t.part, c("l_partkey") == c("p_partkey")).groupBy("l_orderkey").agg(F.collect_set("p_name").alias("p"), F.collect_set("p_size").alias("k"))
    targets = F.when(c("l_orderkey") % 3 == 0, F.array(lit("red bolt"), lit("gear"))).otherwise(F.array(lit("old"), lit("x")))
    return g.select("l_orderkey", E.goods_match(targets, c("p"), F.array_contains("k", 30)).alias("method"))


EVIDENCE = """WITH l AS (SELECT l_orderkey, l_linenumber, p_size AS class, p_name AS name, CASE WHEN l_orderkey % 3 = 0 THEN ['red bolt', 'gear', 'hot ring'] ELSE ['gizmo', 'small bolt', 'ring'] END AS t FROM lineitem JOIN part ON l_partkey = p_partkey),
k AS (SELECT *, l_orderkey % 4 = 0 OR class BETWEEN 10 AND 40 AS of_class, list_contains(t, name) AS same, [x FOR x IN t IF contains(name, x) OR contains(x, name)] AS held FROM l),
n AS (SELECT l_orderkey, count(*) AS products, count(*) FILTER (WHERE of_class) AS class_matched, count(*) FILTER (WHERE of_class AND same) AS n_same, count(*) FILTER (WHERE of_class AND NOT same AND len(held) > 0) AS n_held,
  (list(name ORDER BY l_linenumber, class, name) FILTER (WHERE of_class AND same))[1] AS first, any_value(t) AS t FROM k GROUP BY l_orderkey),
p AS (SELECT l_orderkey, class, name, CASE WHEN same THEN 'exact' ELSE 'contains' END AS kind, CASE WHEN same THEN name ELSE held[1] END AS target, min(l_linenumber) AS line FROM k WHERE of_class AND len(held) > 0 GROUP BY ALL),
e AS (SELECT l_orderkey, string_agg(class || ':' || name || ':' || kind || ':' || target, '|' ORDER BY (kind = 'contains'), line, class, name) AS evidence FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY (kind = 'contains'), line, class, name) AS r FROM p) WHERE r <= 3 GROUP BY 1)
SELECT l_orderkey, CASE WHEN n_same > 0 THEN 'normalized_exact' WHEN n_held > 0 THEN 'normalized_contains' WHEN class_matched > 0 THEN 'class_only' ELSE 'mismatch' END AS method, CASE WHEN n_same > 0 THEN 'high' WHEN n_held > 0 THEN 'high_contains' WHEN class_matched > 0 THEN 'candidate_only' ELSE 'high' END AS confidence,
  n_same = 0 AS review, CASE WHEN first <> t[1] THEN 'notice ' || first END AS notice, CASE WHEN first <> t[1] THEN CASE WHEN first = t[2] THEN 'processed' ELSE 'service' END END AS stage, products::INT AS products, class_matched::INT AS class_matched, coalesce(evidence, '') AS evidence FROM n LEFT JOIN e USING (l_orderkey)"""


@query("c16_goods_evidence", EVIDENCE)
def _(t):
    """The goods of each order against an item and two aliases of it, with three pieces of evidence at most."""
    lines = t.lineitem.join(t.part, c("l_partkey") == c("p_partkey")).select("l_orderkey", F.struct("l_linenumber", c("p_size").alias("class"), c("p_name").alias("name"), c("p_name").alias("goods")).alias("p"))
    g = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("p")).alias("p"))
    target = lambda name, stage: F.struct(lit(name).alias("name"), lit(f"notice {name}").alias("notice"), lit(stage).alias("stage"))
    names = lambda a, b, x: F.array(target(a, "raw"), target(b, "processed"), target(x, "service"))
    targets = F.when(c("l_orderkey") % 3 == 0, names("red bolt", "gear", "hot ring")).otherwise(names("gizmo", "small bolt", "ring"))
    classes = F.when(c("l_orderkey") % 4 == 0, F.array().cast("array<int>")).otherwise(F.sequence(lit(10), lit(40)))
    found = g.select("l_orderkey", E.goods_evidence(targets, c("p"), classes, 3).alias("m")).select("l_orderkey", "m.*").drop("aliases")
    piece = lambda x: F.concat_ws(":", x["class"].cast("string"), x["goods"], x["kind"], x["target"])
    return found.withColumn("evidence", F.array_join(F.transform("evidence", piece), "|"))


@query("c17_facts_expansion", "SELECT s_suppkey, p_partkey, l_orderkey FROM (SELECT s_suppkey, s_suppkey * 3 AS q FROM supplier) LEFT JOIN (SELECT p_partkey, p_partkey AS q, l_orderkey FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_partkey % 2 = 0) USING (q)")
def _(t):
    facts = t.part.filter("p_partkey % 2 = 0").join(t.lineitem, c("p_partkey") == c("l_partkey")).select(c("p_partkey").alias("q"), "p_partkey", "l_orderkey")
    return E.expand_facts(t.supplier.select("s_suppkey", (c("s_suppkey") * 3).alias("q")), facts, "q").select("s_suppkey", "p_partkey", "l_orderkey")


@query("c18_per_region_reevaluation", "WITH " + RECORDS + ", f AS (SELECT item, app, min(app_region) AS app_region FROM rec GROUP BY item, app), e AS (SELECT DISTINCT region, item FROM rec) SELECT region, item, count(*) FILTER (WHERE app_region = region) AS inside, count(*) FILTER (WHERE app_region <> region) AS outside FROM e JOIN f USING (item) GROUP BY region, item")
def _(t):
    """Each region that files an item looks at all records of the item; these are counted by region before the join."""
    rec = written(records(t).select("item", "app", "region", "app_region"))
    facts = rec.groupBy("item", "app").agg(F.min("app_region").alias("app_region")).groupBy("item", "app_region").agg(F.count(lit(1)).alias("n"))
    own, zero = c("app_region") == c("region"), lit(0)
    return rec.select("region", "item").distinct().join(facts, "item").groupBy("region", "item").agg(F.sum(F.when(own, c("n")).otherwise(zero)).alias("inside"), F.sum(F.when(~own, c("n")).otherwise(zero)).alias("outside"))


@query("c21_reviewed_overlay", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 AND p_type = 'PROMO' THEN 99 ELSE p_size END AS p_size FROM part")
def _(t):
    rows = t.part.select("p_partkey", "p_type", "p_size")
    patch = t.part.filter("p_partkey % 4 = 0").select("p_partkey", lit(99).alias("p_size"))
    return N.update_join(rows, patch, ["p_partkey"], ["p_size"], c("p_type") == "PROMO")[0].select("p_partkey", "p_size")


@query("c21_skipped_patches", "SELECT p_partkey, 'not_allowed' AS reason FROM part WHERE p_partkey % 4 = 0 AND p_type <> 'PROMO' UNION ALL SELECT p_partkey + 1000000, 'no_row' FROM part WHERE p_partkey % 100 = 0")
def _(t):
    """Patches of a second source have no rows, whatever keys the table has: the source is part of the key."""
    rows = t.part.select(lit(1).alias("source"), "p_partkey", "p_type", "p_size")
    patch = t.part.filter("p_partkey % 4 = 0").select(lit(1).alias("source"), "p_partkey", lit(99).alias("p_size")).union(t.part.filter("p_partkey % 100 = 0").select(lit(2), c("p_partkey") + 1000000, lit(1)))
    return N.update_join(rows, patch, ["source", "p_partkey"], ["p_size"], c("p_type") == "PROMO")[1].drop("source")


@query("c22_snapshot_assembly", "SELECT p_partkey, gap, text FROM (SELECT p_partkey FROM part WHERE p_partkey % 5 <> 0) LEFT JOIN (SELECT p_partkey, p_size AS gap FROM part WHERE p_partkey % 2 = 0) USING (p_partkey) LEFT JOIN (SELECT p_partkey, p_name AS text FROM part WHERE p_partkey % 3 = 0) USING (p_partkey)")
def _(t):
    p = t.part
    return N.assemble(p.filter("p_partkey % 5 <> 0").select("p_partkey"), p.filter("p_partkey % 2 = 0").select("p_partkey", c("p_size").alias("gap")), p.filter("p_partkey % 3 = 0").select("p_partkey", c("p_name").alias("text")), ["p_partkey"])


@query("c22_orphans", "SELECT 'gap' AS source, p_partkey FROM part WHERE p_partkey % 10 = 0 UNION ALL SELECT 'briefing', p_partkey FROM part WHERE p_partkey % 15 = 0")
def _(t):
    p = t.part.select("p_partkey")
    return N.orphans(p.filter("p_partkey % 5 <> 0"), {"gap": p.filter("p_partkey % 2 = 0"), "briefing": p.filter("p_partkey % 3 = 0")}, ["p_partkey"])


@query("c24_category_lookup", "SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'T' WHEN contains(p_name, 'bolt') AND p_name <> 'red bolt' THEN 'N' WHEN contains(p_name, 'gear') THEN 'P' END AS category, p_type <> 'PROMO' AND contains(p_name, 'gear') AS provisional FROM part")
def _(t):
    p = t.part
    confirmed = p.filter("p_name like '%bolt%' and p_name <> 'red bolt'").select(c("p_name").alias("name"), lit("N").alias("category")).distinct().union(p.filter("p_type = 'PROMO'").select("p_type", lit("T")).distinct())
    proposed = p.filter("p_name like '%gear%'").select(c("p_name").alias("name"), lit("P").alias("category")).distinct()
    rows = p.select("p_partkey", c("p_type").alias("notice"), c("p_name").alias("item"))
    return N.category_lookup(rows, confirmed, proposed, "^fresh ").select("p_partkey", "category", "provisional")


@query("b23_drop_excluded", "SELECT 'items' AS t, count(*) AS n FROM part WHERE p_name NOT LIKE '%bolt%' UNION ALL SELECT 'lines', count(*) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_name NOT LIKE '%bolt%'")
def _(t):
    ex = t.part.filter("p_name like '%bolt%'").select("p_name")
    kept = N.drop_excluded([t.part.select("p_name"), t.lineitem.join(t.part, c("l_partkey") == c("p_partkey")).select("p_name")], ex, "p_name")
    return kept[0].agg(F.count(lit(1)).alias("n")).select(lit("items").alias("t"), "n").unionByName(kept[1].agg(F.count(lit(1)).alias("n")).select(lit("lines").alias("t"), "n"))


@query("c25_evidence_expansion", "SELECT p_partkey, coalesce(place, 'nationwide') AS place FROM (SELECT p_partkey FROM part) LEFT JOIN (SELECT DISTINCT l_partkey AS p_partkey, n_name AS place FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_partkey % 3 = 0) USING (p_partkey)")
def _(t):
    ev = t.lineitem.filter("l_partkey % 3 = 0").join(t.supplier, c("l_suppkey") == c("s_suppkey")).join(checked_broadcast(t.nation), c("s_nationkey") == c("n_nationkey")).select(c("l_partkey").alias("p_partkey"), c("n_name").alias("place")).distinct()
    return E.evidence_expansion(t.part.select("p_partkey"), ev, "p_partkey", "place", "nationwide")


@query("c26_evidence_attachment", "WITH e AS (SELECT DISTINCT p_name, s_nationkey FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE p_size < 10), i AS (SELECT DISTINCT p_name, n_nationkey FROM part, nation) SELECT p_name, n_nationkey, count(s_nationkey) AS n, coalesce(string_agg(s_nationkey::VARCHAR, '|' ORDER BY s_nationkey), '') AS evidence FROM i LEFT JOIN e USING (p_name) WHERE n_nationkey = 0 OR s_nationkey = n_nationkey OR s_nationkey IS NULL GROUP BY ALL")
def _(t):
    e = t.lineitem.join(t.part.filter("p_size < 10"), c("l_partkey") == c("p_partkey")).join(t.supplier, c("l_suppkey") == c("s_suppkey")).select("p_name", "s_nationkey").distinct()
    nations = t.nation.select("n_nationkey").orderBy("n_nationkey").agg(F.collect_list("n_nationkey").alias("n"))  # a row of the dimension
    i = t.part.select("p_name").distinct().crossJoin(F.broadcast(nations)).select("p_name", F.explode("n").alias("n_nationkey"))
    j = i.join(e, "p_name", "left").filter("n_nationkey = 0 or s_nationkey = n_nationkey or s_nationkey is null")
    return j.groupBy("p_name", "n_nationkey").agg(F.count("s_nationkey").alias("n"), arrayed(F.array_sort(F.collect_list("s_nationkey")).cast("array<string>")).alias("evidence"))


@query("c27_badges", "WITH r AS (SELECT p_partkey AS ord, p_brand AS tier, unnest(list_distinct(string_split(p_name || '/' || p_type, '/'))) AS name FROM part WHERE p_partkey % 7 = 0), b AS (SELECT name, min_by(tier, ord) AS badge FROM r GROUP BY name) SELECT p_partkey, badge FROM part LEFT JOIN b ON name = p_name")
def _(t):
    refs = t.part.filter("p_partkey % 7 = 0").select(c("p_partkey").alias("ord"), c("p_brand").alias("tier"), F.concat_ws("/", "p_name", "p_type").alias("names"))
    return N.badges(t.part.select("p_partkey", c("p_name").alias("name")), refs, "name", "[·,/()]").select("p_partkey", "badge")


@query("c28_masked_join", "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN n END AS n FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY 1) USING (c_custkey)")
def _(t):
    n = t.orders.groupBy(c("o_custkey").alias("c_custkey")).agg(F.count(lit(1)).alias("n"))
    return N.masked_join(t.customer.select("c_custkey", "c_mktsegment"), n, "c_custkey", ["n"], c("c_mktsegment") == "BUILDING").select("c_custkey", "n")


@query("c29_fill_from", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_name END AS name FROM part")
def _(t):
    rows = t.part.select("p_partkey", F.when(c("p_size") % 3 != 0, c("p_name")).otherwise(" ").alias("name"))
    return N.fill_from(rows, t.part.select("p_partkey", c("p_brand").alias("name")), "p_partkey", ["name"])


@query("c30_coverage_gaps", "SELECT r_name FROM region WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_suppkey % 10 = 3)")
def _(t):
    seen = t.supplier.filter("s_suppkey % 10 = 3").join(t.nation, c("s_nationkey") == c("n_nationkey")).select(c("n_regionkey").alias("r_regionkey"))
    return t.region.join(seen, "r_regionkey", "left_anti").select("r_name")


@query("c31_boundary_coverage", "WITH s AS (SELECT n_nationkey AS code FROM nation WHERE n_nationkey % 6 <> 5), d AS (SELECT r_regionkey + 100 AS code FROM region WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_regionkey = r_regionkey AND n_nationkey % 6 = 5)) SELECT 'missing' AS issue, r_regionkey + 100 AS code FROM region WHERE r_regionkey + 100 NOT IN (SELECT code FROM d) UNION ALL SELECT 'extra', 900 ")
def _(t):
    shapes = t.nation.filter("n_nationkey % 6 <> 5").select(c("n_nationkey").alias("code")).union(t.region.limit(1).select(lit(900)))
    children = t.nation.select((c("n_regionkey") + 100).alias("code"), c("n_nationkey").alias("child"))
    return N.boundary_check(t.region.select((c("r_regionkey") + 100).alias("code")), shapes, children)


RECONCILE = """WITH a AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem WHERE l_shipdate < '1996-01-01' GROUP BY 1), b AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem WHERE l_shipdate >= '1996-01-01' AND l_partkey % 7 <> 0 GROUP BY 1),
j AS (SELECT coalesce(a.k, b.k) AS k, greatest(a.n, b.n) AS n, CASE WHEN b.k IS NOT NULL THEN CASE WHEN a.k IS NULL THEN 'new' ELSE 'kept' END WHEN a.k % 21 = 0 THEN 'dropped' ELSE 'revived' END AS action FROM a FULL JOIN b ON a.k = b.k)
SELECT k, n, CASE WHEN action = 'revived' AND (SELECT count(*) FROM j WHERE action = 'revived') > 100000 THEN 'blocked' ELSE action END AS action FROM j WHERE action <> 'dropped'"""


@query("c32_reconcile", RECONCILE)
def _(t):
    cut = lit("1996-01-01").cast("timestamp")
    count = lambda d: d.groupBy(c("l_partkey").alias("k")).agg(F.count(lit(1)).alias("n"))
    old, new = count(t.lineitem.filter(c("l_shipdate") < cut)), count(t.lineitem.filter((c("l_shipdate") >= cut) & (c("l_partkey") % 7 != 0)))
    return N.reconcile(old, new, ["k"], ["n"], t.part.filter("p_partkey % 21 = 0").select(c("p_partkey").alias("k")), 100000)


MISSING = """WITH a AS (SELECT p_partkey AS k, p_name AS name, p_brand AS place, p_type AS specialty, p_size AS m FROM part WHERE p_partkey % 3 <> 0), b AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN 'new ' || p_name ELSE p_name END AS name, p_brand AS place, p_type AS specialty, p_size - p_partkey % 2 AS m, p_partkey % 10 = 1 AS better FROM part WHERE p_partkey % 4 <> 1 AND p_size < 45),
x AS (SELECT a.k, CASE WHEN k % 7 = 0 THEN 'tombstone' WHEN name LIKE 'hot%' THEN 'excluded' WHEN place = 'Brand#1' AND name IN (SELECT name FROM b) THEN 'relocated' WHEN (place, specialty) IN (SELECT (place, specialty) FROM b) THEN 'renamed' ELSE 'revived' END AS reason FROM a WHERE k NOT IN (SELECT k FROM b))"""


def snapshots(t):
    """Two snapshots of parts, of which the second lacks some, has others besides, and counts less for some."""
    part = t.part.select(c("p_partkey").alias("k"), c("p_name").alias("name"), c("p_brand").alias("place"), c("p_type").alias("specialty"), c("p_size").alias("m"))
    new = part.filter((c("k") % 4 != 1) & (c("m") < 45)).withColumn("name", F.when(c("k") % 5 == 0, F.concat(lit("new "), "name")).otherwise(c("name"))).withColumn("m", c("m") - c("k") % 2).withColumn("better", c("k") % 10 == 1)
    return part.filter(c("k") % 3 != 0), new


def gone(t, old, new):
    buried = t.part.filter("p_partkey % 7 = 0").select(c("p_partkey").alias("k"))
    return N.missing_keys(old, new, ["k"], buried, "name", "place", "specialty", c("name").like("hot%"), c("place") == "Brand#1")


@query("c32_missing_keys", MISSING + " SELECT k, reason FROM x")
def _(t):
    return gone(t, *snapshots(t))


@query("c32_report", MISSING + """, j AS (SELECT a.k AS ak, b.k AS bk, b.m < a.m AS falls, better FROM a FULL JOIN b ON a.k = b.k) SELECT count(*) FILTER (WHERE ak IS NULL) AS added, count(*) FILTER (WHERE ak = bk) AS retained, count(*) FILTER (WHERE falls AND NOT better) AS floor_retained, count(*) FILTER (WHERE falls AND better) AS upgraded,
  (SELECT count(*) FROM x WHERE reason = 'tombstone') AS tombstone, (SELECT count(*) FROM x WHERE reason = 'excluded') AS excluded, (SELECT count(*) FROM x WHERE reason = 'relocated') AS relocated, (SELECT count(*) FROM x WHERE reason = 'renamed') AS renamed, (SELECT count(*) FROM x WHERE reason = 'revived') AS revived,
  (SELECT count(*) FROM x WHERE reason = 'revived') > 50 AS blocked FROM j""")
def _(t):
    old, new = snapshots(t)
    return N.reconcile_report(old, new, ["k"], "m", gone(t, old, new), 50, "better")


@query("c32_reconcile_years", """WITH y AS (SELECT o_custkey AS k, year(o_orderdate)::INT AS y, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS a, count(*) FILTER (WHERE o_orderkey % 2 = 1) AS b FROM orders GROUP BY ALL),
m AS (SELECT k, sum(a) FILTER (WHERE k % 5 <> 0)::BIGINT AS pa, sum(b) FILTER (WHERE k % 3 <> 0)::BIGINT AS cb, sum(a) AS sa, sum(b) AS sb, string_agg(CASE WHEN greatest(a, b) > 0 THEN y || ':' || greatest(a, b) END, ',' ORDER BY y) AS years FROM y GROUP BY k)
SELECT k, CASE WHEN sa = 0 THEN cb WHEN sb = 0 THEN pa ELSE greatest(pa, cb) END AS n, years, CASE WHEN sb > 0 AND k % 3 <> 0 THEN 'new' WHEN sa > 0 THEN 'old' END AS note, CASE WHEN sb > 0 THEN CASE WHEN sa = 0 THEN 'new' ELSE 'kept' END ELSE 'revived' END AS action FROM m""")
def _(t):
    """Metrics that one side hasn't, counts by year of both sides, and a note carried along."""

    def side(odd: int, known: int, note: str):
        by = t.orders.filter(c("o_orderkey") % 2 == odd).groupBy(c("o_custkey").alias("k"), F.year("o_orderdate").alias("y")).agg(F.count(lit(1)).alias("m"))
        g = by.groupBy("k").agg(F.sum("m").alias("n"), F.map_from_entries(F.collect_list(F.struct("y", "m"))).alias("years"))
        return g.withColumn("n", F.when(c("k") % known != 0, c("n"))).withColumn("note", F.when(lit(note == "old") | (c("k") % known != 0), lit(note)))

    none = t.orders.select(c("o_custkey").alias("k")).filter(lit(False))
    out = N.reconcile(side(0, 5, "old"), side(1, 3, "new"), ["k"], ["n"], none, 10**9, ["years"], ["note"])
    return out.withColumn("years", F.array_join(F.transform(F.array_sort(F.map_entries("years")), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))), ","))


@query("g06_map_max", "WITH y AS (SELECT o_custkey, year(o_orderdate)::INT AS y, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS a, count(*) FILTER (WHERE o_orderkey % 2 = 1) AS b FROM orders GROUP BY ALL) SELECT o_custkey, string_agg(y || ':' || greatest(a, b), ',' ORDER BY y) AS years FROM y GROUP BY o_custkey")
def _(t):
    years = lambda d, n: d.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count(lit(1)).alias("k")).groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("y", "k"))).alias(n))
    j = years(t.orders.filter("o_orderkey % 2 = 0"), "a").join(years(t.orders.filter("o_orderkey % 2 = 1"), "b"), "o_custkey", "full")
    both = N.map_max(c("a"), c("b"))
    return j.select("o_custkey", F.array_join(F.transform(F.array_sort(F.map_entries(both)), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))), ",").alias("years"))


@query("c33_upsert_items", "WITH a AS (SELECT p_name AS item, count(*) AS n, list_distinct(list(p_type)) AS s FROM part WHERE p_partkey % 2 = 0 GROUP BY 1), b AS (SELECT p_name AS item, count(*) AS n, list_distinct(list(p_type)) AS s FROM part WHERE p_partkey % 5 = 0 GROUP BY 1) SELECT item, coalesce(a.n, b.n) AS n, array_to_string(list_sort(list_distinct(list_concat(coalesce(a.s, []), coalesce(b.s, [])))), '|') AS sources FROM a FULL JOIN b USING (item)")
def _(t):
    part = lambda k: t.part.filter(f"p_partkey % {k} = 0").groupBy(c("p_name").alias("item")).agg(F.count(lit(1)).alias("n"), F.collect_set("p_type").alias("sources"), F.array_sort(F.collect_set("p_brand")).alias("examples"))
    return N.upsert_items(part(2), part(5), ["item"], 10).select("item", "n", arrayed("sources").alias("sources"))


@query("c34_strip_merged", "SELECT p_partkey FROM part WHERE p_type <> 'PROMO'")
def _(t):
    rows = t.part.select("p_partkey", F.array("p_type", F.when(c("p_type") != "PROMO", lit("base"))).alias("sources"))
    return P.strip_merged(rows, "sources", ["PROMO"]).select("p_partkey")


@query("c35_reviewed_strategy", "WITH d AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'approved' ELSE 'rejected' END AS decision FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations) WHERE k = 1), p AS (SELECT conv_id, turn, text AS reviewed FROM conversations) SELECT i.conv_id AS id, CASE WHEN d.decision = 'approved' THEN p.reviewed ELSE 'own' END AS shown, CASE WHEN d.decision = 'approved' THEN 'reviewed' ELSE 'template' END AS source FROM (SELECT DISTINCT conv_id FROM conversations) i JOIN d USING (conv_id) JOIN p ON p.conv_id = d.conv_id AND p.turn = d.turn")
def _(t):
    v = t.conversations
    decisions = v.select(c("conv_id").alias("id"), c("turn").alias("at"), c("turn").alias("proposal"), F.when(c("role") == "assistant", "approved").otherwise("rejected").alias("decision"))
    proposals = v.select(c("conv_id").alias("id"), c("turn").alias("version"), "text")
    items = v.select(c("conv_id").alias("id")).distinct().withColumn("text", lit("own"))
    return N.reviewed_overlay(items, proposals, decisions).select("id", "shown", "source")


@query("e07_latest_per_id", "SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations) WHERE k = 1")
def _(t):
    return N.latest_per_key(t.conversations, ["conv_id"], [F.desc("turn")]).select("conv_id", "turn", "role")


@query("b34_manual_reviews", "SELECT p_partkey AS idx, CASE WHEN p_size % 2 = 0 AND p_partkey % 3 = 0 THEN 'ok' WHEN p_size % 2 = 0 AND p_partkey % 3 = 1 THEN 'excluded' WHEN p_size % 2 = 0 THEN 'review_required' ELSE 'ok' END AS status, CASE WHEN p_size % 2 = 0 AND p_partkey % 3 = 0 THEN p_type END AS notice FROM part")
def _(t):
    rows = t.part.select(c("p_partkey").alias("idx"), F.when(c("p_size") % 2 == 0, "review_required").otherwise("ok").alias("status"), F.array("p_name", "p_type").alias("candidates"))
    reviews = t.part.select(c("p_partkey").alias("idx"), F.when(c("p_partkey") % 3 == 0, "approve").when(c("p_partkey") % 3 == 1, "exclude").otherwise("keep").alias("decision"), lit(1).alias("choice"))
    return N.manual_reviews(rows, reviews, "candidates")


@query("b34_review_violations", "SELECT 'twice' AS issue, p_partkey AS idx FROM part WHERE p_partkey % 40 = 0 UNION ALL SELECT 'not_pending', p_partkey FROM part WHERE p_size % 2 = 1 AND p_partkey % 20 = 0 UNION ALL SELECT 'no_reviewer', p_partkey FROM part WHERE p_partkey % 60 = 0")
def _(t):
    rows = t.part.select(c("p_partkey").alias("idx"), F.when(c("p_size") % 2 == 0, "review_required").otherwise("ok").alias("status"))
    r = t.part.filter("p_partkey % 20 = 0").select(c("p_partkey").alias("idx"), F.when(c("p_partkey") % 60 != 0, "x").alias("reviewer"))
    return N.review_violations(rows, r.union(r.filter("idx % 40 = 0")))


def states(t, k):
    return t.lineitem.filter(f"l_partkey % 11 <> {k}").groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("addresses"), F.collect_list(F.when(c("l_linenumber") <= 3 + k, c("l_linestatus"))).alias("goods"), F.collect_list("l_linenumber").alias("history"))


STATE = "SELECT l_orderkey, list_sort(list_distinct(list(l_returnflag))) AS a, list_sort(list_distinct(list(CASE WHEN l_linenumber <= {m} THEN l_linestatus END))) AS g, count(l_linenumber) AS n FROM lineitem WHERE l_partkey % 11 <> {k} GROUP BY 1"


@query("c36_registry_diff", "WITH b AS (" + STATE.format(k=1, m=4) + "), a AS (" + STATE.format(k=2, m=5) + ") SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, CASE WHEN b.n IS NULL THEN 'added' WHEN a.n IS NULL THEN 'removed' WHEN list_filter_null(a.a) <> list_filter_null(b.a) THEN 'address' WHEN list_filter_null(a.g) <> list_filter_null(b.g) THEN 'goods' WHEN a.n > b.n THEN 'history' ELSE 'unchanged' END AS change FROM b FULL JOIN a ON a.l_orderkey = b.l_orderkey".replace("list_filter_null(a.a)", "coalesce(a.a, [])").replace("list_filter_null(b.a)", "coalesce(b.a, [])").replace("list_filter_null(a.g)", "coalesce(a.g, [])").replace("list_filter_null(b.g)", "coalesce(b.g, [])"))
def _(t):
    return E.registry_diff(states(t, 1), states(t, 2), "l_orderkey")


@query("g05_set_equality", "SELECT l_orderkey, list_sort(list_distinct(list(l_returnflag))) = list_sort(list_distinct(list(l_linestatus))) AS same FROM lineitem GROUP BY 1")
def _(t):
    g = t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("a"), F.collect_list("l_linestatus").alias("b"))
    return g.select("l_orderkey", (V.normal_set(c("a")) == V.normal_set(c("b"))).alias("same"))


@query("c36_table_difference", """WITH b AS (SELECT o_orderkey AS k, o_custkey AS v, o_orderstatus AS s FROM orders WHERE o_orderkey % 211 <> 1), a AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 211 = 5 THEN -1 ELSE o_custkey END AS v, CASE WHEN o_orderkey % 211 = 9 THEN NULL ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 211 <> 3)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'added' WHEN a.k IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.v IS DISTINCT FROM b.v OR a.s IS DISTINCT FROM b.s""")
def _(t):
    """Orders against orders of which a few are gone, new or changed."""
    k = c("o_orderkey") % 211
    rows = lambda df, v, s: df.select(c("o_orderkey").alias("k"), v.alias("v"), s.alias("s"))
    before = rows(t.orders.filter(k != 1), c("o_custkey"), c("o_orderstatus"))
    after = rows(t.orders.filter(k != 3), F.when(k == 5, lit(-1)).otherwise(c("o_custkey")), F.when(k != 9, c("o_orderstatus")))
    return N.table_difference(before, after, ["k"], 64)


@query("c37_merge_improved", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL OR coalesce(b.s > a.s, false) THEN b.s ELSE a.s END AS s, a.k IS NULL OR coalesce(b.s > a.s, false) AS replaced FROM (SELECT p_partkey AS k, p_size AS s FROM part WHERE p_partkey % 3 <> 0) a FULL JOIN (SELECT p_partkey AS k, (p_partkey % 50)::INT AS s FROM part WHERE p_partkey % 2 = 0) b ON a.k = b.k")
def _(t):
    old = t.part.filter("p_partkey % 3 <> 0").select(c("p_partkey").alias("k"), c("p_size").alias("s"))
    new = t.part.filter("p_partkey % 2 = 0").select(c("p_partkey").alias("k"), (c("p_partkey") % 50).cast("int").alias("s"))
    return E.merge_improved(old, new, "k", c("new_s") > c("s"))


@query("c38_merge_hits", "WITH u AS (SELECT l_partkey, l_orderkey, 0 AS fresh, l_returnflag AS s FROM lineitem WHERE l_linenumber <= 4 UNION ALL SELECT l_partkey, l_orderkey, 1, l_returnflag FROM lineitem WHERE l_linenumber >= 4), o AS (SELECT l_partkey, l_orderkey, min(fresh) AS fresh, max(s) AS status FROM u GROUP BY ALL) SELECT l_partkey, l_orderkey, status, pos FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY fresh, l_orderkey)::INT AS pos FROM o) WHERE pos <= 20")
def _(t):
    pick = lambda w: t.lineitem.filter(w).select("l_partkey", "l_orderkey", c("l_returnflag").alias("status"))
    return E.merge_hits(pick("l_linenumber <= 4"), pick("l_linenumber >= 4"), ["l_partkey"], "l_orderkey", c("status"), 20).select("l_partkey", "l_orderkey", "status", "pos")


@query("d23_region_merge", "SELECT r_name, count(*) AS n, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS sources, CASE WHEN bool_or(c_acctbal < -900) THEN 'blocked' WHEN bool_or(c_acctbal < 0) THEN 'partial' ELSE 'available' END AS worst FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def _(t):
    rows = t.customer.join(checked_broadcast(masters(t)), c("c_nationkey") == c("code"))
    rank = F.when(c("c_acctbal") < -900, 2).when(c("c_acctbal") < 0, 1).otherwise(0)
    worst = F.max(rank)
    return rows.groupBy(c("province").alias("r_name")).agg(F.count(lit(1)).alias("n"), arrayed(F.array_sort(F.collect_set("c_mktsegment"))).alias("sources"), F.when(worst == 2, "blocked").when(worst == 1, "partial").otherwise("available").alias("worst"))


@query("d28_region_coverage", "WITH " + RECORDS + ", r AS (SELECT province, CASE WHEN app % 6 = 0 THEN 'unverified' ELSE relation END AS rel FROM rec) SELECT province, count(*) AS referenced, count(*) FILTER (WHERE rel = 'inside') AS inside, count(*) FILTER (WHERE rel = 'outside') AS outside, count(*) FILTER (WHERE rel = 'unverified') AS unverified, round(count(*) FILTER (WHERE rel <> 'unverified')::DOUBLE / count(*), 4) AS coverage FROM r GROUP BY province")
def _(t):
    return E.coverage(records(t).withColumn("rel", F.when(c("app") % 6 == 0, "unverified").otherwise(c("relation"))), ["province"], "rel")


@query("d28_coverage_delta", "WITH " + RECORDS + " SELECT province, count(*) FILTER (WHERE relation = 'inside') - count(*) FILTER (WHERE relation = 'inside' AND app % 6 <> 0) AS inside_delta, count(*) FILTER (WHERE relation = 'outside') - count(*) FILTER (WHERE relation = 'outside' AND app % 6 <> 0) AS outside_delta FROM rec GROUP BY province")
def _(t):
    r = records(t)
    before = E.coverage(r.withColumn("rel", F.when(c("app") % 6 == 0, "unverified").otherwise(c("relation"))), ["province"], "rel")
    return E.coverage_delta(before, E.coverage(r, ["province"], "relation"), ["province"], ["inside", "outside"])


@query("d29_goods_coverage", "SELECT p_type, count(*) AS n, count(*) FILTER (WHERE p_size % 3 = 0) AS exact, round(count(*) FILTER (WHERE p_size % 3 <> 2)::DOUBLE / count(*), 4) AS evaluated_rate FROM part GROUP BY p_type")
def _(t):
    return t.part.groupBy("p_type").agg(F.count(lit(1)).alias("n"), F.count_if(c("p_size") % 3 == 0).alias("exact"), V.safe_rate(F.count_if(c("p_size") % 3 != 2), F.count(lit(1))).alias("evaluated_rate"))


@query("d30_reference_summary", "SELECT count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'A') AS inside, count(*) FILTER (WHERE l_returnflag = 'N') AS outside, count(*) FILTER (WHERE l_returnflag = 'R') AS unverified FROM lineitem")
def _(t):
    f = c("l_returnflag")
    return t.lineitem.agg(F.count(lit(1)).alias("total"), F.count_if(f == "A").alias("inside"), F.count_if(f == "N").alias("outside"), F.count_if(f == "R").alias("unverified"))


@query("d31_enrichment_status", "SELECT l_returnflag, count(*) AS requested, count(*) FILTER (WHERE l_orderkey % 3 = 1) AS complete, CASE WHEN count(*) FILTER (WHERE l_orderkey % 3 = 1) = count(*) THEN 'complete' WHEN count(*) FILTER (WHERE l_orderkey % 3 = 2) = count(*) THEN 'error' ELSE 'partial' END AS status FROM lineitem GROUP BY l_returnflag")
def _(t):
    n, ok, bad = F.count(lit(1)), F.count_if(c("l_orderkey") % 3 == 1), F.count_if(c("l_orderkey") % 3 == 2)
    return t.lineitem.groupBy("l_returnflag").agg(n.alias("requested"), ok.alias("complete"), E.rollup_status(ok, n, bad).alias("status"))


@query("d32_enrichment_review", "SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t):
    return t.lineitem.groupBy(c("l_returnflag").alias("a"), c("l_linestatus").alias("b")).agg(F.count(lit(1)).alias("n"))


@query("b30_refresh_category", "WITH g AS (SELECT l_orderkey, list(CASE WHEN s_nationkey % 4 <> 0 THEN s_nationkey END) AS r, bool_or(s_nationkey % 4 = 0) AS f FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1), k AS (SELECT l_orderkey, f, list_filter_out(r) AS known FROM g) SELECT l_orderkey, CASE WHEN len(known) = 0 THEN 'foreign' WHEN list_contains(known, 7) AND len(list_distinct(known)) = 1 THEN 'matched' WHEN list_contains(known, 7) THEN 'ambiguous' ELSE 'unmatched' END AS category FROM k".replace("list_filter_out(r)", "[x FOR x IN r IF x IS NOT NULL]"))
def _(t):
    g = t.lineitem.join(t.supplier, c("l_suppkey") == c("s_suppkey")).groupBy("l_orderkey").agg(F.collect_list("s_nationkey").alias("r"))
    known = F.transform("r", lambda x: F.when(x % 4 != 0, x))
    return g.select("l_orderkey", R.applicant_category(known, F.exists("r", lambda x: x % 4 == 0), lit(7)).alias("category"))


@query("d40_staleness_manifest", "SELECT category, count(*) AS n, category IN ('missing', 'error') AS refresh FROM (SELECT DISTINCT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'missing' WHEN o_orderstatus = 'P' THEN 'error' ELSE 'current' END AS category FROM orders) GROUP BY category")
def _(t):
    s = t.orders.filter("o_orderkey % 3 <> 0").select("o_orderkey", F.when(c("o_orderstatus") == "P", "error").otherwise("current").alias("category"))
    return E.manifest(t.orders, s, "o_orderkey", ["error"])


@query("d41_refresh_manifest", "SELECT category, count(*) AS n, category IN ('missing', 'unmatched') AS refresh FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'missing' WHEN c_nationkey % 2 = 0 THEN 'unmatched' ELSE 'matched' END AS category FROM customer) GROUP BY category")
def _(t):
    s = t.customer.filter("c_custkey % 5 <> 0").select("c_custkey", F.when(c("c_nationkey") % 2 == 0, "unmatched").otherwise("matched").alias("category"))
    return E.manifest(t.customer, s, "c_custkey", ["unmatched"])


@query("d42_combine_documents", "SELECT l_partkey, arg_max(l_suppkey, l_orderkey * 1000000000 + l_linenumber * 100000000 + l_suppkey) AS fact, max(l_returnflag) AS state, count(*) AS n FROM lineitem GROUP BY l_partkey")
def _(t):
    parts = t.lineitem.select("l_partkey", c("l_suppkey").alias("fact"), (c("l_orderkey") * 1000000000 + c("l_linenumber") * 100000000 + c("l_suppkey")).alias("ord"), c("l_returnflag").alias("state"), lit(1).alias("n"))
    return N.combine_documents(parts, "l_partkey", "ord", c("state"), ["n"])


@query("d43_supplemental_summary", "SELECT p_type, count(*) AS n, count(DISTINCT p_name) AS queries FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_size = 1) GROUP BY p_type")
def _(t):
    return P.supplemental_summary(t.part, t.part.filter("p_size = 1"), "p_name", ["p_type"])


@query("d44_high_water", "WITH v AS (SELECT 'orders' AS metric, count(*) AS value, count(*) FILTER (WHERE o_orderstatus <> 'P') AS mark FROM orders UNION ALL SELECT 'lines', count(*), count(*) + count(*) // 100 FROM lineitem UNION ALL SELECT 'customers', count(*), 2 * count(*) FROM customer) SELECT metric, value, mark, CASE WHEN value < mark * 0.98 THEN 'violation' WHEN value < mark THEN 'warning' ELSE 'ok' END AS state, greatest(value, mark) AS next FROM v")
def _(t):
    n = F.count(lit(1)).alias("value")
    m = t.orders.agg(n).select(lit("orders").alias("metric"), "value").union(t.lineitem.agg(n).select(lit("lines"), "value")).union(t.customer.agg(n).select(lit("customers"), "value"))
    k = F.count(lit(1))
    marks = t.orders.agg(F.count_if(c("o_orderstatus") != "P").alias("mark")).select(lit("orders").alias("metric"), "mark").union(t.lineitem.agg((k + F.floor(k / 100)).alias("mark")).select(lit("lines"), "mark")).union(t.customer.agg((k * 2).alias("mark")).select(lit("customers"), "mark"))
    return N.high_water(m, marks, 0.02)


AUDIT = """i AS (SELECT CASE WHEN s_suppkey % 11 <> 0 THEN s_nationkey END AS region_code, CASE WHEN s_nationkey = 3 THEN 'all' ELSE r_name END AS province, n_name AS region, CASE WHEN s_suppkey % 17 = 0 THEN 'same' ELSE s_name END AS item,
  ['confirmed', 'goods', 'review'][s_suppkey % 3 + 1] AS basis, CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS notice, CASE WHEN s_suppkey % 5 <> 0 THEN 1 END AS class, s_suppkey % 13 = 0 AS facility,
  s_suppkey % 19 = 0 AS bad_month, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey END AS value, [NULL, 'available', 'partial', 'blocked'][s_suppkey % 4 % 4 + 1] AS a0, s_suppkey % 2 AS n_examples, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT *, CASE WHEN s_suppkey % 6 = 0 THEN 'available' ELSE a0 END AS availability, province || '/' || region || '/' || item AS key FROM i),
n AS (SELECT count(*) AS items, count(*) FILTER (WHERE province <> 'all') AS regional, count(*) FILTER (WHERE province = 'all') AS nationwide, count(*) FILTER (WHERE province <> 'all' AND availability IN ('available', 'partial')) AS available FROM m)"""


@query("d45_snapshot_audit", "WITH " + AUDIT + """ SELECT 'error' AS severity, 'incomplete_confirmed' AS code, key FROM m WHERE (basis = 'confirmed' AND (notice IS NULL OR class IS NULL)) OR (basis = 'goods' AND notice IS NULL)
UNION ALL SELECT 'error', 'review_with_class', key FROM m WHERE basis = 'review' AND class IS NOT NULL UNION ALL SELECT 'error', 'facility_as_region', key FROM m WHERE facility AND province <> 'all'
UNION ALL SELECT 'error', 'bad_month', key FROM m WHERE bad_month UNION ALL SELECT 'error', 'no_availability', key FROM m WHERE availability IS NULL
UNION ALL SELECT 'error', 'available_without_value', key FROM m WHERE availability = 'available' AND value IS NULL UNION ALL SELECT 'error', 'blocked_with_value', key FROM m WHERE availability = 'blocked' AND value IS NOT NULL
UNION ALL SELECT 'error', 'duplicate_item', key FROM m GROUP BY key HAVING count(*) > 1
UNION ALL SELECT 'error', 'items_count_differs', (items + 1) || '/' || items FROM n UNION ALL SELECT 'error', 'available_count_differs', (available + 2) || '/' || available FROM n
UNION ALL SELECT 'warning', 'review_with_metric', count(*)::VARCHAR FROM m WHERE basis = 'review' AND availability IN ('available', 'partial') HAVING count(*) > 0
UNION ALL SELECT 'warning', 'review_with_examples', count(*)::VARCHAR FROM m WHERE basis = 'review' AND n_examples > 0 HAVING count(*) > 0 UNION ALL SELECT 'warning', 'unresolved_code', count(*)::VARCHAR FROM m WHERE region_code IS NULL HAVING count(*) > 0""")
def _(t):
    k = c("s_suppkey")
    among = lambda n, *values: F.get(F.array(*[lit(v) for v in values]), (k % n).cast("int"))
    items = t.supplier.join(masters(t), c("s_nationkey") == c("code")).select(
        F.when(k % 11 != 0, c("s_nationkey")).alias("region_code"), F.when(c("s_nationkey") == 3, "all").otherwise(c("province")).alias("province"), "region", F.when(k % 17 == 0, "same").otherwise(c("s_name")).alias("item"),
        among(3, "confirmed", "goods", "review").alias("basis"), F.when(k % 7 != 0, c("s_name")).alias("notice"), F.when(k % 5 != 0, lit(1)).alias("class"), F.when(k % 13 == 0, F.array(lit("plant"))).otherwise(F.array(lit("list"))).alias("sources"),
        F.create_map(F.when(k % 19 == 0, "1999-13").otherwise("1999-12"), lit(2)).alias("months"), F.when(k % 4 != 0, k).alias("value"), F.when(k % 6 == 0, "available").otherwise(among(4, None, "available", "partial", "blocked")).alias("availability"), (k % 2).alias("n_examples"),
    )
    real = c("province") != "all"
    reported = items.agg((F.count(lit(1)) + 1).alias("items"), F.count_if(real).alias("regional"), F.count_if(~real).alias("nationwide"), (F.count_if(real & c("availability").isin("available", "partial")) + 2).alias("available"))
    return Q.audit_snapshot(items, reported.unpivot([], reported.columns, "metric", "value"), "plant", "all")


@query("d45_duplicate_keys", "SELECT 'duplicate_key' AS code, l_orderkey || '/' || l_linenumber AS key FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def _(t):
    return N.audit(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], {"never": lit(False)})


@query("d46_recomputed_coverage", "SELECT count(*) AS total, count(*) FILTER (WHERE p_size > 25) AS visible, count(DISTINCT p_name) AS items FROM part")
def _(t):
    return t.part.agg(F.count(lit(1)).alias("total"), F.count_if(c("p_size") > 25).alias("visible"), F.count_distinct("p_name").alias("items"))


@query("d47_pipeline_status", """WITH r AS (SELECT o_custkey AS query, CASE WHEN o_orderkey % 7 = 0 THEN 'skipped' WHEN o_orderstatus = 'F' THEN 'complete' WHEN o_orderstatus = 'O' THEN 'partial' ELSE 'error' END AS state FROM orders),
a AS (SELECT count(*) AS total_rows, count(*) FILTER (WHERE state <> 'skipped') AS searchable_rows, count(*) FILTER (WHERE state = 'complete') AS complete_rows, count(*) FILTER (WHERE state = 'partial') AS partial_rows, count(*) FILTER (WHERE state = 'error') AS error_rows, count(*) FILTER (WHERE state = 'skipped') AS skipped_rows,
 count(DISTINCT query) AS queries, count(DISTINCT CASE WHEN state = 'complete' THEN query END) AS complete_queries, count(DISTINCT CASE WHEN state = 'partial' THEN query END) AS partial_queries FROM r),
i AS (SELECT c_nationkey, count(*) FILTER (WHERE c_custkey % 3 = 0) AS inside, count(*) FILTER (WHERE c_custkey % 3 = 1) AS outside, count(*) FILTER (WHERE c_custkey % 3 = 2) AS unverified FROM customer GROUP BY 1),
b AS (SELECT count(*) FILTER (WHERE c_nationkey % 4 < 2) AS available_items, count(*) FILTER (WHERE c_nationkey % 4 = 1) AS partial_items, count(*) FILTER (WHERE c_nationkey % 4 >= 2) AS blocked_items, sum(inside)::BIGINT AS inside, sum(outside)::BIGINT AS outside, sum(unverified)::BIGINT AS unverified, round(sum(inside + outside)::DOUBLE / sum(inside + outside + unverified), 4) AS verified_rate FROM i)
SELECT *, 'preview' AS policy FROM a, b""")
def _(t):
    state = F.when(c("o_orderkey") % 7 == 0, "skipped").when(c("o_orderstatus") == "F", "complete").when(c("o_orderstatus") == "O", "partial").otherwise("error")
    third = c("c_custkey") % 3
    items = t.customer.groupBy("c_nationkey").agg(F.count_if(third == 0).alias("inside"), F.count_if(third == 1).alias("outside"), F.count_if(third == 2).alias("unverified"))
    items = items.withColumn("availability", F.when(c("c_nationkey") % 4 == 0, "available").when(c("c_nationkey") % 4 == 1, "partial").otherwise("blocked"))
    return Q.run_status(t.orders.select(c("o_custkey").alias("query"), state.alias("state")), items, 0.6)


@query("d48_source_catalog", "SELECT p_name, arg_max(p_brand, p_partkey) FILTER (WHERE p_size % 3 <> 0) AS brand, arg_max(p_type, p_partkey) FILTER (WHERE p_size % 2 = 0) AS kind FROM part GROUP BY p_name")
def _(t):
    parts = t.part.select("p_name", "p_partkey", F.when(c("p_size") % 3 != 0, c("p_brand")).otherwise(" ").alias("brand"), F.when(c("p_size") % 2 == 0, c("p_type")).alias("kind"))
    return N.merge_catalog(parts, "p_name", ["brand", "kind"], "p_partkey")


@query("d49_nested_groups", "WITH n AS (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY ALL) SELECT p_brand, string_agg(p_name || '=' || n, ',' ORDER BY n DESC, p_name) AS items FROM n GROUP BY p_brand")
def _(t):
    g = N.nested_groups(t.part.groupBy("p_brand", "p_name").agg(F.count(lit(1)).alias("n")), "p_brand", "n", "p_name")
    return g.select("p_brand", F.array_join(F.transform("items", lambda x: F.concat_ws("=", x["name"], x["value"].cast("string"))), ",").alias("items"))


@query("d70_review_selection", "SELECT count(*) AS total, count(*) FILTER (WHERE p_size < 5) AS matched, least(count(*) FILTER (WHERE p_size < 5), 100) AS selected, count(*) FILTER (WHERE p_size < 5) > 100 AS truncated FROM part")
def _(t):
    return P.selection_report(t.part, c("p_size") < 5, 100)


DOCUMENT = """a AS (SELECT l_partkey AS id, count(*) AS n, count(DISTINCT l_orderkey) AS d, count(*) FILTER (WHERE l_linestatus = 'F') AS r, bool_or(l_returnflag = 'R' AND l_linenumber > 3) AS bad, bool_or(l_quantity < 2) AS bare FROM lineitem WHERE l_partkey % 9 <> 0 GROUP BY 1),
p AS (SELECT p_partkey AS id, p_brand AS province, p_type AS region, CASE WHEN p_size <> 50 THEN p_name END AS item, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS declared FROM part), j AS (SELECT p.*, coalesce(n, 0) AS n, d, coalesce(r, 0) AS r, bad, bare FROM p LEFT JOIN a USING (id))"""


@query("d71_document_validation", "WITH " + DOCUMENT + """ SELECT 'missing_name' AS code, id::VARCHAR AS key FROM j WHERE item IS NULL UNION ALL SELECT 'no_applications', id::VARCHAR FROM j WHERE n = 0 UNION ALL SELECT 'number_twice', id::VARCHAR FROM j WHERE d < n
UNION ALL SELECT 'bad_method', id::VARCHAR FROM j WHERE bad UNION ALL SELECT 'no_goods', id::VARCHAR FROM j WHERE bare UNION ALL SELECT 'count_differs', id::VARCHAR FROM j WHERE declared <> n UNION ALL SELECT 'registered_differs', id::VARCHAR FROM j WHERE id % 3 = 0 AND r <> 10
UNION ALL SELECT 'row_twice', min(id)::VARCHAR FROM p GROUP BY province, region, item HAVING count(*) > 1""")
def _(t):
    rows = t.part.select(c("p_partkey").alias("id"), c("p_brand").alias("province"), c("p_type").alias("region"), F.when(c("p_size") != 50, c("p_name")).alias("item"), F.when(c("p_partkey") % 2 == 0, c("p_size")).alias("declared"), F.when(c("p_partkey") % 3 == 0, lit(10)).alias("declared_registered"))
    method = F.when((c("l_returnflag") == "R") & (c("l_linenumber") > 3), "other").otherwise("Exact")
    apps = t.lineitem.filter("l_partkey % 9 <> 0").select(c("l_partkey").alias("id"), c("l_orderkey").cast("string").alias("number"), method.alias("method"), F.when(c("l_linestatus") == "F", "registered").otherwise("pending").alias("status"), F.when(c("l_quantity") >= 2, lit(1)).alias("n_goods"))
    return Q.document_violations(rows, apps, ["exact", "contains"])


@query("d71_document_id", """SELECT 'sha256-' || substr(sha256(string_agg(d, '' ORDER BY n_nationkey)), 1, 20) AS id FROM (SELECT n_nationkey, sha256('{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}') AS d FROM nation)""")
def _(t):
    return Q.document_id(t.nation, ["n_name", "n_regionkey"], ["n_nationkey"])


@query("b17_exclude_validation", "SELECT count(*) FILTER (WHERE l_returnflag <> 'R') AS kept, count(*) FILTER (WHERE l_returnflag = 'R') AS excluded FROM lineitem")
def _(t):
    return t.lineitem.agg(F.count_if(c("l_returnflag") != "R").alias("kept"), F.count_if(c("l_returnflag") == "R").alias("excluded"))


@query("b36_validation_rows", "SELECT s_suppkey, n_name AS region, 'reference brand ' || s_name AS reason, true AS validation_only FROM supplier JOIN nation ON s_nationkey = n_nationkey ORDER BY s_suppkey LIMIT 50")
def _(t):
    return t.supplier.join(checked_broadcast(t.nation), c("s_nationkey") == c("n_nationkey")).orderBy("s_suppkey").limit(50).select("s_suppkey", c("n_name").alias("region"), F.concat(lit("reference brand "), "s_name").alias("reason"), lit(True).alias("validation_only"))


@query("f03_review_top", "SELECT p_partkey, p_size FROM part WHERE p_type = 'PROMO' ORDER BY p_size DESC, p_partkey LIMIT 20")
def _(t):
    return t.part.filter("p_type = 'PROMO'").orderBy(F.desc("p_size"), "p_partkey").limit(20).select("p_partkey", "p_size")


@query("f04_candidate_order", "SELECT row_number() OVER (ORDER BY p_size > 40 DESC, p_partkey) AS place, p_partkey FROM part")
def _(t):
    return numbered(t.part.select("p_partkey", "p_size"), [F.desc(c("p_size") > 40), c("p_partkey")], "place").select("place", "p_partkey")


@query("f05_budgeted_selection", "SELECT o_orderkey, true AS cached FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, false FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 ORDER BY o_orderkey LIMIT 500)")
def _(t):
    return E.budgeted(t.orders.select("o_orderkey"), t.orders.filter("o_orderkey % 3 <> 0"), "o_orderkey", ["o_orderkey"], 500)


@query("g01_union_all", "SELECT p_partkey, p_name AS item, false AS derived FROM part UNION ALL SELECT p_partkey, split_part(p_name, ' ', 1), true FROM part WHERE p_size < 10")
def _(t):
    return t.part.select("p_partkey", c("p_name").alias("item"), lit(False).alias("derived")).unionByName(t.part.filter("p_size < 10").select("p_partkey", F.split_part("p_name", lit(" "), lit(1)).alias("item"), lit(True).alias("derived")))


@query("g02_union_distinct", "SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT n_name FROM nation")
def _(t):
    return t.nation.select(c("n_name").alias("name")).union(t.region.select("r_name")).union(t.nation.select("n_name")).distinct()


@query("g03_except", "SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey % 3 = 0")
def _(t):
    return t.nation.select("n_nationkey").join(t.supplier.filter("s_suppkey % 3 = 0").select(c("s_nationkey").alias("n_nationkey")), "n_nationkey", "left_anti").distinct()


@query("g04_distinct_numbers", "SELECT 'app' AS kind, o_orderkey AS number FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) UNION SELECT 'reg', l_suppkey FROM lineitem")
def _(t):
    pairs = F.array(F.struct(lit("app").alias("kind"), c("l_orderkey").alias("number")), F.struct(lit("reg").alias("kind"), c("l_suppkey").alias("number")))
    return t.lineitem.select(F.explode(pairs).alias("p")).select("p.kind", "p.number").distinct()


@query("g07_intersect", "SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer")
def _(t):
    return t.supplier.select("s_nationkey").intersect(t.customer.select("c_nationkey"))


def _archive(t):
    p = t.orders
    h = lambda s: F.sha2(F.concat_ws("|", c("o_orderkey").cast("string"), s), 256)
    v1 = p.filter("o_orderkey % 2 = 0").select(c("o_orderkey").alias("key"), lit(1).alias("version"), h(c("o_orderstatus")).alias("hash"), c("o_orderstatus").alias("payload"))
    v2 = p.filter("o_orderkey % 6 = 0").select(c("o_orderkey").alias("key"), lit(2).alias("version"), h(lit("changed")).alias("hash"), lit("changed").alias("payload"))
    versions = v1.unionByName(v2)
    recs = versions.groupBy("key").agg(F.max_by("hash", "version").alias("hash"), F.max("version").alias("version")).withColumn("last_run", lit("r1"))
    batch = p.filter("o_orderkey % 5 <> 0").select(c("o_orderkey").alias("key"), F.when(c("o_orderkey") % 4 == 0, "third").otherwise(c("o_orderstatus")).alias("payload"))
    batch = batch.withColumn("hash", F.sha2(F.concat_ws("|", c("key").cast("string"), "payload"), 256)).select("key", "hash", "payload")
    return N.archive_upsert(recs, versions, batch, "r2")


ARCHIVE = """WITH s AS (SELECT o_orderkey AS key, o_orderkey % 2 = 0 AS known, CASE WHEN o_orderkey % 6 = 0 THEN 2 ELSE 1 END AS v, o_orderkey % 5 <> 0 AS given, o_orderkey % 4 = 0 AS third FROM orders),
a AS (SELECT key, known, v, CASE WHEN NOT given THEN 'absent' WHEN NOT known THEN 'inserted' WHEN third THEN 'updated' WHEN v = 1 THEN 'unchanged' ELSE 'reverted' END AS action FROM s WHERE known OR given)"""


@query("a19_archive_actions", ARCHIVE + " SELECT action, count(*) AS n FROM a GROUP BY action")
def _(t):
    return _archive(t)[2]


@query("e04_version_numbers", ARCHIVE + " SELECT key, CASE action WHEN 'inserted' THEN 1 WHEN 'updated' THEN v + 1 WHEN 'reverted' THEN 1 ELSE v END AS version FROM a")
def _(t):
    return _archive(t)[0].select("key", "version")


@query("a20_current_view", ARCHIVE + " SELECT key, CASE action WHEN 'inserted' THEN 1 WHEN 'updated' THEN v + 1 WHEN 'reverted' THEN 1 ELSE v END AS version, CASE action WHEN 'updated' THEN 'third' WHEN 'absent' THEN CASE WHEN v = 2 THEN 'changed' ELSE o_orderstatus END WHEN 'inserted' THEN CASE WHEN key % 4 = 0 THEN 'third' ELSE o_orderstatus END ELSE o_orderstatus END AS payload FROM a JOIN orders ON o_orderkey = key")
def _(t):
    recs, versions, _ = _archive(t)
    return N.current_view(recs, versions).select("key", "version", "payload")


def _bucketed(t):
    """The same three batches as ``_archive``, added one after the other to a table in buckets."""
    hashed = lambda df: df.withColumn("hash", F.sha2(F.concat_ws("|", c("key").cast("string"), "payload"), 256))
    key = c("o_orderkey").alias("key")
    first = t.orders.filter("o_orderkey % 2 = 0").select(key, c("o_orderstatus").alias("payload"))
    second = t.orders.filter("o_orderkey % 6 = 0").select(key, lit("changed").alias("payload"))
    third = t.orders.filter("o_orderkey % 5 <> 0").select(key, F.when(c("o_orderkey") % 4 == 0, "third").otherwise(c("o_orderstatus")).alias("payload"))
    archive = BucketedArchive(t.spark, f"archive_{uuid.uuid4().hex}", first.schema["key"])
    return archive, [archive.upsert(hashed(b), i) for i, b in enumerate((first, second, third), 1)]


@query("a19_bucketed_actions", ARCHIVE + " SELECT action, count(*) AS n FROM a WHERE action <> 'absent' GROUP BY action")
def _(t):
    return _bucketed(t)[1][2]


@query("a20_bucketed_view", ARCHIVE + " SELECT key, CASE action WHEN 'inserted' THEN 1 WHEN 'updated' THEN v + 1 WHEN 'reverted' THEN 1 ELSE v END AS version, CASE action WHEN 'updated' THEN 'third' WHEN 'absent' THEN CASE WHEN v = 2 THEN 'changed' ELSE o_orderstatus END WHEN 'inserted' THEN CASE WHEN key % 4 = 0 THEN 'third' ELSE o_orderstatus END ELSE o_orderstatus END AS payload FROM a JOIN orders ON o_orderkey = key")
def _(t):
    return _bucketed(t)[0].current_view()


@query("a21_run_log", "SELECT o_orderpriority AS source, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'P') AS errors, CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') = 0 THEN 'success' WHEN count(*) FILTER (WHERE o_orderstatus = 'P') < count(*) THEN 'partial' ELSE 'failed' END AS status FROM orders GROUP BY 1")
def _(t):
    return P.run_log(t.orders, c("o_orderpriority"), c("o_orderstatus") == "P")


@query("a25_source_metadata", "SELECT p_partkey, r_name AS source_name FROM part LEFT JOIN region ON p_size % 7 = r_regionkey")
def _(t):
    return t.part.withColumn("r_regionkey", c("p_size") % 7).join(checked_broadcast(t.region), "r_regionkey", "left").select("p_partkey", c("r_name").alias("source_name"))


@query("a26_linked_evidence", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 AND p_partkey % 2 = 0 THEN p_name END AS linked, CASE WHEN p_size % 3 = 0 THEN 'alias' WHEN p_size % 3 = 1 AND p_partkey % 2 = 0 THEN 'exact' ELSE 'unmatched' END AS link FROM part")
def _(t):
    p = t.part
    rows = p.select("p_partkey", F.when(c("p_size") % 3 == 0, F.concat(lit("a "), "p_name")).when((c("p_size") % 3 == 1) & (c("p_partkey") % 2 == 0), c("p_name")).otherwise("none").alias("name"))
    aliases = p.select(F.concat(lit("a "), "p_name").alias("name"), c("p_name").alias("target")).distinct()
    return E.link_evidence(rows, aliases, p.select(c("p_name").alias("name"))).select("p_partkey", "linked", "link")
