"""Queries of the trend, leaderboard, cross-tab and expansion operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.functions.values import safe_rate
from terroir.operators import briefing as B
from terroir.operators import insights as I
from terroir.operators import reports as P
from terroir.operators.common import checked_broadcast, numbered, written
from terroir.plans.base import RECORDS, Tables, masters, records

QUERIES, SQL = {}, {}
c, lit = F.col, F.lit
N = lambda: F.count(F.lit(1)).alias("n")


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return keep


def yearly(t):
    return t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).groupBy("c_nationkey", F.year("o_orderdate").alias("y")).agg(N())


YEARLY = "yr AS (SELECT c_nationkey, year(o_orderdate)::INT AS y, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"
MONTH = "month AS (SELECT *, date_trunc('month', o_orderdate)::DATE AS m FROM orders JOIN customer ON o_custkey = c_custkey)"


def monthly(t):
    return t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).withColumn("m", F.trunc("o_orderdate", "month"))


@query("e08_moving_average", "WITH " + YEARLY + ", b AS (SELECT c_nationkey, unnest(range(min(y), max(y) + 1))::INT AS y FROM yr WHERE y <> 1996 GROUP BY 1), d AS (SELECT c_nationkey, y, coalesce(n, 0) AS n FROM b LEFT JOIN (SELECT * FROM yr WHERE y <> 1996) USING (c_nationkey, y)) SELECT c_nationkey, y, n, sum(n) OVER w / (count(*) OVER w)::DOUBLE AS mean FROM d WINDOW w AS (PARTITION BY c_nationkey ORDER BY y ROWS 4 PRECEDING)")
def _(t):
    return I.moving_average(yearly(t).filter("y <> 1996"), ["c_nationkey"], "y", "n")


@query("e09_peak_year", "WITH " + YEARLY + " SELECT c_nationkey, y, n FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, y) AS k FROM yr) WHERE k = 1")
def _(t):
    return I.peak(yearly(t), ["c_nationkey"], "y", "n")


@query("e10_month_windows", "WITH " + MONTH + " SELECT c_nationkey, count(*) FILTER (WHERE m <= DATE '1997-06-01' AND m > DATE '1997-03-01') AS recent, count(*) FILTER (WHERE m <= DATE '1997-03-01' AND m > DATE '1996-12-01') AS prior FROM month GROUP BY 1")
def _(t):
    now, before = I.windows(c("m"), "1997-06-01", 3)
    return monthly(t).groupBy("c_nationkey").agg(F.count_if(now).alias("recent"), F.count_if(before).alias("prior"))


@query("e11_quantile_buckets", "WITH n AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS pl, count(*) OVER () AS total FROM n), b AS (SELECT n AS b FROM r WHERE pl IN (total * 1 // 5, total * 2 // 5, total * 3 // 5, total * 4 // 5)) SELECT l_partkey, n, (SELECT count(*) FROM b WHERE b < n)::INT AS bucket FROM n")
def _(t):
    return I.quantile_buckets(t.lineitem.groupBy("l_partkey").agg(N()), "n")


@query("e12_share_in_group", "SELECT p_brand, p_type, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY p_brand), 4) AS share FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL)")
def _(t):
    return I.shares(t.part.groupBy("p_brand", "p_type").agg(N()), ["p_brand"], "n")


@query("e06_rank_numbers", "SELECT row_number() OVER (ORDER BY n DESC, p_name) AS rank, p_name, n FROM (SELECT p_name, count(*) AS n FROM part GROUP BY 1)")
def _(t):
    g = t.part.groupBy("p_name").agg(N())
    return numbered(g, [F.desc("n"), c("p_name")])


@query("e15_unusual_examples", "WITH f AS (SELECT p_type, p_name, contains(p_name, 'bolt') AS core FROM (SELECT DISTINCT p_type, p_name FROM part) WHERE length(p_name) BETWEEN 7 AND 12), a AS (SELECT p_type, p_name AS representative FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY core DESC, length(p_name), p_name) AS k FROM f) WHERE k = 1), b AS (SELECT p_type, p_name AS unusual FROM (SELECT f.*, row_number() OVER (PARTITION BY p_type ORDER BY core, length(p_name) DESC, p_name) AS k FROM f JOIN a USING (p_type) WHERE p_name <> representative) WHERE k = 1) SELECT * FROM a LEFT JOIN b USING (p_type)")
def _(t):
    return I.unusual_examples(t.part.select("p_type", "p_name").distinct(), ["p_type"], "p_name", F.contains("p_name", lit("bolt")), 7, 12)


@query("e16_change_detection", "SELECT o_custkey, o_orderkey, coalesce(lag(o_orderstatus) OVER w <> o_orderstatus, false) AS changed, row_number() OVER w = 1 AS first_seen FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def _(t):
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.select("o_custkey", "o_orderkey", F.coalesce(F.lag("o_orderstatus").over(w) != c("o_orderstatus"), lit(False)).alias("changed"), (F.row_number().over(w) == 1).alias("first_seen"))


STAGE = "CASE WHEN class BETWEEN 29 AND 33 THEN CASE WHEN kind = 'PROMO' THEN 'processed' ELSE 'raw' END WHEN class >= 35 THEN 'service' ELSE 'excluded' END"


def staged(t):
    return records(t).withColumn("stage", F.expr(STAGE))


@query("d33_stage_counts", "WITH " + RECORDS + f" SELECT item, {STAGE} AS stage, count(*) AS n FROM rec GROUP BY ALL")
def _(t):
    return staged(t).groupBy("item", "stage").agg(N())


@query("d34_stage_registration", "WITH " + RECORDS + f" SELECT {STAGE} AS stage, count(*) FILTER (WHERE status = 'registered') AS registered, round(count(*) FILTER (WHERE status = 'registered')::DOUBLE / count(*), 4) AS rate, sum(date_diff('day', filed, granted))::BIGINT AS days FROM rec GROUP BY 1")
def _(t):
    reg = F.count_if(c("status") == "registered")
    return staged(t).groupBy("stage").agg(reg.alias("registered"), safe_rate(reg, F.count(lit(1))).alias("rate"), F.sum(F.datediff("granted", "filed")).alias("days"))


@query("d35_class_distribution", "WITH " + RECORDS + f", g AS (SELECT {STAGE} AS stage, k AS class, count(*) AS n FROM rec, LATERAL (SELECT unnest([class, class % 7]) AS k) GROUP BY ALL), s AS (SELECT *, round(n::DOUBLE / sum(n) OVER (PARTITION BY stage), 4) AS share, row_number() OVER (PARTITION BY stage ORDER BY n DESC, class)::INT AS rank FROM g) SELECT * FROM s WHERE rank <= 3")
def _(t):
    g = staged(t).select("stage", F.explode(F.array("class", c("class") % 7)).alias("class")).groupBy("stage", "class").agg(N())
    return I.top_shares(g, ["stage"], "class", "n", 3)


@query("d36_top_applicants", "WITH " + RECORDS + f", g AS (SELECT {STAGE} AS stage, applicant, count(*) AS n, min(app) AS sample FROM rec GROUP BY ALL) SELECT stage, applicant, n, sample FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY n DESC, applicant) AS k FROM g) WHERE k <= 5")
def _(t):
    return P.top_per_group(staged(t), ["stage"], "applicant", "app", 5)


@query("d37_top_regions", "WITH " + RECORDS + ", g AS (SELECT item, app_region, count(*) AS n FROM rec GROUP BY ALL), s AS (SELECT *, round(n::DOUBLE / sum(n) OVER (PARTITION BY item), 4) AS share, row_number() OVER (PARTITION BY item ORDER BY n DESC, app_region)::INT AS rank FROM g) SELECT * FROM s WHERE rank <= 5")
def _(t):
    return I.top_shares(records(t).groupBy("item", "app_region").agg(N()), ["item"], "app_region", "n", 5)


@query("d38_signal_confidence", "WITH " + RECORDS + ", g AS (SELECT item, applicant, count(*) AS n FROM rec GROUP BY ALL), s AS (SELECT item, max(n) AS top, sum(n)::BIGINT AS n FROM g GROUP BY item) SELECT item, n, CASE WHEN top * 20 >= n THEN 'low' WHEN top * 100 >= n THEN 'medium' ELSE 'high' END AS confidence FROM s")
def _(t):
    return P.signal_confidence(records(t), ["item"], "applicant")


@query("d39_flow_terms", "WITH t AS (SELECT DISTINCT trim(x) AS term FROM (SELECT unnest(string_split(CASE WHEN p_size % 2 = 0 THEN p_name || ' (x)/' || split_part(p_name, ' ', 2) ELSE p_name END, '/')) AS y FROM part), LATERAL (SELECT trim(replace(y, ' (x)', '')) AS x) WHERE trim(x) <> '') SELECT DISTINCT CASE WHEN split_part(term, ' ', -1) IN (SELECT term FROM t) THEN split_part(term, ' ', -1) ELSE term END AS term FROM t")
def _(t):
    names = t.part.select(F.when(c("p_size") % 2 == 0, F.concat("p_name", lit(" (x)/"), F.split_part("p_name", lit(" "), lit(2)))).otherwise(c("p_name")).alias("name"))
    return I.flow_terms(names, "name")


@query("d50_specialty_coverage", "SELECT count(*) AS total, count(*) FILTER (WHERE p_size > 10) AS decided, count(*) FILTER (WHERE p_size > 30) AS applied, count(*) FILTER (WHERE p_size <= 10) AS pending, round(count(*) FILTER (WHERE p_size > 30)::DOUBLE / count(*), 4) AS rate FROM part")
def _(t):
    s = c("p_size")
    return t.part.agg(F.count(lit(1)).alias("total"), F.count_if(s > 10).alias("decided"), F.count_if(s > 30).alias("applied"), F.count_if(s <= 10).alias("pending"), safe_rate(F.count_if(s > 30), F.count(lit(1))).alias("rate"))


@query("d51_province_stats", "WITH " + RECORDS + " SELECT province, count(*) AS n, count(*) FILTER (WHERE kind = 'PROMO' AND relation = 'inside') AS official, count(DISTINCT item) AS items FROM rec GROUP BY province")
def _(t):
    return P.province_stats(records(t), ["province"], (c("kind") == "PROMO") & (c("relation") == "inside"), "item")


@query("d52_item_rows", "WITH " + RECORDS + " SELECT item, count(*) FILTER (WHERE kind = 'PROMO') AS confirmed, count(*) FILTER (WHERE status = 'registered') AS registered, count(DISTINCT region) AS regions, count(DISTINCT CASE WHEN relation = 'inside' THEN region END) AS own_regions FROM rec GROUP BY item")
def _(t):
    return records(t).groupBy("item").agg(F.count_if(c("kind") == "PROMO").alias("confirmed"), F.count_if(c("status") == "registered").alias("registered"), F.count_distinct("region").alias("regions"), F.count_distinct(F.when(c("relation") == "inside", c("region"))).alias("own_regions"))


@query("d53_policy_comparison", "WITH " + RECORDS + ", g AS (SELECT province, item, count(*) FILTER (WHERE status = 'registered') AS n FROM rec GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY province ORDER BY n DESC, item) AS k FROM g), f AS (SELECT province, min(item) AS flagship FROM rec WHERE kind = 'PROMO' GROUP BY 1) SELECT province, string_agg(item, '|' ORDER BY k) AS top, any_value(flagship) AS flagship, bool_or(item = flagship) AS flagship_in_top FROM r JOIN f USING (province) WHERE k <= 5 GROUP BY province")
def _(t):
    cells = written(records(t).groupBy("province", "item").agg(F.count_if(c("status") == "registered").alias("n"), F.bool_or(c("kind") == "PROMO").alias("promoted")))
    g = cells.withColumn("k", F.row_number().over(W.partitionBy("province").orderBy(F.desc("n"), "item"))).filter("k <= 5")
    top = g.groupBy("province").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "item"))), lambda x: x["item"]).alias("top"))
    flag = cells.filter("promoted").groupBy("province").agg(F.min("item").alias("flagship"))
    return top.join(flag, "province").select("province", F.array_join("top", "|").alias("top"), "flagship", F.array_contains("top", c("flagship")).alias("flagship_in_top"))


@query("d54_category_stats", "SELECT p_type, coalesce(p_name, 'all') AS p_name, count(*) AS n, count(*) FILTER (WHERE p_size > 25) AS large FROM part GROUP BY GROUPING SETS ((p_type), (p_type, p_name))")
def _(t):
    return P.with_totals(t.part, ["p_type"], "p_name", [N(), F.count_if(c("p_size") > 25).alias("large")])


@query("d55_cross_tab", "SELECT r_name, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS \"BUILDING\", count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS \"MACHINERY\", count(*) AS \"all\" FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name UNION ALL SELECT 'all', count(*) FILTER (WHERE c_mktsegment = 'BUILDING'), count(*) FILTER (WHERE c_mktsegment = 'MACHINERY'), count(*) FROM customer")
def _(t):
    rows = t.customer.join(checked_broadcast(masters(t)), c("c_nationkey") == c("code")).select(c("province").alias("r_name"), "c_mktsegment")
    return I.cross_tab(rows, "r_name", "c_mktsegment", ["BUILDING", "MACHINERY"])


@query("d56_rights_board", "SELECT CASE o_orderstatus WHEN 'F' THEN 'goods' WHEN 'O' THEN 'pending' ELSE 'none' END AS rights, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy(F.when(c("o_orderstatus") == "F", "goods").when(c("o_orderstatus") == "O", "pending").otherwise("none").alias("rights")).agg(N())


@query("d57_share_segments", "WITH g AS (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_name) AS k FROM g) SELECT p_brand, CASE WHEN k <= 4 THEN p_name ELSE 'other' END AS p_name, sum(n)::BIGINT AS n FROM r GROUP BY ALL")
def _(t):
    return I.with_other(t.part.groupBy("p_brand", "p_name").agg(N()), ["p_brand"], "p_name", "n", 4)


@query("d58_year_totals", "WITH " + YEARLY + " SELECT y, sum(n)::BIGINT AS n FROM yr GROUP BY y")
def _(t):
    maps = yearly(t).groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("y", "n"))).alias("years"))
    return maps.select(F.explode("years").alias("y", "k")).groupBy("y").agg(F.sum("k").alias("n"))


BOARD = "WITH " + MONTH + ", g AS (SELECT c_nationkey, count(*) FILTER (WHERE m <= DATE '1997-06-01' AND m > DATE '1997-03-01') AS recent, count(*) FILTER (WHERE m <= DATE '1997-03-01' AND m > DATE '1996-12-01') AS prior FROM month GROUP BY 1), b AS (SELECT *, prior < greatest(1, 10 / 3.0) AS is_new, CASE WHEN prior >= greatest(1, 10 / 3.0) THEN round((recent - prior)::DOUBLE / prior, 4) END AS growth FROM g WHERE recent >= 10)"


@query("leaderboard", BOARD + " SELECT * FROM b")
def _(t):
    return I.leaderboard(monthly(t), ["c_nationkey"], *I.windows(c("m"), "1997-06-01", 3), 10)


@query("d59_surging", BOARD + " SELECT c_nationkey, recent, prior, is_new, growth, row_number() OVER (ORDER BY is_new DESC, growth DESC NULLS FIRST, recent DESC, c_nationkey) AS place FROM b ORDER BY place LIMIT 10")
def _(t):
    return I.surging(I.leaderboard(monthly(t), ["c_nationkey"], *I.windows(c("m"), "1997-06-01", 3), 10), ["c_nationkey"], 10)


SHAPED = "sh AS (SELECT p_type AS class, split_part(p_name, ' ', 2) AS item, replace(p_name, split_part(p_name, ' ', 2), '{item}') AS template FROM part WHERE split_part(p_name, ' ', 2) <> '')"


def shaped(t):
    """Class, item and template of the goods: a part's name is an item's with a word before it."""
    goods = t.part.select(c("p_type").alias("class"), F.split_part("p_name", lit(" "), lit(2)).alias("item"), "p_name")
    return I.templates(goods, "item", "p_name", "{item}").select("class", "item", "template")


@query("d60_expansion_index", "WITH " + SHAPED + """ SELECT 'item' AS via, p_name AS key, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS found, count(DISTINCT p_type)::INT AS n FROM part GROUP BY p_name
UNION ALL SELECT 'class', p_type, string_agg(DISTINCT p_name, '|' ORDER BY p_name), count(DISTINCT p_name)::INT FROM part GROUP BY p_type
UNION ALL SELECT 'category', p_brand || '>' || p_type, string_agg(DISTINCT p_name, '|' ORDER BY p_name), count(DISTINCT p_name)::INT FROM part GROUP BY p_brand, p_type
UNION ALL SELECT 'template', class || '>' || template, string_agg(DISTINCT item, '|' ORDER BY item), count(DISTINCT item)::INT FROM sh GROUP BY class, template""")
def _(t):
    """What an item, a class, a class of a category, and a template of a class lead to."""
    index = lambda via, df, keys, value: I.expansion_index(df, keys, value, "f").select(lit(via).alias("via"), F.concat_ws(">", *keys).alias("key"), F.array_join("f", "|").alias("found"), "n")
    a, b = index("item", t.part, ["p_name"], "p_type"), index("class", t.part, ["p_type"], "p_name")
    return a.unionByName(b).unionByName(index("category", t.part, ["p_brand", "p_type"], "p_name")).unionByName(index("template", shaped(t), ["class", "template"], "item"))


@query("d61_suggestions", "WITH d AS (SELECT DISTINCT p_name AS item, p_type || ' {item}' AS template FROM part), u AS (SELECT template, count(*) AS users FROM d GROUP BY 1 HAVING count(*) >= 2 ORDER BY users DESC, template LIMIT 5) SELECT i.item, template, replace(template, '{item}', i.item) AS goods, users FROM (SELECT DISTINCT item FROM d) i, u WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.item = i.item AND d.template = u.template)")
def _(t):
    d = t.part.select(c("p_name").alias("item"), F.concat("p_type", lit(" {item}")).alias("template"))
    return I.suggestions(d, "item", "template", 2, 5, "{item}")


GAPS = """h AS (SELECT DISTINCT p_brand AS peer, p_name AS item, p_type || ' ' || p_size AS feature FROM part), i AS (SELECT DISTINCT item FROM h), x AS (SELECT feature, count(DISTINCT item) AS users, count(*) AS uses FROM (SELECT p_name AS item, p_type || ' ' || p_size AS feature FROM part) GROUP BY 1),
l AS (SELECT item, feature, users, uses FROM i, x WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.item = i.item AND h.feature = x.feature)),
k AS (SELECT peer, feature, count(*) AS users FROM h GROUP BY ALL HAVING count(*) >= 2)"""


@query("d62_peer_gaps", "WITH " + GAPS + " SELECT peer, item, feature, users FROM (SELECT DISTINCT peer, item FROM h) i JOIN k USING (peer) WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.peer = i.peer AND h.item = i.item AND h.feature = k.feature)")
def _(t):
    return I.peer_gaps(t.part.select(c("p_brand").alias("peer"), c("p_name").alias("item"), F.concat_ws(" ", "p_type", c("p_size").cast("string")).alias("feature")), "item", "peer", "feature", 2)


@query("d62_rare_and_services", "WITH " + GAPS + """, s AS (SELECT p_name AS item, 'SERVICE ' || p_container AS feature FROM (SELECT *, p_size % 7 AS p_container FROM part WHERE p_size >= 35)), sx AS (SELECT feature, count(DISTINCT item) AS users, count(*) AS uses FROM s GROUP BY 1),
sl AS (SELECT i.item, sx.* FROM (SELECT DISTINCT item FROM s) i, sx WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.item = i.item AND s.feature = sx.feature))
SELECT * FROM (SELECT 'rare' AS part, item, feature, users, uses, row_number() OVER (PARTITION BY item ORDER BY users, feature)::INT AS place FROM l UNION ALL SELECT 'service', item, feature, users, uses, row_number() OVER (PARTITION BY item ORDER BY uses DESC, feature)::INT FROM sl) WHERE place <= 5""")
def _(t):
    """The rarest classes that an item lacks, and the services most used by others that it lacks."""
    classes = t.part.select(c("p_name").alias("item"), F.concat_ws(" ", "p_type", c("p_size").cast("string")).alias("feature"))
    services = t.part.filter("p_size >= 35").select(c("p_name").alias("item"), F.concat(lit("SERVICE "), (c("p_size") % 7).cast("string")).alias("feature"))
    part = lambda name, df: df.select(lit(name).alias("part"), "item", "feature", "users", "uses", "place")
    return part("rare", I.lacking(classes, "item", "feature", [c("users"), c("feature")], 5)).unionByName(part("service", I.lacking(services, "item", "feature", [F.desc("uses"), c("feature")], 5)))


@query("d63_value_chain", "WITH k AS (SELECT p_name, CASE WHEN p_size >= 35 THEN 'service' ELSE 'goods' END AS bucket, p_size, count(*) AS k FROM part GROUP BY ALL) SELECT p_name, bucket, sum(k)::BIGINT AS n, string_agg(p_size, ',' ORDER BY p_size) AS classes, (SELECT p_size FROM k o WHERE o.p_name = i.p_name AND o.bucket = i.bucket ORDER BY k DESC, p_size LIMIT 1) AS leader FROM k i GROUP BY p_name, bucket")
def _(t):
    return I.value_chain(t.part, ["p_name"], "p_size").withColumn("classes", F.array_join("classes", ","))


@query("d64_expansion_rules", "WITH g AS (SELECT p_name, count(*) FILTER (WHERE p_size < 20) AS raw, count(*) FILTER (WHERE p_size BETWEEN 20 AND 21) AS processed, count(*) FILTER (WHERE p_size >= 48) AS service, count(*) FILTER (WHERE p_partkey % 2 = 0) AS recent, count(*) FILTER (WHERE p_partkey % 2 = 1) AS prior, max(k)::DOUBLE / count(*) AS top_share FROM (SELECT *, count(*) OVER (PARTITION BY p_name, p_brand) AS k FROM part) GROUP BY 1) SELECT p_name, CASE WHEN x = '' THEN 'balanced' ELSE x END AS rules FROM (SELECT p_name, concat_ws('|', CASE WHEN service = 0 AND raw + processed > 0 THEN 'service_gap' END, CASE WHEN processed = 0 AND raw > 0 THEN 'processed_gap' END, CASE WHEN top_share >= 0.6 THEN 'class_concentration' END, CASE WHEN raw > 0 AND processed > 0 AND service > 0 AND top_share < 0.3 THEN 'cluster_split' END, CASE WHEN recent > prior * 1.5 THEN 'momentum' END) AS x FROM g)")
def _(t):
    s = c("p_size")
    g = t.part.groupBy("p_name").agg(F.count_if(s < 20).alias("raw"), F.count_if(s.between(20, 21)).alias("processed"), F.count_if(s >= 48).alias("service"), F.count_if(c("p_partkey") % 2 == 0).alias("recent"), F.count_if(c("p_partkey") % 2 == 1).alias("prior"))
    top = I.top_class_share(t.part, ["p_name"], "p_brand")
    return g.join(top, "p_name").select("p_name", F.array_join(I.expansion_rules(c("raw"), c("processed"), c("service"), c("top_share"), c("recent"), c("prior")), "|").alias("rules"))


@query("d65_mark_types", "SELECT CASE o_orderkey % 3 WHEN 0 THEN 'mark' WHEN 1 THEN 'service' ELSE 'collective' END AS mark, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    types = F.create_map(lit("40"), lit("mark"), lit("41"), lit("service"), lit("42"), lit("collective"))
    return t.orders.groupBy(types[(c("o_orderkey") % 3 + 40).cast("string")].alias("mark")).agg(N())


@query("d66_reach", "WITH " + RECORDS + " SELECT item, round(count(*) FILTER (WHERE relation = 'inside')::DOUBLE / count(*), 4) AS local_share, round(count(*) FILTER (WHERE relation <> 'inside')::DOUBLE / count(*), 4) AS nationwide_share, count(*) >= 1800 AS capped FROM rec GROUP BY item")
def _(t):
    inside, n = F.count_if(c("relation") == "inside"), F.count(lit(1))
    return records(t).groupBy("item").agg(safe_rate(inside, n).alias("local_share"), safe_rate(F.count_if(c("relation") != "inside"), n).alias("nationwide_share"), (n >= 1800).alias("capped"))


@query("d67_strategy_candidates", "SELECT p_partkey, p_name, p_size > 40 AS has_briefing FROM part WHERE p_size > 40 OR (p_type = 'PROMO' AND p_size < 10)")
def _(t):
    return t.part.filter((c("p_size") > 40) | ((c("p_type") == "PROMO") & (c("p_size") < 10))).select("p_partkey", "p_name", (c("p_size") > 40).alias("has_briefing"))


@query("d68_distinct_specialties", "SELECT count(DISTINCT p_name) AS items, count(DISTINCT p_brand) AS brands, count(*) AS total FROM part")
def _(t):
    return t.part.agg(F.count_distinct("p_name").alias("items"), F.count_distinct("p_brand").alias("brands"), F.count(lit(1)).alias("total"))


@query("f02_gap_order", "WITH g AS (SELECT p_name, count(*) FILTER (WHERE p_size > 25) AS a, count(*) AS n FROM part GROUP BY 1) SELECT row_number() OVER (ORDER BY a::DOUBLE / n DESC, p_name) AS rank, p_name FROM g WHERE n >= 20")
def _(t):
    g = t.part.groupBy("p_name").agg(F.count_if(c("p_size") > 25).alias("a"), N()).filter("n >= 20")
    return numbered(g, [F.desc(c("a") / c("n")), c("p_name")]).select("rank", "p_name")


@query("f07_item_sorts", "WITH g AS (SELECT p_name, count(*) AS n, count(DISTINCT p_brand) AS regions FROM part GROUP BY 1) SELECT row_number() OVER (ORDER BY regions DESC, n DESC, p_name) AS place, p_name FROM g ORDER BY place LIMIT 100")
def _(t):
    o = [F.desc("regions"), F.desc("n"), c("p_name")]
    g = t.part.groupBy("p_name").agg(N(), F.count_distinct("p_brand").alias("regions")).orderBy(*o).limit(100)
    return g.select(F.row_number().over(W.orderBy(*o)).cast("long").alias("place"), "p_name")


@query("f08_ranking_tables", "WITH " + RECORDS + " SELECT region, count(*) AS applications, count(*) FILTER (WHERE status = 'registered') AS registrations FROM rec WHERE region IS NOT NULL GROUP BY region ORDER BY applications DESC, region LIMIT 10")
def _(t):
    g = records(t).filter(c("region").isNotNull()).groupBy("region").agg(F.count(lit(1)).alias("applications"), F.count_if(c("status") == "registered").alias("registrations"))
    return g.orderBy(F.desc("applications"), "region").limit(10)


@query("f10_coverage_sorts", "SELECT p_brand, round(count(*) FILTER (WHERE p_size > 30)::DOUBLE / count(*), 4) AS rate, row_number() OVER (ORDER BY count(*) FILTER (WHERE p_size > 30)::DOUBLE / count(*), p_brand) AS place FROM part GROUP BY p_brand")
def _(t):
    g = t.part.groupBy("p_brand").agg(F.count_if(c("p_size") > 30).alias("a"), N())
    return numbered(g, [c("a") / c("n"), c("p_brand")], "place").select("p_brand", safe_rate(c("a"), c("n")).alias("rate"), "place")


@query("f13_top_provinces", "WITH " + RECORDS + " SELECT province, count(*) AS n FROM rec GROUP BY province ORDER BY n DESC, province LIMIT 10")
def _(t):
    return records(t).groupBy("province").agg(N()).orderBy(F.desc("n"), "province").limit(10)


@query("h18_sentences", """WITH n AS (SELECT n_name, n_nationkey AS k, n_nationkey % 10 / 10.0::DOUBLE AS gap, n_nationkey % 3 = 0 AS low, n_nationkey % 4 <> 0 AS known, n_nationkey % 11 / 10.0::DOUBLE AS local, CASE WHEN n_nationkey % 2 = 0 THEN 0.75::DOUBLE END AS producers FROM nation)
SELECT k AS n_nationkey, concat_ws(' ', n_name || '는 ' || CASE WHEN gap >= 0.7 THEN 'short of filings' WHEN low THEN 'active' ELSE 'well covered' END || ' (' || k || ', ' || round(k / 32.0::DOUBLE * 100)::INT || '%)', CASE WHEN low THEN 'low conversion of ' || k END,
 CASE WHEN NOT known THEN 'shares not verified' WHEN 1 - local >= 0.6 THEN CASE WHEN producers >= 0.5 THEN 'led by producers outside (75%)' ELSE 'led from outside (' || round(local * 100)::INT || '% local)' END WHEN local >= 0.8 THEN 'led locally (' || round(local * 100)::INT || '%)' END) AS text FROM n""")
def _(t):
    k = c("n_nationkey")
    rows = t.nation.select(k, c("n_name").alias("place"), k.alias("n"), (k / 32).alias("rate"), (k % 10 / lit(10.0)).alias("gap"), (k % 3 == 0).alias("low_conversion"), (k % 4 != 0).alias("verified"), (k % 11 / lit(10.0)).alias("local_share"), F.when(k % 2 == 0, 0.75).alias("producer_share"))
    return rows.select("n_nationkey", F.array_join(B.sentences(B.PHRASES), " ").alias("text"))
