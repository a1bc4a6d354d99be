"""Queries of the operators that resolve places and item names."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.functions import text as X
from terroir.operators import items as I
from terroir.operators import regions as G
from terroir.operators import review as V
from terroir.operators.common import checked_broadcast, numbered
from terroir.plans.base import Tables, masters

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return keep


#: Free texts of places: full addresses, some with a code, some former names, some provinces, some unknown.
TEXTS = """txt AS (SELECT CASE c_custkey % 6 WHEN 0 THEN r_name || ' ' || n_name || ' ' || c_name WHEN 1 THEN n_name WHEN 2 THEN 'OLD_' || n_nationkey WHEN 3 THEN r_name WHEN 4 THEN 'in ' || r_name ELSE 'nowhere ' || c_name END AS text,
  CASE WHEN c_custkey % 12 = 5 THEN n_nationkey::VARCHAR END AS code FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
mst AS (SELECT n_nationkey::VARCHAR AS code, n_name AS region, r_name AS province FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def texts(t):
    k = F.col("c_custkey") % 6
    m = masters(t).withColumn("code", F.col("code").cast("string"))
    text = (
        F.when(k == 0, F.concat_ws(" ", "province", "region", "c_name")).when(k == 1, F.col("region")).when(k == 2, F.concat(F.lit("OLD_"), "code")).when(k == 3, F.col("province"))
        .when(k == 4, F.concat(F.lit("in "), "province")).otherwise(F.concat(F.lit("nowhere "), "c_name"))
    )
    rows = t.customer.join(checked_broadcast(m), F.col("c_nationkey").cast("string") == F.col("code")).select(text.alias("text"), F.when(F.col("c_custkey") % 12 == 5, F.col("code")).alias("code"))
    return rows.distinct(), m


def formers(m):
    return m.select(F.concat(F.lit("OLD_"), "code").alias("former"), "region")


def addresses(t):
    return t.customer.join(checked_broadcast(masters(t)), F.col("c_nationkey") == F.col("code")).select("c_custkey", F.concat_ws(" ", "province", "region", "c_name").alias("text")), masters(t)


@query("c01_region_cascade", "WITH " + TEXTS + """, d AS (SELECT DISTINCT text, code FROM txt),
a AS (SELECT text, 0 AS rung, 'code' AS method, region, province FROM d JOIN mst USING (code)
 UNION SELECT text, 1, 'alias', NULL, province FROM d JOIN mst ON text = province
 UNION SELECT text, 2, 'name', region, province FROM (SELECT text, region, province, rank() OVER (PARTITION BY text ORDER BY length(region) DESC) AS k FROM (SELECT DISTINCT text FROM d) JOIN mst ON contains(text, region)) WHERE k = 1
 UNION SELECT text, 3, 'successor', region, province FROM d JOIN mst ON contains(text, 'OLD_' || mst.code)
 UNION SELECT text, 4, 'province', NULL, province FROM (SELECT text, province, count(*) OVER (PARTITION BY text) AS k FROM (SELECT DISTINCT text FROM d) JOIN (SELECT DISTINCT province FROM mst) ON contains(text, province)) WHERE k = 1),
b AS (SELECT *, min(rung) OVER (PARTITION BY text) AS least FROM a), e AS (SELECT * FROM b WHERE rung = least),
n AS (SELECT *, contains(text, province) AS named, bool_or(contains(text, province)) OVER (PARTITION BY text) AS any_named, count(*) OVER (PARTITION BY text) > 1 AS many FROM e),
f AS (SELECT text, min(method) AS method, count(DISTINCT region) AS regions, count(DISTINCT province) AS provinces, min(region) AS r, min(province) AS p FROM n WHERE NOT many OR NOT any_named OR named GROUP BY text)
SELECT text, method, CASE WHEN method IS NULL THEN 'unresolved' WHEN regions = 1 AND provinces = 1 THEN 'resolved' WHEN provinces = 1 THEN 'province_only' ELSE 'ambiguous' END AS status,
  CASE WHEN regions = 1 AND provinces = 1 THEN r END AS region, CASE WHEN provinces = 1 THEN p END AS province, coalesce(regions, 0) AS candidates FROM (SELECT DISTINCT text FROM d) LEFT JOIN f USING (text)""")
def _(t):
    d, m = texts(t)
    one = d.select("text").distinct()
    provinces = m.select(F.col("province").alias("alias"), F.lit(None).cast("string").alias("region"), "province").distinct()
    rungs = [("code", G.by_code(d, m)), ("alias", G.by_alias(one, provinces)), ("name", G.by_longest_name(one, m)), ("successor", G.by_successor(one, formers(m), m)), ("province", G.by_province(one, m))]
    return G.resolve(d, rungs, m)


@query("c01a_code_join", "SELECT c_name AS text, n_name AS region, r_name AS province FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_custkey % 3 <> 2 AND n_nationkey <> 0")
def _(t):
    """Codes of five digits, replaced codes of ten, and codes of no known form; nation 0 stands twice in the master."""
    code = lambda base: F.concat((F.col("code") + base).cast("string"), F.lit("00000"))
    m = masters(t)
    master = m.withColumn("code", code(11000)).unionByName(m.filter("code = 0").select(code(11000).alias("code"), F.lit("twin").alias("region"), "province"))
    short = F.when(F.col("c_custkey") % 3 == 0, (F.col("c_nationkey") + 11000).cast("string")).when(F.col("c_custkey") % 3 == 1, F.concat((F.col("c_nationkey") + 12000).cast("string"), F.lit("00000"))).otherwise("x")
    return G.by_code(t.customer.select(F.col("c_name").alias("text"), short.alias("code")), master, m.select(code(12000).alias("old"), code(11000).alias("new")))


@query("c01b_alias_equality", "WITH " + TEXTS + " SELECT DISTINCT text, province AS region, province FROM txt JOIN mst ON text = province")
def _(t):
    d, m = texts(t)
    return G.by_alias(d.select("text").distinct(), m.select(F.col("province").alias("alias"), F.col("province").alias("region"), "province").distinct())


@query("c01c_longest_match", """WITH a AS (SELECT c_custkey, r.r_name || ' ' || n.n_name || ' ' || c_name AS text FROM customer JOIN nation n ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey),
k AS (SELECT c_custkey, n_name AS region, rank() OVER (PARTITION BY text ORDER BY length(n_name) DESC) AS k FROM a JOIN nation ON contains(text, n_name)) SELECT c_custkey, region FROM k WHERE k = 1""")
def _(t):
    a, m = addresses(t)
    return a.join(G.by_longest_name(a.select("text").distinct(), m), "text").select("c_custkey", "region")


@query("c01d_successor", "WITH " + TEXTS + " SELECT DISTINCT text, region, province FROM (SELECT DISTINCT text FROM txt) JOIN mst ON contains(text, 'OLD_' || code)")
def _(t):
    d, m = texts(t)
    return G.by_successor(d.select("text").distinct(), formers(m), m)


@query("c01e_stem", "WITH m AS (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey), x AS (SELECT 'NATION' AS text UNION SELECT r_name || 'NATION' FROM region), k AS (SELECT text, n_name, r_name, s, rank() OVER (PARTITION BY text ORDER BY length(s) DESC) AS k FROM x JOIN (SELECT n_name, r_name, unnest(['NATION', r_name || 'NATION']) AS s FROM m) ON replace(text, ' ', '') = replace(s, ' ', '')) SELECT text, n_name AS region, r_name AS province FROM k WHERE k = 1")
def _(t):
    m = masters(t)
    x = m.select(F.concat("province", F.lit("NATION")).alias("text")).union(m.select(F.lit("NATION"))).distinct()
    return G.by_stem(x, m, r"_\d+$")


@query("c01f_province", "WITH " + TEXTS + " SELECT text, province FROM (SELECT text, province, count(*) OVER (PARTITION BY text) AS k FROM (SELECT DISTINCT text FROM txt) JOIN (SELECT DISTINCT province FROM mst) ON contains(text, province)) WHERE k = 1")
def _(t):
    d, m = texts(t)
    return G.by_province(d.select("text").distinct(), m).select("text", "province")


@query("c02_province_names", "SELECT c_custkey, r_name AS province FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(t):
    m = masters(t).select(F.col("province").alias("alias"), "province", F.col("province").alias("region")).distinct()
    raw = t.customer.join(masters(t), F.col("c_nationkey") == F.col("code")).select("c_custkey", F.concat(F.lit(" "), "province", F.lit(" ")).alias("text"))
    return raw.join(G.by_alias(raw.select("text").distinct(), m), "text").select("c_custkey", "province")


@query("e02_longest_ties", "WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part), k AS (SELECT p_name, word, rank() OVER (PARTITION BY p_name ORDER BY length(word) DESC) AS k FROM (SELECT DISTINCT p_name FROM part) JOIN w ON contains(p_name, word)) SELECT p_name, word FROM k WHERE k = 1")
def _(t):
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("region")).distinct().withColumn("province", F.lit(""))
    return G.by_longest_name(t.part.select(F.col("p_name").alias("text")).distinct(), words).select(F.col("text").alias("p_name"), F.col("region").alias("word"))


@query("c11_region_relation", """SELECT o_orderkey, CASE WHEN cn.n_regionkey <> sn.n_regionkey THEN 'outside' WHEN c_custkey % 4 <> 0 AND cn.n_name <> sn.n_name THEN 'outside' ELSE 'inside' END AS relation,
 CASE WHEN c_custkey % 4 <> 0 THEN 'region' ELSE 'province' END AS level FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON o_orderkey % 25 = sn.n_nationkey""")
def _(t):
    m = checked_broadcast(masters(t))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(m, F.col("c_nationkey") == F.col("code")).withColumn("ar", F.when(F.col("c_custkey") % 4 != 0, F.col("region"))).withColumnRenamed("province", "ap").drop("code", "region")
    rows = rows.join(m, F.col("o_orderkey") % 25 == F.col("code"))
    return rows.select("o_orderkey", *G.relation(F.col("region"), F.col("province"), F.col("ar"), F.col("ap")))


@query("c15_co_applicants", """WITH r AS (SELECT DISTINCT l_orderkey, s_nationkey, s_nationkey % 5 = 0 AS producer, CASE WHEN s_nationkey % 7 = 6 THEN 'unverified' WHEN s_nationkey = c_nationkey THEN 'inside' ELSE 'outside' END AS rel
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
g AS (SELECT l_orderkey, count(DISTINCT rel) AS k, min(rel) AS one, bool_or(producer AND rel = 'inside') AS pi, bool_or(rel = 'inside') AS ai, bool_or(rel = 'unverified') AS au FROM r GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN k = 1 THEN one WHEN pi THEN 'inside' WHEN l_orderkey % 2 = 1 AND ai THEN 'inside' WHEN NOT au THEN 'outside' ELSE 'unverified' END AS relation FROM g""")
def _(t):
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rel = F.when(F.col("s_nationkey") % 7 == 6, "unverified").when(F.col("s_nationkey") == F.col("c_nationkey"), "inside").otherwise("outside")
    one = rows.select("l_orderkey", F.struct(rel.alias("relation"), (F.col("s_nationkey") % 5 == 0).alias("producer")).alias("a"))
    return one.groupBy("l_orderkey").agg(F.collect_set("a").alias("a")).select("l_orderkey", G.fold_applicants(F.col("a"), F.col("l_orderkey") % 2 == 0).alias("relation"))


@query("c19_stored_or_evidence", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'inside' WHEN o_orderstatus = 'F' THEN 'inside' WHEN o_orderstatus = 'O' THEN 'outside' ELSE 'unverified' END AS relation FROM orders")
def _(t):
    flag = F.when(F.col("o_orderstatus") == "F", "Matched").when(F.col("o_orderstatus") == "O", "mismatch")
    return t.orders.select("o_orderkey", G.stored_or_evidence(F.when(F.col("o_orderkey") % 3 == 0, "inside"), flag).alias("relation"))


@query("c20_reference_fold", "SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) ELSE 'unverified' END AS relation FROM lineitem GROUP BY l_orderkey")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("v")).select("l_orderkey", G.unanimous(F.col("v")).alias("relation"))


@query("c23_code_lookup", "WITH m AS (SELECT region, count(DISTINCT c) AS n, min(c) AS c FROM (SELECT c_mktsegment AS region, c_nationkey AS c FROM customer UNION ALL SELECT c_name, c_nationkey FROM customer) GROUP BY 1) SELECT DISTINCT p_type AS region, NULL::INT AS region_code, 'unresolved' AS code_status FROM part UNION ALL SELECT region, CASE WHEN n = 1 THEN c END, CASE WHEN n = 1 THEN 'resolved' ELSE 'ambiguous' END FROM m")
def _(t):
    m = t.customer.select(F.explode(F.array("c_mktsegment", "c_name")).alias("region"), F.col("c_nationkey").alias("code"))
    names = t.part.select(F.col("p_type").alias("region")).union(m.select("region")).distinct()
    return G.code_lookup(names, m)


DICT = "dic AS (SELECT DISTINCT p_name AS item, p_size AS class FROM part WHERE p_partkey % 3 = 0)"


def dictionary(t):
    return t.part.filter("p_partkey % 3 = 0").select(F.col("p_name").alias("item"), F.col("p_size").alias("class")).distinct()


@query("c03_exact_cascade", """WITH d AS (SELECT DISTINCT p_name || ' ' || p_size AS item, p_type AS class FROM part WHERE p_partkey % 3 = 0), q AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) || ' ' || p_size ELSE split_part(p_name, ' ', 2) || ' ' || p_size END AS name FROM part),
w AS (SELECT DISTINCT name, rung, replace(lower(p || name), ' ', '') AS key FROM q, (VALUES (0, ''), (1, 'green '), (2, 'red ')) v(rung, p)), f AS (SELECT name, rung, item, class FROM w JOIN d ON replace(lower(item), ' ', '') = key),
b AS (SELECT *, min(rung) OVER (PARTITION BY name) AS least FROM f), g AS (SELECT name, min(rung) AS rung, count(*) AS matches, min(item) AS item FROM b WHERE rung = least GROUP BY name)
SELECT p_partkey, name, rung, coalesce(matches, 0) AS matches, CASE WHEN matches = 1 THEN item END AS item FROM q LEFT JOIN g USING (name)""")
def _(t):
    p = t.part
    sized = lambda c: F.concat_ws(" ", c, F.col("p_size").cast("string"))
    d = p.filter("p_partkey % 3 = 0").select(sized(F.col("p_name")).alias("item"), F.col("p_type").alias("class")).distinct()
    q = p.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, sized(F.upper("p_name"))).otherwise(sized(F.split_part("p_name", F.lit(" "), F.lit(2)))).alias("name"))
    return I.exact_cascade(q, d, ["green ", "red "])


@query("c04_approved_alias", "WITH d AS (SELECT p_name AS item, p_size AS class FROM part), a AS (SELECT 'a ' || item AS alias, item AS notice, min(class) AS class FROM d GROUP BY item), k AS (SELECT item, class, count(*) AS n FROM d GROUP BY ALL) SELECT p_partkey, 'a ' || p_name AS name, notice, a.class, CASE WHEN n = 1 THEN 'ok' ELSE 'review_required' END AS status FROM part JOIN a ON notice = p_name JOIN k ON item = notice AND k.class = a.class")
def _(t):
    d = t.part.select(F.col("p_name").alias("item"), F.col("p_size").alias("class"))
    a = d.groupBy("item").agg(F.min("class").alias("class")).select(F.concat(F.lit("a "), "item").alias("alias"), F.col("item").alias("notice"), "class")
    return I.approved_aliases(t.part.select("p_partkey", F.concat(F.lit("a "), "p_name").alias("name")), a, d)


FUZZY = "WITH " + DICT + """, q AS (SELECT DISTINCT substr(p_name, 3) AS query FROM part UNION SELECT 'b' UNION SELECT left(p_name, 1) FROM part), e AS (SELECT item, class FROM dic WHERE class < 35 UNION SELECT 'd', 1),
s AS (SELECT query, item, class, list_distinct([substr(query, i::INT, 2) FOR i IN range(1, greatest(length(query), 2))]) AS qb, list_distinct([substr(item, i::INT, 2) FOR i IN range(1, greatest(length(item), 2))]) AS db FROM q, e),
j AS (SELECT query, item, class, len(list_intersect(qb, db))::DOUBLE / len(list_distinct(list_concat(qb, db))) + CASE WHEN starts_with(query, item) OR starts_with(item, query) OR ends_with(query, item) OR ends_with(item, query) THEN 0.5::DOUBLE ELSE 0 END AS score FROM s)
SELECT * FROM (SELECT query, item, class, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, item, class)::INT AS pos FROM j WHERE score > 0) WHERE pos <= 5"""


def fuzzy(t):
    name = F.col("p_name")
    q = t.part.select(F.expr("substr(p_name, 3)").alias("query")).union(t.part.select(F.left(name, F.lit(1)))).union(t.part.limit(1).select(F.lit("b"))).distinct()
    d = dictionary(t).union(t.part.limit(1).select(F.lit("d"), F.lit(1)))
    return I.fuzzy_candidates(q, d, 5)


@query("c05_bigram_topk", FUZZY)
def _(t):
    return fuzzy(t)


@query("e03_topk_per_query", FUZZY.replace("pos <= 5", "pos <= 2"))
def _(t):
    return fuzzy(t).filter("pos <= 2")


@query("c06_processed_derivative", "WITH c AS (" + FUZZY + """), s AS (SELECT query, item, pos, suffix, left(item, length(item) - length(suffix)) AS stem FROM c, (VALUES (' anvil'), (' widget')) v(suffix) WHERE ends_with(item, suffix) AND item <> suffix),
k AS (SELECT *, CASE WHEN stem = query THEN 0 WHEN ends_with(stem, query) OR ends_with(query, stem) THEN 1 END AS kind FROM s)
SELECT query, item, suffix, stem, kind FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY kind, pos, suffix) AS n FROM k WHERE kind IS NOT NULL) WHERE n = 1""")
def _(t):
    return I.processed_derivative(fuzzy(t), [" anvil", " widget"])


@query("c07_catalog_reference", """WITH n AS (SELECT DISTINCT p_name AS name, replace(p_name, ' ', '') AS k FROM part), c AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS name FROM part UNION SELECT p_name FROM part WHERE p_partkey % 50 = 0),
f AS (SELECT n.name, k, c.name AS entry, replace(c.name, ' ', '') AS ending FROM n JOIN c ON ends_with(k, replace(c.name, ' ', '')) WHERE length(replace(c.name, ' ', '')) >= 2)
SELECT name, entry, CASE WHEN ending = k THEN 'exact' ELSE 'suffix' END AS match_type FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY length(ending) DESC, entry DESC) AS r FROM f) WHERE r = 1""")
def _(t):
    c = t.part.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("name")).union(t.part.filter("p_partkey % 50 = 0").select("p_name")).distinct()
    return I.catalog_reference(t.part.select(F.col("p_name").alias("name")), c)


@query("c08_derived_rows", """WITH r AS (SELECT DISTINCT n_name AS region, p_name AS item, min(l_orderkey) AS first FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2),
x AS (SELECT region, first, item, list_max([length(s) FOR s IN [' ' || 'ring', 'ng', ' bolt'] IF ends_with(item, s)]) AS n FROM r), k AS (SELECT region, left(item, (length(item) - n)::INT) AS base, right(item, n::INT) AS suffix, first FROM x WHERE n IS NOT NULL AND n < length(item)),
b AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS item FROM part)
SELECT region, base, suffix, first FROM (SELECT *, row_number() OVER (PARTITION BY region, base ORDER BY first) AS k FROM k WHERE base IN (SELECT item FROM b) AND NOT EXISTS (SELECT 1 FROM r WHERE r.region = k.region AND r.item = k.base)) WHERE k = 1""")
def _(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(checked_broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.groupBy(F.col("n_name").alias("region"), F.col("p_name").alias("item")).agg(F.min("l_orderkey").alias("first"))
    bases = t.part.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("item"))
    return I.derived_rows(rows, bases, [" ring", "ng", " bolt"], ["nothing"], "first")


@query("c09_alias_sets", "WITH s AS (SELECT p_type AS notice, array_to_string(list_sort(list_distinct(list(p_brand))), '|') AS related, array_to_string(list_sort(list_distinct(list(p_size))), '|') AS classes FROM part WHERE p_size < 10 GROUP BY p_type) SELECT p_partkey, notice, related, classes FROM (SELECT p_partkey, p_type AS notice FROM part) LEFT JOIN s USING (notice)")
def _(t):
    related = t.part.filter("p_size < 10").select(F.col("p_type").alias("notice"), F.col("p_brand").alias("related"), F.col("p_size").alias("class"))
    sets = I.alias_sets(t.part.select("p_partkey", F.col("p_type").alias("notice")), related)
    return sets.select("p_partkey", "notice", F.array_join("related", "|").alias("related"), F.array_join(F.col("classes").cast("array<string>"), "|").alias("classes"))


@query("b12_lean_hits", "SELECT l_partkey, l_orderkey, l_linenumber, pos, 10 AS cap, collected FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate)::INT AS pos, count(*) OVER (PARTITION BY l_partkey) AS collected FROM lineitem) WHERE pos <= 10")
def _(t):
    w = W.partitionBy("l_partkey")
    lean = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    rows = lean.withColumn("pos", F.row_number().over(w.orderBy("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"))).withColumn("collected", F.count(F.lit(1)).over(w)).filter("pos <= 10")
    return rows.select("l_partkey", "l_orderkey", "l_linenumber", "pos", F.lit(10).alias("cap"), "collected")


@query("d27_verdict_report", "WITH v AS (SELECT CASE WHEN p_size > 40 THEN 'excluded' WHEN p_type = 'PROMO' THEN 'catalog' WHEN p_size % 4 = 0 THEN 'exact' ELSE 'no_exact' END AS verdict_source FROM part) SELECT verdict_source, count(*) AS n FROM v GROUP BY 1")
def _(t):
    none = F.lit(None).cast("string")
    v = I.normalize_verdict(F.col("p_size") > 40, F.col("p_type") == "PROMO", none, F.when(F.col("p_size") % 4 == 0, 1).otherwise(0), none, none, F.lit(3))
    return t.part.select(*v).groupBy("verdict_source").agg(F.count(F.lit(1)).alias("n"))


CLUSTERS = """r AS (SELECT p_partkey AS idx, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS name, p_type AS reason, p_partkey % 5 AS region, p_brand AS source, replace(p_name, ' ', '') AS cluster,
  CASE p_partkey % 3 WHEN 0 THEN [{'i': p_type, 's': p_size / 64.0::DOUBLE}] WHEN 1 THEN [{'i': p_type, 's': 0.5::DOUBLE}, {'i': p_type, 's': 0.25::DOUBLE}, {'i': 'other', 's': 0.125::DOUBLE}] ELSE [] END AS c FROM part),
g AS (SELECT cluster, count(*) AS n_rows, count(DISTINCT region) AS regions, count(DISTINCT source) AS sources FROM r GROUP BY 1),
v AS (SELECT cluster, string_agg(name || ':' || n, ' | ' ORDER BY n DESC, length(name), name) AS variants FROM (SELECT cluster, name, count(*) AS n FROM r GROUP BY ALL) GROUP BY 1),
h AS (SELECT cluster, string_agg(reason || ':' || n, ' | ' ORDER BY n DESC, reason) AS reasons FROM (SELECT cluster, reason, count(*) AS n FROM r GROUP BY ALL) GROUP BY 1),
x AS (SELECT cluster, string_agg(idx, ',' ORDER BY idx) AS examples FROM (SELECT cluster, idx, row_number() OVER (PARTITION BY cluster ORDER BY idx) AS k FROM r) WHERE k <= 3 GROUP BY 1),
e AS (SELECT cluster, idx, u.c.i AS item, u.c.s AS score FROM r, LATERAL (SELECT unnest(r.c) AS c) u),
o AS (SELECT cluster, item, count(DISTINCT idx) AS n, round(sum(score) / count(*), 4) AS score FROM e GROUP BY ALL),
q AS (SELECT o.*, round(n::DOUBLE / n_rows, 4) AS coverage, n = n_rows AS whole, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, score DESC, item) AS k FROM o JOIN g USING (cluster)),
t AS (SELECT cluster, string_agg(item || ':' || n, ' | ' ORDER BY k) AS options, max(coverage) FILTER (WHERE k = 1) AS coverage, max(score) FILTER (WHERE k = 1) AS score, bool_or(whole) FILTER (WHERE k = 1) AS whole FROM q WHERE k <= 5 GROUP BY 1)"""


@query("d26_review_clusters", "WITH " + CLUSTERS + """ SELECT cluster, n_rows, regions, sources, variants, reasons, examples, options, coverage, score,
CASE WHEN options IS NULL THEN 'none' WHEN whole THEN 'in_all_rows' ELSE 'mixed' END AS state FROM g JOIN v USING (cluster) JOIN h USING (cluster) JOIN x USING (cluster) LEFT JOIN t USING (cluster)""")
def _(t):
    k = F.col("p_partkey") % 3
    candidate = lambda item, score: F.struct(item.alias("item"), F.lit("1").alias("class"), score.alias("score"))
    one, two = F.array(candidate(F.col("p_type"), F.col("p_size") / 64)), F.array(candidate(F.col("p_type"), F.lit(0.5)), candidate(F.col("p_type"), F.lit(0.25)), candidate(F.lit("other"), F.lit(0.125)))
    rows = t.part.select(
        F.col("p_partkey").alias("idx"), F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"), F.col("p_type").alias("reason"), (F.col("p_partkey") % 5).alias("region"),
        F.col("p_brand").alias("source"), F.when(k == 0, one).when(k == 1, two).otherwise(F.slice(two, 1, 0)).alias("candidates"),
    )
    listed = lambda c, name: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x[name], x["rows" if name == "item" else "n"].cast("string"))), " | ")
    first = F.col("options")[0]
    return V.review_clusters(rows).select("cluster", "n_rows", "regions", "sources", listed("variants", "value").alias("variants"), listed("reasons", "value").alias("reasons"), F.array_join("examples", ",").alias("examples"),
                                          listed("options", "item").alias("options"), first["coverage"].alias("coverage"), first["score"].alias("score"), "state")


@query("b37_cluster_text", "WITH h AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL) SELECT p_brand, string_agg(p_type || ':' || n, ' | ' ORDER BY p_type) AS kinds FROM h GROUP BY p_brand")
def _(t):
    h = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n")).groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_type", "n"))).alias("h"))
    return h.select("p_brand", F.array_join(F.transform("h", lambda x: F.concat_ws(":", x["p_type"], x["n"].cast("string"))), " | ").alias("kinds"))


@query("f12_variant_order", "SELECT p_name, row_number() OVER (ORDER BY count(*) DESC, length(p_name), length(p_name) - length(replace(p_name, ' ', '')), p_name) AS place FROM part GROUP BY p_name")
def _(t):
    g = t.part.groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.length("p_name"), F.length("p_name") - F.length(F.replace("p_name", F.lit(" "), F.lit(""))), F.col("p_name")]
    return numbered(g, order, "place").select("p_name", "place")
