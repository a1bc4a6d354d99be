"""Queries of the sources and sinks: tables are written and scanned back, or landed documents are made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from terroir.plans.base import Tables, masters
from terroir.sources import files as S

QUERIES, SQL = {}, {}
c, lit = F.col, F.lit


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return keep


@query("a01_scan_csv", "SELECT p_partkey::VARCHAR AS p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name || ', \"' || p_type || '\"' ELSE '' END AS label FROM part")
def _(t):
    path = S.scratch(t.spark, "csv")
    rows = t.part.withColumn("label", F.when(c("p_size") % 2 == 0, F.concat("p_name", lit(', "'), "p_type", lit('"'))))
    S.write_csv(rows, path, ["p_partkey", "label"])
    return S.scan_csv(t.spark, path, ["p_partkey", "label"])


@query("a15_write_csv", "SELECT s_suppkey::VARCHAR AS s_suppkey, s_name FROM supplier")
def _(t):
    path = S.scratch(t.spark, "csv")
    S.write_csv(t.supplier, path, ["s_suppkey", "s_name"], bom=False)
    return S.scan_csv(t.spark, path, ["s_suppkey"])


@query("a02_dictionary", "SELECT DISTINCT p_name AS item, lpad(p_size::VARCHAR, 2, '0') AS class FROM part WHERE p_size % 9 <> 0")
def _(t):
    path = S.scratch(t.spark, "csv")
    S.write_csv(t.part.select(F.concat(lit(" "), "p_name").alias("name"), F.when(c("p_size") % 9 != 0, F.lpad(c("p_size").cast("string"), 2, "0")).alias("code")).distinct(), path, ["name", "code"])
    return S.scan_dictionary(t.spark, path, {"name": "item", "code": "class"})


@query("a03_region_master", "SELECT n_nationkey::VARCHAR AS code, r_name AS province, n_name AS region, 'region' AS level FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT (r_regionkey + 100)::VARCHAR, r_name, '', 'province' FROM region")
def _(t):
    path = S.scratch(t.spark, "csv")
    m = masters(t).select(c("code").cast("string").alias("code"), "province", "region", lit("").alias("town"), lit("").alias("village"))
    p = t.region.select((c("r_regionkey") + 100).cast("string"), "r_name", lit(""), lit(""), lit(""))
    S.write_csv(m.union(p).union(m.withColumn("town", lit("x"))), path, m.columns)
    return S.scan_region_master(t.spark, path)


@query("a04_match_document", "SELECT l_partkey::VARCHAR AS query_key, count(*) AS hits, min(l_orderkey)::VARCHAR AS first_number FROM lineitem GROUP BY 1")
def _(t):
    path = S.scratch(t.spark, "json")
    hit = F.struct(c("l_orderkey").cast("string").alias("number"), c("l_returnflag").alias("status"))
    facts = t.lineitem.groupBy(c("l_partkey").cast("string").alias("query_key")).agg(F.collect_list(hit).alias("hits"))
    half = c("query_key").cast("long") % 2 == 0
    inline = facts.filter(half).select(F.array(F.struct(c("query_key").cast("long").alias("idx"), "query_key", "hits")).alias("results"))
    keyed = facts.filter(~half).select(F.create_map("query_key", F.struct("hits")).alias("queryFacts"), F.array(F.struct(c("query_key").cast("long").alias("idx"), "query_key")).alias("results"))
    inline.write.json(f"{path}/a")
    keyed.write.json(f"{path}/b")
    both = [S.scan_match_document(t.spark, f"{path}/{x}", multi_line=False) for x in ("a", "b")]
    return both[0][1].unionByName(both[1][1]).groupBy("query_key").agg(F.count(lit(1)).alias("hits"), F.min(c("number").cast("long")).cast("string").alias("first_number"))


@query("a05_xml_items", "SELECT s_suppkey::VARCHAR AS code, s_name AS name FROM supplier")
def _(t):
    path = S.scratch(t.spark, "xml")
    t.supplier.select(c("s_suppkey").cast("string").alias("id"), c("s_name").alias("title")).write.format("xml").options(rowTag="item", rootTag="response").save(path)
    return S.scan_xml_items(t.spark, path, "item", {"id": "code", "title": "name"})


@query("a06_xml_goods", "SELECT p_partkey, p_size::VARCHAR AS class_code, p_name AS goods FROM part UNION ALL SELECT p_partkey, '99', p_type FROM part")
def _(t):
    one = lambda k, v: F.concat(lit("<asignProduct><classCode>"), k, lit("</classCode><name>"), v, lit("</name></asignProduct>"))
    pages = t.part.select("p_partkey", F.concat(lit("<item>"), one(c("p_size").cast("string"), c("p_name")), one(lit("99"), c("p_type")), lit("</item>")).alias("x"))
    return S.xml_goods(pages, "x").select("p_partkey", "class_code", "goods")


@query("a07_registry_json", "SELECT c_custkey, c_custkey::VARCHAR AS number, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS applicants, c_name AS first_name FROM customer")
def _(t):
    a = F.struct(c("c_name").alias("name"), c("c_mktsegment").alias("address"))
    one, two = F.to_json(F.struct(c("c_custkey").cast("string").alias("number"), a.alias("applicant"))), F.to_json(F.struct(c("c_custkey").cast("string").alias("number"), F.array(a, a).alias("applicant")))
    rows = S.scan_registry_json(t.customer.select("c_custkey", F.when(c("c_custkey") % 2 == 0, one).otherwise(two).alias("j")), "j")
    return rows.select("c_custkey", "number", F.size("applicants").alias("applicants"), c("applicants")[0]["name"].alias("first_name"))


@query("a08_html_catalog", "WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1)) AS cell FROM pages) SELECT page_id, count(*) AS cells FROM l GROUP BY page_id")
def _(t):
    return S.scan_html_list(t.pages.select("page_id", "html"), "html").groupBy("page_id").agg(F.count(lit(1)).alias("cells"))


@query("a08_html_pairs", "WITH l AS (SELECT page_id, regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1) AS x FROM pages), p AS (SELECT page_id, unnest(range((len(x) + 1) // 2)) AS pair, x FROM l) SELECT page_id, pair FROM p")
def _(t):
    return S.scan_html_list(t.pages.select("page_id", "html"), "html", pairs=True).select("page_id", "pair")


@query("a09_supplement", "SELECT p_partkey, p_name FROM part WHERE p_size % 4 <> 0")
def _(t):
    return S.scan_supplement(t.part.select("p_partkey", "p_name", F.when(c("p_size") % 4 != 0, c("p_type")).otherwise(" ").alias("kind")), ["p_name", "kind"])[0].select("p_partkey", "p_name")


@query("a10_flatten_map", "SELECT DISTINCT p_brand AS key, p_name AS name, p_size AS tier FROM part")
def _(t):
    m = t.part.groupBy("p_brand").agg(F.collect_set(F.struct(c("p_name").alias("name"), c("p_size").alias("tier"))).alias("l")).select(F.create_map("p_brand", "l").alias("m"))
    n = t.part.select("p_brand", "p_name", "p_size").distinct().count()
    return S.flatten_map(m, "m", n)


@query("a11_common_rows", "SELECT p_name AS item, '' AS region, p_partkey::VARCHAR AS code, '' AS url, 'part' AS source FROM part UNION ALL SELECT s_name, s_nationkey::VARCHAR, '', '', 'supplier' FROM supplier")
def _(t):
    return S.to_common_rows(t.part, {"item": c("p_name"), "code": c("p_partkey")}, "part").unionByName(S.to_common_rows(t.supplier, {"item": c("s_name"), "region": c("s_nationkey")}, "supplier"))


@query("a12_nationwide_catalog", "SELECT p_partkey, '' AS region, 'nationwide' AS scope FROM part")
def _(t):
    return S.nationwide_catalog(t.part.select("p_partkey"), "nationwide")


@query("a13_corroborated_region", "SELECT p_partkey, CASE WHEN starts_with(p_name, 'red') OR starts_with(p_name, 'blue') THEN p_brand ELSE '' END AS region FROM part")
def _(t):
    return S.corroborated_region(t.part.select("p_partkey", "p_name", c("p_brand").alias("region")), "p_name", "region", F.array(lit("red"), lit("blue"))).select("p_partkey", "region")


@query("a16_write_json", "SELECT l_orderkey, count(*) AS lines, max(l_partkey) AS last_part FROM lineitem GROUP BY 1")
def _(t):
    path = S.scratch(t.spark, "json")
    S.write_json(t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_linenumber")).alias("lines")), path)
    df = t.spark.read.schema("l_orderkey long, lines array<struct<l_partkey:long,l_linenumber:int>>").json(path)
    return df.select("l_orderkey", F.size("lines").cast("long").alias("lines"), F.array_max(c("lines.l_partkey")).alias("last_part"))


@query("a17_append_log", "SELECT conv_id, turn, role FROM conversations")
def _(t):
    path = S.scratch(t.spark, "log")
    S.append_log(t.conversations.filter("turn % 2 = 0").select("conv_id", "turn", "role"), path)
    S.append_log(t.conversations.filter("turn % 2 = 1").select("conv_id", "turn", "role"), path)
    return S.read_log(t.spark, path, "conv_id long, turn long, role string")


@query("a18_keyed_cache", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0")
def _(t):
    path = S.scratch(t.spark, "cache")
    rows = t.orders.select("o_orderkey", "o_custkey", F.when(c("o_orderstatus") == "F", "complete").otherwise("partial").alias("status"), (c("o_orderkey") % 3 != 0).alias("found"))
    S.write_cache(rows, path, "o_orderkey", "v1")
    return S.read_cache(t.spark, path, "v1").select("o_orderkey", "o_custkey")


@query("a23_query_facts", "SELECT p_name, count(*) AS n FROM part WHERE p_type = 'PROMO' GROUP BY 1")
def _(t):
    path = S.scratch(t.spark, "facts")
    S.write_query_facts(t.part.groupBy("p_name", c("p_type").alias("status")).agg(F.count(lit(1)).alias("n")), path)
    return S.read_query_facts(t.spark, path, "PROMO").select("p_name", "n")


@query("a27_valid_responses", "SELECT p_partkey, CASE WHEN p_size % 4 = 1 THEN 'denied' ELSE 'error' END AS reason FROM part WHERE p_size % 4 IN (1, 2)")
def _(t):
    k = c("p_size") % 4
    code = F.when(k == 0, "00").when(k == 2, "30").otherwise("20")
    pages = t.part.select("p_partkey", F.concat(lit("<r><resultCode>"), code, lit("</resultCode><resultMsg>"), F.when(k == 1, "access denied").otherwise("none"), lit("</resultMsg></r>")).alias("x"))
    return S.valid_responses(S.xml_headers(pages, "x"))[1].select("p_partkey", "reason")


@query("a28_grid_json", "SELECT p_name AS name, p_partkey::VARCHAR AS code FROM part WHERE p_size % 5 <> 0")
def _(t):
    row = F.struct(c("p_name").alias("NM"), c("p_partkey").cast("string").alias("CD"))
    ok = F.struct(F.when(c("p_size") % 5 != 0, "INFO-000").otherwise("ERROR-500").alias("code"))
    doc = F.when(c("p_size") % 2 == 0, F.to_json(F.struct(F.struct(ok.alias("result"), row.alias("row")).alias("Grid")))).otherwise(F.to_json(F.struct(F.struct(ok.alias("result"), F.array(row).alias("row")).alias("Grid"))))
    return S.scan_grid_json(t.part.select(doc.alias("j")), "j", "Grid", {"NM": "name", "CD": "code"})[0]


@query("a29_flatten_catalog", "SELECT r_name AS major_name, n_nationkey AS minor, coalesce(s_name, n_name) AS name FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) ON s_nationkey = n_nationkey")
def _(t):
    minor = t.nation.select(c("n_nationkey").alias("minor"), c("n_regionkey").alias("major"), c("n_name").alias("minor_name"))
    return S.flatten_catalog(t.region.select(c("r_regionkey").alias("major"), c("r_name").alias("major_name")), minor, t.supplier.filter("s_suppkey % 2 = 0").select(c("s_nationkey").alias("minor"), c("s_name").alias("detail_name")))
