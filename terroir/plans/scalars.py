"""Queries of the row-wise operators and functions: each column in Spark and in SQL side by side."""

from __future__ import annotations

from pyspark.sql import functions as F

from terroir.functions import text as X
from terroir.functions import values as V
from terroir.operators import rows as R
from terroir.operators.score import alert_kind
from terroir.plans.base import Tables

QUERIES, SQL = {}, {}


def project(name: str, table: str, key: str, columns: dict, where: tuple | None = None) -> None:
    """Registers a projection: columns maps an alias to (function that makes the Column, SQL), and
    where is such a pair."""

    def run(spark, sf_dir):
        df = getattr(Tables(spark, sf_dir), table)
        df = df.filter(where[0]()) if where else df
        return df.select(key, *[make().alias(a) for a, (make, _) in columns.items()])

    QUERIES[name] = run
    SQL[name] = f"SELECT {key}, {', '.join(f'{s} AS {a}' for a, (_, s) in columns.items())} FROM {table}" + (f" WHERE {where[1]}" if where else "")


c = F.col


def decorated():
    return F.concat(F.lit("  "), c("p_name"), F.lit(" (lot "), c("p_size").cast("string"), F.lit(", x) ; rest [a]"))


def repaired():
    province = F.when(c("n_nationkey") % 3 != 0, F.lit("P")).otherwise("")
    return R.repair_region_columns(province, F.when(c("n_nationkey") % 3 == 0, F.concat(F.lit("A > "), c("n_name"))).otherwise(c("n_name")), F.array(F.lit("P")))


def dimensions():
    return R.entry_dimensions(F.when(c("p_size") % 3 == 0, c("p_type")), F.when(c("p_size") % 3 == 1, c("p_brand")).otherwise(""), c("p_name"), F.lit(None).cast("string"))


def metric():
    return V.metric(c("p_size"), F.when(c("p_size") % 3 == 0, "blocked").otherwise("available"))


def parsed():
    """Every fifth text isn't JSON."""
    text = F.when(c("event_id") % 5 == 0, F.concat(F.lit("x"), c("props"))).otherwise(c("props"))
    return F.from_json(text, "k int, _corrupt_record string", {"mode": "PERMISSIVE"})


DECORATED = "'  ' || p_name || ' (lot ' || p_size || ', x) ; rest [a]'"

project("b02_clean_item_name", "part", "p_partkey", {"name": (lambda: X.clean_item_name(decorated()), "p_name")})
project("b03_strip_region_names", "supplier", "s_suppkey", {"rest": (lambda: X.strip_region_names(F.concat(F.lit("NATION_1 "), c("s_name")), F.lit("NATION_1")), "trim(replace(replace('NATION_1 ' || s_name, 'NATION_1', ''), 'NATION_', ''))")})
project("b01_repair_columns", "nation", "n_nationkey", {"province": (lambda: repaired()[0], "CASE WHEN n_nationkey % 3 <> 0 THEN 'P' ELSE 'A' END"), "region": (lambda: repaired()[1], "n_name")})
project("b04_service_class", "part", "p_partkey", {"service": (lambda: R.is_service_class(c("p_size")), "p_size >= 35")})
project("b05_class_filter", "part", "p_partkey", {"size": (lambda: c("p_size"), "p_size")}, (lambda: F.arrays_overlap(X.class_list(F.concat_ws("|", F.lpad(c("p_size").cast("string"), 3, "0"), F.lit("099"))), F.array(F.lit("29"), F.lit("30"), F.lit("31"))), "p_size IN (29, 30, 31)"))
project("b06_class_fallback", "part", "p_partkey", {"classes": (lambda: F.array_join(R.with_class_fallback(F.when(c("p_size") < 35, F.array(c("p_size").cast("string"))), ["29", "30", "31"]), "|"), "CASE WHEN p_size < 35 THEN p_size::VARCHAR ELSE '29|30|31' END")})
project("b07_plan_query", "customer", "c_custkey", {"skip_reason": (lambda: R.plan_query(c("c_acctbal") < 0, c("c_mktsegment") == "MACHINERY", c("c_custkey") % 5 == 0, F.when(c("c_nationkey") > 3, c("c_nationkey").cast("string")), c("c_mktsegment") == "BUILDING"),
    "CASE WHEN c_acctbal < 0 THEN 'error' WHEN c_mktsegment = 'MACHINERY' THEN 'excluded' WHEN c_nationkey <= 3 AND c_mktsegment <> 'BUILDING' THEN 'no_region' WHEN c_custkey % 5 = 0 THEN 'review_required' END")})
project("b08_query_key", "part", "p_partkey", {"query_key": (lambda: R.query_key(F.concat(F.lit(" "), F.upper("p_name"), F.lit("  ")), F.when(c("p_size") < 40, F.array(F.lpad(c("p_size").cast("string"), 3, "0"), F.lit("01"))).otherwise(F.array().cast("array<string>"))),
    "lower(p_name) || chr(31) || CASE WHEN p_size >= 40 THEN 'fallback:' ELSE array_to_string(list_sort(list_distinct([p_size::VARCHAR, '1'])), ',') END")})
project("b10_excluded_items", "part", "p_partkey", {"excluded": (lambda: R.excluded_item(c("p_name"), "(ing|ed)$", ["misc"]), "regexp_matches(p_name, '(ing|ed)$') OR p_name IN ('misc')")})
project("b11_catalog_passthrough", "part", "p_partkey", {"status": (lambda: F.when(c("p_type").isin("PROMO", "STANDARD"), "ok").otherwise("review_required"), "CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN 'ok' ELSE 'review_required' END")})
project("b13_sanitize", "customer", "c_custkey", {"regions": (lambda: F.size(R.sanitize_applicants(F.array(F.struct(c("c_nationkey").cast("string").alias("address"), c("c_name").alias("name")), F.struct(F.lit(None).cast("string").alias("address"), c("c_mktsegment").alias("name"))),
    lambda a: a, lambda n: n.rlike("BUILDING"))), "CASE WHEN c_mktsegment LIKE '%BUILDING%' THEN 2 ELSE 1 END")})
project("b14_status_category", "orders", "o_orderkey", {"category": (lambda: X.status_category(c("o_orderstatus"), "P", "F", "O"), "CASE o_orderstatus WHEN 'P' THEN 'inactive' WHEN 'F' THEN 'registered' WHEN 'O' THEN 'pending' ELSE 'unknown' END")})
project("b15_producer_like", "customer", "c_custkey", {"producer": (lambda: X.is_producer_like(F.when(c("c_custkey") % 3 == 0, F.concat(c("c_name"), F.lit("영농조합"))).when(c("c_custkey") % 3 == 1, F.lit("강화군")).otherwise(F.lit("주식회사 강화군"))), "c_custkey % 3 <> 2")})
project("b16_raw_goods", "part", "p_partkey", {"raw_goods": (lambda: F.arrays_overlap(X.class_list(F.concat(F.lit("0"), c("p_size").cast("string"), F.lit(",99")), r"[|,]"), F.array(*map(F.lit, X.RAW_CLASSES))), "p_size IN (29, 30, 31)")})
project("b18_entry_status", "orders", "o_orderkey", {"status": (lambda: R.entry_status(F.when(c("o_orderkey") % 2 == 0, c("o_orderstatus")).otherwise(" "), F.when(c("o_orderkey") % 5 == 0, F.lit("e"))), "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus WHEN o_orderkey % 5 = 0 THEN 'error' ELSE 'ok' END")})
project("b19_entry_dimensions", "part", "p_partkey", {"name": (lambda: dimensions()[0], "CASE p_size % 3 WHEN 0 THEN p_type WHEN 1 THEN p_brand ELSE p_name END"), "matching_basis": (lambda: dimensions()[1], "CASE p_size % 3 WHEN 0 THEN 'notice' WHEN 1 THEN 'item' ELSE 'query' END")})
project("b20_official_label", "part", "p_partkey", {"label": (lambda: R.official_label(c("p_type"), F.concat(F.lit("fresh "), c("p_name")), ["PROMO", "STANDARD"], "^fresh "), "CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN p_name END")})
project("b21_confirmed", "part", "p_partkey", {"confirmed": (lambda: (c("p_type") == "PROMO") & (F.coalesce("p_name", F.lit("")) != "") & ~c("p_size").between(40, 50), "p_type = 'PROMO' AND coalesce(p_name, '') <> '' AND NOT p_size BETWEEN 40 AND 50")})
project("b24_stage_of_name", "part", "p_partkey", {"stage": (lambda: X.specialty_stage(F.when(c("p_size") % 4 == 0, F.lit("매실청")).when(c("p_size") % 4 == 1, F.lit("신선한 감")).when(c("p_size") % 4 == 2, F.lit("사과가공식품")).otherwise(c("p_name"))), "CASE p_size % 4 WHEN 0 THEN 'processed' WHEN 1 THEN 'raw' WHEN 2 THEN 'processed' ELSE 'raw' END")})
project("b25_hit_stage", "part", "p_partkey", {"stage": (lambda: X.hit_stage(F.when(c("p_size") % 2 == 0, F.lit("유자차 마을")).otherwise("미가공 유자"), F.array(c("p_size").cast("string")), F.lit("유자")),
    "CASE WHEN p_size BETWEEN 29 AND 33 THEN CASE WHEN p_size % 2 = 0 THEN 'processed' ELSE 'raw' END WHEN p_size = 35 OR p_size BETWEEN 39 AND 45 THEN 'service' ELSE 'excluded' END"),
    "craft": (lambda: X.hit_stage(c("p_name"), F.array(c("p_size").cast("string")), c("p_name"), craft=True), "CASE WHEN p_size = 35 OR p_size BETWEEN 39 AND 45 THEN 'service' ELSE 'product' END")})
project("b26_goods_stage", "part", "p_partkey", {"stage": (lambda: R.goods_stage(F.array(c("p_name"), c("p_type")), "PROMO|MEDIUM", "ECONOMY"), "'raw' || CASE WHEN p_type IN ('PROMO', 'MEDIUM') THEN '+processed' WHEN p_type = 'ECONOMY' THEN '+service' ELSE '' END")})
project("b27_mark_type", "orders", "o_orderkey", {"mark": (lambda: R.mark_type(c("o_orderkey") + 400000, {"40": "mark", "41": "service", "44": "collective"}), "CASE substr((o_orderkey + 400000)::VARCHAR, 1, 2) WHEN '40' THEN 'mark' WHEN '41' THEN 'service' WHEN '44' THEN 'collective' ELSE 'other' END")})
project("b28_rights_status", "part", "p_partkey", {"rights": (lambda: R.rights_status(c("p_size") % 4, c("p_size") % 2, F.when(c("p_size") > 5, F.array(c("p_size").cast("string"))).otherwise(F.array().cast("array<string>"))),
    "CASE WHEN p_size % 4 = 0 THEN 'none' WHEN p_size % 2 = 0 THEN 'pending' WHEN p_size <= 5 THEN 'unknown' WHEN p_size >= 35 THEN 'service_only' ELSE 'goods' END")})
project("b29_stale_complete", "orders", "o_orderkey", {"stale": (lambda: R.is_stale_complete(F.when(c("o_orderstatus") == "F", "complete").otherwise("partial"), c("o_orderdate").cast("date"), F.lit("1998-08-01").cast("date"), 365), "o_orderstatus = 'F' AND date_diff('day', o_orderdate::DATE, DATE '1998-08-01') >= 365")})
project("b31_staleness", "orders", "o_orderkey", {"state": (lambda: R.staleness_category(F.when(c("o_orderkey") % 7 != 0, c("o_orderdate").cast("date")), F.array(F.date_add(c("o_orderdate").cast("date"), (c("o_orderkey") % 3 - 1).cast("int"))), F.lit("1996-01-01").cast("date")),
    "CASE WHEN o_orderkey % 7 = 0 THEN 'unknown' WHEN o_orderdate::DATE >= DATE '1996-01-01' THEN 'current' WHEN o_orderkey % 3 = 2 THEN 'renewed' ELSE 'expired' END")})
project("b33_relabel_scope", "part", "p_partkey", {"scope": (lambda: R.relabel_scope(F.when(c("p_size") % 5 == 0, "review").otherwise("regional"), c("p_type"), ["PROMO"], "nationwide"), "CASE WHEN p_type = 'PROMO' OR p_size % 5 = 0 THEN 'nationwide' ELSE 'regional' END")})
project("b35_normal_goods", "part", "p_partkey", {"goods": (lambda: X.normal_goods(decorated()), "regexp_replace(lower(" + DECORATED + "), '[^0-9a-z가-힣]', '', 'g')")})
project("b22_data_state", "part", "p_partkey", {"state": (lambda: R.data_state(c("p_size") % 3, c("p_size") % 2, c("p_size") % 4, F.lit(0), F.lit(2)), "CASE WHEN p_size % 3 = 2 THEN 'complete' WHEN p_size % 4 = 2 THEN 'blocked' WHEN p_size % 3 + p_size % 2 = 2 THEN 'partial' ELSE 'mixed' END")})
project("h01_unicode_normalize", "documents", "doc_id", {"n": (lambda: F.length(X.unicode_normalize(c("text"))), "length(nfc_normalize(text))")})
project("h02_spaces", "documents", "doc_id", {"n": (lambda: F.length(X.collapse_spaces(c("text"))), "length(trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')))"), "compacted": (lambda: X.compact(c("source")), "source")})
project("h03_canonical_name", "part", "p_partkey", {"name": (lambda: X.canonical_name(decorated()), "regexp_replace(lower(" + DECORATED + "), '[ \\t\\n''\"`()\\[\\]{}._-]+', '', 'g')")})
project("h04_digits_only", "customer", "c_custkey", {"digits": (lambda: X.digits_only(c("c_name")), "regexp_replace(c_name, '[^0-9]', '', 'g')")})
project("h05_region_code", "customer", "c_custkey", {"code": (lambda: X.region_code((c("c_custkey") + 11000).cast("string")), "CASE WHEN length((c_custkey + 11000)::VARCHAR) = 5 THEN (c_custkey + 11000)::VARCHAR || '00000' ELSE '' END")})
project("h06_class_code", "part", "p_partkey", {"code": (lambda: X.class_code(F.when(c("p_size") < 45, F.lpad(c("p_size").cast("string"), 3, "0")).otherwise(" x1")), "CASE WHEN p_size < 45 THEN p_size::VARCHAR ELSE 'x1' END")})
project("h07_bigrams", "part", "p_partkey", {"pairs": (lambda: F.array_join(F.array_sort(X.bigrams(c("p_name"))), "|"), "array_to_string(list_sort(list_distinct([substr(p_name, i::INT, 2) FOR i IN range(1, length(p_name))])), '|')")})
project("h08_jaccard", "part", "p_partkey", {"likeness": (lambda: V.rounded(X.jaccard(X.bigrams(c("p_name")), X.bigrams(c("p_brand"))), 6), "round(coalesce(len(list_intersect([substr(p_name, i::INT, 2) FOR i IN range(1, length(p_name))], [substr(p_brand, i::INT, 2) FOR i IN range(1, length(p_brand))]))::DOUBLE / len(list_distinct(list_concat([substr(p_name, i::INT, 2) FOR i IN range(1, length(p_name))], [substr(p_brand, i::INT, 2) FOR i IN range(1, length(p_brand))]))), 0), 6)")})
project("h09_edge_containment", "customer", "c_custkey", {"held": (lambda: X.contains_at_edge(F.lit("Customer#00"), c("c_name")), "starts_with(c_name, 'Customer#00') OR ends_with(c_name, 'Customer#00')")})
project("h10_safe_rate", "part", "p_partkey", {"rate": (lambda: V.safe_rate(c("p_size"), c("p_size") % 7), "CASE WHEN p_size % 7 > 0 THEN round(p_size::DOUBLE / (p_size % 7), 4) END")})
project("h11_year_month", "orders", "o_orderkey", {"y": (lambda: V.valid_year(c("o_orderdate").cast("date").cast("string")), "year(o_orderdate)::INT"), "m": (lambda: V.valid_month(F.date_format("o_orderdate", "yyyyMMdd")), "strftime(o_orderdate, '%Y-%m')")})
project("h12_strict_date", "orders", "o_orderkey", {"d": (lambda: V.strict_date(F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lpad((c("o_orderkey") % 32).cast("string"), 2, "0"))).cast("string"), "CAST(try_strptime(strftime(o_orderdate, '%Y%m') || lpad((o_orderkey % 32)::VARCHAR, 2, '0'), '%Y%m%d')::DATE AS VARCHAR)")})
project("h13_local_midnight", "events", "event_id", {"local_day": (lambda: V.local_date(c("ts").cast("timestamp")).cast("string"), "(ts + INTERVAL 9 HOUR)::DATE::VARCHAR"), "next_day": (lambda: F.to_date(F.from_utc_timestamp(V.next_local_midnight(c("ts").cast("timestamp")), "Asia/Seoul")).cast("string"), "((ts + INTERVAL 9 HOUR)::DATE + 1)::VARCHAR")})
project("h14_content_hash", "nation", "n_nationkey", {"hash": (lambda: V.content_hash("n_regionkey", "n_name"), "sha256('{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}')")})
project("h15_hash_id", "nation", "n_nationkey", {"id16": (lambda: V.hash_id(c("n_name")), "substr(sha256(n_name), 1, 16)"), "id12": (lambda: V.hash_id(c("n_name"), 12), "substr(sha256(n_name), 1, 12)")})
project("h16_percent", "part", "p_partkey", {"text": (lambda: X.percent(F.when(c("p_size") > 5, c("p_size") / 64), "none"), "CASE WHEN p_size > 5 THEN round(p_size / 64.0::DOUBLE * 100)::INT || '%' ELSE 'none' END")})
project("h17_topic_marker", "nation", "n_nationkey", {"word": (lambda: X.topic_marker(F.when(c("n_nationkey") % 3 == 0, F.lit("양주군")).when(c("n_nationkey") % 3 == 1, F.lit("제주도")).otherwise(c("n_name"))), "CASE n_nationkey % 3 WHEN 0 THEN '양주군은' WHEN 1 THEN '제주도는' ELSE n_name || '는' END")})
project("h19_alert_kind", "part", "p_partkey", {"kind": (lambda: alert_kind(c("p_size") > 40, c("p_size") > 30), "CASE WHEN p_size > 40 THEN 'unclaimed' WHEN p_size > 30 THEN 'low_conversion' END")})
project("h20_json_parse", "events", "event_id", {"k": (lambda: parsed()["k"], "CASE WHEN event_id % 5 <> 0 THEN (props->>'$.k')::INT END"), "broken": (lambda: parsed()["_corrupt_record"].isNotNull(), "event_id % 5 = 0")})
project("h21_paren_strip", "part", "p_partkey", {"name": (lambda: X.paren_stripped(F.concat(c("p_name"), F.lit(" (old)"))), "p_name")})
project("h22_region_tokens", "customer", "c_custkey", {"tokens": (lambda: F.array_join(X.region_tokens(F.concat(F.lit("경기도 "), F.when(c("c_custkey") % 2 == 0, F.lit("남양주시")).otherwise("강화군"), F.lit(" 1"))), "|"), "CASE WHEN c_custkey % 2 = 0 THEN '경기도|남양주시|경기|남양주' ELSE '경기도|강화군|경기|강화' END")})
project("h23_slots", "part", "p_partkey", {"text": (lambda: X.fill_slot(F.lit("jam of {item}"), "{item}", c("p_name")), "'jam of ' || p_name")})
project("h24_showcase_score", "part", "p_partkey", {"score": (lambda: F.when(c("p_type") == "PROMO", 3).otherwise(0) + F.when(c("p_size") > 30, 2).otherwise(0) + F.when(F.length("p_name") <= 12, 1).otherwise(0), "CASE WHEN p_type = 'PROMO' THEN 3 ELSE 0 END + CASE WHEN p_size > 30 THEN 2 ELSE 0 END + CASE WHEN length(p_name) <= 12 THEN 1 ELSE 0 END")})
project("h26_metric", "part", "p_partkey", {"value": (lambda: metric()["value"], "CASE WHEN p_size % 3 <> 0 THEN p_size END"), "availability": (lambda: metric()["availability"], "CASE WHEN p_size % 3 = 0 THEN 'blocked' ELSE 'available' END")})
project("h28_entities", "pages", "page_id", {"n": (lambda: F.length(X.decode_entities(c("html"))), "length(replace(replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&'))")})
project("a24_record_key", "customer", "c_custkey", {"key": (lambda: V.record_key(F.when(c("c_custkey") % 3 == 0, c("c_custkey")), [F.when(c("c_custkey") % 3 == 1, c("c_name")).otherwise(""), c("c_mktsegment")]),
    "CASE c_custkey % 3 WHEN 0 THEN c_custkey::VARCHAR WHEN 1 THEN c_name || '|' || c_mktsegment ELSE 'h:' || substr(sha256('|' || c_mktsegment), 1, 20) END")})


def _dates(spark, sf_dir):
    spans = Tables(spark, sf_dir).orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("a")).withColumn("b", F.date_add("a", (F.col("o_orderkey") % 60).cast("int")))
    return R.expand_dates(spans, "a", "b", 31).select("o_orderkey", F.col("day").cast("string").alias("day"))


QUERIES["b32_expand_dates"] = _dates
SQL["b32_expand_dates"] = "SELECT o_orderkey, unnest(range(o_orderdate::DATE, o_orderdate::DATE + least(o_orderkey % 60 + 1, 31)::INT, INTERVAL 1 DAY))::DATE::VARCHAR AS day FROM orders"
