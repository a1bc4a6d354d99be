"""Review clusters, audits of snapshots and reviewed documents, and the status of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.functions.text import canonical_name
from terroir.functions.values import rounded, safe_rate
from terroir.operators.common import numbered, violations


def _most(df: DataFrame, keys: list[str], value: Column, name: str, *order: Column) -> DataFrame:
    """The values of each key with their numbers, the most frequent first: array of struct (value, n)."""
    counts = df.groupBy(*keys, value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = F.struct((-F.col("n")).alias("less"), *[o.alias(f"o{i}") for i, o in enumerate(order)], "value", "n")
    listed = F.transform(F.array_sort(F.collect_list(ranked)), lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n")))
    return counts.groupBy(*keys).agg(listed.alias(name))


def review_clusters(rows: DataFrame, top: int = 5, examples: int = 3) -> DataFrame:
    """Rows that wait for review, one cluster for each item by its canonical name.

    ``rows``: idx, name, reason, region, source, candidates (array of struct item, class, score). A cluster has the
    spellings of its name (frequent, then short ones first), reasons, numbers of regions and sources, its candidates
    (in how many rows, as a share of all rows, and with which mean score; the ``top`` first), a state that tells
    whether the first of them stands in all rows, and the ``examples`` first rows. A row that lists a candidate twice
    counts once, with all of its scores. Histograms are aggregated before they are gathered.
    """
    keyed = rows.withColumn("cluster", F.coalesce(F.nullif(canonical_name(F.col("name")), F.lit("")), F.concat(F.lit("row:"), F.col("idx").cast("string"))))
    first = F.slice(F.array_sort(F.array_agg("idx")), 1, examples)
    base = keyed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("region").alias("regions"), F.count_distinct("source").alias("sources"))
    places = keyed.select("cluster", "idx").withColumn("n", F.row_number().over(W.partitionBy("cluster").orderBy("idx"))).filter(F.col("n") <= examples)
    parts = [
        _most(keyed, ["cluster"], F.col("name"), "variants", F.length("value"), F.length("value") - F.length(F.replace("value", F.lit(" "), F.lit("")))),
        _most(keyed, ["cluster"], F.col("reason"), "reasons"),
        places.groupBy("cluster").agg(first.alias("examples")),
    ]
    each = keyed.select("cluster", "idx", F.explode("candidates").alias("c")).groupBy("cluster", "c.item", "c.class", "idx").agg(F.sum("c.score").alias("total"), F.count(F.lit(1)).alias("samples"))
    found = each.groupBy("cluster", "item", "class").agg(F.count(F.lit(1)).alias("rows"), rounded(F.sum("total") / F.sum("samples"), 4).alias("score"))
    best = F.row_number().over(W.partitionBy("cluster").orderBy(F.desc("rows"), F.desc("score"), "item", "class"))
    shown = found.join(base.select("cluster", "n_rows"), "cluster").withColumn("place", best).filter(F.col("place") <= top)
    option = F.struct("place", "item", "class", "rows", safe_rate(F.col("rows"), F.col("n_rows")).alias("coverage"), "score")
    parts.append(shown.groupBy("cluster").agg(F.array_sort(F.collect_list(option)).alias("options")))
    joined = reduce(lambda a, b: a.join(b, "cluster", "left"), parts, base)
    state = F.when(F.col("options").isNull(), "none").when(F.col("options")[0]["rows"] == F.col("n_rows"), "in_all_rows").otherwise("mixed")
    return joined.withColumn("state", state).withColumn("name", F.col("variants")[0]["value"])


def audit_snapshot(items: DataFrame, reported: DataFrame, facility: str, nationwide: str) -> DataFrame:
    """severity, code, key: what is wrong with a snapshot.

    ``items``: region_code, province, region, item, basis (confirmed, goods or review), notice, class, sources (array),
    months (map of month to count), value, availability, n_examples. ``reported``: metric (items, regional, nationwide,
    available) and its value as the snapshot tells it. Rules name the row that breaks them, differing counts both
    numbers, and warnings how many rows they concern.
    """
    real, basis = F.col("province") != nationwide, F.col("basis")
    measured = F.col("availability").isin("available", "partial")
    bad_month = F.exists(F.map_entries("months"), lambda e: ~e["key"].rlike(r"^\d{4}-(0[1-9]|1[0-2])$") | F.coalesce(e["value"] < 0, F.lit(True)))
    rules = {
        "incomplete_confirmed": ((basis == "confirmed") & (F.col("notice").isNull() | F.col("class").isNull())) | ((basis == "goods") & F.col("notice").isNull()),
        "review_with_class": (basis == "review") & F.col("class").isNotNull(),
        "facility_as_region": real & F.array_contains("sources", facility),
        "bad_month": bad_month,
        "no_availability": F.col("availability").isNull(),
        "available_without_value": (F.col("availability") == "available") & F.col("value").isNull(),
        "blocked_with_value": (F.col("availability") == "blocked") & F.col("value").isNotNull(),
    }
    key = F.concat_ws("/", "province", "region", "item")
    broken = violations(items, rules, key)
    twice = items.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit("duplicate_item").alias("code"), "key")
    errors = broken.unionByName(twice).select(F.lit("error").alias("severity"), "code", "key")
    review = basis == "review"
    counts = items.agg(
        F.count(F.lit(1)).alias("items"), F.count_if(real).alias("regional"), F.count_if(~real).alias("nationwide"), F.count_if(real & measured).alias("available"),
        F.count_if(review & measured).alias("review_with_metric"), F.count_if(review & (F.col("n_examples") > 0)).alias("review_with_examples"), F.count_if(F.col("region_code").isNull()).alias("unresolved_code"),
    )
    long = counts.unpivot([], counts.columns, "metric", "actual")
    differs = reported.join(long, "metric").filter("value <> actual").select(F.lit("error").alias("severity"), F.concat(F.col("metric"), F.lit("_count_differs")).alias("code"), F.concat_ws("/", F.col("value").cast("string"), F.col("actual").cast("string")).alias("key"))
    warned = long.filter((F.col("actual") > 0) & F.col("metric").isin("review_with_metric", "review_with_examples", "unresolved_code"))
    return errors.unionByName(differs).unionByName(warned.select(F.lit("warning").alias("severity"), F.col("metric").alias("code"), F.col("actual").cast("string").alias("key")))


def document_violations(rows: DataFrame, apps: DataFrame, methods: list[str]) -> DataFrame:
    """code, key of what a reviewed document breaks.

    ``rows``: id, province, region, item, declared, declared_registered (null: not declared). ``apps``: id, number,
    method, status, n_goods. Names are needed and rows unique; each row needs applications, with a number each and
    none twice, by an allowed method and with goods; declared numbers must be the actual ones.
    """
    number = F.nullif(F.regexp_replace("number", r"\s", ""), F.lit(""))
    per = apps.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(number).alias("distinct"), F.count_if(number.isNull()).alias("unnumbered"), F.count_if(F.col("status") == "registered").alias("registered"),
        F.count_if(~F.coalesce(F.lower("method").isin(methods), F.lit(False))).alias("bad_methods"), F.count_if(F.coalesce("n_goods", F.lit(0)) == 0).alias("no_goods"),
    )
    blank = lambda c: F.nullif(F.trim(c), F.lit("")).isNull()
    joined = rows.join(per, "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    found = violations(
        joined,
        {
            "missing_name": blank("province") | blank("region") | blank("item"), "no_applications": F.col("n") == 0, "no_number": F.col("unnumbered") > 0,
            "number_twice": F.col("distinct") + F.col("unnumbered") < F.col("n"), "bad_method": F.col("bad_methods") > 0, "no_goods": F.col("no_goods") > 0,
            "count_differs": F.col("declared") != F.col("n"), "registered_differs": F.col("declared_registered") != F.coalesce("registered", F.lit(0)),
        },
        F.col("id"),
    )
    twice = rows.groupBy("province", "region", "item").agg(F.count(F.lit(1)).alias("n"), F.min("id").cast("string").alias("key")).filter("n > 1").select(F.lit("row_twice").alias("code"), "key")
    return found.unionByName(twice)


def document_id(rows: DataFrame, columns: list[str], order: list[str], length: int = 20, width: int = 1024) -> DataFrame:
    """id: a hash of the rows' contents in order. Up to ``width`` rows are hashed together; of more rows, each stretch
    of ``width`` is, and the hashes of the stretches in turn, so that no task holds more than ``width`` of them."""
    level = numbered(rows.select(*order, F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256).alias("d")), [F.col(o) for o in order], "n").select("n", "d")
    total = level.count()
    joined = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "d"))), lambda x: x["d"]), ""), 256)
    while total > width:
        level = level.groupBy((F.floor((F.col("n") - 1) / width) + 1).alias("n")).agg(joined.alias("d"))
        total = -(-total // width)
    return level.agg(F.concat(F.lit("sha256-"), F.substring(joined, 1, length)).alias("id"))


def run_status(rows: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """One row: numbers of input rows and of distinct queries by state, of records inside, outside and unverified with
    the verified share, and of items whose metrics are available (partly included) or blocked.

    ``rows``: query, state (complete, partial, error or skipped); ``items``: availability, inside, outside, unverified.
    """
    state = F.col("state")
    of = lambda s: F.count_if(state == s).alias(f"{s}_rows")
    a = rows.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(state != "skipped").alias("searchable_rows"), of("complete"), of("partial"), of("error"), of("skipped"), F.count_distinct("query").alias("queries"),
        F.count_distinct(F.when(state == "complete", F.col("query"))).alias("complete_queries"), F.count_distinct(F.when(state == "partial", F.col("query"))).alias("partial_queries"),
    )
    available = F.count_if(F.col("availability").isin("available", "partial"))
    known = F.sum(F.col("inside") + F.col("outside"))
    b = items.agg(
        available.alias("available_items"), F.count_if(F.col("availability") == "partial").alias("partial_items"), (F.count(F.lit(1)) - available).alias("blocked_items"),
        *[F.sum(c).alias(c) for c in ("inside", "outside", "unverified")], safe_rate(known, known + F.sum("unverified")).alias("verified_rate"),
    )
    policy = F.lit("complete" if threshold >= 1 else "preview").alias("policy")
    return a.crossJoin(F.broadcast(b)).select("*", policy)  # one row by one
