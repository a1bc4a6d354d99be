"""Enrichment of records by keyed caches, and the merging of refreshed entries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.functions.values import normal_set, safe_rate
from terroir.operators.common import checked_broadcast, dealt


def from_cache(rows: DataFrame, cache: DataFrame, key: str, applicable: Column | None = None) -> DataFrame:
    """Left join of a keyed cache (key, status, ...); enrichment: not_applicable, no_number, not_collected or the
    cache's status. Every row stays exactly once: the cache must have one entry a key. Rows without a key are many and
    meet nothing; they are spread over the tasks by their contents and their place instead of meeting in one."""
    state = F.when(~(applicable if applicable is not None else F.lit(True)), "not_applicable").when(F.col(key).isNull(), "no_number").when(F.col("status").isNull(), "not_collected").otherwise(F.col("status"))
    plain = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    spread = F.when(F.col(key).isNull(), F.xxhash64(*plain, F.spark_partition_id())).otherwise(F.lit(0).cast("long"))
    met = cache.withColumn("__spread", F.pmod(F.xxhash64(key), F.lit(1)))  # 0 that isn't a constant, so that it stays a key of the join
    return rows.withColumn("__spread", spread).join(met, [key, "__spread"], "left").withColumn("enrichment", state).drop("status", "__spread")


def keep_confirmed(old: Column, new: Column, confirmed: str = "normalized_exact") -> Column:
    """A confirmed value is never overwritten; otherwise the new one where there is one."""
    return F.when(old == confirmed, old).otherwise(F.coalesce(new, old))


def goods_match(targets: Column, products: Column, class_shared: Column) -> Column:
    """How goods match their targets: exact, contained either way, class only, mismatch, or unverified without goods."""
    exact = F.arrays_overlap(targets, products)
    holds = F.exists(targets, lambda t: F.exists(products, lambda p: F.contains(p, t) | F.contains(t, p)))
    return F.when(F.coalesce(F.size(products), F.lit(0)) == 0, "unverified").when(exact, "normalized_exact").when(holds, "normalized_contains").when(class_shared, "class_only").otherwise("mismatch")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once a row, however often it occurs there."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def goods_evidence(targets: Column, products: Column, classes: Column, most: int = 50) -> Column:
    """How goods match the names they are looked for by, with the evidence, as a struct.

    ``targets``: array of (name, notice, stage), the first being the item itself, the others its aliases; ``products``:
    array of (class, name, goods), ``name`` normalised; ``classes``: classes asked for, all if empty. Only goods of
    these classes can match: by an equal name, or one that stands in the other. Fields: method, confidence, review,
    notice and stage (of the alias by which the first equal name was found, else null), aliases, products and
    class_matched (counts), evidence: array of (class, goods, kind, target) without repeats, equal names first, then in
    order of the goods, ``most`` at most; a piece's target is the first name that it matches.
    """
    count = lambda a: F.coalesce(F.size(a), F.lit(0))
    given = F.coalesce(products, F.array_compact(F.array(F.get(products, F.lit(0)))))  # null: an empty array of its type
    held = lambda p, t: F.contains(p["name"], t) | F.contains(t, p["name"])
    piece = lambda kind, target: lambda p: F.struct(p["class"].alias("class"), p["goods"].alias("goods"), F.lit(kind).alias("kind"), target(p).alias("target"))
    equal = lambda a, b: a["class"].eqNullSafe(b["class"]) & a["goods"].eqNullSafe(b["goods"])

    def matched(a: Column) -> Column:
        return F.filter(a["given"], lambda p: (count(a["classes"]) == 0) | F.coalesce(F.array_contains(a["classes"], p["class"]), F.lit(False)))

    def split(a: Column, of_class: Column) -> Column:
        names = a["names"]
        same = F.filter(of_class, lambda p: F.coalesce(F.array_contains(names, p["name"]), F.lit(False)))
        within = F.filter(of_class, lambda p: (F.coalesce(p["name"], F.lit("")) != "") & ~F.array_contains(names, p["name"]) & F.exists(names, lambda t: held(p, t)))
        return F.struct(same.alias("same"), within.alias("within"))

    def evidence(a: Column, s: Column) -> Column:
        names = a["names"]
        pieces = F.concat(F.transform(s["same"], piece("exact", lambda p: p["name"])), F.transform(s["within"], piece("contains", lambda p: F.get(F.filter(names, lambda t: held(p, t)), F.lit(0)))))
        once = bound(pieces, lambda all_: F.filter(all_, lambda x, i: ~F.exists(F.slice(all_, F.lit(1), i), lambda y: equal(x, y))))
        return F.slice(once, 1, most)

    def result(a: Column, of_class: Column, s: Column) -> Column:
        names, same, within = a["names"], s["same"], s["within"]
        first = F.get(F.filter(F.transform(targets, lambda t, i: F.struct(i.alias("i"), t["name"].alias("name"), t["notice"].alias("notice"), t["stage"].alias("stage"))), lambda t: (t["i"] > 0) & (t["name"] == F.get(same, F.lit(0))["name"])), F.lit(0))
        by_self = F.coalesce(F.get(same, F.lit(0))["name"] == F.get(names, F.lit(0)), F.lit(False))
        method = F.when(F.size(same) > 0, "normalized_exact").when(F.size(within) > 0, "normalized_contains").when(F.size(of_class) > 0, "class_only").when(count(products) > 0, "mismatch").otherwise("unverified")
        sure = F.when(F.size(same) > 0, "high").when(F.size(within) > 0, "high_contains").when(F.size(of_class) > 0, "candidate_only").when(count(products) > 0, "high").otherwise("unverified")
        return F.struct(
            method.alias("method"), sure.alias("confidence"), (F.size(same) == 0).alias("review"), F.when(~by_self, first["notice"]).alias("notice"), F.when(~by_self, first["stage"]).alias("stage"),
            F.size(F.array_distinct(names)).alias("aliases"), count(products).alias("products"), F.size(of_class).alias("class_matched"), evidence(a, s).alias("evidence"),
        )

    sides = F.struct(F.transform(targets, lambda t: t["name"]).alias("names"), classes.alias("classes"), given.alias("given"))
    return bound(sides, lambda a: bound(matched(a), lambda of_class: bound(split(a, of_class), lambda s: result(a, of_class, s))))


def reference_relations(records: DataFrame, references: DataFrame, key: str, relation: Column) -> DataFrame:
    """The relation of each record to its references: the common one, or unverified."""
    joined = records.join(references, key)
    return joined.groupBy(*[c for c in records.columns if c == key]).agg(F.collect_set(relation).alias("r")).select(key, F.when(F.size("r") == 1, F.element_at("r", 1)).otherwise("unverified").alias("reference_relation"))


def coverage(df: DataFrame, group: list[str], relation: str) -> DataFrame:
    r = F.col(relation)
    known = F.count_if(r.isin("inside", "outside"))
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("referenced"), F.count_if(r == "inside").alias("inside"), F.count_if(r == "outside").alias("outside"), F.count_if(r == "unverified").alias("unverified"), safe_rate(known, F.count(F.lit(1))).alias("coverage"))


def coverage_delta(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    b = before.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    return after.join(b, keys, "full").select(*keys, *[(F.coalesce(c, F.lit(0)) - F.coalesce(f"__{c}", F.lit(0))).alias(f"{c}_delta") for c in columns])


def rollup_status(complete: Column, total: Column, errors: Column) -> Column:
    return F.when(total == 0, "skipped").when(complete == total, "complete").when(errors == total, "error").otherwise("partial")


def manifest(universe: DataFrame, states: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """How many of a universe are in each category, and which categories are to be refreshed."""
    joined = universe.select(key).distinct().join(states, key, "left").withColumn("category", F.coalesce("category", F.lit("missing")))
    return joined.groupBy("category").agg(F.count(F.lit(1)).alias("n")).withColumn("refresh", F.col("category").isin(*wanted, "missing"))


def registry_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """What changed between two states (key, addresses, goods, history): sets are compared, not lists."""
    b = before.select(key, *[normal_set(F.col(c)).alias(f"b_{c}") for c in ("addresses", "goods")], F.size("history").alias("b_n"))
    a = after.select(key, *[normal_set(F.col(c)).alias(f"a_{c}") for c in ("addresses", "goods")], F.size("history").alias("a_n"))
    same_a, same_g = F.col("b_addresses") == F.col("a_addresses"), F.col("b_goods") == F.col("a_goods")
    kind = F.when(F.col("b_n").isNull(), "added").when(F.col("a_n").isNull(), "removed").when(~same_a, "address").when(~same_g, "goods").when(F.col("a_n") > F.col("b_n"), "history").otherwise("unchanged")
    return b.join(a, key, "full").select(key, kind.alias("change"))


def merge_improved(old: DataFrame, new: DataFrame, key: str, improved: Column) -> DataFrame:
    """The old entries, replaced by new ones where these are improved, and new keys added. ``improved`` sees old columns
    and new ones as new_*."""
    n = new.select(F.col(key), *[F.col(c).alias(f"new_{c}") for c in new.columns if c != key], F.lit(True).alias("__new"))
    joined = old.withColumn("__old", F.lit(True)).join(n, key, "full")
    take = F.col("__old").isNull() | (F.coalesce(F.col("__new"), F.lit(False)) & F.coalesce(improved, F.lit(False)))
    return joined.select(key, *[F.when(take, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in old.columns if c != key], take.alias("replaced"))


def merge_hits(old: DataFrame, new: DataFrame, keys: list[str], hit: str, rank: Column, cap: int) -> DataFrame:
    """Old and new hits of each key, one of each number: the status of the higher rank, never a lower one; old hits keep
    their places first; at most ``cap``."""
    both = old.withColumn("fresh", F.lit(0)).unionByName(new.withColumn("fresh", F.lit(1)))
    one = dealt(both, *keys, hit).groupBy(*keys, hit).agg(F.min("fresh").alias("fresh"), F.max_by("status", rank).alias("status"))
    return one.withColumn("pos", F.row_number().over(W.partitionBy(*keys).orderBy("fresh", hit))).filter(F.col("pos") <= cap)


def budgeted(df: DataFrame, cached: DataFrame, key: str, order: list[str], budget: int) -> DataFrame:
    """All keys that are cached, and the first ``budget`` of the others."""
    flagged = df.join(cached.select(key).distinct().withColumn("cached", F.lit(True)), key, "left").withColumn("cached", F.coalesce("cached", F.lit(False)))
    open_rows = flagged.filter("not cached").orderBy(*order).limit(budget)
    return flagged.filter("cached").unionByName(open_rows)


def expand_facts(entries: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Entries with the facts of their query; an entry without facts stays."""
    return entries.join(facts, key, "left")


def evidence_expansion(items: DataFrame, evidence: DataFrame, key: str, place: str, nationwide: str) -> DataFrame:
    """One row for each region that evidence names, and one nationwide row where there is none."""
    return items.join(evidence, key, "left").withColumn(place, F.coalesce(place, F.lit(nationwide)))


def link_evidence(rows: DataFrame, aliases: DataFrame, catalog: DataFrame, key: str = "name") -> DataFrame:
    """Rows linked to a catalog by alias, then by name; what isn't linked is kept and marked."""
    a = rows.join(checked_broadcast(aliases), key, "left")
    c = catalog.select(F.col(key).alias("__c")).distinct()
    return a.withColumn("__t", F.coalesce("target", key)).join(c, F.col("__t") == F.col("__c"), "left").select(
        *rows.columns, F.col("__c").alias("linked"), F.when(F.col("__c").isNull(), "unmatched").when(F.col("target").isNotNull(), "alias").otherwise("exact").alias("link")
    )
