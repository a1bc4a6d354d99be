"""Resolution of free-text places against a region master, and relations between regions.

A text goes through rungs; the first rung that finds candidates wins, and ambiguity is kept, not guessed. Only
distinct texts are resolved. Masters and alias tables are rule tables of checked size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.functions.text import compact, region_code
from terroir.operators.common import checked_broadcast, contained


def by_code(texts: DataFrame, master: DataFrame, successors: DataFrame | None = None) -> DataFrame:
    """Equality of codes, in the long form of ten digits where they have five or ten, after replaced codes (old, new)
    are mapped to their successors: text, region, province. A code that several masters have finds none."""
    long = lambda c: F.coalesce(F.nullif(region_code(F.col(c)), F.lit("")), F.col(c))
    coded = texts.filter(F.coalesce("code", F.lit("")) != "").withColumn("code", long("code"))
    if successors is not None:
        moved = successors.select(long("old").alias("code"), long("new").alias("new")).distinct()
        coded = coded.join(moved, "code", "left").withColumn("code", F.coalesce("new", "code")).drop("new")
    known = master.select(long("code").alias("code"), "region", "province").distinct()
    single = known.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.first("region").alias("region"), F.first("province").alias("province")).filter("n = 1")
    return coded.join(single, "code").select("text", "region", "province")


def by_alias(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    """Equality of the whole compacted text with an alias (alias, region, province)."""
    return texts.withColumn("alias", compact(F.col("text"))).join(checked_broadcast(aliases.withColumn("alias", compact(F.col("alias")))), "alias").select("text", "region", "province")


def by_longest_name(texts: DataFrame, master: DataFrame) -> DataFrame:
    """Names contained in the text; of these the longest, ties kept."""
    found = contained(texts.select("text"), "text", master.select("region", "province"), "region")
    return found.withColumn("r", F.rank().over(W.partitionBy("text").orderBy(F.desc(F.length("region"))))).filter("r = 1").select("text", "region", "province")


def by_successor(texts: DataFrame, aliases: DataFrame, master: DataFrame) -> DataFrame:
    """Former names contained in the text, as the region of today."""
    now = aliases.join(master, "region").select("former", "region", "province")
    return contained(texts, "text", now, "former").select("text", "region", "province").distinct()


def by_stem(texts: DataFrame, master: DataFrame, ending: str) -> DataFrame:
    """Equality with a name without its ending, alone or after its province; the longest wins."""
    stem = F.regexp_replace("region", ending, "")
    keys = master.select("region", "province", F.explode(F.array(compact(stem), compact(F.concat("province", stem)))).alias("stem"))
    found = texts.withColumn("stem", compact(F.col("text"))).join(checked_broadcast(keys), "stem")
    return found.withColumn("r", F.rank().over(W.partitionBy("text").orderBy(F.desc(F.length("stem"))))).filter("r = 1").select("text", "region", "province")


def by_province(texts: DataFrame, master: DataFrame) -> DataFrame:
    """A single province contained in the text; no region is told."""
    found = contained(texts, "text", master.select("province").distinct(), "province")
    one = found.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("text"))).filter("n = 1")
    return one.select("text", F.lit(None).cast("string").alias("region"), "province")


def resolve(texts: DataFrame, rungs: list[tuple[str, DataFrame]], provinces: DataFrame) -> DataFrame:
    """From distinct texts (text, ...): text, method, status, region, province, candidates.

    ``rungs``: candidates (text, region, province) of each method in order of trust. More than one candidate is
    narrowed by a province that the text names; what still differs within one province resolves to the province.
    """
    tagged = [c.select("text", "region", "province", F.lit(i).alias("rung"), F.lit(name).alias("method")) for i, (name, c) in enumerate(rungs)]
    every = reduce(DataFrame.unionByName, tagged).distinct()
    best = every.withColumn("least", F.min("rung").over(W.partitionBy("text"))).filter("rung = least")
    best = best.withColumn("named", F.contains("text", "province")).withColumn("any_named", F.max("named").over(W.partitionBy("text")))
    many = F.count(F.lit(1)).over(W.partitionBy("text")) > 1
    narrowed = best.withColumn("many", many).filter(~F.col("many") | ~F.col("any_named") | F.col("named"))
    folded = narrowed.groupBy("text").agg(
        F.min("method").alias("method"), F.array_sort(F.collect_set("region")).alias("regions"), F.array_sort(F.collect_set("province")).alias("provinces")
    )
    one, province = F.size("regions") == 1, F.size("provinces") == 1
    status = F.when(F.col("method").isNull(), "unresolved").when(one & province, "resolved").when(province, "province_only").otherwise("ambiguous")
    return texts.select("text").distinct().join(folded, "text", "left").select(
        "text", "method", status.alias("status"),
        F.when(one & province, F.get("regions", F.lit(0))).alias("region"), F.when(province, F.get("provinces", F.lit(0))).alias("province"), F.coalesce(F.size("regions"), F.lit(0)).alias("candidates"),
    )


def relation(region: Column, province: Column, other_region: Column, other_province: Column) -> list[Column]:
    """inside, outside or unverified, by the finest level that both have, and that level."""
    fine = region.isNotNull() & other_region.isNotNull()
    known = province.isNotNull() & other_province.isNotNull()
    return [
        F.when(~known, "unverified").when(province != other_province, "outside").when(fine & (region != other_region), "outside").otherwise("inside").alias("relation"),
        F.when(~known, "none").when(fine, "region").otherwise("province").alias("level"),
    ]


def fold_applicants(rows: Column, raw_item: Column) -> Column:
    """One relation from those of joint applicants (array of struct relation, producer).

    All alike: that one. A producers' body inside: inside. Anyone inside: inside unless the item is raw. Else outside
    if all are known, and unverified otherwise.
    """
    relations = F.array_distinct(F.transform(rows, lambda r: r["relation"]))
    return (
        F.when(F.size(rows) == 0, "unverified").when(F.size(relations) == 1, relations[0]).when(F.exists(rows, lambda r: r["producer"] & (r["relation"] == "inside")), "inside")
        .when(~raw_item & F.array_contains(relations, "inside"), "inside").when(~F.array_contains(relations, "unverified"), "outside").otherwise("unverified")
    )


def stored_or_evidence(evidence: Column, stored: Column) -> Column:
    """The relation by evidence, else by a stored flag and its synonyms."""
    word = F.lower(F.coalesce(stored, F.lit("")))
    return F.coalesce(evidence, F.when(word.isin("inside", "matched", "true", "y"), "inside").when(word.isin("outside", "mismatch", "false", "n"), "outside").otherwise("unverified"))


def unanimous(values: Column) -> Column:
    """The common value of an array, or unverified."""
    return F.when(F.size(F.array_distinct(values)) == 1, values[0]).otherwise("unverified")


def code_lookup(df: DataFrame, master: DataFrame, key: str = "region") -> DataFrame:
    """The code of a name if it has exactly one: region_code, code_status."""
    codes = master.groupBy(key).agg(F.array_sort(F.collect_set("code")).alias("codes"))
    n = F.coalesce(F.size("codes"), F.lit(0))
    return df.join(checked_broadcast(codes), key, "left").select(*df.columns, F.when(n == 1, F.col("codes")[0]).alias("region_code"), F.when(n == 0, "unresolved").when(n == 1, "resolved").otherwise("ambiguous").alias("code_status"))


__all__ = ["by_alias", "by_code", "by_longest_name", "by_province", "by_stem", "by_successor", "code_lookup", "fold_applicants", "region_code", "relation", "resolve", "stored_or_evidence", "unanimous"]
