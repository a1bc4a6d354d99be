"""Summaries of plans, runs, documents and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def plan_summary(rows: DataFrame, searchable: Column, query: Column, pages: int, cap: int) -> DataFrame:
    """One row: rows to be searched and skipped, distinct queries among them, repeats, and requests at least and at
    most, of ``pages`` pages a query and ``cap`` in all."""
    n, unique = F.count_if(searchable), F.count_distinct(F.when(searchable, query))
    return rows.agg(
        n.alias("searchable"), unique.alias("unique_queries"), (n - unique).alias("duplicates"), F.count_if(~searchable).alias("skipped"),
        unique.alias("min_requests"), F.least(unique * pages, F.lit(cap)).alias("max_requests"),
    )


def top_per_group(df: DataFrame, group: list[str], name: str, sample: str, k: int) -> DataFrame:
    """The ``k`` most frequent names of each group, with their number and their smallest ``sample``."""
    g = df.groupBy(*group, name).agg(F.count(F.lit(1)).alias("n"), F.min(sample).alias("sample"))
    return g.withColumn("k", F.row_number().over(W.partitionBy(*group).orderBy(F.desc("n"), name))).filter(F.col("k") <= k).drop("k")


def signal_confidence(df: DataFrame, keys: list[str], by: str, low: int = 20, medium: int = 100) -> DataFrame:
    """n and confidence of each key: low if one ``by`` has a ``low``-th of the rows or more, medium if a ``medium``-th."""
    g = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("n")).groupBy(*keys).agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    return g.withColumn("confidence", F.when(F.col("top") * low >= F.col("n"), "low").when(F.col("top") * medium >= F.col("n"), "medium").otherwise("high")).drop("top")


def supplemental_summary(df: DataFrame, extra: DataFrame, query: str, by: list[str]) -> DataFrame:
    """Rows and distinct queries by ``by``, of the queries that a supplement names."""
    return df.join(extra.select(query), query, "left_semi").groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(query).alias("queries"))


def with_totals(df: DataFrame, group: list[str], name: str, aggregates: list[Column], total: str = "all") -> DataFrame:
    """Aggregates by group and name, and by group alone under the name ``total``, in one pass over the rows."""
    g = df.groupingSets([group, [*group, name]], *group, name).agg(*aggregates, F.grouping(name).alias("__all"))
    return g.withColumn(name, F.when(F.col("__all") == 1, F.lit(total)).otherwise(F.col(name))).drop("__all")


def document_counters(df: DataFrame, state: Column, query: Column) -> DataFrame:
    """One row: entries by state, and distinct queries, all and partial ones."""
    return df.agg(
        F.count_if(state == "registered").alias("success"), F.count_if(state == "pending").alias("partial"), F.count_if(state == "inactive").alias("error"),
        F.count_distinct(query).alias("unique_queries"), F.count_distinct(F.when(state == "pending", query)).alias("unique_partial"),
    )


def selection_report(df: DataFrame, matched: Column, limit: int) -> DataFrame:
    """One row: all, matched and selected rows, and whether the limit cut some off."""
    m = F.count_if(matched)
    return df.agg(F.count(F.lit(1)).alias("total"), m.alias("matched"), F.least(m, F.lit(limit)).alias("selected"), (m > limit).alias("truncated"))


def run_log(df: DataFrame, source: Column, failed: Column) -> DataFrame:
    """Rows and errors of each source, and how its run ended."""
    n, bad = F.count(F.lit(1)), F.count_if(failed)
    status = F.when(bad == 0, "success").when(bad < n, "partial").otherwise("failed")
    return df.groupBy(source.alias("source")).agg(n.alias("n"), bad.alias("errors"), status.alias("status"))


def strip_merged(df: DataFrame, sources: str, merged: list[str]) -> DataFrame:
    """Rows without the sources that were merged in; rows that had no others go."""
    own = F.filter(F.array_compact(sources), lambda s: ~s.isin(merged))
    return df.withColumn(sources, own).filter(F.size(sources) > 0)


def province_stats(df: DataFrame, by: list[str], official: Column, item: str) -> DataFrame:
    """Records, official ones and distinct items of each key."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(official).alias("official"), F.count_distinct(item).alias("items"))
