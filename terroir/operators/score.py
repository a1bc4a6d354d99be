"""Gap scores, rankings, alerts and run warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.functions.values import rounded, safe_rate
from terroir.operators.common import numbered

#: Weights, saturation and thresholds of the gap score.
ACTIVITY_WEIGHT, REGISTRATION_WEIGHT, SATURATION, REPRESENTATIVE, LOW_CONVERSION = 0.7, 0.3, 5, 3, 0.3


def metric_available(availability: Column, verification_rate: Column) -> Column:
    """Available is, blocked isn't; anything else goes by the verification rate, of which null counts as complete."""
    return F.when(availability == "available", True).when(availability == "blocked", False).otherwise(F.coalesce(verification_rate == 1, F.lit(True)))


def gap_score(n: Column, rate: Column, flagged: Column, availability: Column, verification_rate: Column, threshold: int = REPRESENTATIVE) -> list[Column]:
    """representative (null if it can't be told), gap_score, score_availability, low_conversion."""
    usable = metric_available(availability, verification_rate)
    representative = F.when(usable, flagged | (n >= threshold)).otherwise(F.when(flagged, True))
    used = F.lit(ACTIVITY_WEIGHT) * F.least(F.lit(1.0), n / F.lit(float(SATURATION))) + F.lit(REGISTRATION_WEIGHT) * F.coalesce(rate, F.lit(0.0))
    return [
        representative.alias("representative"),
        F.when(usable & representative, rounded(1 - used, 4)).alias("gap_score"),
        F.when(~usable, "blocked").when(representative, "preview").otherwise("not_applicable").alias("score_availability"),
        (usable & (n >= SATURATION) & F.coalesce(rate < LOW_CONVERSION, F.lit(False))).alias("low_conversion"),
    ]


def gap_counters(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("buckets"), F.count_if(F.col("score_availability") == "blocked").alias("blocked"),
        F.count_if(~F.col("representative")).alias("not_representative"), F.count_if("low_conversion").alias("low_conversion"),
    )


def gap_ranking(scored: DataFrame) -> DataFrame:
    rows = scored.filter(F.col("representative") & F.col("gap_score").isNotNull())
    return numbered(rows, [F.desc("gap_score"), F.col("region"), F.col("item")]).select("rank", "region", "item", "n", "gap_score")


def top(df: DataFrame, order: list[Column], k: int, name: str = "place") -> DataFrame:
    """The first ``k`` rows with their place; the sort keeps k rows of each partition only."""
    return df.orderBy(*order).limit(k).withColumn(name, F.row_number().over(W.orderBy(*order)).cast("long"))


def ordinal_sort(df: DataFrame, column: str, ranks: dict[str, int], then: list[str], rest: int = 9) -> DataFrame:
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[F.col(column)], F.lit(rest))
    return numbered(df, [rank, *map(F.col, then)], "place")


def capped(df: DataFrame, keys: list[str], order: list[str], cap: int) -> DataFrame:
    """The first ``cap`` rows of each key in order, with their place and the count before the cut."""
    w = W.partitionBy(*keys)
    return df.withColumn("total", F.count(F.lit(1)).over(w)).withColumn("pos", F.row_number().over(w.orderBy(*order))).filter(F.col("pos") <= cap).withColumn("cap", F.lit(cap))


def set_differences(a: DataFrame, b: DataFrame, only_a: str, only_b: str) -> DataFrame:
    """Rows of one side only, with the side."""
    return a.join(b, a.columns, "left_anti").withColumn("side", F.lit(only_a)).unionByName(b.join(a, a.columns, "left_anti").withColumn("side", F.lit(only_b)))


def goods_counts(method: str) -> list[Column]:
    m = F.col(method)
    return [
        F.count_if(m == "normalized_exact").alias("confirmed"), F.count_if(m.isin("normalized_contains", "class_only")).alias("review"),
        F.count_if(m == "mismatch").alias("mismatch"), safe_rate(F.count_if(m != "unverified"), F.count(F.lit(1))).alias("evaluated_rate"),
    ]


def warnings(totals: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row for each counter above zero: 'label:count'."""
    found = [F.when(F.col(c) > 0, F.concat_ws(":", F.lit(label), F.col(c).cast("string"))) for label, c in rules.items()]
    return totals.select(F.explode(F.array_compact(F.array(*found))).alias("warning"))


def alert_kind(unclaimed: Column, low_conversion: Column) -> Column:
    return F.when(unclaimed, "unclaimed").when(low_conversion, "low_conversion")
