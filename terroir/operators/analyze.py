"""Aggregation of activity records to buckets, at several levels, with explicit completeness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.functions.values import safe_rate
from terroir.operators.common import dealt, written


def first_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order (ties must be ordered too)."""
    return dealt(df, *keys).withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def record_key(app: Column, reg: Column, *rest: Column) -> Column:
    """app:, else reg:, else fallback: identity of a record; only white space is dropped from numbers."""
    strip = lambda c: F.nullif(F.regexp_replace(c.cast("string"), r"\s", ""), F.lit(""))
    loose = F.concat_ws("|", *[F.trim(F.coalesce(c.cast("string"), F.lit(""))) for c in rest])
    return F.coalesce(F.concat(F.lit("app:"), strip(app)), F.concat(F.lit("reg:"), strip(reg)), F.concat(F.lit("fallback:"), loose))


def status_counts(status: str = "status", where: Column | None = None, prefix: str = "") -> list[Column]:
    """Counts by status and the rate of registered ones."""
    on = F.lit(True) if where is None else where
    n = {s: F.count_if(on & (F.col(status) == s)) for s in ("registered", "pending", "inactive", "unknown")}
    return [c.alias(f"{prefix}{s}") for s, c in n.items()] + [safe_rate(n["registered"], F.count_if(on)).alias(f"{prefix}registration_rate")]


def relation_counts(relation: str = "relation") -> list[Column]:
    """Counts inside, outside and unverified, the verified count and its rate, and the local share."""
    n = {r: F.count_if(F.col(relation) == r) for r in ("inside", "outside", "unverified")}
    known = n["inside"] + n["outside"]
    return [c.alias(r) for r, c in n.items()] + [
        known.alias("verified"), safe_rate(known, F.count(F.lit(1))).alias("verification_rate"), safe_rate(n["inside"], known).alias("local_share")
    ]


def rollup_distinct(records: DataFrame, levels: dict[str, list[str]], key: str, order: list[str]) -> DataFrame:
    """Distinct records at each level, re-deduplicated there: level, the level's keys, n, inside.

    Records are deduplicated once at the finest level (the first in ``levels``); the coarser levels start from its
    survivors, which hold a record of every key and are written once, so only the first shuffle carries all rows.
    """
    finest = next(iter(levels.values()))
    base = written(first_wins(records.select(*{*finest, key, *order, "relation"}), [*finest, key], order))
    parts = []
    for name, keys in levels.items():
        rows = base if keys == finest else first_wins(base, [*keys, key], [*finest, *order])
        cells = [(F.col(k) if k in keys else F.lit("all")).alias(k) for k in finest]
        parts.append(rows.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("relation") == "inside").alias("inside")).select(F.lit(name).alias("level"), *finest, "n", "inside"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def availability(successful: Column, partial: Column, errored: Column, skipped: Column, queries: Column, threshold: float = 1.0) -> Column:
    """available, partial (only a cap stands in the way) or blocked."""
    clean = (successful > 0) & (errored == 0) & (skipped == 0)
    rate = F.when(queries > 0, (successful - partial) / queries).otherwise(0.0)
    return F.when(clean & (rate >= threshold), "available").when(clean, "partial").otherwise("blocked")


def histogram(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """A map from value to count for each key, in order of values; null values are left out."""
    long = df.withColumn("__v", value).filter("__v is not null").groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    return long.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__v", "__n")))).alias(name))


def period_comparison(year: Column, now: int, span: int) -> list[Column]:
    """Counts of the last ``span`` full years and of those before; the change, its rate and a label."""
    recent, previous = F.count_if(year.between(now - span, now - 1)), F.count_if(year.between(now - 2 * span, now - span - 1))
    change = recent - previous
    return [
        recent.alias("recent"), previous.alias("previous"), change.alias("change"), safe_rate(change, previous).alias("change_rate"),
        F.when(change > 0, "up").when(change < 0, "down").otherwise("flat").alias("trend"),
    ]


def summed_override(items: DataFrame, parts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Coarse rows whose columns are replaced by the sums over their parts."""
    sums = parts.groupBy(*keys).agg(*[F.sum(c).alias(f"__{c}") for c in columns])
    out = items.join(sums, keys, "left")
    return out.select(*[F.coalesce(f"__{c}", F.lit(0)).alias(c) if c in columns else c for c in items.columns])


def ranked_examples(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key, numbered from 1."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= n)


#: Pieces into which a key's rows are dealt, each of which passes on what may be an example.
PIECES = 64


def tiered_examples(df: DataFrame, keys: list[str], key: str, registered_inside: Column, evidence: Column, date: str, limit: int, evidenced: int = 3) -> DataFrame:
    """Registered local records first, then a few by evidence, then the most recent; without repeats, newest first.

    A key's rows are dealt into pieces first. A piece passes on its first row by registration, its first ``evidenced`` by
    evidence, and of its latest as many as are examples even where all of these come before them; every other row has
    enough rows of its own piece before it in each order.
    """
    registered, evident, recent = [F.desc(registered_inside.cast("int")), F.desc(date), F.col(key)], [F.desc(evidence), F.desc(date), F.col(key)], [F.desc(date), F.col(key)]
    piece = W.partitionBy(*keys, "__piece")
    numbers = {"__a": (registered, 1), "__b": (evident, evidenced), "__c": (recent, limit + 1 + evidenced)}
    dealt_rows = dealt(df.withColumn("__piece", F.pmod(F.xxhash64(key), F.lit(PIECES))), *keys, "__piece")
    placed = dealt_rows.withColumns({n: F.row_number().over(piece.orderBy(*order)) for n, (order, _) in numbers.items()})
    df = placed.filter(reduce(lambda x, y: x | y, [F.col(n) <= k for n, (_, k) in numbers.items()])).drop(*numbers, "__piece")
    by = W.partitionBy(*keys)
    first, second = F.row_number().over(by.orderBy(*registered)), F.row_number().over(by.orderBy(*evident))
    tier = F.when(registered_inside & (F.col("__a") == 1), 0).when((evidence > 0) & (F.col("__b") <= evidenced), 1).otherwise(2)
    tiered = df.withColumn("__a", first).withColumn("__b", second).withColumn("tier", tier)
    chosen = ranked_examples(tiered, keys, [F.col("tier"), F.desc(date), F.col(key)], limit).drop("rank", "__a", "__b")
    return ranked_examples(chosen, keys, [F.desc(date), F.col(key)], limit)
