"""Trends, leaderboards, cross-tabs and expansion questions over aggregated records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.functions.values import rounded, safe_rate
from terroir.operators.common import numbered, running, written


def moving_average(df: DataFrame, keys: list[str], year: str, value: str, span: int = 5) -> DataFrame:
    """Every year between the first and the last of a key, gaps as 0, with the trailing mean of up to ``span`` years."""
    bounds = df.groupBy(*keys).agg(F.min(year).alias("a"), F.max(year).alias("b"))
    spine = bounds.select(*keys, F.explode(F.sequence("a", "b")).alias(year))
    dense = spine.join(df, [*keys, year], "left").na.fill(0, [value])
    w = W.partitionBy(*keys).orderBy(year).rowsBetween(-(span - 1), 0)
    return dense.withColumn("mean", F.sum(value).over(w) / F.count(F.lit(1)).over(w))


def peak(df: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """The year of the largest value, the first of several."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(value), year))
    return df.withColumn("__k", place).filter("__k = 1").select(*keys, year, value)


def windows(month: Column, end: str, size: int) -> tuple[Column, Column]:
    """Whether a month (date of its first day) lies in the last ``size`` months up to ``end``, and in those before."""
    last = F.lit(end).cast("date")
    now = (month <= last) & (month > F.add_months(last, -size))
    return now, (month <= F.add_months(last, -size)) & (month > F.add_months(last, -2 * size))


def quantile_buckets(df: DataFrame, value: str, parts: int = 5) -> DataFrame:
    """value, bucket: how many of the nearest-rank breaks (row floor(n i / parts) from 0) are below the value. Values
    are counted first, so ranks are sums over distinct values."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__k"))
    ranked = written(running(counts, [F.col(value)], F.col("__k"), "__upto"))
    total = ranked.agg(F.max("__upto")).first()[0] or 0
    places = F.array(*[F.lit(total * i // parts).cast("long") for i in range(1, parts)])
    held = F.filter(places, lambda at: (at < F.col("__upto")) & (at >= F.col("__upto") - F.col("__k")))
    breaks = ranked.select(value, F.explode(held)).collect()  # parts - 1 rows at most
    below = [(F.lit(r[0]) < F.col(value)).cast("int") for r in breaks]
    return df.withColumn("bucket", reduce(Column.__add__, below, F.lit(0)))


def shares(df: DataFrame, group: list[str], value: str) -> DataFrame:
    return df.withColumn("share", safe_rate(F.col(value), F.sum(value).over(W.partitionBy(*group))))


def top_shares(df: DataFrame, group: list[str], name: str, value: str, k: int) -> DataFrame:
    """The k largest of each group, with their share of all."""
    s = shares(df, group, value)
    return s.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(F.desc(value), name))).filter(F.col("rank") <= k)


def with_other(df: DataFrame, group: list[str], name: str, value: str, k: int, other: str = "other") -> DataFrame:
    """The k largest of each group, and the rest as one."""
    r = df.withColumn("r", F.row_number().over(W.partitionBy(*group).orderBy(F.desc(value), name)))
    return r.groupBy(*group, F.when(F.col("r") <= k, F.col(name)).otherwise(other).alias(name)).agg(F.sum(value).alias(value))


def cross_tab(df: DataFrame, row: str, column: str, values: list[str], total: str = "all") -> DataFrame:
    """Counts of rows by columns, with totals of both."""
    c = df.cube(row, column).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    c = c.select(F.when(F.col("g").bitwiseAND(2) == 2, total).otherwise(F.col(row)).alias(row), F.when(F.col("g").bitwiseAND(1) == 1, total).otherwise(F.col(column)).alias(column), "n")
    return c.groupBy(row).pivot(column, [*values, total]).agg(F.first("n")).na.fill(0)


def leaderboard(df: DataFrame, keys: list[str], now: Column, before: Column, least: int) -> DataFrame:
    """recent, prior, whether new (hardly anything before) and growth; infinite growth of new ones sorts first."""
    g = df.groupBy(*keys).agg(F.count_if(now).alias("recent"), F.count_if(before).alias("prior"))
    new = F.col("prior") < F.greatest(F.lit(1.0), F.lit(least) / 3)
    g = g.withColumn("is_new", new).withColumn("growth", F.when(~F.col("is_new"), rounded((F.col("recent") - F.col("prior")) / F.col("prior"), 4)))
    return g.filter(F.col("recent") >= least)


def surging(board: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = [F.desc("is_new"), F.desc_nulls_first("growth"), F.desc("recent"), *map(F.col, keys)]
    return board.orderBy(*order).limit(k).withColumn("place", F.row_number().over(W.orderBy(*order)).cast("long"))


def expansion_index(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """What each key leads to: the sorted set of values and its size."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias(name)).withColumn("n", F.size(name))


def templates(df: DataFrame, item: str, goods: str, slot: str) -> DataFrame:
    """``df`` with a column ``template``: the goods with the item's name cut out, for goods that hold it and more. Goods in
    brackets say something of one place or material and make none."""
    shape = F.replace(F.col(goods), F.col(item), F.lit(slot))
    usable = (F.length(item) > 0) & F.contains(goods, item) & (shape != slot) & ~F.regexp_like(shape, F.lit(r"[()（）\[\]]"))
    return df.filter(usable).withColumn("template", shape)


def lacking(df: DataFrame, item: str, feature: str, order: list[Column], k: int) -> DataFrame:
    """For each item its first ``k`` features, of all features in a total ``order``, among those that it lacks: item,
    feature, users (items that have it), uses, place. ``order`` may name ``feature``, ``users`` and ``uses``.

    An item with h features finds its k among the first k + h: these places are joined by equality, so an item meets
    no more features than that.
    """
    uses = df.groupBy(item, feature).agg(F.count(F.lit(1)).alias("__uses"))
    every = uses.groupBy(feature).agg(F.count(F.lit(1)).alias("users"), F.sum("__uses").alias("uses"))
    ranked = numbered(every, order, "__at")
    wanted = uses.groupBy(item).agg(F.count(F.lit(1)).alias("__h")).withColumn("__at", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__h") + k)))
    found = wanted.join(ranked, "__at").join(uses.select(item, feature), [item, feature], "left_anti")
    place = F.row_number().over(W.partitionBy(item).orderBy("__at"))
    return found.withColumn("place", place).filter(F.col("place") <= k).select(item, feature, "users", "uses", "place")


def peer_gaps(df: DataFrame, item: str, peer: str, feature: str, least: int) -> DataFrame:
    """Features that at least ``least`` items of the same peer group have and an item lacks."""
    have = df.select(peer, item, feature).distinct()
    common = have.groupBy(peer, feature).agg(F.count(F.lit(1)).alias("users")).filter(F.col("users") >= least)
    wanted = have.select(peer, item).distinct().join(common, peer)
    return wanted.join(have, [peer, item, feature], "left_anti")


def suggestions(df: DataFrame, item: str, template: str, least: int, k: int, slot: str) -> DataFrame:
    """Templates that at least ``least`` items use, ranked, with the slot filled for each item that lacks them."""
    users = df.select(item, template).distinct().groupBy(template).agg(F.count(F.lit(1)).alias("users")).filter(F.col("users") >= least)
    ranked = users.orderBy(F.desc("users"), template).limit(k)
    each = df.select(item).distinct().join(F.broadcast(ranked))  # k rows
    return each.join(df.select(item, template).distinct(), [item, template], "left_anti").select(item, template, F.replace(F.col(template), F.lit(slot), F.col(item)).alias("goods"), "users")


def value_chain(df: DataFrame, keys: list[str], cls: str, first_service: int = 35) -> DataFrame:
    """The stages of each key by class number: bucket (goods or service), n, its classes, and the leading one."""
    counts = df.groupBy(*keys, F.when(F.col(cls) >= first_service, "service").otherwise("goods").alias("bucket"), F.col(cls).alias("class")).agg(F.count(F.lit(1)).alias("k"))
    leader = F.max(F.struct("k", (-F.col("class")).alias("less")))["less"]
    return counts.groupBy(*keys, "bucket").agg(F.sum("k").alias("n"), F.array_sort(F.collect_list("class")).alias("classes"), (-leader).alias("leader"))


def top_class_share(df: DataFrame, keys: list[str], cls: str) -> DataFrame:
    """The share of the most frequent class of each key: top_share."""
    counts = df.groupBy(*keys, cls).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg((F.max("n") / F.sum("n")).alias("top_share"))


def expansion_rules(raw: Column, processed: Column, service: Column, top_share: Column, recent: Column, prior: Column, most: int = 4) -> Column:
    """Labels of what an item's stages suggest, at most ``most``."""
    total = raw + processed + service
    rules = [
        F.when((service == 0) & (total > 0), "service_gap"), F.when((processed == 0) & (raw > 0), "processed_gap"), F.when(top_share >= 0.6, "class_concentration"),
        F.when((raw > 0) & (processed > 0) & (service > 0) & (top_share < 0.3), "cluster_split"), F.when(recent > prior * 1.5, "momentum"),
    ]
    found = F.array_compact(F.array(*rules))
    return F.slice(F.when(F.size(found) == 0, F.array(F.lit("balanced"))).otherwise(found), 1, most)


def unusual_examples(df: DataFrame, keys: list[str], title: str, core: Column, least: int, most: int) -> DataFrame:
    """For each key the shortest title that holds the core term, and of the others the longest one without it."""
    fit = df.filter(F.length(title).between(least, most)).withColumn("core", core)
    first = fit.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(F.col("core").cast("int")), F.length(title), title))).filter("n = 1").select(*keys, F.col(title).alias("representative"))
    rest = fit.join(first, keys).filter(F.col(title) != F.col("representative"))
    odd = rest.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy(F.col("core").cast("int"), F.desc(F.length(title)), title))).filter("n = 1").select(*keys, F.col(title).alias("unusual"))
    return first.join(odd, keys, "left")


def flow_terms(names: DataFrame, name: str) -> DataFrame:
    """Terms of item names: without brackets and prefix, split at '/'; a modifier goes if the last word is a term itself."""
    bare = F.trim(F.regexp_replace(F.col(name), r"\([^)]*\)", ""))
    terms = names.select(F.explode(F.split(bare, "/")).alias("t")).select(F.trim("t").alias("term")).filter("term <> ''").distinct()
    last = F.element_at(F.split("term", " "), -1)
    known = terms.select(F.col("term").alias("last")).distinct()
    many = terms.withColumn("last", last).join(known.withColumn("hit", F.lit(True)), "last", "left")
    return many.select(F.when(F.col("hit"), F.col("last")).otherwise(F.col("term")).alias("term")).distinct()
