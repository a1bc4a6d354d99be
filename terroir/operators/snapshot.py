"""Snapshots: assembly, comparison with the one before, audit, and the archive of versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.operators.common import checked_broadcast


def assemble(items: DataFrame, gaps: DataFrame, briefings: DataFrame, keys: list[str]) -> DataFrame:
    return items.join(gaps, keys, "left").join(briefings, keys, "left")


def orphans(items: DataFrame, others: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Rows of other tables that no item has: source, keys."""
    return reduce(DataFrame.unionByName, [d.select(*keys).distinct().join(items.select(*keys), keys, "left_anti").select(F.lit(n).alias("source"), *keys) for n, d in others.items()])


def category_lookup(items: DataFrame, confirmed: DataFrame, proposed: DataFrame, prefix: str) -> DataFrame:
    """The category by notice, by item, by the item without its prefix, and then as proposed; whether it is provisional."""
    c, p = checked_broadcast(confirmed), checked_broadcast(proposed)
    one = items.join(c.select(F.col("name").alias("notice"), F.col("category").alias("k1")), "notice", "left").join(c.select(F.col("name").alias("item"), F.col("category").alias("k2")), "item", "left")
    bare = one.withColumn("bare", F.regexp_replace("item", prefix, ""))
    two = bare.join(c.select(F.col("name").alias("bare"), F.col("category").alias("k3")), "bare", "left").join(p.select(F.col("name").alias("bare"), F.col("category").alias("k4")), "bare", "left")
    sure = F.coalesce("k1", "k2", "k3")
    return two.select(*items.columns, F.coalesce(sure, "k4").alias("category"), (sure.isNull() & F.col("k4").isNotNull()).alias("provisional"))


def drop_excluded(tables: list[DataFrame], exclusions: DataFrame, key: str) -> list[DataFrame]:
    e = checked_broadcast(exclusions.select(key).distinct())
    return [t.join(e, key, "left_anti") for t in tables]


def badges(items: DataFrame, references: DataFrame, key: str, separators: str) -> DataFrame:
    """The first reference (by order) one of whose name variants is the item's name."""
    v = references.select("tier", "ord", F.explode(F.array_distinct(F.transform(F.split("names", separators), lambda x: F.trim(x)))).alias(key)).filter(F.col(key) != "")
    best = v.groupBy(key).agg(F.min_by("tier", "ord").alias("badge"))
    return items.join(checked_broadcast(best), key, "left")


def masked_join(items: DataFrame, facts: DataFrame, key: str, masked: list[str], shown: Column) -> DataFrame:
    """Left join whose ``masked`` columns show only where ``shown`` holds."""
    j = items.join(facts, key, "left")
    return j.select(*[F.when(shown, F.col(c)).alias(c) if c in masked else c for c in j.columns])


def fill_from(rows: DataFrame, detail: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Blank columns filled from a detail table."""
    d = detail.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    return rows.join(d, key, "left").select(*[F.coalesce(F.nullif(F.trim(c), F.lit("")), f"__{c}").alias(c) if c in columns else c for c in rows.columns])


def boundary_check(targets: DataFrame, shapes: DataFrame, children: DataFrame) -> DataFrame:
    """issue, code: targets without a shape (a parent counts as drawn if all of its children are), and shapes without
    a target."""
    drawn = children.join(shapes.withColumnRenamed("code", "child").withColumn("here", F.lit(True)), "child", "left").groupBy("code").agg(F.every(F.col("here").isNotNull()).alias("all")).filter("all").select("code")
    missing = targets.join(shapes.union(drawn).distinct(), "code", "left_anti")
    known = targets.union(children.select(F.col("child").alias("code")))
    return missing.select(F.lit("missing").alias("issue"), "code").unionByName(shapes.join(known, "code", "left_anti").select(F.lit("extra").alias("issue"), "code"))


def reconcile(previous: DataFrame, current: DataFrame, keys: list[str], metrics: list[str], tombstones: DataFrame, revive_limit: int, years: list[str] | None = None, carried: list[str] | None = None) -> DataFrame:
    """Keys of both snapshots; metrics never fall; keys that went missing come back unless they have a tombstone, and
    none does if more than ``revive_limit`` would (blocked). A metric that is null on one side isn't available there,
    and the other side's value stands. ``years``: columns of maps by year, no year of which falls; ``carried``: columns
    that keep their previous value where the current one is null."""
    years, carried = years or [], carried or []
    p = previous.select(*keys, *[F.col(m).alias(f"p_{m}") for m in (*metrics, *years, *carried)], F.lit(True).alias("in_p"))
    c = current.select(*keys, *[F.col(m).alias(f"c_{m}") for m in (*metrics, *years, *carried)], F.lit(True).alias("in_c"))
    dead = checked_broadcast(tombstones.select(*keys).distinct().withColumn("dead", F.lit(True)))
    j = p.join(c, keys, "full").join(dead, keys, "left")
    action = F.when(F.col("in_c").isNotNull(), F.when(F.col("in_p").isNull(), "new").otherwise("kept")).when(F.col("dead"), "dropped").otherwise("revived")
    j = j.withColumn("action", action)
    revived = j.agg(F.count_if(F.col("action") == "revived").alias("revived"))
    j = j.crossJoin(F.broadcast(revived))  # a single row
    return j.filter(F.col("action") != "dropped").select(*keys, *[F.greatest(f"p_{m}", f"c_{m}").alias(m) for m in metrics], *[map_max(F.col(f"p_{y}"), F.col(f"c_{y}")).alias(y) for y in years], *[F.coalesce(f"c_{x}", f"p_{x}").alias(x) for x in carried], F.when((F.col("action") == "revived") & (F.col("revived") > revive_limit), "blocked").otherwise(F.col("action")).alias("action"))


def missing_keys(previous: DataFrame, current: DataFrame, keys: list[str], tombstones: DataFrame, name: str, place: str, specialty: str, excluded: Column, nationwide: Column) -> DataFrame:
    """keys, reason of every key of ``previous`` that ``current`` lacks, the first of these that holds: tombstone (it was
    removed on purpose), excluded (its name is no item any more), relocated (a ``nationwide`` row whose name is now
    somewhere), renamed (its specialty is in its place under another key); else revived, missing by accident.

    ``excluded`` and ``nationwide`` are conditions on rows of ``previous``. Each reason is an equi-join with the keys that
    explain it; null names and specialties explain nothing.
    """
    lost = previous.withColumns({"__excluded": F.coalesce(excluded, F.lit(False)), "__nationwide": F.coalesce(nationwide, F.lit(False))}).join(current.select(*keys), keys, "left_anti")
    told = lambda df, *columns: df.select(*columns).distinct().withColumn(f"__{columns[-1]}_is_there", F.lit(True))
    buried = tombstones.select(*keys).distinct().withColumn("__buried", F.lit(True))
    marked = lost.join(buried, keys, "left").join(told(current, name), name, "left").join(told(current, place, specialty), [place, specialty], "left")
    reason = F.when(F.col("__buried"), "tombstone").when(F.col("__excluded"), "excluded").when(F.col("__nationwide") & F.col(f"__{name}_is_there"), "relocated").when(F.col(f"__{specialty}_is_there"), "renamed").otherwise("revived")
    return marked.select(*keys, reason.alias("reason"))


def reconcile_report(previous: DataFrame, current: DataFrame, keys: list[str], metric: str, missing: DataFrame, revive_limit: int, upgraded: str | None = None) -> DataFrame:
    """One row of counts: added, retained, floor_retained (kept keys whose metric would have fallen), upgraded (those
    that may fall, by the column ``upgraded`` of ``current``), one for each reason of ``missing``, and blocked."""
    now = current.select(*keys, F.col(metric).alias("__now"), (F.col(upgraded) if upgraded else F.lit(False)).alias("__upgraded"), F.lit(True).alias("__in_now"))
    both = previous.select(*keys, F.col(metric).alias("__before"), F.lit(True).alias("__in_before")).join(now, keys, "full")
    kept, falls = F.col("__in_now") & F.col("__in_before"), F.coalesce(F.col("__now") < F.col("__before"), F.lit(False))
    own = both.agg(
        F.count_if(F.col("__in_before").isNull()).alias("added"), F.count_if(kept).alias("retained"), F.count_if(kept & falls & ~F.coalesce("__upgraded", F.lit(False))).alias("floor_retained"),
        F.count_if(kept & falls & F.coalesce("__upgraded", F.lit(False))).alias("upgraded"),
    )
    reasons = missing.agg(*[F.count_if(F.col("reason") == r).alias(r) for r in ("tombstone", "excluded", "relocated", "renamed", "revived")])
    return own.crossJoin(F.broadcast(reasons)).withColumn("blocked", F.col("revived") > revive_limit)  # one row each


#: Parts of the keys that two tables are compared by before any rows are.
DIGESTS = 1024


def digests(df: DataFrame, keys: list[str], parts: int = DIGESTS) -> DataFrame:
    """part (of the keys, by hash), n, a, b: the number of rows and two sums of row hashes of each part, whatever the
    order of rows. The columns are taken by name."""
    columns = sorted(df.columns)
    hashed = df.select(F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias("part"), F.xxhash64(*columns).cast("decimal(20,0)").alias("a"), F.xxhash64(F.lit("b"), *columns).cast("decimal(20,0)").alias("b"))
    return hashed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def table_difference(before: DataFrame, after: DataFrame, keys: list[str], parts: int = DIGESTS) -> DataFrame:
    """keys, change: added, removed or changed, of two tables with the same columns, whose keys are unique.

    Each table is first read once into ``parts`` digests, which are compared; only rows of the parts that differ (a
    list of ``parts`` numbers at most) are joined. Equal tables are thus told without a join of their rows. Rows that
    differ are missed only if both 64-bit sums of a part agree by chance. Null keys are keys. Maps can't be hashed.
    """
    one, two = digests(before, keys, parts), digests(after, keys, parts).toDF("part", "n2", "a2", "b2")
    same = (F.col("n") == F.col("n2")) & (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2"))
    differ = [r["part"] for r in one.join(two, "part", "full").filter(~F.coalesce(same, F.lit(False))).select("part").collect()]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in before.select(*keys).schema)
    if not differ:
        return before.sparkSession.createDataFrame([], f"{fields}, change string")

    def side(df: DataFrame, name: str) -> DataFrame:
        part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
        return df.filter(part.isin(differ)).select(F.struct(*keys).alias("key"), F.xxhash64(*sorted(df.columns)).alias(f"{name}_a"), F.xxhash64(F.lit("b"), *sorted(df.columns)).alias(f"{name}_b"))

    both = side(before, "old").join(side(after, "new"), "key", "full")
    equal = (F.col("old_a") == F.col("new_a")) & (F.col("old_b") == F.col("new_b"))
    change = F.when(F.col("old_a").isNull(), "added").when(F.col("new_a").isNull(), "removed").when(~equal, "changed")
    return both.select("key.*", change.alias("change")).filter("change is not null")


def map_max(a: Column, b: Column) -> Column:
    """Union of two maps; of values under one key the larger."""
    return F.map_zip_with(F.coalesce(a, F.create_map().cast("map<int,bigint>")), F.coalesce(b, F.create_map().cast("map<int,bigint>")), lambda k, x, y: F.greatest(x, y))


def archive_upsert(records: DataFrame, versions: DataFrame, batch: DataFrame, run: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records (key, hash, version, last_run), versions (key, version, hash, payload) and counts by action, after a
    batch (key, hash, payload), one row a key.

    A new key is inserted as version 1; an unchanged one is touched; changed content gets the next version, or the
    old number where the content was there before (so a version may go down).
    """
    b = batch.select("key", F.col("hash").alias("new_hash"), "payload")
    known = versions.select("key", F.col("hash").alias("new_hash"), F.col("version").alias("old_version"))
    top = versions.groupBy("key").agg(F.max("version").alias("top"))
    j = records.join(b, "key", "full").join(known, ["key", "new_hash"], "left").join(top, "key", "left")
    action = (
        F.when(F.col("new_hash").isNull(), "absent").when(F.col("hash").isNull(), "inserted").when(F.col("hash") == F.col("new_hash"), "unchanged").when(F.col("old_version").isNotNull(), "reverted").otherwise("updated")
    )
    version = F.when(action.isin("absent", "unchanged"), F.col("version")).otherwise(F.coalesce("old_version", F.coalesce("top", F.lit(0)) + 1))
    done = j.withColumn("action", action).withColumn("now", version)
    after = done.select("key", F.coalesce("new_hash", "hash").alias("hash"), F.col("now").alias("version"), F.when(F.col("action") == "absent", F.col("last_run")).otherwise(F.lit(run)).alias("last_run"))
    added = done.filter(F.col("action").isin("inserted", "updated")).select("key", F.col("now").alias("version"), F.col("new_hash").alias("hash"), "payload")
    return after, versions.unionByName(added), done.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def current_view(records: DataFrame, versions: DataFrame) -> DataFrame:
    return records.select("key", "version").join(versions, ["key", "version"])


def high_water(metrics: DataFrame, marks: DataFrame, tolerance: float) -> DataFrame:
    """metric, value, mark, state, next: a fall beyond the tolerance is a violation, a smaller one a warning."""
    v, m = F.col("value"), F.coalesce("mark", F.lit(0))
    state = F.when(v < m * (1 - tolerance), "violation").when(v < m, "warning").otherwise("ok")
    return metrics.join(marks, "metric", "left").select("metric", "value", m.alias("mark"), state.alias("state"), F.greatest(v, m).alias("next"))


def audit(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """code, key of every broken rule, and of keys that stand more than once."""
    key = F.concat_ws("/", *keys)
    broken = df.select(F.explode(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for code, c in rules.items()]))).alias("code"), key.alias("key"))
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit("duplicate_key").alias("code"), key.alias("key"))
    return broken.unionByName(twice)


def merge_catalog(parts: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """One row a key with the last value that isn't blank of each column."""
    return parts.groupBy(key).agg(*[F.max_by(c, F.when(F.nullif(F.trim(c), F.lit("")).isNotNull(), F.col(order))).alias(c) for c in columns])


def nested_groups(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Items of each group as a list, by falling value and then name."""
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("neg"), F.col(name).alias("name")))), lambda x: F.struct(x["name"].alias("name"), (-x["neg"]).alias("value"))).alias("items"))


def combine_documents(parts: DataFrame, key: str, order: str, state_rank: Column, counters: list[str]) -> DataFrame:
    """Documents of one key: the last fact, the state of the highest rank, and sums."""
    return parts.groupBy(key).agg(F.max_by("fact", order).alias("fact"), F.max_by("state", state_rank).alias("state"), *[F.sum(c).alias(c) for c in counters])


def upsert_items(base: DataFrame, extra: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Items of both tables: sources joined, counts of the base first, and the first ``n`` examples."""
    e = extra.select(*keys, F.col("sources").alias("s2"), F.col("examples").alias("x2"), F.col("n").alias("n2"))
    none = F.array().cast("array<string>")
    return base.join(e, keys, "full").select(
        *keys, F.coalesce("n", "n2").alias("n"), F.array_sort(F.array_union(F.coalesce("sources", none), F.coalesce("s2", none))).alias("sources"), F.slice(F.array_distinct(F.concat(F.coalesce("examples", none), F.coalesce("x2", none))), 1, n).alias("examples")
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def reviewed_overlay(items: DataFrame, proposals: DataFrame, decisions: DataFrame) -> DataFrame:
    """Items with the proposal that the latest decision on them approves; else their own text."""
    last = latest_per_key(decisions, ["id"], [F.desc("at"), F.desc("proposal")]).filter("decision = 'approved'").select("id", F.col("proposal").alias("version"))
    chosen = proposals.join(last, ["id", "version"]).select("id", F.col("text").alias("reviewed"))
    return items.join(chosen, "id", "left").withColumn("shown", F.coalesce("reviewed", "text")).withColumn("source", F.when(F.col("reviewed").isNotNull(), "reviewed").otherwise("template")).drop("reviewed")


def manual_reviews(rows: DataFrame, reviews: DataFrame, candidates: str) -> DataFrame:
    """Rows (idx, status, candidates) after review decisions (idx, decision, choice)."""
    j = rows.join(reviews, "idx", "left")
    pending = F.col("status") == "review_required"
    approve = pending & (F.col("decision") == "approve")
    return j.select(
        "idx", F.when(approve, "ok").when(pending & (F.col("decision") == "exclude"), "excluded").otherwise(F.col("status")).alias("status"), F.when(approve, F.get(candidates, F.col("choice"))).alias("notice")
    )


def review_violations(rows: DataFrame, reviews: DataFrame) -> DataFrame:
    """issue, idx: reviews given twice, of unknown rows, of rows not pending, or without a reviewer."""
    known = rows.select("idx", "status")
    j = reviews.join(known, "idx", "left").withColumn("times", F.count(F.lit(1)).over(W.partitionBy("idx")))
    issue = F.array_compact(F.array(F.when(F.col("times") > 1, "twice"), F.when(F.col("status").isNull(), "unknown"), F.when(F.col("status").isNotNull() & (F.col("status") != "review_required"), "not_pending"), F.when(F.col("reviewer").isNull(), "no_reviewer")))
    return j.select(F.explode(issue).alias("issue"), "idx").distinct()


def update_join(rows: DataFrame, patch: DataFrame, keys: list[str], columns: list[str], allowed: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with patched columns where ``allowed``, and the patches that found no such row, with the reason."""
    p = patch.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__hit"))
    j = rows.join(p, keys, "left")
    use = F.coalesce(F.col("__hit"), F.lit(False)) & allowed
    out = j.select(*[F.when(use, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else c for c in rows.columns])
    state = rows.select(*keys, allowed.alias("__ok"))
    skipped = patch.select(*keys).join(state, keys, "left").filter(~F.coalesce("__ok", F.lit(False))).select(*keys, F.when(F.col("__ok").isNull(), "no_row").otherwise("not_allowed").alias("reason"))
    return out, skipped
