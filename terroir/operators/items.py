"""Normalisation of item names against a goods dictionary and rule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.functions import text as X
from terroir.operators.common import checked_broadcast, written


def exact_cascade(names: DataFrame, dictionary: DataFrame, prefixes: list[str]) -> DataFrame:
    """From names (name) and a dictionary (item, class): name, rung, matches, item. The name itself is the first
    rung, then the name after each prefix; several matches at the first rung that has any are a review, not a pick."""
    keys = [F.struct(F.lit(i).alias("rung"), X.canonical_name(F.concat(F.lit(p), F.col("name"))).alias("key")) for i, p in enumerate(["", *prefixes])]
    wanted = names.select("name").distinct().select("name", F.explode(F.array(*keys)).alias("k")).select("name", "k.*")
    found = wanted.join(dictionary.select(X.canonical_name(F.col("item")).alias("key"), "item", "class").distinct(), "key")
    best = found.withColumn("least", F.min("rung").over(W.partitionBy("name"))).filter("rung = least")
    folded = best.groupBy("name").agg(F.min("rung").alias("rung"), F.count(F.lit(1)).alias("matches"), F.min(F.struct("item", "class")).alias("m"))
    return names.join(folded, "name", "left").select(*names.columns, "rung", F.coalesce("matches", F.lit(0)).alias("matches"), F.when(F.col("matches") == 1, F.col("m.item")).alias("item"))


def approved_aliases(names: DataFrame, aliases: DataFrame, dictionary: DataFrame) -> DataFrame:
    """name, notice, class, status: ok if the alias's target stands once in the dictionary, review otherwise; an alias
    given twice is a review too, with the smallest of its targets."""
    once = aliases.groupBy("alias").agg((F.count(F.lit(1)) > 1).alias("twice"), F.min(F.struct("notice", "class")).alias("t")).select("alias", "twice", "t.*")
    held = dictionary.groupBy("item", "class").agg(F.count(F.lit(1)).alias("entries")).withColumnsRenamed({"item": "__i", "class": "__c"})
    joined = names.join(checked_broadcast(once), F.col("name") == F.col("alias")).join(held, (F.col("notice") == F.col("__i")) & (F.col("class") == F.col("__c")), "left")
    status = F.when(F.col("twice") | (F.coalesce("entries", F.lit(0)) != 1), "review_required").otherwise("ok")
    return joined.select(*names.columns, "notice", "class", status.alias("status"))


def _by_rarity(rows: DataFrame, keys: list[str], text: str, frequency: DataFrame, name: str) -> DataFrame:
    """``keys`` of rows with the distinct character pairs of ``text`` as structs (n, b), rarest in the dictionary first."""
    pairs = rows.select(*keys, F.explode(X.bigrams(F.col(text))).alias("b")).join(frequency, "b", "left")
    return pairs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "b"))).alias(name))


def _shared(joined: DataFrame) -> DataFrame:
    """Pairs joined by one character pair, kept only at the first of the query's that the entry has, with the score."""
    first = ~F.arrays_overlap(F.slice("qb", F.lit(1), F.col("i")), F.col("db"))
    n = F.size(F.array_intersect("qb", "db"))
    score = n / (F.size("qb") + F.size("db") - n)
    return joined.filter(first & ~X.contains_at_edge(F.col("query"), F.col("item"))).withColumn("score", score)


def _edges(q: DataFrame, d: DataFrame) -> DataFrame:
    """Pairs of which one begins or ends the other, by equality with all beginnings and endings, with the score."""

    def ends(c: str, least: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1)))
        return F.filter(F.array_distinct(F.concat(F.transform(at, lambda i: F.substring(F.col(c), F.lit(1), i)), F.transform(at, lambda i: F.substring(F.col(c), i, F.length(c))))), lambda x: F.length(x) >= least)

    inside = q.withColumn("item", F.explode(ends("query", 1))).join(d, "item")
    around = d.withColumn("query", F.explode(ends("item", 1))).filter("query <> item").join(q, "query")
    n = F.size(F.array_intersect("qb", "db"))
    score = n / (F.size("qb") + F.size("db") - n) + 0.5
    return inside.select("query", "item", "class", score.alias("score")).unionByName(around.select("query", "item", "class", score.alias("score")))


def fuzzy_pairs(queries: DataFrame, dictionary: DataFrame, k: int = 20) -> DataFrame:
    """query, item, class, score of all pairs that the search for the ``k`` best forms: those found by the query's rarest
    character pairs, which give a k-th score, and those that can reach it (see ``fuzzy_candidates``)."""
    q = queries.select("query").distinct().filter("query <> ''")
    d = dictionary.select("item", "class").distinct().filter(~F.coalesce(F.col("class").cast("string").try_cast("int") >= 35, F.lit(False)) & (F.col("item") != ""))
    frequency = d.select(F.explode(X.bigrams(F.col("item"))).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    bare = lambda c: F.transform(c, lambda x: x["b"])
    q = _by_rarity(q, ["query"], "query", frequency, "pairs").select("query", bare("pairs").alias("qb"), F.transform("pairs", lambda x: x["n"]).alias("ns"))
    d = written(_by_rarity(d, ["item", "class"], "item", frequency, "pairs").select("item", "class", bare("pairs").alias("db")))
    q = written(q)
    index = d.select("item", "class", "db", F.posexplode("db").alias("j", "b"))
    before = F.aggregate(F.slice("ns", F.lit(1), F.col("i")), F.lit(0).cast("long"), lambda a, x: a + x)
    seeds = _shared(q.select("query", "qb", "ns", F.posexplode("qb").alias("i", "b")).filter(before < 4 * k).drop("ns").join(index, "b"))
    known = written(_edges(q, d).unionByName(seeds.select("query", "item", "class", "score")))
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score")))
    least = known.withColumn("pos", place).filter(F.col("pos") == k).select("query", F.col("score").alias("least"))
    bounded = q.join(least, "query", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    need = lambda size: F.greatest(F.ceil(F.col("least") * size - 1e-9), F.lit(1))
    prefix = bounded.select("query", "qb", "ns", "least", F.posexplode("qb").alias("i", "b")).filter((F.col("i") <= F.size("qb") - need(F.size("qb"))) & (before >= 4 * k))
    sizes = F.size("qb") + F.size("db")
    both = F.greatest(F.ceil(F.col("least") / (1 + F.col("least")) * sizes - 1e-9), F.lit(1))
    reach = F.least(F.size("qb") - F.col("i"), F.size("db") - F.col("j")) >= both
    more = _shared(prefix.drop("ns").join(index, "b").filter(reach))
    return known.unionByName(more.select("query", "item", "class", "score"))


def fuzzy_candidates(queries: DataFrame, dictionary: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best entries of a dictionary (item, class, ...) for each distinct query: query, item, class, score, pos.

    Score: Jaccard of character pairs, plus 0.5 if one stands at the beginning or end of the other. Pairs are ordered by
    their frequency in the dictionary. A query first meets the entries at its edges and those that share one of its
    rarest pairs, as many pairs as have 4 ``k`` entries together; the k-th score so far bounds the rest: an entry that
    reaches it must share one of the query's first n - need + 1 pairs (prefix filter), be of a like length, have the
    shared pair early enough in its own order and enough after it. A frequent pair is thus joined only for queries
    that have no k-th score yet, whose rarer pairs all together have fewer than 4 ``k`` entries, or a low one.
    """
    final = fuzzy_pairs(queries, dictionary, k)
    return final.withColumn("pos", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "item", "class"))).filter(F.col("pos") <= k).select("query", "item", "class", "score", "pos")


def processed_derivative(candidates: DataFrame, suffixes: list[str]) -> DataFrame:
    """Of each query's candidates one that is the query plus a processing suffix: an exact stem before one that only
    ends alike; then by place."""
    s = candidates.select("query", "item", "pos", F.explode(F.array(*map(F.lit, suffixes))).alias("suffix")).filter(F.endswith("item", "suffix") & (F.col("item") != F.col("suffix")))
    s = s.withColumn("stem", F.substring(F.col("item"), F.lit(1), F.length("item") - F.length("suffix")))
    kind = F.when(F.col("stem") == F.col("query"), 0).when(F.endswith("stem", "query") | F.endswith("query", "stem"), 1)
    return s.withColumn("kind", kind).filter("kind is not null").withColumn("n", F.row_number().over(W.partitionBy("query").orderBy("kind", "pos", "suffix"))).filter("n = 1").select("query", "item", "suffix", "stem", "kind")


def catalog_reference(names: DataFrame, catalog: DataFrame, least: int = 2) -> DataFrame:
    """The catalog entry (name, ...) equal to a name, else the longest that the name ends with: all endings of a name
    are joined by equality."""
    key = X.canonical_name(F.col("name"))
    endings = names.select("name").distinct().select("name", key.alias("k")).filter("k <> ''").select("name", "k", F.explode(F.transform(F.sequence(F.lit(1), F.length("k")), lambda i: F.substring(F.col("k"), i, F.length("k")))).alias("ending"))
    found = endings.join(catalog.select(X.canonical_name(F.col("name")).alias("ending"), F.col("name").alias("entry")), "ending").filter((F.col("ending") == F.col("k")) | (F.length("ending") >= least))
    best = found.groupBy("name").agg(F.max_by(F.struct("entry", "ending"), F.struct(F.length("ending"), "entry")).alias("m"), F.max("k").alias("k"))
    return best.select("name", F.col("m.entry").alias("entry"), F.when(F.col("m.ending") == F.col("k"), "exact").otherwise("suffix").alias("match_type"))


def derived_rows(rows: DataFrame, bases: DataFrame, suffixes: list[str], whole: list[str], order: str) -> DataFrame:
    """New rows (region, base, suffix, first order) for the raw items behind processed ones: the longest suffix is cut;
    the base must be known, not whole, and not present in the region already; one row per region and base."""
    n = F.array_max(F.transform(F.filter(F.array(*map(F.lit, suffixes)), lambda s: F.endswith(F.col("item"), s)), lambda s: F.length(s)))
    cut = rows.withColumn("n", n).filter(F.col("n").isNotNull() & (F.col("n") < F.length("item")) & ~F.col("item").isin(whole))
    cut = cut.select("region", F.substring(F.col("item"), F.lit(1), F.length("item") - F.col("n")).alias("base"), F.right(F.col("item"), F.col("n")).alias("suffix"), order)
    known = cut.join(bases.select(F.col("item").alias("base")).distinct(), "base", "left_semi")
    new = known.join(rows.select("region", F.col("item").alias("base")).distinct(), ["region", "base"], "left_anti")
    return new.withColumn("k", F.row_number().over(W.partitionBy("region", "base").orderBy(order))).filter("k = 1").select("region", "base", "suffix", order)


def alias_sets(names: DataFrame, related: DataFrame) -> DataFrame:
    """Each name with its related names and the union of their classes."""
    sets = related.groupBy("notice").agg(F.array_sort(F.collect_set("related")).alias("related"), F.array_sort(F.collect_set("class")).alias("classes"))
    return names.join(checked_broadcast(sets), "notice", "left")


def normalize_verdict(excluded: Column, catalog: Column, alias_status: Column, matches: Column, derivative: Column, reference: Column, candidates: Column) -> list[Column]:
    """Status and source of the verdict, in order of trust."""
    status = F.when(excluded, "excluded").when(catalog, "ok").when(alias_status.isNotNull(), alias_status).when(matches == 1, "ok").otherwise("review_required")
    source = (
        F.when(excluded, "excluded").when(catalog, "catalog").when(alias_status.isNotNull(), "alias").when(matches == 1, "exact").when(matches > 1, "several_exact")
        .when(derivative.isNotNull(), "processed_derivative").when(reference.isNotNull(), "catalog_reference").when(candidates > 0, "no_exact").otherwise("no_candidate")
    )
    return [status.alias("status"), source.alias("verdict_source")]
