"""Source divergence audit: how far the sources of a language differ from each other, and by which terms.

A ``CountVectorizer`` for each language, with ``min_df`` and the largest integer as ``vocabSize``, makes exact sparse
count vectors of all its documents. It is fitted on the terms that a document adds to what a task has read: once
``min_df`` documents in a task hold a term, it is known to be kept, and further documents needn't say so. Documents of
a source that a task reads together share a vector, the sum of theirs. Non-zero places of the vectors are added up by
source, as a summarizer would add up whole vectors, but without ever making a dense one: a row for each term that a
source uses. A term's key is the number of its vocabulary and its place there; only what is reported gets names.

Pairs of sources are evaluated on these sparse sums. The value of (a, b) is a sum over all kept terms, most of which
neither uses. With z the share that a group gives a term that it doesn't use, it is the sum of f(p_a, z_b) over a's
terms, of f(z_a, p_b) over b's terms and of f(z_a, z_b) over the others, corrected on the terms that both use; the
first two are sums over the distinct shares of a group, and only the last needs a join by term. Terms of a group are
ranked in two steps, by parts and then together, so that a source with most of the rows isn't sorted in one task; those
below as many others as are reported, told by the largest values of parts of the group, are left out before.

A vocabulary is gathered on the driver and sent to the tasks. It is therefore made in shards of the terms, by hash, if
a language has more than about ``vocabulary`` distinct terms, as counted from those whose checksum is a multiple of
``EVERY``: every shard has its own vectorizer and vectors, and their sums are put together; the result is the same.
The terms are written in ``DEALT`` columns by hash and a shard reads its own columns only, so that up to as many shards
together read each term once. Languages are taken one after the other.

All arithmetic is exact: counts are whole doubles below 2^53, products with 10^9 are decimals, squares of shares fit in
64 bits. Defined results: null text, language and source count as empty; a group without kept terms has pair rows like
any other, with value 0 where the language keeps no term; a row counts as a document of its own, repeated or not; an
empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.llm.common import checkpoint_folder, documents, text_of, written

#: A to Z become small letters, what stands in no term a space; every other byte stands for itself.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Documents that must hold a term, and terms of a group that are reported.
MIN_DF, TOP = 3, 200
#: Distinct terms of a language up to which it has one vocabulary, and columns over which its terms are dealt.
VOCABULARY, DEALT = 200_000, 16
#: One of how many checksums of terms is counted to tell the number of distinct terms.
EVERY = 64
#: Terms of a language that a task remembers while it reads.
KNOWN = 500_000
#: Bytes of terms after which documents of a source that are read together start another vector.
STRETCH = 1 << 17
#: Shares are counted in parts of this.
WHOLE = 1_000_000_000
#: Folders of texts by language, and parts of a group's terms that are ranked before all of them are.
FOLDERS, PARTS = 16, 16
#: Parts of a group, for each term to report, whose largest values bound the values reported.
SLOTS = 8
#: A word that no text has, which keeps a vocabulary from being empty.
NO_TERM = " "
COUNTS, TERMS = "lang string, source string, key long, n long", "key long, term string"


def dealt(words: bytes, parts: int) -> list[bytes]:
    """The words, joined by single spaces, as so many such strings, by a checksum of the word."""
    if parts == 1:
        return [words]
    out: list[list[bytes]] = [[] for _ in range(parts)]
    for t, n in Counter(words.split()).items():
        out[zlib.crc32(t) // EVERY % parts] += [t] * n
    return [b" ".join(x) for x in out]


def dealt_columns(column: str, parts: int) -> list[str]:
    return [f"{column}{i or ''}" for i in range(parts)]


def folded(texts: DataFrame, min_df: int, parts: int = 1) -> DataFrame:
    """From rows (lang, source, text): lang, source, words (the terms of the text and of those before it in the batch of
    the same source that have no words yet, joined by single spaces; empty until they are ``STRETCH`` bytes or the batch
    ends), fresh (those of its distinct terms that fewer than ``min_df`` documents of the language had before in this
    task) and sample (checksums of terms new to the task, those that are multiples of ``EVERY``). With more ``parts``,
    words and fresh are dealt over so many columns, words, words1 and so on, by the terms."""
    words_columns, fresh_columns = dealt_columns("words", parts), dealt_columns("fresh", parts)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[bytes, int]] = {}
        settled: dict[str, set[bytes]] = {}
        for batch in batches:
            words, fresh, samples = [[b""] * parts] * batch.num_rows, [], []
            stretches: dict[tuple[str, str], tuple[int, int, list[bytes]]] = {}  # last row, bytes, words of its rows
            for i, (lang, source, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True)):
                terms = text.as_py().translate(FOLD).split()
                known, enough = counts.setdefault(lang, {}), settled.setdefault(lang, set())
                own, sample = set(terms) - enough, []
                for t in own:
                    n = known[t] = known.get(t, 0) + 1
                    if n == 1 and not (h := zlib.crc32(t)) % EVERY:
                        sample.append(h)
                    if n == min_df:
                        enough.add(t)
                _, size, stretch = stretches.pop((lang, source), (i, 0, []))
                if terms:
                    stretch.append(b" ".join(terms))
                    size += len(stretch[-1])
                if size < STRETCH:
                    stretches[lang, source] = i, size, stretch
                else:
                    words[i] = dealt(b" ".join(stretch), parts)
                fresh.append(dealt(b" ".join(own), parts))
                samples.append(sample)
                if len(known) > KNOWN:  # what is forgotten is told again
                    known.clear()
                    enough.clear()
            for i, _, stretch in stretches.values():
                words[i] = dealt(b" ".join(stretch), parts)
            strings = [pa.array([row[part] for row in x], pa.binary()).cast(pa.string()) for x in (words, fresh) for part in range(parts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *strings, pa.array(samples, pa.list_(pa.int64()))], ["lang", "source", *words_columns, *fresh_columns, "sample"])

    schema = ", ".join(["lang string", "source string", *(f"{c} string" for c in (*words_columns, *fresh_columns)), "sample array<bigint>"])
    return texts.select("lang", "source", F.col("text").cast("binary")).mapInArrow(fold, schema)


def shards_of(n: int) -> list[tuple[slice, int, int]]:
    """At least ``n`` shards: the columns that each reads, and which of how many of their terms."""
    if n <= DEALT:
        return [(slice(DEALT * i // n, DEALT * (i + 1) // n), 0, 1) for i in range(n)]
    of = -(-n // DEALT)
    return [(slice(i, i + 1), j, of) for i in range(DEALT) for j in range(of)]


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + size)), exact."""
    above = ((n + 1).cast("decimal(19,0)") * F.lit(WHOLE).cast("decimal(10,0)")).cast("decimal(30,0)")
    wide = F.call_function("div", above, (total + size).cast("decimal(30,0)"))
    return F.when(n < 9 * WHOLE, F.call_function("div", (n + 1) * WHOLE, total + size)).otherwise(wide) + 1


def squared(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def write_sums(texts: DataFrame, lang: str, first: int, shards: list[tuple[slice, int, int]], min_df: int, counts: str, names: str) -> int:
    """Adds lang, source, key, n of the kept terms of one language to the table at ``counts``, and key, term to the one at
    ``names``, from rows of ``folded`` in ``DEALT`` parts; tells how many terms are kept. Vocabularies are numbered from ``first`` on.
    Each shard is written before the next one's vocabulary is gathered, so that the driver holds one at a time."""
    spark, kept = texts.sparkSession, 0
    for number, (columns, place, of) in enumerate(shards, first):

        def terms_in(column: str, columns: slice = columns, place: int = place, of: int = of) -> DataFrame:
            own = [F.nullif(F.col(c), F.lit("")) for c in dealt_columns(column, DEALT)[columns]]
            terms = F.split(F.concat_ws(" ", *own), " ")
            terms = F.filter(terms, lambda t: F.pmod(F.xxhash64(t), F.lit(of)) == place) if of > 1 else terms
            return texts.filter(F.coalesce(*own).isNotNull()).select("source", terms.alias("terms"))

        never = spark.range(min_df).select(F.array(F.lit(NO_TERM)).alias("terms"))
        model = CountVectorizer(inputCol="terms", outputCol="counts", minDF=float(min_df), vocabSize=2**31 - 1).fit(terms_in("fresh").select("terms").unionAll(never))
        vector = F.unwrap_udt("counts")
        places = model.transform(terms_in("words")).select("source", F.explode(F.arrays_zip(vector["indices"].alias("at"), vector["values"].alias("n"))).alias("x"))
        summed = places.groupBy("source", F.col("x.at").alias("at")).agg(F.sum("x.n").cast("long").alias("n"))
        before = number << 31
        terms = pa.array(model.vocabulary, pa.string())  # fetched once: a copy of all terms
        named = pa.table({"key": pa.array(np.arange(before, before + len(terms), dtype=np.int64)), "term": terms}).filter(pc.not_equal(terms, NO_TERM))
        spark.createDataFrame(named).write.mode("append").parquet(names)
        kept += len(named)
        del terms, named
        summed.select(F.lit(lang).alias("lang"), "source", (F.col("at").cast("long") + F.lit(before)).alias("key"), "n").write.mode("append").parquet(counts)
    return kept


def ranked(df: DataFrame, top: int | None = None) -> DataFrame:
    """Rows with their rank in (lang, source), by value descending and item, up to ``top``."""
    order = [F.desc("value"), F.asc("item")]
    if top:
        part = W.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(PARTS))).orderBy(*order)
        df = df.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
    df = df.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(*order)))
    return df.filter(F.col("rank") <= top) if top else df


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_df: int = MIN_DF, top: int = TOP, vocabulary: int = VOCABULARY) -> DataFrame:
    """lang, source, part, item, value, rank: for each (lang, source), all other sources of the language by divergence
    (``pair``), and the ``top`` terms that it uses more than its language does (``term``)."""
    spark = docs.sparkSession
    folder = f"{checkpoint_folder(spark)}/terms-{uuid.uuid4()}"
    texts = folded(docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text")), min_df, DEALT)
    texts = texts.withColumn("folder", F.pmod(F.xxhash64("lang"), F.lit(FOLDERS)).cast("int"))
    texts.write.option("compression", "zstd").partitionBy("folder").parquet(folder)
    texts = spark.read.schema(texts.schema).parquet(folder)
    groups = written(texts.groupBy("lang", "source").agg(F.lit(0).alias("none")).select("lang", "source"))
    sampled = texts.select("lang", "folder", F.explode_outer("sample").alias("h"))
    sizes = sampled.groupBy("lang", "folder").agg(F.count_distinct("h").alias("n")).collect()  # one row a language
    counts, names = (f"{checkpoint_folder(spark)}/{x}-{uuid.uuid4()}" for x in ("counts", "names"))
    spark.createDataFrame([], COUNTS).write.parquet(counts)
    spark.createDataFrame([], TERMS).write.parquet(names)
    kept, vocabularies = [], 0
    for lang, number, n in sorted(map(tuple, sizes)):
        own, shards = texts.filter((F.col("folder") == number) & (F.col("lang") == lang)), shards_of(-(-n * EVERY // vocabulary) or 1)
        kept.append((lang, write_sums(own, lang, vocabularies, shards, min_df, counts, names)))
        vocabularies += len(shards)
    sizes = spark.createDataFrame(kept, "lang string, size long")
    return ranked_parts(groups, spark.read.schema(COUNTS).parquet(counts), spark.read.schema(TERMS).parquet(names), sizes, top)


def largest(df: DataFrame, top: int) -> DataFrame:
    """Of rows (id, key, value), at least the ``top`` largest values of each id, with all that equal the last, and few more:
    those not below the value that ``top`` parts of the id reach."""
    most = df.groupBy("id", F.pmod(F.xxhash64("key"), F.lit(SLOTS * top)).alias("slot")).agg(F.max("value").alias("bound"))
    place = F.row_number().over(W.partitionBy("id").orderBy(F.desc("bound")))
    bounds = most.withColumn("place", place).filter(F.col("place") == top).select("id", "bound")
    return df.join(bounds, "id", "left").filter(F.col("bound").isNull() | (F.col("value") >= F.col("bound"))).drop("bound")


def ranked_parts(groups: DataFrame, counts: DataFrame, terms: DataFrame, kept: DataFrame, top: int) -> DataFrame:
    """``audit`` from the groups (lang, source), their counts (lang, source, key, n), the kept terms (key, term) and their
    number (lang, size)."""
    by_group = written(counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("used")))
    by_lang = by_group.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(kept, "lang")
    filled = groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").fillna(0, ["total", "used", "size", "lang_total"])
    zero = F.when(F.col("size") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("size")))
    groups = written(filled.withColumn("zero", zero).withColumn("id", F.monotonically_increasing_id()))
    p, q = share(F.col("n"), F.col("total"), F.col("size")), share(F.col("lang_n"), F.col("lang_total"), F.col("size"))
    keyed = counts.join(groups.select("lang", "source", "id"), ["lang", "source"]).select("key", "id", "n").withColumn("lang_n", F.sum("n").over(W.partitionBy("key")))
    shares = written(keyed.join(groups, "id").select("key", "id", "zero", p.alias("p"), q.alias("q")))
    over = shares.filter("p > q").select("id", "key", squared(F.col("p"), F.col("q")).alias("value"))
    by_term = (largest(over, top) if top else over).join(terms, "key").join(groups, "id").select("lang", "source", F.col("term").alias("item"), "value")

    def of(name: str, df: DataFrame, *more: str) -> DataFrame:
        return df.select("lang", *[F.col(c).alias(f"{name}_{c}") for c in ("source", *more)])

    key, differ = ["lang", "a_source", "b_source"], F.col("a_source") != F.col("b_source")
    a, b = of("a", groups, "used", "zero", "size"), of("b", groups, "used", "zero")
    neither = squared(F.col("a_zero"), F.col("b_zero"))
    rest = a.join(b, "lang").filter(differ).select(*key, F.coalesce((F.col("a_size") - F.col("a_used") - F.col("b_used")) * neither, F.lit(0)).alias("v"))
    spread = written(shares.groupBy("id", "p").agg(F.count(F.lit(1)).alias("k")).join(groups.select("id", "lang", "source"), "id"))
    only_a = of("a", spread, "p", "k").join(of("b", groups, "zero"), "lang").filter(differ).select(*key, (F.col("a_k") * squared(F.col("a_p"), F.col("b_zero"))).alias("v"))
    only_b = of("b", spread, "p", "k").join(of("a", groups, "zero"), "lang").filter(differ).select(*key, (F.col("b_k") * squared(F.col("a_zero"), F.col("b_p"))).alias("v"))

    def uses(name: str) -> DataFrame:
        return shares.select("key", *[F.col(c).alias(f"{name}_{c}") for c in ("id", "p", "zero")])

    def correction(a: str, b: str) -> Column:
        p, q, p_zero, q_zero = (F.col(x) for x in (f"{a}_p", f"{b}_p", f"{a}_zero", f"{b}_zero"))
        return F.sum(squared(p, q) - squared(p, q_zero) - squared(p_zero, q) + squared(p_zero, q_zero))

    both = uses("a").join(uses("b"), "key").filter("a_id < b_id")
    common = both.groupBy("a_id", "b_id").agg(correction("a", "b").alias("ab"), correction("b", "a").alias("ba"))
    common = common.join(of("a", groups, "id"), "a_id").join(of("b", groups, "id").drop("lang"), "b_id")
    ways = F.array(F.struct("a_source", "b_source", F.col("ab").alias("v")), F.struct(F.col("b_source").alias("a_source"), F.col("a_source").alias("b_source"), F.col("ba").alias("v")))
    shared = common.select("lang", F.explode(ways).alias("x")).select("lang", "x.*")
    summed = reduce(DataFrame.unionAll, [rest, only_a, only_b, shared]).groupBy(*key).agg(F.sum("v").alias("value"))
    by_pair = summed.select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), "value")

    def part(name: str, df: DataFrame) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part("pair", ranked(by_pair)).unionAll(part("term", ranked(by_term, top)))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


SQL = r"""
with d as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents),
t as (select row, lang, source, unnest(ws) as term from d),
kept as (select lang, term, count(*) as lang_n from t group by lang, term having count(distinct row) >= 3),
v as (select lang, count(*) as size, sum(lang_n) as lang_total from kept group by lang),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from t group by all),
f as (select g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0)::hugeint as n, sum(coalesce(c.n, 0)) over (partition by g.lang, g.source) as total
      from g join kept k on g.lang = k.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
p as (select f.lang, source, term, n, 1 + (1000000000 * (n + 1)) // (total + size)::hugeint as p, 1 + (1000000000 * (lang_n + 1)::hugeint) // (lang_total + size)::hugeint as q from f join v on f.lang = v.lang),
pairs as (select a.lang, a.source, b.source as item, coalesce(x.value, 0) as value
          from g a join g b on a.lang = b.lang and a.source <> b.source
          left join (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all) x
            on x.lang = a.lang and x.source = a.source and x.item = b.source),
terms as (select lang, source, term as item, ((p - q) * (p - q)) // q as value from p where n > 0 and p > q),
r as (select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
      union all select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) from terms)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from r where part = 'pair' or rank <= 200
"""
