"""Ranked lexical search by an Aho-Corasick scan of the documents, without an index of them.

The terms of all queries form one automaton, each guarded by a boundary on both sides: a text's separators become
spaces, so that " term " stands in it exactly where the term is a whole word. A text is run through the automaton once;
what comes out are the query terms in it with their counts, whatever the length of the text. These hits, not the
texts, are written as a table, since scores need the corpus counts N, L and df, which come from the same table. In a
second pass over the hits the automaton's outputs are mapped to the queries that hold the term: a batch of documents
is a matrix of weights by term, the queries one of times by term, and their product is all scores. Every task keeps
the ``k`` best documents of each query; these are ranked in two steps, by parts of a query's rows and then together.

Queries are a stated set: they are taken in blocks of about ``TERMS`` words, each with an automaton and a scan of its
own, so that what is sent to the tasks is bounded however many there are. Scores are 64-bit integers; the product is
made in doubles as long as all sums stay below 2^53, in which they are exact, and in integers beyond.

Defined results: null text, and a text without words, has no terms and counts for nothing; a query without terms, or
whose terms no document holds, returns no row; queries that share an id or are repeated are answered each for itself;
documents that repeat an id are ranked each for itself; equal scores are ordered by id, null last; an empty table of
documents or queries gives an empty table; columns beside id and text are not looked at.
"""

from __future__ import annotations

import functools
import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window as W

from terroir.llm.common import documents, written

#: Words of queries, repeats included, that go into one automaton.
TERMS = 200_000
#: Documents scored at once, and queries at once.
DOCUMENTS, QUERIES = 256, 512
#: Parts of a query's best documents that are ranked before all of them are.
PARTS = 32

#: Separators become spaces, A to Z small letters; every other byte stands for itself.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[str]:
    """The terms of a text, as strings with one character for each byte."""
    return text.translate(FOLD).decode("latin-1").split(" ")


@functools.lru_cache(maxsize=2)
def automaton(terms: tuple[str, ...]):
    """Aho-Corasick automaton of the guarded terms; its outputs are their places in ``terms``."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        made.add_word(f" {term} ", i)
    made.make_automaton()
    return made


def term_counts(text: bytes, machine) -> tuple[int, dict[int, int]]:
    """Number of words in a text, and how often each of the automaton's terms is one of them."""
    folded = b" " + text.translate(FOLD) + b" "
    inside = np.frombuffer(folded, np.uint8) != 32
    n = int(np.count_nonzero(inside[1:] > inside[:-1]))
    return n, Counter(map(itemgetter(1), machine.iter(folded.decode("latin-1")))) if n and len(machine) else {}


def scan(docs: DataFrame, terms: tuple[str, ...], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, n (words), hits (places in ``terms``) and tfs (their counts) of every document with a word."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    kind = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL("n long, hits array<int>, tfs array<int>")])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)
        for batch in batches:
            at, ns, hits, tfs = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                n, counts = term_counts(text.as_py(), machine)
                if n:
                    at.append(i)
                    ns.append(n)
                    hits.append(list(counts.keys()))
                    tfs.append(list(counts.values()))
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(ns, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], ["id", "n", "hits", "tfs"])

    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).mapInArrow(found, kind)


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


class Best:
    """The ``k`` best documents of each query so far: score descending, then id, null last."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.kept, self.least = k, [[] for _ in range(queries)], np.ones(queries, np.int64)

    def add(self, scores: np.ndarray, ids: pa.Array, first: int) -> None:
        """``scores``: documents by queries, beginning with the query ``first``."""
        for i, q in zip(*np.nonzero(scores >= self.least[first : first + scores.shape[1]]), strict=True):
            kept, one = self.kept[first + q], ids[int(i)].as_py()
            entry = (-int(scores[i, q]), one is None, one)
            if len(kept) < self.k or entry[:2] < kept[-1][:2] or entry[:2] == kept[-1][:2] and one is not None and one < kept[-1][2]:
                insort(kept, entry, key=lambda e: (e[0], e[1], 0 if e[1] else e[2]))
                del kept[self.k :]
                if len(kept) == self.k:
                    self.least[first + q] = -kept[-1][0]


def rank(hits: DataFrame, queries: list[list[int]], df: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """query (its place), id and score: of each task's documents the ``k`` best of each query."""
    pairs = [(t, q, times) for q, terms in enumerate(queries) for t, times in sorted(Counter(terms).items())]
    postings = np.array(sorted(pairs), np.int64).reshape(-1, 3)
    most = max((len(q) for q in queries), default=0)
    shared = hits.sparkSession.sparkContext.broadcast((postings, weights(df, n_docs), len(queries), most))
    kind = T.StructType([T.StructField("query", T.IntegerType()), hits.schema["id"], T.StructField("score", T.LongType())])
    id_kind = to_arrow_type(hits.schema["id"].dataType)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings, weight, n_queries, most = shared.value
        starts = np.searchsorted(postings[:, 0], np.arange(len(weight) + 1))
        exact = int(weight.max(initial=0)) * 1_000_000 * most < 1 << 53
        best = Best(n_queries, k)
        for whole in batches:
            for begin in range(0, whole.num_rows, DOCUMENTS):
                batch = whole.slice(begin, DOCUMENTS)
                ids, n, terms, tfs = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2), batch.column(3)
                tf = tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                used, place = np.unique(terms.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
                of = np.repeat(np.arange(len(n)), terms.value_lengths().to_numpy(zero_copy_only=False))
                m = np.array([25 + 75 * int(x) * n_docs // total for x in n], np.int64)
                value = weight[used][place] * (1_000_000_000 * tf // (1000 * tf + 8 * m[of]))
                by_term = np.zeros((len(n), len(used)), np.float64 if exact else np.int64)
                by_term[of, place] = value
                lengths = starts[used + 1] - starts[used]
                rows = np.repeat(starts[used] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
                row, (_, query, times) = np.repeat(np.arange(len(used)), lengths), postings[rows].T
                for first in range(0, n_queries, QUERIES):
                    here = (query >= first) & (query < first + QUERIES)
                    by_query = np.zeros((len(used), min(QUERIES, n_queries - first)), by_term.dtype)
                    by_query[row[here], query[here] - first] = times[here]
                    best.add((by_term @ by_query).astype(np.int64), ids, first)
        found = [(q, e[2], -e[0]) for q, kept in enumerate(best.kept) for e in kept]
        columns = [pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int32(), id_kind, pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["query", "id", "score"])

    return hits.mapInArrow(scored, kind)


def search(docs: DataFrame, queries: DataFrame, k: int = 10, text_col: str = "text", id_col: str = "doc_id", query_text: str = "text", query_id: str = "item_id", terms: int = TERMS) -> DataFrame:
    """The ``k`` best documents of each query with a score above 0: ``query_id``, rank (from 1), ``id_col``, score."""
    spark = docs.sparkSession
    asked = queries.select(F.col(query_id).alias("id"), F.coalesce(F.col(query_text), F.lit("")).alias("text"))
    size = asked.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    blocks = -(-size // terms) or 1
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)))
    kind = T.StructType([T.StructField(query_id, asked.schema["id"].dataType), T.StructField("rank", T.IntegerType()), T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
    answers = spark.createDataFrame([], kind)
    for block in range(blocks):
        rows = dealt.filter(F.col("block") == block).select("id", "text").collect()
        listed = [[w for w in words(r["text"].encode()) if w] for r in rows]
        known = tuple(sorted({w for q in listed for w in q}))
        number = {w: i for i, w in enumerate(known)}
        if not known:
            continue
        hits = written(scan(docs, known, text_col, id_col), "zstd")
        n_docs, total = hits.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = np.zeros(len(known), np.int64)
        for t, n in hits.select(F.explode("hits").alias("t")).groupBy("t").count().collect():
            df[t] = n
        best = rank(hits, [[number[w] for w in q] for q in listed], df, n_docs, total, k)
        order = [F.desc("score"), F.asc_nulls_last("id")]
        parted = best.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
        for keys in (["query", "part"], ["query"]):
            parted = parted.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(rows)], T.StructType([T.StructField("query", T.IntegerType()), T.StructField("name", asked.schema["id"].dataType)]))
        answers = answers.unionAll(parted.join(names, "query").select(F.col("name").alias(query_id), "rank", F.col("id").alias(id_col), "score"))
    return answers


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents),
q as (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
qt as (select item_id, term, count(*) as times from q group by all),
corpus as (select count(*) as big_n, sum(len(ws)) as l from d where len(ws) > 0),
t as (select doc_id, n, term, count(*) as tf from (select doc_id, len(ws) as n, unnest(ws) as term from d) group by all),
w as (select term, cast(floor(1000 * ln(cast(2 * any_value(big_n) + 2 as double) / (2 * count(*) + 1))) as bigint) as w from t, corpus where term in (select term from qt) group by term),
s as (select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * big_n) // l)))) as score from t join w using (term) join qt using (term), corpus group by all),
r as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, cast(score as bigint) as score from r where rank <= 10
"""
