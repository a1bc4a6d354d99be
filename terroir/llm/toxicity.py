"""Toxicity by Levenshtein automata over a lexicon trie, with scores for the context of each hit.

The lexicon is learned from labelled documents: words, and beginnings of words, that stand in many toxic and few
clean ones, counted once for each group of similar documents. All automata of distance 1 are run as one, as
states of sets of (trie node, errors): a word is read once and meets every term it equals, begins with, or
misspells by one letter. States are made when a word first needs them and kept while the worker lives, and
distinct words of a block are read together. A hit in quotation marks or after a word of reporting counts for
less. A logistic regression on a document's hits gives its score.

The classifier is fitted on a bounded sample of ``SAMPLE`` labelled rows (those of the smallest hashes of their
ids), lexicon and regression on different rows of it; every document is scored whole. Rows whose
crc32(doc_id as text) mod 5 is 0 are held out. Labels, language, source and id are no inputs of a score.

Defined results: null or empty text has no hits and the score of a document without hits; a null id is never
held out and never labelled; without usable labels all scores are the share of toxic labels (0 without any);
rows that repeat get the same score; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.llm.common import checkpoint, documents, free_names, text_of
from terroir.llm.textblocks import LETTER, NUMBER, blocks, classes, code_points, piece_array

SAMPLE = 10_000
TERMS = 600
#: Lengths of beginnings of words that may become terms.
STEMS = (4, 5, 6)
#: Least length of a term that may be misspelled.
FUZZY = 5
EVIDENCE = 5.0
HELD_OUT = 5
QUOTED = 0.5
WINDOW = 48
QUOTES = '"“”„«»‹›'
REPORTING = {"called", "calls", "quote", "quoted", "quotes", "said", "says", "slur", "term", "word", "wrote"}
FEATURES = 7


class Automaton:
    """Terms (text, whether it is the beginning of a word, weight) as one lazily built deterministic automaton."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, int] = {}
        self.stems: dict[int, int] = {}
        for i, (text, stem, _) in enumerate(terms):
            node = 0
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                node = self.children[node][c]
            (self.stems if stem else self.ends)[node] = i
        self.letters = {c: i + 1 for i, c in enumerate(sorted({c for t, _, _ in terms for c in t}))}
        self.by_column = {i: c for c, i in self.letters.items()}
        self.sets: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.next = np.full((0, len(self.letters) + 1), -1, np.int32)
        self.exact = self.fuzzy = self.stem = np.zeros(0, np.int32)
        self.dead = self._state(frozenset())
        self.start = self._state(self._closed({(0, 0)}))
        self.columns = np.zeros(0x110000, np.int16)
        for c, i in self.letters.items():
            self.columns[ord(c)] = i

    def _closed(self, states: set) -> frozenset:
        out = set(states)
        for node, errors in states:
            if not errors:
                out.update((child, 1) for child in self.children[node].values())
        return frozenset((n, e) for n, e in out if not e or (n, 0) not in out)

    def _state(self, states: frozenset) -> int:
        if states not in self.number:
            self.number[states] = len(self.sets)
            self.sets.append(states)

            def best(found: list[int]) -> int:
                return max(found, key=lambda i: (self.terms[i][2], -i), default=-1)

            row = (
                best([self.ends[n] for n, e in states if not e and n in self.ends]),
                best([self.ends[n] for n, e in states if e and n in self.ends and len(self.terms[self.ends[n]][0]) >= FUZZY]),
                best([self.stems[n] for n, e in states if not e and n in self.stems]),
            )
            self.exact, self.fuzzy, self.stem = (np.append(a, np.int32(x)) for a, x in zip((self.exact, self.fuzzy, self.stem), row, strict=True))
            self.next = np.concatenate((self.next, np.full((1, self.next.shape[1]), -1, np.int32)))
        return self.number[states]

    def _step(self, state: int, column: int) -> int:
        out, c = set(), self.by_column.get(column)
        for node, errors in self.sets[state]:
            if c in self.children[node]:
                out.add((self.children[node][c], errors))
            if not errors:
                out.add((node, 1))
                out.update((child, 1) for child in self.children[node].values())
        return self._state(self._closed(out))

    def read(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each word the number of the term it equals or begins with, and else of the one it misspells, or -1."""
        n = len(words)
        hit, near = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        text = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
        begin = np.cumsum(lengths) - lengths
        state, live, at = np.full(n, self.start, np.int32), np.flatnonzero(lengths > 0), 0
        while len(live):
            column = self.columns[text[begin[live] + at]]
            then = self.next[state[live], column]
            if (then < 0).any():
                need = then < 0
                for s, c in {*zip(state[live][need].tolist(), column[need].tolist(), strict=True)}:
                    to = self._step(s, c)
                    self.next[s, c] = to
                then = self.next[state[live], column]
            state[live] = then
            found = self.stem[then]
            hit[live] = np.where((found >= 0) & (hit[live] < 0), found, hit[live])
            at += 1
            ended = lengths[live] == at
            done, last = live[ended], then[ended]
            hit[done] = np.where(self.exact[last] >= 0, self.exact[last], hit[done])
            near[done] = np.where(hit[done] < 0, self.fuzzy[last], -1)
            live = live[~ended & (then != self.dead)]
        return hit, near


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where tokens and gaps begin, and which are tokens: runs of letters and numbers, with *, @ or $
    between two letters."""
    at, cp = code_points(data)
    kind = classes()[cp]
    token = (kind == LETTER) | (kind == NUMBER)
    if len(cp) > 2:
        token[1:-1] |= np.isin(cp[1:-1], [0x24, 0x2A, 0x40]) & (kind[:-2] == LETTER) & (kind[2:] == LETTER)
    first = np.zeros(len(at) + 1, bool)
    first[np.searchsorted(at, offsets[:-1])] = True
    change = first[:-1].copy()
    change[1:] |= token[1:] != token[:-1]
    return at[change], token[change]


def _quoted(data: np.ndarray, begin: int, end: int, first: int, last: int) -> bool:
    before = bytes(data[max(first, begin - WINDOW) : begin]).decode(errors="ignore")
    after = bytes(data[end : min(last, end + WINDOW)]).decode(errors="ignore")
    marks = sum(c in QUOTES for c in before) % 2 == 1 and any(c in QUOTES for c in after)
    return marks or not REPORTING.isdisjoint(before.lower().split()[-4:])


def _features(automaton: Automaton, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    docs = len(offsets) - 1
    out = np.zeros((docs, FEATURES))
    if not len(data):
        return out
    starts, token = _tokens(data, offsets)
    coded = piece_array(data, starts).dictionary_encode()
    words = pc.utf8_lower(coded.dictionary.cast(pa.string()))
    hit, near = automaton.read(words)
    codes = coded.indices.to_numpy()
    owner = np.searchsorted(offsets, starts, "right") - 1
    n_tokens = np.bincount(owner[token], minlength=docs)
    ends = np.append(starts[1:], len(data))
    weight = np.array([w for _, _, w in automaton.terms])
    found: dict[int, tuple[dict, dict, int, int]] = {}
    for i in np.flatnonzero(token & ((hit[codes] >= 0) | (near[codes] >= 0))).tolist():
        d, exact = int(owner[i]), int(hit[codes[i]])
        exacts, nears, n, quotes = found.get(d, ({}, {}, 0, 0))
        quoted = _quoted(data, int(starts[i]), int(ends[i]), int(offsets[d]), int(offsets[d + 1]))
        term, into = (exact, exacts) if exact >= 0 else (int(near[codes[i]]), nears)
        into[term] = max(into.get(term, 0.0), weight[term] * (QUOTED if quoted else 1.0))
        found[d] = (exacts, nears, n + 1, quotes + quoted)
    for d, (exacts, nears, n, quotes) in found.items():
        out[d] = (
            max(exacts.values(), default=0.0), math.log1p(sum(exacts.values())), math.log1p(len(exacts)),
            max(nears.values(), default=0.0), math.log1p(len(nears)), quotes / n, math.log1p(100 * n / n_tokens[d]),
        )
    return out


def crc(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def sample_of(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``sample`` labelled rows that aren't held out: doc_id, text, toxic, fold (0 to 3). Of rows that share an
    id the one with the smallest text is taken."""
    usable = labels.filter("toxic in (0, 1)").groupBy(F.col(id_col).alias("__id")).agg(F.max("toxic").cast("int").alias("toxic")).filter(crc("__id") % HELD_OUT != 0)
    chosen = usable.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    joined = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    return checkpoint(joined.withColumn("fold", (crc("doc_id") % HELD_OUT - 1).cast("int")))


def learn_terms(sample: DataFrame, terms: int = TERMS) -> list[tuple[str, bool, float]]:
    """Words and beginnings of words that mark toxic documents, with their log odds."""
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) >= 3))
    worded = sample.select("toxic", words.alias("words")).filter(F.size("words") > 0)
    # similar documents share the smallest hash of three neighbouring words
    places = F.sequence(F.lit(1), F.greatest(F.size("words") - 2, F.lit(1)))
    worded = worded.withColumn("group", F.array_min(F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(F.col("words"), i, F.lit(3)), " ")))))
    stems = [F.transform(F.filter("words", lambda w, k=k: F.length(w) >= k), lambda w, k=k: F.concat(F.substring(w, 1, k), F.lit("*"))) for k in STEMS]
    units = worded.select("toxic", "group", F.explode(F.array_distinct(F.concat("words", *stems))).alias("unit")).distinct()
    bad, good = (r or 0 for r in worded.agg(F.countDistinct(F.when(F.col("toxic") == 1, F.col("group"))), F.countDistinct(F.when(F.col("toxic") == 0, F.col("group")))).first())
    if not bad or not good:
        return []
    share = bad / (bad + good)
    a, n = F.col("a"), F.col("a") + F.col("b")
    z = (a - share * n) / F.sqrt(n * share * (1 - share))
    rows = (
        units.groupBy("unit").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
        .filter((a >= 3) & (a >= F.col("b"))).withColumn("z", z).filter(F.col("z") >= EVIDENCE).orderBy(F.desc("z"), "unit").limit(terms).collect()
    )
    weight = lambda r: math.log((r["a"] + 0.5) / (bad + 1)) - math.log((r["b"] + 0.5) / (good + 1))
    return [(r["unit"].removesuffix("*"), r["unit"].endswith("*"), max(weight(r), 0.1)) for r in rows]


_made: dict[tuple, Automaton] = {}


def features(df: DataFrame, terms: list[tuple[str, bool, float]], keep: list[str], text_col: str = "text", out: str = "__features") -> DataFrame:
    """The columns ``keep`` and the features of each text, as column ``out``."""
    text = free_names(df, "__text")[0]
    kinds = df.select(*keep).schema
    shared = df.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = tuple(shared.value)
        if key not in _made:
            _made.clear()
            _made[key] = Automaton(shared.value)
        for batch in batches:
            for a, b, data, offsets in blocks(batch, text, 4 << 20):
                found = _features(_made[key], data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * FEATURES), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in keep), lists], names=[*keep, out])

    return df.select(*keep, text_of(text_col).alias(text)).mapInArrow(run, kinds.add(out, T.ArrayType(T.DoubleType())))


def fit(rows: list[tuple[list[float], int]], ridge: float = 0.5) -> tuple[list[float], float]:
    """Weights and intercept of a logistic regression (Newton's method); the intercept isn't shrunk."""
    x = np.array([[*r, 1.0] for r, _ in rows])
    y = np.array([t for _, t in rows], float)
    w, shrink = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink, x.T @ (y - p) - shrink @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1].tolist(), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[list, list[float], float]:
    """(terms, weights, intercept); what reaches the driver is bounded by ``TERMS`` and ``sample``."""
    rows = sample_of(docs, labels, sample, id_col, text_col)
    terms = learn_terms(rows.filter("fold < 3"))
    fitted = [(r["__features"], r["toxic"]) for r in features(rows.filter("fold = 3"), terms, ["toxic"]).collect()]
    if not terms or len({t for _, t in fitted}) < 2:
        share = rows.agg(F.avg("toxic")).first()[0] or 0.0
        return terms, [0.0] * FEATURES, math.log(max(share, 1e-9) / max(1 - share, 1e-9))
    return terms, *fit(fitted)


def score(df: DataFrame, model: tuple[list, list[float], float], keep: list[str], text_col: str = "text", out: str = "score") -> DataFrame:
    """The columns ``keep`` and the score of each text, as column ``out``."""
    terms, weights, intercept = model
    made = free_names(df, "__features")[0]
    linear = F.aggregate(F.zip_with(made, F.array(*map(F.lit, weights)), lambda x, w: x * w), F.lit(intercept), lambda a, x: a + x)
    return features(df, terms, keep, text_col, made).withColumn(out, 1 / (1 + F.exp(-linear))).drop(made)


def drop_toxic(df: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose score is below ``threshold``; ``labels`` has the same id column."""
    model = train(df, labels, id_col=id_col, text_col=text_col)
    own = free_names(df, "__score")[0]
    return score(df, model, df.columns, text_col, out=own).filter(F.col(own) < threshold).drop(own)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score(docs, train(docs, labels), ["doc_id"])
    held = F.coalesce(crc("doc_id") % HELD_OUT == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
