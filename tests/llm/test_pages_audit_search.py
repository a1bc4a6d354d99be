"""Main text of pages, source divergence and ranked search against plain versions, on tables with hard cases."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terroir.llm import divergence, lexical, pages
from tests.llm.test_operators import LONG

PAGE = "page_id long, url string, html string, text string, host string, paths string"
TEXT = "A sentence of the article that is long enough to count, with a comma. "
SHELL = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>no";</script></head><body><nav><ul><li><a href="/">Home</a></ul></nav>'
    '<div class="cookie-banner">We use cookies</div><div id="wrap" class="has-sidebar"><div class="post-%d">%s</div><div class="sidebar"><p>%s</p></div></div>'
    '<section class="comments"><p>A reader says very much indeed, and then more, and more, and more.</p></section><form>Search <input></form><!-- <p>old</p> --><footer>&copy; us</footer></body></html>'
)


def shell(n, inner, side="Side."):
    return SHELL % (n, inner, side)


def shown(spark, rows, **how):
    return {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, PAGE), **how).collect()}


def row(i, html, url="http://a.example.org/x"):
    return (i, url, html, "other", "h", "p")


def test_article_without_what_surrounds_it(spark):
    inner = f"<h1>Title &amp; more</h1><p>{TEXT}<p>Two\n\t lines<br>and&nbsp;a <b>bold</b> <a href=x>link</a></p><div class='ad-slot'>Buy</div><ul><li>one<li>two</ul>"
    expected = f"Title & more\n{TEXT.strip()}\nTwo lines and a bold link\none\ntwo"
    out = shown(spark, [row(1, shell(1, inner)), row(2, shell(22, inner)[:-30]), row(3, shell(3, inner).replace("<p>Side", "<p class=x>Side"))])
    assert out == {1: expected, 2: expected, 3: expected}


def test_a_page_follows_the_paths_of_its_host(spark):
    """On one page the sidebar holds more text than the article: the host's other pages decide."""
    normal = [row(i, shell(i, f"<p>{TEXT * 3}</p>")) for i in range(12)]
    odd = row(99, shell(99, "<p>Short article.</p>", TEXT * 9).replace('class="sidebar"', 'class="column"'))
    assert len(shown(spark, [odd])[99]) > len(TEXT)
    assert shown(spark, [*normal, odd])[99] == "Short article."
    assert [r["paths"] for r in pages.winners(spark.createDataFrame([*normal, odd], PAGE)).collect()] == [["html>body>div.has-sidebar@wrap>div.post-#", "html>body>div.has-sidebar@wrap>div.column"]]


def test_hosts_of_either_join_agree(spark, monkeypatch):
    rows = [row(i, shell(i, f"<p>{i} {TEXT}</p>"), f"https://user@{'ABC'[i % 3]}.example.org:80/{i}") for i in range(30)]
    before = shown(spark, rows)
    monkeypatch.setattr(pages, "small", lambda df: False)
    assert shown(spark, rows) == before
    assert before[7] == f"7 {TEXT}".strip()


def test_hard_pages(spark):
    cases = {
        None: "", "": "", " \n": "", "plain &lt;text&gt; &am": "plain <text> &am", "<p>cut <b": "cut", '<p>cut <a href="x>': "cut", "<p class=x\">odd</p>": "odd", "<p title='a > b'>quoted</p>": "quoted",
        "<script>x": "", "<!-- <p>never</p>": "", "<p>a&amp;lt;b</p>": "a&lt;b", "<div>" * 3000 + "deep": "deep", "<p>x" * 3000: "\n".join("x" * 3000),
        "<form><div><p>All text lies in a form.</p></div></form>": "All text lies in a form.", "<nav>only a menu</nav>": "", "<SCRIPT>a</SCRIPT ><P>After</P>": "After",
    }
    rows = [row(i, h, None if i % 2 else "no host") for i, h in enumerate(cases)]
    assert shown(spark, rows) == dict(enumerate(cases.values()))
    twice = pages.extract(spark.createDataFrame([rows[3], rows[3]], PAGE)).collect()
    assert [r["text"] for r in twice] == ["plain <text> &am"] * 2
    empty = pages.extract(spark.createDataFrame([], PAGE))
    assert empty.count() == 0 and empty.columns == ["page_id", "url", "host", "paths", "text"]


DOCS = "doc_id long, text string, lang string, source string, item string, value string, term string, folder string"


def documents(texts):
    return [(i, t, lang, source, "x", "y", "z", "f") for i, (t, lang, source) in enumerate(texts)]


CORPUS = [
    ("The cat É é the cat", "en", "a"), ("the dog, the cat", "en", "b"), ("the dog the dog cat", "en", "b"), ("THE", "en", None), (None, "en", "c"), ("", None, "c"), ("x x x", None, None), ("x", None, "d"), ("x 1 x2y", "", "d"),
    ("le chat", "fr", "a"), ("le chien", "fr", "b"), ("le", "fr", "b"), (LONG, "en", "a"), (LONG, "en", "a"), (LONG, "en", "long"), ("lonely", "de", "a"), ("lonely", "de", "b"),
]


def plain_audit(rows, min_df=3, top=200):
    count, df, groups = Counter(), Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        df.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
    out = []
    for lang, source in groups:
        kept = [t for (its, t), n in df.items() if its == lang and n >= min_df]
        of = {s: {t: count[lang, s, t] for t in kept} for its, s in groups if its == lang}
        total = {t: sum(x[t] for x in of.values()) for t in kept}
        share = {s: {t: 1 + 10**9 * (n + 1) // (sum(x.values()) + len(kept)) for t, n in x.items()} for s, x in of.items()}
        whole = {t: 1 + 10**9 * (n + 1) // (sum(total.values()) + len(kept)) for t, n in total.items()}
        p = share[source]
        pairs = [(sum((p[t] - q[t]) ** 2 // q[t] for t in kept), s) for s, q in share.items() if s != source]
        terms = [((p[t] - whole[t]) ** 2 // whole[t], t) for t in kept if of[source][t] and p[t] > whole[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            out += [(lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most])]
    return sorted(out)


@pytest.mark.parametrize(("vocabulary", "top"), [(2_000_000, 200), (2, 200), (2_000_000, 2)])
def test_audit_equals_plain_version(spark, vocabulary, top):
    """Also with vocabularies in several shards, and with fewer ranks."""
    rows = documents(CORPUS)
    out = divergence.audit(spark.createDataFrame(rows, DOCS), vocabulary=vocabulary, top=top).collect()
    assert sorted(map(tuple, out)) == plain_audit(rows, top=top)


def test_audit_of_few_rows(spark):
    empty = divergence.audit(spark.createDataFrame([], DOCS))
    assert empty.collect() == [] and empty.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = documents([("", "en", "a"), (None, "en", "b")])
    assert sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, DOCS)).collect())) == plain_audit(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_documents_of_a_source_share_vectors(spark, monkeypatch):
    """Sums are made of few vectors, whatever the number of documents; the vocabulary still counts each of them."""
    rows = [("en", f"s{i % 2}", f"the cat {'abc'[i % 3]}") for i in range(300)] + [("en", "s0", "")]
    texts = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    out = divergence.folded(texts, 3).collect()
    assert len(out) == len(rows) and sorted(r["source"] for r in out if r["words"]) == ["s0", "s1"]
    assert Counter(t for r in out for t in r["words"].split()) == Counter(t for _, _, x in rows for t in x.split())
    assert Counter(t for r in out for t in r["fresh"].split()) == dict.fromkeys(["the", "cat", "a", "b", "c"], 3)
    monkeypatch.setattr(divergence, "STRETCH", 20)
    short = divergence.folded(texts, 3).collect()
    assert max(len(r["words"]) for r in short) == 29 and Counter(t for r in short for t in r["words"].split()) == Counter(t for r in out for t in r["words"].split())


def test_audit_of_many_documents_and_equal_values(spark, monkeypatch):
    """Stretches end within a batch; more terms than are reported have the same value, in one vocabulary or several."""
    monkeypatch.setattr(divergence, "STRETCH", 60)
    rows = documents([(" ".join(f"w{chr(97 + (i * k) % 26)}{chr(97 + k)}" for k in range(1, 12)), "en" if i % 5 else "fr", f"s{i % 3}") for i in range(120)])
    for vocabulary in (2_000_000, 20):
        out = divergence.audit(spark.createDataFrame(rows, DOCS), vocabulary=vocabulary, top=7).collect()
        assert sorted(map(tuple, out)) == plain_audit(rows, top=7)


def test_no_vocabulary_is_large(spark, monkeypatch):
    """What the driver gets at once is a part of a large language's terms; each term is in one of the vocabularies."""
    sizes, fit = [], divergence.CountVectorizer.fit

    def noted(self, df):
        model = fit(self, df)
        sizes.append(len(model.vocabulary) - 1)  # without the word that no text has
        return model

    monkeypatch.setattr(divergence.CountVectorizer, "fit", noted)
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = " ".join(f"{a}{b}{c}{d}" for a in letters for b in letters for c in letters for d in letters[:15])
    out = divergence.audit(spark.createDataFrame(documents([(text, "en", s) for s in "aab"]), DOCS)).collect()
    assert sum(sizes) == 26**3 * 15 and max(sizes) < 200_000
    assert sorted(map(tuple, out)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_terms_are_dealt_over_columns(spark):
    """A term is in one part of the words and of the fresh terms; together the parts are the whole."""
    texts = spark.createDataFrame([("en", f"s{i % 2}", f"the cat {'abc'[i % 3]} É") for i in range(30)] + [("en", "s0", "")], "lang string, source string, text string").coalesce(1)
    whole, parted = divergence.folded(texts, 3).collect(), divergence.folded(texts, 3, 4).collect()
    for name in ("words", "fresh"):
        found = [Counter(t for r in parted for t in r[c].split()) for c in divergence.dealt_columns(name, 4)]
        assert sum(found, Counter()) == Counter(t for r in whole for t in r[name].split())
        assert sum(map(len, found)) == len(sum(found, Counter()))
    for n in (1, 5, 16, 17, 40):
        shards = divergence.shards_of(n)
        read = Counter((i, of) for columns, _, of in shards for i in range(16)[columns])
        assert len(shards) >= n and len(set(map(str, shards))) == len(shards) and len(read) == 16 and all(k == of for (_, of), k in read.items())


def test_few_values_are_left_to_rank(spark):
    """Before a group is sorted, what can't be among its largest values is left out; equal values stay."""
    rows = [(i % 2, i, (i * 7919) % 5000 if i % 2 else 5) for i in range(40_000)] + [(2, i, i) for i in range(5)]
    left = divergence.largest(spark.createDataFrame(rows, "id long, key long, value long"), 50).collect()
    by = {k: sorted((r["value"] for r in left if r["id"] == k), reverse=True) for k in range(3)}
    assert by[0] == [5] * 20_000 and by[2] == [4, 3, 2, 1, 0] and len(by[1]) < 500
    assert by[1][:50] == sorted((v for k, _, v in rows if k == 1), reverse=True)[:50]


def test_shares_are_exact_beyond_64_bits(spark):
    n, total = 10**12 + 7, 10**13 + 1
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(10**6))).first()[0]
    assert got == 1 + 10**9 * (n + 1) // (total + 10**6)


QUERIES = "item_id long, text string, doc_id long, score string, rank string"


def plain_search(docs, queries, k=10):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))

    held = [(r[0], Counter(terms(r[1]))) for r in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item in queries:
        scores = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(item[1]) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item[0], rank + 1, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [lexical.TERMS, 5])
def test_search_equals_plain_version(spark, block, monkeypatch):
    """Also with queries in several blocks, and few documents and queries at once."""
    if block == 5:
        monkeypatch.setattr(lexical, "DOCUMENTS", 3)
        monkeypatch.setattr(lexical, "QUERIES", 2)
    texts = [
        None, "", "... !", "the cat sat", "The CAT; sat on the mat 42", "cat", "cat", "cat cat cat", "cats catalog", "É é x", "İstanbul kelvin K", "the " * 3000 + "rare", LONG, LONG, "42x 42", "a b a b a",
        *["same words here"] * 15,
    ]
    docs = [(i, t, "en", "s", "x", "y", "z", "f") for i, t in enumerate(texts)] + [(None, "cat sat", "en", "s", "x", "y", "z", "f"), (5, "cat", "en", "s", "x", "y", "z", "f")]
    queries = [(1, "The cat the", 0, "", ""), (2, None, 0, "", ""), (3, "??", 0, "", ""), (4, "unknown", 0, "", ""), (5, "rare é 42", 0, "", ""), (None, "same same words", 0, "", ""), (1, "mat", 0, "", ""), (1, "mat", 0, "", ""), (7, "a b goes on", 0, "", "")]
    out = lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(queries, QUERIES), terms=block)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=repr) == plain_search(docs, queries)


def test_search_of_strings_and_of_empty_tables(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    queries = spark.createDataFrame([(1, "x")], "item_id int, text string")
    assert [r["doc_id"] for r in lexical.search(docs, queries).orderBy("rank").collect()] == ["a", "b", None]
    assert [r["doc_id"] for r in lexical.search(docs, queries, k=1).collect()] == ["a"]
    assert lexical.search(docs.limit(0), queries).count() == 0
    assert lexical.search(docs, queries.limit(0)).count() == 0


def test_scores_in_integers_where_doubles_are_not_exact(spark):
    docs = [(i, "x " * (i + 1) + "y", "en", "s", "x", "y", "z", "f") for i in range(6)]
    queries = [(1, "x y " * 600_000, 0, "", "")]
    out = lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(queries, QUERIES), terms=10**9)
    assert sorted(map(tuple, out.collect()), key=repr) == plain_search(docs, queries)
