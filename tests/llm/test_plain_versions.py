"""The queries that SQL can't express, and the pipeline, against plain versions of their whole work."""

import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest

from terroir.llm import bpe, phrases, queries, toxicity, token_file
from tests.llm.test_operators import LONG, distance, filled, normal, plain_simhash, sha, some, without_repeats

ALL = 2**64 - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & ALL
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & ALL
    return x ^ x >> 31


def tossed(before, symbol):
    apart = before ^ symbol
    place = (apart & -apart).bit_length() - 1 if apart else 0
    return 2 * place + (symbol >> place & 1)


def plain_sketch(raw, k=phrases.SKETCH):
    """Locally consistent parsing, symbol by symbol."""
    odd, keys, symbols, depth = 0x9E3779B97F4A7C15, set(), [b + 1 for b in raw], 0
    while symbols:
        depth += 1
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        symbols = [mixed((s * odd + n) & ALL) if n > 1 else s for s, n in runs]
        labels = [tossed(~symbols[0] & ALL, symbols[0])] + [tossed(a, b) for a, b in zip(symbols, symbols[1:], strict=False)]
        for _ in range(3):
            labels = [tossed(labels[0] ^ 1, labels[0])] + [tossed(a, b) for a, b in zip(labels, labels[1:], strict=False)]
        starts = [0] + [i for i in range(1, len(symbols) - 1) if labels[i] > labels[i - 1] and labels[i] > labels[i + 1]]
        names = []
        for a, b in zip(starts, [*starts[1:], len(symbols)], strict=True):
            names.append(mixed((sum(mixed((s + odd * (i + 1)) & ALL) for i, s in enumerate(symbols[a:b])) + b - a) & ALL))
        keys |= {(mixed(n ^ odd) >> 32) // min(3 ** (depth - 1), 9) for n in names}
        symbols = names if len(names) > 1 else []
    return sorted(keys)[:k]


def likeness(a, b, k=phrases.SKETCH):
    if not a or not b:
        return float(len(a) == len(b))
    union = sorted({*a, *b})[:k]
    return sum(x in a and x in b for x in union) / len(union)


def hexed(sketch):
    return "".join(f"{x:08x}" for x in sketch)


def saved(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


def test_fingerprint_query(spark, tmp_path):
    rng = np.random.default_rng(12)
    words = ["alpha", "beta", "gamma", "aaaaaaa", "é漢字", "x"]
    texts = [" ".join(rng.choice(words, int(n))) for n in rng.integers(0, 120, 30)] + [None, "", "a", "ab", "aaaaaaaaaa", "same", "same", "long " * 3000]
    rows = [(i // 2 if i % 5 else None, t, "x", 1.0) for i, t in enumerate(texts)]
    saved(spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, part double"), tmp_path, "documents")
    listed = sorted(((i, t or "") for i, t, _, _ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = []
    for (i, text), (_, then) in zip(listed, listed[1:] + listed[:1], strict=True):
        k = len(text) // 3
        edited = text[: len(text) - k] + then[:k]
        own, other, following = (plain_sketch(t.encode()) for t in (text, edited, then))
        expected.append((some(i), len(text), sha(edited), hexed(own), hexed(other), likeness(own, other), likeness(own, following)))
    out = phrases.op10_fingerprints(spark, str(tmp_path)).collect()
    assert sorted((some(r[0]), *r[1:]) for r in out) == sorted(expected)


def test_fingerprint_leaves_the_table_as_it_is(spark):
    df = spark.createDataFrame([(1, "some text", "old")], "doc_id long, text string, fingerprint string")
    out = phrases.fingerprint(df)
    assert df.columns == ["doc_id", "text", "fingerprint"] == out.columns
    assert out.first()["fingerprint"] == hexed(plain_sketch(b"some text"))


def plain_tokens(text):
    kind = ["L" if unicodedata.category(c)[0] == "L" else "N" if unicodedata.category(c)[0] == "N" else "" for c in text]
    token = [bool(k) or (c in "$*@" and 0 < i < len(text) - 1 and kind[i - 1] == "L" == kind[i + 1]) for i, (c, k) in enumerate(zip(text, kind, strict=True))]
    at = 0
    while at < len(text):
        end = at
        while end < len(text) and token[end] == token[at]:
            end += 1
        yield at, end, token[at]
        at = end


def plain_score(text, model):
    """The score of one text, term by term."""
    terms, weights, intercept = model
    exacts, nears, hits, quotes, n_tokens = {}, {}, 0, 0, 0
    for a, b, token in plain_tokens(text):
        if not token:
            continue
        n_tokens += 1
        word = text[a:b].lower()
        equal = [i for i, (t, stem, _) in enumerate(terms) if not stem and t == word]
        begins = sorted((len(t), i) for i, (t, stem, _) in enumerate(terms) if stem and word.startswith(t))
        close = [(w, -i) for i, (t, stem, w) in enumerate(terms) if not stem and len(t) >= toxicity.FUZZY and distance(word, t) <= 1]
        term, into = (equal[0], exacts) if equal else (begins[0][1], exacts) if begins else (-max(close)[1], nears) if close else (None, None)
        if into is None:
            continue
        raw = text.encode()
        begin, end = len(text[:a].encode()), len(text[:b].encode())
        before, after = raw[max(0, begin - 48) : begin].decode(errors="ignore"), raw[end : end + 48].decode(errors="ignore")
        quoted = (sum(before.count(q) for q in toxicity.QUOTES) % 2 == 1 and any(q in after for q in toxicity.QUOTES)) or bool({*before.lower().split()[-4:]} & toxicity.REPORTING)
        into[term] = max(into.get(term, 0.0), terms[term][2] * (0.5 if quoted else 1.0))
        hits, quotes = hits + 1, quotes + quoted
    if not hits:
        features = [0.0] * 7
    else:
        features = [max(exacts.values(), default=0.0), math.log1p(sum(exacts.values())), math.log1p(len(exacts)), max(nears.values(), default=0.0), math.log1p(len(nears)), quotes / hits, math.log1p(100 * hits / n_tokens)]
    return 1 / (1 + math.exp(-intercept - sum(w * x for w, x in zip(weights, features, strict=True))))


def toxic_table(n=900):
    """Documents and labels of which every seventh is toxic."""
    rng = np.random.default_rng(5)
    clean = [f"{a}{b}" for a in ("river", "stone", "meadow", "cloud", "window") for b in ("side", "light", "ward", "land", "path")]
    docs, labels = [], []
    for i in range(n):
        words = list(rng.choice(clean, int(rng.integers(20, 60))))
        if i % 7 == 0:
            words[int(rng.integers(len(words)))] = str(rng.choice(["vilewort", "grumblescum", "Vilewort", '"vilewort"']))
        docs.append((i, " ".join(words), "en", f"s{i % 4}"))
        labels.append((i, int(i % 7 == 0)))
    return docs, labels


def hard_rows(first):
    same = " ".join(f"word{i}" for i in range(300))
    return [
        (first, same, "en", "s1"), (first + 1, same.replace("word150", "other"), "en", "s2"), (first + 2, same, "en", "s1"), (first + 2, same, "en", "s1"), (None, same, "en", "s1"),
        (None, "nobody  has this text", "en", None), (None, "nobody has\tthis text", "en", None), (first + 3, None, "en", "s1"), (first + 4, "", None, "s2"), (first + 5, " ", "en", "s3"),
        (first + 6, LONG, "en", "s3"), (first + 7, "vilewort grumblescum vilewort", "en", "s3"), (first + 7, "a vilewart of the river", "en", "s3"), (first + 8, "he said vilewort, é漢字 😀 b*ld", "en", None),
        (first + 9, "!", "en", "alone"), (None, None, None, None),
    ]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs, labels = toxic_table()
    rows = [(*r, "copy", 1) for r in docs + hard_rows(5000)]
    saved(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, __copy_of string, label long"), folder, "documents")
    saved(spark.createDataFrame([(i, 1, t) for i, t in labels] + [(3, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int"), folder, "labels")
    return folder, rows


def test_toxicity_query(spark, tables):
    folder, rows = tables
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    assert model[0]
    out = [(some(r["doc_id"]), r["held_out"], round(r["score"], 9), r["predicted"]) for r in toxicity.op9_toxicity(spark, folder).collect()]
    expected = []
    for i, text, *_ in rows:
        s = plain_score(text or "", model)
        expected.append((some(i), i is not None and zlib.crc32(str(i).encode()) % 5 == 0, round(s, 9), int(s >= 0.5)))
    assert sorted(out) == sorted(expected)


def plain_pipeline(rows, model):
    """The documents that each stage leaves."""
    left = [r for r in rows if plain_score(r[1] or "", model) < 0.5]
    yield left
    kept = {}
    for r in left:
        key = normal(r[1] or "")
        if key not in kept or (r[0] is None, r[0] or 0) < (kept[key][0] is None, kept[key][0] or 0):
            kept[key] = r
    left = list(kept.values())
    yield left
    prints = [plain_simhash(r[1] or "") for r in left]
    group = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    kept = {}
    for g, r in zip(group, left, strict=True):
        if g not in kept or (r[0] is None, r[0] or 0) < (kept[g][0] is None, kept[g][0] or 0):
            kept[g] = r
    left = list(kept.values())
    yield left
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in left]
    names = sorted({r[3] for r in left if r[3] is not None}) + [None] * any(r[3] is None for r in left)
    total = [sum(n for r, n in zip(left, sizes, strict=True) if r[3] == s) for s in names]
    goal = filled(total, [(5, 2, 1)[i % 3] for i in range(len(names))], 3)
    taken = []
    for name, target, size in zip(names, goal, total, strict=True):
        rate = target / size if size else 0.0
        own = [(r, n, int(hashlib.md5(f"mix-1:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:13], 16) / 2**52) for r, n in zip(left, sizes, strict=True) if r[3] == name]
        tries = []
        for turn in range(128):
            copies = [int(rate) + ((u + turn / 128) % 1 < rate - int(rate)) for _, _, u in own]
            tries.append((abs(sum(c * n for c, (_, n, _) in zip(copies, own, strict=True)) - target), turn, copies))
        best = min(tries)[2]
        taken += [r for c, (r, _, _) in zip(best, own, strict=True) for _ in range(c)]
    yield taken


def counted(rows):
    return Counter((r[0], r[1], *r[2:]) for r in rows)


def test_pipeline(spark, tables):
    import corpus_pipeline
    import public_tokenizers
    import tiktoken

    folder, rows = tables
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    columns = docs.columns
    for (_, stage), expected in zip(corpus_pipeline.STAGES[:-1], plain_pipeline(rows, model), strict=True):
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        assert counted(map(tuple, docs.collect())) == counted(expected)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.rank_file()), special_tokens={})
    plain = Counter((r[0], r[3], tuple(library.encode_ordinary(r[1] or "")), True) for r in expected)
    assert Counter((r["doc_id"], r["source"], tuple(r["ids"]), r["exact"]) for r in corpus_pipeline.run(spark, folder).collect()) == plain


def documents(spark, folder):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


SMALL = "/root/testdata/sf0.001"


def test_byte_bpe_query(spark):
    import public_tokenizers
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.rank_file()), special_tokens={})
    expected = []
    for i, text in documents(spark, SMALL):
        ids = library.encode_ordinary(text)
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(text)))
    assert sorted(map(tuple, queries.QUERIES["op1_byte_bpe"](spark, SMALL).collect())) == sorted(expected)


def test_token_file_query(spark):
    from tokenizers import Tokenizer

    library, start, expected = Tokenizer.from_file(token_file.tokenizer_file()), 0, []
    for i, text in sorted(documents(spark, SMALL)):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.QUERIES["op5_token_file"](spark, SMALL).collect())) == expected


def test_suffix_dedup_query(spark):
    expected = [(i, n, gone, spans, sha(rest)) for (_, i), n, gone, spans, rest in without_repeats(documents(spark, SMALL), 200, "none")]
    assert sorted(map(tuple, queries.QUERIES["op6_suffix_dedup"](spark, SMALL).collect())) == sorted(expected)


def test_simhash_query(spark):
    docs = sorted(documents(spark, SMALL))
    prints = [plain_simhash(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    expected = [(i, f"{p:016x}", docs[g][0]) for (i, _), p, g in zip(docs, prints, group, strict=True)]
    assert sorted(map(tuple, queries.QUERIES["op8_simhash"](spark, SMALL).collect())) == expected


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    saved(spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"), tmp_path, "documents")
    saved(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
