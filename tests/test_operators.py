"""Operators on small tables with expected results."""

import random

import pytest
from pyspark.sql import functions as F

from terroir.operators import analyze as A
from terroir.operators import common as C
from terroir.operators import distinct as D
from terroir.operators import enrich as E
from terroir.operators import insights as I2
from terroir.operators import items as I
from terroir.operators import regions as G
from terroir.operators import review as Q
from terroir.operators import score as S
from terroir.operators import snapshot as N
from terroir.plans.base import Tables
from terroir.sources import files as L


def listed(df):
    return sorted(tuple(r) for r in df.collect())


def test_longest_name_wins_and_ties_are_kept(spark):
    master = spark.createDataFrame([("1", "양주시", "경기도"), ("2", "남양주시", "경기도"), ("3", "중구", "서울"), ("4", "중구", "부산")], "code string, region string, province string")
    texts = spark.createDataFrame([("경기도 남양주시 와부읍",), ("중구",), ("부산 중구",), ("모름",)], "text string")
    out = {r["text"]: r for r in G.resolve(texts, [("name", G.by_longest_name(texts, master))], master).collect()}
    assert out["경기도 남양주시 와부읍"]["region"] == "남양주시"
    assert out["중구"]["status"] == "ambiguous"
    assert (out["부산 중구"]["status"], out["부산 중구"]["province"]) == ("resolved", "부산")
    assert out["모름"]["status"] == "unresolved"


@pytest.mark.parametrize(
    ("rows", "raw", "relation"),
    [
        ([("inside", False), ("inside", True)], True, "inside"), ([("inside", True), ("outside", False)], True, "inside"), ([("inside", False), ("outside", False)], True, "outside"),
        ([("inside", False), ("outside", False)], False, "inside"), ([("unverified", False), ("outside", False)], False, "unverified"), ([], True, "unverified"),
    ],
)
def test_joint_applicants(spark, rows, raw, relation):
    df = spark.createDataFrame([(rows,)], "a array<struct<relation:string,producer:boolean>>")
    assert df.select(G.fold_applicants(F.col("a"), F.lit(raw))).first()[0] == relation


def test_first_wins_by_order(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("l", 1, "c")], "k string, o int, v string")
    assert listed(A.first_wins(df, ["k"], ["o"]).select("k", "v")) == [("k", "a"), ("l", "c")]


def test_record_keys(spark):
    df = spark.createDataFrame([("40-2025-1", None, "t"), ("4020251", None, "t"), (" ", "R 1", "t"), (None, None, "t")], "app string, reg string, title string")
    keys = [r[0] for r in df.select(A.record_key(F.col("app"), F.col("reg"), F.col("title"))).collect()]
    assert keys == ["app:40-2025-1", "app:4020251", "reg:R1", "fallback:t"]


def test_rollup_dedupes_again_at_each_level(spark):
    rows = [("r1", "a", 1, 1, "inside"), ("r2", "a", 1, 2, "outside"), ("r2", "b", 1, 3, "inside"), ("r1", "a", 1, 4, "outside")]
    df = spark.createDataFrame(rows, "region string, item string, app int, o int, relation string")
    out = listed(A.rollup_distinct(df, {"cell": ["region", "item"], "item": ["item"], "total": []}, "app", ["o"]))
    assert ("cell", "r1", "a", 1, 1) in out
    assert ("item", "all", "a", 1, 1) in out
    assert ("total", "all", "all", 1, 1) in out


@pytest.mark.parametrize(
    ("n", "rate", "flagged", "availability", "verified", "expected"),
    [
        (5, 1.0, False, "available", None, (True, 0.0, "preview", False)), (0, None, True, "available", None, (True, 1.0, "preview", False)), (2, 0.5, False, "available", None, (False, None, "not_applicable", False)),
        (9, 0.1, False, "available", None, (True, 0.27, "preview", True)), (9, 0.1, True, "blocked", None, (True, None, "blocked", False)), (9, 0.1, False, "partial", 0.5, (None, None, "blocked", False)),
        (9, 0.5, False, "partial", None, (True, 0.15, "preview", False)),
    ],
)
def test_gap_score(spark, n, rate, flagged, availability, verified, expected):
    df = spark.createDataFrame([(n, rate, flagged, availability, verified)], "n int, rate double, flagged boolean, availability string, verified double")
    assert tuple(df.select(*S.gap_score(*map(F.col, df.columns))).first()) == expected


def test_availability(spark):
    df = spark.createDataFrame([(2, 0, 0, 0, 2), (2, 1, 0, 0, 2), (1, 0, 1, 0, 2), (0, 0, 0, 0, 0)], "ok int, part int, bad int, skip int, q int")
    assert [r[0] for r in df.select(A.availability(*map(F.col, df.columns))).collect()] == ["available", "partial", "blocked", "blocked"]


def test_several_exact_matches_are_a_review(spark):
    names = spark.createDataFrame([("감",), ("배",), ("귤",)], "name string")
    d = spark.createDataFrame([("감", "31"), ("감", "29"), ("신선한 배", "31")], "item string, class string")
    out = {r["name"]: (r["rung"], r["matches"], r["item"]) for r in I.exact_cascade(names, d, ["신선한 "]).collect()}
    assert out == {"감": (0, 2, None), "배": (1, 1, "신선한 배"), "귤": (None, 0, None)}


def test_fuzzy_finds_short_entries_and_drops_services(spark):
    q = spark.createDataFrame([("하회탈",), ("감",)], "query string")
    d = spark.createDataFrame([("탈", "28"), ("하회 마을", "43"), ("단감", "31"), ("옷단감치기", "7")], "item string, class string")
    out = {(r["query"], r["item"]): r["score"] for r in I.fuzzy_candidates(q, d).collect()}
    assert out == {("하회탈", "탈"): 0.5, ("감", "단감"): 0.5}


def test_derived_rows(spark):
    rows = spark.createDataFrame([("r", "생강조청", 1), ("r", "매실청", 2), ("r", "매실즙", 3), ("s", "매실청", 4), ("s", "매실", 5), ("r", "조청", 6)], "region string, item string, o int")
    bases = spark.createDataFrame([("생강",), ("매실",), ("조",)], "item string")
    out = I.derived_rows(rows, bases, ["청", "조청", "즙"], ["조청"], "o")
    assert listed(out) == [("r", "매실", "청", 2), ("r", "생강", "조청", 1)]


def test_archive_reverts_to_an_old_version(spark):
    r = spark.createDataFrame([(1, "b", 2, "r0"), (2, "x", 1, "r0"), (4, "q", 1, "r0")], "key long, hash string, version int, last_run string")
    v = spark.createDataFrame([(1, 1, "a", "A"), (1, 2, "b", "B"), (2, 1, "x", "X"), (4, 1, "q", "Q")], "key long, version int, hash string, payload string")
    b = spark.createDataFrame([(1, "a", "A"), (2, "y", "Y"), (3, "n", "N"), (4, "q", "Q")], "key long, hash string, payload string")
    records, versions, counts = N.archive_upsert(r, v, b, "r1")
    assert listed(records) == [(1, "a", 1, "r1"), (2, "y", 2, "r1"), (3, "n", 1, "r1"), (4, "q", 1, "r1")]
    assert dict(counts.collect()) == {"reverted": 1, "updated": 1, "inserted": 1, "unchanged": 1}
    assert versions.count() == 6
    again, versions2, counts2 = N.archive_upsert(records, versions, b, "r2")
    assert dict(counts2.collect()) == {"unchanged": 4}
    assert versions2.count() == 6


def test_reconcile_never_falls_and_respects_tombstones(spark):
    p = spark.createDataFrame([("a", 5), ("b", 3), ("c", 9), ("d", 1)], "k string, n int")
    c = spark.createDataFrame([("a", 2), ("e", 4)], "k string, n int")
    dead = spark.createDataFrame([("c",)], "k string")
    assert listed(N.reconcile(p, c, ["k"], ["n"], dead, 5)) == [("a", 5, "kept"), ("b", 3, "revived"), ("d", 1, "revived"), ("e", 4, "new")]
    assert ("b", 3, "blocked") in listed(N.reconcile(p, c, ["k"], ["n"], dead, 1))


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing: z"):
        C.require_columns(spark.range(1), "id", "z")


def test_broadcast_is_checked(spark):
    plan = lambda limit: spark.range(5).join(C.checked_broadcast(spark.range(3), limit), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(3)
    assert "strategy=broadcast" not in plan(2)


def test_broadcast_check_counts_bytes(spark):
    """A few wide rows aren't broadcast; an empty table, null values and repeated column names are counted."""
    hinted = lambda df, most: "strategy=broadcast" in C.checked_broadcast(df, most=most)._jdf.queryExecution().analyzed().toString()
    wide = spark.range(3).withColumn("v", F.repeat(F.lit("x"), 1000)).withColumn("none", F.lit(None).cast("string"))
    assert hinted(wide, 4000) and not hinted(wide, 2999)
    assert hinted(wide.limit(0), 0)
    assert not hinted(wide.withColumn("w", F.col("v")).toDF("id", "v", "none", "v"), 5000)


def test_csv_with_mark_quotes_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿sido,item\n경기도,"감, ""단감"""\n,\n강원도,\n', encoding="utf-8")
    assert listed(L.scan_csv(spark, str(tmp_path / "a.csv"), ["sido", "item"])) == [("강원도", ""), ("경기도", '감, "단감"')]
    with pytest.raises(ValueError, match="missing"):
        L.scan_csv(spark, str(tmp_path / "a.csv"), ["region"])


def test_denied_responses_are_rejected(spark):
    pages = spark.createDataFrame([("<r><resultCode>00</resultCode><totalCount>3</totalCount></r>",), ("<r><resultCode>20</resultCode><resultMsg>no result</resultMsg></r>",), ("<r><resultCode>20</resultCode><resultMsg>access denied</resultMsg></r>",)], "x string")
    good, bad = L.valid_responses(L.xml_headers(pages, "x"))
    assert (good.count(), [r["reason"] for r in bad.collect()]) == (2, ["denied"])


def test_html_table_rows_are_paired(spark):
    page = spark.createDataFrame([(1, "<table><tr><td>사과&amp;배</td></tr><tr><td>청송</td></tr></table>")], "id int, html string")
    assert listed(L.scan_html_list(page, "html", "tr", pairs=True)) == [(1, 0, "사과&배", "청송")]


def test_running_sums_and_numbers(spark):
    df = spark.range(500).selectExpr("id % 50 v", "id").repartition(7)
    out = {r["id"]: (r["n"], r["v"]) for r in C.numbered(df, [F.desc("v"), F.col("id")], "n").collect()}
    assert [i for i, _ in sorted(out.items(), key=lambda x: x[1][0])] == sorted(out, key=lambda i: (-(i % 50), i))
    sums = {r["id"]: r["s"] for r in C.running(df, [F.col("id")], F.col("v"), "s").collect()}
    assert sums == {i: sum(j % 50 for j in range(i + 1)) for i in range(500)}
    assert C.numbered(df.limit(0), [F.col("id")]).count() == 0


def test_names_contained_in_texts(spark):
    texts, names = ["abcabc", "", None, "xabx", "c"], ["a", "abc", "bca", "", None, "zz", "c"]
    t, n = spark.createDataFrame([(x,) for x in texts], "text string"), spark.createDataFrame([(x,) for x in names], "name string")
    assert sorted(map(tuple, C.contained(t, "text", n, "name").collect())) == sorted((x, y) for x in texts for y in names if x and y and y in x)
    assert C.contained(t, "text", n.limit(0), "name").count() == 0


def test_codes_of_places(spark):
    """Short and replaced codes find their master; a code of two masters finds none."""
    master = spark.createDataFrame([("4136000000", "남양주시", "경기도"), ("11", "kept", "p"), ("2600000000", "x", "p"), ("26000", "y", "p")], "code string, region string, province string")
    texts = spark.createDataFrame([("a", "41360"), ("b", "4199900000"), ("c", "11"), ("d", "2600000000"), ("e", ""), ("f", None)], "text string, code string")
    moved = spark.createDataFrame([("41999", "4136000000")], "old string, new string")
    assert listed(G.by_code(texts, master, moved)) == [("a", "남양주시", "경기도"), ("b", "남양주시", "경기도"), ("c", "kept", "p")]


def test_whole_texts_are_normalised(spark):
    from terroir.functions import text as X

    df = spark.createDataFrame([("e\u0301" * 100050,)], "text string")
    assert df.select(F.length(X.unicode_normalize(F.col("text")))).first()[0] == 100050


def test_document_ids_depend_on_order_and_content_only(spark):
    import hashlib

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    df = spark.range(10).selectExpr("id at", "id * id v")
    digests = [sha(f'{{"v":{i * i}}}') for i in range(10)]
    assert Q.document_id(df.repartition(3), ["v"], ["at"]).first()[0] == "sha256-" + sha("".join(digests))[:20]
    threes = [sha("".join(digests[i : i + 3])) for i in range(0, 10, 3)]
    pairs = [sha("".join(threes[:3])), sha(threes[3])]
    assert Q.document_id(df, ["v"], ["at"], width=3).first()[0] == "sha256-" + sha("".join(pairs))[:20]


def test_review_clusters(spark):
    """A row that lists a candidate twice counts once; spellings of one name are one cluster."""
    schema = "idx int, name string, reason string, region string, source string, candidates array<struct<item:string,class:string,score:double>>"
    a, b = ("jam", "1", 0.5), ("tea", "2", 0.25)
    rows = [(1, "Red Jam", "x", "r", "s", [a, a]), (2, "red jam", "y", "r", "t", [a, b]), (3, "red jam", "x", None, "s", [b]), (4, None, "z", "q", None, []), (5, "", "z", "q", None, None)]
    out = {r["cluster"]: r for r in Q.review_clusters(spark.createDataFrame(rows, schema), examples=2).collect()}
    assert set(out) == {"redjam", "row:4", "row:5"}
    r = out["redjam"]
    assert (r["n_rows"], r["regions"], r["sources"], r["name"], r["state"], r["examples"]) == (3, 1, 2, "red jam", "mixed", [1, 2])
    assert [(o["item"], o["rows"], o["coverage"], o["score"]) for o in r["options"]] == [("jam", 2, 0.6667, 0.5), ("tea", 2, 0.6667, 0.25)]
    assert [tuple(x) for x in r["reasons"]] == [("x", 2), ("y", 1)]
    assert (out["row:4"]["state"], out["row:4"]["name"]) == ("none", None)


def test_aliases_given_twice_are_reviewed_with_their_smallest_target(spark):
    aliases = spark.createDataFrame([("x", "n2", 2), ("x", "n1", 1), ("y", "n1", 1), ("z", "n3", 3)], "alias string, notice string, class int")
    dictionary = spark.createDataFrame([("n1", 1), ("n2", 2)], "item string, class int")
    names = spark.createDataFrame([("x",), ("y",), ("z",), ("w",)], "name string")
    for given in (aliases, aliases.orderBy("notice")):
        assert listed(I.approved_aliases(names, given, dictionary)) == [("x", "n1", 1, "review_required"), ("y", "n1", 1, "ok"), ("z", "n3", 3, "review_required")]


def plain_candidates(queries, entries, k):
    def pairs(x):
        return {x[i : i + 2] for i in range(max(len(x) - 1, 1))}

    out = []
    for q in {q for q in queries if q}:
        scored = []
        for item, number in {e for e in entries if e[0] and (e[1] is None or e[1] < 35)}:
            a, b = pairs(q), pairs(item)
            edge = q.startswith(item) or q.endswith(item) or item.startswith(q) or item.endswith(q)
            score = len(a & b) / len(a | b) + 0.5 * edge
            if score > 0:
                scored.append((-score, item, number))
        out += [(q, item, number, round(-score, 9), i + 1) for i, (score, item, number) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_fuzzy_candidates_equal_brute_force(spark, k):
    """Random texts over few characters: many ties, frequent pairs, texts of one character, queries with too few entries."""
    rng = random.Random(k)
    word = lambda: "".join(rng.choices("abcdefgh", weights=[20, 20, 10, 5, 2, 1, 1, 1], k=rng.choice([1, 2, 3, 4, 6, 9])))
    queries = [word() for _ in range(60)] + ["", None, "zzz", "q", "aaaa"]
    entries = [(word(), rng.randrange(1, 45)) for _ in range(150)] + [("", 1), ("z", 1), ("aaa", 2), ("aaa", 2)]
    q, d = spark.createDataFrame([(x,) for x in queries], "query string"), spark.createDataFrame(entries, "item string, class int")
    out = [(r["query"], r["item"], r["class"], round(r["score"], 9), r["pos"]) for r in I.fuzzy_candidates(q, d, k).collect()]
    assert sorted(out) == plain_candidates(queries, entries, k)


def test_few_pairs_are_formed(spark):
    """Names with a frequent ending: most share character pairs with most others, few can be among the best."""
    rng = random.Random(3)
    names = sorted({"".join(chr(0xAC00 + int(rng.paretovariate(0.7)) % 400) for _ in range(rng.randrange(2, 7))) + rng.choice(["가공품", "제품", ""]) for _ in range(2000)})
    d = spark.createDataFrame([(n, 1) for n in names], "item string, class int")
    q = spark.createDataFrame([(n[1:] + "류",) for n in names[::20]], "query string")
    pairs, all_pairs = I.fuzzy_pairs(q, d, 5).count(), q.count() * d.count()
    assert pairs < 0.1 * all_pairs, (pairs, all_pairs)


def test_containment_equals_brute_force(spark):
    rng = random.Random(5)
    word = lambda most: "".join(rng.choices("abc ", k=rng.randrange(most)))
    texts, names = [word(40) for _ in range(200)] + [None, ""], sorted({word(9) for _ in range(120)}) + [None]
    t, n = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, text string"), spark.createDataFrame([(x, i) for i, x in enumerate(names)], "name string, at int")
    expected = sorted((i, j) for i, x in enumerate(texts) for j, y in enumerate(names) if x and y and y in x)
    assert sorted((r["id"], r["at"]) for r in C.contained(t, "text", n, "name").collect()) == expected
    assert sorted((r["id"], r["at"]) for r in C.contained(t, "text", n, "name", gram=2).collect()) == expected


def test_goods_evidence_of_hard_rows(spark):
    """Nulls, empty names, no classes asked for, repeated goods, an alias that is found, and a limit."""
    schema = "id int, classes array<int>, products array<struct<class int, name string, goods string>>"
    rows = [
        (1, [1], None), (2, [1], []), (3, [1], [(2, "인삼", "인삼")]), (4, [1], [(1, "다른것", "다른것")]), (5, [], [(None, "인삼차", "인삼차"), (3, "인삼", "인삼")]),
        (6, [30], [(30, "가공된인삼", "가공된 인삼"), (30, "인삼차", "인삼차"), (30, "인삼차", "인삼차"), (30, "", ""), (30, None, None)]), (7, [5], [(5, f"인삼{i}", f"인삼{i}") for i in range(60)]),
    ]
    target = lambda name, stage: F.struct(F.lit(name).alias("name"), F.lit(f"N{name}").alias("notice"), F.lit(stage).alias("stage"))
    targets = F.array(target("인삼", None), target("인삼차", "가공"))
    found = spark.createDataFrame(rows, schema).select("id", E.goods_evidence(targets, F.col("products"), F.col("classes")).alias("m")).select("id", "m.*").collect()
    out = {r["id"]: (r["method"], r["confidence"], r["review"], r["notice"], r["stage"], r["products"], r["class_matched"], [tuple(x) for x in r["evidence"]]) for r in found}
    assert out[1] == out[2] == ("unverified", "unverified", True, None, None, 0, 0, [])
    assert out[3] == ("mismatch", "high", True, None, None, 1, 0, [])
    assert out[4] == ("class_only", "candidate_only", True, None, None, 1, 1, [])
    assert out[5] == ("normalized_exact", "high", False, "N인삼차", "가공", 2, 2, [(None, "인삼차", "exact", "인삼차"), (3, "인삼", "exact", "인삼")])
    assert out[6] == ("normalized_exact", "high", False, "N인삼차", "가공", 5, 5, [(30, "인삼차", "exact", "인삼차"), (30, "가공된 인삼", "contains", "인삼")])
    assert out[7][:2] == ("normalized_contains", "high_contains") and len(out[7][-1]) == 50


def test_missing_keys_have_one_reason_each(spark):
    schema = "region string, item string, specialty string"
    old = spark.createDataFrame([("전국", "사과", "apple"), ("청송", "사과", "apple"), ("청송", "파프리카", "pepper"), ("청송", "금지", "x"), ("청송", "폐지", "y"), ("청송", "실종", "z"), ("청송", "무명", None), (None, "빈곳", "apple")], schema)
    new = spark.createDataFrame([("청송", "사과", "apple"), ("청송", "풋고추", "pepper"), ("안동", "무명", None)], schema)
    buried = spark.createDataFrame([("청송", "폐지")], "region string, item string")
    out = {(r["region"], r["item"]): r["reason"] for r in N.missing_keys(old, new, ["region", "item"], buried, "item", "region", "specialty", F.col("item") == "금지", F.col("region") == "전국").collect()}
    expected = {("전국", "사과"): "relocated", ("청송", "파프리카"): "renamed", ("청송", "금지"): "excluded", ("청송", "폐지"): "tombstone", ("청송", "실종"): "revived", ("청송", "무명"): "revived", (None, "빈곳"): "revived"}
    assert out == expected
    report = N.reconcile_report(old.withColumn("m", F.lit(5)), new.withColumn("m", F.lit(3)).withColumn("ok", F.col("item") != "사과"), ["region", "item"], "m", N.missing_keys(old, new, ["region", "item"], buried, "item", "region", "specialty", F.col("item") == "금지", F.col("region") == "전국"), 2, "ok").first().asDict()
    assert report == {"added": 2, "retained": 1, "floor_retained": 1, "upgraded": 0, "tombstone": 1, "excluded": 1, "relocated": 1, "renamed": 1, "revived": 3, "blocked": True}


def test_features_that_an_item_lacks(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("b", "y"), ("c", "y"), ("c", "z"), ("c", "w"), ("d", "v")]
    df = spark.createDataFrame(rows, "item string, feature string")
    out = listed(I2.lacking(df, "item", "feature", [F.col("users"), F.col("feature")], 2))
    assert out == [("a", "v", 1, 1, 1), ("a", "w", 1, 1, 2), ("b", "v", 1, 1, 1), ("b", "w", 1, 1, 2), ("c", "v", 1, 1, 1), ("c", "x", 1, 2, 2), ("d", "w", 1, 1, 1), ("d", "x", 1, 2, 2)]
    shaped = I2.templates(spark.createDataFrame([("감", "가공된감"), ("감", "감"), ("감", "감(청도)"), ("감", "사과"), ("", "x")], "item string, goods string"), "item", "goods", "{}")
    assert [r["template"] for r in shaped.collect()] == ["가공된{}"]


def test_distinct_counts_by_bitmaps_equal_counts_of_distinct_keys(spark):
    """Keys in several cells, repeated rows, null keys and cells, more keys than a bitmap has places, and empty tables."""
    df = spark.range(90_000).selectExpr("cast(id % 40000 as string) key", "id % 7 region", "case when id % 11 = 0 then null else cast(id % 3 as string) end item", "id % 5 = 0 ok")
    df = df.unionByName(spark.createDataFrame([(None, 1, "0", True), ("x", None, None, True), ("x", None, None, False)], df.schema))
    levels = {"cell": ["region", "item"], "region": ["region"], "all": []}
    out = D.distinct_counts(df, "key", levels, {"n": F.lit(True), "ok_ones": F.col("ok")})
    for level, cells in levels.items():
        plain = df.filter("key is not null").groupBy(*cells).agg(F.count_distinct("key").alias("n"), F.count_distinct(F.when(F.col("ok"), F.col("key"))).alias("ok_ones"))
        plain = plain.select(*[F.col(c).cast("string").alias(c) if c in cells else F.lit("all").alias(c) for c in levels["cell"]], "n", "ok_ones")
        assert sorted(map(tuple, out.filter(F.col("level") == level).drop("level").collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    sets = D.key_sets(df, "key", ["region", "item"], {"n": F.lit(True)})
    assert sets.count() < 5 * df.select("region", "item").distinct().count(), "keys of a cell are neighbours"
    assert listed(D.distinct_counts(df.limit(0), "key", levels, {"n": F.lit(True)})) == [("all", "all", "all", 0)]


def test_table_difference(spark):
    schema = "k int, x string, v double"
    old = spark.createDataFrame([(i, str(i % 3), i / 2) for i in range(500)] + [(None, "n", None)], schema)
    new = old.filter("k is null or k <> 7").withColumn("v", F.when(F.col("k") == 9, None).otherwise(F.col("v"))).unionByName(spark.createDataFrame([(-1, "x", 1.0)], schema))
    assert listed(N.table_difference(old, new, ["k"], 16)) == [(-1, "added"), (7, "removed"), (9, "changed")]
    renamed = old.withColumn("x", F.when(F.col("k").isNull(), "m").otherwise(F.col("x")))
    assert [tuple(r) for r in N.table_difference(old, renamed, ["k"]).collect()] == [(None, "changed")]
    same = N.table_difference(old, old.repartition(3).select("v", "k", "x"), ["k"])
    assert same.count() == 0 and same.columns == ["k", "change"]
    assert "Join" not in same._jdf.queryExecution().executedPlan().toString()
    assert listed(N.table_difference(old.limit(0), old.filter("k < 2"), ["k"])) == [(0, "added"), (1, "added")]
