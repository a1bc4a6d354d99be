"""Text and value functions on literals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terroir.functions import text as X
from terroir.functions import values as V


def value(spark, make, *cells):
    df = spark.createDataFrame([cells], ", ".join(f"c{i} {'string' if not isinstance(c, (int, float, list)) else 'array<string>' if isinstance(c, list) else 'double'}" for i, c in enumerate(cells)))
    return df.select(make(*[F.col(f"c{i}") for i in range(len(cells))])).first()[0]


@pytest.mark.parametrize(
    ("raw", "region", "clean"),
    [
        ("딸기(삼례,고산)", "", "딸기"), ("딸기(삼례", "", "딸기"), ("양파, 마늘", "", "양파"), ("[특산] 감", "", "[특산] 감"), ("순창고추장", "순창군", "고추장"), ("순창", "순창군", "순창"), ("  ", "", ""), ("사과（청송）", "", "사과"),
    ],
)
def test_clean_item_name(spark, raw, region, clean):
    assert value(spark, X.clean_item_name, raw, region) == clean


@pytest.mark.parametrize(
    ("name", "stage"),
    [("매실청", "processed"), ("조청", "processed"), ("미가공 감자", "raw"), ("신선한 사과", "raw"), ("쌀", "raw"), ("사과가공식품", "processed"), ("주", "raw"), ("간고등어", "processed"), ("", None)],
)
def test_specialty_stage(spark, name, stage):
    assert value(spark, X.specialty_stage, name) == stage


@pytest.mark.parametrize(("status", "found"), [("등록", "registered"), ("등록취소", "inactive"), ("출원공고", "pending"), ("", "unknown"), (None, "unknown")])
def test_status_precedence(spark, status, found):
    assert value(spark, X.status_category, status) == found


@pytest.mark.parametrize(("name", "is_producer"), [("강화군", True), ("주식회사 강화군", False), ("청송영농조합법인", True), ("", False), ("아주아주긴이름의어떤회사의도시", False)])
def test_producer(spark, name, is_producer):
    assert value(spark, X.is_producer_like, name) is is_producer


@pytest.mark.parametrize(("word", "marked"), [("강릉시", "강릉시는"), ("청송군", "청송군은"), ("ABC", "ABC는")])
def test_topic_marker(spark, word, marked):
    assert value(spark, X.topic_marker, word) == marked


def test_bigrams_and_jaccard(spark):
    assert value(spark, X.bigrams, "감자") == ["감자"]
    assert value(spark, X.bigrams, "감") == ["감"]
    assert value(spark, X.bigrams, "") == []
    assert value(spark, lambda a, b: X.jaccard(X.bigrams(a), X.bigrams(b)), "abc", "bcd") == pytest.approx(1 / 3)


@pytest.mark.parametrize(("a", "b", "held"), [("단감", "옷단감치는", False), ("탈", "하회탈", True), ("감", "감자", True), ("", "감자", False)])
def test_edge_containment(spark, a, b, held):
    assert value(spark, X.contains_at_edge, a, b) is held


@pytest.mark.parametrize(("title", "classes", "stage"), [("유자차", ["30"], "processed"), ("미가공 유자", ["31"], "raw"), ("유자 마을", ["43"], "service"), ("유자", ["9"], "excluded"), ("유자", ["30", "43"], "raw")])
def test_hit_stage(spark, title, classes, stage):
    assert value(spark, lambda t, k: X.hit_stage(t, k, F.lit("유자")), title, classes) == stage


def test_class_codes(spark):
    assert value(spark, X.class_list, "008|x|  |30") == ["8", "x", "30"]
    assert value(spark, X.region_code, "11110") == "1111000000"
    assert value(spark, X.region_code, "1111") == ""


@pytest.mark.parametrize(("text", "day"), [("20240229", dt.date(2024, 2, 29)), ("20240231", None), ("2024-02-01", None), ("", None)])
def test_strict_date(spark, text, day):
    assert value(spark, V.strict_date, text) == day


@pytest.mark.parametrize(("text", "month"), [("20240304", "2024-03"), ("2024-13-01", None), ("17991201", None), ("2024", None), (None, None)])
def test_valid_month(spark, text, month):
    assert value(spark, V.valid_month, text) == month


def test_rates(spark):
    assert value(spark, V.safe_rate, 1.0, 3.0) == 0.3333
    assert value(spark, V.safe_rate, 1.0, 0.0) is None
    assert value(spark, X.percent, 0.256) == "26%"
    assert value(spark, lambda c: X.percent(F.lit(None).cast("double")), "x") == "확인불가"


def test_unicode(spark):
    assert value(spark, X.unicode_normalize, "가") == "가"
