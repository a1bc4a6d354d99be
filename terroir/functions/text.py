"""Text functions: Column to Column, all built from Spark's own functions but for ``unicode_normalize``."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Word lists of the attribution rules.
INACTIVE_WORDS = ["거절", "취하", "포기", "소멸", "무효", "취소"]
REGISTERED_WORD = "등록"
PENDING_WORDS = ["출원", "심사", "공고"]
PRODUCER_HINTS = ["영농조합", "농업회사법인", "협동조합", "생산자", "작목반", "축협", "수협", "산림조합", "농협", "연구소", "기술센터", "농업기술원", "영어조합", "어업회사법인", "어촌계"]
CORPORATE_HINTS = ["주식회사", "(주)", "㈜", "컴퍼니", "코퍼레이션", "Inc", "Corp"]
PROCESSED_SUFFIXES = ["말랭이", "농축액", "엑기스", "진액", "원액", "통조림", "장아찌", "액젓", "조청", "한과", "막걸리", "주스", "식초", "와인", "소주", "청주", "김치", "절임", "과자", "찐빵", "잼", "즙", "차", "청", "환", "빵", "떡", "면", "칩", "주", "젓", "장", "가루", "기름"]
WHOLE_ITEM_NAMES = ["조청", "엿기름", "참기름", "들기름", "녹차", "황차", "홍차", "말차", "메주", "된장", "간장", "고추장", "쌈장", "청국장", "소주", "청주", "탁주", "약주", "막걸리", "동동주", "찐빵", "한과", "유과", "약과", "식혜", "수정과", "김치"]
PROCESSED_WHOLE_NAMES = ["간고등어", "간미역", "아이스홍시", "알밤묵"]
PROCESSED_MARKERS = ["가공", "식품", "절임", "훈제", "발효", "염장", "조미", "세트", "소스", "요구르트", "치즈", "순대", "육포", "젤리", "죽염", "국수", "송편", "빼떼기", "쫀득이", "백반", "볶음탕", "다시마장", "분말", "밀키트", "두부", "어묵", "피클", "통조림", "건조"]
FRESH_PREFIX = r"^(신선한|미가공|무가공|살아있는)\s*"
EXCLUDED_SUFFIX = r"(나무|묘목|모종|종묘|종자|씨앗)$"
EXCLUDED_NAMES = ["기타"]
TITLE_SUFFIXES = ["주", "차", "즙", "청", "환", "정", "면", "빵", "떡", "엿", "장"]
TITLE_WORDS = ["막걸리", "소주", "와인", "리큐르", "브랜디", "주스", "음료", "에이드", "잼", "정과", "당절임", "장아찌", "절임", "피클", "식혜", "식초", "국수", "과자", "스낵", "쿠키", "파이", "가루", "분말", "캡슐", "엑기스", "농축액", "추출물", "진액", "젓갈", "통조림", "소스", "드레싱", "조청", "로션", "크림", "에센스", "화장품", "비누", "팩", "가공", "구이", "훈제", "육포", "볶음", "건강기능식품"]
RAW_CLASSES = ["29", "30", "31"]
GOODS_CLASSES = ["29", "30", "31", "32", "33"]
SERVICE_CLASSES = ["35", "39", "40", "41", "42", "43", "44", "45"]
#: Patterns of the same rules.
CANONICAL_DROP = r"[\s'\"`()\[\]{}._-]+"
PARENTHESES = r"\s*[（(][^）)]*[）)]"
OPEN_BRACKET = r"(?s)\s*[（(\[].*$"
BRACKETS = r"\[[^\]]*\]"
SEGMENT_END = "[,，;；]"
GOODS_DROP = "[^0-9a-z가-힣]"
NEGATED = "(미|무)가공"
REGION_WORD = r"[^\s()]+(?:특별자치도|특별자치시|광역시|특별시|도|시|군|구)(?=\s|$)"
REGION_ENDING = "(특별자치도|특별자치시|광역시|특별시|도|시|군|구)$"


def unicode_normalize(c: Column, form: str = "NFC") -> Column:
    """Unicode normalisation, for which Spark has no function."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: unicodedata.normalize(form, x), na_action="ignore")

    return run(c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def compact(c: Column, separators: str = r"[\s·,./_-]+") -> Column:
    return F.regexp_replace(c, separators, "")


def canonical_name(c: Column) -> Column:
    """Lower case without spaces, quotes, brackets, dots, underscores and hyphens."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), CANONICAL_DROP, "")


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def region_code(c: Column) -> Column:
    """A ten-digit code: five digits are padded, anything else is empty."""
    d = digits_only(F.coalesce(c, F.lit("")))
    return F.when(F.length(d) == 10, d).when(F.length(d) == 5, F.rpad(d, 10, "0")).otherwise("")


def class_code(c: Column) -> Column:
    """'008' to '8'; what isn't a number is kept."""
    t = F.trim(c)
    return F.coalesce(t.try_cast("int").cast("string"), t)


def class_list(c: Column, separator: str = r"\|") -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), separator), class_code), lambda x: x != "")


def bigrams(c: Column) -> Column:
    """Distinct character pairs; a single character stands for itself, an empty text has none."""
    n = F.length(c)
    pairs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(c, i, 2)))
    return F.when(n >= 2, pairs).when(n == 1, F.array(c)).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def contains_at_edge(a: Column, b: Column) -> Column:
    """Whether the shorter stands at the beginning or the end of the longer."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    return (F.length(short) > 0) & (F.startswith(long, short) | F.endswith(long, short))


def any_of(words: list[str]) -> str:
    """A pattern that matches any of the words literally."""
    return "|".join("\\Q" + w + "\\E" for w in words)


def strip_region_names(c: Column, *names: Column) -> Column:
    """Removes region names, and their roots without the last character where these are longer than one."""
    for name in names:
        name = F.coalesce(name, F.lit(""))
        root = F.substring(name, F.lit(1), F.length(name) - 1)
        c = F.when(name != "", F.replace(c, name, F.lit(""))).otherwise(c)
        c = F.when(F.length(root) >= 2, F.replace(c, root, F.lit(""))).otherwise(c)
    return F.trim(c)


def clean_item_name(item: Column, *regions: Column) -> Column:
    """An item name without region, brackets and what follows a separator; the raw name if nothing is left."""
    raw = F.trim(F.coalesce(item, F.lit("")))
    c = F.coalesce(blank_to_null(strip_region_names(raw, *regions)), raw)
    c = F.regexp_replace(c, PARENTHESES, " ")
    c = F.regexp_replace(c, OPEN_BRACKET, "")
    c = F.split(c, SEGMENT_END)[0]
    c = collapse_spaces(F.regexp_replace(c, BRACKETS, " "))
    return F.coalesce(blank_to_null(c), raw)


def paren_stripped(c: Column) -> Column:
    return collapse_spaces(F.regexp_replace(c, PARENTHESES, " "))


def normal_goods(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), GOODS_DROP, "")


def status_category(c: Column, inactive: str | None = None, registered: str = REGISTERED_WORD, pending: str | None = None) -> Column:
    """inactive before registered before pending before unknown."""
    c = F.coalesce(c, F.lit(""))
    return (
        F.when(F.rlike(c, F.lit(inactive or any_of(INACTIVE_WORDS))), "inactive")
        .when(F.rlike(c, F.lit(registered)), "registered")
        .when(F.rlike(c, F.lit(pending or any_of(PENDING_WORDS))), "pending")
        .otherwise("unknown")
    )


def is_producer_like(c: Column) -> Column:
    """A producers' body by its name, or a short name of an administrative body that isn't a company's."""
    t = F.trim(F.coalesce(c, F.lit("")))
    office = t.rlike("(시|군|구|도)$") & (F.length(t) <= 10) & ~t.rlike(any_of(CORPORATE_HINTS))
    return t.rlike(any_of(PRODUCER_HINTS)) | office


def specialty_stage(c: Column) -> Column:
    """Whether a name is of a raw or a processed item; null for an empty one."""
    name = F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", "")
    return (
        F.when(name == "", None)
        .when(name.isin(WHOLE_ITEM_NAMES + PROCESSED_WHOLE_NAMES), "processed")
        .when(F.trim(c).rlike(FRESH_PREFIX), "raw")
        .when(name.rlike(".(" + "|".join(PROCESSED_SUFFIXES) + ")$") | name.rlike(any_of(PROCESSED_MARKERS)), "processed")
        .otherwise("raw")
    )


def hit_stage(title: Column, classes: Column, core: Column, craft: bool = False) -> Column:
    """raw, processed, service, product or excluded, from a title and a list of class codes."""
    strings = lambda v: F.array(*map(F.lit, v))
    service, goods = F.arrays_overlap(classes, strings(SERVICE_CLASSES)), F.arrays_overlap(classes, strings(GOODS_CLASSES))
    if craft:
        return F.when(service, "service").when(F.size(classes) > 0, "product").otherwise("excluded")
    t = F.regexp_replace(F.coalesce(title, F.lit("")), NEGATED, "")
    processed = t.rlike(any_of(TITLE_WORDS)) | F.exists(strings(TITLE_SUFFIXES), lambda s: F.contains(t, F.concat(core, s)))
    return F.when(goods & processed, "processed").when(goods, "raw").when(service, "service").otherwise("excluded")


def topic_marker(word: Column) -> Column:
    """A word with its particle: by the final consonant of a Hangul syllable, the plain form otherwise."""
    code = F.ascii(F.right(word, F.lit(1)))
    final = code.between(0xAC00, 0xD7A3) & ((code - 0xAC00) % 28 != 0)
    return F.concat(word, F.when(final, "은").otherwise("는"))


def percent(rate: Column, missing: str = "확인불가") -> Column:
    return F.coalesce(F.concat(F.round(rate * 100).cast("int").cast("string"), F.lit("%")), F.lit(missing))


def decode_entities(c: Column) -> Column:
    for name, value in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(value))
    return c


def fill_slot(template: Column, slot: str, value: Column) -> Column:
    return F.replace(template, F.lit(slot), value)


def region_tokens(c: Column) -> Column:
    """Tokens of a region text: names of provinces and municipalities and their roots of two characters or more."""
    words = F.regexp_extract_all(c, F.lit(REGION_WORD), 0)
    roots = F.transform(words, lambda w: F.regexp_replace(w, REGION_ENDING, ""))
    return F.array_distinct(F.concat(words, F.filter(roots, lambda r: F.length(r) >= 2)))
