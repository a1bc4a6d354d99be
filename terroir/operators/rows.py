"""Row-wise operators: projections, predicates and classifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.functions import text as X


def repair_region_columns(province: Column, region: Column, provinces: Column) -> list[Column]:
    """'A > B' in an otherwise empty row is split; a province's name in the wrong column is moved."""
    both = F.split(region, r"\s*>\s*")
    shifted = (F.coalesce(province, F.lit("")) == "") & F.contains(region, F.lit(">"))
    moved = (F.coalesce(province, F.lit("")) == "") & F.array_contains(provinces, region)
    return [
        F.when(shifted, both[0]).when(moved, region).otherwise(province).alias("province"),
        F.when(shifted, both[1]).when(moved, F.lit("")).otherwise(region).alias("region"),
    ]


def is_service_class(c: Column) -> Column:
    return F.coalesce(c.cast("string").try_cast("int") >= 35, F.lit(False))


def filter_by_class(df: DataFrame, column: str, wanted: list[str]) -> DataFrame:
    """Rows whose pipe list shares a class with ``wanted``, leading zeros aside; an empty list filters nothing."""
    if not wanted:
        return df
    codes = F.array(*[F.lit(str(int(w)) if w.strip().isdigit() else w.strip()) for w in wanted])
    return df.filter(F.arrays_overlap(X.class_list(F.col(column)), codes))


def with_class_fallback(classes: Column, fallback: list[str]) -> Column:
    return F.when(F.size(F.coalesce(classes, F.array().cast("array<string>"))) > 0, classes).otherwise(F.array(*map(F.lit, fallback)))


def plan_query(error: Column, excluded: Column, review: Column, region: Column, nationwide: Column, include_review: bool = False) -> Column:
    """The reason why a row isn't searched, or null."""
    return (
        F.when(error, "error").when(excluded, "excluded").when((F.coalesce(region, F.lit("")) == "") & ~nationwide, "no_region").when(review & F.lit(not include_review), "review_required")
    )


def query_key(item: Column, classes: Column) -> Column:
    """Item in lower case with single spaces, and sorted classes; 'fallback:' without classes."""
    codes = F.array_join(F.array_sort(F.array_distinct(F.transform(classes, X.class_code))), ",")
    return F.concat(F.lower(X.collapse_spaces(item)), F.chr(F.lit(31)), F.when(codes == "", F.lit("fallback:")).otherwise(codes))


def excluded_item(name: Column, suffix: str = X.EXCLUDED_SUFFIX, names: list[str] | None = None) -> Column:
    return name.rlike(suffix) | name.isin(X.EXCLUDED_NAMES if names is None else names)


def sanitize_applicants(applicants: Column, region_of, producer_of) -> Column:
    """Addresses to regions and names to a flag; entries without either are dropped. Names never come out."""
    made = F.transform(applicants, lambda a: F.struct(region_of(a["address"]).alias("region"), producer_of(a["name"]).alias("producer")))
    return F.filter(made, lambda a: a["region"].isNotNull() | a["producer"])


def entry_status(status: Column, error: Column) -> Column:
    return F.coalesce(X.blank_to_null(status), F.when(F.coalesce(error, F.lit("")) != "", "error").otherwise("ok"))


def entry_dimensions(notice: Column, item: Column, query: Column, basis: Column) -> list[Column]:
    """The first filled name, and what it was matched on."""
    filled = [X.blank_to_null(c) for c in (notice, item, query)]
    chosen = F.when(filled[0].isNotNull(), "notice").when(filled[1].isNotNull(), "item").when(filled[2].isNotNull(), "query").otherwise("unresolved")
    return [F.coalesce(*filled).alias("name"), F.coalesce(X.blank_to_null(basis), chosen).alias("matching_basis")]


def data_state(available: Column, partial: Column, blocked: Column, errors: Column, total: Column) -> Column:
    return (
        F.when(total == 0, "no_data").when(errors == total, "failed").when(available == total, "complete").when(blocked == total, "blocked").when(available + partial == total, "partial").otherwise("mixed")
    )


def goods_stage(goods: Column, processed: str, service: str) -> Column:
    """A label of all stages that a list of goods covers."""
    has = lambda p: F.exists(goods, lambda g: g.rlike(p))
    raw = F.exists(goods, lambda g: ~g.rlike(processed) & ~g.rlike(service))
    return F.array_join(F.array_compact(F.array(F.when(raw, "raw"), F.when(has(processed), "processed"), F.when(has(service), "service"))), "+")


def rights_status(applications: Column, registered: Column, classes: Column) -> Column:
    service = F.forall(classes, lambda c: is_service_class(c)) & (F.size(classes) > 0)
    return F.when(applications == 0, "none").when(registered == 0, "pending").when(F.size(classes) == 0, "unknown").when(service, "service_only").otherwise("goods")


def is_stale_complete(status: Column, fetched: Column, today: Column, days: int) -> Column:
    return (status == "complete") & (F.datediff(today, fetched) >= days)


def applicant_category(regions: Column, foreign: Column, wanted: Column) -> Column:
    """no_address, foreign, matched, ambiguous or unmatched, over the applicants of one record."""
    known = F.filter(regions, lambda r: r.isNotNull())
    inside = F.exists(known, lambda r: r == wanted)
    return (
        F.when((F.size(known) == 0) & foreign, "foreign").when(F.size(known) == 0, "no_address").when(inside & (F.size(F.array_distinct(known)) == 1), "matched").when(inside, "ambiguous").otherwise("unmatched")
    )


def staleness_category(expiry: Column, history: Column, as_of: Column) -> Column:
    """current, renewed (history after the expiry), expired, or unknown."""
    return F.when(expiry.isNull(), "unknown").when(expiry >= as_of, "current").when(F.exists(history, lambda h: h > expiry), "renewed").otherwise("expired")


def expand_dates(df: DataFrame, start: str, end: str, most: int, name: str = "day") -> DataFrame:
    """One row a day, at most ``most`` of each row."""
    last = F.least(F.col(end), F.date_add(F.col(start), most - 1))
    return df.filter(F.col(start) <= F.col(end)).withColumn(name, F.explode(F.sequence(F.col(start), last)))


def relabel_scope(scope: Column, source: Column, nationwide_sources: list[str], label: str) -> Column:
    return F.when(source.isin(nationwide_sources) | (scope == "review"), F.lit(label)).otherwise(scope)


def mark_type(number: Column, types: dict[str, str]) -> Column:
    """The type of a right from the first two digits of its number."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in types.items() for x in kv])[F.substring(number.cast("string"), 1, 2)], F.lit("other"))


def official_label(basis: Column, notice: Column, confirmed: list[str], prefix: str) -> Column:
    return F.when(basis.isin(confirmed), F.regexp_replace(notice, prefix, ""))
