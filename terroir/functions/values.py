"""Numbers, dates, hashes and structs: Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, places: int) -> Column:
    """A double rounded half away from zero, as SQL does it: scaled, rounded and scaled back in doubles. ``F.round`` goes
    by the value's decimal digits instead, and differs where scaling lands on a half (0.20474999999999999, 4 places)."""
    scale = F.lit(float(10**places))
    return F.round(value.cast("double") * scale) / scale


def safe_rate(numerator: Column, denominator: Column, places: int = 4) -> Column:
    """A rate rounded to ``places``; null where there is nothing to divide by."""
    return F.when(denominator > 0, rounded(numerator / denominator, places))


def valid_year(c: Column) -> Column:
    y = F.nullif(F.regexp_extract(F.trim(c), r"^(\d{4})", 1), F.lit("")).cast("int")
    return F.when(y.between(1800, 2200), y)


def valid_month(c: Column) -> Column:
    """'YYYY-MM' from a date text, or null."""
    d = F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", "")
    y, m = F.nullif(F.substring(d, 1, 4), F.lit("")).try_cast("int"), F.nullif(F.substring(d, 5, 2), F.lit("")).try_cast("int")
    return F.when((F.length(d) >= 6) & y.between(1800, 2200) & m.between(1, 12), F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2)))


def strict_date(c: Column) -> Column:
    """A date from exactly eight digits; null for days that don't exist."""
    return F.when(c.rlike(r"^\d{8}$"), F.try_to_date(c, "yyyyMMdd"))


def local_date(ts: Column, zone: str = "Asia/Seoul") -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def next_local_midnight(ts: Column, zone: str = "Asia/Seoul") -> Column:
    return F.to_utc_timestamp(F.date_add(local_date(ts, zone), 1).cast("timestamp"), zone)


def content_hash(*columns: str) -> Column:
    """SHA-256 of the columns as JSON with sorted keys; columns of observation are simply not given."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def hash_id(c: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(c.cast("string"), 256), 1, length)


def record_key(explicit: Column, parts: list[Column]) -> Column:
    """An explicit id, else the parts if all are there, else a hash of what there is."""
    filled = [F.nullif(F.trim(p.cast("string")), F.lit("")) for p in parts]
    whole = F.when(F.forall(F.array(*filled), lambda x: x.isNotNull()), F.concat_ws("|", *filled))
    loose = F.concat(F.lit("h:"), F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in filled]), 256), 1, 20))
    return F.coalesce(F.nullif(F.trim(explicit.cast("string")), F.lit("")), whole, loose)


def metric(value: Column, availability: Column, status: Column | None = None, issue: Column | None = None) -> Column:
    return F.struct(
        F.when(availability != "blocked", value).alias("value"),
        availability.alias("availability"),
        (status if status is not None else F.lit("computed")).alias("status"),
        (issue if issue is not None else F.lit(None).cast("string")).alias("blocking_issue"),
    )


def normal_set(c: Column) -> Column:
    """An array as a set: sorted, distinct, without nulls. Equal sets are equal arrays."""
    return F.array_sort(F.array_distinct(F.array_compact(c)))
