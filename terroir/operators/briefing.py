"""Sentences about a place's scores, assembled from phrases that are a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terroir.functions.text import percent, topic_marker

#: {place} comes with its particle; {n}, {rate}, {local} and {producers} are numbers and percentages.
PHRASES = {
    "short": "{place} short of filings ({n}, {rate})",
    "active": "{place} active ({n}, {rate})",
    "covered": "{place} well covered ({n}, {rate})",
    "low_conversion": "low conversion of {n}",
    "producers_outside": "led by producers outside ({producers})",
    "outside": "led from outside ({local} local)",
    "local": "led locally ({local})",
    "unverified": "shares not verified",
}
#: Thresholds of the gap, of the outside share, of producers among those outside, and of the local share.
GAP, OUTSIDE, PRODUCERS, LOCAL = 0.7, 0.6, 0.5, 0.8


def sentences(phrases: dict[str, str]) -> Column:
    """The sentences that hold for a row, in order, as an array.

    Columns: place, n, rate, gap, low_conversion, verified, local_share, producer_share. The gap comes first (a row of
    low conversion is called active, not well covered), then low conversion, then one of: an outside lead (by
    producers or not), a local lead, or that shares aren't verified.
    """
    slots = {
        "{place}": topic_marker(F.col("place")), "{n}": F.col("n").cast("string"), "{rate}": percent(F.col("rate")), "{local}": percent(F.col("local_share")), "{producers}": percent(F.col("producer_share")),
    }

    def filled(name: str) -> Column:
        text = F.lit(phrases[name])
        for slot, value in slots.items():
            if slot in phrases[name]:
                text = F.replace(text, F.lit(slot), value)
        return text

    gap = F.when(F.col("gap") >= GAP, filled("short")).when(F.col("low_conversion"), filled("active")).otherwise(filled("covered"))
    shared = F.col("verified") & F.col("local_share").isNotNull()
    lead = (
        F.when(shared & (1 - F.col("local_share") >= OUTSIDE), F.when(F.col("producer_share") >= PRODUCERS, filled("producers_outside")).otherwise(filled("outside")))
        .when(shared & (F.col("local_share") >= LOCAL), filled("local")).when(~F.col("verified"), filled("unverified"))
    )
    return F.array_compact(F.array(gap, F.when(F.col("low_conversion"), filled("low_conversion")), lead))
