"""Exact distinct counts at several levels.

A level is counted over its distinct (cell, key) rows with a flag for each condition, so it takes a row a key and cell at
most, however many keys and cells there are. Records are deduplicated once, at the finest level; coarser levels start
from these rows. Bitmaps (``key_sets``) take the place of a whole bitmap for each cell and bucket of keys, even where only
a few keys are set: they suit cells that hold most of the keys of a bucket.

Defined results: a null key is in no set; a cell without keys (all null) isn't told; null cell values are cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.operators.common import dealt, numbered, written


def key_numbers(records: DataFrame, key: str, cells: list[str]) -> DataFrame:
    """key, number: dense numbers from 1, in order of each key's first cell."""
    first = records.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*cells)).alias("__cell"))
    return numbered(first, [F.col("__cell"), F.col(key)], "number").select(key, "number")


def key_sets(records: DataFrame, key: str, cells: list[str], where: dict[str, Column]) -> DataFrame:
    """cells, bucket, and a bitmap for each name in ``where``: the numbers of the keys that have a row of the cell for
    which the condition holds. Written, since several levels read it."""
    flags = records.select(*cells, key, *[F.coalesce(c, F.lit(False)).alias(f"__{n}") for n, c in where.items()])
    rows = flags.join(key_numbers(records, key, cells), key)
    place = F.bitmap_bit_position("number")
    sets = [F.bitmap_construct_agg(F.when(F.col(f"__{n}"), place)).alias(n) for n in where]
    return written(rows.groupBy(*cells, F.bitmap_bucket_number("number").alias("bucket")).agg(*sets))


def key_rows(records: DataFrame, key: str, cells: list[str], where: dict[str, Column]) -> DataFrame:
    """cells, key and for each name in ``where`` whether a row of the key in the cell fulfils it (1 or 0); once a key."""
    flags = records.filter(F.col(key).isNotNull()).select(*cells, key, *[F.coalesce(c, F.lit(False)).cast("int").alias(n) for n, c in where.items()])
    return dealt(flags, *cells, key).groupBy(*cells, key).agg(*[F.max(n).alias(n) for n in where])


def counted(rows: DataFrame, cells: list[str], names: list[str]) -> DataFrame:
    """cells and the number of keys for each name."""
    return rows.groupBy(*cells).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def distinct_counts(records: DataFrame, key: str, levels: dict[str, list[str]], where: dict[str, Column]) -> DataFrame:
    """level, the finest level's cells ('all' where a level leaves one out), and for each name in ``where`` the number of
    distinct keys with a row for which it holds. The first of ``levels`` is the finest."""
    finest, names = next(iter(levels.values())), list(where)
    base = written(key_rows(records, key, finest, where))
    parts = []
    for level, cells in levels.items():
        rows = base if cells == finest else key_rows(base, key, cells, {n: F.col(n) == 1 for n in names})
        found = counted(rows, cells, names)
        parts.append(found.select(F.lit(level).alias("level"), *[(F.col(c).cast("string") if c in cells else F.lit("all")).alias(c) for c in finest], *names))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
