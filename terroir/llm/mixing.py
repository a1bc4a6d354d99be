"""Mixing sources to target weights.

Words are summed for each source, each source gets a target, and every document is emitted floor(rate) times
plus one Bernoulli copy whose probability is the fraction; the draw is a hash of a seed and the document id,
turned by the seed of the source, so that reruns and retried tasks agree. A source's seed is the one of ``TURNS``
whose copies come nearest its target (the smallest of several), found by one aggregation: so small sources come near
their targets too.

Targets: sources in code point order (null last) have the weights ``weights``, repeating. A target is at most
``most`` times its source's words; the excess goes to the others by weight until none is above. That fixed
point is a water level: every target is min(weight x level, most x words), and the level is found by a few
aggregations over the table of sources, which never leaves Spark.

Defined results: null or empty text has size 0 and is emitted once per copy like any other (it adds no words);
a source of size 0 has target 0 and no copies; an empty table gives an empty table; equal ids draw alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from terroir.llm.common import checkpoint, documents, free_names, row_numbers, small, text_of

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
TURNS = 128


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """From rows (source, size): source, source_size, target."""
    totals = row_numbers(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), F.col("source").asc_nulls_last(), name="place")
    cycle = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = checkpoint(totals.select("source", "source_size", cycle.alias("weight"), (F.col("source_size") * most).alias("cap")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # each round fills at least one more source, so rounds are few
        above = F.col("weight") * F.lit(level) > F.col("cap")
        capped, n, weight = table.agg(F.sum(F.when(above, F.col("cap")).otherwise(0)), F.count_if(above), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if n == full or not weight:
            break
        level, full = (total - capped) / weight, n
    return table.select("source", "source_size", F.least(F.col("weight") * F.lit(level), F.col("cap").cast("double")).alias("target"))


def draw(id_col: str, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def _turned(u: Column, turn: Column, turns: int) -> Column:
    """The draw turned by a source's seed."""
    moved = u + turn / F.lit(float(turns))
    return F.when(moved >= 1, moved - 1).otherwise(moved)


def _copies(u: Column, rate: Column) -> Column:
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("long")).cast("long")


def _taken(rows: DataFrame, table: DataFrame, turns: int) -> DataFrame:
    """source, turn, target, taken: the words that each seed would take of a source.

    From turn to turn a document's copies change at two turns only: one where its turned draw passes 1 and begins
    again at 0, which is below the rate's fraction, and one where it reaches the fraction. These changes (at most two
    rows a document) are added up by turn and summed over the turns of each source.
    """
    part, u = F.col("rate") - F.floor("rate"), F.col("u")
    drawn = lambda turn: _turned(u, turn, turns) < part
    falls_from = F.when(u < part, part).otherwise(part + 1)
    near = F.greatest(F.least(F.ceil((falls_from - u) * turns), F.lit(turns)), F.lit(1)).cast("int")
    # the division may be off by a rounding: the first turn at or after the one before, which isn't drawn while that is
    falls = F.array_min(F.filter(F.array(near - 1, near, near + 1), lambda t: (t >= 1) & ~drawn(t) & drawn(t - 1)))
    rises = F.ceil((1 - u) * turns).cast("int")
    rises = F.when(drawn(rises) & ~drawn(rises - 1), rises)
    change = [F.struct(rises.alias("turn"), F.col("size").alias("delta")), F.struct(falls.alias("turn"), (-F.col("size")).alias("delta"))]
    changes = rows.select("source", F.explode(F.array(*change)).alias("x")).select("source", "x.*").filter(F.col("turn") < turns)
    first = rows.select("source", F.lit(0).alias("turn"), (F.col("size") * _copies(u, F.col("rate"))).alias("delta"))
    grid = table.select("source", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn"), F.lit(0).cast("long").alias("delta"))
    summed = changes.unionByName(first).unionByName(grid).groupBy("source", "turn").agg(F.sum("delta").alias("delta"))
    all_before = W.partitionBy("source").orderBy("turn").rowsBetween(W.unboundedPreceding, W.currentRow)
    return _joined(summed.withColumn("taken", F.sum("delta").over(all_before)), table.select("source", "target"), "source").drop("delta")


def seeded(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, turns: int = TURNS) -> DataFrame:
    """From rows (source, size, u): source, source_size, target, rate, turn (the source's seed)."""
    table = targets(sizes.select("source", "size"), weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    table = checkpoint(table.withColumn("rate", rate))
    taken = _taken(_joined(sizes, table, "source"), table, turns)
    best = taken.groupBy("source").agg(F.min(F.struct(F.abs(F.col("taken") - F.col("target")).alias("off"), "turn"))["turn"].alias("turn"))
    best = best.select(F.col("source").alias("__source"), "turn")
    return table.join(best, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def _joined(rows: DataFrame, table: DataFrame, source_col: str) -> DataFrame:
    """Rows with the columns of their source."""
    own = free_names(rows, "__source")[0]
    table = table.withColumnRenamed("source", own)
    few = small(table)  # otherwise a shuffled join, which adaptive execution splits where a source is hot
    return rows.join(F.broadcast(table) if few else table, F.col(source_col).eqNullSafe(F.col(own))).drop(own)


def plan_copies(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, rate, copies."""
    sizes = checkpoint(df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"), draw(id_col, seed).alias("u")))
    table = checkpoint(seeded(sizes, weights, most))
    copies = _copies(_turned(F.col("u"), F.col("turn"), TURNS), F.col("rate"))
    return _joined(sizes, table, "source").select("doc_id", "size", "source", "source_size", "target", "rate", copies.alias("copies"))


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it."""
    sizes = checkpoint(df.select(F.col(source_col).alias("source"), n_words(text_col).alias("size"), draw(id_col, seed).alias("u")))
    rate, turn, copy = free_names(df, "__rate", "__turn", "__copy")
    table = checkpoint(seeded(sizes, weights, most).select("source", F.col("rate").alias(rate), F.col("turn").alias(turn)))
    copies = _copies(_turned(draw(id_col, seed), F.col(turn), TURNS), F.col(rate)).cast("int")
    return _joined(df, table, source_col).withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies))).drop(rate, turn, copy)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_copies(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 3 * source_size AS cap FROM s),
o AS (SELECT *, sum(source_size) OVER () AS total,
             sum(cap) OVER r - cap AS filled, sum(weight) OVER () - (sum(weight) OVER r - weight) AS open
      FROM w WINDOW r AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT arg_min((total - filled)::DOUBLE / open, cap / weight) FILTER (WHERE weight * ((total - filled)::DOUBLE / open) <= cap) AS level FROM o),
t AS (SELECT source, source_size, least(weight * level, cap::DOUBLE) AS target FROM w, l),
m AS (SELECT doc_id, size, t.source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (SELECT m.*, turn, CASE WHEN u + turn / 128.0::DOUBLE >= 1 THEN u + turn / 128.0::DOUBLE - 1 ELSE u + turn / 128.0::DOUBLE END AS v FROM m, range(128) AS x(turn)),
c AS (SELECT *, (floor(rate) + (v < rate - floor(rate))::INT)::BIGINT AS copies FROM r),
b AS (SELECT source, turn, row_number() OVER (PARTITION BY source ORDER BY abs(sum(size * copies) - any_value(target)), turn) AS place FROM c GROUP BY source, turn)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source AND c.turn = b.turn WHERE place = 1
"""
