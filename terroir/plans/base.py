"""The roles that the driver's tables play, in Spark and in SQL.

region/nation: provinces and regions; part: items, kinds and classes; orders with lineitem: activity records;
customer: applicants; supplier: the region that a record is filed under.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.operators.common import checked_broadcast

STATUS = {"F": "registered", "O": "pending", "P": "inactive"}


class Tables:
    """The tables of a folder, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.folder = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def masters(t: Tables) -> DataFrame:
    """Regions: code, region, province."""
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("region"), F.col("r_name").alias("province"))


def records(t: Tables) -> DataFrame:
    """One row per activity record line. The region master is broadcast if its size allows; the joins to orders,
    customer, part and supplier are left to the optimiser, which knows the sizes of the plain tables."""
    place = checked_broadcast(masters(t))
    seller = place.select(F.col("code").alias("s_nationkey"), "region", "province")
    buyer = place.select(F.col("code").alias("c_nationkey"), F.col("region").alias("app_region"), F.col("province").alias("app_province"))
    status = F.create_map(*[F.lit(x) for kv in STATUS.items() for x in kv])[F.col("o_orderstatus")]
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", F.col("c_mktsegment").alias("segment"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, "o_custkey")
        .join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_size"), "l_partkey")
        .join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
        .join(buyer, "c_nationkey")
        .join(seller, "s_nationkey")
        .select(
            "region", "province", F.col("p_name").alias("item"), F.col("p_type").alias("kind"), F.col("p_size").alias("class"),
            F.col("l_orderkey").alias("app"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
            F.col("o_custkey").alias("applicant"), "app_region", "app_province", "segment", status.alias("status"),
            F.col("o_orderdate").cast("date").alias("filed"), F.col("l_shipdate").cast("date").alias("granted"),
            F.when(F.col("region") == F.col("app_region"), "inside").otherwise("outside").alias("relation"),
        )
    )


#: The same as SQL: queries begin with ``WITH`` + RECORDS.
RECORDS = """rec AS (
 SELECT sn.n_name AS region, sr.r_name AS province, p_name AS item, p_type AS kind, p_size AS class, l_orderkey AS app, l_linenumber AS line,
        l_partkey AS part, l_suppkey AS supp, o_custkey AS applicant, cn.n_name AS app_region, cr.r_name AS app_province, c_mktsegment AS segment,
        CASE o_orderstatus WHEN 'F' THEN 'registered' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'inactive' END AS status,
        o_orderdate::DATE AS filed, l_shipdate::DATE AS granted, CASE WHEN sn.n_name = cn.n_name THEN 'inside' ELSE 'outside' END AS relation
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
 JOIN region cr ON cn.n_regionkey = cr.r_regionkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey)"""

#: First record of each application in each region and item.
FIRSTS = RECORDS + """,
fst AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY region, item, app ORDER BY line, part, supp, granted) AS rn FROM rec) WHERE rn = 1)"""
