"""Given tables with planted nulls, copies, outliers and dirty text.

The given tables are clean, so the queries that show cleaning plant the dirt by
arithmetic on the key. Each frame has its SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

ORDERS_WITH_NULLS = """(
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM orders)"""


def orders_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(key % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )


ORDERS_WITH_COPIES = """(
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
    WHERE o_orderkey % 10 = 0)"""


def orders_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    times = F.when(F.col("o_orderkey") % 10 == 0, 2).otherwise(1)
    return orders.withColumn("__copy", F.explode(F.sequence(F.lit(1), times))).drop("__copy")


LINES_WITH_OUTLIERS = """(
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
           l_extendedprice * CASE WHEN l_orderkey % 500 = 0 THEN 100 ELSE 1 END AS price
    FROM lineitem)"""


def lines_with_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    factor = F.when(F.col("l_orderkey") % 500 == 0, 100).otherwise(1)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_quantity",
        (F.col("l_extendedprice") * factor).alias("price"),
    )


PARTS_WITH_DIRT = """(
    SELECT p_partkey, '  ' || upper(p_name) || '-1! ' AS name, ' ' || p_type || '#' AS kind
    FROM part)"""


def parts_with_dirt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), F.upper("p_name"), F.lit("-1! ")).alias("name"),
        F.concat(F.lit(" "), "p_type", F.lit("#")).alias("kind"),
    )
