"""Queries for joins, lookups and unions."""

from pyspark.sql import functions as F

from ..operators.joins import cross_join, join_tables, lookup, union_tables
from .registry import query, table

# Customers and orders share the names c_custkey and amount. Order keys are
# shifted, so that both sides have keys without a match.
_PEOPLE = "(SELECT c_custkey, c_name, c_acctbal AS amount FROM customer)"
_SALES = "(SELECT o_custkey + 100 AS c_custkey, o_orderkey, o_totalprice AS amount FROM orders)"


def _people(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_acctbal").alias("amount")
    )


def _sales(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + 100).alias("c_custkey"),
        "o_orderkey",
        F.col("o_totalprice").alias("amount"),
    )


def _joined_sql(kind):
    return f"""SELECT coalesce(p.c_custkey, s.c_custkey) AS c_custkey, c_name,
        p.amount AS amount_left, o_orderkey, s.amount AS amount_right
    FROM {_PEOPLE} p {kind} JOIN {_SALES} s ON p.c_custkey = s.c_custkey"""


_EXISTS = f"SELECT * FROM {_PEOPLE} p WHERE {{}} EXISTS (SELECT 1 FROM {_SALES} s WHERE s.c_custkey = p.c_custkey)"

HOT = 12
"""A group limit so low that some customers of the small tables exceed it."""


def _register(name, join_type, sql, swap=False, **options):
    @query(name, sql)
    def run(spark, sf_dir):
        sides = [_people(spark, sf_dir), _sales(spark, sf_dir)]
        if swap:
            sides.reverse()
        return join_tables(*sides, ["c_custkey"], join_type, **options)


_register("join_inner", "inner", _joined_sql("INNER"))
_register("join_full", "outer", _joined_sql("FULL"))
_register("join_left", "left", _joined_sql("LEFT"))
_register("join_right", "right", _joined_sql("RIGHT"))
_register("join_semi", "left_semi", _EXISTS.format(""))
_register("join_anti", "left_anti", _EXISTS.format("NOT"))
_register("join_full_hot_keys", "outer", _joined_sql("FULL"), group_rows=HOT)
_register("join_left_hot_keys", "left", _joined_sql("LEFT"), group_rows=HOT)
_register(
    "join_right_hot_keys",
    "right",
    f"""SELECT p.c_custkey, o_orderkey, s.amount AS amount_left, c_name,
               p.amount AS amount_right
        FROM {_SALES} s RIGHT JOIN {_PEOPLE} p ON p.c_custkey = s.c_custkey""",
    swap=True,
    group_rows=HOT,
)
_register("join_semi_hot_keys", "left_semi", _EXISTS.format(""), group_rows=HOT)
_register("join_anti_hot_keys", "left_anti", _EXISTS.format("NOT"), group_rows=HOT)


@query(
    "join_composite_key",
    """
    WITH a AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS l_quantity_sum
               FROM lineitem GROUP BY ALL),
         b AS (SELECT l_partkey, l_suppkey, max(l_discount) AS l_discount_max
               FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
    SELECT l_partkey, l_suppkey, l_quantity_sum, l_discount_max
    FROM a JOIN b USING (l_partkey, l_suppkey)
    """,
)
def join_composite_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_partkey", "l_suppkey"]
    moved = lines.groupBy(*keys).agg(F.sum("l_quantity").alias("l_quantity_sum"))
    returned = (
        lines.filter("l_returnflag = 'R'")
        .groupBy(*keys)
        .agg(F.max("l_discount").alias("l_discount_max"))
    )
    return join_tables(moved, returned, keys)


_CONDITION_TYPES = {"left": "LEFT JOIN", "right": "RIGHT JOIN", "full": "FULL JOIN"}


def _register_condition(name, how, group_rows=None):
    if how in _CONDITION_TYPES:
        sql = f"""SELECT coalesce(p.c_custkey, s.c_custkey) AS c_custkey, c_name, p.amount AS amount_left,
                         o_orderkey, s.amount AS amount_right
                  FROM {_PEOPLE} p {_CONDITION_TYPES[how]} {_SALES} s
                  ON p.c_custkey = s.c_custkey AND s.amount > 50 * p.amount"""
    else:
        sql = f"""SELECT * FROM {_PEOPLE} p WHERE {"NOT " if how == "left_anti" else ""}EXISTS (
                  SELECT 1 FROM {_SALES} s WHERE p.c_custkey = s.c_custkey AND s.amount > 50 * p.amount)"""

    @query(name, sql)
    def run(spark, sf_dir):
        return join_tables(
            _people(spark, sf_dir),
            _sales(spark, sf_dir),
            ["c_custkey"],
            how,
            condition="amount_right > 50 * amount_left",
            group_rows=group_rows,
        )


_register_condition("join_condition", "left")
for _how in ("left", "right", "full", "left_semi", "left_anti"):
    _register_condition(f"join_condition_{_how}_hot_keys", _how, 3)


@query(
    "lookup_enrich",
    """SELECT c_custkey, c_name, c_nationkey, n_name
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def lookup_enrich(spark, sf_dir):
    return lookup(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"),
        table(spark, sf_dir, "nation"),
        "c_nationkey",
        "n_nationkey",
        ["n_name"],
    )


@query(
    "lookup_best_match",
    """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice
    FROM customer LEFT JOIN (
        SELECT * FROM (SELECT o_custkey + 100 AS k, o_orderkey, o_totalprice,
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
        FROM orders) WHERE rn = 1) ON c_custkey = k
    """,
)
def lookup_best_match(spark, sf_dir):
    sales = _sales(spark, sf_dir).withColumnsRenamed(
        {"c_custkey": "customer", "amount": "o_totalprice"}
    )
    return lookup(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
        sales,
        "c_custkey",
        "customer",
        unique_by=[("o_totalprice", "desc"), "o_orderkey"],
    )


@query("cross_join", "SELECT c_custkey, c_mktsegment, r_regionkey, r_name FROM customer, region")
def cross_join_query(spark, sf_dir):
    return cross_join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
        table(spark, sf_dir, "region"),
    )


@query(
    "theta_join",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, o_custkey, o_orderkey
       FROM lineitem, orders
       WHERE l_orderkey = o_orderkey AND l_extendedprice * 4 > o_totalprice""",
)
def theta_join(spark, sf_dir):
    pairs = cross_join(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        "l_orderkey = o_orderkey AND l_extendedprice * 4 > o_totalprice",
    )
    return pairs.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "o_custkey", "o_orderkey"
    )


_PARTS = """
    SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_totalprice > 150000
    {0}
    SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    {0}
    SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'
"""


def _parts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return [
        orders.filter(condition).select("o_custkey", "o_orderstatus", "o_orderpriority")
        for condition in (
            "o_totalprice > 150000", "o_orderstatus = 'F'", "o_orderpriority = '1-URGENT'",
        )
    ]


@query("union_distinct", _PARTS.format("UNION"))
def union_distinct(spark, sf_dir):
    return union_tables(_parts(spark, sf_dir))


@query("union_all", _PARTS.format("UNION ALL"))
def union_all(spark, sf_dir):
    return union_tables(_parts(spark, sf_dir), "union_all")


@query(
    "union_by_name",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL BY NAME SELECT s_acctbal AS balance, s_name AS name FROM supplier""",
)
def union_by_name(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    firms = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return union_tables([people, firms], "union_all", by_name=True)
