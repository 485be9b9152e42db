"""Queries for aggregates, windows, sorting and quality."""

from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.aggregates import (
    distinct_counts,
    group_by,
    group_by_time,
    pivot,
    row_count,
    statistics,
)
from ..operators.quantiles import exact_quantiles
from ..operators.sorting import head, sort_rows, top_k
from ..operators.windows import rolling_aggregation, window_functions
from . import planted as p
from .registry import query, table

SMALL_GROUP = 1_000
"""A group limit so low that groups of the small tables are split."""


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- aggregates -----------------------------------------------------------------

_ALL = ["sum", "avg", "count", "min", "max", "stddev", "var"]
_ALL_SQL = """round(sum(l_quantity), 2) AS l_quantity_sum, round(avg(l_quantity), 6) AS l_quantity_avg,
    count(l_quantity) AS l_quantity_count, min(l_quantity) AS l_quantity_min,
    max(l_quantity) AS l_quantity_max, round(stddev_samp(l_quantity), 6) AS l_quantity_stddev,
    round(var_samp(l_quantity), 6) AS l_quantity_variance,
    round(avg(l_extendedprice), 4) AS l_extendedprice_avg"""
_ALL_ROUNDED = {
    "l_quantity_sum": 2, "l_quantity_avg": 6, "l_quantity_stddev": 6,
    "l_quantity_variance": 6, "l_extendedprice_avg": 4,
}


def _all_functions(spark, sf_dir, keys):
    grouped = group_by(
        table(spark, sf_dir, "lineitem"),
        keys,
        {"l_quantity": _ALL, "l_extendedprice": "mean"},
    )
    return grouped.withColumns({c: F.round(c, d) for c, d in _ALL_ROUNDED.items()})


@query(
    "group_by_all_functions",
    f"SELECT l_returnflag, l_linestatus, {_ALL_SQL} FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def group_by_all_functions(spark, sf_dir):
    return _all_functions(spark, sf_dir, ["l_returnflag", "l_linestatus"])


@query("global_aggregate", f"SELECT {_ALL_SQL} FROM lineitem")
def global_aggregate(spark, sf_dir):
    return _all_functions(spark, sf_dir, [])


def _register_pivot(function, column_sql, values, digits=None):
    columns = ", ".join(
        column_sql.format(f"o_orderstatus = '{v}'") + f' AS "{v}"' for v in ("F", "O", "P")
    )

    @query(
        f"pivot_{function}",
        f"SELECT o_orderpriority, {columns} FROM orders GROUP BY o_orderpriority",
    )
    def run(spark, sf_dir):
        wide = pivot(
            table(spark, sf_dir, "orders"),
            ["o_orderpriority"],
            "o_orderstatus",
            "o_totalprice",
            function,
            values,
        )
        return wide if digits is None else _rounded(wide, digits, "F", "O", "P")


_register_pivot("sum", "round(sum(o_totalprice) FILTER ({}), 2)", None, 2)
_register_pivot("avg", "round(avg(o_totalprice) FILTER ({}), 4)", None, 4)
_register_pivot("count", "nullif(count(*) FILTER ({}), 0)", ["F", "O", "P"])
_register_pivot("max", "max(o_totalprice) FILTER ({})", ["F", "O", "P"])
_register_pivot("min", "min(o_totalprice) FILTER ({})", ["F", "O", "P"])

_STATISTICS_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


def _statistics_sql(column):
    return f"""
    SELECT '{column}' AS "column", count(x) AS count, round(avg(x), 5) AS mean,
           round(stddev_samp(x), 5) AS stddev, min(x) AS min, max(x) AS max,
           quantile_disc(x, 0.25) AS q1, quantile_disc(x, 0.5) AS median,
           quantile_disc(x, 0.75) AS q3, round(var_samp(x), 2) AS variance,
           round(avg(d * d * d) / (sqrt(avg(d * d)) * avg(d * d)), 5) AS skewness,
           round(avg(d * d * d * d) / (avg(d * d) * avg(d * d)) - 3, 5) AS kurtosis
    FROM (SELECT {column} AS x, {column} - (SELECT avg({column}) FROM lineitem) AS d FROM lineitem)
    """


@query(
    "statistics_summary",
    " UNION ALL ".join(_statistics_sql(c) for c in _STATISTICS_COLUMNS),
)
def statistics_summary(spark, sf_dir):
    summary = statistics(table(spark, sf_dir, "lineitem"), _STATISTICS_COLUMNS, exact=True)
    return _rounded(summary, 5, "mean", "stddev", "skewness", "kurtosis").withColumn(
        "variance", F.round("variance", 2)
    )


@query("statistics_approximate")
def statistics_approximate(spark, sf_dir):
    return statistics(table(spark, sf_dir, "lineitem"), _STATISTICS_COLUMNS)


@query(
    "exact_quantiles_split",
    """
    SELECT 'l_extendedprice' AS "column", p AS probability, v AS value
    FROM (SELECT unnest([0.1, 0.5, 0.99])::DOUBLE AS p,
                 unnest(quantile_disc(l_extendedprice, [0.1, 0.5, 0.99])) AS v FROM lineitem)
    """,
)
def exact_quantiles_split(spark, sf_dir):
    return exact_quantiles(
        table(spark, sf_dir, "lineitem"),
        ["l_extendedprice"],
        [0.1, 0.5, 0.99],
        group_rows=8 * SMALL_GROUP,
    )


@query(
    "monthly_order_totals",
    """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
              round(sum(o_totalprice), 2) AS o_totalprice_sum, count(o_orderkey) AS o_orderkey_count
       FROM orders GROUP BY 1""",
)
def monthly_order_totals(spark, sf_dir):
    monthly = group_by_time(
        table(spark, sf_dir, "orders"),
        "o_orderdate",
        "month",
        {"o_totalprice": "sum", "o_orderkey": "count"},
    )
    return _rounded(monthly, 2, "o_totalprice_sum").select(
        F.date_format("o_orderdate_month", "yyyy-MM-dd").alias("month"),
        "o_totalprice_sum",
        "o_orderkey_count",
    )


@query(
    "daily_events_by_type",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type,
              round(sum(value), 2) AS value_sum, round(avg(value), 6) AS value_avg
       FROM events GROUP BY 1, 2""",
)
def daily_events_by_type(spark, sf_dir):
    daily = group_by_time(
        table(spark, sf_dir, "events"), "ts", "day", {"value": ["sum", "avg"]}, ["event_type"]
    )
    return daily.select(
        F.date_format("ts_day", "yyyy-MM-dd").alias("day"),
        "event_type",
        F.round("value_sum", 2).alias("value_sum"),
        F.round("value_avg", 6).alias("value_avg"),
    )


_DISTINCT = ["l_partkey", "l_suppkey", "l_returnflag"]


@query(
    "count_distinct",
    "SELECT "
    + ", ".join(f"count(DISTINCT {c}) AS {c}_distinct" for c in _DISTINCT)
    + " FROM lineitem",
)
def count_distinct(spark, sf_dir):
    return distinct_counts(table(spark, sf_dir, "lineitem"), _DISTINCT)


@query("count_distinct_approximate")
def count_distinct_approximate(spark, sf_dir):
    return distinct_counts(table(spark, sf_dir, "lineitem"), _DISTINCT, approximate=True)


@query("row_count", 'SELECT count(*) AS "rows" FROM lineitem')
def row_count_query(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


# --- windows --------------------------------------------------------------------

_ORDER = "(PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey)"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
        "o_totalprice",
    )


def _register_window(name, sql, keys, order, functions, kept, rounded=()):
    """The query with the usual group limit, and again with split groups."""
    for suffix, options in (("", {}), ("_split", {"group_rows": SMALL_GROUP})):

        @query(name + suffix, sql)
        def run(spark, sf_dir, options=options):
            result = window_functions(
                _orders(spark, sf_dir), keys, order, functions, **options
            )
            return _rounded(result, 2, *rounded).select(*kept, *functions)


_register_window(
    "window_ranks",
    """SELECT o_orderkey, o_orderstatus,
        row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_orderdate, o_orderkey)::INTEGER AS rn
       FROM orders""",
    ["o_orderstatus"],
    ["o_orderpriority", "o_orderdate", "o_orderkey"],
    {"rn": "row_number"},
    ["o_orderkey", "o_orderstatus"],
)
_register_window(
    "window_ranks_ties",
    """SELECT o_orderkey, o_orderstatus,
        rank() OVER w::INTEGER AS rk, dense_rank() OVER w::INTEGER AS dr
       FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderpriority DESC, o_orderdate)""",
    ["o_orderstatus"],
    [("o_orderpriority", "desc"), "o_orderdate"],
    {"rk": "rank", "dr": "dense_rank"},
    ["o_orderkey", "o_orderstatus"],
)
_register_window(
    "window_lag_lead",
    """SELECT o_orderkey, o_orderstatus,
        lag(o_totalprice) OVER w AS before, lag(o_totalprice, 3) OVER w AS before_3,
        lead(o_totalprice) OVER w AS after, lead(o_totalprice, 2) OVER w AS after_2
       FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey)""",
    ["o_orderstatus"],
    ["o_orderdate", "o_orderkey"],
    {
        "before": "lag(o_totalprice)", "before_3": "lag(o_totalprice, 3)",
        "after": "lead(o_totalprice)", "after_2": ("lead", "o_totalprice", 2),
    },
    ["o_orderkey", "o_orderstatus"],
)
_register_window(
    "running_sum",
    """SELECT o_orderkey, o_orderstatus,
        round(sum(o_totalprice) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS total
       FROM orders""",
    ["o_orderstatus"],
    ["o_orderdate", "o_orderkey"],
    {"total": "sum(o_totalprice)"},
    ["o_orderkey", "o_orderstatus"],
    ["total"],
)
_register_window(
    "global_rank",
    """SELECT o_orderkey, rank() OVER w::INTEGER AS rk, dense_rank() OVER w::INTEGER AS dr
       FROM orders WINDOW w AS (ORDER BY o_orderdate DESC, o_orderpriority)""",
    [],
    [("o_orderdate", "desc"), "o_orderpriority"],
    {"rk": "rank", "dr": "dense_rank"},
    ["o_orderkey"],
)


@query(
    "window_per_customer",
    f"""SELECT o_orderkey, o_custkey, row_number() OVER {_ORDER}::INTEGER AS rn,
               lag(o_totalprice) OVER {_ORDER} AS before,
               round(sum(o_totalprice) OVER {_ORDER[:-1]}
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS total
        FROM orders""",
)
def window_per_customer(spark, sf_dir):
    result = window_functions(
        _orders(spark, sf_dir),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        {"rn": "row_number", "before": "lag(o_totalprice)", "total": "sum(o_totalprice)"},
    )
    return _rounded(result, 2, "total").select(
        "o_orderkey", "o_custkey", "rn", "before", "total"
    )


def _register_rolling(name, function, keys, size, **options):
    partition = ", ".join(keys)
    value = f"{function}(value) OVER (PARTITION BY {partition} ORDER BY ts, event_id ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    alias = f"rolling_{function}_{size}"
    shown = value if function == "count" else f"round({value}, 4)"

    @query(name, f"SELECT event_id, {partition}, {shown} AS {alias} FROM events")
    def run(spark, sf_dir):
        rolled = rolling_aggregation(
            table(spark, sf_dir, "events"), keys, ["ts", "event_id"], size, "value",
            function, **options,
        )
        if function != "count":
            rolled = _rounded(rolled, 4, alias)
        return rolled.select("event_id", *keys, alias)


for _function in ("avg", "sum", "min", "max", "count"):
    _register_rolling(f"rolling_{_function}", _function, ["user_id"], 3)
    _register_rolling(
        f"rolling_{_function}_split", _function, ["event_type"], 3, group_rows=SMALL_GROUP
    )


for _function in ("min", "max"):  # frames longer than most groups, and than the parts of split ones
    _register_rolling(f"rolling_{_function}_long", _function, ["event_type"], 10_000)
    _register_rolling(
        f"rolling_{_function}_long_split", _function, ["event_type"], 700, group_rows=SMALL_GROUP
    )


# --- sorting --------------------------------------------------------------------


@query(
    "sort_topk",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
)
def sort_topk(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_k(orders, [("o_totalprice", "desc"), "o_orderkey"], 20)


@query("sort_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY ALL")
def sort_rows_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sort_rows(orders, ["o_custkey", ("o_totalprice", "desc")])


@query("preview")
def preview(spark, sf_dir):
    return head(table(spark, sf_dir, "orders"), 10)


# --- quality --------------------------------------------------------------------

_NULL_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _per_column(select, source, columns=_NULL_COLUMNS):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {select.format(c=c)} FROM {source}" for c in columns
    )


@query(
    "profile_nulls",
    "SELECT * FROM ("
    + _per_column(
        "count_if({c} IS NULL)::BIGINT AS null_count, "
        "round(count_if({c} IS NULL) * 100.0 / count(*), 2) AS null_percentage",
        p.ORDERS_WITH_NULLS,
    )
    + ") WHERE null_count > 0",
)
def profile_nulls(spark, sf_dir):
    return q.null_profile(p.orders_with_nulls(spark, sf_dir))


@query(
    "profile_columns",
    _per_column(
        "count_if({c} IS NULL)::BIGINT AS null_count, "
        "count(DISTINCT {c}) + max(({c} IS NULL)::INTEGER) AS distinct_count, "
        "round(count({c}) * 100.0 / count(*), 6) AS completeness, "
        "round((count(DISTINCT {c}) + max(({c} IS NULL)::INTEGER)) * 100.0 / count(*), 6) AS uniqueness",
        p.ORDERS_WITH_NULLS,
    ),
)
def profile_columns(spark, sf_dir):
    return _rounded(
        q.column_profile(p.orders_with_nulls(spark, sf_dir)), 6, "completeness", "uniqueness"
    )


@query("profile_columns_approximate")
def profile_columns_approximate(spark, sf_dir):
    return q.column_profile(p.orders_with_nulls(spark, sf_dir), approximate=True)


@query(
    "profile_table",
    f"""SELECT n AS total_rows, 5 AS total_columns, nulls AS total_nulls,
               round((n * 5 - nulls) * 100.0 / (n * 5), 6) AS completeness,
               round(nulls * 100.0 / (n * 5), 6) AS null_percentage,
               round(n * 5 * 8 / 1048576.0, 6) AS estimated_mb
        FROM (SELECT count(*) AS n,
                     (count_if(o_totalprice IS NULL) + count_if(o_orderpriority IS NULL))::BIGINT AS nulls
              FROM {p.ORDERS_WITH_NULLS})""",
)
def profile_table(spark, sf_dir):
    return _rounded(
        q.table_profile(p.orders_with_nulls(spark, sf_dir)),
        6, "completeness", "null_percentage", "estimated_mb",
    )

@query(
    "profile_plan_size",
    """SELECT count(*) AS total_rows, round(count(*) * 6 * 8 / 1048576.0, 6) AS estimated_mb, true AS planned
       FROM orders""",
)
def profile_plan_size(spark, sf_dir):
    """The formula beside the optimizer's estimate, which is the size of the table's files."""
    orders = table(spark, sf_dir, "orders")
    profile = q.table_profile(orders, plan_size=True)
    return _rounded(profile, 6, "estimated_mb").select(
        "total_rows", "estimated_mb", F.col("plan_mb").between(0.001, F.col("total_rows")).alias("planned")
    )



@query(
    "duplicate_rows",
    f"""SELECT a AS total_rows, a - d AS duplicate_count,
               round((a - d) * 100.0 / a, 2) AS duplicate_percentage
        FROM (SELECT count(*) AS a FROM {p.ORDERS_WITH_COPIES}),
             (SELECT count(*) AS d FROM (SELECT DISTINCT * FROM {p.ORDERS_WITH_COPIES}))""",
)
def duplicate_rows(spark, sf_dir):
    return q.duplicate_rows(p.orders_with_copies(spark, sf_dir))


@query(
    "schema_samples",
    """SELECT position, "column", data_type, true AS nullable,
              CASE WHEN length(s) > 50 THEN substr(s, 1, 50) || '...' ELSE s END AS sample_values
       FROM ("""
    + " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS data_type,
            (SELECT string_agg({c}::VARCHAR, ', ' ORDER BY o_totalprice DESC, o_orderkey) FROM
                (FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3)) AS s"""
        for i, (c, t) in enumerate(
            [
                ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderpriority", "string"),
            ],
            1,
        )
    )
    + ")",
)
def schema_samples(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    return q.schema_samples(sort_rows(orders, [("o_totalprice", "desc"), "o_orderkey"]))


@query(
    "type_distribution",
    """SELECT * FROM (VALUES ('bigint', 3), ('double', 4), ('int', 1), ('string', 2),
                             ('timestamp_ntz', 1)) AS t(data_type, columns),
              (SELECT count(*) AS total_rows FROM lineitem)""",
)
def type_distribution(spark, sf_dir):
    report = q.assess(table(spark, sf_dir, "lineitem"))
    return report.select(F.explode("data_types").alias("data_type", "columns"), "total_rows")


@query(
    "assess_nulls",
    "SELECT n AS total_rows, 5 AS total_columns, 0::BIGINT AS duplicate_count, x.* FROM "
    f"(SELECT count(*) AS n FROM {p.ORDERS_WITH_NULLS}), ("
    + _per_column(
        "count_if({c} IS NULL)::BIGINT AS null_count, "
        "round(count_if({c} IS NULL) * 100.0 / count(*), 2) AS null_percentage",
        p.ORDERS_WITH_NULLS,
    )
    + ") x WHERE null_count > 0",
)
def assess_nulls(spark, sf_dir):
    return q.assess(p.orders_with_nulls(spark, sf_dir)).select(
        "total_rows", "total_columns", "duplicate_count", F.inline("null_analysis")
    )


_OVERVIEW = f"""
    SELECT 'with_nulls' AS dataset, count(*) AS total_rows, 5 AS total_columns,
           0::BIGINT AS duplicate_count,
           round(count_if(o_orderpriority IS NULL) * 100.0 / count(*), 2) AS null_percentage_1,
           round(count_if(o_totalprice IS NULL) * 100.0 / count(*), 2) AS null_percentage_2,
           0.0::DOUBLE AS null_percentage_3, 0.0::DOUBLE AS null_percentage_4,
           0.0::DOUBLE AS null_percentage_5, 2 AS null_columns
    FROM {p.ORDERS_WITH_NULLS}
    UNION ALL
    SELECT 'with_copies', count(*), 5, count(*) - (SELECT count(*) FROM orders), 0, 0, 0, 0, 0, 0
    FROM {p.ORDERS_WITH_COPIES}
    UNION ALL
    SELECT 'lineitem', count(*), 11,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)), 0, 0, 0, 0, 0, 0
    FROM lineitem
"""


def _overview_tables(spark, sf_dir):
    return {
        "with_nulls": p.orders_with_nulls(spark, sf_dir),
        "with_copies": p.orders_with_copies(spark, sf_dir),
        "lineitem": table(spark, sf_dir, "lineitem"),
    }


@query("quality_overview", _OVERVIEW)
def quality_overview(spark, sf_dir):
    overview = q.quality_overview(_overview_tables(spark, sf_dir))
    return overview.withColumn("null_columns", F.size("null_percentages")).drop("null_percentages")


@query(
    "completeness_overview",
    f"""SELECT dataset, total_rows, total_columns, total_nulls,
               round((total_rows * total_columns - total_nulls) * 100.0
                     / (total_rows * total_columns), 6) AS completeness
    FROM (
        SELECT 'with_nulls' AS dataset, count(*) AS total_rows, 5 AS total_columns,
               (count_if(o_orderpriority IS NULL) + count_if(o_totalprice IS NULL))::BIGINT AS total_nulls
        FROM {p.ORDERS_WITH_NULLS}
        UNION ALL SELECT 'with_copies', count(*), 5, 0 FROM {p.ORDERS_WITH_COPIES}
        UNION ALL SELECT 'lineitem', count(*), 11, 0 FROM lineitem)""",
)
def completeness_overview(spark, sf_dir):
    return _rounded(
        q.completeness_overview(_overview_tables(spark, sf_dir)), 6, "completeness"
    )
