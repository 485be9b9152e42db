"""Grouping, pivoting and statistics.

Everything here aggregates map-side before it shuffles, so a key that holds
much of the table arrives as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import cell_digests, known, quoted, require
from .quantiles import exact_quantiles, sketched

# Function name -> (Spark function, suffix of the result column).
AGGREGATES = {
    "sum": (F.sum, "sum"),
    "avg": (F.avg, "avg"),
    "mean": (F.avg, "avg"),
    "count": (F.count, "count"),
    "min": (F.min, "min"),
    "max": (F.max, "max"),
    "stddev": (F.stddev_samp, "stddev"),
    "var": (F.var_samp, "variance"),
}

TIME_UNITS = ("year", "quarter", "month", "week", "day", "hour", "minute")


def aggregate_columns(aggregations: Mapping[str, str | Sequence[str]]) -> list[Column]:
    """``{"price": "sum"}`` or ``{"price": ["sum", "avg"]}`` as named aggregates."""
    columns = []
    for column, functions in aggregations.items():
        for name in [functions] if isinstance(functions, str) else functions:
            if name not in AGGREGATES:
                raise ValueError(f"unsupported aggregate function: {name}")
            function, suffix = AGGREGATES[name]
            columns.append(function(quoted(column)).alias(f"{column}_{suffix}"))
    if not columns:
        raise ValueError("no aggregations given")
    return columns


def group_by(
    df: DataFrame,
    group_by_columns: Sequence[str],
    aggregations: Mapping[str, str | Sequence[str]],
) -> DataFrame:
    """Aggregate per group; no group columns means one row for the table."""
    return df.groupBy(*map(quoted, group_by_columns)).agg(*aggregate_columns(aggregations))


def group_by_time(
    df: DataFrame,
    time_column: str,
    unit: str,
    aggregations: Mapping[str, str | Sequence[str]],
    group_by_columns: Sequence[str] = (),
) -> DataFrame:
    """Aggregate per calendar unit (and per group); the bucket is its start."""
    if unit not in TIME_UNITS:
        raise ValueError(f"unsupported time unit: {unit}")
    bucket = F.date_trunc(unit, time_column).alias(f"{time_column}_{unit}")
    return df.groupBy(bucket, *group_by_columns).agg(*aggregate_columns(aggregations))


def pivot_values(df: DataFrame, pivot_column: str) -> list:
    """Sorted distinct values, NULL last; more than Spark's limit is an error."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = (
        df.select(pivot_column)
        .distinct()
        .orderBy(F.col(pivot_column).asc_nulls_last())
        .limit(limit + 1)
        .collect()
    )
    if len(found) > limit:
        raise ValueError(
            f"{pivot_column} has more than {limit} values (spark.sql.pivotMaxValues)"
        )
    return [row[0] for row in found]


def pivot(
    df: DataFrame,
    group_columns: Sequence[str],
    pivot_column: str,
    value_column: str,
    agg_function: str = "sum",
    values: Sequence | None = None,
) -> DataFrame:
    """One row per group, one column per pivot value.

    ``count`` counts rows, whatever the value column; a combination that does
    not occur is NULL. Without ``values`` they are looked up first.
    """
    if agg_function not in ("sum", "avg", "count", "max", "min"):
        raise ValueError(f"unsupported pivot function: {agg_function}")
    if values is None:
        values = pivot_values(df, pivot_column)
    pivoted = df.groupBy(*group_columns).pivot(pivot_column, list(values))
    if agg_function == "count":
        return pivoted.count()
    return getattr(pivoted, agg_function)(value_column)


def statistics(
    df: DataFrame, numeric_columns: Sequence[str], exact: bool = False
) -> DataFrame:
    """One row of statistics per numeric column.

    Quartiles are approximate unless ``exact``; skewness is the population
    skewness, kurtosis the excess kurtosis. Unknown columns are skipped. Moments
    and quartiles are two passes, because moments alone run in generated code.
    """
    names = known(df, numeric_columns)
    if not names:
        raise ValueError("none of the columns exists")

    def moments(column: str) -> Column:
        value = quoted(column).cast("double")
        return F.struct(
            F.lit(column).alias("column"),
            F.count(quoted(column)).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("stddev"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.var_samp(value).alias("variance"),
            F.skewness(value).alias("skewness"),
            F.kurtosis(value).alias("kurtosis"),
        )

    quartiles = _exact_quartiles(df, names) if exact else _sketched_quartiles(df, names)
    summary = df.agg(F.array(*[moments(c) for c in names]).alias("rows"))
    # Both sides have one row per analysed column.
    return (
        summary.select(F.inline("rows"))
        .join(F.broadcast(quartiles), "column", "left")
        .select(
            "column", "count", "mean", "stddev", "min", "max", "q1", "median", "q3",
            "variance", "skewness", "kurtosis",
        )
    )


def _sketched_quartiles(df: DataFrame, names: Sequence[str]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(column).alias("column"),
            *[F.col(f"q{k}")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))],
        )
        for k, column in enumerate(names)
    ]
    return sketched(df, names, [0.25, 0.5, 0.75]).select(F.inline(F.array(*rows)))


def _exact_quartiles(df: DataFrame, names: Sequence[str]) -> DataFrame:
    found = exact_quantiles(df, names, [0.25, 0.5, 0.75])
    return found.groupBy("column").agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
            for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
        ]
    )


def distinct_counts(
    df: DataFrame, columns: Sequence[str], approximate: bool = False
) -> DataFrame:
    """One row with ``<column>_distinct`` per column; NULL is not counted."""
    require(df, columns)
    names = list(columns)
    if approximate:
        return df.agg(*[F.approx_count_distinct(quoted(c)).alias(f"{c}_distinct") for c in names])
    # Grouped digests of the cells, counted per column: no row is repeated per aggregate.
    values = cell_digests(df, names).filter("a IS NOT NULL").distinct()
    counted = values.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        *[
            F.coalesce(F.max(F.when(F.col("cell") == i, F.col("n"))), F.lit(0)).alias(f"{c}_distinct")
            for i, c in enumerate(names)
        ]
    )


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a table."""
    return df.agg(F.count(F.lit(1)).alias("rows"))
