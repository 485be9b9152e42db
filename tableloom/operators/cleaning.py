"""Cleaning: nulls, duplicates, types, outliers, text, simple projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import (
    OrderSpec,
    known,
    lenient_cast,
    quoted,
    require,
    sort_columns,
    tidy_text,
)
from .quantiles import exact_quantiles, sketched


def remove_nulls(
    df: DataFrame, columns: Sequence[str] | None = None, how: str = "any"
) -> DataFrame:
    """Drop rows with NULL (or NaN) in any / all of the columns.

    No columns, or an empty list, means all columns.
    """
    if how not in ("any", "all"):
        raise ValueError(f"how must be 'any' or 'all', got {how!r}")
    subset = [f"`{c}`" for c in columns or df.columns]
    return df.na.drop(how=how, subset=subset)


def fill_nulls(
    df: DataFrame, fill_values: Mapping | None = None, default_value=0
) -> DataFrame:
    """Fill per column first, then the default in columns of its own type.

    A number fills numeric columns only, a text only text columns, a boolean
    only boolean columns; ``default_value=None`` leaves the other columns alone.
    """
    if fill_values:
        df = df.na.fill(dict(fill_values))
    return df if default_value is None else df.na.fill(default_value)


def remove_duplicates(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order_by: Sequence[OrderSpec] | None = None,
) -> DataFrame:
    """Distinct rows, or one row per key.

    With ``order_by`` the first row in that order survives. Spark limits each
    map task to one row per key before the shuffle (window group limit), so a
    key with very many rows costs no more than any other.
    """
    if not columns:
        return df.distinct()
    require(df, columns)
    if not order_by:
        return df.dropDuplicates(list(columns))
    first = F.row_number().over(
        Window.partitionBy(*map(quoted, columns)).orderBy(*sort_columns(order_by))
    )
    return (
        df.withColumn("__position", first)
        .filter(F.col("__position") == 1)
        .drop("__position")
    )


def convert_types(
    df: DataFrame, type_conversions: Mapping[str, str], strict: bool = False
) -> DataFrame:
    """Cast columns; unknown columns are skipped.

    A value that cannot be converted becomes NULL, or an error if ``strict``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            c: quoted(c).cast(t) if strict else lenient_cast(quoted(c), types[c], t)
            for c, t in type_conversions.items()
            if c in types
        }
    )


def outlier_bounds(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = 1.5,
    exact: bool = False,
) -> DataFrame:
    """One row with ``<column>_low`` and ``<column>_high`` for every column.

    All columns share one pass. The approximate quantiles are mergeable
    sketches; ``exact=True`` ranks the distinct values instead.
    """
    require(df, columns)
    if exact:
        quartiles = exact_quantiles(df, columns, [0.25, 0.75])
        ends = quartiles.groupBy().agg(
            *[
                F.max(
                    F.when(
                        (F.col("column") == c) & (F.col("probability") == p),
                        F.col("value"),
                    )
                ).alias(f"{c}_{name}")
                for c in columns
                for name, p in (("q1", 0.25), ("q3", 0.75))
            ]
        )
    else:
        ends = sketched(df, columns, [0.25, 0.75]).select(
            *[
                F.col(f"q{k}")[i].alias(f"{c}_{name}")
                for k, c in enumerate(columns)
                for i, name in enumerate(("q1", "q3"))
            ]
        )
    spread = {c: quoted(f"{c}_q3") - quoted(f"{c}_q1") for c in columns}
    return ends.select(
        *[
            end
            for c in columns
            for end in (
                (quoted(f"{c}_q1") - multiplier * spread[c]).alias(f"{c}_low"),
                (quoted(f"{c}_q3") + multiplier * spread[c]).alias(f"{c}_high"),
            )
        ]
    )


def _inside(
    df: DataFrame, columns: Sequence[str], multiplier: float, exact: bool
) -> dict[str, Column]:
    bounds = outlier_bounds(df, columns, multiplier, exact)
    if exact:
        # Exact quantiles have run jobs already: one row of plain numbers, which
        # a filter can hand down to the scan.
        row = bounds.first()
        limit = {n: F.lit(row[n]).cast("double") for n in bounds.columns}
    else:
        # A scalar subquery: computed once, when the result is.
        limits = bounds.select(F.struct(*map(quoted, bounds.columns))).scalar()
        limit = {n: limits.getField(n) for n in bounds.columns}
    return {
        c: (quoted(c) >= limit[f"{c}_low"]) & (quoted(c) <= limit[f"{c}_high"]) for c in columns
    }


def remove_outliers(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = 1.5,
    exact: bool = False,
) -> DataFrame:
    """Keep rows inside the interquartile fences of every column.

    Fences come from the unfiltered input; both ends count as inside and NULL
    counts as outside. Unknown columns are skipped.
    """
    names = known(df, columns)
    if not names:
        return df
    inside = _inside(df, names, multiplier, exact)
    keep = F.lit(True)
    for c in names:
        keep = keep & inside[c]
    return df.filter(keep)


def flag_outliers(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = 1.5,
    exact: bool = False,
) -> DataFrame:
    """Add ``is_outlier_<column>`` instead of dropping; NULL stays NULL."""
    names = known(df, columns)
    if not names:
        return df
    inside = _inside(df, names, multiplier, exact)
    return df.withColumns({f"is_outlier_{c}": ~inside[c] for c in names})


def standardize_text(
    df: DataFrame,
    columns: Sequence[str],
    operations: Sequence[str] | None = None,
) -> DataFrame:
    """Trim, change case and strip special characters, in this order."""
    chosen = ["lower", "trim"] if operations is None else list(operations)
    return df.withColumns({c: tidy_text(quoted(c), chosen) for c in known(df, columns)})


def filter_rows(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the SQL condition is true."""
    return df.filter(F.expr(condition))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))
