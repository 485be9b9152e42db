"""Sort, limit and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.expressions import OrderSpec, sort_columns


def sort_rows(df: DataFrame, order_columns: Sequence[OrderSpec]) -> DataFrame:
    """Total order; Spark range-partitions the rows."""
    return df.orderBy(*sort_columns(order_columns))


def head(df: DataFrame, rows: int = 5) -> DataFrame:
    """Any ``rows`` rows, for a preview."""
    return df.limit(rows)


def top_k(df: DataFrame, order_columns: Sequence[OrderSpec], k: int) -> DataFrame:
    """The first ``k`` rows of an order; each task keeps its own best ``k``."""
    return df.orderBy(*sort_columns(order_columns)).limit(k)
