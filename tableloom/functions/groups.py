"""Finding groups too large for one task.

Several operators must bring all rows of a key together. Before they do, they
look for groups above a limit: one aggregate over the key columns alone, combined
map-side, whose few large groups are written once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .expressions import quoted
from .storage import store

GROUP_ROWS = 1_000_000
"""Rows one task is trusted to sort; larger groups are split."""

SIZE = "__group_rows"


def attach(
    df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join ``other`` to ``df`` on ``keys``, where NULL equals NULL.

    Null-safe equality is still an equi-join for Spark; ``other``'s key
    columns do not appear in the result.
    """
    renamed = other.withColumnsRenamed({k: f"__other_{k}" for k in keys})
    match = reduce(
        lambda a, b: a & b,
        [quoted(k).eqNullSafe(quoted(f"__other_{k}")) for k in keys],
    )
    return df.join(renamed, match, how).drop(*[f"__other_{k}" for k in keys])


def large_groups(
    df: DataFrame, keys: list[str], limit: int = GROUP_ROWS
) -> DataFrame | None:
    """Keys holding more than ``limit`` rows, or None when there are none.

    The returned table (keys and row count) has fewer than rows / limit rows
    and is written once, so every later use sees the same keys.
    """
    sizes = df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias(SIZE))
    large = store(sizes.filter(F.col(SIZE) > limit), "large-groups")
    return None if large.isEmpty() else large


def split_off(
    df: DataFrame, keys: list[str], large: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``df`` as (rows outside the large groups, rows inside them)."""
    return attach(df, large, keys, "left_anti"), attach(df, large, keys, "left_semi")
