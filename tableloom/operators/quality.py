"""Profiling and data quality, as tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import cell_digests, quoted, value_digest
from ..functions.sizing import plan_bytes
from .sorting import head

TOP_NULL_COLUMNS = 5
CELL_BYTES = 8
SAMPLE_ROWS = 3
SAMPLE_LENGTH = 50


def _share(part: Column, whole: Column, digits: int | None = None) -> Column:
    """part / whole in percent; NULL for an empty table."""
    percent = F.when(whole > 0, part * 100.0 / whole)
    return percent if digits is None else F.round(percent, digits)


def _null_counts(df: DataFrame) -> DataFrame:
    """One row: total rows and an array of (column, nulls)."""
    nulls = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(F.col(f"`{c}`").isNull()).alias("null_count"),
            )
            for c in df.columns
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"))


def null_profile(df: DataFrame, only_nulls: bool = True) -> DataFrame:
    """Nulls per column, most affected column first; one pass over the table."""
    profile = (
        _null_counts(df)
        .select("rows", F.inline("nulls"))
        .select(
            "column",
            "null_count",
            _share(F.col("null_count"), F.col("rows"), 2).alias("null_percentage"),
        )
    )
    if only_nulls:
        profile = profile.filter(F.col("null_count") > 0)
    return profile.orderBy(F.desc("null_percentage"), "column")


MASK_COLUMNS = 60
"""Columns whose NULLs are noted in one number."""


def _row_groups(df: DataFrame) -> DataFrame:
    """Equal rows as one: how often they occur (``copies``), and their NULLs as bits (``nulls0``, ...).

    Rows are told apart by 128 bits of the columns' digests and their NULLs; these
    numbers alone are shuffled.
    """
    digests = [value_digest(quoted(f.name), f.dataType) for f in df.schema.fields]
    masks = []
    for start in range(0, len(df.columns), MASK_COLUMNS):
        bits = [
            F.when(quoted(c).isNull(), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            for i, c in enumerate(df.columns[start : start + MASK_COLUMNS])
        ]
        masks.append(reduce(lambda x, y: x.bitwiseOR(y), bits).alias(f"nulls{len(masks)}"))
    narrow = df.select(
        F.xxhash64(*[a for a, _ in digests]).alias("a"), F.xxhash64(F.lit(3), *[b for _, b in digests]).alias("b"), *masks
    )
    return narrow.groupBy("a", "b", *[f"nulls{i}" for i in range(len(masks))]).agg(
        F.count(F.lit(1)).alias("copies")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row, and their share; digests are shuffled, not rows."""
    return _row_groups(df).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_count"),
    ).withColumn(
        "duplicate_percentage",
        _share(F.col("duplicate_count"), F.col("total_rows"), 2),
    )


def type_distribution(df: DataFrame) -> DataFrame:
    """Number of columns per data type."""
    types = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    listed = df.sparkSession.createDataFrame(types, "column string, data_type string")
    return listed.groupBy("data_type").agg(F.count(F.lit(1)).alias("columns"))


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Nulls, distinct values, completeness and uniqueness per column.

    NULL counts as one distinct value. The exact form groups (column, digest)
    cells before it counts them, so no column is expanded per distinct
    aggregate and no value is shuffled; the approximate form is a single pass
    without that shuffle.
    """
    if approximate:
        cells = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.col(f"`{c}`").isNull()).alias("null_count"),
                    (
                        F.approx_count_distinct(f"`{c}`")
                        + F.max(F.col(f"`{c}`").isNull().cast("int"))
                    ).alias("distinct_count"),
                )
                for c in df.columns
            ]
        )
        counted = df.agg(cells.alias("cells")).select(F.inline("cells"))
    else:
        values = cell_digests(df, df.columns).groupBy("cell", "a", "b").agg(F.count(F.lit(1)).alias("n"))
        names = F.array(*[F.lit(c) for c in df.columns])
        counted = (
            values.groupBy("cell")
            .agg(
                F.sum("n").alias("rows"),
                F.coalesce(F.sum(F.when(F.col("a").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
                F.count(F.lit(1)).alias("distinct_count"),
            )
            .withColumn("column", F.get(names, F.col("cell")))
        )
    return counted.select(
        "column",
        "null_count",
        "distinct_count",
        _share(F.col("rows") - F.col("null_count"), F.col("rows")).alias("completeness"),
        _share(F.col("distinct_count"), F.col("rows")).alias("uniqueness"),
    )


def table_profile(df: DataFrame, plan_size: bool = False) -> DataFrame:
    """Shape, nulls, completeness and estimated size, in one pass.

    ``plan_size`` adds ``plan_mb``, the optimizer's own estimate of the result,
    NULL where it has none (see ``functions.sizing``); it costs no job.
    """
    columns = len(df.columns)
    nulls = F.aggregate(
        "nulls", F.lit(0).cast("bigint"), lambda total, c: total + c["null_count"]
    )
    shape = _null_counts(df).select(
        F.col("rows").alias("total_rows"),
        F.lit(columns).alias("total_columns"),
        nulls.alias("total_nulls"),
    )
    cells = F.col("total_rows") * columns
    size = plan_bytes(df) if plan_size else None
    planned = F.lit(None if size is None else size / (1024 * 1024)).cast("double").alias("plan_mb")
    return shape.select(
        "*",
        _share(cells - F.col("total_nulls"), cells).alias("completeness"),
        F.coalesce(_share(F.col("total_nulls"), cells), F.lit(0.0)).alias(
            "null_percentage"
        ),
        (cells * CELL_BYTES / (1024 * 1024)).alias("estimated_mb"),
        *([planned] if plan_size else []),
    )


def schema_samples(df: DataFrame) -> DataFrame:
    """Name, type, nullability and sample values of every column.

    The samples are the values of the first three rows, NULLs left out, as text
    of at most 50 characters. Sort ``df`` to say which rows come first.
    """
    fields = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields, 1)
    ]
    listed = df.sparkSession.createDataFrame(
        fields, "position int, column string, data_type string, nullable boolean"
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.array_join(F.collect_list(F.col(f"`{c}`").cast("string")), ", ").alias("text"),
            )
            for c in df.columns
        ]
    )
    samples = head(df, SAMPLE_ROWS).agg(cells.alias("cells")).select(F.inline("cells"))
    shown = F.when(
        F.length("text") > SAMPLE_LENGTH,
        F.concat(F.substring("text", 1, SAMPLE_LENGTH), F.lit("...")),
    ).otherwise(F.col("text"))
    return listed.join(samples, "column").select(
        "position", "column", "data_type", "nullable", shown.alias("sample_values")
    )


def assess(df: DataFrame) -> DataFrame:
    """The full assessment as one row: shape, duplicates, nulls, types.

    One scan and one grouping give all of it: equal rows have equal NULLs, so
    these are counted beside the duplicates, from digests of the rows.
    """
    nulls = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.coalesce(
                    F.sum(
                        F.when(
                            F.col(f"nulls{i // MASK_COLUMNS}").bitwiseAND(F.lit(1 << i % MASK_COLUMNS).cast("bigint")) != 0,
                            F.col("copies"),
                        )
                    ),
                    F.lit(0),
                ).alias("null_count"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    counted = _row_groups(df).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_count"),
        nulls.alias("nulls"),
    )
    ranked = F.array_sort(
        F.transform(
            F.filter("nulls", lambda c: c["null_count"] > 0),
            lambda c: F.struct(
                (-F.round(c["null_count"] * 100.0 / F.col("total_rows"), 2)).alias("by"),
                c["column"].alias("column"),
                c["null_count"].alias("null_count"),
            ),
        )
    )
    types: dict[str, int] = {}
    for field in df.schema.fields:
        name = field.dataType.simpleString()
        types[name] = types.get(name, 0) + 1
    return counted.select(
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        "duplicate_count",
        _share(F.col("duplicate_count"), F.col("total_rows"), 2).alias(
            "duplicate_percentage"
        ),
        F.transform(
            ranked,
            lambda c: F.struct(
                c["column"].alias("column"),
                c["null_count"].alias("null_count"),
                (-c["by"]).alias("null_percentage"),
            ),
        ).alias("null_analysis"),
        F.create_map(
            *[F.lit(v) for name in sorted(types) for v in (name, types[name])]
        ).alias("data_types"),
    )


def quality_overview(tables: Mapping[str, DataFrame], worst_columns: int = TOP_NULL_COLUMNS) -> DataFrame:
    """One row per dataset: rows, columns, duplicates, the worst null shares.

    ``null_percentages`` lists them all, the worst first.
    """

    def line(name: str, df: DataFrame) -> DataFrame:
        worst = [
            F.coalesce(F.get("null_analysis", F.lit(i))["null_percentage"], F.lit(0.0)).alias(
                f"null_percentage_{i + 1}"
            )
            for i in range(worst_columns)
        ]
        return assess(df).select(
            F.lit(name).alias("dataset"),
            "total_rows",
            "total_columns",
            "duplicate_count",
            *worst,
            F.transform("null_analysis", lambda c: c["null_percentage"]).alias("null_percentages"),
        )

    return reduce(DataFrame.unionByName, [line(n, df) for n, df in tables.items()])


def completeness_overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per dataset: rows, columns, nulls and completeness."""
    return reduce(
        DataFrame.unionByName,
        [
            table_profile(df).select(
                F.lit(name).alias("dataset"),
                "total_rows",
                "total_columns",
                "total_nulls",
                "completeness",
            )
            for name, df in tables.items()
        ],
    )


def dataset_info(df: DataFrame, preview: int = 5) -> dict[str, DataFrame]:
    """Shape, schema with samples and the first rows, as three tables."""
    return {
        "shape": table_profile(df).select("total_rows", "total_columns"),
        "schema": schema_samples(df),
        "preview": head(df, preview),
    }

