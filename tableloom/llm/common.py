"""What the operators of this package share: rows kept whole, lets, stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableloom.functions.sizing import partitions_for
from tableloom.functions.storage import store

__all__ = ["WORD_BREAK", "let", "numbered", "packed", "pieces", "slices", "store", "table"]

WORD_BREAK = r"[\x20\x09-\x0D]+"
"""White space between words, in Java's and Python's notation alike."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(df: DataFrame) -> DataFrame:
    """The rows as one struct column ``row``, so that added names cannot clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes that end before ASCII white space.

    What is made of a very long text's words is then held a piece at a time.
    """
    start = 0
    while start < len(data):
        end = start + size
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[start:end]
        start = end


def slices(batches, rows: int = 256):
    """Arrow batches in small slices, so that what Python makes of one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often it is used.

    Spark merges projections, and an expression named inside a lambda would
    then be computed again for every array element.
    """
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def numbered(df: DataFrame, keys: list[str], label: str, name: str = "place") -> DataFrame:
    """``df`` with each row's place (from 0) in the order of ``keys``, written once.

    Rows are range-partitioned and sorted, so no task sees more than its share;
    a partition's first place is the number of rows in the partitions before it.
    Rows equal in all keys get places of their own in an arbitrary order, which
    the written table fixes.
    """
    partitions = partitions_for(df)
    order = [F.col(k).asc_nulls_first() for k in keys]
    ranged = (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .select("*", F.monotonically_increasing_id().alias("__at"))
    )
    part, row = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    ranged = store(ranged, label).select("*", part.alias("__part"), row.alias("__row"))
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition, however many rows these have.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return (
        ranged.join(starts, "__part")
        .withColumn(name, F.col("__start") + F.col("__row"))
        .drop("__at", "__part", "__row", "__start")
    )
