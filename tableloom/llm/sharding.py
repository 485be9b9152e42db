"""Shards that each hold the sources in their overall proportions.

Rows are ranked within their source in the order of a seeded hash; a row's
fractional rank is its place among its source's rows, from 0 to 1. Sorted by it,
all sources run through the whole order evenly, and cutting the order into equal
runs gives shards of equal counts, each with every source's share.

Ranks come from range-partitioned sorts, so a source of any size is spread over
many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, table
from .registry import query

SHARDS = 16
SEED = 20


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``id``, ``source``, ``size``, ``text_crc32``, ``shard``, ``slot`` of every row.

    ``size`` is the text's UTF-8 bytes plus one; a null text counts as empty.
    Shards' counts differ by one at most; ``slot`` numbers a shard's rows from 0.
    Null is a source like any other. Repeated rows are rows of their own; rows
    equal in id, size and checksum change places freely. An empty table gives an
    empty table.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
    ).withColumn("shuffle", F.xxhash64(F.lit(seed), "id", "text_crc32"))
    ties = ["shuffle", "id", "size", "text_crc32"]
    ranked = numbered(rows, ["source", *ties], "shard-sources", "place")
    sizes = ranked.groupBy(F.col("source").alias("own")).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    even = ranked.join(sizes, F.col("source").eqNullSafe(F.col("own"))).select(
        ((F.col("place") - F.col("first") + 0.5) / F.col("rows")).alias("fraction"),
        "source",
        *ties,
    )
    order = numbered(even, ["fraction", "shuffle", "source", *ties[1:]], "shard-order", "place")
    count = rows.count()
    at = F.expr(f"(place * {shards}L) DIV {max(count, 1)}L")
    first = F.expr(f"(shard * {count}L + {shards - 1}L) DIV {shards}L")
    return (
        order.withColumn("shard", at.cast("int"))
        .withColumn("slot", F.col("place") - first)
        .select("id", "source", "size", "text_crc32", "shard", "slot")
    )


@query("op9_sharding")
def op9_sharding(spark, sf_dir):
    return shard(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
