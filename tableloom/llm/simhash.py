"""SimHash near-duplicates: majority fingerprints, pigeonhole blocks, components.

A fingerprint is cut into ``blocks`` runs of bits. Two fingerprints that differ
in at most ``radius`` bits agree in at least ``blocks - radius`` whole runs, so
they share the key made of some ``blocks - radius`` of them. Fingerprints are
joined on these keys and each pair's Hamming distance is verified.

A key that many different fingerprints share would make a quadratic number of
pairs. Such a bucket is linked exactly in another way: two fingerprints at most
two bits apart have a midpoint at most one bit from each, so every member names
the 65 points within one bit, and all that name a point (65 at most) are within
two bits of each other and form a star.

Only different fingerprints are joined; equal ones need no links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, slices, store, table
from .registry import query

SHINGLE_WORDS = 3
RADIUS = 2
BLOCKS = 5
BUCKET = 64
"""Different fingerprints in a bucket up to which all its pairs are compared."""


def _word_lists(data: bytes) -> Iterator[list[bytes]]:
    """The words of ``data``, some at a time; each list repeats the two words before it."""
    carried = []
    for piece in pieces(data):
        words = carried + piece.split()
        yield words
        carried = words[-(SHINGLE_WORDS - 1) :]


def fingerprint(text: str | None) -> int:
    """Majority fingerprint of the text's shingles (fewer words: of all its words)."""
    data = (text or "").encode().lower()
    ones, total, short = np.zeros(64, np.int64), 0, None
    for words in _word_lists(data):
        if len(words) < SHINGLE_WORDS:
            short = words if total == 0 else short
            continue
        joined = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
        starts = [0, *(e + 1 for e in ends)]
        hashes = np.array(
            [
                xxhash.xxh64_intdigest(joined[s:e], 42)
                for s, e in zip(starts, ends[SHINGLE_WORDS - 1 :])
            ],
            np.uint64,
        )
        total += len(hashes)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    if total == 0:
        return xxhash.xxh64_intdigest(b" ".join(short), 42) if short else 0
    return sum(1 << k for k in range(64) if 2 * int(ones[k]) > total)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``fp`` (the 64 bits as a signed long) of every row; null text: zero."""

    def run(batches):
        for batch in slices(batches):
            values = [_signed(fingerprint(t)) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("id"), pa.array(values, pa.int64())], names=["id", "fp"]
            )

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def _block_keys(blocks: int, radius: int):
    """For each choice of runs, the mask of the bits it keeps."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    runs = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    return [sum(c) for c in combinations(runs, blocks - radius)]


def links(
    points: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, bucket: int = BUCKET
) -> DataFrame:
    """Pairs ``a``, ``b`` that connect all fingerprints within ``radius`` bits.

    ``points``: different fingerprints in ``fp``, a written table. Buckets of up
    to ``bucket`` give every pair; larger ones give stars around shared midpoints
    (for radius 2), which connect the same fingerprints.
    """
    if radius != 2:
        raise ValueError("midpoints link fingerprints at two bits; radius must be 2")
    masks = _block_keys(blocks, radius)
    keyed = points.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                    for i, m in enumerate(masks)
                ]
            )
        ).alias("k"),
    ).select("fp", "k.t", "k.key")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = store(keyed.join(sizes, ["t", "key"]), "simhash-blocks")
    small = shared.filter(F.col("n") <= bucket).select("t", "key", "fp")
    pairs = (
        small.withColumnRenamed("fp", "a")
        .join(small.withColumnRenamed("fp", "b"), ["t", "key"])
        .filter(
            (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
        )
        .select("a", "b")
    )
    flips = [F.lit(0).cast("long")] + [F.lit(_signed(1 << k)) for k in range(64)]
    hot = shared.filter(F.col("n") > bucket).select("fp").distinct()
    named = hot.select("fp", F.explode(F.array(*flips)).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid")
    )
    stars = (
        named.groupBy("mid")
        .agg(F.collect_list("fp").alias("fps"))  # 65 at most
        .filter(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        .filter("a != b")
    )
    return pairs.union(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node reachable) of every node that has an edge.

    Rounds of large-star and small-star: neighbours move to the least node they
    see. Every round is written; a round's files are all the next one reads.
    """
    current = store(edges.select("a", "b"), "simhash-edges")
    before = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: larger neighbours of a node move to the least of it and its neighbours.
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        # Small star: a node and its smaller neighbours move to the least of these.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).union(low.select("a", F.col("m").alias("b")))
        current = store(small.distinct(), "simhash-edges")
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    bucket: int = BUCKET,
) -> DataFrame:
    """``id``, ``fp``, ``component`` of every row of ``docs``.

    Rows whose fingerprints are equal, or linked through fingerprints at most
    ``radius`` bits apart, share a component; its number is the smallest id in
    it. Null or empty texts have fingerprint zero. Repeated rows stay, each with
    the same result. A row without id keeps a null id, links like any other, and
    its component is null only if no row in it has an id. No other column of
    ``docs`` is read. An empty table gives an empty table.
    """
    found = store(fingerprints(docs, id_column, text), "simhash-fingerprints")
    points = store(found.groupBy("fp").agg(F.min("id").alias("first")), "simhash-points")
    roots = components(links(points.select("fp"), radius, blocks, bucket))
    rooted = points.join(roots, points.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component"))
    by_point = rooted.join(named, "root").select("fp", "component")
    return found.join(by_point, "fp").select("id", "fp", "component")


@query("op8_simhash")
def op8_simhash(spark, sf_dir):
    groups = near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
