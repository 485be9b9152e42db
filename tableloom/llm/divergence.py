"""Source divergence audit: how a source's words differ from its language's.

The first pass counts in how many documents of its language each term occurs;
this exact count decides which terms are kept. Kept terms are cut by a hash into
shards, and each shard gets a minimal perfect hash: a cascade of bit maps, in which
a term's slot is the number of bits before its own. A shard also holds its terms by
slot, so a look-up is verified by the term itself.

The second pass looks up the terms of a task's documents and sends on their slots
and counts; for each (language, source) group and shard, one dense array of slots
is incremented. Shards are broadcast ``BLOCK_BYTES`` at a time, with a pass over the
documents for each block, and released after it.

Shares are whole numbers (billionths); all arithmetic on them is exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces, slices, store, table
from .registry import query

MIN_DOCS = 3
SMOOTHING = 1
TOP = 200
SCALE = 1_000_000_000

SHARDS = 64
"""Shards of each language's terms; more if they would pass ``SHARD_TERMS``."""
SHARD_TERMS = 131_072
BLOCK_BYTES = 64 << 20
"""Shards broadcast at a time."""
HELD_TERMS = 400_000
"""Terms a task holds before it emits their counts."""
SOURCE_BLOCK = 64
"""Sources compared with one another by a task at a time."""
LEVELS = 24

# Letters, A-Z in lower case, and all bytes beyond ASCII; the rest ends a term.
_LETTERS = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(data: bytes | None) -> Iterator[list[bytes]]:
    """The text's terms, a piece at a time."""
    for piece in pieces(data or b""):
        yield piece.translate(_LETTERS).split()


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k, 42) for k in keys), np.uint64, len(keys))


def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
    mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def perfect_hash(keys: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Bit maps of a minimal perfect hash of different ``keys``, and the keys by slot.

    In each level a key that meets no other sets its bit; the others go on. Keys
    that never part (equal 64-bit hashes) take the last slots.
    """
    hashes, levels, ordered = _hashes(keys), [], []
    left = np.arange(len(keys))
    while len(left) and len(levels) < LEVELS:
        size = -(-max(64, 2 * len(left)) // 8) * 8
        at = _places(hashes[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(np.packbits(alone).tobytes())
        mine = alone[at]
        ordered += [keys[i] for i in left[mine][np.argsort(at[mine])]]
        left = left[~mine]
    return levels, ordered + [keys[i] for i in left]


class PerfectHash:
    """Look-up of slots, verified by the stored keys."""

    def __init__(self, levels: list[bytes], keys: list[bytes]):
        self.keys, self.levels, before = keys, [], 0
        for data in levels:
            bits = np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool)
            ranks = np.cumsum(bits) - 1 + before
            before = int(ranks[-1]) + 1
            self.levels.append((bits, ranks))
        self.rest = {k: before + i for i, k in enumerate(keys[before:])}

    def slots(self, keys: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not stored."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(self.levels):
            at = _places(hashes[left], level, len(bits))
            hit = bits[at]
            found[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        for i in np.flatnonzero(found >= 0):
            if self.keys[found[i]] != keys[i]:
                found[i] = -1
        if self.rest:
            for i in np.flatnonzero(found < 0):
                found[i] = self.rest.get(keys[i], -1)
        return found


def _counted_documents(batches):
    """``lang``, ``text`` become ``lang``, ``term``, ``docs`` (of some of the rows)."""
    held: dict[str, Counter] = {}

    def emitted():
        for lang, counter in held.items():
            if counter:
                yield pa.record_batch(
                    [
                        pa.array([lang] * len(counter), pa.string()),
                        pa.array(list(counter), pa.binary()),
                        pa.array(list(counter.values()), pa.int64()),
                    ],
                    names=["lang", "term", "docs"],
                )
        held.clear()

    for batch in slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            held.setdefault(lang, Counter()).update(set().union(*terms(text)))
        if sum(map(len, held.values())) > HELD_TERMS:
            yield from emitted()
    yield from emitted()


def _hashed_shards(keys, rows):
    levels, ordered = perfect_hash(rows.column("term").to_pylist())
    return pa.table(
        {
            "lang": pa.array([keys[0].as_py()], pa.string()),
            "bucket": pa.array([keys[1].as_py()], pa.int64()),
            "levels": pa.array([levels], pa.list_(pa.binary())),
            "terms": pa.array([ordered], pa.list_(pa.binary())),
        }
    )


def _slots_by_bucket(hashes: dict[int, PerfectHash], keys: list[bytes], buckets: int):
    """Bucket and slot of each key, slot -1 for keys that no loaded shard holds."""
    hashed = _hashes(keys)
    bucket = np.mod(hashed.view(np.int64), buckets)  # Spark's remainder, of the signed number
    slots = np.full(len(keys), -1, np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    for start, end in zip(edges[:-1], edges[1:]):
        at = order[start:end]
        shard = hashes.get(int(bucket[at[0]]))
        if shard is not None:
            slots[at] = shard.slots([keys[i] for i in at], hashed[at])
    return bucket, slots


COUNTS = "lang string, source string, bucket long, slots array<int>, counts array<long>"


def _recount(held, buckets: int):
    """``lang``, ``source``, ``text`` become counts by shard and slot (of some of the rows)."""

    def run(batches):
        hashes: dict[str, dict[int, PerfectHash]] = {}
        for lang, number, levels, keys in held.value:
            hashes.setdefault(lang, {})[number] = PerfectHash(levels, keys)
        counters: dict[tuple[str, str], Counter] = {}

        def emitted():
            for lang in {g for g, _ in counters}:
                own = {source: c for (g, source), c in counters.items() if g == lang}
                keys = list(set().union(*own.values()))
                bucket, slots = _slots_by_bucket(hashes[lang], keys, buckets)
                place = dict(zip(keys, (bucket << 32 | slots).tolist()))
                for source, counter in own.items():
                    at = np.fromiter(map(place.__getitem__, counter), np.int64, len(counter))
                    counts = np.fromiter(counter.values(), np.int64, len(counter))
                    order = np.argsort(at)[np.count_nonzero(at < 0) :]  # not stored: below zero
                    at, counts = at[order], counts[order]
                    if len(at) == 0:
                        continue
                    number = at >> 32
                    edges = np.flatnonzero(np.diff(number, prepend=-1, append=-1))
                    yield pa.record_batch(
                        [
                            pa.array([lang] * (len(edges) - 1), pa.string()),
                            pa.array([source] * (len(edges) - 1), pa.string()),
                            pa.array(number[edges[:-1]], pa.int64()),
                            _lists(edges, (at & 0xFFFFFFFF).astype(np.int32)),
                            _lists(edges, counts),
                        ],
                        names=["lang", "source", "bucket", "slots", "counts"],
                    )
            counters.clear()

        for batch in slices(batches):
            columns = [batch.column(n).to_pylist() for n in ("lang", "source", "text")]
            for lang, source, text in zip(*columns):
                if lang in hashes:
                    counter = counters.setdefault((lang, source), Counter())
                    for piece in terms(text):
                        counter.update(piece)
            if sum(map(len, counters.values())) > HELD_TERMS:
                yield from emitted()
        yield from emitted()

    return run


def _lists(edges: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values))


def _incremented(keys: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All counts of a group and shard, added up in one dense array."""
    dense, total = np.zeros(0, np.int64), 0
    for batch in batches:
        slots = batch.column("slots").flatten().to_numpy(zero_copy_only=False)
        counts = batch.column("counts").flatten().to_numpy(zero_copy_only=False)
        if len(slots):
            if slots.max() >= len(dense):
                dense = np.concatenate([dense, np.zeros(int(slots.max()) + 1 - len(dense), np.int64)])
            np.add.at(dense, slots, counts)
            total += int(counts.sum())
    slots = np.flatnonzero(dense)
    yield pa.record_batch(
        [
            pa.array([keys[0].as_py()], pa.string()),
            pa.array([keys[1].as_py()], pa.string()),
            pa.array([keys[2].as_py()], pa.int64()),
            pa.array([slots.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([dense[slots]], pa.list_(pa.int64())),
            pa.array([total], pa.int64()),
        ],
        names=["lang", "source", "bucket", "slots", "counts", "n"],
    )


def _blocks(shards: DataFrame) -> Iterator[list[tuple]]:
    """The shards in blocks of bounded size, one block on the driver at a time."""
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 16)
    sizes = shards.select("lang", "bucket", size.alias("size"))
    # One narrow row per shard of thousands of terms.
    placed = store(
        sizes.withColumn("block", F.expr(f"(sum(size) OVER (ORDER BY lang, bucket) - size) div {BLOCK_BYTES}")),
        "divergence-blocks",
    )
    last = placed.agg(F.max("block")).first()[0]
    for block in range(0 if last is None else last + 1):
        chosen = shards.join(placed.filter(F.col("block") == block).select("lang", "bucket"), ["lang", "bucket"])
        yield [
            (r["lang"], r["bucket"], [bytes(x) for x in r["levels"]], [bytes(x) for x in r["terms"]])
            for r in chosen.orderBy("lang", "bucket").collect()
        ]


def shares(counts: np.ndarray, total: int, size: int) -> np.ndarray:
    """``1 + floor(10^9 (count + 1) / (total + size))``, exactly."""
    whole = total + SMOOTHING * size
    above = counts + SMOOTHING
    if whole >= 1 << 47:  # products would pass 64 bits
        return np.array([1 + SCALE * int(c) // whole for c in above], np.int64)
    first = above % whole * 31_250
    return 1 + above // whole * SCALE + first // whole * 32_000 + first % whole * 32_000 // whole


def _dense(rows: list[dict]) -> np.ndarray:
    """A line of shares for each group of a shard."""
    lines = np.zeros((len(rows), rows[0]["terms"]), np.int64)
    for line, r in zip(lines, rows):
        if r["slots"]:
            line[r["slots"]] = r["counts"]
        line[:] = shares(line, r["total"], r["size"])
    return lines


def _result(lang: str, source: list, item: list, value: list) -> pa.Table:
    return pa.table(
        {
            "lang": pa.array([lang] * len(source), pa.string()),
            "source": pa.array(source, pa.string()),
            "item": pa.array(item, pa.string()),
            "value": pa.array(value, pa.int64()),
        }
    )


def _compared(keys, left, right):
    """Sums of the differences between the sources of two blocks, over one shard."""
    left, right = left.to_pylist(), right.to_pylist()
    source, item, value = [], [], []
    if left and right:
        base = _dense(right)
        for row, line in zip(left, _dense(left)):
            apart = line - base
            for other, total in zip(right, (apart * apart // base).sum(axis=1).tolist()):
                if other["source"] != row["source"]:
                    source.append(row["source"])
                    item.append(other["source"])
                    value.append(total)
    return _result(keys[0].as_py(), source, item, value)


def _above(top: int):
    """The strongest terms of a block of sources, over one shard; no other can be in the result."""

    def run(keys, left, right):
        rows, whole = left.to_pylist(), right.to_pylist()
        source, item, value = [], [], []
        if rows and whole:
            names = [bytes(t).decode("utf-8", "replace") for t in whole[0]["names"]]
            encoded = [bytes(t) for t in whole[0]["names"]]
            base = shares(np.array(whole[0]["counts"], np.int64), whole[0]["total"], whole[0]["size"])
            for row, line in zip(rows, _dense(rows)):
                apart = line - base
                differ = apart * apart // base
                seen = np.array(row["slots"] or [], np.int64)
                seen = seen[apart[seen] > 0]
                if len(seen) > top:  # those that tie with the last one stay in
                    least = np.partition(differ[seen], len(seen) - top)[len(seen) - top]
                    seen = seen[differ[seen] >= least]
                best = sorted(seen.tolist(), key=lambda s: (-int(differ[s]), encoded[s]))[:top]
                source += [row["source"]] * len(best)
                item += [names[s] for s in best]
                value += [int(differ[s]) for s in best]
        return _result(keys[0].as_py(), source, item, value)

    return run


def _summed(keys: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's counts over all sources of the language, by slot."""
    dense = None
    for batch in batches:
        if dense is None:
            dense = np.zeros(batch.column("terms")[0].as_py(), np.int64)
        slots, counts = batch.column("slots").flatten(), batch.column("counts").flatten()
        np.add.at(dense, slots.to_numpy(zero_copy_only=False), counts.to_numpy(zero_copy_only=False))
    yield pa.record_batch(
        [
            pa.array([keys[0].as_py()], pa.string()),
            pa.array([keys[1].as_py()], pa.int64()),
            pa.array([dense], pa.list_(pa.int64())),
        ],
        names=["lang", "bucket", "counts"],
    )


def divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    shards_each: int = SHARDS,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` of every group.

    A group is a (language, source) that occurs; null text, language and source
    count as ''. Terms are runs of letters and characters beyond ASCII; those in
    ``min_docs`` documents of a language are kept for it. A term's share is
    ``1 + floor(10^9 (count + 1) / (sum of counts + number of kept terms))``, and
    two shares p and q differ by ``floor((p - q)^2 / q)``.

    Part ``pair`` compares a group with every other source of its language: the
    sum over all kept terms (0 if none is kept). Part ``term`` lists the ``top``
    terms of the group whose share is above the language's. Ranks go by value,
    largest first, then by item. Repeated rows count as often as they occur; an
    empty table gives an empty table. No other column is read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("lang"),
        F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("source"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    groups = store(rows.select("lang", "source").distinct(), "divergence-groups")
    found = rows.select("lang", "text").mapInArrow(_counted_documents, "lang string, term binary, docs long")
    kept = store(
        found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).drop("docs"),
        "divergence-kept",
    )
    sizes = store(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "divergence-sizes")
    most = sizes.agg(F.max("size")).first()[0] or 1
    buckets = max(shards_each, -(-most // SHARD_TERMS))
    shards = store(
        kept.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets).cast("long")))
        .groupBy("lang", "bucket")
        .applyInArrow(_hashed_shards, "lang string, bucket long, levels array<binary>, terms array<binary>"),
        "divergence-shards",
    )
    recounted = spark.createDataFrame([], COUNTS)
    for block in _blocks(shards):
        held = spark.sparkContext.broadcast(block)
        recounted = recounted.union(store(rows.mapInArrow(_recount(held, buckets), COUNTS), "divergence-slots"))
        held.unpersist()
    counts = store(
        recounted.groupBy("lang", "source", "bucket").applyInArrow(_incremented, f"{COUNTS}, n long"),
        "divergence-counts",
    )
    totals = store(
        groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .fillna(0, ["total", "size"]),
        "divergence-totals",
    )
    blocks = -(-(totals.groupBy("lang").count().agg(F.max("count")).first()[0] or 1) // SOURCE_BLOCK)
    # Every group has a line in every shard of its language, with terms or without.
    lines = store(
        totals.join(shards.select("lang", "bucket", F.size("terms").alias("terms")), "lang")
        .join(counts.drop("n"), ["lang", "source", "bucket"], "left")
        .withColumn("i", F.pmod(F.xxhash64("source"), F.lit(blocks).cast("long"))),
        "divergence-lines",
    )
    return _terms(lines, totals, shards, blocks, top).union(_pairs(lines, totals, blocks))


RESULT = "lang string, source string, item string, value long"


def _every(blocks: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))


def _ranked():
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))


def _terms(lines: DataFrame, totals: DataFrame, shards: DataFrame, blocks: int, top: int) -> DataFrame:
    found = lines.filter("slots IS NOT NULL")
    sums = found.groupBy("lang", "bucket").applyInArrow(_summed, "lang string, bucket long, counts array<long>")
    whole = totals.groupBy("lang").agg(F.sum("total").alias("total"), F.first("size").alias("size"))
    base = (
        sums.join(shards.select("lang", "bucket", F.col("terms").alias("names")), ["lang", "bucket"])
        .join(whole, "lang")
        .withColumn("i", _every(blocks))
    )
    keys = ["lang", "bucket", "i"]
    above = found.groupBy(*keys).cogroup(base.groupBy(*keys)).applyInArrow(_above(top), RESULT)
    ranked = above.withColumn("rank", _ranked()).filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pairs(lines: DataFrame, totals: DataFrame, blocks: int) -> DataFrame:
    left = lines.withColumn("j", _every(blocks))
    right = lines.withColumnRenamed("i", "j").withColumn("i", _every(blocks))
    keys = ["lang", "bucket", "i", "j"]
    sums = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_compared, RESULT)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    names = totals.select("lang", "source")
    pairs = names.join(names.withColumnRenamed("source", "item"), "lang").filter("source != item")  # the result's rows
    valued = pairs.join(sums, ["lang", "source", "item"], "left").fillna(0, ["value"])
    return valued.withColumn("rank", _ranked()).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"
    )


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
occurrences AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM occurrences GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
found AS (SELECT lang, source, term, count(*) AS n FROM occurrences JOIN kept USING (lang, term) GROUP BY ALL),
counts AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k ON g.lang = k.lang
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
own AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 1))
             // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source))::HUGEINT AS p
  FROM counts),
whole AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY lang, term),
base AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1))
             // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::HUGEINT AS q
  FROM whole),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT o.lang, o.source, 'term', o.term, ((p - q) * (p - q) // q)::BIGINT
  FROM own o JOIN base USING (lang, term) WHERE o.n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query("op11_source_divergence", DIVERGENCE_SQL)
def op11_source_divergence(spark, sf_dir):
    return divergence(table(spark, sf_dir, "documents"))
