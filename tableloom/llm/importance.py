"""Resampling towards a target distribution, by importance over hashed word n-grams.

A text is its words, each after one separating space. One scan of it stores the
CRC-32 of the prefix before each word (its space included) and of the prefix that
ends with it. An n-gram's CRC then follows from two of them: appending ``k`` bytes
to a prefix shifts its CRC by ``8 k`` places, which is linear over GF(2), so the
CRC of prefix and n-gram, xor the shifted CRC of the prefix, is the n-gram's own.
Neither an n-gram's bytes nor a string of it are ever made.

The first pass counts hashed features of all documents and of all target texts;
the second adds up each document's gains. Documents are drawn without replacement
by the largest sums of weight and Gumbel noise, which a hash of the id gives.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, pieces, slices, store, table
from .registry import query

MAX_WORDS = 1
"""Longest n-gram."""
BUCKETS = 10_000
SCALE = 1000
SEED = 2024
MIN_DRAWN_WORDS = 20
PERCENT = 10

# Digits, letters (A-Z in lower case) and all bytes beyond ASCII; the rest ends a word.
_WORDS = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def _byte_steps() -> np.ndarray:
    """What a CRC's low byte becomes as one more zero byte goes through the register."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1).astype(np.uint32)
    return steps


class Shift:
    """A CRC-32 moved on by so many bytes: a linear map, looked up byte by byte."""

    def __init__(self):
        steps = _byte_steps()
        first = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
        low = [first]
        for _ in range(256):
            low.append(steps[low[-1] & 0xFF] ^ (low[-1] >> 8))
        self.low, self.high = np.stack(low[:256]), [low[256]]
        while len(self.high) < 32:  # each twice as far as the one before
            self.high.append(self._mapped(self.high[-1], self.high[-1]))

    @staticmethod
    def _mapped(maps: np.ndarray, values: np.ndarray) -> np.ndarray:
        return (
            maps[0][values & 0xFF] ^ maps[1][(values >> 8) & 0xFF] ^ maps[2][(values >> 16) & 0xFF] ^ maps[3][values >> 24]
        )

    def __call__(self, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        far = lengths >> 8
        if far.any():
            values = values.copy()
            for k in range(int(far.max()).bit_length()):
                moved = (far >> k & 1).astype(bool)
                values[moved] = self._mapped(self.high[k], values[moved])
        near, low = lengths & 0xFF, self.low
        return (
            low[near, 0, values & 0xFF]
            ^ low[near, 1, (values >> 8) & 0xFF]
            ^ low[near, 2, (values >> 16) & 0xFF]
            ^ low[near, 3, values >> 24]
        )


class Features:
    """CRC-32s of a text's n-grams, a piece of the text at a time."""

    def __init__(self, most: int):
        self.most, self.shift = most, Shift()

    def of(self, data: bytes | None):
        """Arrays of the CRCs of all runs of 1 to ``most`` words, and the words so far."""
        crc, words_before, carried = 0, 0, np.zeros((3, 0), np.int64)
        for piece in pieces(data or b""):
            words = piece.translate(_WORDS).split()
            if not words:
                continue
            before, after = [], []
            for word in words:
                start = crc32(b" ", crc)
                crc = crc32(word, start)
                before.append(start)
                after.append(crc)
            scan = np.array([before, after, list(map(len, words))], np.int64)
            scan = np.concatenate([carried, scan], axis=1)
            old = carried.shape[1]
            starts, ends = scan[0].astype(np.uint32), scan[1].astype(np.uint32)
            stops = np.cumsum(scan[2] + 1)
            found = []
            for n in range(1, self.most + 1):
                # Runs that end in this piece.
                last = np.arange(max(old, n - 1), scan.shape[1])
                first = last - (n - 1)
                lengths = stops[last] - stops[first] + scan[2][first]
                found.append(ends[last] ^ self.shift(starts[first], lengths))
            words_before += len(words)
            carried = scan[:, scan.shape[1] - min(self.most - 1, scan.shape[1]) :]
            yield np.concatenate(found), words_before


def _counted(most: int, buckets: int):
    """``text`` becomes ``bucket``, ``n`` (of some of the rows)."""

    def run(batches):
        features, counts = Features(most), np.zeros(buckets, np.int64)
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                for crcs, _ in features.of(text):
                    counts += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["bucket", "n"])

    return run


def _weighed(most: int, gains: np.ndarray):
    """``id``, ``text`` become ``id``, ``n_words``, ``n_features``, ``weight``."""

    def run(batches):
        features = Features(most)
        for batch in slices(batches):
            words, sizes, weights = [], [], []
            for text in batch.column("text").to_pylist():
                n_words = size = total = 0
                for crcs, n_words in features.of(text):
                    size += len(crcs)
                    total += int(gains[crcs % np.uint32(len(gains))].sum())
                words.append(n_words)
                sizes.append(size)
                weights.append(total // size if size else 0)
            yield pa.record_batch(
                [batch.column("id"), *(pa.array(x, pa.int64()) for x in (words, sizes, weights))],
                names=["id", "n_words", "n_features", "weight"],
            )

    return run


def bucket_counts(texts: DataFrame, text: str, most: int, buckets: int) -> np.ndarray:
    """Features of all ``texts`` in each bucket; the driver sees one number per bucket."""
    rows = texts.select(F.col(f"`{text}`").cast("binary").alias("text"))
    found = rows.mapInArrow(_counted(most, buckets), "bucket long, n long")
    summed = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln(share in the target / share in the source))``, each count one more."""
    s_all, t_all = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(SCALE * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    most_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    min_words: int = MIN_DRAWN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``id``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` of every row.

    Of the rows with ``min_words`` words, ``percent`` in a hundred (rounded down)
    are drawn: those of the highest scores, ties to the smaller id; ``rank``
    counts them from 1 and is null elsewhere. A null or empty text has no
    features and weight 0. A row without id draws its noise from an empty id and
    comes last among ties. Repeated rows are drawn one by one, in any order. An
    empty target makes all texts of one kind of words less likely the rarer these
    are; an empty table gives an empty table. No other column is read.
    """
    gains = bucket_gains(
        bucket_counts(docs, text, most_words, buckets), bucket_counts(target, target_text, most_words, buckets)
    )
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    weighed = rows.mapInArrow(
        _weighed(most_words, gains), "id long, n_words long, n_features long, weight long"
    )
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    chance = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-SCALE * F.log(-F.log((chance + 0.5) / 4294967296.0)))
    scored = store(weighed.withColumn("score", F.col("weight") + noise), "importance-scores")
    eligible = scored.filter(F.col("n_words") >= min_words)
    drawn = eligible.count() * percent // 100
    placed = numbered(
        eligible.withColumn("__low", -F.col("score")).withColumn("__none", F.col("id").isNull()),
        ["__low", "__none", "id"],
        "importance-places",
    )
    columns = ["id", "n_words", "n_features", "weight", "score"]
    ranked = placed.select(*columns, F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank"))
    others = scored.filter(F.col("n_words") < min_words)
    return ranked.union(others.select(*columns, F.lit(None).cast("long").alias("rank")))


@query("op13_importance_resample")
def op13_importance_resample(spark, sf_dir):
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
