"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. A
text is cut into windows of ``WINDOW`` words; each is compressed with the ordinary
dictionary alone and with the toxic one added to it. How many bytes the toxic one
saves is the window's level. Ordinary words, which both explain, save nothing.

The dictionaries are trained twice. The first ones, of pieces of all fitting texts,
hold much that both kinds of text share. Windows with which they save ``TELLING``
bytes or more train the second ones: those of toxic texts the toxic dictionary, those
of ordinary texts an addition to the ordinary one.

Labelled texts that a dictionary was not trained on give each level a weight (the
logarithm of its rate in toxic over that in ordinary texts), and a logistic curve
over the sum of a text's weights, relative to its length, gives the score. For this
the fitting rows are halved: each half is measured with the dictionaries of the
other, and the dictionaries in use come from both.

Everything is fitted on a bounded sample of labelled rows: ``FIT_ROWS`` of each
label, in the order of a hash of the id, and ``FIT_BYTES`` of pieces of their texts,
in the order of a hash of the piece.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near_copies
from .common import pieces, slices, store, table
from .registry import query

FIT_ROWS = 10_000
"""Labelled rows of each label that are used (20,000 at most)."""
FIT_BYTES = 8 << 20
"""Bytes of pieces of each label that train a dictionary."""
PIECE_WORDS = 32
ORDINARY_BYTES = 65_536
TOXIC_BYTES = 16_384
ADDED_BYTES, TELLING_BYTES = 32_768, 8192
"""Of the second training: what is added to the ordinary one, and the toxic one."""
TELLING = 4
SEGMENT, MATCH = 16, 8
"""Bytes of the segments a dictionary is made of, and of the runs they are chosen by."""
WINDOW = 3
LEVELS = 23
LEAST = -6
"""Level 0 stands for so many bytes saved, or fewer; each further level for one more."""
THRESHOLD = 0.3
HELD_OUT = 2
"""Rows whose id's CRC-32 leaves this remainder by 4 are never learned from."""

# Digits, letters (A-Z in lower case) and all bytes beyond ASCII; the rest ends a word.
_WORDS = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
# A dictionary match needs the search to go on beyond it, and a start that matches anyway.
_LEAD, _TAIL = b"0123456789abcdefghijklmnop", b"QRSTUVWXYZ@"


def _compressor(content: bytes):
    parameters = zstandard.ZstdCompressionParameters(
        min_match=4,
        strategy=zstandard.STRATEGY_GREEDY,
        window_log=18,
        hash_log=17,
        chain_log=17,
        search_log=5,
    )
    held = zstandard.ZstdCompressionDict(content + _LEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=parameters).compress


def windows(data: bytes | None, words: int = WINDOW):
    """The text's windows, each of so many words (or what is left of a piece)."""
    for piece in pieces(data or b""):
        found = piece.translate(_WORDS).split()
        for start in range(0, len(found), words):
            yield b" ".join(found[start : start + words])


class WindowLevels:
    """Counts of a text's windows by level; from the contents of the two dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.both = _compressor(ordinary), _compressor(ordinary + toxic)

    def counts(self, data: bytes | None) -> np.ndarray:
        levels = [max(0, min(LEVELS - 1, self.saved(w) - LEAST)) for w in windows(data)]
        return np.bincount(np.array(levels, np.int64), minlength=LEVELS)

    def saved(self, window: bytes) -> int:
        """Bytes that the toxic dictionary saves on a window."""
        framed = b"%b %b %b" % (_LEAD, window, _TAIL)
        return len(self.ordinary(framed)) - len(self.both(framed))


def _counted(held):
    """Batch function: ``text`` (bytes) becomes ``levels``, its windows' counts by level.

    ``held``: the pairs of dictionaries, of which ``half`` names one; without that
    column the first is used.
    """

    def run(batches):
        levels = [WindowLevels(*d) for d in held.value]
        for batch in slices(batches):
            halves = batch.column("half").to_pylist() if "half" in batch.schema.names else [0] * batch.num_rows
            texts = batch.column("text").to_pylist()
            found = [levels[h].counts(t) for h, t in zip(halves, texts)]
            flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64), pa.int64())
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * LEVELS)
            rest = [n for n in batch.schema.names if n not in ("text", "half")]
            yield pa.record_batch(
                [*[batch.column(n) for n in rest], pa.ListArray.from_arrays(offsets, flat)],
                names=[*rest, "levels"],
            )

    return run


def held_out(number):
    """Whether an id is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(number.cast("string")) % 4 == HELD_OUT, F.lit(False))


def fitting_rows(
    docs: DataFrame, labels: DataFrame, id_column: str, text: str, rows: int = FIT_ROWS
) -> DataFrame:
    """``text``, ``toxic``, ``half`` of the labelled rows to learn from, one of near copies each.

    A row goes only if a kept row with the same label and it share a MinHash band and
    have, by all their hashes, a Jaccard of 0.8 or more of five-word shingles. Many
    copies of one text would make its rare words look telling. An id marked both
    ways counts as toxic; null ids and labels teach nothing.
    """
    marks = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("marked"))
        .agg(F.max("toxic").alias("toxic"))
        .filter(~held_out(F.col("marked")))
    )
    order = F.xxhash64("marked")
    chosen = marks.filter("toxic = 1").orderBy(order).limit(rows).union(
        marks.filter("toxic = 0").orderBy(order).limit(rows)
    )
    chosen = store(chosen, "toxicity-chosen")
    found = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).join(F.broadcast(chosen), F.col("id") == F.col("marked"))  # 2 * rows small rows at most
    found = found.select("id", "toxic", F.xxhash64("text").alias("mark"), "text").dropDuplicates(["id", "mark"])
    # An id can have several texts; the bound holds for rows.
    found = store(found.orderBy(F.xxhash64("id", "mark")).limit(2 * rows), "toxicity-labelled")
    described = found.mapInArrow(_described, "id long, mark long, toxic int, keys array<long>, sketch binary")
    kept = docs.sparkSession.createDataFrame(_distinct(described.toArrow()), "id long, mark long")
    half = F.pmod(F.xxhash64("mark", "id"), F.lit(2).cast("long")).cast("int")
    return store(
        found.join(kept, ["id", "mark"]).select(F.col("text").cast("binary").alias("text"), "toxic", half.alias("half")),
        "toxicity-fit",
    )


def _described(batches):
    shingles = near_copies.Shingles()
    for batch in slices(batches, 64):
        hashed = [near_copies.described(shingles.of(t)) for t in batch.column("text").to_pylist()]
        yield pa.record_batch(
            [
                batch.column("id"),
                batch.column("mark"),
                batch.column("toxic"),
                pa.array([k for k, _ in hashed], pa.list_(pa.int64())),
                pa.array([b for _, b in hashed], pa.binary()),
            ],
            names=["id", "mark", "toxic", "keys", "sketch"],
        )


def _distinct(rows: pa.Table) -> list[tuple[int, int]]:
    """Ids and marks without near copies of a kept row; sketches of a bounded sample."""
    ordered = sorted(rows.to_pylist(), key=lambda r: (r["id"], r["mark"]))
    by_key: dict[tuple[int, int], list[int]] = {}
    sketches, kept = [], []
    for r in ordered:
        keys = [(r["toxic"], k) for k in r["keys"]] or [(r["toxic"], -1)]
        near = sorted({i for k in keys for i in by_key.get(k, ())})
        own = np.frombuffer(r["sketch"], np.uint8)
        if near and (len(own) == 0 or _alike(own, np.stack([sketches[i] for i in near]))):
            continue
        for k in keys:
            by_key.setdefault(k, []).append(len(sketches))
        sketches.append(own)
        kept.append((r["id"], r["mark"]))
    return kept


def _alike(own: np.ndarray, others: np.ndarray) -> bool:
    """Whether the share of equal hashes, less those equal by chance, says 0.8 or more."""
    shares = (others == own).mean(axis=1)
    return bool(((shares - 1 / 256) / (1 - 1 / 256)).max() >= near_copies.JACCARD)


def _pieces(batches):
    for batch in slices(batches, 64):
        found, marks, halves = [], [], []
        for text, toxic, half in zip(*(batch.column(n).to_pylist() for n in ("text", "toxic", "half"))):
            own = list(windows(text, PIECE_WORDS))
            found += own
            marks += [toxic] * len(own)
            halves += [half] * len(own)
        yield pa.record_batch(
            [pa.array(found, pa.binary()), pa.array(marks, pa.int32()), pa.array(halves, pa.int32())],
            names=["piece", "toxic", "half"],
        )


def trained(size: int, samples: list[bytes]) -> bytes:
    """What a zstandard dictionary of ``samples`` holds; too little text is held as it is."""
    try:
        return zstandard.train_dictionary(size + 1024, samples, k=SEGMENT, d=MATCH).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def _samples(pieces: DataFrame, each: int) -> dict[tuple[int, int], list[bytes]]:
    """Pieces by ``toxic`` and ``half``, ``FIT_BYTES`` of each label, in the order of their hashes.

    ``each``: bytes that a piece has on the average, so that enough are fetched.
    """
    sized = store(pieces, "toxicity-pieces").withColumn("order", F.xxhash64("piece"))
    samples: dict[tuple[int, int], list[bytes]] = {}
    for toxic in (0, 1):
        total = 0
        chosen = sized.filter(F.col("toxic") == toxic).orderBy("order", "piece").limit(FIT_BYTES // each)
        for r in chosen.select("piece", "half").toArrow().to_pylist():
            total += len(r["piece"])
            if total > FIT_BYTES:
                break
            samples.setdefault((toxic, r["half"]), []).append(r["piece"])
    return samples


def _pairs(samples, ordinary: int, toxic: int, together: int) -> list[tuple[bytes, bytes]]:
    """Dictionaries of all rows, then of either half's; so many pieces make a sample."""

    def pair(halves: tuple[int, ...]) -> tuple[bytes, bytes]:
        both = [[p for h in halves for p in samples.get((t, h), [])] for t in (0, 1)]
        joined = [[b" ".join(p[i : i + together]) for i in range(0, len(p), together)] for p in both]
        return trained(ordinary, joined[0]), trained(toxic, joined[1])

    return [pair((0, 1)), pair((0,)), pair((1,))]


def _telling(held):
    """The windows of ``text`` with which the other half's dictionaries save enough."""

    def run(batches):
        levels = [WindowLevels(*d) for d in held.value]
        for batch in slices(batches, 64):
            found, marks, halves = [], [], []
            for text, toxic, half in zip(*(batch.column(n).to_pylist() for n in ("text", "toxic", "half"))):
                own = [w for w in windows(text) if levels[2 - half].saved(w) >= TELLING]
                found += own
                marks += [toxic] * len(own)
                halves += [half] * len(own)
            yield pa.record_batch(
                [pa.array(found, pa.binary()), pa.array(marks, pa.int32()), pa.array(halves, pa.int32())],
                names=["piece", "toxic", "half"],
            )

    return run


def dictionaries(rows: DataFrame) -> list[tuple[bytes, bytes]]:
    """Ordinary and toxic dictionary of all rows, then of either half's rows."""
    pieces = "piece binary, toxic int, half int"
    first = _pairs(_samples(rows.mapInArrow(_pieces, pieces), PIECE_WORDS * 4), ORDINARY_BYTES, TOXIC_BYTES, 1)
    held = rows.sparkSession.sparkContext.broadcast(first)
    telling = _samples(rows.mapInArrow(_telling(held), pieces), WINDOW * 4)
    held.unpersist()
    second = _pairs(telling, ADDED_BYTES, TELLING_BYTES, PIECE_WORDS // WINDOW)
    return [(a + c, d) for (a, _), (c, d) in zip(first, second)]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept, by Newton's steps with a little shrinkage."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 1e-3 * beta
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


BASE_WINDOWS = 20
"""A text's sum of weights is divided by the square root of its windows and these."""


def calibrate(rows: DataFrame, held) -> tuple[list[float], float, float]:
    """Weight of each level, and the logistic curve's slope and intercept.

    A half's rows are measured with the other half's dictionaries.
    """
    crossed = rows.withColumn("half", 2 - F.col("half"))
    counted = crossed.mapInArrow(_counted(held), "toxic int, levels array<long>").toArrow()
    y = np.array(counted.column("toxic").to_pylist(), float)
    counts = np.array(counted.column("levels").to_pylist(), float).reshape(-1, LEVELS)
    if not 0 < y.sum() < len(y):
        return [0.0] * LEVELS, 0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    toxic, ordinary = counts[y == 1].sum(axis=0) + 1, counts[y == 0].sum(axis=0) + 1
    weights = np.log((toxic / toxic.sum()) / (ordinary / ordinary.sum()))
    evidence = counts @ weights / np.sqrt(counts.sum(axis=1) + BASE_WINDOWS)
    order = np.argsort(evidence, kind="stable")  # sums then do not depend on the rows' order
    slope, intercept = _logistic(evidence[order], y[order])
    return weights.tolist(), slope, intercept


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    rows: int = FIT_ROWS,
) -> DataFrame:
    """``id``, ``held_out``, ``score`` (0 to 1), ``predicted`` of every row.

    Learned from labelled rows that are not held out. Null and empty texts get
    the score of a text without evidence; repeated rows get equal scores. Without
    labels of both kinds every score is the same. No other column is read.
    """
    spark = docs.sparkSession
    fit = fitting_rows(docs, labels, id_column, text, rows)
    held = spark.sparkContext.broadcast(dictionaries(fit))
    weights, slope, intercept = calibrate(fit, held)
    texts = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    each = [F.get("levels", F.lit(k)) for k in range(LEVELS)]
    total = sum((n * w for n, w in zip(each, weights)), start=F.lit(0.0))
    evidence = total / F.sqrt(sum(each, start=F.lit(BASE_WINDOWS)))
    score = 1 / (1 + F.exp(-(evidence * slope + intercept)))
    return (
        texts.mapInArrow(_counted(held), "id long, levels array<long>")
        .select("id", held_out(F.col("id")).alias("held_out"), score.alias("score"), "levels")
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score", "predicted")
