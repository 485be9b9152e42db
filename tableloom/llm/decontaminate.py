"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words at a mask's fixed positions; words at the other
positions may differ. Three masks of six words find, wherever at most 4 of 20
aligned words differ, at least one place where all masked words agree (the
tests check every pattern). Benchmark seeds are looked up in every text, and
each hit's alignment is verified word by word.

The benchmark is taken in blocks of a bounded number of words, so that what each
task holds does not grow with it; every block meets every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .registry import query

WINDOW = 20
"""Aligned words that are judged together; shorter items are judged whole."""
SIMILARITY = 0.8
MIN_WORDS = 5
"""Items with fewer words cannot be told from ordinary text and are not looked for."""
MASKS = ((0, 1, 2, 5, 6, 8), (0, 2, 5, 12, 13, 14), (0, 5, 6, 7, 8, 13))
BLOCK_WORDS = 1_000_000
"""Benchmark words that a task holds at a time (about 100 MB with their seeds)."""
GROUP_BYTES = 1 << 21
"""Text hashed at a time."""
COMPARED = 1 << 20
"""Pairs of words held against one another at a time."""

_U = np.uint64
_FACTORS = np.array(
    [(0x9E3779B97F4A7C15 * (2 * i + 1)) % 2**64 | 1 for i in range(64)], _U
)
_POWERS = np.cumprod(np.full(4096, 0x100000001B3, _U), dtype=_U)
_LETTERS = np.array(
    [b if b >= 128 or chr(b).isalnum() else 0 for b in range(256)], np.uint8
)
_BITS = 22


def allowed(words: int) -> int:
    """Aligned words that may differ among so many."""
    return words - int(np.ceil(SIMILARITY * words - 1e-9))


def lossless(masks, words: int) -> bool:
    """Whether every way to change ``allowed(words)`` of them leaves a mask intact."""
    places = [
        {o + k for o in m} for m in masks for k in range(words - m[-1])
    ]
    return all(
        any(p.isdisjoint(changed) for p in places)
        for changed in combinations(range(words), allowed(words))
    )


def masks_for(words: int) -> tuple:
    """Masks that miss no item of so many words.

    For items too short for ``MASKS``: runs as long as the longest that must stay
    intact when the changes are spread evenly.
    """
    if words >= WINDOW or lossless(MASKS, words):
        return MASKS
    changes = allowed(words)
    return (tuple(range(-(-(words - changes) // (changes + 1)))),)


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word in lower-case UTF-8 ``data``; a word ends at an offset.

    Words are runs of ASCII letters, digits and all other characters beyond ASCII.
    """
    hashes, places, start, end = [], [], 0, len(data)
    while start < end:
        stop = min(start + GROUP_BYTES, end)
        while stop < end and _LETTERS[data[stop]] and offsets[np.searchsorted(offsets, stop)] != stop:
            stop += 1
        letters = _LETTERS[data[start:stop]]
        inside = letters != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = offsets[np.searchsorted(offsets, start) : np.searchsorted(offsets, stop)] - start
        first[cuts] = inside[cuts]
        begins = np.flatnonzero(first)
        if len(begins):
            lengths = np.diff(begins, append=len(letters))
            lengths[-1] = len(letters) - begins[-1]
            at = np.arange(begins[0], len(letters)) - np.repeat(begins, lengths)
            values = letters[begins[0] :].astype(_U) * _POWERS[at & 4095]
            found = np.add.reduceat(values, begins - begins[0])
            hashes.append((found ^ (found >> _U(29))) * _U(0xBF58476D1CE4E5B9))
            places.append(begins + start)
        start = stop
    if not hashes:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and where each text's words begin (one more: the end)."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset : lower.offset + len(lower) + 1]
    data = np.frombuffer(lower.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    hashes, places = _word_hashes(data, offsets)
    return hashes, np.searchsorted(places, offsets)


def _seeds(hashes: np.ndarray, mask: tuple) -> np.ndarray:
    count = max(0, len(hashes) - mask[-1])
    total = np.zeros(count, _U)
    for factor, o in zip(_FACTORS, mask):
        total += hashes[o : o + count] * factor
    return (total ^ (total >> _U(31))) * _U(0x94D049BB133111EB)


def block_of(items: list[tuple[int | None, str]]) -> tuple:
    """What ``Block`` is made of: the items' ids, words and sorted seeds by mask."""
    words, starts = hashed_words(pa.array([t for _, t in items], pa.string()))
    sizes = np.diff(starts)
    masks = {n: masks_for(int(n)) for n in np.unique(np.minimum(sizes, WINDOW)) if n >= MIN_WORDS}
    tables = []
    for mask in sorted({m for ms in masks.values() for m in ms}):
        used = [i for i, n in enumerate(sizes) if n >= MIN_WORDS and mask in masks[min(n, WINDOW)]]
        found = [_seeds(words[starts[i] : starts[i + 1]], mask) for i in used]
        seeds = np.concatenate(found)
        item = np.repeat(np.array(used), [len(f) for f in found])
        place = np.concatenate([np.arange(len(f)) for f in found])
        order = np.lexsort((place, item, seeds))
        seeds, item, place = seeds[order], item[order], place[order]
        # One entry per seed and item, however often the item repeats the seed.
        new = np.ones(len(seeds), bool)
        new[1:] = (seeds[1:] != seeds[:-1]) | (item[1:] != item[:-1])
        first = np.flatnonzero(new)
        present = np.zeros(1 << _BITS, bool)
        present[(seeds >> _U(64 - _BITS)).astype(np.int64)] = True
        tables.append((mask, seeds[first], item[first], first, np.diff(first, append=len(seeds)), place, present))
    return [i for i, _ in items], words, starts, tables


class Block:
    """Some benchmark items, made ready for look-ups; from the parts of ``block_of``."""

    def __init__(self, ids: list, words: np.ndarray, starts: np.ndarray, tables: list):
        self.ids, self.words, self.starts, self.tables = ids, words, starts, tables

    def alignments(self, words: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Text, item, and the shifts at which a seed of the item occurs in the text.

        A text and an item that repeat the same seeds meet in very many pairs of
        places, but in no more shifts than they have words: then all shifts are given.
        """
        hits = []
        for mask, seeds, item, first, count, place, present in self.tables:
            own = _seeds(words, mask)
            at = np.flatnonzero(present[(own >> _U(64 - _BITS)).astype(np.int64)])
            low = np.searchsorted(seeds, own[at], "left")
            found = np.searchsorted(seeds, own[at], "right") - low
            at, low, found = at[found > 0], low[found > 0], found[found > 0]
            text = np.searchsorted(starts, at, "right") - 1
            whole = at + mask[-1] < starts[text + 1]
            at, low, found, text = at[whole], low[whole], found[whole], text[whole]
            entry = np.repeat(low, found) + _counted_up(found)
            hits.append(
                (np.repeat(text, found) * len(self.ids) + item[entry], np.repeat(at - starts[text], found),
                 first[entry], count[entry], place)
            )
        if not any(len(h[0]) for h in hits):
            return
        pairs, inverse = np.unique(np.concatenate([h[0] for h in hits]), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([h[3] for h in hits]))
        texts, items = pairs // len(self.ids), pairs % len(self.ids)
        sizes = np.diff(starts)[texts] + np.diff(self.starts)[items]
        rows, done = [], 0
        for pair, at, first, count, place in hits:
            own = inverse[done : done + len(pair)]
            done += len(pair)
            few = total[own] <= 4 * sizes[own]
            own, at, first, count = own[few], at[few], first[few], count[few]
            shift = np.repeat(at, count) - place[np.repeat(first, count) + _counted_up(count)]
            rows.append(np.stack([np.repeat(own, count), shift], axis=1))
        rows = np.unique(np.concatenate(rows), axis=0)
        edges = np.searchsorted(rows[:, 0], np.arange(len(pairs) + 1))
        for k, (text, item) in enumerate(zip(texts.tolist(), items.tolist())):
            shifts = rows[edges[k] : edges[k + 1], 1]
            if len(shifts) == 0:
                shifts = np.arange(1 - int(np.diff(self.starts)[item]), int(np.diff(starts)[text]))
            yield text, item, shifts

    def overlap(self, item: int, words: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int]:
        """(agreeing words, window, first word in the text) of the best window at any of the shifts."""
        own = self.words[self.starts[item] : self.starts[item + 1]]
        window, best = min(WINDOW, len(own)), (0, 0)
        step = max(1, COMPARED // len(own))
        for start in range(0, len(shifts), step):
            some = shifts[start : start + step]
            place = some[:, None] + np.arange(len(own))
            agree = (words[np.clip(place, 0, len(words) - 1)] == own) & (place >= 0) & (place < len(words))
            total = np.zeros((len(some), len(own) + 1), np.int32)
            np.cumsum(agree, axis=1, out=total[:, 1:])
            sums = total[:, window:] - total[:, :-window]
            at = sums.argmax(axis=1)
            first = np.maximum(at + some, 0)
            found = sums[np.arange(len(some)), at]
            k = np.lexsort((first, -found))[0]
            best = max(best, (int(found[k]), -int(first[k])))
        return best[0], window, -best[1]

    def find(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, agreeing words, window, first word), the best for each text and item."""
        words, starts = hashed_words(texts)
        for text, item, shifts in self.alignments(words, starts):
            agree, window, first = self.overlap(item, words[starts[text] : starts[text + 1]], shifts)
            if window - agree <= allowed(window):
                yield text, item, agree, window, first


def _counted_up(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of ``counts``, one after another."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _groups(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of ``texts`` of a bounded size (a longer text stays alone), each with its start."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if size + n > GROUP_BYTES and i > start:
            yield start, texts.slice(start, i - start)
            start, size = i, 0
        size += n
    yield start, texts.slice(start)


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The benchmark's different items as broadcast blocks of about ``block_words`` words.

    One block is on the driver at a time, made from the rows of one bucket.
    """
    items = benchmark.filter("text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    ).distinct()
    size = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    count = -(-size // block_words)
    for number in range(count):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        rows = [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]
        if rows:
            yield benchmark.sparkSession.sparkContext.broadcast(block_of(rows))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per text and benchmark item of which the text holds a near copy.

    ``id``, ``item_id``, ``agreeing`` of ``window`` aligned words, ``first_word``
    (place in the text, from 0) of the best window. An item overlaps if at least
    0.8 of 20 aligned words agree (of all its words, if it has fewer than 20);
    words are compared in lower case without punctuation. Null and empty texts
    hold nothing; repeated rows give repeated results; empty tables none.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = "id long, item_id long, agreeing long, window long, first_word long"

    def scan(block):
        def run(batches):
            held = Block(*block.value)
            for batch in batches:
                texts = batch.column("text")
                for start, group in _groups(texts):
                    found = list(held.find(group))
                    if not found:
                        continue
                    text_no, item, agree, window, first = zip(*found)
                    yield pa.record_batch(
                        [
                            batch.column("id").take(pa.array([start + t for t in text_no])),
                            pa.array([held.ids[i] for i in item], pa.int64()),
                            *[pa.array(x, pa.int64()) for x in (agree, window, first)],
                        ],
                        names=["id", "item_id", "agreeing", "window", "first_word"],
                    )

        return rows.mapInArrow(run, schema)

    result = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, block_words):
        result = result.union(scan(block))
    return result


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs`` whose text holds no near copy of a benchmark item."""

    def clean(block):
        def run(batches):
            held = Block(*block.value)
            for batch in batches:
                texts = batch.column(text)
                keep = np.ones(len(texts), bool)
                for start, group in _groups(texts):
                    keep[[start + hit[0] for hit in held.find(group)]] = False
                yield batch.filter(pa.array(keep))

        return run

    for block in blocks(benchmark, block_words):
        docs = docs.mapInArrow(clean(block), docs.schema)
    return docs


# Every pair of equal words gives an alignment; those with words enough are judged
# window by window.
_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10ffff}]+')"
_SQL = f"""
    WITH item AS (
        SELECT item_id, words, len(words) AS n, least(len(words), {WINDOW}) AS size
        FROM (SELECT DISTINCT item_id, {_WORDS} AS words FROM benchmark WHERE text IS NOT NULL)
        WHERE len(words) >= {MIN_WORDS}),
    own AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place
            FROM (SELECT doc_id, {_WORDS} AS words FROM documents)),
    wanted AS (SELECT item_id, n, size, unnest(words) AS word, generate_subscripts(words, 1) AS spot FROM item),
    matched AS (SELECT doc_id, item_id, n, size, place - spot AS shift, spot FROM own JOIN wanted USING (word)),
    aligned AS (
        SELECT doc_id, item_id, n, size, shift, list(spot) AS spots FROM matched
        GROUP BY doc_id, item_id, n, size, shift
        HAVING count(*) >= ceil({SIMILARITY} * size - 1e-9)),
    judged AS (
        SELECT doc_id, item_id, size, shift, start,
               len(list_filter(spots, lambda a: a >= start AND a < start + size)) AS agreeing
        FROM (SELECT *, unnest(range(1, n - size + 2)) AS start FROM aligned)),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY agreeing DESC, start) AS k
        FROM judged WHERE agreeing >= ceil({SIMILARITY} * size - 1e-9))
    SELECT doc_id, item_id, agreeing::BIGINT AS agreeing, size::BIGINT AS "window",
           greatest(start - 1 + shift, 0)::BIGINT AS first_word
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id
                 ORDER BY agreeing DESC, greatest(start - 1 + shift, 0)) AS place FROM best WHERE k = 1)
    WHERE place = 1"""


@query("op5_decontaminate", _SQL)
def op5_decontaminate(spark, sf_dir):
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")
