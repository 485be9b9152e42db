"""Near copies: texts whose sets of five-word shingles have a Jaccard of 0.8 or more,
or whose SimHashes differ in at most two bits.

Candidates come from MinHash bands: ``BANDS`` keys of ``ROWS`` least hashes each.
Two texts at 0.8 share no key with a chance of 6 in 100,000, closer ones with less.
Every such link is then verified on the whole shingle sets.

A key that many texts share would make a quadratic number of pairs. Its texts are
first compared along a chain, each with the next in an order of the key's own; what
the verified links of all chains connect needs no more comparing. What is left are
the texts of a key outside its largest group. In a key of up to ``BUCKET`` texts
their sketches are compared, and only pairs that agree come back, each from one key;
in a larger one they are queries against blocks of the key's texts, and only the
links they find come back. So the groups are those of comparing all pairs that share
a key.

Only different shingle sets are compared; equal ones are one point. Before two sets
are brought together, sketches of ``BANDS * ROWS`` bytes are: a pair at 0.8 agrees in
fewer than ``SKETCH`` of them with a chance of 1 in a thousand million.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, packed, pieces, slices, store
from .simhash import _signed, components, fingerprint, links

SHINGLE_WORDS = 5
JACCARD = 0.8
BANDS = 32
ROWS = 6
CHUNK = 512
"""Shingles hashed at a time."""
CACHED_WORDS = 50_000
"""Words whose hashes a task remembers (about 150 bytes each); when there are more, it starts anew."""
SEEN_POINTS = 100_000
"""Points a task remembers to have given; later ones may come twice and are merged by key."""
BUCKET = 64
"""Texts in a key up to which all sketches of different groups are compared at once."""
BLOCK = 1024
"""Texts of a larger key held against one another at a time."""
SKETCH = 0.62
FILTER_BITS = 24
"""Size (as a power of two) of the bit map of the points whose sets are needed."""

_CHANCE = np.random.default_rng(42)
_FACTORS = _CHANCE.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _CHANCE.integers(0, 1 << 63, SHINGLE_WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


class Shingles:
    """A text's set of shingles, as sorted hashes; fewer words make one shingle."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _words(self, data: bytes) -> np.ndarray:
        words = data.split()
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known = {}
            new = set(words)
        self.known.update((w, xxhash.xxh64_intdigest(w, 42)) for w in new)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def of(self, text: str | None) -> np.ndarray:
        found = [self._words(p) for p in pieces((text or "").encode().lower())]
        words = np.concatenate(found) if found else np.zeros(0, np.uint64)
        if len(words) == 0:
            return words
        if len(words) < SHINGLE_WORDS:
            words = np.concatenate([words, np.zeros(SHINGLE_WORDS - len(words), np.uint64)])
        count = len(words) - SHINGLE_WORDS + 1
        sums = sum(words[k : k + count] * _PLACES[k] for k in range(SHINGLE_WORDS))
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            sums = (sums ^ (sums >> np.uint64(shift))) * np.uint64(factor)
        return np.unique(sums ^ (sums >> np.uint64(33)))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A key of each band; no shingles, no keys."""
    return described(shingles)[0]


def described(shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The bands' keys, and the last byte of every least hash."""
    if len(shingles) == 0:
        return np.zeros(0, np.int64), b""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), CHUNK):
        hashes = np.multiply.outer(_FACTORS, shingles[start : start + CHUNK])
        np.minimum(least, hashes.min(axis=1), out=least)
    data = least.reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(data)]
    return np.array(keys, np.uint64).view(np.int64), least.astype(np.uint8).tobytes()


def _point(shingles: np.ndarray) -> int:
    return _signed(xxhash.xxh64_intdigest(shingles.tobytes(), 42))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype=np.int64)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int64)))


def _described(batches):
    """``id``, ``mark``, ``text`` become ``id``, ``mark``, ``fp``, ``point``, ``keys``, ``sketch``."""
    shingles = Shingles()
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        sets = [shingles.of(t) for t in texts]
        hashed = [described(s) for s in sets]
        yield pa.record_batch(
            [
                batch.column("id"),
                batch.column("mark"),
                pa.array([_signed(fingerprint(t)) for t in texts], pa.int64()),
                pa.array([_point(s) for s in sets], pa.int64()),
                _lists([k for k, _ in hashed]),
                pa.array([b for _, b in hashed], pa.binary()),
            ],
            names=["id", "mark", "fp", "point", "keys", "sketch"],
        )


def _needed_sets(needed):
    """``text`` becomes ``point``, ``shingles`` of the points whose bits are set."""

    def run(batches):
        shingles, seen = Shingles(), set()
        bits = needed.value
        for batch in slices(batches, 64):
            points, sets = [], []
            for text in batch.column("text").to_pylist():
                found = shingles.of(text)
                point = _point(found)
                at = point & ((1 << FILTER_BITS) - 1)
                if bits[at >> 3] >> (at & 7) & 1 and point not in seen:
                    if len(seen) < SEEN_POINTS:
                        seen.add(point)
                    points.append(point)
                    sets.append(found)
            yield pa.record_batch([pa.array(points, pa.int64()), _lists(sets)], names=["point", "shingles"])

    return run


def _sets(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``point``, ``shingles`` of the points in ``pairs``, and of a few more.

    What is not needed is dropped by a bit map of fixed size before it is
    shuffled; a full map would drop nothing and lose nothing.
    """
    at = F.col("point").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = (
        pairs.select(F.explode(F.array("a", "b")).alias("point"))
        .groupBy(F.shiftright(at, 3).alias("byte"))
        .agg(F.bit_or(F.expr("shiftleft(1, cast(point & 7 as int))")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    bits[words.column("byte").to_numpy()] = words.column("bits").to_numpy()
    needed = texts.sparkSession.sparkContext.broadcast(bits.tobytes())
    found = texts.select("text").mapInArrow(_needed_sets(needed), "point long, shingles array<long>")
    return store(found.groupBy("point").agg(F.first("shingles").alias("shingles")), "copies-sets")


def sets_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """``point``, ``shingles`` of all texts."""
    every = docs.sparkSession.sparkContext.broadcast(b"\xff" * (1 << (FILTER_BITS - 3)))
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    found = texts.mapInArrow(_needed_sets(every), "point long, shingles array<long>")
    return found.groupBy("point").agg(F.first("shingles").alias("shingles"))


def verified(pairs: DataFrame, sets: DataFrame, jaccard: float) -> DataFrame:
    """The ``pairs`` whose sets reach ``jaccard``."""
    both = (
        pairs.join(sets.select(F.col("point").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("point").alias("b"), F.col("shingles").alias("y")), "b")
    )
    shared, total = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    near = F.least(F.size("x"), F.size("y")) >= F.greatest(F.size("x"), F.size("y")) * jaccard
    return both.filter(near).filter(shared >= (total - shared) * jaccard).select("a", "b")


def _agreeing(batches):
    """The pairs ``a``, ``b`` whose sketches agree often enough."""
    size = BANDS * ROWS
    for batch in batches:
        x, y = (
            np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(-1, size) for n in ("x", "y")
        )
        near = pa.array((x == y).sum(axis=1) >= SKETCH * size)
        yield batch.select(["a", "b"]).filter(near)


def likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The ``pairs`` of points whose sketches (``point``, ``sketch``) agree often enough."""
    both = pairs.join(sketches.select(F.col("point").alias("a"), F.col("sketch").alias("x")), "a").join(
        sketches.select(F.col("point").alias("b"), F.col("sketch").alias("y")), "b"
    )
    return both.mapInArrow(_agreeing, "a long, b long")


def _agreeing_in_keys(batches):
    """``key`` and its ``members`` become their pairs ``a``, ``b`` of different roots whose sketches agree.

    A pair that shares several keys is looked for in the least of them.
    """
    for batch in slices(batches):
        members = batch.column("members")
        edges = members.offsets.to_numpy() - members.offsets[0].as_py()
        points, roots, keys, sketches = members.flatten().flatten()
        points, roots = points.to_numpy(), roots.to_numpy()
        keys = keys.flatten().to_numpy().reshape(-1, BANDS)
        sketches = np.frombuffer(b"".join(sketches.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
        a, b = [], []
        for key, start, end in zip(batch.column("key").to_pylist(), edges[:-1], edges[1:]):
            x, y = np.triu_indices(end - start, 1)
            x, y = x + start, y + start
            apart = roots[x] != roots[y]
            x, y = x[apart], y[apart]
            near = (sketches[x] == sketches[y]).sum(axis=1) >= SKETCH * BANDS * ROWS
            x, y = x[near], y[near]
            least = np.where(keys[x] == keys[y], keys[x], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
            x, y = x[least == key], y[least == key]
            a.append(np.minimum(points[x], points[y]))
            b.append(np.maximum(points[x], points[y]))
        yield pa.record_batch(
            [pa.array(np.concatenate(side) if side else [], pa.int64()) for side in (a, b)], names=["a", "b"]
        )


def _crossing(small: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs of different groups, by sketches, in keys of up to ``BUCKET`` texts (``key``, ``point``, ``root``)."""
    members = small.join(points, "point").groupBy("key").agg(
        F.collect_list(F.struct("point", "root", "keys", "sketch")).alias("members")  # BUCKET at most
    )
    return members.mapInArrow(_agreeing_in_keys, "a long, b long")


def _links_to(jaccard: float):
    """Batch function of one block of queries and one of texts: a link from each query to each group."""

    def run(keys, queries, texts):
        a, b = [], []
        if queries.num_rows and texts.num_rows:
            points, groups = texts.column("point").to_numpy(), texts.column("root").to_numpy()
            lists = texts.column("shingles").combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            tokens, at = np.unique(lists.flatten().to_numpy(), return_inverse=True)
            owners = np.repeat(np.arange(len(points)), sizes)[np.argsort(at, kind="stable")]
            edges = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(tokens)))])
            rows = zip(*(queries.column(n).to_pylist() for n in ("point", "root")), queries.column("shingles"))
            for point, root, own in rows:
                own = own.values.to_numpy()
                found = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                found = found[tokens[found] == own]
                shared = np.bincount(
                    np.concatenate([owners[edges[f] : edges[f + 1]] for f in found] or [np.zeros(0, np.int64)]),
                    minlength=len(points),
                )
                near = (shared >= (len(own) + sizes - shared) * jaccard) & (groups != root)
                _, first = np.unique(groups[near], return_index=True)
                others = points[near][first].tolist()
                a += [min(point, o) for o in others]
                b += [max(point, o) for o in others]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _links_of_large_keys(rooted: DataFrame, sets: DataFrame, jaccard: float) -> DataFrame:
    """Links between groups of ``rooted`` (``key``, ``point``, ``root``, ``n`` of the key)."""
    groups = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = groups.groupBy("key").agg(F.max_by("root", F.struct("size", "root")).alias("most"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = (
        rooted.join(largest, "key")
        .join(sets, "point")
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("point"), F.col("blocks").cast("long")).cast("int"))
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["key", "i", "j", "point", "root", "shingles"]
    queries = rows.filter("root != most").withColumn("i", F.col("own")).withColumn("j", every).select(*columns)
    texts = rows.withColumn("j", F.col("own")).withColumn("i", every).select(*[F.col(c).alias(c) for c in columns])
    found = queries.groupBy("key", "i", "j").cogroup(texts.groupBy("key", "i", "j"))
    return found.applyInArrow(_links_to(jaccard), "a long, b long").distinct()


def _pair(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _simhash_links(found: DataFrame) -> DataFrame:
    """Pairs of points that connect the fingerprints within two bits."""
    both = store(found.select("fp", "point").distinct(), "copies-fingerprints")
    first = store(both.groupBy("fp").agg(F.min("point").alias("first")), "copies-firsts")
    equal = both.join(first, "fp").filter("first != point").select(*_pair("first", "point"))
    linked = (
        links(first.select("fp"))
        .join(first.select(F.col("fp").alias("a"), F.col("first").alias("p")), "a")
        .join(first.select(F.col("fp").alias("b"), F.col("first").alias("q")), "b")
        .filter("p != q")
        .select(*_pair("p", "q"))
    )
    return equal.union(linked)


def copies(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", jaccard: float = JACCARD
) -> DataFrame:
    """``id``, ``mark`` (the text's XXH64), ``point``, ``root`` of every row of ``docs``.

    Rows with one ``root`` are linked through texts whose shingle sets have at
    least that Jaccard or whose SimHashes differ in two bits or less. Null or empty texts are copies of each other.
    """
    texts = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("mark"),
        F.col(f"`{text}`").alias("text"),
    )
    found = store(
        texts.mapInArrow(
            _described, "id long, mark long, fp long, point long, keys array<long>, sketch binary"
        ),
        "copies-points",
    )
    points = found.groupBy("point").agg(F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    points = store(points.filter(F.size("keys") > 0), "copies-sketches")
    keyed = points.select("point", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = keyed.join(shared, "key").withColumn("turn", F.xxhash64("point", "key"))
    members = store(numbered(members, ["key", "turn", "point"], "copies-keys"), "copies-places")
    after = members.select((F.col("place") - 1).alias("place"), F.col("key").alias("k"), F.col("point").alias("next"))
    chained = members.join(after, "place").filter("key = k AND point != next").select(*_pair("point", "next"))
    chained = store(likely(chained.distinct(), points), "copies-pairs")
    sets = _sets(texts, members.select(F.col("point").alias("a"), F.col("point").alias("b")).distinct())
    near = store(verified(chained, sets, jaccard).union(_simhash_links(found)), "copies-links")
    roots = store(components(near), "copies-roots")
    rooted = members.select("key", "n", "point").join(roots, F.col("point") == F.col("node"), "left").select(
        "key", "n", "point", F.coalesce("root", "point").alias("root")
    )
    apart = rooted.groupBy("key").agg(F.min("root").alias("m"), F.max("root").alias("x")).filter("m != x")
    rooted = store(rooted.join(apart.select("key"), "key"), "copies-apart")
    crossed = _crossing(rooted.filter(F.col("n") <= BUCKET), points)
    more = verified(store(crossed, "copies-pairs"), sets, jaccard)
    most = _links_of_large_keys(rooted.filter(F.col("n") > BUCKET), sets, jaccard)
    roots = components(near.union(more).union(most))
    return found.select("id", "mark", "point").join(roots, F.col("point") == F.col("node"), "left").select(
        "id", "mark", "point", F.coalesce("root", "point").alias("root")
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: those with its smallest id.

    A row is known by its id and its text, so that a text of its own stays where
    an id is repeated. A row without id cannot be named by a group and stays.
    All columns are returned as they are.
    """
    groups = copies(docs, id_column, text).filter("id IS NOT NULL")
    kept = groups.groupBy("root").agg(F.min(F.struct("id", "mark")).alias("kept")).select(
        F.col("kept.id").alias("__kept"), F.col("kept.mark").alias("__text")
    )
    rows = (
        packed(docs)
        .withColumn("__id", F.col(f"row.`{id_column}`").cast("long"))
        .withColumn("__mark", F.xxhash64(F.col(f"row.`{text}`")))
    )
    chosen = rows.join(
        kept, (F.col("__id") == F.col("__kept")) & (F.col("__mark") == F.col("__text")), "left_semi"
    ).dropDuplicates(["__id", "__mark"])
    return chosen.union(rows.filter("__id IS NULL")).select("row.*")
