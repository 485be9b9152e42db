"""Byte-level BPE over overlapping chunks, and decoding.

A long text is cut into chunks, each with some of the text after it. All chunks
are split into pre-tokens at once. Splitting goes on from a boundary in the same
way whatever came before, so where a boundary of one chunk's split is also one
of the next chunk's, the two agree from there on: that is where they are
stitched. A chunk's piece runs from its own stitch to the next one's, and pieces
are encoded separately. A stitch has no white space before it, so that a piece
splits by itself as it does inside the text. A text in which some overlap has no
such place (a very long run of one kind) is encoded whole.

Texts of one chunk need no stitching and are encoded where they are read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, store, table
from .registry import query

RANKS = "byte_bpe_multi_50k.tiktoken"
CHUNK = 32_768
"""Characters of a chunk; longer texts are cut."""
OVERLAP = 512
"""Characters of the following chunk that a chunk sees."""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def boundaries(text: str, pattern) -> list[int]:
    """Starts of the pre-tokens of ``text`` that have no white space before them."""
    starts = (m.start() for m in pattern.finditer(text))
    return [s for s in starts if s and not text[s - 1].isspace()]


def _list_array(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _encoded(ranks, pattern: str):
    """A batch function that adds ``ids`` of its column ``text`` in the text's place."""

    def run(batches):
        bpe = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        for batch in slices(batches):
            ids = [
                bpe.encode_to_numpy(t, disallowed_special=()) if t else np.zeros(0, np.int32)
                for t in batch.column("text").to_pylist()
            ]
            rest = [n for n in batch.schema.names if n != "text"]
            yield pa.record_batch(
                [*[batch.column(n) for n in rest], _list_array(ids)], names=[*rest, "ids"]
            )

    return run


def _chunks(size: int, overlap: int):
    def run(batches):
        part, row = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            for number, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                # The last chunk keeps what would be within its overlap.
                starts = range(0, max(1, len(text) - overlap), size)
                yield pa.record_batch(
                    {
                        "id": pa.array([number] * len(starts), pa.int64()),
                        "row": pa.array([(part << 33) + row] * len(starts), pa.int64()),
                        "no": pa.array(range(len(starts)), pa.int32()),
                        "text": pa.array([text[s : s + size + overlap] for s in starts], pa.string()),
                    }
                )
                row += 1

    return run


def _scanned(size: int, overlap: int, pattern: str):
    """``head``: boundaries in a chunk's first ``overlap`` characters, ``tail``: in those it sees ahead."""

    def run(batches):
        compiled = regex.compile(pattern)
        for batch in slices(batches):
            heads, tails = [], []
            for text in batch.column("text").to_pylist():
                found = np.array(boundaries(text, compiled), np.int32)
                # What ends with the text that is seen may go on beyond it: the last two
                # starts are left out of the tail.
                heads.append(found[found < overlap])
                tails.append(found[:-2][found[:-2] >= size] - size)
            yield pa.record_batch(
                [batch.column("row"), batch.column("no"), _list_array(heads), _list_array(tails)],
                names=["row", "no", "head", "tail"],
            )

    return run


def _pieces(batches):
    """Each chunk's text from its own stitch (``begin``) to the next chunk's (``finish``, null: the end)."""
    for batch in slices(batches):
        texts = [
            t[b:f]
            for t, b, f in zip(*(batch.column(n).to_pylist() for n in ("text", "begin", "finish")))
        ]
        rest = [n for n in batch.schema.names if n not in ("text", "begin", "finish")]
        yield pa.record_batch(
            [*[batch.column(n) for n in rest], pa.array(texts, pa.string())], names=[*rest, "text"]
        )


def _encoded_pieces(encoded):
    """Cuts and encodes in one Python worker; two steps of a plan would take two for every task."""

    def run(batches):
        yield from encoded(_pieces(batches))

    return run


def encode(
    docs: DataFrame,
    ranks_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    id_column: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``id``, ``ids`` (array of int) of every row's whole text, without special tokens.

    The same ids as encoding the text in one go. Null and empty texts have no
    ids; repeated rows stay; a null id stays null; other columns are not read.
    The result is a written table, so that a Python step that reads it, as
    ``decode`` does, has no second worker beside its own in every task.
    """
    if not 8 <= overlap <= chunk:
        raise ValueError("overlap must be from 8 to the chunk's length")
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path or public_tokenizers.path(RANKS)))
    encoded = _encoded(ranks, pattern)
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    length = F.char_length("text")
    short = rows.filter(length <= chunk).mapInArrow(encoded, "id long, ids array<int>")
    long = rows.filter(length > chunk).mapInArrow(
        _chunks(chunk, overlap), "id long, row long, no int, text string"
    )
    # Written, so that a row's number stays what it is; spread, as one task may have cut many.
    cut = store(long.repartition("row", "no"), "bpe-chunks")
    scanned = store(
        cut.mapInArrow(
            _scanned(chunk, overlap, pattern), "row long, no int, head array<int>, tail array<int>"
        ),
        "bpe-boundaries",
    )
    before = scanned.select("row", (F.col("no") + 1).alias("no"), "tail")
    stitches = store(
        scanned.drop("tail").join(before, ["row", "no"]).select(
            "row", "no", F.array_min(F.array_intersect("head", "tail")).alias("at")
        ),
        "bpe-stitches",
    )
    unstitched = stitches.filter("at IS NULL").select("row").distinct()
    begin = stitches.select("row", "no", F.col("at").alias("begin"))
    finish = stitches.select("row", (F.col("no") - 1).alias("no"), (F.col("at") + chunk).alias("finish"))
    pieces = (
        cut.join(unstitched, "row", "left_anti")
        .join(begin, ["row", "no"], "left")
        .join(finish, ["row", "no"], "left")
        .select("id", "row", "no", "text", F.coalesce("begin", F.lit(0)).alias("begin"), "finish")
        .mapInArrow(_encoded_pieces(encoded), "id long, row long, no int, ids array<int>")
    )

    def own(part, i):
        part = part["text"]
        return F.when(i == F.size("parts") - 1, part).otherwise(F.substring(part, F.lit(1), F.lit(chunk)))

    whole = (
        cut.join(unstitched, "row", "left_semi")
        .groupBy("id", "row")
        .agg(F.sort_array(F.collect_list(F.struct("no", "text"))).alias("parts"))  # one text
        .select(
            "id",
            "row",
            F.lit(0).alias("no"),
            F.array_join(F.transform("parts", own), "").alias("text"),
        )
    )
    wholes = whole.mapInArrow(encoded, "id long, row long, no int, ids array<int>")
    joined = pieces.union(wholes).groupBy("id", "row").agg(
        F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("parts")  # one text
    )
    return store(short.union(joined.select("id", F.flatten(F.col("parts.ids")).alias("ids"))), "bpe-ids")


def decode(encoded: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """``encoded`` with ``data``: the bytes of its tokens, one after another."""
    ranks = read_ranks(ranks_path or public_tokenizers.path(RANKS))
    held = encoded.sparkSession.sparkContext.broadcast({v: k for k, v in ranks.items()})

    def run(batches):
        token = held.value.__getitem__
        for batch in slices(batches):
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))
            data, start = [], 0
            for end in ends:
                data.append(b"".join(map(token, flat[start:end].tolist())))
                start = end
            yield batch.append_column("data", pa.array(data, pa.binary()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, data binary")


def digests(decoded: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of ``decode``'s result."""
    return decoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


@query("op7_byte_bpe")
def op7_byte_bpe(spark, sf_dir):
    return digests(decode(encode(table(spark, sf_dir, "documents"))))
