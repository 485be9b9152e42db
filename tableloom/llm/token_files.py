"""Token ids as length-delimited binary records, with offset indexes.

A data file starts with ``MAGIC`` and one byte, the bytes of an id (2 or 4).
Each record after it is

    length       8 bytes, little-endian
    checksum     4 bytes: masked CRC-32 of the length's bytes
    ids          ``length`` bytes, little-endian
    checksum     4 bytes: masked CRC-32 of the ids' bytes

and its index file has one ``INDEX`` entry per record, so that a reader can go
to any record. Files are numbered; records go through the files in ascending
document id. A file is written under a name of its own and then moved, so that a
repeated or a lost attempt leaves nothing half written.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableloom.functions.sizing import partitions_for
from tableloom.functions.storage import new_folder

from .common import pieces, slices, store, table
from .registry import query

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
MAGIC = b"TLTOKEN1"
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("size", "<u8")])
CACHED_WORDS = 400_000
"""Words whose ids a task remembers; when there are more, it starts anew."""
CACHED_BYTES = 64
"""Longer words are not remembered."""
BATCH_WORDS = 1000
"""Words given to the library at a time: its results are large."""
GROUP_BYTES = 2 << 20
"""Text encoded, or ids read, at a time."""

_MARKS = b",.!?;:#$%&*|"


def masked_crc(data: bytes) -> int:
    """CRC-32, rotated and shifted, so that a checksum of checksums is no checksum."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload)))
    )


class WordEncoder:
    """Encodes texts word by word, as bytes of their ids.

    ``vocabulary``: a file in the format of the tokenizers library that is for
    lower case, splits text into letters, digits and marks, and whose tokens never
    hold white space. A text's ids are then its words' ids, and those of a word
    with marks behind it are the word's and the marks'.
    """

    def __init__(self, vocabulary: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(vocabulary)
        # Special strings are found here, in the text as it is; in lower-cased words they are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.kind = f"<u{width}"
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {
            b" " + t.content.encode(): np.array([i], self.kind).tobytes() for i, t in added.items() if t.special
        }
        names = sorted((re.escape(t.strip()) for t in self.special), key=len, reverse=True)
        self.cut = re.compile(b"(%b)" % b"|".join(names)).split if names else lambda data: [data]
        self.known = dict(self.special)
        # Small letters of the Latin alphabets as the byte-level vocabulary spells them.
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        letters = (chr(c) for c in range(0xDF, 0x180))
        self.spelling = {
            ord(c): spell(c)[0][0]
            for c in letters
            if c.isalpha() and c.lower() == c and unicodedata.is_normalized("NFC", c)
        }
        self.latin = re.compile("[a-z%s]+" % "".join(map(chr, self.spelling))).fullmatch

    def _encode(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each word with its ids, in any order."""
        model, others = self.tokenizer.model.tokenize, []
        for word in words:
            text = word.decode()
            if word.isalpha():  # ASCII letters: one piece, spelled as it is
                ids = model(text)
            elif self.latin(text):
                ids = model(text.translate(self.spelling))
            else:
                others.append((word, text))
                continue
            yield word, np.array([t.id for t in ids], self.kind).tobytes()
        for start in range(0, len(others), BATCH_WORDS):
            batch = others[start : start + BATCH_WORDS]
            found = self.tokenizer.encode_batch_fast([t for _, t in batch], add_special_tokens=False)
            for (word, _), encoding in zip(batch, found):
                yield word, np.array(encoding.ids, self.kind).tobytes()

    def _learn(self, words: set[bytes]) -> None:
        parts, atoms = {}, set()
        for word in words:
            base = word.rstrip(_MARKS)
            if len(base) < len(word) and base[-1:].isalpha():
                parts[word] = base, word[len(base) :]
                atoms.update(parts[word])
            else:
                atoms.add(word)
        self.known.update(self._encode(list(atoms.difference(self.known))))
        self.known.update((w, self.known[a] + self.known[b]) for w, (a, b) in parts.items())

    def texts(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order; a text alone, which may be long, in pieces."""
        if len(texts) == 1:
            parts = pieces((texts[0] or "").encode())
            yield b"".join(ids for p in parts for ids in self._texts([p]))
        else:
            yield from self._texts([(t or "").encode() for t in texts])

    def _words(self, data: bytes) -> list[bytes]:
        """Lower-case words; a special string is an entry of its own, behind a space."""
        parts = self.cut(data)
        if len(parts) == 1:
            return data.lower().split()
        return [w for i, p in enumerate(parts) for w in ([b" " + p] if i % 2 else p.lower().split())]

    def _texts(self, texts: list[bytes]) -> Iterator[bytes]:
        split = [self._words(t) for t in texts]
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known = dict(self.special)
            new = set().union(*split).difference(self.known)
        self._learn(new)
        for words in split:
            yield b"".join(map(self.known.__getitem__, words))
        for word in [w for w in new if len(w) > CACHED_BYTES]:
            del self.known[word]


def _writer(folder: str, vocabulary, width: int, end_id: int):
    """Writes a partition as one data file and its index; gives one row about them."""

    def groups(batches):
        rows, size = [], 0
        for row in rows_of(batches):
            length = len(row[1] or "")
            if rows and size + length > GROUP_BYTES:
                yield rows
                rows, size = [], 0
            rows.append(row)
            size += length
        yield rows

    def rows_of(batches):
        for batch in slices(batches):
            yield from zip(batch.column("id").to_pylist(), batch.column("text").to_pylist())

    def run(batches):
        context = TaskContext.get()
        encoder = WordEncoder(vocabulary.value, width)
        end = end_id.to_bytes(width, "little")
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        name = f"{root}/part-{context.partitionId():08d}"
        own = f"{name}.attempt-{context.taskAttemptId()}"
        entries, offset, tokens = bytearray(), len(MAGIC) + 1, 0
        with system.open_output_stream(f"{own}.tokens") as data:
            data.write(MAGIC + bytes([width]))
            for rows in groups(batches):
                for (number, _), ids in zip(rows, encoder.texts([t for _, t in rows])):
                    record = frame(ids + end)
                    data.write(record)
                    entries += struct.pack("<qBQQ", number or 0, number is not None, offset, len(ids) + width)
                    offset += len(record)
                    tokens += len(ids) // width + 1
        with system.open_output_stream(f"{own}.index") as index:
            index.write(bytes(entries))
        for kind in ("tokens", "index"):
            system.move(f"{own}.{kind}", f"{name}.{kind}")
        yield pa.record_batch(
            {
                "part": pa.array([context.partitionId()], pa.int64()),
                "file": pa.array([f"{folder}/part-{context.partitionId():08d}"]),
                "records": pa.array([len(entries) // INDEX.itemsize], pa.int64()),
                "tokens": pa.array([tokens], pa.int64()),
            }
        )

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    vocabulary_path: str | None = None,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text: str = "text",
    files: int | None = None,
) -> DataFrame:
    """Encode every row's whole text, write the files, return one row per file.

    ``part`` (files in ascending document id), ``file`` (path without ending),
    ``records``, ``tokens``, ``first`` (tokens in the files before it). Every
    text, null and empty ones too, gets a record that ends with ``end_id``. Rows
    without id come first; rows of equal ids follow one another, in the order of
    their texts' hashes. ``files``: how many; by default the session's number of
    shuffle partitions, more for a large table.
    """
    spark = docs.sparkSession
    with open(vocabulary_path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        content = file.read()
    from tokenizers import Tokenizer

    size = Tokenizer.from_str(content).get_vocab_size()
    vocabulary = spark.sparkContext.broadcast(content)
    system, root = pyarrow.fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    files = files or partitions_for(docs)
    written = store(
        rows.repartitionByRange(files, F.col("id").asc_nulls_first())
        .sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))
        .mapInArrow(
            _writer(folder, vocabulary, 2 if max(size, end_id + 1) <= 1 << 16 else 4, end_id),
            "part long, file string, records long, tokens long",
        ),
        "token-manifest",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return written.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_records(data, index: np.ndarray) -> Iterator[bytes]:
    """The ids of the records at the index's places, checked; ``data`` is an open file."""
    data.seek(0)
    start = data.read(len(MAGIC) + 1)
    if start[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    width = start[-1]
    for entry in index:
        data.seek(int(entry["offset"]))
        head = data.read(12)
        length, check = struct.unpack("<QI", head)
        if check != masked_crc(head[:8]) or length != entry["size"]:
            raise ValueError(f"damaged length at byte {entry['offset']}")
        payload = data.read(length)
        if struct.unpack("<I", data.read(4))[0] != masked_crc(payload):
            raise ValueError(f"damaged ids at byte {entry['offset']}")
        yield np.frombuffer(payload, f"<u{width}").astype("<u4").tobytes()


def read_index(system, path: str) -> np.ndarray:
    with system.open_input_stream(f"{path}.index") as file:
        return np.frombuffer(file.read(), INDEX)


def _reader(shuffle_seed: int | None):
    def run(batches):
        for batch in batches:
            for file, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist()):
                system, path = pyarrow.fs.FileSystem.from_uri(file)
                index = read_index(system, path)
                order = np.arange(len(index))
                if shuffle_seed is not None:
                    np.random.default_rng([shuffle_seed, zlib.crc32(path.encode())]).shuffle(order)
                with system.open_input_file(f"{path}.tokens") as data:
                    width = data.read(len(MAGIC) + 1)[-1]
                    starts = first + np.cumsum(index["size"]) // width - index["size"] // width
                    rows, size = [], 0
                    for at, ids in zip(order, read_records(data, index[order])):
                        rows.append((at, ids))
                        size += len(ids)
                        if size >= GROUP_BYTES:
                            yield _rows(index, starts, rows)
                            rows, size = [], 0
                    yield _rows(index, starts, rows)

    return run


def _rows(index: np.ndarray, starts: np.ndarray, rows: list) -> pa.RecordBatch:
    at = np.array([i for i, _ in rows], np.int64)
    ids = index["doc_id"][at]
    return pa.record_batch(
        {
            "id": pa.array(ids, pa.int64(), mask=index["has_id"][at] == 0),
            "start": pa.array(starts[at].astype(np.int64)),
            "n_tokens": pa.array([len(d) // 4 for _, d in rows], pa.int64()),
            "data": pa.array([d for _, d in rows], pa.binary()),
        }
    )


def read_tokens(files: DataFrame, shuffle_seed: int | None = None) -> DataFrame:
    """The records of ``write_tokens``'s files, lengths and checksums verified.

    ``id``, ``start`` (ids of all records before it), ``n_tokens``, ``data`` (the
    ids, four bytes each, little-endian). With a seed, a file's records come in
    an order shuffled by its index. A damaged file is an error.
    """
    # A task reads one file, whatever the size of the list's own file.
    spread = files.repartitionByRange(max(1, files.count()), "part")
    return spread.mapInArrow(
        _reader(shuffle_seed), "id long, start long, n_tokens long, data binary"
    )


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_tokens(table(spark, sf_dir, "documents"), new_folder(spark, "token-files"))
    return read_tokens(files).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("data").alias("ids_crc32")
    )
