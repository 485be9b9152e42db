"""Web captures as WARC files, written, read back and assembled.

``write_captures`` writes one transaction per page: a request, a response (or a
revisit of an earlier equal payload) and a metadata record, each compressed on its
own; request and metadata name the response by ``WARC-Concurrent-To``.
``read_records`` reads WARC files whose records are compressed one by one, ``captures``
joins the records of each transaction into one nested row.

A record id is a digest of what the record belongs to, so that a repeated task
writes the same ids. A file is written under a name of its own and then moved.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableloom.functions.sizing import partitions_for
from tableloom.functions.storage import new_folder

from .common import slices, store, table
from .registry import query

VERSION = "WARC/1.1"
REVISIT_BYTES = 1000
"""Least payload that is written once and then referred to."""
DATE = "2024-01-01T00:00:00Z"
BLOCK = 1 << 20
"""Compressed bytes read at a time."""

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_RESPONSE = "application/http; msgtype=response"
HTTP_REQUEST = "application/http; msgtype=request"
FIELDS = "application/warc-fields"
END = b"\r\n\r\n"


def record_id(kind: str, page: int | None, digest: str, turn: int) -> str:
    """Id of a page's record; ``turn`` tells rows apart that repeat page and payload."""
    own = hashlib.sha256(f"{kind} {page} {digest} {turn}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=own[:16], version=5)}>"


def _line(value: str) -> str:
    """A header's value, its control characters escaped."""
    return re.sub(r"[\x00-\x1F\x7F%]", lambda m: f"%{ord(m[0]):02X}", value)


def _plain(value: str) -> str:
    return re.sub(r"%([01][0-9A-F]|7F|25)", lambda m: chr(int(m[1], 16)), value)


def _fields(pairs) -> bytes:
    return "".join(f"{name}: {value}\r\n" for name, value in pairs if value is not None).encode()


def record(kind: str, identity: str, date: str, block: bytes, **headers: str | None) -> bytes:
    """A record, compressed as a member of its own."""
    named = [(name.replace("_", "-"), value) for name, value in headers.items()]
    head = _fields(
        [("WARC-Type", kind), ("WARC-Record-ID", identity), ("WARC-Date", date), *named, ("Content-Length", len(block))]
    )
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    parts = (f"{VERSION}\r\n".encode(), head, b"\r\n", block, END)
    return b"".join([*map(packer.compress, parts), packer.flush()])


def transaction(page: int | None, url: str | None, payload: bytes, digest: str, turn: int, target, date: str):
    """The records of one page; ``target`` is the page it revisits, if any."""
    identity = record_id("response", page, digest, turn)
    address = None if url is None else _line(url)
    sha1 = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = _fields([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    head = b"HTTP/1.1 200 OK\r\n" + head + b"\r\n"
    common = {"WARC_Target_URI": address, "WARC_Payload_Digest": sha1, "Content_Type": HTTP_RESPONSE}
    if target is None:
        yield record("response", identity, date, head + payload, **common)
    else:
        refers = record_id("response", target, digest, 0)
        yield record("revisit", identity, date, head, WARC_Profile=PROFILE, WARC_Refers_To=refers, **common)
    try:
        parts = urlsplit(url or "")
        host, path = parts.netloc, parts.path + (f"?{parts.query}" if parts.query else "")
    except ValueError:  # no address in it
        host, path = "", ""
    request = f"GET {quote(path or '/', safe='/?=&%+,;:@!$()*~-._')} HTTP/1.1\r\nHost: {_line(host)}\r\n\r\n"
    yield record(
        "request", record_id("request", page, digest, turn), date, request.encode("utf-8", "replace"),
        WARC_Concurrent_To=identity, WARC_Target_URI=address, Content_Type=HTTP_REQUEST,
    )
    about = _fields([("page-id", page), ("turn", turn)])
    yield record(
        "metadata", record_id("metadata", page, digest, turn), date, about,
        WARC_Concurrent_To=identity, WARC_Target_URI=address, Content_Type=FIELDS,
    )


def _writer(folder: str, date: str):
    """Writes a partition as one file; gives one row about it."""

    def run(batches):
        context = TaskContext.get()
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        name = f"part-{context.partitionId():08d}.warc.gz"
        own = f"{root}/{name}.attempt-{context.taskAttemptId()}"
        size = captures = 0
        with system.open_output_stream(own, compression=None) as file:
            about = record_id("warcinfo", context.partitionId(), "", 0)
            start = record("warcinfo", about, date, _fields([("format", "WARC File Format 1.1")]), Content_Type=FIELDS)
            file.write(start)
            size += len(start)
            for batch in slices(batches, 64):
                for row in batch.to_pylist():
                    for data in transaction(**row, date=date):
                        file.write(data)
                        size += len(data)
                    captures += 1
        if captures:
            system.move(own, f"{root}/{name}")
        else:
            system.delete_file(own)
        yield pa.record_batch(
            {
                "file": pa.array([f"{folder}/{name}"] if captures else [], pa.string()),
                "captures": pa.array([captures] if captures else [], pa.int64()),
                "bytes": pa.array([size] if captures else [], pa.int64()),
            }
        )

    return run


def write_captures(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = REVISIT_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write a transaction per row of ``pages``; one row (``file``, ``captures``, ``bytes``) per file.

    Of rows with equal payloads of at least ``least`` bytes, that of the largest
    id is a response and those of smaller ids (a null id is the smallest) are
    revisits of it; rows that repeat the largest id are responses too. A null
    payload is an empty one, a null address is left out. An empty table writes no
    file. No other column is read.
    """
    spark = pages.sparkSession
    system, root = pyarrow.fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    rows = rows.withColumn("own", F.concat_ws(":", "page", "digest"))
    # Narrow rows find which pages are revisits; wide ones are then dealt once, page by page.
    large = rows.filter(F.octet_length("payload") >= least).select("page", "digest", "own")
    shared = large.groupBy("digest").agg(F.max("page").alias("target"), F.count(F.lit(1)).alias("n"))
    again = (
        large.join(shared.filter("n > 1 AND target IS NOT NULL").drop("n"), "digest")
        .filter("page IS NULL OR page < target")
        .select("own", "target")
        .distinct()
    )
    again = store(again, "warc-revisits")
    same = Window.partitionBy("own").orderBy("url")
    spread = rows.repartition(partitions_for(pages), "own").withColumn("turn", F.row_number().over(same) - 1)
    known = spread.join(again, "own", "left").drop("own")
    return store(known.mapInArrow(_writer(folder, date), "file string, captures long, bytes long"), "warc-files")


RECORD = (
    "file string, type string, record_id string, concurrent_to array<string>, refers_to string, uri string, "
    "date string, content_type string, payload_digest string, http string, content binary"
)


def _members(file) -> Iterator[bytes]:
    """The decompressed members of an open file, one at a time."""
    data, unpacker, parts = b"", zlib.decompressobj(31), []
    while data or (data := file.read(BLOCK)):
        parts.append(unpacker.decompress(data))
        data = b""
        if unpacker.eof:
            yield b"".join(parts)
            data, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the file ends within a record")


def parsed(member: bytes) -> dict:
    """A record's headers and content, the HTTP header apart."""
    head, _, rest = member.partition(END)
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers: dict[str, list[str]] = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        headers.setdefault(name.strip().lower(), []).append(value.strip())
    one = {name: values[0] for name, values in headers.items()}
    content = rest[: int(one["content-length"])]
    if len(content) < int(one["content-length"]):
        raise ValueError(f"record {one.get('warc-record-id')} is cut off")
    http = None
    if one.get("content-type", "").startswith("application/http"):
        http, _, content = content.partition(END)
        http = http.decode("utf-8", "replace")
    digest = one.get("warc-payload-digest", "")
    if digest.startswith("sha1:"):
        digest = digest[5:]
        digest = digest.lower() if len(digest) == 40 else base64.b32decode(digest.upper()).hex()
    return {
        "type": one.get("warc-type"),
        "record_id": one.get("warc-record-id"),
        "concurrent_to": headers.get("warc-concurrent-to", []),
        "refers_to": one.get("warc-refers-to"),
        "uri": _plain(one["warc-target-uri"]) if "warc-target-uri" in one else None,
        "date": one.get("warc-date"),
        "content_type": one.get("content-type"),
        "payload_digest": digest or None,
        "http": http,
        "content": content,
    }


def _reader(bodies: bool):
    kinds = {"concurrent_to": pa.list_(pa.string()), "content": pa.binary()}
    schema = pa.schema([(p.split()[0], kinds.get(p.split()[0], pa.string())) for p in RECORD.split(", ")])

    def run(batches):
        for batch in batches:
            for path in batch.column("file").to_pylist():
                system, own = pyarrow.fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with system.open_input_stream(own, compression=None) as file:
                    for member in _members(file):
                        row = parsed(member) | {"file": path}
                        if not bodies and row["type"] == "response":
                            row["content"] = None
                        rows.append(row)
                        size += len(row["content"] or b"") + 256
                        if size > BLOCK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_records(files: DataFrame, bodies: bool = True) -> DataFrame:
    """The records of the WARC files named in ``file``, lengths verified.

    A cut-off file is an error. Without ``bodies`` the payloads of responses are null.
    """
    # A file, or a few, per task.
    spread = files.select("file").repartitionByRange(max(1, files.count()), "file")
    return spread.mapInArrow(_reader(bodies), RECORD)


def _number(text, name: str):
    """A whole number from a header or field line."""
    return F.regexp_extract(text, rf"(?im)^{name}:\x20*(-?\d+)\x20*\r?$", 1).try_cast("long")


def captures(files: DataFrame) -> DataFrame:
    """One nested row per response or revisit in the WARC files named in ``file``.

    ``capture_id``, ``uri``, ``date``, ``page_id`` (of its metadata), ``record_type``,
    ``refers_to`` (the page whose response a revisit names, null if that is not
    among the records), ``payload_bytes`` and ``payload_digest`` of the full
    payload, ``response`` (status line with headers, payload; null for revisits),
    ``requests`` and ``metadata`` (lists of what names it as concurrent). A record
    may name several captures; one that names none of them is left out, as are
    kinds of records that belong to no transaction. A capture without request or
    metadata has empty lists.
    """
    about = store(read_records(files, bodies=False), "warc-records")
    named = about.filter("type IN ('request', 'metadata')").select(
        "type", "record_id", F.explode("concurrent_to").alias("capture_id"), "http",
        F.when(F.col("type") == "metadata", F.decode("content", "utf-8")).alias("fields"),
    )
    beside = named.groupBy("capture_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("type") == "request", F.struct("record_id", "http")))).alias("requests"),
        F.sort_array(F.collect_list(F.when(F.col("type") == "metadata", F.struct("record_id", "fields")))).alias("metadata"),
        F.min(_number(F.col("fields"), "page-id")).alias("page_id"),
    )
    # Revisits find their response by its id; many may name one, in narrow rows.
    pages = (
        named.filter("type = 'metadata'").groupBy(F.col("capture_id").alias("target"))
        .agg(F.min(_number(F.col("fields"), "page-id")).alias("target_page"))
        .join(about.filter("type = 'response'").select(F.col("record_id").alias("target")), "target", "left_semi")
    )
    referred = (
        about.filter("type = 'revisit'")
        .select(F.col("record_id").alias("capture_id"), F.col("refers_to").alias("target"))
        .join(pages, "target")
        .select("capture_id", "target_page")
    )
    response = F.col("type") == "response"
    main = read_records(files).filter("type IN ('response', 'revisit')").select(
        F.col("record_id").alias("capture_id"), "uri", "date", F.col("type").alias("record_type"), "http",
        F.when(response, F.col("content")).alias("payload"),
        F.when(response, F.octet_length("content").cast("long"))
        .otherwise(_number(F.col("http"), "content-length")).alias("payload_bytes"),
        F.when(response, F.sha1("content")).otherwise(F.col("payload_digest")).alias("payload_digest"),
    )
    joined = main.join(beside, "capture_id", "left").join(referred, "capture_id", "left")
    return joined.select(
        "capture_id", "uri", "date", "page_id", "record_type", F.col("target_page").alias("refers_to"),
        "payload_bytes", "payload_digest",
        F.when(F.col("record_type") == "response", F.struct("http", "payload")).alias("response"),
        F.coalesce("requests", F.array().cast("array<struct<record_id:string,http:string>>")).alias("requests"),
        F.coalesce("metadata", F.array().cast("array<struct<record_id:string,fields:string>>")).alias("metadata"),
    )


WARC_SQL = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
sized AS (
  SELECT page_id, octet_length(payload) AS bytes, sha1(payload) AS digest, sha256(payload) AS whole FROM payloads),
targets AS (
  SELECT whole, max(page_id) AS target FROM sized WHERE bytes >= 1000 GROUP BY whole)
SELECT s.page_id, s.bytes::BIGINT AS payload_bytes, s.digest AS payload_digest,
       CASE WHEN s.page_id < t.target THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN s.page_id < t.target THEN t.target END AS refers_to
FROM sized s LEFT JOIN targets t USING (whole)
"""


@query("op12_warc", WARC_SQL)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_captures(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    return captures(files).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
