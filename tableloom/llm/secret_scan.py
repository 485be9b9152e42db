"""Secret scans: fixed patterns, and windows of high entropy in candidate strings.

Everything is a Spark expression over one row. Positions come from the pieces
between the matches: splitting and extracting walk through the same matches, so
a match starts where the running length of pieces and matches before it ends.

Entropy: a window of ``WINDOW`` characters slides over each candidate, a run of
one character class. The counts of its characters change by one in and one out,
and with them the sum of c * log2(c), kept in whole millionths so that no
rounding adds up. Candidates on the allow list are passed over.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, packed, table
from .registry import query

ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
"""Runs long enough: the same as all runs with the short ones dropped."""
ASSIGN_LENGTH = 12

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
WINDOW = 20
CLASSES = {
    "entropy_hex": (r"[0-9a-fA-F]{20,}", "0123456789abcdef", 3.0),
    "entropy_base64": (
        r"[A-Za-z0-9+/_-]{20,}",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
        3.9,
    ),
}
"""Kind: candidate strings, alphabet, least entropy in bits of some window."""
ALLOWED = (
    r"^[0-9]+$",
    r"^[A-Z]?[a-z]+$",
    r"^[A-Z]+$",
    r"(?i)^(?=.{20,64}$).*(?:example|sample|placeholder|changeme|your[_-])",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(?=.{20,64}$).*(.)\1{7}",
)
"""Candidates that match one of these are no secrets: numbers, words, stand-ins, UUIDs, filler.
Stand-ins and filler speak for a candidate of up to 64 characters only; in a longer one the
windows beside them are judged like any others."""
PIECE = 4096
"""Characters of a candidate that are taken apart at a time; pieces overlap by a window."""
MASK = "[SECRET]"

_SCALE = 1_000_000
_BLOCK = 64
_SPAN = "array<struct<start:int,rank:int,end:int>>"


def running(values: Column, join, zero: Column) -> Column:
    """Running ``join`` (a sum, a maximum) of an int array.

    In blocks, then over the blocks' last values: an array that grows by one
    element is copied each time, which blocks keep short.
    """
    def grown(sofar: Column, x: Column) -> Column:
        last = F.coalesce(F.get(sofar, F.size(sofar) - 1), zero)
        return F.concat(sofar, F.array(join(last, x)))

    nothing = F.array().cast("array<int>")

    def blocks(a: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(a) - 1, F.lit(_BLOCK)),
            lambda p: F.aggregate(F.slice(a, p + 1, F.lit(_BLOCK)), nothing, grown),
        )

    def combined(cut: Column) -> Column:
        totals = F.aggregate(F.transform(cut, lambda b: F.element_at(b, -1)), nothing, grown)

        def shifted(sums: Column) -> Column:
            def moved(block: Column, i: Column) -> Column:
                before = F.coalesce(F.get(sums, i - 1), zero)
                return F.transform(block, lambda x: join(before, x))

            return F.flatten(F.transform(cut, moved))

        return let(totals, shifted)

    return let(values, lambda a: F.when(F.size(a) == 0, a).otherwise(let(blocks(a), combined)))


def _spans(text: Column, pattern: str, rank: int, keep) -> Column:
    """Spans of the pattern's matches; ``keep(text, spans)`` filters them."""
    def placed(matches: Column, pieces: Column) -> Column:
        lengths = F.transform(
            matches, lambda m, i: F.char_length(m) + F.char_length(F.get(pieces, i))
        )
        ends = running(lengths, lambda a, b: a + b, F.lit(0))
        return let(
            ends,
            lambda e: F.transform(
                matches,
                lambda m, i: F.struct(
                    (F.get(e, i) - F.char_length(m)).alias("start"),
                    F.lit(rank).alias("rank"),
                    F.get(e, i).alias("end"),
                ),
            ),
        )

    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.split(text, pattern, -1).alias("p"),
    )
    return let(both, lambda b: keep(b["m"], placed(b["m"], b["p"])))


def _where(spans: Column, passes) -> Column:
    """The spans whose place ``passes``."""
    return let(spans, lambda s: F.filter(s, lambda _, i: passes(i)))


def _entropy_reaches(candidate: Column, alphabet: str, least: float) -> Column:
    """Whether some window of the candidate has at least that entropy.

    With counts c summing to w, entropy is log2(w) - sum(c * log2(c)) / w.
    """
    terms = F.array(
        *[F.lit(round(c * math.log2(c) * _SCALE) if c else 0).cast("long") for c in range(WINDOW + 2)]
    )
    most = math.floor((math.log2(WINDOW) - least) * WINDOW * _SCALE)
    plain = F.lower(candidate) if alphabet.islower() else F.translate(candidate, "-_", "+/")

    def slide(codes: Column) -> Column:
        def move(a: Column, x: Column) -> Column:
            out = F.get(codes, a["at"] - WINDOW)  # null until the window is full
            entered = F.get(a["counts"], x)
            after = F.get(a["counts"], out) + F.when(out == x, 1).otherwise(0)
            total = (
                a["total"]
                + F.get(terms, entered + 1)
                - F.get(terms, entered)
                - F.coalesce(F.get(terms, after) - F.get(terms, after - 1), F.lit(0).cast("long"))
            )
            counts = F.transform(
                a["counts"],
                lambda v, k: v
                + F.when(k == x, 1).otherwise(0)
                - F.when(k == out, 1).otherwise(0),
            )
            return let(
                total,
                lambda t: F.struct(
                    (a["at"] + 1).alias("at"),
                    counts.alias("counts"),
                    t.alias("total"),
                    (a["found"] | ((a["at"] >= WINDOW - 1) & (t <= most))).alias("found"),
                ),
            )

        start = F.struct(
            F.lit(0).alias("at"),
            F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
            F.lit(0).cast("long").alias("total"),
            F.lit(False).alias("found"),
        )
        return F.aggregate(codes, start, move, lambda a: a["found"])

    def piece(text: Column, at: Column) -> Column:
        characters = F.filter(
            F.split(F.substring(text, at + 1, F.lit(PIECE + WINDOW - 1)), ""), lambda c: c != ""
        )
        codes = F.transform(characters, lambda c: F.instr(F.lit(alphabet), c) - 1)
        return let(codes, slide)

    return let(
        plain,
        lambda p: F.exists(
            F.sequence(F.lit(0), F.char_length(p) - 1, F.lit(PIECE)), lambda at: piece(p, at)
        ),
    )


def secret_spans(text: Column, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Array of (start, rank of its kind in ``KINDS``, end) in code points, in this order.

    Matches of the fixed patterns always stay. An entropy span is added where no
    earlier kind's span holds it. A null text has none.
    """
    none = F.array().cast(_SPAN)
    text = F.coalesce(text, F.lit(""))

    def found(t: Column) -> Column:
        def assigned(matches, spans):
            values = F.transform(
                matches, lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 1)) >= ASSIGN_LENGTH
            )
            return let(values, lambda v: _where(spans, lambda i: F.get(v, i)))

        def every(_, spans):
            return spans

        base = F.concat(
            F.when(t.rlike(ASSIGN[:-2] + "{%d,})" % ASSIGN_LENGTH), _spans(t, ASSIGN, 0, assigned)).otherwise(none),
            F.when(t.rlike(ACCESS), _spans(t, ACCESS, 1, every)).otherwise(none),
            F.when(t.rlike(HEX), _spans(t, HEX, 2, every)).otherwise(none),
        )

        def high(kind: str) -> Column:
            pattern, alphabet, least = CLASSES[kind]

            def keep(matches, spans):
                def secret(m: Column) -> Column:
                    known = F.lit(False)
                    for a in allowed:
                        known = known | m.rlike(a)
                    return F.when(known, False).otherwise(_entropy_reaches(m, alphabet, least))

                verdicts = F.transform(matches, secret)
                return let(verdicts, lambda v: _where(spans, lambda i: F.get(v, i)))

            spans = _spans(t, pattern, KINDS.index(kind), keep)
            return F.when(t.rlike(pattern), spans).otherwise(none)

        def add(spans: Column, more: Column) -> Column:
            def new(known: Column) -> Column:
                def held(s: Column) -> Column:
                    return F.exists(known, lambda k: (k["start"] <= s["start"]) & (s["end"] <= k["end"]))

                return F.concat(known, F.filter(more, lambda s: ~held(s)))

            return let(spans, new)

        return F.sort_array(add(add(base, high("entropy_hex")), high("entropy_base64")))

    return let(text, found)


def _named(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def _part_of(pieces: Column, size: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` of a text cut into pieces of ``size``."""
    def within(k: Column) -> Column:
        low = F.greatest(start - k * size, F.lit(0))
        return F.substring(F.get(pieces, k), low + 1, F.least(end - k * size, size) - low)

    numbers = F.sequence(F.floor(start / size).cast("int"), F.floor((end - 1) / size).cast("int"))
    return F.when(start >= end, F.lit("")).otherwise(F.array_join(F.transform(numbers, within), ""))


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with every span, or run of overlapping spans, replaced by ``mask``.

    Reaching a place in a text means walking to it, so the text is cut into about
    a thousand pieces first: many spans in a long text stay affordable.
    """
    def cut(s: Column, length: Column) -> Column:
        size = F.greatest(F.lit(PIECE), F.ceil(length / 1024).cast("int"))
        pieces = F.transform(
            F.sequence(F.lit(0), length - 1, size), lambda p: F.substring(text, p + 1, size)
        )
        ends = running(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b), F.lit(0))

        def joined(c: Column) -> Column:
            def part(x: Column, i: Column) -> Column:
                before = F.coalesce(F.get(c["ends"], i - 1), F.lit(0))
                clear = _part_of(c["pieces"], c["size"], before, x["start"])
                return F.when((i > 0) & (x["start"] < before), F.lit("")).otherwise(
                    F.concat(clear, F.lit(mask))
                )

            rest = _part_of(c["pieces"], c["size"], F.element_at(c["ends"], -1), length)
            return F.concat(F.array_join(F.transform(s, part), ""), rest)

        return let(F.struct(pieces.alias("pieces"), size.alias("size"), ends.alias("ends")), joined)

    return let(
        spans,
        lambda s: F.when(F.size(s) == 0, text).otherwise(
            let(F.char_length(text), lambda n: cut(s, n))
        ),
    )


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``spans`` (start, rank, end) of every row; see ``secret_spans``.

    Null and empty texts have no spans, repeated rows equal ones; no other column
    is read.
    """
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        secret_spans(F.col(f"`{text}`")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in ``text``, and ``length``, if there, counted again.

    Rows and columns stay; texts without secrets, null ones too, stay as they are.
    """
    rows = packed(docs).withColumn("spans", secret_spans(F.col(f"row.`{text}`")))
    rows = rows.withColumn(
        "clean",
        F.when(F.size("spans") > 0, masked(F.col(f"row.`{text}`"), F.col("spans"))).otherwise(
            F.col(f"row.`{text}`")
        ),
    )
    found = F.size("spans") > 0
    columns = []
    for field in docs.schema.fields:
        column = F.col(f"row.`{field.name}`")
        if field.name == text:
            column = F.col("clean")
        elif field.name == length:
            column = F.when(found, F.char_length("clean")).otherwise(column).cast(field.dataType)
        columns.append(column.alias(field.name))
    return rows.select(*columns)


@query("op1_secret_scan")
def op1_secret_scan(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < 3)
    counts = [
        F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")
        for rank, kind in enumerate(KINDS)
    ]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts[:3],
        F.sha2(_named(base), 256).alias("base_sha256"),
        _named(F.col("spans")).alias("spans"),
        *counts[3:],
    )
