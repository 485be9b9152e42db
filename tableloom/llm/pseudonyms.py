"""PII: format-preserving pseudonyms by keyed Feistel networks.

Personal numbers, dates and e-mail names are found by patterns and validated.
Each is then split in two halves, and in every round one half is shifted by a
keyed digest of the other, within the half's own range. Every round can be
undone, so different values get different pseudonyms, a value gets the same one
in every document, and a pseudonym has its value's form: a card number still has
a right check digit, a date is still a day of the calendar.

All of it is Spark expressions over one row; a document without a match costs
one search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, packed, table
from .registry import query

ROUNDS = 8

_EDGE, _END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9][A-Za-z0-9.-]*\.[A-Za-z]{2,}",
    "date": _EDGE
    + r"(?:(?:19|20)\d\d-\d\d-\d\d|\d\d\.\d\d\.(?:19|20)\d\d|\d\d/\d\d/(?:19|20)\d\d)"
    + _END,
    "ip": r"(?<![\p{L}\p{N}_.])(?:\d{1,3}\.){3}\d{1,3}(?![\p{L}\p{N}_]|\.\d)",
    "ssn": _EDGE + r"\d{3}-\d\d-\d{4}" + _END,
    "phone": r"(?<![\p{L}\p{N}_+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}" + _END,
    "card": _EDGE + r"\d(?:[ -]?\d){12,18}" + _END,
}
"""In the order in which they are tried at a place."""
KINDS = tuple(PATTERNS)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

DAYS = (150, 487)
"""73,050 days from 1900-01-01 to 2100-01-01, as a product."""
_CLASSES = ((97, 26), (65, 26), (48, 10), (0xE0, 23), (0xC0, 23))
"""First code point and size: a-z, A-Z, 0-9, small and capital letters with accents."""


def _digest(key: str, kind: str, number: int, half: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|{number}|"), half.cast("string")), 256)


def _as_number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("decimal(20,0)").cast("long")


def feistel(left: Column, right: Column, sizes: tuple, key: str, kind: str, body) -> Column:
    """``body`` of the pair (left, right), permuted within 0..sizes[0]-1 and 0..sizes[1]-1.

    ``sizes`` are numbers or columns, all less than 10 ** 15.
    """
    def turned(half: Column, other: Column, size, number: int) -> Column:
        shift = _as_number(F.substring(_digest(key, kind, number, other), 1, 15))
        return F.pmod(half + F.pmod(shift, size), size)

    def go(l: Column, r: Column, number: int) -> Column:
        if number == ROUNDS:
            return body(l, r)
        if number % 2 == 0:
            return let(turned(l, r, sizes[0], number), lambda x: go(x, r, number + 1))
        return let(turned(r, l, sizes[1], number), lambda x: go(l, x, number + 1))

    return go(left.cast("long"), right.cast("long"), 0)


def _padded(number: Column, width) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _digits_permuted(digits: Column, key: str, kind: str) -> Column:
    """A string of 2 to 29 digits as another one of the same length."""
    def halves(d: Column) -> Column:
        size = F.char_length(d)
        half = F.floor(size / 2).cast("int")
        left, right = F.substring(d, F.lit(1), half), F.substring(d, half + 1, size)
        sizes = tuple(F.pow(F.lit(10.0), w).cast("long") for w in (half, size - half))
        return feistel(
            left, right, sizes, key, kind,
            lambda l, r: F.concat(_padded(l, half), _padded(r, size - half)),
        )

    return let(digits, halves)


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _put_back(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by ``digits``."""
    def filled(d: Column) -> Column:
        characters = F.filter(F.split(value, ""), lambda c: c != "")

        def put(c: Column, i: Column) -> Column:
            before = F.char_length(_only_digits(F.substring(value, F.lit(1), i)))
            return F.when(c.rlike("[0-9]"), F.substring(d, before + 1, F.lit(1))).otherwise(c)

        return F.array_join(F.transform(characters, put), "")

    return let(digits, filled)


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, each second one from the right but the last doubled."""
    numbers = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _card(value: Column, key: str) -> Column:
    def changed(d: Column) -> Column:
        body = _digits_permuted(F.substring(d, F.lit(1), F.char_length(d) - 1), key, "card")
        full = let(
            body, lambda b: F.concat(b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string"))
        )
        # One digit repeated passes the check but is no card.
        return F.when((luhn_sum(d) % 10 == 0) & ~d.rlike(r"^(\d)\1*$"), _put_back(value, full))

    return let(_only_digits(value), changed)


def _phone(value: Column, key: str) -> Column:
    """The last ten digits are permuted; a country code stays."""
    def changed(d: Column) -> Column:
        code = F.substring(d, F.lit(1), F.char_length(d) - 10)
        local = _digits_permuted(F.substring(d, F.char_length(d) - 9, F.lit(10)), key, "phone")
        return _put_back(value, F.concat(code, local))

    return let(_only_digits(value), changed)


def _ip(value: Column, key: str) -> Column:
    def changed(p: Column) -> Column:
        def octet(i: int) -> Column:
            return F.get(p, F.lit(i)).cast("int")

        valid = F.forall(p, lambda o: o.cast("int") <= 255)
        new = feistel(
            octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), (65536, 65536), key, "ip",
            lambda l, r: F.concat_ws(
                ".", *[x.cast("string") for h in (l, r) for x in (F.shiftright(h, 8), h.bitwiseAND(F.lit(255)))]
            ),
        )
        return F.when(valid, new)

    return let(F.split(value, r"\."), changed)


def _ssn(value: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (
        F.substring(value, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4))
    )
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)

    def written(l: Column, r: Column) -> Column:
        index = F.floor(l / 99).cast("int")
        new = index + F.when(index >= 665, 2).otherwise(1)
        return F.concat_ws("-", _padded(new, 3), _padded(l % 99 + 1, 2), _padded(r + 1, 4))

    return F.when(valid, feistel(place * 99 + group - 1, serial - 1, (898 * 99, 9999), key, "ssn", written))


def _date(value: Column, key: str) -> Column:
    """yyyy-mm-dd, dd.mm.yyyy or mm/dd/yyyy; a day keeps its pseudonym in every form."""
    form = (
        F.when(F.substring(value, 5, 1) == "-", "yyyy-MM-dd")
        .when(F.substring(value, 3, 1) == ".", "dd.MM.yyyy")
        .otherwise("MM/dd/yyyy")
    )

    def part(starts: tuple[int, int, int], length: int) -> Column:
        iso, german, american = starts
        return (
            F.when(form == "yyyy-MM-dd", F.substring(value, iso, length))
            .when(form == "dd.MM.yyyy", F.substring(value, german, length))
            .otherwise(F.substring(value, american, length))
            .cast("int")
        )

    year, month, day = part((1, 7, 7), 4), part((6, 4, 1), 2), part((9, 1, 4), 2)
    parsed = F.try_to_date(F.concat_ws("-", _padded(year, 4), _padded(month, 2), _padded(day, 2)), "yyyy-MM-dd")
    first = F.lit("1900-01-01").cast("date")

    def changed(number: Column) -> Column:
        left, right = F.floor(number / DAYS[1]), number % DAYS[1]

        def written(l: Column, r: Column) -> Column:
            new = F.date_add(first, (l * DAYS[1] + r).cast("int"))
            return (
                F.when(form == "yyyy-MM-dd", F.date_format(new, "yyyy-MM-dd"))
                .when(form == "dd.MM.yyyy", F.date_format(new, "dd.MM.yyyy"))
                .otherwise(F.date_format(new, "MM/dd/yyyy"))
            )

        return F.when(number.isNotNull(), feistel(left, right, DAYS, key, "date", written))

    return let(F.datediff(parsed, first), changed)


def _email(value: Column, key: str) -> Column:
    """Letters and digits before the @ are shifted within their class; the rest stays."""
    def shifted(half: Column, other: Column, number: int) -> Column:
        def new(stream: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                code = F.ascii(c)
                shift = _as_number(F.substring(stream, (i * 3) % 60 + 1, F.lit(4))) + i
                result = c
                for start, size in _CLASSES:
                    inside = (code >= start) & (code < start + size)
                    result = F.when(
                        inside, F.chr(F.pmod(code - start + shift, F.lit(size)) + start)
                    ).otherwise(result)
                return result

            return F.array_join(F.transform(F.filter(F.split(half, ""), lambda c: c != ""), one), "")

        return let(_digest(key, "email", number, other), new)

    def go(l: Column, r: Column, number: int) -> Column:
        if number == 4:
            return F.concat(l, r)
        if number % 2 == 0:
            return let(shifted(r, l, number), lambda x: go(l, x, number + 1))
        return let(shifted(l, r, number), lambda x: go(x, r, number + 1))

    def changed(parts: Column) -> Column:
        name = F.get(parts, F.lit(0))
        half = F.floor(F.char_length(name) / 2).cast("int")
        new = go(F.substring(name, F.lit(1), half), F.substring(name, half + 1, F.char_length(name)), 0)
        return F.concat(new, F.lit("@"), F.get(parts, F.lit(1)))

    return let(F.split(value, "@"), changed)


_CHANGES = {"email": _email, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonymised(text: Column, key: str) -> Column:
    """Struct of ``text`` with pseudonyms and ``found``, the kinds found, in order.

    What a pattern finds but validation refuses (a card with a wrong check digit,
    an address part over 255, a 31st of June) stays as it is. A null text stays null.
    """
    none = F.array().cast("array<string>")

    def replaced(match: Column) -> Column:
        kind, new = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name in reversed(KINDS):
            is_kind = match.rlike(f"^(?:{PATTERNS[name]})$")
            kind = F.when(is_kind, F.lit(name)).otherwise(kind)
            new = F.when(is_kind, _CHANGES[name](match, key)).otherwise(new)
        return F.struct(kind.alias("kind"), new.alias("new"))

    def rebuilt(b: Column) -> Column:
        def joined(changes: Column) -> Column:
            def part(m: Column, i: Column) -> Column:
                return F.concat(F.get(b["p"], i), F.coalesce(F.get(changes, i)["new"], m))

            last = F.element_at(b["p"], -1)
            return F.struct(
                F.concat(F.array_join(F.transform(b["m"], part), ""), last).alias("text"),
                F.transform(
                    F.filter(changes, lambda c: c["new"].isNotNull()), lambda c: c["kind"]
                ).alias("found"),
            )

        return let(F.transform(b["m"], replaced), joined)

    both = F.struct(
        F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("m"), F.split(text, ANY, -1).alias("p")
    )
    unchanged = F.struct(text.alias("text"), none.alias("found"))
    return F.when(F.coalesce(text.rlike(ANY), F.lit(False)), let(both, rebuilt)).otherwise(unchanged)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``found`` beside them.

    Whoever has the ``key`` can link values to pseudonyms; there is no default.

    The result's columns are ``row`` (all columns of ``docs``, the text replaced)
    and ``found``, so that no name can clash. Null and empty texts stay; repeated
    rows stay and change alike.
    """
    rows = packed(docs).withColumn("changed", pseudonymised(F.col(f"row.`{text}`"), key))
    fields = [
        (F.col("changed.text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns
    ]
    return rows.select(F.struct(*fields).alias("row"), F.col("changed.found").alias("found"))


QUERY_KEY = "key of the registered query"
"""Public, as its results are: other calls pass a secret."""


@query("op10_pii_pseudonyms")
def op10_pii_pseudonyms(spark, sf_dir):
    changed = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), QUERY_KEY)
    counts = [
        F.size(F.filter("found", lambda k: k == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return changed.select(F.col("row.doc_id").cast("long").alias("doc_id"), "row.text", *counts)
