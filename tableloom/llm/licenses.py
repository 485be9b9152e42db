"""License scans: MinHash bands over overlapping windows, then exact containment.

Texts and templates are words in lower case, taken five at a time. A window is a
number of successive shingles, one starting at every shingle; a band is the least
of a window's shingles under one hash.

Windows are as wide as the longest run that must be left of a template, and no
wider than ``WINDOW``: of T shingles at most m = T - 0.8 T may be missing, which
cut the others into m + 1 runs, and one of these has (T - m) / (m + 1) or more. Where
the text holds that run as the template does, the window is the same in both, and
equal windows have equal bands. For unequal windows a band agrees with the
probability of their Jaccard similarity; on that alone depend texts that hold a
template's shingles apart from one another and in no run.

The templates are a parameter, small enough to be part of the plan.
"""

from __future__ import annotations

from collections import Counter
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, table
from .registry import query

SHINGLE_WORDS = 5
WINDOW = 4
BANDS = 2
CONTAINMENT = 0.8

# Notices as their publishers word them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
}


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _starts(words: Column) -> Column:
    return F.sequence(F.lit(0), F.size(words) - SHINGLE_WORDS)


def _shingles(words: Column) -> Column:
    joined = F.transform(
        _starts(words), lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(SHINGLE_WORDS)])
    )
    return F.when(F.size(words) < SHINGLE_WORDS, F.array().cast("array<string>")).otherwise(joined)


def _shingle_hashes(words: Column) -> Column:
    def hashed(h: Column) -> Column:
        return F.transform(
            _starts(h), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE_WORDS)])
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < SHINGLE_WORDS, F.array().cast("array<long>")).otherwise(
        let(hashes, hashed)
    )


def _bands(shingles: Column, width: int, band: int) -> Column:
    """The band's value of the window of ``width`` shingles at every place.

    Windows that would pass the end are shorter; they can only add candidates.
    """
    def least(p: Column) -> Column:
        if width == 1:
            return p
        return F.transform(p, lambda x, i: F.least(x, *[F.get(p, i + k) for k in range(1, width)]))

    return let(F.transform(shingles, lambda x: F.xxhash64(x, F.lit(band))), least)


def width_for(shingles: list[str], window: int, containment: float) -> int:
    """Shingles in a row that a text with ``containment`` of them must have kept."""
    often = sorted(Counter(shingles).values(), reverse=True)
    missing = sum(often[: len(often) - ceil(containment * len(often) - 1e-9)])
    return max(1, min(window, -(-(len(shingles) - missing) // (missing + 1))))


def _template_rows(spark, templates: dict[str, str], window: int, bands: int, containment: float) -> list:
    """Per template: name, shingles, window width, and its windows' band values."""
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string")
    words = _words(F.col("text"))
    found = rows.select(
        "name",
        let(words, _shingles).alias("shingles"),
        let(words, _shingle_hashes).alias("hashes"),
    ).filter(F.size("shingles") > 0)
    widths: dict[int, list[str]] = {}
    for r in found.select("name", "shingles").collect():
        widths.setdefault(width_for(r["shingles"], window, containment), []).append(r["name"])
    result = []
    for width, names in sorted(widths.items()):
        whole = F.size("hashes") - width + 1
        keys = [
            F.slice(_bands(F.col("hashes"), width, band), 1, whole).alias(f"b{band}")
            for band in range(bands)
        ]
        for r in found.filter(F.col("name").isin(names)).select("name", "shingles", *keys).collect():
            result.append((r["name"], list(r["shingles"]), width, [list(r[f"b{b}"]) for b in range(bands)]))
    return sorted(result)


def licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    bands: int = BANDS,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per text and template that the text contains.

    ``id``, ``license``, ``containment`` (share of the template's different
    shingles that are in the text), ``first_word`` (place of the first of them).
    Null and empty texts contain none; templates of fewer than five words are an
    error; repeated rows give repeated results; other columns are not read.
    """
    known = TEMPLATES if templates is None else templates
    held = _template_rows(docs.sparkSession, known, window, bands, containment)
    if len(held) < len(known):
        raise ValueError(f"templates need at least {SHINGLE_WORDS} words")
    schema = "id long, license string, containment double, first_word long"
    if not held:
        return docs.sparkSession.createDataFrame([], schema)
    widths = sorted({width for _, _, width, _ in held})

    def keys_of(width: int, band: int) -> list[int]:
        return sorted({k for _, _, w, bs in held if w == width for k in bs[band]})

    def retrieved(shingles: Column) -> Column:
        """Names of the templates that share a band with some window."""
        found = []
        for width in widths:
            for band in range(bands):
                hits = F.filter(_bands(shingles, width, band), lambda k: k.isin(keys_of(width, band)))
                by_key: dict[int, list[str]] = {}
                for name, _, w, bs in held:
                    if w == width:
                        for k in set(bs[band]):
                            by_key.setdefault(k, []).append(name)

                def names(k: Column) -> Column:
                    chosen = F.array().cast("array<string>")
                    for key, values in sorted(by_key.items()):
                        chosen = F.when(k == key, F.array(*map(F.lit, values))).otherwise(chosen)
                    return chosen

                found.append(F.flatten(F.transform(F.array_distinct(hits), names)))
        return F.array_distinct(F.concat(*found))

    texts = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, dict.fromkeys(shingles))).alias("shingles"))
            for name, shingles, _, _ in held
        ]
    )

    def verified(words: Column, names: Column) -> Column:
        def of(own: Column) -> Column:
            def judged(t: Column) -> Column:
                def row(common: Column) -> Column:
                    places = F.transform(common, lambda c: F.array_position(own, c) - 1)
                    return F.struct(
                        t["name"].alias("license"),
                        (F.size(common) / F.size(t["shingles"])).alias("containment"),
                        F.array_min(places).alias("first_word"),
                    )

                return let(F.array_intersect(t["shingles"], own), row)

            candidates = F.filter(texts, lambda t: F.array_contains(names, t["name"]))
            return F.filter(
                F.transform(candidates, judged), lambda m: m["containment"] >= containment
            )

        return let(_shingles(words), of)

    def matches(words: Column) -> Column:
        none = F.array().cast("array<struct<license:string,containment:double,first_word:long>>")
        return let(
            let(_shingle_hashes(words), retrieved),
            lambda n: F.when(F.size(n) == 0, none).otherwise(verified(words, n)),
        )

    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.explode(let(_words(F.col(f"`{text}`")), matches)).alias("m"),
    ).select("id", "m.license", "m.containment", "m.first_word")


def _sql() -> str:
    """The containments, found by comparing every text with every template."""
    listed = ", ".join(f"('{name}', '{text}')" for name, text in sorted(TEMPLATES.items()))
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
    shingles = f"[array_to_string(words[i:i + {SHINGLE_WORDS - 1}], ' ') for i in range(1, len(words) - {SHINGLE_WORDS - 2})]"
    return f"""
        WITH template AS (
            SELECT license, list_distinct({shingles}) AS wanted FROM (
                SELECT license, {words} AS words FROM (VALUES {listed}) AS t(license, text))),
        document AS (
            SELECT doc_id, {shingles} AS own FROM (SELECT doc_id, {words} AS words FROM documents)),
        common AS (
            SELECT doc_id, license, own, wanted, list_intersect(wanted, own) AS held
            FROM document, template WHERE list_has_any(own, wanted))
        SELECT doc_id, license, len(held)::DOUBLE / len(wanted) AS containment,
               (list_min([list_position(own, x) for x in held]) - 1)::BIGINT AS first_word
        FROM common WHERE len(held) >= {CONTAINMENT} * len(wanted)"""


@query("op2_license_scan", _sql())
def op2_license_scan(spark, sf_dir):
    return licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
