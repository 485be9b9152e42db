"""Source divergence, WARC captures and importance resampling against plain versions."""

import base64
import gzip
import hashlib
import math
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from tableloom.functions.storage import new_folder
from tableloom.llm import QUERIES, divergence, importance, warc
from tableloom.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_divergence(rows, min_docs=3, top=200):
    texts = [((g or ""), (s or ""), re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low(t))) for g, s, t in rows]
    groups, out = {(g, s) for g, s, _ in texts}, []
    for lang in {g for g, _ in groups}:
        docs = Counter(w for g, _, ws in texts if g == lang for w in set(ws))
        kept = [w for w, n in docs.items() if n >= min_docs]
        sources = sorted(s for g, s in groups if g == lang)
        counts = {s: Counter(w for g, x, ws in texts if (g, x) == (lang, s) for w in ws) for s in sources}
        whole = sum(counts.values(), Counter())

        def shares(counter):
            total = sum(counter[w] for w in kept)
            return {w: 1 + 10**9 * (counter[w] + 1) // (total + len(kept)) for w in kept}

        own, base = {s: shares(counts[s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [
                (sum((own[s][w] - own[o][w]) ** 2 // own[o][w] for w in kept), o) for o in sources if o != s
            ]
            words = [
                ((own[s][w] - base[w]) ** 2 // base[w], w) for w in kept if counts[s][w] and own[s][w] > base[w]
            ]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", words, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k) for k, (v, i) in enumerate(found[:most], 1)]
    return sorted(out)


AUDIT_ROWS = [
    ("en", "a", "One two TWO three éa éa"), ("en", "b", "one two é three"), ("en", "c", "one; one two: three3three"),
    ("en", None, None), (None, "a", "one"), ("de", "x", ""), ("de", "y", "\x00eins\x7fzwei"), ("en", "a", "One two TWO"),
    ("en", "a", "One two TWO"), ("en", "long", "two " * 60_000 + "w" * 70_000), ("", "a", "one"), ("", "z", "one 中文 中文"),
    ("en", "b", "中文 one"), ("en", "c", "中文"), ("en", "d", "x中文 中文"),
]


@pytest.mark.parametrize("small", [False, True])
def test_divergence(spark, small, monkeypatch):
    if small:  # several blocks of shards and of sources, counts emitted often
        monkeypatch.setattr(divergence, "BLOCK_BYTES", 100)
        monkeypatch.setattr(divergence, "SOURCE_BLOCK", 2)
        monkeypatch.setattr(divergence, "HELD_TERMS", 2)
    rows = [(g, s, t, 1, 2) for g, s, t in AUDIT_ROWS]
    docs = spark.createDataFrame(rows, "lang string, source string, text string, value long, rank int")
    found = divergence.divergence(docs, shards_each=2 if small else divergence.SHARDS)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == brute_divergence(AUDIT_ROWS)


def test_divergence_of_the_table(spark):
    docs = table(spark, SF_DIR, "documents")
    want = brute_divergence([(r["lang"], r["source"], r["text"]) for r in docs.collect()])
    assert sorted(tuple(r) for r in QUERIES["op11_source_divergence"](spark, SF_DIR).collect()) == want


def test_divergence_of_nothing(spark):
    assert divergence.divergence(brute.table(spark, [])).collect() == []


def test_shares_are_exact():
    counts = np.array([0, 1, 7, 10**6, 10**9, 10**12])
    for total in (0, 1, 10**6, 10**13, 1 << 46, 1 << 47, 10**16):
        for size in (1, 17, 10**6):
            fits = counts[counts <= total]
            want = [1 + 10**9 * (int(c) + 1) // (total + size) for c in fits]
            assert divergence.shares(fits, total, size).tolist() == want


def test_perfect_hash_is_minimal_and_verified():
    keys = [f"k{i}".encode() for i in range(5000)]
    levels, ordered = divergence.perfect_hash(keys)
    held = divergence.PerfectHash(levels, ordered)
    slots = held.slots(keys, divergence._hashes(keys))
    assert sorted(slots.tolist()) == list(range(5000)) and all(ordered[s] == k for s, k in zip(slots, keys))
    others = [f"o{i}".encode() for i in range(5000)]
    assert (held.slots(others, divergence._hashes(others)) == -1).all()


def test_perfect_hash_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(divergence, "_hashes", lambda keys: np.array([len(k) for k in keys], np.uint64))
    keys = [b"aa", b"bb", b"c", b"dddd", b"ee"]
    held = divergence.PerfectHash(*divergence.perfect_hash(keys))
    slots = held.slots([*keys, b"ff"], divergence._hashes([*keys, b"ff"]))
    assert sorted(slots[:5].tolist()) == list(range(5)) and slots[5] == -1


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, u, h, "x", b"y") for i, u, h in rows], "page_id long, url string, html string, payload string, digest binary"
    )


BIG, LONG = "<p>é</p>" * 200, "<b>ab</b>" * 200_000
PAGES = [
    (1, "https://a.example/x?y=1 2", BIG), (2, None, BIG), (3, "not an address\r\nWARC-Type: fake", BIG), (4, "", None),
    (5, "http://[broken", ""), (6, "https://b.example/%41", "short"), (7, "https://b.example", "short"), (None, "u", BIG),
    (8, "https://c.example", LONG), (-9, "https://c.example", LONG), (3, "again", BIG), (10, "x", "WARC/1.1\r\n\r\nbody"),
    (11, "x", "a" * 1000), (12, "x", "a" * 1000), (13, "x", "b" * 999), (14, "x", "b" * 999), (None, None, None),
]


def test_captures(spark):
    files = warc.write_captures(pages(spark, PAGES), new_folder(spark, "test-warc"))
    found = warc.captures(files).collect()
    want = []
    for page, url, html in PAGES:
        data = (html or "").encode()
        same = [i for i, _, h in PAGES if h == html and i is not None]
        target = max(same) if len(data) >= 1000 and same else None
        again = target is not None and (page is None or page < target)
        want.append((page, url, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response",
                     target if again else None, None if again else data))
    got = [
        (r["page_id"], r["uri"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
         r["response"] and bytes(r["response"]["payload"]))
        for r in found
    ]
    assert Counter(got) == Counter(want)
    assert len({r["capture_id"] for r in found}) == len(PAGES)
    assert all(len(r["requests"]) == len(r["metadata"]) == 1 for r in found)
    assert all(r["requests"][0]["http"].startswith("GET ") for r in found)


def test_files_are_plain_warc(spark):
    files = warc.write_captures(pages(spark, PAGES[:3]), new_folder(spark, "test-warc")).collect()
    data = b"".join(gzip.open(f["file"].removeprefix("file:")).read() for f in files)
    assert sum(f["captures"] for f in files) == 3 and data.count(b"WARC/1.1\r\n") == 9 + len(files)
    sha1 = base64.b32encode(hashlib.sha1(BIG.encode()).digest())
    assert data.count(b"WARC-Payload-Digest: sha1:" + sha1) == 3
    assert b"WARC-Target-URI: not an address%0D%0AWARC-Type: fake\r\n" in data


def test_transactions_without_all_parts(spark, tmp_path):
    records = [
        warc.record("response", "<r1>", "d", b"HTTP/1.1 200 OK\r\n\r\nbody", Content_Type=warc.HTTP_RESPONSE),
        warc.record("request", "<q1>", "d", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<r1>", Content_Type=warc.HTTP_REQUEST),
        warc.record("request", "<q2>", "d", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<gone>", Content_Type=warc.HTTP_REQUEST),
        warc.record("revisit", "<r2>", "d", b"HTTP/1.1 200 OK\r\n\r\n", WARC_Refers_To="<gone>", Content_Type=warc.HTTP_RESPONSE),
    ]
    path = tmp_path / "one.warc.gz"
    path.write_bytes(b"".join(records))
    files = spark.createDataFrame([(str(path),)], "file string")
    found = {r["capture_id"]: r for r in warc.captures(files).collect()}
    assert set(found) == {"<r1>", "<r2>"}
    assert bytes(found["<r1>"]["response"]["payload"]) == b"body"
    assert [q["record_id"] for q in found["<r1>"]["requests"]] == ["<q1>"] and found["<r1>"]["metadata"] == []
    assert found["<r2>"]["refers_to"] is None and found["<r2>"]["response"] is None
    path.write_bytes(path.read_bytes()[:-5])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_records(files).collect()


def test_captures_of_nothing(spark):
    files = warc.write_captures(pages(spark, []), new_folder(spark, "test-warc"))
    assert files.collect() == [] and warc.captures(files).collect() == []


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", low(text).encode())


def grams(text, most):
    own = words(text)
    return [b" ".join(own[i : i + n]) for n in range(1, most + 1) for i in range(len(own) - n + 1)]


def test_prefix_crcs():
    for most in (1, 2, 5):
        features = importance.Features(most)
        for text in [*brute.texts(6, 3), "q" * 70_000 + " " + "r" * 300 + " é1", "ab cd " * 400_000]:
            got = [c for crcs, _ in features.of((text or "").encode()) for c in crcs.tolist()]
            own = words(text)
            if most == 1 or len(own) < 100_000:
                assert sorted(got) == sorted(zlib.crc32(g) for g in grams(text, most))
            else:  # too many to list: their number and kinds
                assert len(got) == sum(len(own) - n + 1 for n in range(1, most + 1))
                assert set(got) == {zlib.crc32(g) for g in grams("ab cd " * 10, most)}


def brute_resample(docs, target, most=1, percent=10, least=20, buckets=10_000):
    def buckets_of(text):
        return [zlib.crc32(g) % buckets for g in grams(text, most)]

    s = Counter(b for _, t in docs for b in buckets_of(t))
    t = Counter(b for x in target for b in buckets_of(x))
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for number, text in docs:
        found = buckets_of(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        name = f"2024:{'' if number is None else number}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([number, len(found), weight, score, None, len(words(text)) >= least])
    drawn = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, row in enumerate(drawn[: len(drawn) * percent // 100], 1):
        row[4] = place
    return Counter(tuple(r[:5]) for r in rows)


def test_resample_of_the_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()]
    target = [r["text"] for r in table(spark, SF_DIR, "benchmark").collect()]
    found = QUERIES["op13_importance_resample"](spark, SF_DIR)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert set(dict(found.dtypes).values()) == {"bigint"}
    assert Counter(tuple(r) for r in found.collect()) == brute_resample(docs, target)


def test_resample_of_awkward_texts(spark):
    rows = list(enumerate(brute.texts(20, 5))) + [(None, brute.prose(50, 1)), (None, None), (3, brute.prose(30, 2))]
    target = [None, "", brute.prose(40, 9), "one two"]
    items = spark.createDataFrame([(t, 1) for t in target], "text string, id int")
    found = importance.resample(brute.table(spark, rows), items, percent=60, most_words=3, buckets=500)
    got = Counter((r["id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found.collect())
    assert got == brute_resample(rows, target, 3, 60, 20, 500)


def test_resample_of_nothing(spark):
    docs, none = brute.table(spark, [(1, brute.prose(30, 1))] * 10), brute.table(spark, [])
    assert importance.resample(none, docs).collect() == []
    found = importance.resample(docs, none).collect()
    assert sorted(r["rank"] or 0 for r in found) == [0] * 9 + [1]
