"""Registered text queries and the pipeline against brute force on the smallest tables."""

import hashlib
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from tableloom.llm import QUERIES, byte_bpe, quality, secret_scan
from tableloom.llm.common import store, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SF_DIR, "documents").collect()}


@pytest.fixture(scope="module")
def items(spark):
    return {r["item_id"]: r["text"] for r in table(spark, SF_DIR, "benchmark").collect()}


def rows(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF_DIR).collect()}


def hexdigest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_all_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(queries())


def test_op1(spark, texts):
    found = rows(spark, "op1_secret_scan")
    assert set(found) == set(texts)
    for i, r in found.items():
        spans = brute.secrets(texts[i], secret_scan)
        named = [f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        base = [n for n in named if not n.startswith("entropy")]
        assert r["spans"] == ",".join(named) and r["base_sha256"] == hexdigest(",".join(base))
        for kind in ("assign", "access", "hex"):
            assert r[f"n_{kind}"] == sum(n.startswith(kind) for n in named)


def test_op3(spark, texts):
    found = rows(spark, "op3_quality_rules")
    assert set(found) == set(texts)
    for i, r in found.items():
        words, chars, symbols, lines, repeats = brute.counts(texts[i])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            words, chars, symbols, lines, repeats)
        assert r["base_failed"] == (words < 10 or 100 * repeats > 20 * words)
        assert not (r["base_failed"] and r["kept"])


def test_op4(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found, start = rows(spark, "op4_token_files"), 0
    for i in sorted(texts):
        ids = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_op5(spark, texts, items):
    found = QUERIES["op5_decontaminate"](spark, SF_DIR).collect()
    got = {(r["doc_id"], r["item_id"]): r["agreeing"] for r in found}
    # Items with no word in common cannot overlap.
    want = {}
    for i, t in texts.items():
        own = set((t or "").lower().split())
        for k, x in items.items():
            words = x.lower().split()
            if sum(w in own for w in words) * 4 >= len(words) and (n := brute.overlaps(t, x)):
                want[i, k] = n
    assert got == want and want


def test_op7(spark, texts):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = rows(spark, "op7_byte_bpe")
    assert set(found) == set(texts)
    for i, r in found.items():
        ids = bpe.encode_ordinary(texts[i] or "")
        want = (len(ids), hexdigest(",".join(map(str, ids))), hexdigest(texts[i] or ""))
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want


def test_op8(spark, texts):
    prints = {i: brute.fingerprint(t) for i, t in texts.items()}
    want = brute.connected(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 2)
    found = rows(spark, "op8_simhash")
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in found.items()} == {
        i: (f"{prints[i]:016x}", want[i]) for i in texts
    }


def test_op9(spark, texts):
    found = rows(spark, "op9_sharding")
    assert {i: r["text_crc32"] for i, r in found.items()} == {i: zlib.crc32(t.encode()) for i, t in texts.items()}
    assert {r["law"] for r in found.values()} == {"rows"}


def test_op10_leaves_other_text_alone(spark, texts):
    for i, r in rows(spark, "op10_pii_pseudonyms").items():
        changed = sum(r[c] for c in r.asDict() if c.startswith("n_"))
        assert (r["text"] == texts[i]) == (changed == 0)


def test_pipeline(spark, texts, items):
    docs = table(spark, SF_DIR, "documents")
    columns, left = docs.columns, dict(texts)
    judged = {r["id"]: r["kept"] for r in quality.quality(docs, table(spark, SF_DIR, "labels")).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, SF_DIR), "test-pipeline")
        assert docs.columns == columns
        if name == "quality_rules":
            left = {i: t for i, t in left.items() if judged[i]}
        elif name == "near_dedup":
            root = brute.copies(left)
            left = {i: t for i, t in left.items() if root[i] == i}
        elif name == "decontaminate":
            left = {
                i: t for i, t in left.items()
                if not any(
                    sum(w in t.lower() for w in x.lower().split()) * 4 >= len(x.split()) and brute.overlaps(t, x)
                    for x in items.values()
                )
            }
        else:
            left = {i: brute.masked(t, brute.secrets(t, secret_scan)) for i, t in left.items()}
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == left, name
    tokens = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in tokens} == {i: hexdigest(t) for i, t in left.items()}
    assert all(len(r["ids"]) == r["n_tokens"] for r in tokens)
