"""Packing: every id once, sequences without padding, the placement rule, and ids of the file's own library."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from strata.llm import packing
from strata.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def content():
    with open(packing.default_vocabulary(), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def own(content):
    return Tokenizer.from_str(content)


def check(rows, texts, own, window=2048):
    """rows cover the documents (a list, ids may repeat) exactly; returns the padding."""
    ids = [np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for _, t in texts]
    want = Counter()
    by_id = defaultdict(list)
    for (doc, _), x in zip(texts, ids, strict=True):
        by_id[doc].append(x)
        want[doc] += len(x)
    got = Counter()
    for r in rows:
        got[r["doc_id"]] += r["length"]
        assert any(r["doc_tokens"] == len(x) and zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for x in by_id[r["doc_id"]])
    assert got == want
    for doc, versions in by_id.items():
        if len(versions) == 1:
            at = 0
            for r in sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]
            assert at == len(versions[0])
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_given_documents(spark, own):
    texts = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert check(entry.queries()["op11_packing"](spark, SF).collect(), texts, own) == 0


def test_ids_are_those_of_the_files_own_library(content, own):
    tokens = packing.Tokens(content)
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    assert all(not packing.SETTLED.fullmatch(chr(c)) for c in range(0x3000, 0x30000) if not 0xD800 <= c < 0xE000)
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)} 's{chr(c)} \n{chr(c)} {chr(c)}z" for c in points]
    texts += ["", " ", "<|endoftext|>", "a <|endoftext|>b", "x" * 3000, " " * 3000 + "x", "!" * 3000, "it's we'LL\r\n\r\n  end ", "日本語 text", "\U0001f600 ok"]
    for text in texts:
        assert tokens.ids(text).tolist() == own.encode(text, add_special_tokens=False).ids


def test_placement_leaves_the_least_sum_of_squares():
    rng, levels = random.Random(1), packing.Levels(16)

    def after(at, size):
        count = levels.count.copy()
        if at:
            count[at] -= 1
        if at + size < 16:
            count[at + size] += 1
        return int((count[1:16] ** 2).sum())

    for k in range(3000):
        size = rng.randint(1, 15)
        choices = {at: after(at, size) for at in range(16 - size + 1) if at == 0 or levels.count[at]}
        at = levels.level_for(size)
        assert choices[at] == min(choices.values()) and at == max(a for a, v in choices.items() if v == min(choices.values()))
        filled = levels.place(size, (k, 0, np.zeros(size, dtype=np.uint32), size))
        assert not filled or sum(len(p[2]) for p in filled) == 16
        assert levels.open == levels.count[1:16].sum() == sum(map(len, levels.held))


def test_edges(spark, own):
    texts = [(1, None), (2, ""), (2, ""), (None, "no id"), (None, None), (3, "word " * 30_000), (4, "x" * 50_000), (5, "same text"), (5, "same text"), (5, "another"), (6, "É 𝒳 日本 <|endoftext|>")]
    frame = spark.createDataFrame([(d, t, 1, 2, "s") for d, t in texts], "doc_id long, text string, start int, length int, ids string")
    assert check(packing.packed_sequences(frame).collect(), texts, own) == 0
    assert check(packing.packed_sequences(frame.coalesce(1), window=64, most=2).collect(), texts, own, 64) == 0
    assert packing.packed_sequences(frame.limit(0)).collect() == []


def test_open_windows_are_bounded(spark, own):
    """Documents that never fit together are cut once too many windows are open, not padded."""
    texts = [(k, "word " * 39 + "word") for k in range(200)]  # 41 tokens with the last id, windows of 64
    frame = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    rows = packing.packed_sequences(frame, window=64, most=10).collect()
    assert check(rows, texts, own, 64) == 0
    assert check(rows, texts, own, 64) == check(packing.packed_sequences(frame, window=64).collect(), texts, own, 64)
