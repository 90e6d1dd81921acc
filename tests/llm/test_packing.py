"""Packing."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm import packing, queries


def check(rows, texts, capacity=packing.CAPACITY):
    """Every id once, cut as its document says, in sequences without gaps."""
    tokenizer = Tokenizer.from_file(packing.VOCABULARY)
    parts: dict = {}
    for r in rows:
        parts.setdefault(r["doc_id"], []).append(r)
    assert set(parts) == set(texts)
    for key, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(parts[key], key=lambda r: r["start"]):
            piece = np.array(ids[at : at + r["length"]], dtype="<u4").tobytes()
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["ids_crc32"] == zlib.crc32(piece)
            at += r["length"]
        assert at == len(ids)
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert sorted(sequences) == list(range(len(sequences)))
    return padding / (capacity * len(sequences))


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = queries.op4_packing(spark, folder).collect()
    assert check(rows, {r["doc_id"]: r["text"] for r in docs.collect()}) < 0.02


def test_edges(spark):
    texts = [None, "", "<|endoftext|> ab", "The <|STARTOFTEXT|> x", "it's we'll 'TIS I'd", "naïve… ΑΣ. ΑΣ, Σ",
             "a\u0301b e\u0301. x\u00a0y\u2003z", "12,345.67% (ok)-- **b** \"q\"", "word " * 20000, "x" * 30000, "中文字。\n\n日本!", "\ud7ff\U0001f600!?"]
    rows = [(i, t, 1, "mine") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int, extra string")
    made = packing.pack_documents(docs, ["doc_id", "ids_crc32"], with_ids=False).collect()
    check(made, dict(enumerate(texts)))
    assert {r["extra"] for r in made} == {"mine"}
    twice = docs.unionAll(docs)
    assert packing.pack_documents(twice, ["doc_id", "ids_crc32"], with_ids=False).count() == 2 * len(made)
    assert packing.pack_documents(docs.filter("false"), ["doc_id"], with_ids=False).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, f"some words {i} " * (40 * i + 1)) for i in range(30)], "doc_id long, text string")
    packed = packing.pack_documents(docs, ["doc_id"]).withColumn("crc", F.crc32("ids"))
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        ids = bytes(whole[r["sequence_id"]]["ids"])
        assert zlib.crc32(ids[4 * r["offset"] : 4 * (r["offset"] + r["length"])]) == r["crc"]
    for r in whole.values():
        n = len(r["ids"]) // 4
        assert n == packing.CAPACITY or n & (n - 1) == 0 and r["n_padding"] == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50)))
def test_patterns_use_up_the_histogram(histogram):
    patterns = packing.pack_histogram(histogram, 64)
    used: dict = {}
    for lengths, packs in patterns:
        assert sum(lengths) <= 64 and packs > 0
        for length in lengths:
            used[length] = used.get(length, 0) + packs
    assert used == histogram
    ranks: dict = {}
    for length, first, last, _, _ in packing.slots(patterns):
        ranks.setdefault(length, []).extend(range(first, last + 1))
    assert all(sorted(found) == list(range(histogram[length])) for length, found in ranks.items())


@pytest.mark.parametrize("parts", [1, 9])
def test_ranks_of_a_frequent_length(spark, parts):
    pieces = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, 7L, id % 5) AS length").repartition(parts)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    for part_rows in (packing.PART_ROWS, 2):
        found: dict = {}
        for r in packing.ranked(pieces, ["id"], counts, part_rows).collect():
            found.setdefault(r["length"], []).append(r["_ll_rank"])
        assert {k: sorted(ranks) for k, ranks in found.items()} == {k: list(range(n)) for k, n in counts.items()}


def test_words_against_the_tokenizer():
    tokenizer, known = Tokenizer.from_file(packing.VOCABULARY), packing.word_ids(packing.VOCABULARY)
    chance = random.Random(8)
    letters = "abzABZ019.,;:!?*#$%&|)\"-'_/\u0130\u0131\u00c5\u00df\u03a3\u03c2\u0301\u0307\u4e2d\uac00\U0001f600\u00a0\u2026\u01c5\ufb01"
    words = ["DEN\u0130ZL\u0130.", "\u0130", "\u0130!", "a\u0130-b."]
    words += ["".join(chance.choices(letters, k=chance.randint(1, 9))) for _ in range(20_000)]
    for word in words:
        raw = word.encode()
        found = b"".join(map(known.__getitem__, raw.lower().split()))
        want = np.array(tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert found == want, ascii(word)
