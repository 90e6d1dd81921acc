"""Exact copies against a dictionary of texts, and the hash on its own."""

import hashlib
import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tideline.llm import exact_dedup, queries


def digests(names):
    return np.frombuffer(b"".join(hashlib.sha256(str(n).encode()).digest() for n in names), dtype=np.uint8).reshape(-1, 32)


def test_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 7, 5_000):
        held = digests(range(n))
        sizes, bits, slot = exact_dedup.perfect_hash(held)
        assert sorted(slot) == list(range(n))
        assert (exact_dedup.slots(held, sizes, bits) == slot).all()
    shard = {"digests": held[np.argsort(slot)].tobytes(), "level_bits": sizes, "bits": bits.tobytes()}
    assert (exact_dedup.members(held, shard) == slot).all()
    assert (exact_dedup.members(digests(range(10_000, 30_000)), shard) == -1).all()


def wanted(rows):
    """By a dictionary: id, id that stays, size, sha256 per row; number of rows that stay per text."""
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text or ""), []).append(i)

    def order(i):
        return (i is None, i or 0)

    return sorted(
        ((i, min(ids, key=order), len(ids), hashlib.sha256(text.encode()).hexdigest()) for text, ids in groups.items() for i in ids),
        key=repr,
    )


def test_copies_against_a_dictionary(spark):
    chance = random.Random(3)
    words = ["a", "b", " ", "  ", "\t", "\n", "\r\n", "\x0b", "\x0c", " ", "é"]
    rows = [(i, "".join(chance.choice(words) for _ in range(chance.randint(0, 5)))) for i in range(600)]
    rows += [(None, "a b"), (None, "a b"), (None, None), (7, "a b"), (7, "a b"), (700, None), (701, ""), (702, " "), (703, "x" * 200_000)]
    rows += [(-5, "only late"), (900, "only late")]
    docs = spark.createDataFrame([(i, t, 1, "k", "s") for i, t in rows], "doc_id long, text string, size int, kept string, _winner string")
    for shards in (exact_dedup.Shards(), exact_dedup.Shards(40, 16)):
        found = exact_dedup.mark_copies(docs.repartition(4), exact_dedup.first_half(docs), shards=shards).collect()
        assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=repr) == wanted(rows)
        stays = {}
        for r in found:
            stays[r["text_sha256"]] = stays.get(r["text_sha256"], 0) + r["kept"]
            assert not r["kept"] or r["doc_id"] == r["keep_id"]
            assert r["size"] == 1
        assert set(stays.values()) == {1}


def test_history_keeps_its_winner(spark):
    rows = [(10, "same", True), (3, "same", False), (4, "new", False), (2, "new", None), (11, "old", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, known boolean")
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.mark_copies(docs, F.col("known")).collect()}
    assert found == {10: (10, 2, True), 3: (10, 2, False), 4: (2, 2, False), 2: (2, 2, True), 11: (11, 1, True)}


def test_rows_that_stay_keep_their_texts(spark):
    docs = spark.createDataFrame([(1, "a  b", "x"), (2, "a b", "y"), (2, "a b", "z"), (3, None, "n")], "doc_id long, text string, kept string")
    assert sorted(map(tuple, exact_dedup.drop_copies(docs).collect())) == [(1, "a  b", "x"), (3, None, "n")]
    assert exact_dedup.drop_copies(docs.filter("false")).count() == 0
    assert exact_dedup.mark_copies(docs.filter("false"), F.lit(True)).count() == 0


def test_query_equals_sql(spark, folder):
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{folder}/documents.parquet'")
    want = sorted(db.sql(queries.ORACLE["op12_exact_copies"]).fetchall())
    found = queries.op12_exact_copies(spark, folder)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect())) == want and not all(r[3] for r in want)
