"""Line dedup, near duplicates, passages, decontamination."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import decontaminate, graph, line_dedup, near_dups, passages, queries
from tideline.llm.shingles import Shingles, cached_hashes

WORDS = [a + b for a in ("ba", "do", "ki", "lu", "me", "no", "pa", "ri") for b in ("ta", "sun", "vel", "mor", "gin", "fex", "zul", "hem")]


def prose(n, seed):
    chance = random.Random(seed)
    return [chance.choice(WORDS) + chance.choice(["", "s", "t", "er"]) for _ in range(n)]


# ---- lines --------------------------------------------------------------------------


def deleted(rows, min_lines=2, min_words=8):
    """Per row (in order) the kept lines, by comparing every run with every earlier one."""
    lines = [(r or "").split("\n") for r in rows]
    worded = [[(i, x) for i, x in enumerate(found) if x.split()] for found in lines]
    gone = [set() for _ in rows]
    places = [(d, p) for d, found in enumerate(worded) for p in range(len(found))]
    for k, (d, p) in enumerate(places):
        best = 0
        for e, q in places[:k]:
            n = 0
            while p + n < len(worded[d]) and q + n < len(worded[e]) and worded[d][p + n][1] == worded[e][q + n][1]:
                n += 1
            best = max(best, n)
        if best >= min_lines or best == 1 and len(worded[d][p][1].split()) >= min_words:
            gone[d] |= {worded[d][p + n][0] for n in range(best)}
    return [None if r is None else "\n".join(x for i, x in enumerate(found) if i not in g) for r, found, g in zip(rows, lines, gone)]


def test_lines_against_brute_force(spark):
    chance = random.Random(5)
    pool = ["a b c", "d e", "one two three four five six seven eight", "nine ten eleven twelve a b c d e", "", " ", "x", "y z"]
    texts = ["\n".join(chance.choice(pool) for _ in range(chance.randint(0, 14))) for _ in range(40)]
    texts += [texts[3], texts[3], None, "", "same\nsame\nsame\nsame\nsame", "\n\n", texts[7] + "\n" + texts[8]]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, pos int").repartition(5)
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    for i, want in enumerate(deleted(texts)):
        assert found[i]["text"] == want and found[i]["pos"] == 5
    assert line_dedup.dedup_lines(docs.filter("false")).count() == 0


def test_maximal_runs(spark):
    body = [f"line {i}" for i in range(11)]
    texts = ["\n".join(body), "new\n" + "\n".join(body[2:9]) + "\nend", "\n".join(body)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = line_dedup.numbered(docs)
    runs = line_dedup.repeated_runs(line_dedup.line_ids(rows, "text", ["doc_id"], 8)).collect()
    longest: dict = {}
    for r in runs:
        longest[r[line_dedup.ROW]] = max(longest.get(r[line_dedup.ROW], (0,)), (r["n_lines"], r["start"], r["from_start"]))
    assert sorted(longest.values()) == [(7, 1, 2), (11, 0, 0)]
    made = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert (made[1]["text"], made[1]["n_deleted"], made[1]["longest_run"]) == ("new\nend", 7, 7)
    assert (made[2]["text"], made[0]["n_deleted"]) == ("", 0)


def previous_lengths(worded):
    """Of each line (row, number): how many lines from it on occurred earlier, by comparing all places."""
    places = [(d, p) for d, found in enumerate(worded) for p in range(len(found))]
    length = {}
    for k, (d, p) in enumerate(places):
        length[d, p] = 0
        for e, q in places[:k]:
            n = 0
            while p + n < len(worded[d]) and q + n < len(worded[e]) and worded[d][p + n] == worded[e][q + n]:
                n += 1
            length[d, p] = max(length[d, p], n)
    return length


def tables_of_lines():
    chance = random.Random(11)
    few = [[chance.choice("abc") for _ in range(chance.randint(0, 24))] for _ in range(14)]
    base = [chance.choice("abcdefghij") for _ in range(60)]
    pieces = []
    for _ in range(16):
        cuts = [chance.randrange(60) for _ in range(4)]
        pieces.append([x for c in cuts for x in base[c : c + chance.randint(1, 17)]])
    return {
        "joined": [list("ab"), list("xabcy"), list("zabcq")],
        "few letters": few,
        "pieces": pieces,
        "one letter": [["a"] * 13, ["a"] * 5, ["b"] + ["a"] * 21, ["a"] * 40],
        "copies": [base, base[7:31] + ["new"] + base[3:40], base, base[20:]],
        "distinct": [list("abc"), list("def"), []],
    }


@pytest.mark.parametrize("name", list(tables_of_lines()))
def test_runs_of_any_length_against_brute_force(spark, name):
    worded = tables_of_lines()[name]
    length = previous_lengths(worded)
    docs = spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate(worded)], "doc_id long, text string").repartition(3)
    rows = line_dedup.numbered(docs)
    of = {r[line_dedup.ROW]: r["doc_id"] for r in rows.collect()}
    runs = {}
    for r in line_dedup.repeated_runs(line_dedup.line_ids(rows, "text", ["doc_id"], 8)).collect():
        d, p, e, q, n = of[r[line_dedup.ROW]], r["start"], of[r["from_row"]], r["from_start"], r["n_lines"]
        runs[d, p] = n
        assert (e, q) < (d, p) and worded[d][p : p + n] == worded[e][q : q + n]
    assert runs == {(d, p): n for (d, p), n in length.items() if n and length.get((d, p - 1), 0) <= n}
    for least in (1, 3):
        found = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs, min_lines=least).collect()}
        for d, lines in enumerate(worded):
            mine = {p: n for (e, p), n in length.items() if e == d and n >= least}
            gone = {p + k for p, n in mine.items() for k in range(n)}
            kept = "\n".join(x for p, x in enumerate(lines) if p not in gone)
            assert (found[d]["text"], found[d]["n_deleted"]) == (kept, len(gone))
            assert found[d]["longest_run"] == max(mine.values(), default=0)


def test_a_long_line_in_a_short_run_goes_alone(spark):
    long = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, f"a\n{long}\nb"), (2, f"a\n{long}\nc"), (3, f"a\n{long}\nc")], "doc_id long, text string")
    found = {r["doc_id"]: (r["text"], r["longest_run"]) for r in line_dedup.dedup_lines(docs, min_lines=3).collect()}
    assert found == {1: (f"a\n{long}\nb", 0), 2: ("a\nc", 1), 3: ("", 3)}


def test_rows_that_tie(spark):
    rows = [(None, "a b\nc d"), (None, "a b\nc d"), (1, "a b\nc d"), (1, "a b\nc d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.dedup_lines(docs).collect()
    assert sorted(r["n_deleted"] for r in found) == [0, 2, 2, 2]
    assert all(r["n_deleted"] == 2 for r in found if r["doc_id"] == 1)


def test_line_query_equals_sql(spark, folder):
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{folder}/documents.parquet'")
    want = sorted(db.sql(queries.ORACLE["op8_line_dedup"]).fetchall())
    assert sorted(map(tuple, queries.op8_line_dedup(spark, folder).collect())) == want
    assert sum(r[3] for r in want) > 0


# ---- near duplicates ----------------------------------------------------------------


def shingled(text):
    words = (text or "").split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def classes(texts, threshold=0.8, common=0.005):
    """Classes of rows by comparing all pairs of texts, and the links of each row."""
    bags = [shingled(t) for t in texts]
    df = Counter(s for bag in bags for s in bag)
    n = len(texts)
    idf = {s: math.log1p(n / k) if k >= common * n else math.log1p(1 / common) for s, k in df.items()}
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    near = set()
    for i in range(n):
        for j in range(i):
            both = sum(min(k, bags[j][s]) * idf[s] for s, k in bags[i].items())
            every = sum(max(bags[i][s], bags[j][s]) * idf[s] for s in bags[i] | bags[j])
            if (texts[i] or "") == (texts[j] or "") or every and both >= threshold * every - 1e-9:
                near.add((j, i))
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)], near


def near_copies():
    texts = []
    for k in range(30):
        words = prose(120 + 3 * k, k)
        texts.append(" ".join(words))
        chance = random.Random(k)
        for edits in (1, 2, 3):
            other = list(words)
            for _ in range(edits):
                other[chance.randrange(len(other))] = "changed"
            texts.append(" ".join(other))
    return texts + [texts[0], texts[0], None, "", "one two", "one two", "a b c d e", " a  b c d\te ", "lonely text"]


def test_near_duplicates_against_brute_force(spark):
    texts = near_copies()
    docs = spark.createDataFrame([(i, t, "mine", "c") for i, t in enumerate(texts)], "doc_id long, text string, tid string, component string")
    want, _ = classes(texts)
    found = {r["doc_id"]: r for r in near_dups.near_duplicates(docs.repartition(6)).collect()}
    assert [found[i]["class_id"] for i in range(len(texts))] == want
    sizes = Counter(want)
    assert all(found[i]["class_rows"] == sizes[c] and found[i]["tid"] == "mine" for i, c in enumerate(want))
    kept = sorted(r["doc_id"] for r in near_dups.drop_near_duplicates(docs).collect())
    assert kept == sorted(set(want))


def chained_copies():
    """Pages of one template that are unlike each other; of each there is one copy with few changes."""
    stock, texts = prose(80, 60), []
    for k in range(40):
        own = prose(40, 700 + k)
        texts += [stock + own, stock + own[:37] + prose(3, 800 + k)]
    return [" ".join(t) for t in texts]


def test_every_pair_of_a_bucket_is_settled(spark):
    texts = chained_copies()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want, near = classes(texts)
    shape = near_dups.NearDups(bands=1, rows=1)
    table = near_dups.weights_table(docs, "text", shape)
    bucket = {r["first"]: r["buckets"][0] for r in near_dups.distinct_texts(docs, "text", "doc_id", table, shape).collect()}
    met = [(i, j) for i, j in near if bucket[i] == bucket[j]]
    assert len(met) >= 20 and max(Counter(bucket.values()).values()) > 2 * near_dups.NearDups().bands
    found = {r["doc_id"]: r["class_id"] for r in near_dups.near_duplicates(docs, shape=shape).collect()}
    split = [(i, j) for i, j in met if found[i] != found[j]]
    print(f"pairs of a bucket that are split: {len(split)} of {len(met)}")
    assert not split and all(want[i] == want[found[i]] for i in found)


def test_rare_shingles_weigh_by_their_exact_counts(spark):
    """Pages of 85 shared and 10 own shingles among 10,000 other rows: similarity 0.72 by TF-IDF, 0.81 by plain counts."""
    stock = prose(89, 61)
    pages = [" ".join(stock + prose(10, 900 + k)) for k in range(40)]
    rows = pages + [" ".join(prose(5, 2000 + k)) for k in range(10_000)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    found = near_dups.near_duplicates(docs).filter("doc_id < 40").collect()
    assert len({r["class_id"] for r in found}) == 40 and {r["class_rows"] for r in found} == {1}


def test_counts_of_shingles_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "CHUNK_BYTES", 2_000)
    monkeypatch.setattr(near_dups, "PART_SHINGLES", 300)
    texts = near_copies() + ["w " * 400, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    table = near_dups.weights_table(docs, "text", near_dups.NearDups())
    assert table.texts.select("chunk").distinct().count() > 10 and table.counts.select("part").distinct().count() > 10
    want = Counter(s for t in texts for s in shingled(t))
    found = near_dups.distinct_texts(docs, "text", "doc_id", table, near_dups.NearDups()).collect()
    assert len(found) == len({t or "" for t in texts}) and table.total == len(texts)
    for r in found:
        own = near_dups.unpacked(bytes(r["df"])).tolist()
        assert sorted(own) == sorted(want[s] for s in shingled(texts[r["first"]]))


def test_packed_numbers():
    for values in ([], [0], [1, 255, 3], [256, 0], [(1 << 44) - 1, 7], [1 << 63]):
        raw = near_dups.packed(np.array(values, dtype=np.uint64))
        assert near_dups.unpacked(raw).tolist() == values
    assert len(near_dups.packed(np.array([1, 2, 3], dtype=np.uint64))) == 4


def test_open_pairs_of_a_large_bucket_are_made_once(spark, monkeypatch):
    """Texts meet in many buckets, and by many shingles that they share."""
    made, pairs_of = [], near_dups.shared_pairs

    def counted(*args):
        pairs = pairs_of(*args)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(near_dups, "shared_pairs", counted)
    stock, texts = prose(300, 62), [" ".join(prose(5, 5000 + k)) for k in range(2000)]
    for k in range(60):
        edits = random.Random(k).sample(range(300), 3)
        texts.append(" ".join(f"changed{k}" if i in edits else word for i, word in enumerate(stock)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    near_dups.near_duplicates(docs).count()
    print(f"rows and pairs: {made}")
    assert made and made[0][1] > 20 and made[0][0] <= 1.2 * made[0][1]


def test_near_duplicates_of_edge_rows(spark):
    rows = [(None, "x y z"), (None, "x y z"), (5, None), (5, ""), (7, "w " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dups.near_duplicates(docs).collect()
    assert sorted(r["class_rows"] for r in found) == [1, 2, 2, 2, 2]
    assert near_dups.drop_near_duplicates(docs).count() == 3
    assert near_dups.near_duplicates(docs.filter("false")).count() == 0
    assert near_dups.drop_near_duplicates(docs.filter("false")).count() == 0


def test_samples_collide_as_often_as_texts_are_similar():
    shape = near_dups.NearDups(bands=600, rows=1)
    words = prose(300, 1)
    texts = [" ".join(words).encode(), " ".join(words[:240] + prose(60, 2)).encode()]
    found = near_dups.weighted(Shingles(texts, cached_hashes()), np.zeros(0, np.uint64), np.zeros(0), 2.0)
    buckets, _ = near_dups.signatures(*found, 2, near_dups.Samples(600), shape)
    a, b = (shingled(t.decode()) for t in texts)
    similarity = sum((a & b).values()) / sum((a | b).values())
    assert abs((buckets[:, 0] == buckets[:, 1]).mean() - similarity) < 0.07


def test_recall_on_documents(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    keys = sorted(texts)
    want, near = classes([texts[k] for k in keys])
    found = {r["doc_id"]: r["class_id"] for r in queries.op10_near_duplicates(spark, folder).collect()}
    linked = sum(found[keys[i]] == found[keys[j]] for i, j in near)
    assert near and linked >= 0.99 * len(near)
    assert all(found[k] in {keys[j] for j in range(len(keys)) if want[j] == want[i]} for i, k in enumerate(keys))


def test_components(spark):
    chance = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(chance.randrange(200, 400), chance.randrange(200, 400)) for _ in range(150)]
    edges = [(u, v) for u, v in edges if u != v]
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "u long, v long")
    found = {r["node"]: r["component"] for r in graph.components(df).collect()}
    assert found == {x: root(x) for x in parent}
    assert graph.components(df.filter("false")).count() == 0


# ---- passages -----------------------------------------------------------------------


def test_compact_windows_against_brute_force():
    chance = np.random.default_rng(1)
    for _ in range(150):
        sizes = chance.integers(1, 60, 5)
        n, t = sizes.sum(), int(chance.integers(2, 12))
        owner = np.repeat(np.arange(5), sizes)
        stop = np.cumsum(sizes)
        begins, ends = np.repeat(stop - sizes, sizes), np.repeat(stop - 1, sizes)
        order = (chance.integers(0, 30, n).astype(np.uint64) << np.uint64(24)) | np.arange(n, dtype=np.uint64)
        want = set()
        for i in range(n):
            a = b = i
            while a > begins[i] and order[a - 1] > order[i]:
                a -= 1
            while b < ends[i] and order[b + 1] > order[i]:
                b += 1
            if b - a + 1 >= t:
                want.add((a, i, b))
        left, center, right = passages.compact_windows(order, owner, begins, ends, t)
        assert set(zip(left.tolist(), center.tolist(), right.tolist())) == want


def test_planted_passages(spark):
    rows, shared = [], []
    for k in range(40):
        words = prose(300, 1000 + k)
        if k % 2 == 0:
            passage = prose(51 + k, 5000 + k // 2 * 2)
            shared.append(passage)
        passage = list(shared[-1])
        if k % 4 == 3:
            passage[len(passage) // 2] = "edited"
        at = 20 + 5 * k
        rows.append((k, " ".join(words[:at] + passage + words[at:]), at, len(passage)))
    rows += [(100, " ".join(prose(400, 77)), 0, 0), (101, None, 0, 0), (102, "", 0, 0), (103, " ".join(shared[0][:30]), 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tid int, n int")
    found: dict = {}
    for r in passages.mark_passages(docs.repartition(5)).collect():
        found.setdefault(r["doc_id"], []).append(r)
    for k in range(0, 40, 2):
        a, b = found[k], found[k + 1]
        assert {r["class_id"] for r in a} & {r["class_id"] for r in b} - {None}
        for r, (_, _, at, n) in ((a[0], rows[k]), (b[0], rows[k + 1])):
            assert abs(r["passage_start"] - at) <= 3 and abs(r["passage_stop"] - at - n) <= 3 and r["tid"] == at
            assert (r["class_rows"], r["n_links"]) == (2, 1)
    assert all(len(found[k]) == 1 and found[k][0]["class_id"] is None for k in (100, 101, 102, 103))
    assert passages.mark_passages(docs.filter("false")).count() == 0


def test_copies_and_hot_passages(spark):
    passage = " ".join(prose(60, 9))
    rows = [(k, " ".join(prose(100, k)) + " " + passage) for k in range(60)] + [(200 + k, " ".join(prose(80, 500))) for k in range(3)]
    found = passages.mark_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r["class_id"] for r in found if r["doc_id"] < 200}) == 1 and len(found) == 63
    copies = [r for r in found if r["doc_id"] >= 200]
    assert len({r["class_id"] for r in copies}) == 1 and copies[0]["class_id"] and {r["class_rows"] for r in copies} == {3}
    assert {(r["passage_start"], r["passage_stop"]) for r in copies} == {(0, 80)}


def test_pairs_beside_a_frequent_phrase(spark):
    phrase = prose(40, 9)
    texts = [prose(60, 2000 + k) + phrase + prose(60, 3000 + k) for k in range(120)]
    for k in range(12):
        tail = prose(15, 4000 + k)
        texts += [prose(60, 5000 + 2 * k + j) + phrase + tail + prose(60, 6000 + 2 * k + j) for j in (0, 1)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found: dict = {}
    for r in passages.mark_passages(docs.repartition(4)).collect():
        found.setdefault(r["doc_id"], set()).add(r["class_id"])
    pairs = [(i, i + 1) for i in range(120, 144, 2)]
    assert sum(bool(found[i] & found[j] - {None}) for i, j in pairs) == len(pairs)
    assert all(found[i] == {None} for i in range(120)) and len({min(found[i]) for i, _ in pairs}) == len(pairs)


def test_every_place_of_a_passage(spark):
    rows = []
    for k in range(12):
        passage, start = prose(60, 700 + k), k % 3 * 20
        twice = prose(30 + start, 800 + k) + passage + prose(50, 820 + k) + passage + prose(30, 840 + k) + passage + prose(9, 860 + k)
        rows += [(2 * k, " ".join(twice), [30 + start, 140 + start, 230 + start])]
        rows += [(2 * k + 1, " ".join(prose(25, 880 + k) + passage + prose(30, 900 + k)), [25])]
    found: dict = {}
    for r in passages.mark_passages(spark.createDataFrame(rows, "doc_id long, text string, at array<int>")).collect():
        found.setdefault(r["doc_id"], []).append(r)
    for k, _, at in rows:
        assert len(found[k]) == len(at) and {r["class_id"] for r in found[k]} == {found[k // 2 * 2][0]["class_id"]}
        starts = sorted(r["passage_start"] for r in found[k])
        assert all(abs(x - y) <= 3 for x, y in zip(starts, at)) and all(abs(r["passage_stop"] - r["passage_start"] - 60) <= 3 for r in found[k])


def test_a_line_that_stands_many_times(spark):
    line = prose(12, 33)
    times = [30, 60, 25, 90]
    rows = [(k, " ".join(prose(40, 610 + k) + line * n + prose(40, 650 + k))) for k, n in enumerate(times)]
    found = passages.mark_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(times) and len({r["class_id"] for r in found}) == 1
    for r in found:
        assert abs(r["passage_start"] - 40) <= 3 and abs(r["passage_stop"] - 40 - 12 * times[r["doc_id"]]) <= 12


def test_a_passage_behind_two_million_words(spark):
    words = [format(x, "x") for x in np.random.default_rng(8).integers(1 << 16, 1 << 20, 2_300_000).tolist()]
    passage = prose(80, 55)
    rows = [(0, " ".join(words + passage)), (1, " ".join(prose(100, 56) + passage)), (2, " ".join(prose(90, 57)))]
    found = {r["doc_id"]: r for r in passages.mark_passages(spark.createDataFrame(rows, "doc_id long, text string")).drop("text").collect()}
    assert found[0]["class_id"] == found[1]["class_id"] and found[2]["class_id"] is None
    assert (found[0]["passage_start"], found[0]["passage_stop"]) == (2_300_000, 2_300_080)
    assert (found[1]["passage_start"], found[1]["passage_stop"]) == (100, 180)


def test_packed_windows_are_never_narrower(spark):
    chance = np.random.default_rng(2)
    center = chance.integers(0, (1 << 31) - 1, 4000)
    reach = [chance.integers(0, 1 << 30, 4000) >> chance.integers(0, 30, 4000) for _ in range(2)]
    left, right = np.maximum(center - reach[0], 0), center + reach[1]
    place = passages.packed(left, center, right)
    low, middle, high = passages.opened(place)
    assert (middle == center).all() and (low <= left).all() and (high >= right).all() and (place >= 0).all()
    assert (low == left)[center - left < 4096].all() and (high == right)[right - center < 4096].all()
    assert ((left - low) * 2000 <= center - left).all() and ((high - right) * 2000 <= right - center).all()
    rows = spark.createDataFrame([(x,) for x in place.tolist()], "place long").select("place", *passages.unpacked("place")).collect()
    assert {tuple(r) for r in rows} == set(zip(place.tolist(), low.tolist(), middle.tolist(), high.tolist()))


def test_windows_that_agree_against_brute_force():
    chance, shape = np.random.default_rng(7), passages.Passages()
    for n, length in ((60, 300), (80, 150), (3, 90)):
        of, center = chance.integers(0, 3, n), chance.integers(0, length, n)
        left, right = center - chance.integers(0, 60, n), center + chance.integers(0, 60, n)
        left, token = np.maximum(left, 0), chance.integers(0, 6, n)
        bucket, text, place, more, gap = passages.agreed(of, token, passages.packed(left, center, right), shape)
        want = []
        for i in range(n):
            for j in range(n):
                lo, hi = max(left[i], left[j]), min(right[i], right[j])
                near = abs(center[i] // shape.least - center[j] // shape.least) <= 1
                if of[i] == of[j] and token[i] < token[j] and near and hi - lo + 1 >= shape.least and lo <= center[i] <= hi and lo <= center[j] <= hi:
                    want.append((of[i], (token[i], token[j], center[j] - center[i]), (lo, center[i], hi)))
        opened = list(zip(*[x.tolist() for x in passages.opened(place)]))
        assert sorted(zip(text.tolist(), opened)) == sorted((x, z) for x, _, z in want)
        assert len(set(bucket.tolist())) == len({y for _, y, _ in want})
        seen: dict = {}
        for b, t, w, m, g in zip(bucket.tolist(), text.tolist(), opened, more.tolist(), gap.tolist()):
            before = seen.get((b, t))
            assert m == (before is not None)
            assert g == (w[1] - before[1] if m and before[0] <= w[0] and before[2] >= w[2] else 0)
            seen[b, t] = w


def test_windows_of_fewest_shingles():
    chance = np.random.default_rng(3)
    for n in (3, 10, 31):
        values = chance.integers(0, 12, n)
        want = min(len(set(values[k : k + 10].tolist())) for k in range(max(1, n - 9)))
        assert passages.fewest(values, 10) == want
    assert passages.fewest(np.arange(30), 10) == 10 and passages.fewest(np.arange(4), 10) == 4


def test_all_passages_of_two_texts(spark):
    rows = []
    for k in range(30):
        one, two = prose(100, 9000 + k), prose(60, 9100 + k)
        for side in (0, 1):
            seed = 9200 + 10 * k + side
            words = prose(40, seed) + one + prose(20, seed + 5000) + two + prose(40, seed + 7000)
            rows.append((2 * k + side, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    starts: dict = {}
    for r in passages.mark_passages(docs).collect():
        starts.setdefault(r["doc_id"], []).append(r["passage_start"])
    whole = [sum(any(s is not None and abs(s - at) <= 3 for s in starts[d]) for at in (40, 160)) for d in starts]
    assert sum(whole) >= 0.98 * 2 * len(rows)


def test_matched_finds_every_stretch():
    chance = np.random.default_rng(4)
    one, two, three, x, y = (chance.integers(0, 1 << 62, n).astype(np.uint64) for n in (100, 60, 46, 30, 30))
    a, b = np.concatenate([one, x, two, x[:20], three]), np.concatenate([one, y, two, y[:20], three])
    assert passages.matched(a, b, passages.Passages()) == [(0, 99, 0, 99), (130, 189, 130, 189), (210, 255, 210, 255)]
    # Side by side in one text, far apart in the other.
    a, b = np.concatenate([one, two]), np.concatenate([one, x, y, two])
    assert passages.matched(a, b, passages.Passages()) == [(0, 99, 0, 99), (100, 159, 160, 219)]
    assert passages.matched(x, y, passages.Passages()) == []


def test_stretches_side_by_side_are_matched_as_each_alone():
    shape, chance, given, inside, others, stretch = passages.Passages(words=14), np.random.default_rng(6), [], [], [], []
    texts: list = []
    for kinds in (1 << 40, 1 << 40, 30, 6):
        for _ in range(40):
            parts = [chance.integers(0, kinds, n).astype(np.uint64) for n in chance.integers(1, 30, 9)]
            texts.append([np.concatenate([parts[k] for k in chance.permutation(9)[: chance.integers(4, 9)]]) for _ in range(2)])
    alone = [passages.matched(a, b, shape) for a, b in texts]
    base = 0
    for k, (a, b) in enumerate(texts):
        first = {x: i for i, x in reversed(list(enumerate(b.tolist())))}
        at = [i for i, x in enumerate(a.tolist()) if x in first]
        inside, others, stretch = inside + at, others + [first[x] for x in a[at].tolist()], stretch + [k] * len(at)
        unique = len(set(a.tolist())) == len(a) and len(set(b.tolist())) == len(b)
        given.append((1, unique, 0, len(a), 0, base, base + len(a)))
        base += len(a) + len(b)
    facts = [np.array(x) for x in zip(*given)]
    runs = passages.runs(np.array(inside), np.array(others), np.array(stretch), *facts, np.concatenate([x for t in texts for x in t]))
    found: dict = {}
    for k, *one in zip(*[x.tolist() for x in passages.matched_runs(runs, shape)]):
        found.setdefault(k, []).append(tuple(one))
    assert [sorted(found.get(k, [])) for k in range(len(texts))] == alone and sum(map(bool, alone)) > 40
    for (a, b), ends in zip(texts, alone):
        for start, stop, start2, stop2 in ends:
            x, y = set(a[start : stop + 1].tolist()), set(b[start2 : stop2 + 1].tolist())
            assert len(x & y) >= 0.8 * len(x | y) - 1e-9 and min(stop - start, stop2 - start2) + 1 >= shape.least


def test_stretches_left_are_matched_beside_new_ones():
    shape, chance = passages.Passages(words=14), np.random.default_rng(12)
    texts: list = []
    for kinds in (1 << 40, 30):
        for _ in range(30):
            parts = [chance.integers(0, kinds, n).astype(np.uint64) for n in chance.integers(1, 30, 9)]
            texts.append([np.concatenate([parts[k] for k in chance.permutation(9)[: chance.integers(4, 9)]]) for _ in range(2)])
    whole = np.concatenate([x for t in texts for x in t])
    bases = np.cumsum([0] + [len(x) for t in texts for x in t]).tolist()

    def runs_of(numbers):
        given, inside, others, stretch = [], [], [], []
        for n, k in enumerate(numbers):
            a, b = texts[k]
            first = {x: i for i, x in reversed(list(enumerate(b.tolist())))}
            at = [i for i, x in enumerate(a.tolist()) if x in first]
            inside, others, stretch = inside + at, others + [first[x] for x in a[at].tolist()], stretch + [n] * len(at)
            unique = len(set(a.tolist())) == len(a) and len(set(b.tolist())) == len(b)
            given.append((1, unique, 0, len(a), 0, bases[2 * k], bases[2 * k + 1]))
        return passages.runs(np.array(inside), np.array(others), np.array(stretch), *[np.array(x) for x in zip(*given)], whole)

    numbers = [k for k, (a, b) in enumerate(texts) if set(a.tolist()) & set(b.tolist())]
    found: dict = {}
    r, of = runs_of(numbers[:20]), np.array(numbers[:20])
    parts, carried = passages.whole_parts(r), 0
    for more in (numbers[20:40], numbers[40:], None):
        made, parts = passages.matched_parts(r, parts, shape, 15 if more else 1)
        for k, *one in zip(of[made[0]].tolist(), *[x.tolist() for x in made[1:]]):
            found.setdefault(k, []).append(tuple(one))
        if more:
            carried += len(parts[0])
            r, parts, kept = passages.both_parts(r, parts, runs_of(more))
            of = np.concatenate([of[kept], more])
    assert carried and not len(parts[0])
    assert all(sorted(found.get(k, [])) == passages.matched(*texts[k], shape) for k in numbers) and len(found) > 20


def test_a_partner_as_far_off_as_the_windows(spark):
    line = prose(7, 41)
    rows = [(k, " ".join(prose(30, 420 + k) + line * 20 + prose(30, 440 + k))) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fetched = docs.select(passages.text_key("text")[0].alias("tid"), "text")
    tids = [r["tid"] for r in fetched.select("tid").collect()]
    # The line's third to seventeenth place in one text beside the first to fifteenth in another, and twelve places of the same text.
    places = [passages.packed(*[np.array([x]) for x in window]).tolist()[0] for window in ((44, 50, 140), (30, 36, 126), (30, 36, 113))]
    given = [(tids[0], places[0], tids[1], places[1]), (tids[0], places[0], tids[2], places[2])]
    pairs = spark.createDataFrame(given, "tid long, place long, tid2 long, place2 long")
    found = {(r["tid2"], r["start"], r["stop"], r["start2"], r["stop2"]) for r in passages.verify(pairs, fetched, passages.Passages()).collect()}
    assert found == {(tids[1], 44, 140, 30, 126), (tids[2], 44, 127, 30, 113)}


def test_what_is_compared_at_once_is_bounded(spark, monkeypatch):
    sizes = np.array([5, 900_000, 0, 400_000, 400_000, 7] + [100] * 30_000)
    cut = passages.pieces(sizes)
    assert [k for x in cut for k in range(*x)] == list(range(len(sizes))) and passages.pieces(sizes[:0]) == []
    assert all(stop - start == 1 or sizes[start : stop - 1].sum() <= 500_000 + sizes[start] for start, stop in cut)
    texts = [prose(30, 300 + k) + prose(60, 9)[k % 3 :] + prose(50, 8) + prose(20, 400 + k) for k in range(12)]
    docs = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(texts)], "doc_id long, text string")
    whole = sorted(passages.mark_passages(docs).drop("text").collect(), key=str)
    verify = passages.verify
    shape = passages.Passages()
    found = passages.windows(docs, "text", shape)
    fetched = docs.select(passages.text_key("text")[0].alias("tid"), "text")
    other = found.select("token", *[passages.F.col(c).alias(f"{c}2") for c in ("tid", "place")])
    pairs = passages.stored(found.join(other, "token").filter("tid > tid2").select(*passages.PAIR))
    at_once = sorted(verify(pairs, fetched, shape).select(*passages.FOUND).distinct().collect())
    monkeypatch.setattr(passages, "SHINGLES_AT_ONCE", 100)
    assert sorted(verify(pairs, fetched, shape).select(*passages.FOUND).distinct().collect()) == at_once and len(at_once) > 20
    assert len({r["class_id"] for r in whole}) == 1


def test_windows_are_made_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    plain = passages.compact_windows

    def counted(*given):
        made.add(1)
        return plain(*given)

    docs = spark.createDataFrame([(k, " ".join(prose(60, 70 + k) + prose(60, 9))) for k in range(4)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(passages, "compact_windows", counted)
    assert len({r["class_id"] for r in passages.mark_passages(docs).collect()}) == 1
    assert made.value == passages.Passages().hashes


def test_open_windows_are_paired_by_the_cheaper_way(spark, monkeypatch):
    phrase = prose(40, 9)
    texts = [prose(60, 2000 + k) + phrase + prose(60, 3000 + k) for k in range(24)]
    for k in range(4):
        tail = prose(15, 4000 + k)
        texts += [prose(60, 5000 + 2 * k + j) + phrase + tail + prose(60, 6000 + 2 * k + j) for j in (0, 1)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    shingled, by_shingles = [], passages.window_shingles
    monkeypatch.setattr(passages, "window_shingles", lambda *a: shingled.append(1) or by_shingles(*a))
    direct = sorted(passages.mark_passages(docs).drop("text").collect(), key=str)
    assert not shingled
    assert all(any(r["doc_id"] == i and r["class_id"] for r in direct) for i in range(24, 32))
    monkeypatch.setattr(passages, "DIRECT", 0.0)
    assert sorted(passages.mark_passages(docs).drop("text").collect(), key=str) == direct and shingled


def test_a_block_has_each_text_once(spark, monkeypatch):
    ids = list(range(100, 160)) + [200, 201]
    pairs = [(a, b) for a in ids for b in ids if a > b and (a < 200) == (b < 200)]
    fetched = spark.createDataFrame([(i, "x" * 100) for i in ids], "tid long, text string")
    grouped = spark.createDataFrame(pairs, "tid long, tid2 long")
    for size, cells in ((1 << 20, 1), (5 * (passages.TEXT_BYTES + 100), 4)):
        monkeypatch.setattr(passages, "CELL_BYTES", size)
        blocks, sent = passages.in_blocks(grouped, fetched)
        blocks, sent = blocks.collect(), [(r["block"], r["block2"], r["tid"]) for r in sent.collect()]
        assert sorted((r["tid"], r["tid2"]) for r in blocks) == sorted(pairs)
        assert len(set(sent)) == len(sent)
        assert set(sent) == {(r["cell"], r["cell2"], r[x]) for r in blocks for x in ("tid", "tid2")}
        assert len({r["cell"] for r in blocks}) >= cells
    monkeypatch.setattr(passages, "CELL_BYTES", 1 << 20)
    assert len(passages.in_blocks(grouped, fetched)[1].collect()) == len(ids)


def test_fewest_different_shingles_of_a_text():
    chance = np.random.default_rng(5)
    for n, kinds in ((30, 8), (60, 40), (200, 1000), (9, 3)):
        text = chance.integers(0, kinds, n).astype(np.uint64)
        found = passages.Ordered(text, 10)
        runs = [len(np.unique(text[k : k + 10])) for k in range(n - 9)]
        assert found.unique == (len(np.unique(text)) == n)
        assert not runs or 0 < found.least <= min(runs)
    assert passages.Ordered(np.array([1, 2, 3, 4, 1], dtype=np.uint64), 4).least == 4


# ---- benchmark items ----------------------------------------------------------------

QUESTION = "A train leaves the old station with Maria on board and travels 120 km in 2 hours before Maria gets off at the river"
OTHER = "a train leaves the old station with Peter on board and travels 300 km in 5 hours before Peter gets off at the river"
MIXED = "A train leaves the old station with Peter on board and travels 300 km in 5 hours before Olga gets off at the river"


def test_contamination(spark):
    items = spark.createDataFrame(
        [(1, QUESTION), (2, " ".join(prose(30, 1))), (3, None), (4, "two words"), (5, "short item of six words")],
        "item_id long, text string",
    )
    filler = " ".join(prose(200, 3))
    texts = {
        10: (f"{filler}. {QUESTION}. {filler}", "verbatim", [1]),
        11: (f"{filler}.\n{OTHER}.", "reparameterised", [1]),
        12: (f"{filler}. {MIXED}", None, None),
        13: (filler + " " + " ".join(prose(30, 1)).upper() + " " + filler, "verbatim", [2]),
        14: (filler + " " + " ".join(prose(30, 1)[:11]), None, None),
        15: ("so. Short item of SIX words!", "verbatim", [5]),
        16: (None, None, None),
        17: ("", None, None),
        18: (filler, None, None),
        19: (f"{OTHER}; {' '.join(prose(30, 1))}", "verbatim", [1, 2]),
    }
    rows = [(k, t, "mine") for k, (t, _, _) in texts.items()] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string")
    found = decontaminate.mark_contaminated(docs.repartition(4), items).collect()
    assert len(found) == 2 * len(texts)
    for r in found:
        _, kind, ids = texts[r["doc_id"]]
        assert (r["kind"], r["item_ids"], r["contaminated"], r["_key"]) == (kind, ids, kind is not None, "mine"), r["doc_id"]
    clean = sorted({r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()})
    assert clean == [k for k, (_, kind, _) in texts.items() if kind is None]
    assert not any(r["contaminated"] for r in decontaminate.mark_contaminated(docs, items.filter("false")).collect())
    assert decontaminate.mark_contaminated(docs.filter("false"), items).count() == 0


def test_all_planted_items_are_found(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    found = {r["doc_id"]: r for r in queries.op9_decontaminate(spark, folder).collect()}
    for key, text in texts.items():
        held = [i for i, item in items.items() if item in text]
        assert set(held) <= set(found[key]["item_ids"] or [])
        if not held:
            windows = {tuple(w[i : i + 8]) for w in [text.lower().split()] for i in range(len(w) - 7)}
            near = any(tuple(w[i : i + 8]) in windows for item in items.values() for w in [item.lower().split()] for i in range(len(w) - 7))
            assert near or not found[key]["contaminated"]


CAPITAL = "What is the capital of old France today"
NAMED = "Later Maria and Peter met Olga and Ivan near the bridge"
DENSE = "12 km in 3 hours plus 40 km in 2 hours"
SMALL = "then we add 3 apples and 4 pears to the big basket"


def test_every_exact_copy_is_found(spark):
    eaten = prose(25, 71) + ["has", "5", "apples"] + prose(20, 72) + ["eats", "5", "pears"] + prose(9, 73)
    altered = list(eaten)
    altered[eaten.index("eats") + 1] = "6"
    items = {1: DENSE, 2: CAPITAL, 3: NAMED, 4: " ".join(eaten), 5: SMALL, 6: "Why not?", 7: "Peter sold 7 old books there"}
    filler = " ".join(prose(80, 74))
    texts = {
        10: (f"{filler}. {DENSE}. {filler}", "verbatim", [1]),
        11: (f"{filler} and so {CAPITAL} he said {filler}", "verbatim", [2]),
        12: (f"{filler} and so {CAPITAL.replace('France', 'Norway')} he said {filler}", "reparameterised", [2]),
        13: (f"{filler} {NAMED.lower()} {filler}", "verbatim", [3]),
        14: (f"{filler} {' '.join(altered)} {filler}", "verbatim", [4]),
        15: (f"{filler} {SMALL.replace('3', '4')} {filler}", "reparameterised", [5]),
        16: (f"{filler}. Why not? {filler}", "verbatim", [6]),
        17: (f"{filler} why not {filler}", None, None),
        18: (f"{filler}. Maria sold 12 old books there. {filler}", "reparameterised", [7]),
        19: (f"{filler}. Trains sold many old books there. {filler}", None, None),
        20: (f"- {SMALL}", "verbatim", [5]),
    }
    found = decontaminate.mark_contaminated(
        spark.createDataFrame([(k, t) for k, (t, _, _) in texts.items()], "doc_id long, text string"),
        spark.createDataFrame(list(items.items()), "item_id long, text string"),
    ).collect()
    assert {r["doc_id"]: (r["kind"], r["item_ids"]) for r in found} == {k: (kind, ids) for k, (_, kind, ids) in texts.items()}


def matched_items(text: str, items: dict[int, str], window=8, enough=13, shortest=5) -> tuple:
    """(kind, item ids) of a text: every window held against every window, word by word."""

    def words(value):
        made = []
        for line in value.split("\n"):
            start = True
            for word in line.split():
                low, mid, plain, low_type, mid_type, ends = decontaminate.RECORD.unpack(decontaminate.token(word.encode()))
                if low_type != decontaminate.NONE:
                    made.append((plain, (low, low_type) if start else (mid, mid_type), (mid, mid_type), start))
                    start = False
                start |= ends
        return made

    ours, exact, templates = words(text), [], []
    for item, value in items.items():
        theirs = words(value)
        n = min(window, len(theirs))
        by_words, by_template = set(), set()
        for shift in range(-len(theirs), len(ours) + 1):
            places = [i for i in range(len(theirs) - n + 1) if n and 0 <= i + shift <= len(ours) - n]
            met = []
            for i in places:
                a, b = theirs[i : i + n], ours[i + shift : i + shift + n]
                stop = i + shift + n
                alone = b[0][3] and (stop == len(ours) or ours[stop][3])
                if [x[0] for x in a] == [x[0] for x in b] and (n >= shortest or alone):
                    by_words.add(i)
                for r in (1, 2) if n >= shortest else ():
                    for q in (1, 2):
                        same = [x[r] for x in a] == [x[q] for x in b]
                        if same and 2 * sum(x[r][1] == decontaminate.PLAIN for x in a) >= n:
                            met.append((i, {(x[0], y[0]) for x, y in zip(a, b) if x[r][1] != decontaminate.PLAIN}))
            values: dict = {}
            for _, pairs in met:
                for x, y in pairs:
                    values.setdefault(x, set()).add(y)
            by_template |= {i for i, pairs in met if all(len(values[x]) == 1 for x, _ in pairs)}
        need = min(enough, len(theirs))

        def cover(found):
            return len({i + j for i in found for j in range(n)})

        if theirs and cover(by_words | by_template) >= need:
            templates.append(item)
        if theirs and cover(by_words) >= need:
            exact.append(item)
    return ("verbatim" if exact else "reparameterised" if templates else None), sorted(templates) or None


def test_decontamination_against_brute_force(spark, folder):
    chance = random.Random(12)
    vocabulary = "the the a of river Maria Peter Olga trains Trains 3 4 12 five km hours - sold. saw? and\nWhat What".split(" ")
    texts = [" ".join(chance.choices(vocabulary, k=chance.randrange(0, 60))) for _ in range(120)]
    items = {i: " ".join(chance.choices(vocabulary, k=chance.randrange(0, 24))) for i in range(60)}
    for i in range(60):
        copy = items[i].split(" ")
        if i % 3 and copy:
            copy[chance.randrange(len(copy))] = chance.choice(vocabulary)
        texts.append(" ".join(chance.choices(vocabulary, k=10) + copy + chance.choices(vocabulary, k=10)))
    documents = [r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    benchmark = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    for some, all_items in ((texts, items), (sorted(set(documents), key=len)[:60], dict(list(benchmark.items())[:12]))):
        found = decontaminate.mark_contaminated(
            spark.createDataFrame(list(enumerate(some)), "doc_id long, text string"),
            spark.createDataFrame(list(all_items.items()), "item_id long, text string"),
        ).collect()
        got = {r["doc_id"]: (r["kind"], r["item_ids"]) for r in found}
        assert got == {k: matched_items(t, all_items) for k, t in enumerate(some)}
