"""Language ID, quality classifier and fertility rules."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import fertility, langid, quality_model, queries

EDGES = [(1, None, "en"), (1, None, "en"), (2, "", None), (3, "12 34 !?", "de"), (4, "word", None), (None, "héllo wörld " * 3000, "xx")]


@pytest.fixture()
def edges(spark):
    return spark.createDataFrame(EDGES, "doc_id long, text string, lang string").selectExpr("*", "7 AS score", "8 AS tid")


def test_phrases_are_those_of_greedy_parsing():
    passages = {"a": ["abracadabra alakazam"], "b": ["sim sala bim hokus"]}
    model = langid.learn(passages)
    table = langid.symbol_table(model.letters)
    texts = ["abra sala", "hokus pokus", "zzz", "Éé abracadabra", "q", "x" * 3000 + " sim"]
    counts = langid.phrases([langid.normalise(t, table) for t in texts], model)
    learnt = [bytes(langid.normalise(" ".join(passages[k]), table)) for k in model.languages]
    for row, known in zip(counts, learnt):
        for count, text in zip(row, texts):
            symbols, want = bytes(langid.normalise(text, table)), 0
            for begin in range(0, len(symbols), langid.BLOCK):
                block = symbols[begin : begin + langid.BLOCK]
                at = 0
                while at < len(block):
                    size = 1
                    while at + size < len(block) and block[at : at + size + 1] in known:
                        size += 1
                    want, at = want + 1, at + size
            assert count == want, (text, known)


def test_languages_held_out(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = queries.op1_language(spark, folder).join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_edges(spark, edges):
    model = spark.sparkContext.broadcast(langid.learn({"en": ["hello word and more"], "de": ["hallo wort und mehr"]}))
    rows = langid.predict(edges, model).collect()
    assert [r["lang_pred"] for r in rows][:4] == ["und"] * 4
    assert rows[4]["lang_pred"] == "en" and rows[0] == rows[1] and rows[0]["tid"] == 8
    nothing = spark.sparkContext.broadcast(langid.learn(langid.learning_sample(edges.filter("false"))))
    assert {r["lang_pred"] for r in langid.predict(edges, nothing).collect()} == {"und"}
    assert langid.predict(edges.filter("false"), model).count() == 0


def test_sample_is_bounded_and_hangs_on_texts_only(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text", "lang")
    one = langid.learning_sample(docs, passages=5, chars=40)
    two = langid.learning_sample(docs.repartition(7), passages=5, chars=40)
    assert one == two and all(len(p) <= 5 and all(len(x) <= 40 for x in p) for p in one.values())


def test_copies_do_not_push_a_language_out(spark):
    plain = {f"l{k}": " ".join(chr(97 + (k * 3 + i * j) % 26) * 3 for i, j in zip(range(30), range(3, 33))) for k in range(8)}
    docs = spark.createDataFrame([(t, k) for k, t in plain.items()], "text string, lang string").crossJoin(spark.range(3000))
    sample = langid.learning_sample(docs.select("text", "lang").repartition(4))
    assert sorted(sample) == sorted(plain) and all(len(found) == 1 for found in sample.values())


def test_predictions_against_plain_parsing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy(F.length("text")).limit(60)
    sample = {k: found[:4] for k, found in langid.learning_sample(docs, passages=4, chars=200).items()}
    model = langid.learn(sample)
    table = langid.symbol_table(model.letters)
    learnt = {k: bytes(langid.normalise(" ".join(sample[k]), table)) for k in sorted(sample)}
    rows = langid.predict(docs, spark.sparkContext.broadcast(model)).collect()
    assert len(learnt) > 1 and len(rows) == 60
    for r in rows:
        symbols, bits = bytes(langid.normalise(r["text"] or "", table)), []
        for known in learnt.values():
            count = 0
            for begin in range(0, len(symbols), langid.BLOCK):
                block = symbols[begin : begin + langid.BLOCK]
                while block:
                    size = 1
                    while size < len(block) and block[: size + 1] in known:
                        size += 1
                    count, block = count + 1, block[size:]
            bits.append(count * math.log2(max(2, len(known))))
        if symbols:
            assert r["lang_pred"] == list(learnt)[bits.index(min(bits))]
            assert r["score"] == pytest.approx(1 / sum(2 ** (min(bits) - b) for b in bits))
        else:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)


def test_scores_against_a_plain_forward_pass(spark):
    sample = [("good words of a good text here", 1), ("bad bad bad spam spam buy", 0), ("calm plain prose", 1), ("spam buy buy", 0)]
    weights, bias = quality_model.learn(sample, {0: 30, 1: 10})
    texts = ["good plain words", "buy spam buy buy", "", None, "h\u00e9llo h\u00e9llo x", "word " * 5000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = quality_model.score(docs, spark.sparkContext.broadcast((weights, bias))).collect()
    for r in rows:
        words, total, n = (r["text"] or "").encode().split(), 0.0, 0
        for i, word in enumerate(words):
            marked = f"<{word.decode()}>"
            grams = [marked[j : j + size] for size in (3, 4, 5) for j in range(len(marked) - size + 1)]
            buckets = [zlib.crc32(word) % quality_model.BUCKETS] + [zlib.crc32(g.encode()) % quality_model.BUCKETS for g in grams]
            buckets += [quality_model.REPEAT] * (i > 0 and words[i - 1] == word)
            total, n = total + sum(weights[b] for b in buckets), n + len(buckets)
        want = 1 / (1 + math.exp(-(bias + (total / n if n else 0.0))))
        assert r["score"] == pytest.approx(want) and r["predicted"] == (want >= 0.5)


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = queries.op5_quality(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert found.count() == docs.count()
    held = found.filter("held_out").join(labels, "doc_id").collect()
    right = np.array([r["predicted"] == r["quality"] for r in held])
    assert right.mean() > 0.93
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in found.collect())


def test_quality_edges(spark, edges):
    labels = spark.createDataFrame([(4, 1), (3, 0), (None, 1), (9, None), (1, 5)], "doc_id long, quality int")
    sample, counts = quality_model.learning_sample(edges, labels, "doc_id", "quality")
    assert sorted(sample) == [("12 34 !?", 0), ("word", 1)] and counts == {0: 1, 1: 1}
    model = spark.sparkContext.broadcast(quality_model.learn(sample, counts))
    rows = quality_model.score(edges, model).collect()
    assert rows[0]["score"] == rows[1]["score"] == rows[2]["score"] == 0.5 and rows[0]["predicted"] == 1
    assert rows[4]["score"] > 0.5 > rows[3]["score"]
    empty = quality_model.learn(*quality_model.learning_sample(edges, labels.filter("false"), "doc_id", "quality"))
    assert quality_model.score(edges, spark.sparkContext.broadcast(empty)).first()["score"] == 0.5


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
        len(words) < 10 or 100 * len(repeated) > 20 * len(words),
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_fertility_base(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in queries.op6_fertility(spark, folder).collect():
        assert tuple(row[c] for c in BASE) == base(texts[row["doc_id"]])
        assert not (row["kept"] and row["base_failed"])


def test_fertility_edges(spark, edges):
    odd = "a\u00a0b\x1cc d\x0be\n \n x x x x x x x x x x x\nd\nd #*|"
    more = spark.createDataFrame([(9, odd, "en", 7, 8)], edges.schema)
    rows = fertility.judge_quality(edges.unionAll(more)).collect()
    assert len(rows) == 7
    for row in rows:
        assert tuple(row[c] for c in BASE) == base(row["text"]) and row["tid"] == 8
    assert fertility.judge_quality(edges.filter("false")).count() == 0


def test_bands_reject_what_is_odd_for_its_language(spark):
    good = [(i, " ".join(f"water{'ing' * (i % 3)} the garden plant{j % 9}{'s' * (j % 2)}" for j in range(20 + i % 5)), "en") for i in range(300)]
    bad = [(1000, " ".join(f"QZX{j}&&&%%% ###$$${j}" for j in range(40)), "en"), (1001, " ".join(f"\u0c85\u0ca8{j}" for j in range(60)), "en")]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    bands = fertility.Bands(max_repeat_percent=100)
    kept = {r["doc_id"]: r["kept"] for r in fertility.judge_quality(docs, bands).collect()}
    assert all(kept[i] for i in range(300)) and not kept[1000] and not kept[1001]


def test_short_and_lone_texts_are_judged(spark):
    good = [(i, " ".join(f"water{'ing' * (i % 3)} the garden plant{j % 9}{'s' * (j % 2)}" for j in range(20 + i % 5)), "en") for i in range(300)]
    short = " ".join("\u0c85\u0ca8\u0c95\u0cb2" for _ in range(11))
    lone = " ".join(f"\u0c85\u0ca8{j}\u0c95" for j in range(60))
    rows = [*good, (1000, short, "en"), (1001, lone, "kn"), (1002, "the water in the garden is for the plants of it", "xx"), (1003, good[0][1], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in fertility.judge_quality(docs, fertility.Bands(max_repeat_percent=100)).collect()}
    assert not kept[1000] and not kept[1001] and kept[1002] and kept[1003]


def verdicts(rows, bands=fertility.Bands()):
    """Kept or not by sorting the measures of each group; ``rows`` carry the features."""
    def size(r):
        return int(math.log2(max(r["n_tokens"], 1)))

    keys = [lambda r: (r["lang"] or "", size(r)), lambda r: r["lang"] or "", lambda r: r["script"], size, lambda r: 0]
    ends = []
    for number, key in enumerate(keys):
        groups: dict = {}
        for r in rows:
            if not r["base_failed"]:
                groups.setdefault(key(r), []).append(r)
        found = {}
        for k, some in groups.items():
            if len(some) < (1 if number == 4 else bands.least_rows):
                continue
            q = {}
            for m in fertility.MEASURES:
                values = sorted(math.floor(r[m] * 100 + 0.5) / 100 for r in some)
                q[m] = [values[math.ceil(len(values) * share) - 1] for share in (0.25, 0.75)]
            wide = {m: bands.spread * (b - a) for m, (a, b) in q.items()}
            found[k] = (
                q["chars_per_token"][0] - wide["chars_per_token"] - bands.chars_margin,
                q["chars_per_token"][1] + wide["chars_per_token"] + bands.chars_margin,
                q["byte_share"][1] + wide["byte_share"] + bands.byte_margin,
                q["token_entropy"][0] - wide["token_entropy"] - bands.entropy_margin,
            )
        ends.append(found)
    made = {}
    for r in rows:
        at = [found.get(key(r)) for key, found in zip(keys, ends)]
        few, many, most, _ = next(x for i, x in enumerate(at) if x and i != 3) if any(at) else (None,) * 4
        entropy = next((x[3] for x in (at[0], at[3], at[4]) if x), None)
        error = bands.errors * (bands.like_size if at[0] else 1) / math.sqrt(max(r["n_tokens"], 1))
        slack = [few is not None and v for v in (
            few is not None and (few - error * bands.token_chars) - r["chars_per_token"],
            few is not None and r["chars_per_token"] - (many + error * bands.token_chars),
            few is not None and r["byte_share"] - (most + error * math.sqrt(most * max(1 - most, 0))),
            entropy is not None and (entropy - error * bands.token_bits) - r["token_entropy"],
        )]
        made[r["doc_id"]] = (not r["base_failed"] and not any(x > 0 for x in slack), min(abs(x) for x in slack))
    return made


@pytest.mark.parametrize("least_rows", [100, 15])
def test_verdicts_against_sorted_groups(spark, folder, least_rows):
    bands = fertility.Bands(least_rows=least_rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet").drop("n_chars", "source")
    rows = fertility.judge_quality(docs, bands).collect()
    want = verdicts([r.asDict() for r in rows], bands)
    for r in rows:
        kept, margin = want[r["doc_id"]]
        assert r["kept"] == kept or margin < 0.02
    assert 0 < sum(not r["kept"] and not r["base_failed"] for r in rows) < len(rows) / 2


def test_columns_of_the_contract_come_first(spark, folder):
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert queries.op6_fertility(spark, folder).columns[:8] == first
    first = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert queries.op2_chat(spark, folder).columns[:6] == first


def test_quartiles_are_exact(spark):
    df = spark.range(1, 1001).selectExpr("1 AS g", *[f"id / 100.0D AS {m}" for m in fertility.MEASURES])
    row = fertility.quartiles(df, ["g"]).first()
    assert (row["_ll_chars_per_token_q1"], row["_ll_chars_per_token_q3"], row["_ll_rows"]) == (2.5, 7.5, 1000)
