"""The pipeline, stage by stage, against plain versions of its stages."""

import pytest
from test_duplicates import classes, deleted
from test_packing import check

import corpus_pipeline
from tideline.llm import fertility
from tideline.operators.groups import stored

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(stored(stage(spark, made[-1], FOLDER)))
    return made


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "near_duplicates"


def test_rules(stages):
    judged = fertility.judge_quality(stages[0]).filter("kept")
    assert texts(stages[1]) == texts(judged)


def test_lines(stages):
    before = dict(sorted(texts(stages[1]).items()))
    cut = dict(zip(before, deleted(list(before.values()))))
    assert texts(stages[2]) == {k: t for k, t in cut.items() if t == before[k] or t.split()}
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect() if r["text"] != before[r["doc_id"]])


def test_near_duplicates(stages):
    before = dict(sorted(texts(stages[2]).items()))
    keys = list(before)
    want, _ = classes(list(before.values()))
    assert texts(stages[3]) == {keys[i]: before[keys[i]] for i in sorted(set(want))}


def test_leaks(spark, stages):
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before, after = texts(stages[3]), texts(stages[4])
    assert after.items() <= before.items()
    assert not any(item in text for item in items for text in after.values())
    for key in set(before) - set(after):
        words = before[key].lower().split()
        windows = {tuple(words[i : i + 6]) for i in range(len(words) - 5)}
        assert any(tuple(w[i : i + 6]) in windows for item in items for w in [item.lower().split()] for i in range(len(w) - 5))


def test_packing(stages):
    check(stages[5].collect(), texts(stages[4]))


def test_run(spark, stages):
    made = corpus_pipeline.run(spark, FOLDER).select("doc_id", "start", "length", "ids_crc32")
    want = stages[5].select("doc_id", "start", "length", "ids_crc32")
    assert sorted(made.collect()) == sorted(want.collect())


EDGES = [(None, "plain text of no particular interest that is long enough to pass the rules of words", "en", "s", 9, 1, 2)] * 2 + [
    (1, None, "en", "s", None, 1, 2), (2, "", None, None, 0, 1, 2), (3, " \n\t\n", "en", "s", 4, 1, 2), (3, " \n\t\n", "en", "s", 4, 1, 2),
    (4, "one two three four five six seven eight nine ten eleven twelve\nand a second line of words here", "en", "s", 1, 1, 2),
    (4, "one two three four five six seven eight nine ten eleven twelve\nand a second line of words here", "en", "s", 1, 1, 2),
    (5, "ua " * 30_000, "en", "s", 1, 1, 2),
]
KINDS = "doc_id long, text string, lang string, source string, n_chars long, component int, tid int"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, name, stage):
    docs = stored(spark.createDataFrame(EDGES, KINDS))
    found = stage(spark, docs, FOLDER).collect()
    empty = stage(spark, docs.filter("false"), FOLDER)
    assert empty.count() == 0
    ids = sorted((r["doc_id"] or 0) for r in found)
    if name == "packing":
        assert len({r["sequence_id"] for r in found}) >= 1 and {r["doc_id"] for r in found} == {None, 1, 2, 3, 4, 5}
        return
    assert empty.columns == docs.columns
    if name == "quality_rules":
        assert ids == [0, 0, 4, 4]
    elif name == "line_dedup":
        # One NULL id and one 4 lose all their lines; the long text has one line.
        assert ids == [0, 1, 2, 3, 3, 4, 5]
    elif name == "near_duplicates":
        assert len(ids) == len(set(ids)) and set(ids) <= {0, 1, 2, 3, 4, 5} and {0, 4, 5} <= set(ids)
    else:
        assert ids == [0, 0, 1, 2, 3, 3, 4, 4, 5]


def test_a_stage_deletes_what_earlier_ones_left(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    lazily = corpus_pipeline.repeated_lines(spark, corpus_pipeline.quality_rules(spark, docs, FOLDER), FOLDER)
    assert len(corpus_pipeline.LEFT) == 2
    written = stored(lazily)
    corpus_pipeline.release(written)
    assert corpus_pipeline.LEFT == [] and written.count() > 0
