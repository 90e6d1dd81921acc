"""Chunked windows and range sums against plain Spark windows."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.operators import windows as w
from tideline.operators.groups import hot_groups
from tideline.operators.ranges import (
    collapsed_range_sums,
    plain_range_sums,
    range_sums,
    swept_range_sums,
)

MEASURES = {
    "rn": w.ROW_NUMBER,
    "rk": w.RANK,
    "dr": w.DENSE_RANK,
    "pr": w.PERCENT_RANK,
    "total": w.running_sum("amount"),
    "near": w.centred_avg("other"),
    "prev": w.lag("amount"),
    "next": w.lead("amount"),
}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, a third of all rows with one value, NULL groups and values."""
    n = F.col("id")
    h = F.xxhash64("id")
    return spark.range(6000).select(
        n.alias("key"),
        F.when(n % 3 == 0, "hot").when(n % 41 == 0, None).otherwise(F.concat(F.lit("g"), n % 7)).alias("g"),
        F.when(n % 17 == 0, None)
        .when(F.pmod(h, F.lit(3)) == 0, F.lit(50.25))
        .otherwise(F.pmod(h, F.lit(400)) / 4)
        .alias("value"),
        F.when(n % 13 == 0, None).otherwise(F.pmod(h, F.lit(97)) * 0.25).alias("amount"),
        F.when(n % 5 < 3, F.pmod(h, F.lit(31)) * 0.5).alias("other"),
    ).repartition(5, "key")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [["g"], []])
def test_chunked_equals_plain(skewed, by, descending):
    order = w.Order("value", "key", descending)
    plain = w.plain_windows(skewed, by, order, MEASURES)
    chunked = w.chunked_windows(skewed, by, order, MEASURES, chunk_rows=150)
    assert chunked.columns == plain.columns
    assert chunked.dtypes == plain.dtypes
    assert rows_of(chunked) == rows_of(plain)


@pytest.mark.parametrize("few_groups", [0, 1000])
def test_only_hot_groups_are_chunked(skewed, monkeypatch, few_groups):
    monkeypatch.setattr(w, "FEW_GROUPS", few_groups)
    assert [r.g for r in hot_groups(skewed, ["g"], 1500).collect()] == ["hot"]
    assert hot_groups(skewed, ["g"], 100_000) is None
    order = w.Order("value", "key")
    mixed = w.window_columns(skewed, ["g"], order, MEASURES, group_rows=1500)
    assert rows_of(mixed) == rows_of(w.plain_windows(skewed, ["g"], order, MEASURES))


def test_group_sizes(skewed):
    from tideline.operators.groups import group_sizes

    tagged = skewed.withColumn("h", F.col("key") % 2)
    sizes = group_sizes(tagged, ["g"], [], ["h", "g"], ["h"])
    for by, size in zip((["g"], [], ["h", "g"], ["h"]), sizes):
        counts = [r["count"] for r in tagged.groupBy(*by).count().collect()]
        assert size == (len(counts), max(counts))
    assert group_sizes(skewed, []) == [(1, 6000)]
    assert group_sizes(skewed.filter("false"), ["g"]) == [(0, 0)]


def test_no_chunk_is_large(skewed):
    rows = w.plan_cuts(skewed, w.Order("value", "key"), 200)(skewed)
    sizes = rows.groupBy("_vb", "_kb").count().agg(F.max("count")).first()[0]
    assert sizes <= 600


def test_nan_follows_numbers(spark):
    df = spark.createDataFrame(
        [(i, float("nan") if i % 3 == 0 else (None if i % 7 == 0 else float(i % 5))) for i in range(200)],
        "key bigint, value double",
    )
    measures = {"rn": w.ROW_NUMBER, "rk": w.RANK, "dr": w.DENSE_RANK}
    for descending in (False, True):
        order = w.Order("value", "key", descending)
        plain = w.plain_windows(df, [], order, measures)
        assert rows_of(w.chunked_windows(df, [], order, measures, 20)) == rows_of(plain)


@pytest.mark.parametrize("descending", [False, True])
def test_signed_zeros_and_infinities(spark, descending):
    values = [0.0, -0.0, float("inf"), float("-inf"), 0.0, -0.0, 1.5, -1.5, None, float("nan")]
    df = spark.createDataFrame([(i, values[i % 10]) for i in range(400)], "key bigint, value double")
    order = w.Order("value", "key", descending)
    measures = {"rn": w.ROW_NUMBER, "rk": w.RANK, "dr": w.DENSE_RANK, "pr": w.PERCENT_RANK}
    plain = w.plain_windows(df, [], order, measures).drop("value")
    assert rows_of(w.chunked_windows(df, [], order, measures, 15).drop("value")) == rows_of(plain)


def test_one_row_and_no_row(spark):
    one = spark.createDataFrame([(1, 2.0)], "key bigint, value double")
    order = w.Order("value", "key")
    result = w.chunked_windows(one, [], order, {"pr": w.PERCENT_RANK, "p": w.lag("value")}, 10).first()
    assert (result.pr, result.p) == (0.0, None)
    assert w.chunked_windows(one.filter("false"), [], order, {"rk": w.RANK}, 10).count() == 0


@pytest.fixture(scope="module")
def stamped(spark):
    n = F.col("id")
    h = F.xxhash64("id")
    return spark.range(4000).select(
        n.alias("key"),
        F.when(n % 3 == 0, 0).when(n % 43 == 0, None).otherwise(n % 9).alias("c"),
        F.when(n % 29 == 0, None).when(n % 4 == 0, F.lit(500)).otherwise(F.pmod(h, F.lit(900))).alias("at"),
        F.when(n % 6 == 0, None).otherwise((F.pmod(h, F.lit(1000)) / 100).cast("decimal(15,2)")).alias("r"),
    )


def test_range_sums_agree(stamped):
    plain = plain_range_sums(stamped, ["c"], "at", -30, 0, {"s": "r"})
    for rows in (400, 100, 5):
        assert rows_of(range_sums(stamped, ["c"], "at", -30, 0, {"s": "r"}, rows)) == rows_of(plain)
    collapsed = collapsed_range_sums(stamped, ["c"], "at", -30, 0, {"s": "r"}, 20)
    assert rows_of(collapsed) == rows_of(plain)


def test_range_sums_without_groups(stamped):
    plain = plain_range_sums(stamped, [], "at", -3, 3, {"s": "r"})
    assert rows_of(range_sums(stamped, [], "at", -3, 3, {"s": "r"}, 100, 100)) == rows_of(plain)


def test_swept_range_sums(stamped):
    points = stamped.groupBy("c", "at").agg(F.sum("r").alias("r"), F.count(F.lit(1)).alias("n"))
    sums = {"s": "r", "m": "n"}
    plain = plain_range_sums(points, ["c"], "at", -7, 7, sums)
    swept = swept_range_sums(points, ["c"], "at", -7, 7, sums, 50)
    assert rows_of(swept) == rows_of(plain)
