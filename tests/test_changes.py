"""Sampling, change sets and refreshes."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.operators import changes as ch
from tideline.operators.sampling import hash_sample, key_uniform
from tideline.plans import star

TARGET = "orderkey bigint, custkey bigint, orderdate date, order_revenue double"


@pytest.fixture(scope="module")
def target(spark):
    rows = [(1, 10), (2, 10), (3, 20), (4, None), (5, 30), (None, 10)]
    df = spark.createDataFrame(rows, "orderkey bigint, custkey bigint")
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.coalesce("orderkey", F.lit(0)).cast("int"))
    return df.select("orderkey", "custkey", day.alias("orderdate"), (F.col("orderkey") * 1.25).alias("order_revenue"))


@pytest.fixture(scope="module")
def changes(spark):
    rows = [
        (1, 11, "U"),  # matched update, moves to a new customer
        (2, 10, "D"),  # matched delete
        (3, 20, "I"),  # insert of an existing key: nothing
        (4, 40, None),  # no op: nothing
        (5, 30, "D"),  # last order of its customer
        (7, 70, "I"),  # new
        (8, 80, "U"),  # update of an absent key: nothing
        (9, 90, "D"),  # delete of an absent key: nothing
        (None, 10, "I"),  # NULL never matches, so it comes in
    ]
    df = spark.createDataFrame(rows, "orderkey bigint, custkey bigint, op string")
    return df.select(
        "orderkey", "custkey", F.lit("2021-06-01").cast("date").alias("orderdate"), F.lit(9.5).alias("order_revenue"), "op"
    )


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_apply(target, changes, broadcast_rows):
    merged = ch.apply_changes(target, changes, broadcast_rows=broadcast_rows)
    assert merged.columns == target.columns
    keys = sorted(((r.orderkey, r.custkey) for r in merged.collect()), key=repr)
    assert keys == sorted([(1, 11), (3, 20), (4, None), (7, 70), (None, 10), (None, 10)], key=repr)
    assert merged.filter("orderkey = 1").first().order_revenue == 9.5


def test_repeated_target_keys_all_change(target, changes):
    twice = target.unionByName(target)
    merged = ch.apply_changes(twice, changes)
    assert merged.filter("orderkey = 1 and custkey = 11").count() == 2
    assert merged.filter("orderkey in (2, 5)").count() == 0
    assert merged.filter("orderkey = 7").count() == 1


def test_repeated_change_keys_are_refused(target, changes):
    with pytest.raises(ValueError, match="several changes"):
        ch.apply_changes(target, changes.unionByName(changes))


def test_small_change_set_leaves_the_target_unshuffled(spark, target, changes):
    plan = ch.apply_changes(target, changes)._jdf.queryExecution().executedPlan().toString()
    kept = plan.split("LeftAnti")[0]
    assert "Exchange hashpartitioning" not in kept and "BroadcastHashJoin" in kept


def test_outcomes(target, changes):
    got = {(r.op, r.matched): r.changes for r in ch.merge_conflicts(target, changes).collect()}
    assert got == {("I", True): 1, (None, True): 1, ("U", False): 1, ("D", False): 1}
    every = ch.change_outcomes(target, changes)
    assert every.agg(F.sum("changes")).first()[0] == 9


def test_statement_merges_alike(target, changes):
    import duckdb

    db = duckdb.connect()
    old, new = target.toPandas(), changes.toPandas()  # noqa: F841
    kinds = "orderkey bigint, custkey bigint, orderdate date, order_revenue double"
    db.sql(f"create table facts ({kinds})")
    db.sql("insert into facts select * from old")
    db.sql(f"create table feed ({kinds}, op varchar)")
    db.sql("insert into feed select * from new")
    db.sql(ch.merge_statement("facts", "feed", target.columns))
    merged = ch.apply_changes(target, changes)
    theirs = db.sql(f"select {', '.join(sorted(target.columns))} from facts").fetchall()
    assert sorted(theirs, key=repr) == rows_of(merged)


def test_merge_into_needs_a_table_that_takes_merge(spark, changes):
    from pyspark.errors import PySparkException

    from tideline.session import scratch_database

    database = scratch_database(spark)
    changes.drop("op").write.saveAsTable(f"{database}.facts")
    try:
        with pytest.raises(PySparkException, match="MERGE"):
            ch.merge_into(changes, f"{database}.facts")
        assert not spark.catalog.tableExists("changes_of_facts")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_incremental_refresh_equals_full(target, changes, broadcast_rows):
    merged = ch.apply_changes(target, changes)
    touched = ch.touched_groups(target, changes, broadcast_rows=broadcast_rows)
    assert {r.custkey for r in touched.collect()} >= {10, 11, 30, 70}
    previous = star.agg_customer_revenue(target)
    partial = ch.refresh_touched(
        previous, merged, touched, star.agg_customer_revenue, broadcast_rows=broadcast_rows
    )
    assert rows_of(partial) == rows_of(star.agg_customer_revenue(merged))


def test_last_change_of_each_key_wins(spark):
    rows = [(1, 3, "D"), (1, 9, "U"), (2, 1, "I"), (None, 2, "U"), (None, 5, "D")] + [(7, i, "U") for i in range(500)]
    feed = spark.createDataFrame(rows, "orderkey bigint, seq int, op string").repartition(4)
    last = ch.last_per_key(feed)
    assert rows_of(last, ["orderkey", "seq", "op"]) == sorted(
        [(1, 9, "U"), (2, 1, "I"), (None, 5, "D"), (7, 499, "U")], key=repr
    )
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]


def orders(spark, n=3000):
    return spark.range(n).select(
        F.col("id").alias("orderkey"),
        (F.col("id") % 50).alias("custkey"),
        F.lit("O").alias("orderstatus"),
        F.lit(1.0).alias("totalprice"),
        F.lit("2020-01-01").cast("date").alias("orderdate"),
        F.when(F.col("id") % 2 == 0, "4-NOT SPECIFIED").alias("orderpriority"),
        F.lit(None).cast("string").alias("clerk"),
        F.lit(None).cast("int").alias("shippriority"),
        F.lit(2.0).alias("order_revenue"),
    )


@pytest.mark.parametrize("size", [0, 1, 137, 2999, 3000, 9999])
def test_sample_has_its_size_and_ignores_partitions(spark, size):
    a = hash_sample(orders(spark).repartition(3), "orderkey", size, "42")
    b = hash_sample(orders(spark).repartition(7, "custkey"), "orderkey", size, "42")
    assert a.count() == min(size, 3000)
    assert rows_of(a.select("orderkey")) == rows_of(b.select("orderkey"))


def test_sample_takes_the_smallest_hashes(spark):
    df = orders(spark)
    expected = df.orderBy(F.md5(F.concat(F.lit("42:"), F.col("orderkey").cast("string")))).limit(100)
    assert rows_of(hash_sample(df, "orderkey", 100, "42").select("orderkey")) == rows_of(expected.select("orderkey"))


def test_sample_of_repeated_keys_keeps_its_size(spark):
    df = orders(spark).withColumn("orderkey", F.lit(5))
    assert hash_sample(df, "orderkey", 100, "42").count() == 100


def test_draws_are_even(spark):
    mean, least, most = (
        orders(spark, 20000).select(key_uniform("orderkey", "42b").alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    )
    assert abs(mean - 0.5) < 0.01 and 0 <= least < 0.001 and 0.999 < most < 1


def test_feed(spark):
    feed = ch.make_changes(orders(spark), "42b")
    shares = {r.op: r["count"] / 3000 for r in ch.count_by_op(feed).collect()}
    assert abs(shares["I"] - 0.3) < 0.05 and abs(shares["D"] - 0.3) < 0.05 and abs(shares["U"] - 0.4) < 0.05
    assert feed.filter("(op = 'I') <> (orderkey >= 10000000)").count() == 0
    # A NULL priority leaves the mark alone; the mark is cut off where the text is full already.
    marks = {r[0] for r in feed.filter("op = 'U'").select("orderpriority").distinct().collect()}
    assert marks == {"upd", "4-NOT SPECIFIED-upd"}
    staged = ch.stage_changes(feed)
    assert {r[0] for r in staged.filter("op = 'U'").select("orderpriority").distinct().collect()} == {
        "upd", "4-NOT SPECIFIED"
    }
    assert "seq" not in staged.columns
    assert staged.filter("rn_latest <> 0 or revenue_rank <> 0 or rolling_30d_revenue <> 0").count() == 0
