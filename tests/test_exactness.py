"""Results that hang neither on the size of a table nor on its values being kind."""

import math
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.functions import columns as cols
from tideline.operators import changes as ch
from tideline.operators import pairs, sinks, stats
from tideline.operators import windows as w
from tideline.operators.ranges import plain_range_sums
from tideline.plans import passengers as pax
from tideline.plans import run, star
from tideline.session import fresh_folder, scratch_database
from tideline.sources import formats, tables
from tideline.sources.passengers import cast_passengers

EVERYTHING = {
    "rn": w.ROW_NUMBER, "rk": w.RANK, "dr": w.DENSE_RANK, "pr": w.PERCENT_RANK, "total": w.running_sum("value"),
    "near": w.centred_avg("value"),
}


def ways(df, measures=EVERYTHING, chunk_rows=(37, 250)):
    order = w.Order("value", "key")
    yield w.plain_windows(df, ["g"], order, measures)
    for rows in chunk_rows:
        yield w.chunked_windows(df, ["g"], order, measures, rows)


@pytest.mark.parametrize(
    "value",
    [
        "CAST(id % 3001 AS DOUBLE) / 100 + 0.1",
        "CAST(9007199254740992 + id % 5 AS BIGINT)",
        "CAST(CAST(id % 700 AS DECIMAL(20,2)) / 7 AS DECIMAL(20,2))",
        "CASE WHEN id % 50 = 0 THEN CAST('NaN' AS DOUBLE) WHEN id % 77 = 0 THEN NULL ELSE id * 0.7D END",
        "CASE WHEN id = 500 THEN CAST('Infinity' AS DOUBLE) ELSE id * 0.01D END",
    ],
)
def test_windows_do_not_hang_on_cuts(spark, value):
    df = spark.range(1500).selectExpr("id AS key", "id % 2 AS g", f"{value} AS value").repartition(7)
    first, *others = ways(df)
    for other in others:
        assert other.dtypes == first.dtypes
        assert rows_of(other) == rows_of(first)


def test_running_sums_in_cents_are_exact(spark):
    df = spark.range(1000).selectExpr("id AS key", "1 AS g", "CAST(0.1 AS DOUBLE) AS value")
    for made in ways(df, {"total": w.running_sum("value")}):
        assert sorted(r["total"] for r in made.collect()) == [k / 10 for k in range(1, 1001)]


def test_exact_sum_rounds_nothing_away(spark):
    small = spark.range(1000).select(F.lit(0.00004).alias("x"))
    assert small.agg(cols.exact_sum(F.col("x"))).first()[0] == Decimal("0.0400")
    assert small.agg(cols.exact_sum(F.col("x"), 5)).first()[0] == Decimal("0.04000")
    mixed = spark.createDataFrame([(0.1,), (0.00005,), (-7.00001,), (12345.6789,)], "x double")
    assert mixed.agg(cols.exact_sum(F.col("x"), 5)).first()[0] == Decimal("12338.77894")


def test_amounts_that_are_no_numbers_make_their_group_null(spark):
    rows = [(1, 2.5), (1, 1.0), (2, 1.0), (2, float("nan")), (3, float("inf")), (4, None), (5, None), (5, 0.12345)]
    df = spark.createDataFrame(rows, "g int, x double")
    found = {r["g"]: r["s"] for r in df.groupBy("g").agg(cols.exact_sum(F.col("x")).alias("s")).collect()}
    assert found == {1: Decimal("3.5000"), 2: None, 3: None, 4: None, 5: Decimal("0.1235")}


def test_running_sums_keep_small_digits(spark):
    df = spark.range(200).selectExpr("id AS key", "1 AS g", "CAST(1e-13 AS DOUBLE) AS value")
    for made in ways(df, {"total": w.running_sum("value")}):
        got = sorted(r["total"] for r in made.collect())
        assert all(math.isclose(x, k * 1e-13, rel_tol=1e-15) for k, x in enumerate(got, 1))
    assert 0 < got[0] < 2e-13


def test_pivots_show_every_value(spark):
    rows = [(1, "X", 0.0, 1), (4, None, 1.0, 0), (None, "MALE", 2.0, 1)]
    df = spark.createDataFrame(rows, "pclass int, sex string, fare double, survived int").withColumn("embarked", F.lit("S"))
    assert {"X_count", "null_count", "MALE_count"} <= set(stats.pivot_survival(df).columns)
    assert {"1_max_fare", "4_max_fare", "null_max_fare"} <= set(stats.pivot_fare(df).columns)


def test_columns_are_not_dropped(spark):
    database = scratch_database(spark)
    try:
        sinks.insert_overwrite(spark.range(3), f"{database}.t")
        with pytest.raises(ValueError, match="columns"):
            sinks.insert_overwrite(spark.range(3).withColumn("more", F.lit(1)), f"{database}.t")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    target = spark.createDataFrame([(1, "a")], "orderkey long, x string")
    extra = spark.createDataFrame([(1, "b", "U", 5)], "orderkey long, x string, op string, more int")
    with pytest.raises(ValueError, match="more"):
        ch.apply_changes(target, extra)
    assert ch.apply_changes(target, extra.drop("more").select("op", "x", "orderkey")).first()["x"] == "b"


def test_age_band_ends(spark):
    ages = [0.3333333, 5.3333330, 5.3333333, 10.0, 5.0, float("inf"), 0.1, 5.1]
    df = spark.createDataFrame([(a, 1.0, 1) for a in ages], "age double, fare double, survived int")
    df = df.withColumns({"pclass": F.lit(1), "sex": F.lit("MALE"), "embarked": F.lit("S")})
    want = sum(abs(a - b) < 5 for a in ages for b in ages if not math.isinf(a) and not math.isinf(b))
    assert pairs.comparable_pairs(df).first()["pair_count"] == want


def test_lenient_casts(spark):
    texts = ["3.0", " 4 ", "1e1", "99999999999", "-2.9", "x", None, ""]
    names = ("age", "fare", "survived", "pclass", "sibsp", "parch")
    df = spark.createDataFrame([(t,) * 6 for t in texts], ", ".join(f"{n} string" for n in names))
    assert [r["pclass"] for r in cast_passengers(df).collect()] == [3, 4, 10, None, -2, None, None, None]


def test_csv_keeps_line_breaks(spark):
    texts = ["a\nb", "a\\nb", "\\", "\\\\n\r\n", "\\N", "", None, '"q", x', " pad "]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    path = fresh_folder(spark, "breaks")
    formats.write_files(df, path, "csv")
    assert [r["t"] for r in formats.read_files(spark, path, "csv", df.schema).orderBy("n").collect()] == texts


def test_damaged_table_is_noted(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/orders.parquet")
    (tmp_path / "nation.parquet").write_bytes(b"this is no parquet file, not at all")
    loaded = tables.load_tables(spark, str(tmp_path), ["orders", "nation", "region"])
    assert set(loaded.tables) == {"orders"} and loaded.missing["region"] == "no such table"
    assert loaded.missing["nation"] != "no such table"
    with pytest.raises(KeyError, match="nation: "):
        loaded["nation"]
    assert tables.table_exists(spark, "nation", str(tmp_path)) and not tables.table_exists(spark, "region", str(tmp_path))


def test_rolling_sum_of_a_busy_month(spark):
    """Rows without a date see one another only; a month of orders of one customer takes seconds."""
    day = F.date_add(F.lit("1998-01-01").cast("date"), (F.col("id") % 45).cast("int"))
    orders = spark.range(20_000).select(
        F.col("id").alias("orderkey"), F.lit(1).alias("custkey"),
        F.when(F.col("id") % 500 != 7, day).alias("orderdate"), (F.col("id") % 90 * F.lit(0.25)).cast("decimal(28,4)").alias("order_revenue"),
    )
    found = star.order_windows(orders).collect()
    per_day: dict = {}
    for r in found:
        per_day[r["orderdate"]] = per_day.get(r["orderdate"], 0) + r["order_revenue"]
    for r in found[::97] + [r for r in found if r["orderdate"] is None]:
        near = [v for d, v in per_day.items() if d is None and r["orderdate"] is None
                or d is not None and r["orderdate"] is not None and 0 <= (r["orderdate"] - d).days <= 30]
        assert r["rolling_30d_revenue"] == sum(near)


def test_range_sums_of_nothing_are_null(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 5, 2), (1, None, 7), (1, None, None)], "g int, at int, v int")
    made = plain_range_sums(df, ["g"], "at", -3, 3, {"s": "v"})
    assert sorted(rows_of(made, ["at", "s"]), key=repr) == sorted([(0, None), (5, 2), (None, 7), (None, 7)], key=repr)


def test_no_window_over_all_rows_in_one_task(spark, folder):
    people = tables.read_table(spark, "customer", folder).selectExpr("c_custkey AS passenger_id", "c_acctbal AS fare")
    by, order = pax.BY_ALL
    made = w.window_columns(people, list(by), order, pax.GLOBAL_PERCENTILE)
    # Only the summaries of the chunks, a row each, meet in one task.
    plan = made._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "SinglePartition" in line]
    assert all("HashAggregate" in line and "_rows" in line for line in below)
    assert rows_of(made) == rows_of(w.plain_windows(people, list(by), order, pax.GLOBAL_PERCENTILE))


def test_jobs_as_a_program(spark, folder):
    name = scratch_database(spark)
    try:
        star_rows = run.run(spark, run.arguments(["star", "--source", folder, "--database", name]))
        changed = run.run(spark, run.arguments(["changes", "--database", name, "--size", "50", "--seed", "3"]))
        assert star_rows["fact_orders"] == 1500 and changed["staged_changes"] <= 50
        assert tables.list_databases(spark).filter(F.col("namespace") == name).count() == 1
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
