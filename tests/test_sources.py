"""Table loading, files, schema helpers."""

import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.functions import columns as cols
from tideline.session import fresh_folder
from tideline.sources import formats, tables
from tideline.sources.passengers import cast_passengers, passengers, passengers_as_text


def test_missing_table_is_noted_and_the_rest_load(spark, folder):
    loaded = tables.load_tables(spark, folder)
    assert set(loaded.missing) == {"partsupp"}
    assert set(loaded.tables) == set(tables.STAR_TABLES) - {"partsupp"}
    counts = {r.table_name: r.row_count for r in tables.table_inventory(spark, loaded).collect()}
    assert counts["partsupp"] is None and counts["region"] == 5


def test_catalog_tables_load_too(spark):
    spark.range(3).createOrReplaceTempView("region")
    try:
        loaded = tables.load_tables(spark, names=("region", "no_such_table"))
        assert set(loaded.tables) == {"region"} and set(loaded.missing) == {"no_such_table"}
        listed = tables.list_catalog(spark).filter("tableName = 'region'").first()
        assert listed.isTemporary
    finally:
        spark.catalog.dropTempView("region")


def test_columns_are_lowered(spark):
    assert tables.lower_columns(spark.range(1).toDF("ID")).columns == ["id"]


def test_only_needed_columns_are_read(spark, folder):
    plan = tables.read_table(spark, "lineitem", folder).select("l_orderkey").filter("l_orderkey > 5")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in text and "GreaterThan(l_orderkey,5)" in text


@pytest.mark.parametrize("file_format", formats.FORMATS)
def test_files_keep_every_value(spark, file_format):
    rows = [
        (1, "plain", 0.1, dt.datetime(2020, 1, 2, 3, 4, 5)),
        (2, "", 1e300, None),
        (3, None, None, dt.datetime(1969, 12, 31, 23, 59, 59, 123456)),
        (4, 'a "quoted", line\\with', -0.0, dt.datetime(2020, 1, 1)),
        (5, " spaced ", 2.0, None),
    ]
    df = spark.createDataFrame(rows, "id int, t string, x double, at timestamp_ntz")
    path = fresh_folder(spark, file_format)
    formats.write_files(df, path, file_format)
    assert rows_of(formats.read_files(spark, path, file_format, df.schema)) == rows_of(df)


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError):
        formats.write_files(spark.range(1), "/nowhere", "avro")


def test_malformed_numbers_become_null(spark, folder):
    typed = passengers(tables.read_table(spark, "customer", folder))
    again = cast_passengers(passengers_as_text(typed))
    assert again.dtypes == typed.dtypes
    expected = typed.withColumns(
        {
            "age": F.when(F.col("passenger_id") % 211 != 0, F.col("age")),
            "parch": F.when(F.col("passenger_id") % 223 != 0, F.col("parch")),
        }
    )
    assert rows_of(again) == rows_of(expected)


def test_duplicate_columns(spark):
    df = spark.range(1).select(
        F.lit(1).alias("a"), F.lit(2).alias("b"), F.lit(3).alias("A"), F.lit(4).alias("a"), F.lit(5).alias("a_dedup_1")
    )
    renamed = cols.dedupe_columns(df)
    assert renamed.columns == ["a", "b", "A_dedup_2", "a_dedup_3", "a_dedup_1"]
    assert renamed.first().asDict() == {"a": 1, "b": 2, "A_dedup_2": 3, "a_dedup_3": 4, "a_dedup_1": 5}
    dropped = cols.dedupe_columns(df, "drop")
    assert dropped.columns == ["a", "b", "a_dedup_1"] and tuple(dropped.first()) == (1, 2, 5)
    with pytest.raises(ValueError):
        cols.dedupe_columns(df, "merge")


def test_types_widen(spark):
    df = spark.range(1).selectExpr(
        "cast(1 as byte) b", "cast(1 as short) s", "1 i", "cast(0.5 as float) f", "'x' t", "cast(1 as decimal(5,2)) d"
    )
    assert [t for _, t in cols.widen_types(df).dtypes] == [
        "bigint", "bigint", "bigint", "double", "string", "decimal(5,2)"
    ]


def test_exact_sum(spark):
    values = [0.1] * 1000 + [-0.3, 12345.6789, -12345.6789, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert str(df.agg(cols.exact_sum(F.col("x"))).first()[0]) == "99.7000"
    assert df.filter("x is null").agg(cols.exact_sum(F.col("x"))).first()[0] is None


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "timestamp"])
def test_epoch_seconds(spark, kind):
    text = "1969-12-30" if kind == "date" else "1969-12-30 00:00:07"
    df = spark.range(1).select(F.lit(text).cast(kind).alias("at"))
    expected = -2 * 86400 + (0 if kind == "date" else 7)
    assert df.select(cols.epoch_seconds(df, "at")).first()[0] == expected
    late = spark.range(1).select(F.lit("2100-01-01").cast(kind).alias("at"))
    assert late.select(cols.epoch_seconds(late, "at")).first()[0] == 4102444800
