"""Features, scores, statistics and pair totals on small frames."""

import math

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.functions.features import all_features
from tideline.functions.scoring import survival_score, survival_score_arrow
from tideline.operators import pairs, stats
from tideline.plans import passengers as pax
from tideline.sources.passengers import passengers
from tideline.sources.tables import read_table

SCHEMA = (
    "passenger_id bigint, survived int, pclass int, sex string, age double, sibsp int, parch int, "
    "fare double, embarked string, alone string"
)
NAN = float("nan")
ROWS = [
    (1, 1, 1, "FEMALE", 0.42, 0, 0, 512.3292, "C", "TRUE"),
    (2, 0, 3, "MALE", 5.42, 1, 0, 7.2292, "C", "FALSE"),
    (3, 0, 3, "MALE", None, 0, 0, None, None, "TRUE"),
    (4, 1, 2, "FEMALE", 15.0, 1, 2, 10.0, "S", "FALSE"),
    (5, None, None, None, 60.0, 5, 2, 50.0, "S", None),
    (6, 0, 1, "MALE", 61.0, 3, 1, 100.0, "Q", "FALSE"),
    (7, 1, 3, "MALE", 10.41, 0, 0, 29.99, "C", "TRUE"),
    (8, 1, 3, "MALE", NAN, 0, 0, NAN, "C", "TRUE"),
    (9, 1, 1, "FEMALE", 11.99, None, 0, 30.0, "C", "TRUE"),
]


@pytest.fixture(scope="module")
def few(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def many(spark, folder):
    return passengers(read_table(spark, "customer", folder))


def test_buckets_and_missing_values(few):
    got = {r.passenger_id: r for r in all_features(few).collect()}
    assert [got[i].fare_bucket for i in (2, 4, 7, 9, 6, 1, 3)] == [
        "low", "medium", "medium", "high", "premium", "premium", "premium"
    ]
    assert [got[i].age_bucket for i in (1, 9, 4, 5, 6, 3)] == [
        "child", "child", "teen", "senior", "senior", "senior"
    ]
    assert (got[5].is_solo, got[3].is_solo, got[6].is_large_family) == (0, 1, 1)
    assert got[9].family_size is None and got[9].is_large_family == 0
    assert got[9].fare_per_family_member is None and got[6].fare_per_family_member == 20.0
    assert (got[1].high_fare_solo, got[3].high_fare_solo, got[6].high_fare_solo) == (True, True, False)
    assert (got[1].first_class_child, got[6].first_class_child) == (True, False)
    # NULL class: unknown for a child, false for anyone else.
    assert got[5].first_class_child is False


@pytest.mark.parametrize("source", ["few", "many"])
def test_native_score_equals_function(source, request):
    df = all_features(request.getfixturevalue(source))
    both = df.select(survival_score().alias("a"), survival_score_arrow().alias("b"))
    assert both.filter("not a <=> b").count() == 0
    assert both.filter("a is null or a < 0 or a > 1").count() == 0


def test_score_by_hand(few):
    got = {r.passenger_id: r.s for r in all_features(few).select("passenger_id", survival_score().alias("s")).collect()}
    assert got[1] == 1.0
    assert got[2] == max(0.0, 0.5 - 0.2 - 0.3 + 0.2 - 0.15 + 0.1)
    assert got[3] == 0.5 - 0.2 - 0.3
    assert got[4] == 0.5 + 0.1 + 0.4 + 0.0 + 0.0 + 0.1 or got[4] == 1.0
    assert got[5] == 0.0


def test_score_stays_in_generated_code(few):
    plan = all_features(few).select(survival_score())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_missing_values_correlate_as_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None), (4.0, 8.0)], "x double, y double")
    got = {(r.feature1, r.feature2): r.correlation for r in stats.correlation_matrix(df, ("x", "y")).collect()}
    expected = df.fillna(0.0).select(F.corr("x", "y")).first()[0]
    assert got[("x", "y")] == got[("y", "x")] == pytest.approx(expected, abs=1e-12)
    assert abs(got[("x", "y")] - df.select(F.corr("x", "y")).first()[0]) > 0.1


def test_constant_column_correlates_as_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "x double, y double")
    assert all(math.isnan(r.correlation) for r in stats.correlation_matrix(df, ("x", "y")).collect())


def test_matrix_has_all_ordered_pairs(many):
    matrix = stats.correlation_matrix(all_features(many))
    assert matrix.count() == 42 and matrix.filter("feature1 = feature2").count() == 0


def test_spread_of_a_single_row_is_null(few):
    row = stats.survival_stats(all_features(few)).filter("sex = 'FEMALE' and pclass = 2").first()
    assert (row.passenger_count, row.stddev_fare, row.distinct_ports) == (1, None, 1)


def test_pivot_with_and_without_given_values(many):
    features = all_features(many)
    given = stats.pivot_survival(features, [None, "FEMALE", "MALE"])
    assert rows_of(given) == rows_of(stats.pivot_survival(features).select(*given.columns))
    assert given.columns[1:3] == ["null_survival_rate", "null_count"]


def test_absent_pivot_cells_are_null(few):
    row = stats.pivot_fare(all_features(few), [1, 2, 3]).filter("embarked = 'Q'").first()
    assert (row["1_avg_fare"], row["2_avg_fare"], row["3_max_fare"]) == (100.0, None, None)


def brute_pairs(rows):
    totals = {}
    for a in rows:
        for b in rows:
            keys = [(a[2], b[2]), (a[3], b[3]), (a[8], b[8])]
            if any(x is None or x != y for x, y in keys) or a[4] is None or b[4] is None:
                continue
            # In exact decimals: 0.42 and 5.42 are five years apart and do not pair.
            if not round(abs(a[4] - b[4]), 9) < 5:
                continue
            t = totals.setdefault((a[2], a[3]), [0, 0, 0, 0])
            for i, v in enumerate((1, a[1] or 0, b[1] or 0, (a[1] or 0) * (b[1] or 0))):
                t[i] += v
    return sorted((k[0], k[1], *map(int, v)) for k, v in totals.items())


@pytest.mark.parametrize("limit", [1000, 3])
def test_comparable_pairs_by_brute_force(few, many, limit):
    names = ["pclass", "sex", "pair_count", "p1_survived", "p2_survived", "both_survived"]
    for df, known in ((few, [r for r in ROWS if r[4] is None or not math.isnan(r[4])]), (many, None)):
        rows = known or [tuple(r) for r in df.collect()]
        got = pairs.comparable_pairs(df, limit, limit).select(*names).collect()
        assert sorted((r[0], r[1], *map(int, r[2:])) for r in got) == brute_pairs(rows)


def test_pair_totals_are_symmetric(many):
    row = pairs.comparable_pairs(many)
    assert row.filter("p1_survived <> p2_survived or p1_fare <> p2_fare").count() == 0


def test_cross_pairs_sum_to_the_square(many):
    total = pairs.cross_pair_counts(many).agg(F.sum("pair_count")).first()[0]
    assert total == many.count() ** 2
    plan = pairs.cross_pair_counts(many)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_chunked_passenger_table_equals_plain(many):
    plain = pax.passenger_transformed(many)
    assert plain.columns == [*many.columns, *pax.passenger_transformed(many, 20).columns[len(many.columns):]]
    assert rows_of(pax.passenger_transformed(many, 20)) == rows_of(plain)
