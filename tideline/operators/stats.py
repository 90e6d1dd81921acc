"""Grouped statistics, pivots and correlations over passengers."""

from __future__ import annotations

from itertools import combinations
from math import nan

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tideline.operators.groups import stored

# The columns correlated with one another.
CORRELATED = ("survived", "pclass", "age", "sibsp", "parch", "fare", "family_size")


def survival_stats(features: DataFrame) -> DataFrame:
    """Counts, averages and fare spread by class, sex, age bucket and fare bucket."""
    return features.groupBy("pclass", "sex", "age_bucket", "fare_bucket").agg(
        F.count(F.lit(1)).alias("passenger_count"),
        F.avg("survived").alias("survival_rate"),
        F.avg("fare").alias("avg_fare"),
        F.stddev("fare").alias("stddev_fare"),
        F.min("fare").alias("min_fare"),
        F.max("fare").alias("max_fare"),
        F.avg("age").alias("avg_age"),
        F.count_distinct("embarked").alias("distinct_ports"),
    )


def cohort_analysis(features: DataFrame) -> DataFrame:
    """Survivors, sexes and fares by port and class."""
    return (
        features.groupBy("embarked", "pclass")
        .agg(
            F.sum("survived").alias("survivors"),
            F.count(F.lit(1)).alias("total_passengers"),
            F.avg("fare").alias("avg_fare"),
            F.count_if(F.col("sex") == "MALE").alias("male_count"),
            F.count_if(F.col("sex") == "FEMALE").alias("female_count"),
        )
        .withColumn("survival_rate", F.try_divide("survivors", "total_passengers"))
    )


def family_patterns(features: DataFrame) -> DataFrame:
    """Survival and fares by family size and class."""
    return features.groupBy("family_size", "pclass").agg(
        F.avg("survived").alias("family_survival_rate"),
        F.count(F.lit(1)).alias("family_count"),
        F.avg("fare").alias("avg_fare_paid"),
    )


# Columns that a pivot may have per aggregate; more values stop it.
PIVOT_VALUES = 10_000


def pivot_once(df: DataFrame, by: str, pivot: str, wanted: dict[str, Column]) -> DataFrame:
    """Aggregates per group, a set of columns for every value of ``pivot``, from one pass over ``df``.

    The cells (one per group and value) are aggregated and stored; the values are observed in that
    same pass and need no job of their own. NULL groups and a NULL value have their cells. Columns
    are named and ordered as Spark's pivot does; an absent cell is NULL.
    """
    seen = Observation()
    cells = df.groupBy(by, pivot).agg(*[column.alias(name) for name, column in wanted.items()])
    observed = cells.observe(seen, F.collect_set(pivot).alias("values"), F.count_if(F.col(pivot).isNull()).alias("nulls"))
    held = stored(observed)
    values = sorted(seen.get["values"])
    if len(values) > PIVOT_VALUES:
        raise ValueError(f"{pivot} has {len(values)} values, more than {PIVOT_VALUES} columns")
    if seen.get["nulls"]:
        values = [None, *values]
    if not values:
        return held.select(by).distinct()
    return held.groupBy(by).pivot(pivot, values).agg(*[F.first(name).alias(name) for name in wanted])


def pivot_survival(features: DataFrame, sexes: list[str | None] | None = None) -> DataFrame:
    """Survival rate and count per class, one pair of columns per sex.

    Not given the values, they are found in the pass that aggregates. A NULL sex has columns of its own.
    """
    wanted = {"survival_rate": F.avg("survived"), "count": F.count(F.lit(1))}
    return _pivoted(features, "pclass", "sex", sexes, wanted)


def pivot_fare(features: DataFrame, classes: list[int | None] | None = None) -> DataFrame:
    """Average and largest fare per port, one pair of columns per class."""
    wanted = {"avg_fare": F.avg("fare"), "max_fare": F.max("fare")}
    return _pivoted(features, "embarked", "pclass", classes, wanted)


def _pivoted(df: DataFrame, by: str, pivot: str, values: list | None, wanted: dict[str, Column]) -> DataFrame:
    if values is None:
        return pivot_once(df, by, pivot, wanted)
    return df.groupBy(by).pivot(pivot, values).agg(*[column.alias(name) for name, column in wanted.items()])


def correlation_matrix(df: DataFrame, columns: tuple[str, ...] = CORRELATED) -> DataFrame:
    """Pearson correlation of every ordered pair of different columns, NULL counting as 0.

    One aggregate over one scan computes all pairs; the single row it leaves is turned into
    one row per pair. A constant column correlates as NaN.
    """
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    moments: list[Column] = [F.stddev_pop(c).alias(f"sd_{c}") for c in columns]
    moments += [F.covar_pop(a, b).alias(f"cov_{a}_{b}") for a, b in combinations(columns, 2)]

    def entry(first: str, second: str) -> Column:
        a, b = sorted((first, second), key=columns.index)
        value = F.try_divide(F.col(f"cov_{a}_{b}"), F.col(f"sd_{a}") * F.col(f"sd_{b}"))
        return F.struct(
            F.lit(first).alias("feature1"),
            F.lit(second).alias("feature2"),
            F.coalesce(value, F.lit(nan)).alias("correlation"),
        )

    pairs = [entry(a, b) for a in columns for b in columns if a != b]
    return filled.agg(*moments).select(F.inline(F.array(*pairs)))
