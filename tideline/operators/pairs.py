"""Measures over pairs of passengers, without making the pairs.

The number of pairs grows with the square of the rows, and what is asked of them are
counts and sums. Both follow from per-group totals, at a cost linear in the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.columns import exact_sum
from tideline.operators.groups import FRAME_ROWS, GROUP_ROWS
from tideline.operators.ranges import point_range_sums

# Fixed value: ages of comparable passengers differ by less than this many years.
AGE_BAND = 5
# Ages are compared in whole units of 1e-14 years, about what a double of such size tells apart,
# so the band has exact, open ends.
AGE_UNITS = 10**14


def cross_pair_counts(df: DataFrame, by: str = "pclass") -> DataFrame:
    """Size of the cross product of the rows with themselves, by the first row's ``by``."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).cast("decimal(19,0)").alias("rows"))
    total = counts.select(F.sum("rows").cast("decimal(19,0)")).scalar()
    return counts.select(by, (F.col("rows") * total).alias("pair_count"))


def comparable_pairs(
    passengers: DataFrame, group_rows: int = FRAME_ROWS, chunk_rows: int = GROUP_ROWS
) -> DataFrame:
    """Totals over all ordered pairs alike in class, sex and port with ages less than 5 apart.

    A passenger pairs with itself too; an infinite age is 5 years from none, itself included. Rows are first collapsed to one per group and age;
    a range sum over the ages then gives each age the totals of its partners.
    """
    by = ["pclass", "sex", "embarked"]
    known = passengers.filter(
        F.col("pclass").isNotNull()
        & F.col("sex").isNotNull()
        & F.col("embarked").isNotNull()
        & F.col("age").isNotNull()
        & ~F.isnan("age")
        & (F.abs("age") != float("inf"))
    )
    ages = (
        known.withColumn("at", F.rint(F.col("age") * AGE_UNITS).cast("bigint"))
        .groupBy(*by, "at")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.col("survived").cast("bigint")), F.lit(0)).alias("s"),
            F.coalesce(exact_sum(F.col("fare")), F.lit(0)).alias("f"),
        )
    )
    reach = AGE_BAND * AGE_UNITS - 1
    sums = {"n2": "n", "s2": "s", "f2": "f"}
    paired = point_range_sums(ages, by, "at", -reach, reach, sums, group_rows, chunk_rows)

    def product(a: str, b: str):
        return F.sum(F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)"))

    def fares(count: str, fare: str):
        return F.sum(F.col(count).cast("decimal(19,0)") * F.col(fare))

    return paired.groupBy("pclass", "sex").agg(
        product("n", "n2").alias("pair_count"),
        product("s", "n2").alias("p1_survived"),
        product("n", "s2").alias("p2_survived"),
        product("s", "s2").alias("both_survived"),
        fares("n2", "f").alias("p1_fare"),
        fares("n", "f2").alias("p2_fare"),
    )
