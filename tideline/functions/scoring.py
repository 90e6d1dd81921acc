"""Rule-based survival score, as a native expression and as an Arrow function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Fixed values of the score.
BASE = 0.5
CLASS_POINTS = {1: 0.3, 2: 0.1}
OTHER_CLASS = -0.2
FEMALE_POINTS = 0.4
OTHER_SEX = -0.3
YOUNG_BELOW, YOUNG_POINTS = 15, 0.2
OLD_ABOVE, OLD_POINTS = 60, -0.1
FARE_ABOVE, HIGH_FARE_POINTS = 50, 0.15
FARE_BELOW, LOW_FARE_POINTS = 10, -0.15
SMALL_FAMILY, SMALL_FAMILY_POINTS = (2, 4), 0.1
LARGE_FAMILY_POINTS = -0.15

SCORE_INPUTS = ("pclass", "sex", "age", "fare", "family_size")


def survival_score() -> Column:
    """The score in Spark expressions: no Python worker, inside whole-stage codegen.

    The additions run in a fixed order, so the doubles equal those of
    ``survival_score_arrow`` bit for bit. A NaN age or fare earns nothing.
    """
    pclass, age, fare, family = (F.col(c) for c in ("pclass", "age", "fare", "family_size"))
    class_points = F
    for value, points in CLASS_POINTS.items():
        class_points = class_points.when(pclass == value, F.lit(points))
    low, high = SMALL_FAMILY
    score = (
        F.lit(BASE)
        + class_points.otherwise(F.lit(OTHER_CLASS))
        + F.when(F.col("sex") == "FEMALE", F.lit(FEMALE_POINTS)).otherwise(F.lit(OTHER_SEX))
        + F.when(age < YOUNG_BELOW, F.lit(YOUNG_POINTS))
        .when((age > OLD_ABOVE) & ~F.isnan(age), F.lit(OLD_POINTS))
        .otherwise(F.lit(0.0))
        + F.when((fare > FARE_ABOVE) & ~F.isnan(fare), F.lit(HIGH_FARE_POINTS))
        .when(fare < FARE_BELOW, F.lit(LOW_FARE_POINTS))
        .otherwise(F.lit(0.0))
        + F.when(family.between(low, high), F.lit(SMALL_FAMILY_POINTS))
        .when(family > high, F.lit(LARGE_FAMILY_POINTS))
        .otherwise(F.lit(0.0))
    )
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))


def survival_score_arrow() -> Column:
    """The score in pandas, one Arrow batch at a time.

    Defined inside, so Spark ships the function itself and workers need not import this module.
    """

    @F.pandas_udf(DoubleType())
    def score(
        pclass: pd.Series, sex: pd.Series, age: pd.Series, fare: pd.Series, family: pd.Series
    ) -> pd.Series:
        low, high = SMALL_FAMILY
        total = BASE + pclass.map(CLASS_POINTS).fillna(OTHER_CLASS)
        total += sex.eq("FEMALE").map({True: FEMALE_POINTS, False: OTHER_SEX})
        total += age.lt(YOUNG_BELOW) * YOUNG_POINTS + age.gt(OLD_ABOVE) * OLD_POINTS
        total += fare.gt(FARE_ABOVE) * HIGH_FARE_POINTS + fare.lt(FARE_BELOW) * LOW_FARE_POINTS
        total += family.between(low, high) * SMALL_FAMILY_POINTS + family.gt(high) * LARGE_FAMILY_POINTS
        return total.clip(0.0, 1.0)

    return score(*[F.col(c) for c in SCORE_INPUTS])


def discounted_price(price: str, discount: str) -> Column:
    """A function over one struct argument (price, discount), read by position."""

    @F.pandas_udf(DoubleType())
    def discounted(priced: pd.DataFrame) -> pd.Series:
        return priced.iloc[:, 0] * (1 - priced.iloc[:, 1])

    return discounted(F.struct(price, discount))
