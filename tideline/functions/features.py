"""Passenger features: family, buckets and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds (exclusive) and names of the buckets, then the name above them all.
FARE_BUCKETS = ((10, "low"), (30, "medium"), (100, "high"))
FARE_TOP = "premium"
AGE_BUCKETS = ((12, "child"), (18, "teen"), (60, "adult"))
AGE_TOP = "senior"


def bucket(name: str, bounds: tuple[tuple[int, str], ...], top: str) -> Column:
    """First bucket whose bound exceeds the value. A NULL value exceeds none, so it is in ``top``."""
    chain = F
    for bound, label in bounds:
        chain = chain.when(F.col(name) < bound, F.lit(label))
    return chain.otherwise(F.lit(top))


def family_features(df: DataFrame) -> DataFrame:
    """Family size, the flags for large families and lone travellers, and the fare per head."""
    return df.withColumn("family_size", F.col("sibsp") + F.col("parch") + 1).withColumns(
        {
            "is_large_family": F.when(F.col("family_size") > 4, 1).otherwise(0),
            "is_solo": F.when(F.col("alone") == "TRUE", 1).otherwise(0),
            "fare_per_family_member": F.try_divide(F.col("fare"), F.col("family_size")),
        }
    )


def fare_age_buckets(df: DataFrame) -> DataFrame:
    """Fare and age buckets; a missing fare is ``premium`` and a missing age ``senior``."""
    return df.withColumns(
        {
            "fare_bucket": bucket("fare", FARE_BUCKETS, FARE_TOP),
            "age_bucket": bucket("age", AGE_BUCKETS, AGE_TOP),
        }
    )


def feature_flags(df: DataFrame) -> DataFrame:
    """Flags over the buckets; NULL where a needed input is NULL and the rest does not decide."""
    return df.withColumns(
        {
            "high_fare_solo": (F.col("fare_bucket") == FARE_TOP) & (F.col("is_solo") == 1),
            "first_class_child": (F.col("pclass") == 1) & (F.col("age_bucket") == "child"),
        }
    )


def all_features(df: DataFrame) -> DataFrame:
    """All derived columns; still one projection over the scan."""
    return feature_flags(fare_age_buckets(family_features(df)))
