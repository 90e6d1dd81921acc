"""Passenger table and its marts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tideline.functions.features import all_features
from tideline.functions.scoring import survival_score, survival_score_arrow
from tideline.operators import windows as w
from tideline.operators.groups import GROUP_ROWS

FARE = w.Order("fare", "passenger_id")
AGE = w.Order("age", "passenger_id")

BY_CLASS = (("pclass",), FARE)
BY_SEX_CLASS = (("sex", "pclass"), AGE)
BY_PORT = (("embarked",), FARE)
BY_ALL = ((), FARE)

FARE_RANKS = {"fare_rank_by_class": w.RANK, "fare_percentile_by_class": w.PERCENT_RANK}
AGE_RANK = {"age_rank_by_sex_class": w.DENSE_RANK}
FARE_CUMSUM = {"fare_cumsum_by_embark": w.running_sum("fare")}
AGE_MOVING_AVG = {"age_moving_avg_3": w.centred_avg("age")}
FARE_NEIGHBOURS = {"fare_lag_1": w.lag("fare"), "fare_lead_1": w.lead("fare")}
GLOBAL_PERCENTILE = {"global_fare_percentile": w.PERCENT_RANK}

WINDOW_STEPS = [
    w.Step(*BY_CLASS, FARE_RANKS | AGE_MOVING_AVG | FARE_NEIGHBOURS),
    w.Step(*BY_SEX_CLASS, AGE_RANK),
    w.Step(*BY_PORT, FARE_CUMSUM),
    w.Step(*BY_ALL, GLOBAL_PERCENTILE),
]


def passenger_windows(passengers: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """All eight window columns."""
    return w.window_steps(passengers, WINDOW_STEPS, group_rows)


def passenger_transformed(passengers: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Passengers with window columns, features and score."""
    featured = all_features(passenger_windows(passengers, group_rows))
    return featured.withColumn("survival_score", survival_score())


def passenger_features(passengers: DataFrame) -> DataFrame:
    """Passengers with features only: what the statistics need."""
    return all_features(passengers)


def score_with(passengers: DataFrame, score) -> DataFrame:
    """Passenger id and score, by the native expression or the Arrow function."""
    return all_features(passengers).select("passenger_id", score.alias("survival_score"))


def scored_natively(passengers: DataFrame) -> DataFrame:
    return score_with(passengers, survival_score())


def scored_by_function(passengers: DataFrame) -> DataFrame:
    return score_with(passengers, survival_score_arrow())
