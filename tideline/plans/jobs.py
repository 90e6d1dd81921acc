"""Whole jobs that write tables. Each output is written once and read back by what follows.

Every job returns the rows of each table it wrote, counted by the writes themselves.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tideline.operators import changes as ch
from tideline.operators import sinks, stats
from tideline.operators.groups import GROUP_ROWS, stored
from tideline.operators.sampling import hash_sample
from tideline.plans import star
from tideline.plans.passengers import passenger_transformed
from tideline.sources.passengers import passengers
from tideline.sources.tables import Loaded

SAMPLE_SIZE = 5000
SEED = 42
STAGED = "staged_changes"


def build_star_schema(
    spark: SparkSession, loaded: Loaded, database: str
) -> dict[str, int]:
    """Write dim_customer, fact_orders and, from the written facts, agg_customer_revenue."""
    geography = star.customer_geography(loaded["customer"], loaded["nation"], loaded["region"])
    fact = star.fact_orders(loaded["orders"], loaded["lineitem"])
    written = {
        "dim_customer": sinks.overwrite_table(
            star.dim_customer(geography), f"{database}.dim_customer"
        ),
        "fact_orders": sinks.overwrite_table(fact, f"{database}.fact_orders"),
    }
    totals = star.agg_customer_revenue(spark.table(f"{database}.fact_orders"))
    written["agg_customer_revenue"] = sinks.overwrite_table(
        totals, f"{database}.agg_customer_revenue"
    )
    return written


def run_change_cycle(
    spark: SparkSession, database: str, size: int = SAMPLE_SIZE, seed: int = SEED
) -> dict[str, int]:
    """Simulate changes, stage them, merge them into the facts and refresh the totals.

    Only the totals of customers touched by a change are recomputed.
    """
    fact, totals, staged = (
        f"{database}.{t}" for t in ("fact_orders", "agg_customer_revenue", STAGED)
    )
    sample = hash_sample(
        spark.table(fact).select(*star.ORDER_COLUMNS), "orderkey", size, str(seed)
    )
    feed = ch.last_per_key(ch.make_changes(sample, f"{seed}b"))
    sinks.insert_overwrite(ch.stage_changes(feed), staged)

    changes = spark.table(staged)
    target = spark.table(fact)
    touched = stored(ch.touched_groups(target, changes))
    written = {STAGED: changes.count()}
    written["fact_orders"] = sinks.overwrite_table(ch.apply_changes(target, changes), fact)
    refreshed = ch.refresh_touched(
        spark.table(totals), spark.table(fact), touched, star.agg_customer_revenue
    )
    written["agg_customer_revenue"] = sinks.overwrite_table(refreshed, totals)
    return written


def build_passenger_marts(
    spark: SparkSession, loaded: Loaded, database: str, group_rows: int = GROUP_ROWS
) -> dict[str, int]:
    """Write passenger_transformed and, from it, the three statistics tables."""
    table = f"{database}.passenger_transformed"
    records = passengers(loaded["customer"])
    written = {
        "passenger_transformed": sinks.overwrite_table(
            passenger_transformed(records, group_rows), table
        )
    }
    features = spark.table(table)
    for name, mart in (
        ("survival_statistics", stats.survival_stats),
        ("cohort_analysis", stats.cohort_analysis),
        ("family_survival_patterns", stats.family_patterns),
    ):
        written[name] = sinks.overwrite_table(mart(features), f"{database}.{name}")
    return written


def audit(spark: SparkSession, written: dict[str, int]):
    """The counts of a job as rows."""
    rows = [(name, count) for name, count in written.items()]
    return spark.createDataFrame(rows, "table_name string, row_count bigint").select(
        F.col("table_name"), F.col("row_count")
    )
