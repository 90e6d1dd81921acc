"""Customer totals kept as state that takes additions and retractions.

The state of a customer holds what its totals are made of: rows, orders, exact revenue, the last
order date and how many rows have it. A change of the facts is two sets of rows, removed and added.
Only customers whose last date lost all its rows are counted anew from the facts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.columns import exact_sum
from tideline.operators.changes import BROADCAST_ROWS, hinted, is_small
from tideline.operators.groups import stored

REVENUE = "decimal(28,4)"
STATE = ["custkey", "n_rows", "order_cnt", "lifetime_revenue", "priced", "last_order_date", "rows_at_last"]


def customer_state(fact: DataFrame) -> DataFrame:
    """The state of every customer, from all facts. An order key counts once per customer."""
    keys = fact.groupBy("custkey", "orderkey", "orderdate").agg(
        F.count(F.lit(1)).alias("rows"), exact_sum(F.col("order_revenue")).alias("revenue"), F.count("order_revenue").alias("priced")
    )
    dates = keys.groupBy("custkey", "orderdate").agg(
        F.sum("rows").alias("rows"),
        F.sum("revenue").alias("revenue"),
        F.sum("priced").alias("priced"),
    )
    made = dates.groupBy("custkey").agg(
        F.sum("rows").alias("n_rows"),
        F.sum("revenue").cast(REVENUE).alias("lifetime_revenue"),
        F.sum("priced").alias("priced"),
        F.max("orderdate").alias("last_order_date"),
        F.coalesce(F.max_by("rows", "orderdate"), F.lit(0)).alias("rows_at_last"),
    )
    orders = fact.groupBy(F.col("custkey").alias("_c")).agg(F.count_distinct("orderkey").alias("order_cnt"))
    return made.join(orders, F.col("custkey").eqNullSafe(F.col("_c"))).select(*STATE)


def totals_of(state: DataFrame) -> DataFrame:
    """The totals as ``agg_customer_revenue`` gives them."""
    revenue = F.when(F.col("priced") > 0, F.col("lifetime_revenue").cast("double"))
    return state.select("custkey", "order_cnt", revenue.alias("lifetime_revenue"), "last_order_date")


def signed(removed: DataFrame, added: DataFrame) -> DataFrame:
    """What the totals need of the rows taken out (-1) and put in (1)."""
    columns = ["custkey", "orderkey", "orderdate", "order_revenue"]
    return removed.select(*columns, F.lit(-1).alias("_sign")).unionByName(added.select(*columns, F.lit(1).alias("_sign")))


def state_changes(
    state: DataFrame,
    removed: DataFrame,
    added: DataFrame,
    facts_of: Callable[[DataFrame], DataFrame],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Changes (``op`` I, U, D) that take the state from the facts before to the facts after; stored.

    ``removed`` and ``added`` hold the rows that differ, and may hold others on both sides: these
    cancel out. Of an order key that differs, all rows have to be there. ``facts_of(customers)``
    reads the facts after the change of given customers (a column ``custkey``); it is asked only for
    those whose last date lost all its rows and who got no later one, and only their dates count.
    """
    moved = stored(signed(removed, added))
    small = is_small(moved, broadcast_rows)
    sign, revenue = F.col("_sign"), F.col("order_revenue")

    def keys(which: int) -> Column:
        return F.count_distinct(F.when(sign == which, F.col("orderkey")))

    sums = moved.groupBy(F.col("custkey").alias("_c")).agg(
        F.sum(sign).alias("_rows"),
        (keys(1) - keys(-1)).alias("_orders"),
        F.coalesce(exact_sum(F.when(sign == 1, revenue).otherwise(-revenue)), F.lit(0).cast(REVENUE)).alias("_revenue"),
        F.sum(F.when(revenue.isNotNull(), sign).otherwise(0)).alias("_priced"),
    )
    held = state.join(hinted(moved.select(F.col("custkey").alias("_t")), small), F.col("custkey").eqNullSafe(F.col("_t")), "left_semi")
    by_date = moved.filter("orderdate IS NOT NULL").groupBy(F.col("custkey").alias("_d"), F.col("orderdate").alias("_date")).agg(F.sum(sign).alias("_net"))
    by_date = by_date.filter("_net != 0")
    latest = by_date.filter("_net > 0").groupBy(F.col("_d").alias("_e")).agg(F.max("_date").alias("_late"), F.max_by("_net", "_date").alias("_at_late"))
    joined = (
        sums.join(held, F.col("_c").eqNullSafe(F.col("custkey")), "left")
        .join(latest, F.col("_c").eqNullSafe(F.col("_e")), "left")
        .join(by_date, F.col("_c").eqNullSafe(F.col("_d")) & (F.col("last_order_date") == F.col("_date")), "left")
    )

    def plus(before: str, more: str) -> Column:
        return F.coalesce(F.col(before), F.lit(0)) + F.coalesce(F.col(more), F.lit(0))

    last, late = F.col("last_order_date"), F.col("_late")
    at_last, n_rows = plus("rows_at_last", "_net"), plus("n_rows", "_rows")
    later = F.coalesce(late.isNotNull() & (last.isNull() | (late > last)), F.lit(False))
    differs = (F.col("_rows") != 0) | (F.col("_orders") != 0) | (F.col("_revenue") != 0) | (F.col("_priced") != 0) | F.col("_net").isNotNull() | late.isNotNull()
    worked = stored(
        joined.filter(differs).select(
            F.col("_c").alias("custkey"),
            n_rows.alias("n_rows"),
            plus("order_cnt", "_orders").alias("order_cnt"),
            plus("lifetime_revenue", "_revenue").cast(REVENUE).alias("lifetime_revenue"),
            plus("priced", "_priced").alias("priced"),
            F.when(later, late).otherwise(last).alias("last_order_date"),
            F.when(later, F.col("_at_late")).otherwise(at_last).alias("rows_at_last"),
            F.col("n_rows").isNotNull().alias("_known"),
            F.coalesce(last.isNotNull() & ~later & (at_last <= 0) & (n_rows > 0), F.lit(False)).alias("_lost"),
        )
    )
    operation = F.when(F.col("n_rows") <= 0, "D").when(F.col("_known"), "U").otherwise("I").alias("op")
    settled = worked.filter("NOT _lost AND (_known OR n_rows > 0)").select(*STATE, operation)
    lost = worked.filter("_lost")
    if lost.isEmpty():
        return settled
    again = facts_of(hinted(lost.select("custkey"), small)).groupBy(F.col("custkey").alias("_c"), F.col("orderdate").alias("_date")).agg(F.count(F.lit(1)).alias("_n"))
    again = again.groupBy("_c").agg(F.max("_date").alias("_last"), F.coalesce(F.max_by("_n", "_date"), F.lit(0)).alias("_at"))
    renewed = lost.join(again, F.col("custkey").eqNullSafe(F.col("_c"))).drop("last_order_date", "rows_at_last")
    renewed = renewed.withColumnsRenamed({"_last": "last_order_date", "_at": "rows_at_last"}).select(*STATE, F.lit("U").alias("op"))
    return stored(settled.unionByName(renewed))


def with_changes(state: DataFrame, changes: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The state after its changes."""
    touched = hinted(changes.select(F.col("custkey").alias("_t")), is_small(changes, broadcast_rows))
    rest = state.join(touched, F.col("custkey").eqNullSafe(F.col("_t")), "left_anti")
    return rest.unionByName(changes.filter("op != 'D'").select(*STATE))


def of_customers(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """The facts of given customers."""
    return facts.join(customers.withColumnRenamed("custkey", "_t"), F.col("custkey").eqNullSafe(F.col("_t")), "left_semi")


@dataclass(frozen=True)
class Moved:
    """Rows that changes take out of a table and put in, and the keys whose rows they are."""

    removed: DataFrame
    added: DataFrame
    keys: DataFrame
    small: bool

    def facts_of(self, target: DataFrame, customers: DataFrame, key: str = "orderkey") -> DataFrame:
        """Facts after the change of given customers, without making the table."""
        stays = of_customers(target, customers).join(hinted(self.keys, self.small), F.col(key) == F.col("_k"), "left_anti")
        return stays.unionByName(of_customers(self.added, customers))


def moved_rows(target: DataFrame, changes: DataFrame, key: str = "orderkey", broadcast_rows: int = BROADCAST_ROWS) -> Moved:
    """What changes move in a table, found by one pass over it.

    The rows of changed keys are stored; they are no more than the changes unless keys repeat.
    """
    small = is_small(changes, broadcast_rows)
    wanted = changes.select(F.col(key).alias("_k"), F.col("op").alias("_op"), F.struct(*target.columns).alias("_new"))
    met = stored(target.join(hinted(wanted, small), F.col(key) == F.col("_k")))
    moving = met.filter("_op IN ('U', 'D')")
    new = changes.filter("op = 'I'").join(hinted(met.select("_k"), small), F.col(key) == F.col("_k"), "left_anti")
    added = met.filter("_op = 'U'").select("_new.*").unionByName(new.select(*target.columns))
    return Moved(moving.select(*target.columns), added, moving.select("_k"), small)
