"""The star schema's facts and totals as versioned tables, and a change cycle that can be repeated.

Each step of a cycle commits one version that notes the batch. A cycle that stopped anywhere is run
again with the same batch: steps that were committed are passed over, and the totals follow from
the two versions of the facts, not from the run that made them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import changes as ch
from tideline.operators import retract
from tideline.operators.changes import BROADCAST_ROWS, hinted, is_small
from tideline.operators.sampling import hash_sample
from tideline.operators.versions import VersionedTable
from tideline.plans import star
from tideline.plans.jobs import SAMPLE_SIZE, SEED, STAGED
from tideline.sources.tables import Loaded

FACTS, STATE = "fact_orders", "customer_state"


def table(spark: SparkSession, root: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{root}/{name}")


def build_versioned_star(spark: SparkSession, loaded: Loaded, root: str, n_files: int | None = None) -> dict[str, int]:
    """Facts in files by order key, and the state of the totals in files by customer."""
    facts, state = table(spark, root, FACTS), table(spark, root, STATE)
    written = facts.replace(star.fact_orders(loaded["orders"], loaded["lineitem"]), "orderkey", n_files=n_files)
    counted = state.replace(retract.customer_state(facts.read(written.number)), "custkey", n_files=n_files)
    return {FACTS: written.done["rows"], STATE: counted.done["rows"]}


def staged_batch(spark: SparkSession, root: str, batch: str, size: int, seed: int) -> DataFrame:
    """The staged changes of a batch: made from the facts the first time, read again later."""
    facts, staged = table(spark, root, FACTS), table(spark, root, STAGED)
    if not staged.exists() or batch not in staged.version().batches:
        sample = hash_sample(facts.read().select(*star.ORDER_COLUMNS), "orderkey", size, str(seed))
        staged.replace(ch.stage_changes(ch.last_per_key(ch.make_changes(sample, f"{seed}b"))), batch=batch, n_files=1)
    return staged.read(staged.version().batches[batch]["version"])


def run_versioned_cycle(spark: SparkSession, root: str, batch: str | None = None, size: int = SAMPLE_SIZE, seed: int = SEED) -> dict[str, dict]:
    """Stage, merge by file, refresh by retraction. Run again with a batch that is done, it changes nothing.

    Returns what each table's version noted for the batch.
    """
    batch = batch or f"cycle-{seed}"
    facts, state = table(spark, root, FACTS), table(spark, root, STATE)
    changes = staged_batch(spark, root, batch, size, seed)
    note = facts.merge(changes, batch=batch).batches[batch]
    held = state.version()
    if batch not in held.batches:
        moved = facts.difference(note["base"], note["version"])
        after = facts.read(note["version"])
        # Files are rewritten whole; rows of other keys are on both sides and cancel out.
        keys = changes.select(F.col("orderkey").alias("_m"))
        small = is_small(keys, BROADCAST_ROWS)

        def of_keys(rows: DataFrame) -> DataFrame:
            return rows.join(hinted(keys, small), F.col("orderkey").eqNullSafe(F.col("_m")), "left_semi")

        renewed = retract.state_changes(state.read(held.number), of_keys(moved.removed), of_keys(moved.added), lambda some: retract.of_customers(after, some))
        held = state.merge(renewed, "custkey", batch, "null_safe")
    return {FACTS: note, STATE: held.batches[batch]}


def totals(spark: SparkSession, root: str) -> DataFrame:
    """The totals of the newest version."""
    return retract.totals_of(table(spark, root, STATE).read())
