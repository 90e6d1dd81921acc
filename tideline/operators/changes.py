"""Insert/update/delete change sets: making, de-duplicating, applying, refreshing.

A change set has the target's columns and ``op``, one of I, U and D.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.sampling import key_number, key_uniform

# Fixed values of the simulated feed.
INSERT_BELOW = 0.30
DELETE_BELOW = 0.60
INSERT_KEY_OFFSET = 10_000_000
UPDATE_MARK = "upd"
STATUS_WIDTH, PRIORITY_WIDTH, CLERK_WIDTH = 10, 15, 15

# A change set up to this many rows and bytes is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def make_changes(sample: DataFrame, salt: str) -> DataFrame:
    """Turn sampled orders into changes: 30% inserts, 30% deletes, 40% updates.

    Inserts get a new key and updates a mark on the priority. ``seq`` orders changes of one
    key; all draws hang on the key, so a repeated task produces the same feed.
    """
    draw = key_uniform("orderkey", salt)
    op = F.when(draw < INSERT_BELOW, "I").when(draw < DELETE_BELOW, "D").otherwise("U")
    marked = F.concat_ws("-", F.col("orderpriority"), F.lit(UPDATE_MARK))
    return sample.withColumns({"op": op, "seq": key_number("orderkey", salt)}).withColumns(
        {
            "orderkey": F.when(F.col("op") == "I", F.col("orderkey") + INSERT_KEY_OFFSET).otherwise(
                F.col("orderkey")
            ),
            "orderpriority": F.when(F.col("op") == "U", marked).otherwise(F.col("orderpriority")),
        }
    )


def count_by_op(changes: DataFrame) -> DataFrame:
    """Changes per operation."""
    return changes.groupBy("op").count()


def last_per_key(changes: DataFrame, key: str = "orderkey", seq: str = "seq") -> DataFrame:
    """The change with the greatest ``seq`` of each key.

    Spark keeps one row per key and task before the shuffle, so a key that holds a large
    part of the feed costs no more than any other.
    """
    others = [F.col(c).desc() for c in changes.columns if c not in (key, seq)]
    newest = Window.partitionBy(key).orderBy(F.col(seq).desc(), *others)
    return (
        changes.withColumn("_place", F.row_number().over(newest)).filter("_place = 1").drop("_place")
    )


def stage_changes(changes: DataFrame) -> DataFrame:
    """Align changes with the fact table: cut texts to width, zero the window columns, drop ``seq``."""
    return changes.drop("seq").withColumns(
        {
            "orderstatus": F.substring("orderstatus", 1, STATUS_WIDTH),
            "orderpriority": F.substring("orderpriority", 1, PRIORITY_WIDTH),
            "clerk": F.substring("clerk", 1, CLERK_WIDTH),
            "rn_latest": F.lit(0).cast("bigint"),
            "revenue_rank": F.lit(0).cast("bigint"),
            "rolling_30d_revenue": F.lit(0.0),
        }
    )


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory: 16 bytes a column, and its texts."""
    texts = [F.col(f.name) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts]
    return sum(sizes, F.lit(16 * (1 + len(df.columns)))).cast("bigint")


def inspect_changes(changes: DataFrame, key: str = "orderkey", rows: int = BROADCAST_ROWS) -> bool:
    """Whether a change set is small; refuses one in which a key occurs twice.

    Applying such a set would be ambiguous. NULL keys match nothing and may repeat.
    """
    per_key = changes.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(row_bytes(changes)).alias("_bytes"))
    repeated = F.when(F.col("_n") > 1, F.col(key))
    found, size, example = per_key.agg(F.sum("_n"), F.sum("_bytes"), F.max(repeated)).first()
    if example is not None:
        raise ValueError(f"several changes for {key} {example}; use last_per_key first")
    return (found or 0) <= rows and (size or 0) <= BROADCAST_BYTES


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows, and no more bytes than are broadcast; one partial aggregate."""
    found, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return found <= rows and (size or 0) <= BROADCAST_BYTES


def hinted(df: DataFrame, small: bool) -> DataFrame:
    """Marked for broadcast if its rows and bytes were counted and found few."""
    return F.broadcast(df) if small else df


def matched_keys(target: DataFrame, changes: DataFrame, key: str, small: bool) -> DataFrame:
    """Keys of the change set that the target has, each once.

    Reads the target's key column only, and shuffles nothing of it but the matches when the
    change set is small.
    """
    wanted = hinted(changes.select(key), small)
    return target.select(key).join(wanted, key, "left_semi").distinct()


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    key: str = "orderkey",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The target after the changes.

    Matched D rows go, matched U rows take every column of the change, unmatched I rows come
    in; any other combination, a NULL ``op`` included, changes nothing. Changes must have the
    target's columns and ``op``, in any order: none is dropped in silence. The target side is
    never the built side of a join and never in an outer join that cannot be split, so a
    frequent target key stays divisible.
    """
    columns = target.columns
    if {c.lower() for c in changes.columns} != {c.lower() for c in columns} | {"op"}:
        raise ValueError(f"changes have columns {changes.columns}; expected op and {columns}")
    small = inspect_changes(changes, key, broadcast_rows)
    touching = changes.filter(F.col("op").isin("U", "D")).select(
        F.col(key).alias("_key"),
        F.col("op").alias("_op"),
        F.struct(*[F.col(c) for c in columns]).alias("_new"),
    )
    updated = F.col("_op").eqNullSafe("U")
    kept = (
        target.join(hinted(touching, small), F.col(key) == F.col("_key"), "left")
        .filter(~F.col("_op").eqNullSafe("D"))
        .select(*[F.when(updated, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns])
    )
    inserts = changes.filter(F.col("op") == "I").select(*columns)
    existing = matched_keys(target, inserts, key, small)
    new = inserts.join(hinted(existing, small), key, "left_anti")
    return kept.unionByName(new.select(*columns))


def merge_statement(target: str, source: str, columns: list[str], key: str = "orderkey") -> str:
    """The same merge as SQL, for tables that take MERGE. ``columns`` are the target's."""
    assignments = ", ".join(f"{c} = source.{c}" for c in columns)
    values = ", ".join(f"source.{c}" for c in columns)
    return (
        f"MERGE INTO {target} AS target USING {source} AS source ON target.{key} = source.{key} "
        f"WHEN MATCHED AND source.op = 'D' THEN DELETE "
        f"WHEN MATCHED AND source.op = 'U' THEN UPDATE SET {assignments} "
        f"WHEN NOT MATCHED AND source.op = 'I' THEN INSERT ({', '.join(columns)}) VALUES ({values})"
    )


def merge_into(changes: DataFrame, table: str, key: str = "orderkey") -> None:
    """Run the merge inside a catalog whose tables take MERGE; Parquet tables do not.

    The statement is all or nothing there. For Parquet, write the result of ``apply_changes``.
    """
    inspect_changes(changes, key)
    spark = changes.sparkSession
    view = f"changes_of_{table.split('.')[-1]}"
    changes.createOrReplaceTempView(view)
    try:
        columns = [c for c in changes.columns if c != "op"]
        spark.sql(merge_statement(table, view, columns, key))
    finally:
        spark.catalog.dropTempView(view)


def change_outcomes(
    target: DataFrame,
    changes: DataFrame,
    key: str = "orderkey",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Changes per operation and match, and whether that combination does anything."""
    small = is_small(changes, broadcast_rows)
    found = matched_keys(target, changes, key, small).withColumn("_found", F.lit(True))
    matched = F.coalesce(F.col("_found"), F.lit(False))
    applied = (matched & F.col("op").isin("U", "D")) | (~matched & (F.col("op") == "I"))
    return (
        changes.select(key, "op")
        .join(found, key, "left")
        .groupBy("op", matched.alias("matched"))
        .agg(
            F.count(F.lit(1)).alias("changes"),
            F.bool_or(F.coalesce(applied, F.lit(False))).alias("applied"),
        )
    )


def merge_conflicts(
    target: DataFrame, changes: DataFrame, key: str = "orderkey", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Changes without effect: inserts of existing keys, updates and deletes of absent ones."""
    outcomes = change_outcomes(target, changes, key, broadcast_rows)
    return outcomes.filter(~F.col("applied")).select("op", "matched", "changes")


def touched_groups(
    target: DataFrame,
    changes: DataFrame,
    group: str = "custkey",
    key: str = "orderkey",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Groups whose aggregate may differ after the changes: where rows were, and where they are now."""
    moving = changes.filter(F.col("op").isin("U", "D")).select(key)
    moving = hinted(moving, is_small(changes, broadcast_rows))
    before = target.select(key, group).join(moving, key, "left_semi").select(group)
    after = changes.filter(F.col("op").isin("U", "I")).select(group)
    return before.union(after).distinct()


def refresh_touched(
    previous: DataFrame,
    merged: DataFrame,
    touched: DataFrame,
    aggregate,
    group: str = "custkey",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Aggregate after a merge: recomputed for the touched groups, carried over for the rest."""
    small = is_small(touched, broadcast_rows)
    keys = hinted(touched.select(F.col(group).alias("_touched")), small)
    same: Column = F.col(group).eqNullSafe(F.col("_touched"))
    renewed = aggregate(merged.join(keys, same, "left_semi"))
    return previous.join(keys, same, "left_anti").unionByName(renewed)
