"""Telling apart groups that fit one task from groups that do not."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import fresh_folder
from tideline.sources import files

# Rows of one group that a single task may sort. A bigger group is cut into chunks.
GROUP_ROWS = 2_000_000
# Range sums are differences of running frames, linear in the rows, and need no earlier cut.
FRAME_ROWS = GROUP_ROWS
# Keys of hot groups that may be collected and broadcast; more of them are joined by shuffle.
HOT_KEYS = 100_000
# Deletes the shuffle files of a query when the query is done.
SHUFFLES_DELETED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# With no more groups than this, all of them are chunked together, large or small.
FEW_GROUPS = 1_000


def hot_groups(
    df: DataFrame, by: list[str], group_rows: int = GROUP_ROWS, hot_keys: int = HOT_KEYS
) -> DataFrame | None:
    """Keys of the groups with more than ``group_rows`` rows, or None when there are none.

    One partial aggregate over the key columns only. Up to ``hot_keys`` keys are collected
    and marked for broadcast; beyond that the keys stay distributed.
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    large = counts.filter(F.col("_rows") > group_rows).select(*by)
    keys = large.limit(hot_keys + 1).collect()
    if not keys:
        return None
    if len(keys) > hot_keys:
        return stored(large)
    return F.broadcast(df.sparkSession.createDataFrame(keys, large.schema))


def split_hot(
    df: DataFrame, by: list[str], group_rows: int = GROUP_ROWS, counted: DataFrame | None = None
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of ordinary groups and rows of hot groups; None for an empty part.

    ``counted`` has the same groups with as many rows, where that is cheaper to read than ``df``.

    With hot groups, ``df`` is computed once and stored in two partitions of one Parquet
    folder; each part then reads its own, as often as it needs to.
    """
    if not by:
        return (None, stored(df)) if df.count() > group_rows else (df, None)
    keys = hot_groups(df if counted is None else counted, by, group_rows)
    if keys is None:
        return df, None
    keys = keys.select(*[F.col(name).alias(f"_hot_{name}") for name in by], F.lit(True).alias("_hot"))
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_hot_{name}")) for name in by])
    marked = df.join(keys, same, "left").select(*df.columns, F.coalesce("_hot", F.lit(False)).alias("_hot"))
    parts = stored(marked, "_hot")
    return parts.filter("not _hot").drop("_hot"), parts.filter("_hot").drop("_hot")


def group_sizes(df: DataFrame, *groupings: list[str]) -> list[tuple[int, int]]:
    """For each list of keys, how many groups there are and the rows of the largest.

    One scan for all of them: grouping sets, summed up before the shuffle.
    """
    keys = sorted({name for by in groupings for name in by})
    if not keys:
        rows = df.count()
        return [(1, rows) for _ in groupings]
    # A grouping id has a bit for each key that is not grouped by, the last key lowest.
    ids = [sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in by) for by in groupings]
    sets = [[F.col(name) for name in by] for by in groupings]
    counts = df.groupingSets(sets, *keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.grouping_id().alias("_id")
    )
    sizes = counts.groupBy("_id").agg(F.count(F.lit(1)).alias("groups"), F.max("_rows").alias("largest"))
    found = {row["_id"]: (row["groups"], row["largest"]) for row in sizes.collect()}
    return [found.get(i, (0, 0)) for i in ids]


class Scope:
    """Owns the relations stored while it lasts; at its end their folders are deleted.

    What a function returns has to outlast it: ``keep`` hands a stored relation on to the scope around
    it (or to nobody, outermost). ``free`` deletes a relation before the end, once all that reads it
    has been stored itself. Stored relations have no lineage but their files, so a lost executor
    costs tasks that read files of relations still owned, never one that was freed.
    """

    def __init__(self, outer: Scope | None):
        self.outer, self.folders = outer, {}

    def keep(self, df: DataFrame) -> DataFrame:
        """Hand a relation on; it is stored first, unless ``stored`` returned it."""
        path = getattr(df, "_stored_at", None)
        if path not in self.folders:
            df = stored(df)
            path = df._stored_at
        spark = self.folders.pop(path)
        if self.outer is not None:
            self.outer.folders[path] = spark
        return df

    def free(self, *relations: DataFrame) -> None:
        """Delete the folders of relations that nothing will read any more; others are left alone."""
        for df in relations:
            path = getattr(df, "_stored_at", None)
            if path in self.folders:
                files.delete(self.folders.pop(path), path)

    def reads(self, df: DataFrame) -> bool:
        """Whether a relation reads files of this scope."""
        names = {path.rstrip("/").split("/")[-1] for path in self.folders}
        return any(names & set(file.split("/")) for file in df.inputFiles())

    def close(self) -> None:
        for path, spark in self.folders.items():
            files.delete(spark, path)
        self.folders.clear()


_scope: ContextVar[Scope | None] = ContextVar("scope", default=None)


@contextmanager
def owning(scope: Scope) -> Iterator[Scope]:
    """Let a scope own what ``stored`` writes inside; it stays open."""
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)


@contextmanager
def storing() -> Iterator[Scope]:
    """A scope for what ``stored`` writes inside; scopes nest, and each owns its own."""
    scope = Scope(_scope.get())
    try:
        with owning(scope):
            yield scope
    finally:
        scope.close()


def free(*relations: DataFrame) -> None:
    """Free relations of the innermost scope; without a scope they stay."""
    scope = _scope.get()
    if scope is not None:
        scope.free(*relations)


@contextmanager
def shuffles_deleted(spark) -> Iterator[None]:
    """Shuffle files of what runs inside are deleted when it is done, not when the driver's memory is cleared."""
    before = spark.conf.get(SHUFFLES_DELETED, None)
    spark.conf.set(SHUFFLES_DELETED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_DELETED)
        else:
            spark.conf.set(SHUFFLES_DELETED, before)


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write to the shared folder as Parquet and read from there.

    Cuts the lineage, survives lost executors, and lets later passes read single columns. Inside
    ``storing`` the folder is deleted at the end of the scope.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, "stored")
    scope = _scope.get()
    if scope is not None:
        # Owned before it is written, so that a write that fails leaves nothing behind either.
        scope.folders[path] = spark
    with shuffles_deleted(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def union_parts(parts: list[DataFrame | None]) -> DataFrame:
    """Union of the parts that exist, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), [part for part in parts if part is not None])
