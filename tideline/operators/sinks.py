"""Writing Parquet tables.

A table of the same columns is replaced by writing the new rows to a folder of their own and
pointing the catalog there, which is one step: a reader finds the table before or after it. The
folder it pointed to before stays until the next replacement, for readers that are under way. If
the columns change, the table is written beside the old one and the names are swapped; between the
two renames the name is briefly absent, and ``mend_table`` restores it if a run stopped just there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.changes import BROADCAST_ROWS, apply_changes, hinted, is_small
from tideline.operators.groups import stored
from tideline.sources import files


def overwrite_table(df: DataFrame, table: str, mode: str = "overwrite") -> int:
    """Replace a table by the rows of ``df``, which may read the table itself.

    Returns the rows written, counted by the write.
    """
    if mode != "overwrite":
        raise ValueError(f"unsupported mode {mode!r}; use 'overwrite'")
    spark = df.sparkSession
    mend_table(spark, table)
    if not spark.catalog.tableExists(table):
        return write_table(df, table)
    if same_columns(spark, table, df):
        return point_to(df, table)
    upcoming, former = f"{table}__next", f"{table}__prev"
    rows = write_table(df, upcoming)
    spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
    files.delete(spark, versions_folder(spark, table).removesuffix("__versions"))
    spark.sql(f"ALTER TABLE {upcoming} RENAME TO {table}")
    drop_table(spark, former)
    files.delete(spark, versions_folder(spark, table))
    return rows


def same_columns(spark: SparkSession, table: str, df: DataFrame) -> bool:
    """Whether a table has the columns of ``df`` by name, type and order, and no partitions."""
    found = spark.table(table).schema
    partitioned = any(column.isPartition for column in spark.catalog.listColumns(table))
    return not partitioned and [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in df.schema]


def location(spark: SparkSession, table: str) -> str:
    """The folder that the catalog has for a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def versions_folder(spark: SparkSession, table: str) -> str:
    """Where the replacements of a table go: beside its own folder, in its database."""
    database, _, name = table.rpartition(".")
    return f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri}/{name.lower()}__versions"


def point_to(df: DataFrame, table: str) -> int:
    """Write rows to a new folder, then point the table there; keep the folder it had, drop older ones."""
    spark = df.sparkSession
    before, root = location(spark, table), versions_folder(spark, table)
    name, counted = uuid.uuid4().hex, Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.option("compression", "snappy").parquet(f"{root}/{name}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{root}/{name}'")
    for entry in files.listed(spark, root):
        if entry.name not in (name, before.rstrip("/").split("/")[-1]):
            files.delete(spark, f"{root}/{entry.name}")
    if "__versions/" in before:
        # The folder that the table was created with is two replacements old by now.
        files.delete(spark, root.removesuffix("__versions"))
    return counted.get["rows"]


def mend_table(spark: SparkSession, table: str) -> bool:
    """Finish or undo a swap that stopped half way; True if the table had lost its name."""
    former = f"{table}__prev"
    if not spark.catalog.tableExists(former):
        return False
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {former}")
        return False
    spark.sql(f"ALTER TABLE {former} RENAME TO {table}")
    return True


def write_table(df: DataFrame, table: str) -> int:
    """Write a Parquet table in place and return its rows, counted on the way."""
    counted = Observation()
    (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.format("parquet")
        .option("compression", "snappy")
        .mode("overwrite")
        .saveAsTable(table)
    )
    return counted.get["rows"]


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Create the table if it is absent, then replace its rows; the table itself stays.

    Columns go by name and must be the table's, in any order. ``df`` must not read the table:
    Spark refuses to overwrite what it is reading.
    """
    spark = df.sparkSession
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} USING parquet AS SELECT * FROM {{df}} WHERE false", df=df
    )
    columns = spark.table(table).columns
    if sorted(c.lower() for c in columns) != sorted(c.lower() for c in df.columns):
        raise ValueError(f"{table} has columns {columns}, the rows to insert have {df.columns}")
    ordered = df.select(*columns)
    spark.sql(f"INSERT OVERWRITE TABLE {table} SELECT * FROM {{df}}", df=ordered)


def overwrite_existing(df: DataFrame, table: str) -> int:
    """Replace a table that must be there already."""
    if not df.sparkSession.catalog.tableExists(table):
        raise RuntimeError(f"table {table} must exist; create it with insert_overwrite first")
    return overwrite_table(df, table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table and what was kept of its earlier contents."""
    folder = versions_folder(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    files.delete(spark, folder)


# ---- partitions ---------------------------------------------------------------------


def overwrite_partitions(df: DataFrame, table: str, by: str) -> None:
    """Replace the partitions that ``df`` has rows of; the others keep their files.

    The table is created with partitions by ``by`` if it is absent. ``df`` must not read the table.
    """
    spark = df.sparkSession
    if by not in df.columns:
        raise ValueError(f"{table} is to be partitioned by {by}, the rows to write have {df.columns}")
    ordered = df.select(*[c for c in df.columns if c != by], by)
    if not spark.catalog.tableExists(table):
        ordered.limit(0).write.format("parquet").option("compression", "snappy").partitionBy(by).saveAsTable(table)
    columns = spark.table(table).columns
    if sorted(c.lower() for c in columns) != sorted(c.lower() for c in df.columns):
        raise ValueError(f"{table} has columns {columns}, the rows to write have {df.columns}")
    # Rows of a partition meet in few files; AQE splits a large one.
    dealt = df.select(*columns).hint("rebalance", F.col(by))
    with dynamic_partitions(spark):
        dealt.write.mode("overwrite").insertInto(table)


@contextmanager
def dynamic_partitions(spark: SparkSession) -> Iterator[None]:
    """While it lasts, overwriting a table replaces only partitions that get rows; tables take no option for it."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def merge_partitions(changes: DataFrame, table: str, by: str, key: str = "orderkey", broadcast_rows: int = BROADCAST_ROWS) -> list:
    """Apply changes to a partitioned table, reading and writing only partitions they touch.

    Touched are partitions that hold a changed key and those that changes put rows in. One scan of
    key and partition column finds the first kind. Partitions left without rows are dropped.
    Returns the touched values; there are no more of them than partitions.
    """
    spark = changes.sparkSession
    target = spark.table(table)
    wanted = hinted(changes.select(F.col(key).alias("_k")), is_small(changes, broadcast_rows))
    holding = target.select(key, by).join(wanted, F.col(key) == F.col("_k"), "left_semi").select(by)
    entering = changes.filter("op IN ('U', 'I')").select(by)
    touched = [row[0] for row in holding.union(entering).distinct().collect()]
    if not touched:
        return []
    values = [v for v in touched if v is not None]
    inside = F.col(by).isin(values) if values else F.lit(False)
    inside = (inside | F.col(by).isNull()) if None in touched else inside
    rows = stored(apply_changes(target.filter(inside), changes, key, broadcast_rows))
    left = {row[0] for row in rows.select(by).distinct().collect()}
    overwrite_partitions(rows, table, by)
    for value in set(touched) - left:
        literal = "null" if value is None else f"'{value}'"
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({by} = {literal})")
    return touched


# ---- buckets ------------------------------------------------------------------------


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Write a table in buckets sorted by a key, so that joins and sums by it need no shuffle.

    Rows are dealt as Spark deals buckets, so every task writes one file of one bucket.
    """
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.format("parquet").option("compression", "snappy").bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)


# ---- checks -------------------------------------------------------------------------


def fingerprint(schema: T.StructType) -> list[Column]:
    """Aggregates that tell whether two tables hold the same rows, in any order, as often.

    The number of rows and the exact sums of two hashes of each row; which columns are NULL is part of
    them. Maps are hashed as sorted entries.
    """

    def plain(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        return F.array_sort(F.map_entries(column)) if isinstance(field.dataType, T.MapType) else column

    nulls = [F.col(f"`{field.name}`").isNull() for field in schema]
    values = [plain(field) for field in schema]
    first = F.xxhash64(*values, *nulls)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(first.cast("decimal(20,0)")).alias("hashes"),
        F.sum(F.xxhash64(first, F.hash(*values, *nulls)).cast("decimal(20,0)")).alias("more_hashes"),
    ]


def audited_write(df: DataFrame, table: str) -> dict:
    """Write a table, take the fingerprint of its rows in the write itself, and hold the table against it."""
    seen = Observation()
    df.observe(seen, *fingerprint(df.schema)).write.format("parquet").option("compression", "snappy").mode("overwrite").saveAsTable(table)
    audit(df.sparkSession.table(table), seen.get, table)
    return seen.get


def audit(df: DataFrame, expected: dict, name: str = "table") -> None:
    """Fail if the rows are not those of a fingerprint."""
    found = df.agg(*fingerprint(df.schema)).first().asDict()
    if found["rows"] != expected["rows"]:
        raise RuntimeError(f"{name}: wrote {expected['rows']} rows, read back {found['rows']}")
    if found != {k: expected[k] for k in found}:
        raise RuntimeError(f"{name}: as many rows as written, but not the same ones")


def write_check(df: DataFrame, table: str, reading=None) -> DataFrame:
    """Write, read back, and drop a table; fail if a row is missing, doubled or altered.

    Returns what ``reading`` (a small aggregate; a row count by default) found in the table.
    """
    spark = df.sparkSession
    try:
        audited_write(df, table)
        held = spark.table(table)
        found = reading(held) if reading else held.agg(F.count(F.lit(1)).alias("row_count"))
        return spark.createDataFrame(found.collect(), found.schema)
    finally:
        drop_table(spark, table)
