"""Table scans by catalog name or by folder of Parquet files."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables of the star schema.
STAR_TABLES = ("customer", "orders", "lineitem", "part", "supplier", "partsupp", "nation", "region")

# A damaged footer comes as a plain error of the JVM.
READ_ERRORS = (PySparkException, Py4JError)
ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[name.lower() for name in df.columns])


def read_table(spark: SparkSession, table: str, folder: str | None = None) -> DataFrame:
    """Scan ``<folder>/<table>.parquet``, or the catalog table when no folder is given."""
    df = spark.table(table) if folder is None else spark.read.parquet(f"{folder}/{table}.parquet")
    return lower_columns(df)


@dataclass
class Loaded:
    """Tables that could be read, and the reasons for those that could not."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    missing: dict[str, str] = field(default_factory=dict)

    def __getitem__(self, table: str) -> DataFrame:
        if table in self.missing:
            raise KeyError(f"{table}: {self.missing[table]}")
        return self.tables[table]


def load_tables(
    spark: SparkSession, folder: str | None = None, names: Iterable[str] = STAR_TABLES
) -> Loaded:
    """Load several tables; one that is absent or damaged is noted and the rest still load."""
    loaded = Loaded()
    for name in names:
        try:
            loaded.tables[name] = read_table(spark, name, folder)
        except READ_ERRORS as error:
            loaded.missing[name] = reason(error)
    return loaded


def reason(error: Exception) -> str:
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    if condition in ABSENT:
        return "no such table"
    return condition or str(error).splitlines()[0]


def table_exists(spark: SparkSession, table: str, folder: str | None = None) -> bool:
    """Whether a catalog table or a file or folder of that name is there, damaged or not."""
    if folder is None:
        return spark.catalog.tableExists(table)
    try:
        read_table(spark, table, folder)
    except READ_ERRORS as error:
        return reason(error) != "no such table"
    return True


def table_inventory(spark: SparkSession, loaded: Loaded) -> DataFrame:
    """One row per expected table: its row count, NULL when it could not be read."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in loaded.tables.items()
    ]
    if loaded.missing:
        parts.append(
            spark.createDataFrame(
                [(name, None) for name in loaded.missing], "table_name string, row_count bigint"
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def list_databases(spark: SparkSession) -> DataFrame:
    """Names of the catalog's databases and which is the current one."""
    current = spark.catalog.currentDatabase()
    names = spark.sql("SHOW DATABASES").toDF("namespace")
    return names.withColumn("is_current", F.col("namespace") == current)


def list_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of one database (the current one by default) with a flag for temporary views."""
    database = database or spark.catalog.currentDatabase()
    return spark.sql(f"SHOW TABLES IN {database}").select("namespace", "tableName", "isTemporary")
