"""Parquet, CSV and JSON files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tideline.operators.groups import stored

FORMATS = ("parquet", "csv", "json")

# Full timestamps, a mark that tells NULL from empty text, doubled quotes.
TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
OPTIONS = {
    "parquet": {},
    "json": TIMES,
    "csv": TIMES
    | {
        "header": "true",
        "nullValue": "\\N",
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    },
}


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def _escaped(text: Column) -> Column:
    """Line breaks and the mark itself behind a backslash, so that a CSV row is a line."""
    for plain, mark in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def _unescaped(text: Column) -> Column:
    def breaks(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    # Pairs of backslashes are texts' own; a single one begins a line break.
    return F.array_join(F.transform(F.split(text, r"\\\\"), breaks), "\\")


def write_files(df: DataFrame, path: str, file_format: str) -> None:
    """Overwrite ``path`` with the rows of ``df``. In CSV, backslashes and line breaks are escaped."""
    _check(file_format)
    if file_format == "csv":
        df = df.withColumns({name: _escaped(F.col(name)) for name in _texts(df)})
    writer = df.write.mode("overwrite").format(file_format).options(**OPTIONS[file_format])
    if file_format == "parquet":
        writer = writer.option("compression", "snappy")
    writer.save(path)


def read_files(spark: SparkSession, path: str, file_format: str, schema: StructType) -> DataFrame:
    """Read files back under a given schema; nothing is inferred, so there is no extra pass."""
    _check(file_format)
    found = spark.read.schema(schema).format(file_format).options(**OPTIONS[file_format]).load(path)
    if file_format == "csv":
        found = found.withColumns({name: _unescaped(F.col(name)) for name in _texts(found)})
    return found


# The column that keeps a record which does not fit the schema.
BROKEN = "_broken_record"


@dataclass(frozen=True)
class Checked:
    """Rows that fit the schema, records that do not (``record``, ``file``), and how many there are of each."""

    good: DataFrame
    broken: DataFrame
    counts: dict[str, int]


def read_checked(spark: SparkSession, path: str, file_format: str, schema: StructType) -> Checked:
    """Read CSV or JSON files; records that do not fit the schema are set apart, not dropped or guessed.

    A record is broken if it cannot be parsed, has a value of another type, or (CSV) another number
    of values. The files are parsed once, into a stored copy in two parts, and the counts are
    observed on the way. Parquet has no records of its own to be broken: a damaged file stops the read.
    """
    _check(file_format)
    if file_format == "parquet":
        raise ValueError("records are checked in csv and json files")
    wide = StructType([*schema.fields, StructField(BROKEN, StringType())])
    options = OPTIONS[file_format] | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    if file_format == "csv":
        # Every value is parsed, so that a record does not count as sound for want of a column.
        options = options | {"enforceSchema": "true"}
    found = spark.read.schema(wide).format(file_format).options(**options).load(path)
    bad = F.col(BROKEN).isNotNull()
    seen = Observation()
    parts = found.withColumns({"_bad": bad, "_file": F.col("_metadata.file_path")})
    parts = stored(parts.observe(seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("broken")), "_bad")
    good = parts.filter("NOT _bad").select(*schema.fieldNames())
    if file_format == "csv":
        good = good.withColumns({name: _unescaped(F.col(name)) for name in _texts(good)})
    broken = parts.filter("_bad").select(F.col(BROKEN).alias("record"), F.col("_file").alias("file"))
    return Checked(good, broken, {name: seen.get[name] for name in ("good", "broken")})


def _check(file_format: str) -> None:
    if file_format not in FORMATS:
        raise ValueError(f"unsupported format {file_format!r}; use one of {FORMATS}")
