"""Helpers shared by the text operators: row batches, words, cached words, row keys."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.groups import stored

# Texts of one Arrow batch are worked on in pieces of about so many bytes.
BATCH_BYTES = 4_000_000
# Words of one Python worker's cache, some 200 bytes each; it starts afresh when full.
CACHED_WORDS = 600_000
# The same where other work of the task needs the memory.
FEWER_WORDS = 300_000
# Bits of the map that drops texts which are not needed.
KEY_BITS = 1 << 22
# What a Python worker keeps from one task to the next: one thing, under the name it was made for.
KEPT: dict = {}


def kept(name: tuple, make: Callable):
    """What ``make`` returned when this worker last asked for ``name``, if nothing else was kept since."""
    if name not in KEPT:
        KEPT.clear()
        give_back()
        KEPT[name] = make()
    return KEPT[name]


def give_back() -> None:
    """Return freed memory to the system: a worker lives on from stage to stage, beside the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo; NULL for NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


class CachedWords(dict):
    """``compute(word)`` for words met before; bounded, since a full cache is emptied."""

    def __init__(self, compute: Callable, limit: int = CACHED_WORDS):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, word):
        value = self.compute(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


def utf8_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text, b'' for NULL. ``bytes.split()`` cuts at \\x20 and \\x09-\\x0D only."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str | None, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of a piece hold about ``limit`` bytes (one row at least)."""
    for batch in batches:
        if text is None:
            yield batch
            continue
        start = size = 0
        lengths = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def with_columns(
    df: DataFrame, text: str | None, new: T.StructType, compute: Callable[[pa.RecordBatch], list]
) -> DataFrame:
    """``df`` with columns that ``compute`` makes from batches of rows; same-named columns are replaced.

    ``compute`` gets batches of bounded text and returns one Arrow array or list per field of ``new``.
    """
    kept = [name for name in df.columns if name not in new.fieldNames()]
    schema = T.StructType([df.schema[name] for name in kept] + new.fields)
    types = [field.type for field in to_arrow(new)]

    def run(batches):
        for batch in slices(batches, text):
            made = compute(batch)
            arrays = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in kept] + arrays, kept + new.fieldNames()
            )

    return df.mapInArrow(run, schema)


def to_arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def bit_map(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bit for the low bits of each value of a long column, put together by Spark; of fixed size."""
    bit = F.col(column).bitwiseAND(bits - 1)
    found = np.zeros(bits // 8, dtype=np.uint8)
    marks = df.groupBy(F.shiftright(bit, 3).alias("byte")).agg(F.bit_or(F.expr(f"shiftleft(1, cast({column} & 7 AS int))")).alias("bits"))
    for row in marks.toLocalIterator():
        found[row["byte"]] = row["bits"]
    return found


def in_map(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which values have their bit in a map; all that were put in, and a few others."""
    bit = values.view(np.uint64) & np.uint64(len(found) * 8 - 1)
    return (found[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def fetch_texts(docs: DataFrame, text: str, needed: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """tid and text of the texts that ``needed`` (tid and the keys of ``text_key``) names, one of each; stored.

    A map of fixed size drops most other texts where they are read, so what is shuffled follows
    the texts that are needed; the join decides.
    """
    marks = docs.sparkSession.sparkContext.broadcast(bit_map(needed, "_ll_key", bits))
    names = ["_ll_key", "_ll_check", "text"]

    def marked(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield batch.filter(pa.array(in_map(batch.column("_ll_key").to_numpy(), marks.value)))

    rows = docs.select(*text_key(text), F.col(text).alias("text")).select(*names)
    rows = rows.mapInArrow(marked, "_ll_key long, _ll_check int, text string")
    on = [c for c in needed.columns if c != "tid"]
    return stored(rows.join(needed, on).groupBy("tid").agg(F.max("text").alias("text")))


def text_key(text: str) -> list[Column]:
    """Two hashes that stand for a text, 96 bits in all; NULL counts as empty."""
    value = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(value).alias("_ll_key"), F.hash(value).alias("_ll_check")]
