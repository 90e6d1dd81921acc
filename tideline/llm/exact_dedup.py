"""Exact copies: a minimal perfect hash over the digests that history holds, and byte-checked lookups in it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.groups import stored

DIGEST_BYTES = 32
# Bits of a level for each digest that is left; fewer levels with more bits.
ROOM = 2.0
LEVELS = 64
WHITESPACE = r"[\x20\x09-\x0D]+"

INDEX = T.StructType(
    [
        T.StructField("_ll_shard", T.IntegerType()),
        T.StructField("generation", T.IntegerType()),
        T.StructField("level_bits", T.ArrayType(T.LongType())),
        T.StructField("bits", T.BinaryType()),
        T.StructField("digests", T.BinaryType()),
        T.StructField("winners", T.ArrayType(T.LongType())),
        T.StructField("winner_rows", T.BinaryType()),
        T.StructField("sizes", T.BinaryType()),
    ]
)


@dataclass(frozen=True)
class Shards:
    """Digests that one shard of the index holds, and rows that one lookup task takes, on the average."""

    digests: int = 200_000
    rows: int = 400_000


def normalised(text: str | Column) -> Column:
    """Every stretch of whitespace as one space; NULL as the empty text."""
    value = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(value, F.lit("")), WHITESPACE, " ")


# ---- the hash -----------------------------------------------------------------------


def words_of(digests: np.ndarray) -> np.ndarray:
    """Four 64-bit words of each digest."""
    return np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)


def place(words: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Where each digest falls on a level: a mix of two of its words, which change from level to level."""
    mixed = words[:, level % 4] + words[:, (level // 4 + level + 1) % 4] * np.uint64(2 * level + 1)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(bits)).astype(np.int64)


def perfect_hash(digests: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Bits per level, all levels' bits, and the slot of each digest; n distinct digests fill n slots.

    A digest that falls alone on a bit of a level gets that bit; the others go on to the next
    level. The slot is the number of bits set before its own.
    """
    words = words_of(digests)
    left = np.arange(len(digests))
    sizes: list[int] = []
    parts: list[np.ndarray] = []
    position = np.empty(len(digests), dtype=np.int64)
    start = 0
    while len(left):
        if len(sizes) == LEVELS:
            raise ValueError("digests to be hashed are not distinct")
        bits = -(-max(64, int(ROOM * len(left))) // 64) * 64
        at = place(words[left], len(sizes), bits)
        met = np.bincount(at, minlength=bits)
        alone = met[at] == 1
        position[left[alone]] = start + at[alone]
        parts.append(met == 1)
        sizes.append(bits)
        start += bits
        left = left[~alone]
    bitmap = np.concatenate(parts) if parts else np.zeros(0, dtype=bool)
    return sizes, np.packbits(bitmap, bitorder="little"), (np.cumsum(bitmap) - 1)[position]


def slots(digests: np.ndarray, sizes: list[int], packed: np.ndarray) -> np.ndarray:
    """The slot of each digest that was hashed; for any other, some slot or -1."""
    bitmap = np.unpackbits(packed, bitorder="little").astype(bool)
    rank = np.cumsum(bitmap) - 1
    words = words_of(digests)
    found = np.full(len(digests), -1, dtype=np.int64)
    left = np.arange(len(digests))
    start = 0
    for level, bits in enumerate(sizes):
        at = start + place(words[left], level, bits)
        hit = bitmap[at]
        found[left[hit]] = rank[at[hit]]
        left = left[~hit]
        start += bits
    return found


def members(digests: np.ndarray, shard: dict) -> np.ndarray:
    """The slot whose full digest is equal byte for byte, or -1."""
    held = np.frombuffer(shard["digests"], dtype=np.uint8).reshape(-1, DIGEST_BYTES)
    at = slots(digests, shard["level_bits"], np.frombuffer(shard["bits"], dtype=np.uint8))
    same = (at >= 0) & (held[at] == digests).all(axis=1) if len(held) else np.zeros(len(at), dtype=bool)
    return np.where(same, at, -1)


# ---- shards of the index ------------------------------------------------------------


def digest_matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, DIGEST_BYTES)


def numbers(values: np.ndarray) -> bytes:
    return values.astype("<i8").tobytes()


def as_numbers(value: bytes) -> np.ndarray:
    return np.frombuffer(value, dtype="<i8")


def shard_row(shard: int, generation: int, groups: pa.Table) -> dict:
    """One record of the index: the hash, and in slot order digests, winners and group sizes."""
    digests = digest_matrix(groups.column("_ll_digest"))
    sizes, packed, slot = perfect_hash(digests)
    order = np.empty(len(slot), dtype=np.int64)
    order[slot] = np.arange(len(slot))
    return {
        "_ll_shard": shard,
        "generation": generation,
        "level_bits": sizes,
        "bits": packed.tobytes(),
        "digests": digests[order].tobytes(),
        "winners": groups.column("winner").take(pa.array(order)).to_pylist(),
        "winner_rows": numbers(groups.column("winner_row").to_numpy()[order]),
        "sizes": numbers(groups.column("size").to_numpy()[order]),
    }


def index_table(rows: list[dict]) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.Table.from_pylist(rows, to_arrow_schema(INDEX))


def build_index(groups: DataFrame) -> DataFrame:
    """One record per shard over groups of distinct digests; a shard is bounded by the number of shards."""

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return index_table([shard_row(key[0].as_py(), 0, table)])

    return groups.groupBy("_ll_shard").applyInArrow(build, INDEX)


def extend_index(index: DataFrame, groups: DataFrame) -> DataFrame:
    """The index after later groups: members add to the size of their slot and lose to its winner,
    the others get slots of their own in a further generation."""

    def absorb(key: tuple[pa.Scalar, ...], held: pa.Table, later: pa.Table) -> pa.Table:
        rows = held.to_pylist()
        digests = digest_matrix(later.column("_ll_digest")) if later.num_rows else np.zeros((0, DIGEST_BYTES), np.uint8)
        sizes = later.column("size").to_numpy() if later.num_rows else np.zeros(0, dtype=np.int64)
        new = np.ones(len(digests), dtype=bool)
        for row in rows:
            at = members(digests, row)
            more = as_numbers(row["sizes"]).copy()
            np.add.at(more, at[at >= 0], sizes[at >= 0])
            row["sizes"] = numbers(more)
            new &= at < 0
        if new.any():
            rows.append(shard_row(key[0].as_py(), 1 + max([r["generation"] for r in rows], default=-1), later.filter(pa.array(new))))
        return index_table(rows)

    return index.groupBy("_ll_shard").cogroup(groups.groupBy("_ll_shard")).applyInArrow(absorb, INDEX)


# ---- rows ---------------------------------------------------------------------------


def digest_rows(docs: DataFrame, text: str, row_id: str, keep_text: bool) -> DataFrame:
    """The rows with digest and row number, stored; without their texts unless asked for."""
    hexed = F.sha2(normalised(text), 256)
    rows = docs.withColumns(
        {"_ll_digest": F.unhex(hexed), "_ll_row": F.monotonically_increasing_id(), "_ll_id": F.col(row_id).cast("long")}
    )
    return stored(rows if keep_text else rows.drop(text))


def grouped(rows: DataFrame) -> DataFrame:
    """Per digest the row that stays (smallest id, NULL last, then row number) and the number of rows."""
    first = F.min(F.struct(F.col("_ll_id").isNull().alias("last"), F.col("_ll_id").alias("id"), F.col("_ll_row").alias("row")))
    found = rows.groupBy("_ll_digest").agg(first.alias("first"), F.count(F.lit(1)).alias("size"))
    return found.select("_ll_digest", F.col("first.id").alias("winner"), F.col("first.row").alias("winner_row"), "size")


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("_ll_digest"), F.lit(shards)).cast("int").alias("_ll_shard")


def look_up(rows: DataFrame, index: DataFrame, shards: int, task_rows: int) -> DataFrame:
    """Every row with winner, size and whether it stays, from the slot that holds its digest.

    A shard with many rows is looked up by several tasks, each with a copy of that shard's
    records: a frequent text is spread by row number. The table that is broadcast has a row of two
    integers per shard.
    """
    parts = F.ceil(F.count(F.lit(1)) / task_rows).cast("int").alias("_ll_parts")
    parts = F.broadcast(stored(rows.groupBy(shard_of(shards)).agg(parts)))
    part = F.pmod(F.xxhash64("_ll_row"), F.col("_ll_parts")).cast("int").alias("_ll_part")
    wanted = rows.withColumn("_ll_shard", shard_of(shards)).join(parts, "_ll_shard").select(*rows.columns, "_ll_shard", part)
    copies = index.join(parts, "_ll_shard").withColumn("_ll_part", F.explode(F.sequence(F.lit(0), F.col("_ll_parts") - 1)))
    copies = copies.drop("_ll_parts")
    given = [name for name in rows.columns if not name.startswith("_ll_")]
    result = T.StructType(
        [rows.schema[name] for name in given]
        + [
            T.StructField("keep_id", T.LongType()),
            T.StructField("group_size", T.LongType()),
            T.StructField("kept", T.BooleanType()),
            T.StructField("text_sha256", T.StringType()),
        ]
    )
    made = result.fieldNames()

    def probe(asked: pa.Table, held: pa.Table) -> pa.Table:
        digests = digest_matrix(asked.column("_ll_digest")) if asked.num_rows else np.zeros((0, DIGEST_BYTES), np.uint8)
        row = asked.column("_ll_row").to_numpy()
        winner = np.full(len(digests), -1, dtype=np.int64)
        no_winner = np.ones(len(digests), dtype=bool)
        winner_row = np.full(len(digests), -1, dtype=np.int64)
        size = np.zeros(len(digests), dtype=np.int64)
        for shard in held.to_pylist():
            at = members(digests, shard)
            hit = at >= 0
            ids = shard["winners"]
            winner[hit] = np.array([x or 0 for x in ids], dtype=np.int64)[at[hit]]
            no_winner[hit] = np.array([x is None for x in ids], dtype=bool)[at[hit]]
            winner_row[hit] = as_numbers(shard["winner_rows"])[at[hit]]
            size[hit] = as_numbers(shard["sizes"])[at[hit]]
        arrays = [asked.column(name) for name in given] + [
            pa.array(winner, mask=no_winner),
            pa.array(size),
            pa.array(winner_row == row),
            pa.array([d.hex() for d in asked.column("_ll_digest").to_pylist()], pa.string()),
        ]
        return pa.Table.from_arrays(arrays, made)

    by = ["_ll_shard", "_ll_part"]
    return wanted.groupBy(*by).cogroup(copies.groupBy(*by)).applyInArrow(probe, result)


def mark_copies(
    docs: DataFrame,
    history: Column,
    text: str = "text",
    row_id: str = "doc_id",
    keep_text: bool = False,
    shards: Shards = Shards(),
) -> DataFrame:
    """Every row, those that go too, with keep_id, group_size, kept and text_sha256.

    Rows for which ``history`` holds are indexed first: per shard a minimal perfect hash over their
    distinct digests. The digests of the later rows are looked up there; the full digest in the
    slot decides. Members belong to the slot's group, whose historical winner stays, whatever the
    ids. Nonmembers are grouped among themselves and make a second generation of slots. Every row
    is then looked up once. A group's row that stays is the one of smallest id, a NULL id last, of
    equal ids one; exactly one row of each group is ``kept``. NULL in ``history`` counts as later.

    Texts are equal when they are after each stretch of whitespace became one space; a NULL text
    counts as empty. The other columns of ``docs`` stay, the text only if asked for; columns named
    like the new ones are replaced. An empty table gives an empty one. The texts are read and
    hashed once; digests and ids are stored and shuffled, texts are not.
    """
    new = ["keep_id", "group_size", "kept", "text_sha256"]
    named = docs.drop(*[name for name in new if name not in (text, row_id)])
    marked = named.withColumn("_ll_known", F.coalesce(history, F.lit(False)))
    rows = digest_rows(marked, text, row_id, keep_text)
    known, later = stored(grouped(rows.filter("_ll_known"))), stored(grouped(rows.filter("NOT _ll_known")))
    total = known.count() + later.count()
    count = max(1, -(-total // shards.digests))
    index = stored(build_index(known.withColumn("_ll_shard", shard_of(count))))
    index = stored(extend_index(index, later.withColumn("_ll_shard", shard_of(count))))
    return look_up(rows, index, count, shards.rows)


def drop_copies(docs: DataFrame, text: str = "text", row_id: str = "doc_id", shards: Shards = Shards()) -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    names = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    marked = mark_copies(plain, first_half(plain, names[row_id]), names[text], names[row_id], True, shards)
    return marked.filter("kept").select(*[F.col(short).alias(name) for name, short in names.items()])


def first_half(docs: DataFrame, row_id: str = "doc_id") -> Column:
    """Rows that came first: ids up to the middle between the smallest and the greatest."""
    low, high = docs.agg(F.min(F.col(row_id).cast("long")), F.max(F.col(row_id).cast("long"))).first()
    return F.col(row_id).cast("long") <= F.lit(None if low is None else (low + high) // 2)


def copies_sql(table: str) -> str:
    """What ``mark_copies`` returns for doc_id and text, in DuckDB SQL."""
    return f"""
with texts as (
 select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as norm from {table})
select doc_id, min(doc_id) over (partition by norm) as keep_id,
 count(*) over (partition by norm) as group_size,
 row_number() over (partition by norm order by doc_id nulls last) = 1 as kept,
 sha256(norm) as text_sha256
from texts"""
