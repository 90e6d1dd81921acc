"""Packing token sequences: shortest pack first over the histogram of lengths."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tideline.llm.common import CachedWords, slices, to_arrow, utf8_texts
from tideline.llm.common import kept as of_worker
from tideline.operators.groups import stored

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_OF_TEXT = 2
CAPACITY = 4096
# Parts into which rows of one length are dealt while they are numbered, and the rows of a part
# from which on a length gets more of them.
DEAL, PART_ROWS = 64, 250_000
# ASCII punctuation that a word may end in; it is split off, as it forms tokens of its own.
TAIL = b".,;:!?*#$%&|)\"-"
SPECIAL = b"<|"
# Letters before this one are Latin, and composed or plain.
LATIN_END = "\u0250"


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def word_ids(vocabulary: str) -> CachedWords:
    """Ids of a word as little-endian 32-bit integers.

    The tokenizer lower-cases, splits at white space and never joins letters with punctuation,
    so the ids of a text are those of its words, and of their parts, in order. Words of lower-case
    Latin letters, which its normaliser leaves as they are, go to its model at once.
    """
    tokenizer = Tokenizer.from_file(vocabulary)
    model, letters = tokenizer.model, byte_letters()
    normalizer = tokenizer.normalizer

    def ends_in_letter(base: bytes) -> bool:
        # What the tokenizer makes of the letter counts: a mark that it adds would join the punctuation.
        text = base.decode("utf-8", "replace")
        return (normalizer.normalize_str(text) if normalizer else text)[-1:].isalpha()

    def ids(word: bytes) -> bytes:
        base = word.rstrip(TAIL)
        if base and len(base) < len(word) and SPECIAL not in word and ends_in_letter(base):
            return known[base] + known[word[len(base) :]]
        text = word.decode("utf-8", "replace")
        if text.isalpha() and max(text) < LATIN_END and text == text.lower():
            return np.array([t.id for t in model.tokenize(word.decode("latin-1").translate(letters))], dtype="<u4").tobytes()
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    known = CachedWords(ids)
    return known


PIECE = [
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()),
]


# Names of what is added to pieces later.
PLACE = ("ids_crc32", "sequence_id", "offset")


def token_pieces(
    docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, end: int = END_OF_TEXT, capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: the other columns of ``docs``, start, length, doc_tokens and the ids.

    A document is its text's ids and then ``end``; it is cut every ``capacity`` ids. NULL and
    empty texts are one piece with ``end`` alone. Ids are little-endian unsigned 32-bit integers.
    Columns of ``docs`` that are named like one of the piece or of its place are left out, and so
    is the text.
    """
    names = [f.name for f in PIECE]
    kept = [c for c in docs.columns if c not in (text, *names, *PLACE)]
    schema = T.StructType([docs.schema[c] for c in kept] + PIECE)
    types = to_arrow(T.StructType(PIECE))

    def run(batches: Iterator[pa.RecordBatch]):
        known = of_worker(("word ids", vocabulary), lambda: word_ids(vocabulary))
        last = np.array([end], dtype="<u4").tobytes()
        for batch in slices(batches, text):
            rows, pieces = [], []
            for i, raw in enumerate(utf8_texts(batch.column(text))):
                # The tokenizer lower-cases too; special tokens' strings are matched as they stand.
                words = (raw if SPECIAL in raw else raw.lower()).split()
                ids = b"".join(map(known.__getitem__, words)) + last
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    rows.append(i)
                    pieces.append((start, len(piece) // 4, total, piece))
            made = [pa.array(list(x), f.type) for x, f in zip(zip(*pieces), types)]
            carried = [batch.column(c).take(pa.array(rows, pa.int64())) for c in kept]
            yield pa.RecordBatch.from_arrays(carried + made, kept + names)

    return docs.select(*kept, text).mapInArrow(run, schema)


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths that share a sequence) and how often each is used.

    Lengths are placed longest first, each on the pack with the most room that takes it, which is
    the shortest pack. Packs of equal content are one pattern with a count; it is split when
    fewer pieces are left than it has packs. Work and patterns hang on the number of different
    lengths, not on the number of pieces.
    """
    open_packs: list[tuple[int, int, tuple[int, ...], int]] = []  # (-room, age, lengths, packs)
    done: list[tuple[list[int], int]] = []
    age = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_packs and -open_packs[0][0] >= length:
                room, _, lengths, packs = heapq.heappop(open_packs)
                used = min(packs, left)
                if packs > used:
                    age += 1
                    heapq.heappush(open_packs, (room, age, lengths, packs - used))
                grown, free = (*lengths, length), -room - length
            else:
                used, grown, free = left, (length,), capacity - length
            left -= used
            if free:
                age += 1
                heapq.heappush(open_packs, (-free, age, grown, used))
            else:
                done.append((list(grown), used))
    return done + [(list(lengths), packs) for _, _, lengths, packs in sorted(open_packs)]


def slots(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset): where the pieces of a rank range go."""
    ranks: dict[int, int] = {}
    found, sequence = [], 0
    for lengths, packs in patterns:
        offset = 0
        for length in lengths:
            rank = ranks.get(length, 0)
            found.append((length, rank, rank + packs - 1, sequence, offset))
            ranks[length] = rank + packs
            offset += length
        sequence += packs
    return found


def ranked(pieces: DataFrame, keys: list[str], counts: dict[int, int], part_rows: int = PART_ROWS) -> DataFrame:
    """``pieces`` with _ll_rank, counted from 0 within each length; ``counts`` holds the rows of each.

    Rows of a length are dealt by hash into ``DEAL`` parts, or as many as leave a part
    ``part_rows`` rows, and numbered there; a part begins where the parts before it end. No task
    gets all rows of a frequent length.
    """
    hot = {length: -(-n // part_rows) for length, n in counts.items() if n > DEAL * part_rows}
    parts = F.lit(DEAL)
    if hot:
        parts = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in sorted(hot.items()) for x in pair]), F.col("length").cast("int")), parts)
    dealt = pieces.withColumn("_ll_part", F.pmod(F.xxhash64(*keys), parts).cast("int"))
    sizes = dealt.groupBy("length", "_ll_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_ll_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(
        "length", "_ll_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ll_begin")
    )
    inside = Window.partitionBy("length", "_ll_part").orderBy(*keys)
    numbered = dealt.withColumn("_ll_inside", F.row_number().over(inside) - 1)
    return (
        numbered.join(begins, ["length", "_ll_part"])
        .withColumn("_ll_rank", F.col("_ll_begin") + F.col("_ll_inside"))
        .drop("_ll_part", "_ll_inside", "_ll_begin")
    )


def assign_sequences(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with sequence_id and offset.

    Only the histogram, ``capacity`` rows at most, goes to the driver, and only the slots come
    back: at most two patterns arise per different length and pattern used up. Slots are joined
    to pieces by length and rank; that table is small whatever the number of pieces. ``pieces``
    is read three times and should be stored. Equal rows are numbered in any order, which leaves
    the result the same as a set.
    """
    rows = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["length"]: r["n"] for r in rows}
    found = slots(pack_histogram(counts, capacity))
    schema = "_ll_length long, _ll_from long, _ll_to long, _ll_sequence long, offset long"
    places = pieces.sparkSession.createDataFrame(found, schema)
    fits = [F.col("length") == F.col("_ll_length"), F.col("_ll_rank").between(F.col("_ll_from"), F.col("_ll_to"))]
    joined = ranked(pieces, keys, counts).join(F.broadcast(places), fits)
    return joined.withColumn("sequence_id", F.col("_ll_sequence") + F.col("_ll_rank") - F.col("_ll_from")).drop(
        "_ll_length", "_ll_rank", "_ll_from", "_ll_to", "_ll_sequence"
    )


def sequences(packed: DataFrame, capacity: int = CAPACITY, padding: int = 0) -> DataFrame:
    """sequence_id, ids and n_padding of each sequence of packed pieces (with ``ids``).

    A sequence is padded to ``capacity``, except where its length is a power of two. Its pieces,
    ``capacity`` ids in all, meet in one task.
    """
    piece = F.struct("offset", F.hex("ids").alias("ids"))
    grouped = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("_p"), F.sum("length").alias("_n"))
    whole = F.log2("_n") == F.floor(F.log2("_n"))
    room = F.when(whole, F.lit(0)).otherwise(capacity - F.col("_n"))
    pad = F.lit(np.array([padding], dtype="<u4").tobytes().hex())
    text = F.concat(F.array_join(F.transform("_p", lambda p: p["ids"]), ""), F.repeat(pad, room.cast("int")))
    return grouped.select("sequence_id", F.unhex(text).alias("ids"), room.cast("long").alias("n_padding"))


def pack_documents(docs: DataFrame, keys: list[str], with_ids: bool = True, **options) -> DataFrame:
    """Pieces of all documents with their place in the sequences; ``ids`` or, without, ids_crc32.

    ``keys`` number the pieces; with the piece's start they should tell rows apart.
    """
    pieces = token_pieces(docs, **options)
    if not with_ids:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return assign_sequences(stored(pieces), [*keys, "start"], options.get("capacity", CAPACITY))
