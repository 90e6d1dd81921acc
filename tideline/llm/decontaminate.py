"""Benchmark questions in a corpus, also with other numbers, names and units: template windows."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import CachedWords, bit_map, in_map, kept, slices, text_key, utf8_texts
from tideline.operators.groups import stored

# Tokens of a window; items with fewer tokens are one window of their own length.
WINDOW = 8
# Items with fewer tokens than this count only where they stand as a sentence or line of their own.
SHORTEST_ITEM = 5
# Tokens of an item that a text must repeat; the whole item where that is shorter.
ENOUGH_TOKENS = 13
# Bits of the map that benchmark windows set; doc windows that miss it are not joined.
MAP_BITS = 1 << 24

# Fixed values.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces "
    "pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week "
    "weeks month months year years cent cents dollar dollars euro euros percent degree degrees mph kmh watt watts volt "
    "volts joule joules byte bytes kb mb gb tb".split()
)
# Words that begin sentences and are no names, however they are written.
OPENERS = frozenset(
    "a about after all although an and any are as at because before both but by calculate can choose compare compute "
    "could describe determine did do does each estimate evaluate every explain find for from give given had has have he "
    "her his how i if in is it its let list many name no not of on one or our simplify she should since so solve some "
    "that the their then there these they this those to under until was we were what when where which while who whom "
    "whose why will with would write you your".split()
)
NUMBER = re.compile(r"[+-]?[$€£¥]?\d[\d.,:/]*(%|[a-z]{0,5})")
PLAIN, NUM, NAME, UNIT, NONE = 0, 1, 2, 3, 4

TOKEN = np.dtype(
    [("low", "<u8"), ("mid", "<u8"), ("value", "<u8"), ("low_type", "u1"), ("mid_type", "u1"), ("ends", "u1"), ("pad", "u1", 5)]
)
RECORD = struct.Struct("<QQQBB?5x")
FACTOR = np.uint64(0x9E3779B97F4A7C15)
# What ends a sentence.
ENDS = tuple(".!?:…")


def hashed(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


PLACEHOLDERS = {kind: hashed(f"<{name}>") for kind, name in ((NUM, "number"), (NAME, "name"), (UNIT, "unit"))}


def token(word: bytes) -> bytes:
    """A word as a record: its hash as a plain word and as a name, value, types, sentence end.

    Words lose punctuation at both ends and case. Numbers and units become placeholders; so does
    a capitalised word that is no common opener, as a name. At the start of a sentence both
    readings of such a word are open.
    """
    text = word.decode("utf-8", "replace")
    if text.isalpha():
        core, lowered, ends, number = text, text.lower(), False, None
    else:
        ends = text.rstrip("\"')]}*_”’»")[-1:] in ENDS
        start, stop = 0, len(text)
        while start < stop and not text[start].isalnum():
            start += 1
        while stop > start and not text[stop - 1].isalnum():
            stop -= 1
        core = text[start:stop]
        lowered = core.lower()
        number = NUMBER.fullmatch(lowered)
    low_type = PLAIN
    if not core:
        low_type = NONE
    elif lowered in NUMBER_WORDS or number and (number[1] in ("", "%", "st", "nd", "rd", "th") or number[1] in UNITS):
        low_type = NUM
    elif lowered in UNITS:
        low_type = UNIT
    mid_type = low_type
    if low_type == PLAIN and len(core) > 1 and core[0].isupper() and core[1:].islower() and lowered not in OPENERS:
        mid_type = NAME
    value = hashed(lowered)
    low, mid = PLACEHOLDERS.get(low_type, value), PLACEHOLDERS.get(mid_type, value)
    return RECORD.pack(low, mid, value, low_type, mid_type, ends)


def cached_tokens() -> CachedWords:
    return kept(("template tokens",), lambda: CachedWords(token))


class Tokens:
    """The tokens of a batch of texts, end to end."""

    def __init__(self, texts: list[bytes], known: CachedWords):
        pieces, line_sizes, text_sizes = [], [], []
        for raw in texts:
            size = 0
            for line in raw.split(b"\n"):
                words = line.split()
                if words:
                    pieces.append(b"".join(map(known.__getitem__, words)))
                    line_sizes.append(len(words))
                    size += len(words)
            text_sizes.append(size)
        records = np.frombuffer(b"".join(pieces), dtype=TOKEN)
        starts = np.zeros(len(records), dtype=bool)
        if len(records):
            starts[1:] = records["ends"][:-1] > 0
            starts[np.cumsum([0, *line_sizes[:-1]])] = True
        owner = np.repeat(np.arange(len(texts)), text_sizes)
        use = records["low_type"] != NONE
        # A token without letters hands the start of a sentence on to the next one.
        starts = np.diff(np.cumsum(starts)[use], prepend=0) > 0
        records, self.starts, self.owner = records[use], starts, owner[use]
        self.value = records["value"]
        # Sentence starts read as plain words, and as names.
        self.readings = [
            (np.where(starts, records["low"], records["mid"]), np.where(starts, records["low_type"], records["mid_type"])),
            (records["mid"], records["mid_type"]),
        ]
        self.open = starts & (records["low_type"] != records["mid_type"])
        self.sizes = np.bincount(self.owner, minlength=len(texts))
        self.place = np.arange(len(self.owner)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)

    def windows(self, n: int, shortest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """Windows of n tokens of one text: where they begin, their hashes, and the types they were read by.

        First the words as they stand, without types; then, from ``shortest`` tokens on, the
        templates of which half is plain words at least. A window that holds an open start has
        two templates.
        """
        m = len(self.value) - n + 1
        if m <= 0:
            return
        inside = self.owner[:m] == self.owner[n - 1 :]
        at = np.flatnonzero(inside)
        yield at, rolled(self.value, n, 1)[at], None
        if n < shortest:
            return
        for number, (hashes, types) in enumerate(self.readings):
            good = inside & (2 * spans(types == PLAIN, n) >= n)
            if number:
                good &= spans(self.open, n) > 0
            at = np.flatnonzero(good)
            yield at, rolled(hashes, n, 0)[at], types

    def alone(self, at: np.ndarray, n: int) -> np.ndarray:
        """Which windows are a whole sentence or line."""
        after = np.append(self.starts, True)[at + n]
        return self.starts[at] & after

    def slots(self, at: int, n: int, types: np.ndarray | None) -> list[int]:
        """Values of the placeholders of a window."""
        if types is None:
            return []
        return self.value[at : at + n][types[at : at + n] != PLAIN].view(np.int64).tolist()


def rolled(values: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of every n values in a row."""
    made = np.full(len(values) - n + 1, n + (seed << 32), dtype=np.uint64)
    for j in range(n):
        made = (made ^ (made >> np.uint64(29))) * FACTOR + values[j : j + len(made)]
    return made


def spans(marks: np.ndarray, n: int) -> np.ndarray:
    """How many of every n marks in a row are set."""
    total = np.concatenate([[0], np.cumsum(marks)])
    return total[n:] - total[:-n]


WINDOWS = "place long, size int, plain boolean, window long, slots array<long>"
WINDOW_TYPES = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.list_(pa.int64())]


def item_windows(benchmark: DataFrame, item: str, text: str, window: int, shortest: int) -> DataFrame:
    """item, tokens, place, size, plain, window, slots: every window of every item."""
    names = ["item", "tokens", "place", "size", "plain", "window", "slots"]

    def run(batches: Iterator[pa.RecordBatch]):
        known = cached_tokens()
        for batch in slices(batches, "text"):
            tokens = Tokens(utf8_texts(batch.column("text")), known)
            ids = batch.column("item").to_pylist()
            rows = []
            for n in range(1, window + 1):
                for begins, made, types in tokens.windows(n, shortest):
                    for at, value in zip(begins, made.view(np.int64)):
                        k = tokens.owner[at]
                        if n == window or tokens.sizes[k] == n:
                            found = (n, types is None, int(value), tokens.slots(at, n, types))
                            rows.append((ids[k], int(tokens.sizes[k]), int(tokens.place[at]), *found))
            yield from table(rows, names, [batch.schema.field("item").type, pa.int64(), *WINDOW_TYPES])

    kind = benchmark.schema[item].dataType.simpleString()
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"item {kind}, tokens long, {WINDOWS}")


def table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)


def text_windows(docs: DataFrame, text: str, sizes: list[int], bitmap: Broadcast, shortest: int) -> DataFrame:
    """_ll_key, _ll_check, place, size, plain, window, slots: the windows of all texts whose bit is set in the map."""
    names = ["_ll_key", "_ll_check", "place", "size", "plain", "window", "slots"]

    def run(batches: Iterator[pa.RecordBatch]):
        known, bits = cached_tokens(), bitmap.value
        for batch in slices(batches, "text"):
            tokens = Tokens(utf8_texts(batch.column("text")), known)
            key, check = batch.column("_ll_key").to_numpy(), batch.column("_ll_check").to_numpy()
            rows = []
            for n in sizes:
                for at, made, types in tokens.windows(n, shortest):
                    hit = in_map(made, bits)
                    if n < shortest:
                        hit &= tokens.alone(at, n)
                    for i, value in zip(at[hit], made[hit].view(np.int64)):
                        k = tokens.owner[i]
                        found = (n, types is None, int(value), tokens.slots(i, n, types))
                        rows.append((int(key[k]), int(check[k]), int(tokens.place[i]), *found))
            yield from table(rows, names, [pa.int64(), pa.int32(), *WINDOW_TYPES])

    rows = docs.select(*text_key(text), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"_ll_key long, _ll_check int, {WINDOWS}")


def contaminated_texts(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, enough: int = ENOUGH_TOKENS, shortest: int = SHORTEST_ITEM, bits: int = MAP_BITS,
) -> DataFrame:
    """_ll_key, _ll_check, item_ids, matched_tokens, kind of each text that repeats enough of an item.

    Windows of texts and items are joined by hash: words as they stand, and templates. Where a
    text matches an item at one distance (diagonal), a value of the item must stand for one value
    of the text; template windows that hold a value with two are dropped, other windows stay. An
    item counts if its windows that are left cover ``enough`` of its tokens, or all of them; one
    of fewer than ``shortest`` tokens counts where it is a sentence or line of its own, word for
    word. kind is ``verbatim`` if words as they stand are enough for some item, else
    ``reparameterised``.
    """
    items = stored(item_windows(benchmark, item, item_text, window, shortest))
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    bitmap = docs.sparkSession.sparkContext.broadcast(bit_map(items, "window", bits))
    found = text_windows(docs, text, sizes, bitmap, shortest)
    # Copies of a text say the same; they are reduced before they are shuffled.
    found = found.groupBy("_ll_key", "_ll_check", "place", "size", "plain", "window").agg(F.first("slots").alias("slots"))
    named = items.select(
        "item", "tokens", F.col("place").alias("item_place"), "size", "plain", "window", F.col("slots").alias("item_slots")
    )
    hits = stored(
        found.join(named, ["size", "plain", "window"]).withColumn("shift", F.col("place") - F.col("item_place"))
    )
    diagonal = ["_ll_key", "_ll_check", "item", "shift"]
    pairs = F.arrays_zip(F.col("item_slots").alias("theirs"), F.col("slots").alias("ours"))
    filled = hits.filter("NOT plain").select(*diagonal, F.explode(pairs).alias("p")).select(*diagonal, "p.theirs", "p.ours")
    clashes = (
        filled.groupBy(*diagonal, "theirs").agg(F.min("ours").alias("least"), F.max("ours").alias("most"))
        .filter("least < most").groupBy(*diagonal).agg(F.collect_list("theirs").alias("clashing"))
    )
    # NULL ids of items are one item of their own here; <=> keeps them.
    left = hits.alias("h").join(
        clashes.alias("c"), F.expr(" AND ".join(f"h.{c} <=> c.{c}" for c in diagonal)), "left"
    ).filter("h.plain OR c.clashing IS NULL OR NOT arrays_overlap(h.item_slots, c.clashing)").select("h.*")
    offsets = left.groupBy("_ll_key", "_ll_check", "item", "tokens", "item_place", "size").agg(F.max("plain").alias("plain"))
    at_least = F.least("tokens", F.lit(enough))
    whole = ["_ll_key", "_ll_check", "item", "tokens"]
    pieces = Window.partitionBy(*whole).orderBy("item_place")
    words = Window.partitionBy(*whole, "plain").orderBy("item_place")

    def new(window) -> Column:
        return F.least(F.col("size"), F.coalesce(F.col("item_place") - F.lag("item_place").over(window), F.col("size")))

    covered = (
        offsets.withColumns({"new": new(pieces), "new_words": F.when(F.col("plain"), new(words)).otherwise(F.lit(0))})
        .groupBy(*whole)
        .agg(F.sum("new").alias("covered"), F.sum("new_words").alias("words"))
    )
    return (
        covered.filter(F.col("covered") >= at_least)
        .groupBy("_ll_key", "_ll_check")
        .agg(
            F.sort_array(F.collect_set("item")).alias("item_ids"),
            F.max("covered").alias("matched_tokens"),
            F.when(F.max(F.col("words") >= at_least), F.lit("verbatim")).otherwise(F.lit("reparameterised")).alias("kind"),
        )
    )


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with contaminated, item_ids, matched_tokens and kind (NULL for clean texts).

    Whole texts are searched. What is found hangs on the text alone, so equal rows get equal
    answers; NULL and empty texts are clean. Items with NULL text or without a word have no windows; NULL ids are not listed. Columns of ``docs`` that are named
    like an added one are replaced. The findings are stored; Spark decides by their size how to
    join them.
    """
    added = ["contaminated", "item_ids", "matched_tokens", "kind"]
    found = stored(contaminated_texts(docs, benchmark, text, **options))
    key, check = text_key(text)
    rows = docs.drop(*added).withColumns({"_ll_key": key, "_ll_check": check})
    joined = rows.join(found, ["_ll_key", "_ll_check"], "left")
    return joined.withColumn("contaminated", F.col("kind").isNotNull()).select(
        *[c for c in docs.columns if c not in added], *added
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text repeats no benchmark item; columns as they are."""
    found = stored(contaminated_texts(docs, benchmark, text, **options).select("_ll_key", "_ll_check"))
    key, check = text_key(text)
    return docs.withColumns({"_ll_key": key, "_ll_check": check}).join(found, ["_ll_key", "_ll_check"], "left_anti").select(*docs.columns)
