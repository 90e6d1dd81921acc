"""Periodic runs of words, by recompression of the texts to a run-length grammar."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import utf8_texts, with_columns

# Grid points that are looked at in one go.
GRID_POINTS = 1_000_000
SEED = 42

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FOUND = T.StructType(
    [
        T.StructField("n_runs", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("strongest", RUN),
        T.StructField("collapsed", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Runs:
    """A run has at least ``words`` words and ``times`` periods; ``times`` is 2 at least."""

    words: int = 6
    times: int = 4


# ---- the grammar --------------------------------------------------------------------


@dataclass
class Level:
    """Symbols of one level, and how the next one groups them: ``parent`` of each, whether a group
    begins or ends with it, and the steps within a block of equal symbols to its end or start."""

    symbols: np.ndarray
    parent: np.ndarray | None = None
    opens: np.ndarray | None = None
    closes: np.ndarray | None = None
    ahead: np.ndarray | None = None
    behind: np.ndarray | None = None
    first: np.ndarray | None = field(default=None)
    last: np.ndarray | None = field(default=None)


def regroup(symbols: np.ndarray, opens: np.ndarray, block: bool, codes: np.ndarray) -> tuple[Level, np.ndarray]:
    """The level with its groups, and the symbols of the next level, one number for each code."""
    first = np.flatnonzero(opens)
    parent = np.cumsum(opens) - 1
    last = np.append(first[1:], len(symbols)) - 1
    closes = np.zeros(len(symbols), dtype=bool)
    closes[last] = True
    place = np.arange(len(symbols))
    ahead = last[parent] - place + 1 if block else None
    behind = place - first[parent] + 1 if block else None
    level = Level(symbols, parent, opens, closes, ahead, behind, first, last)
    return level, np.unique(codes, return_inverse=True)[1]


def recompress(words: np.ndarray, ends: np.ndarray) -> list[Level]:
    """Levels of the grammar over texts that follow one another, each closed by a symbol of its own.

    In turn, blocks of equal symbols become one symbol per symbol and length, and pairs whose left
    symbol is on the one side and whose right symbol on the other side of a split of the alphabet
    become one symbol each. Equal stretches are thus grouped alike but at their borders. Closing
    symbols are never grouped, so the last level has one symbol per text.
    """
    chance = np.random.default_rng(SEED)
    symbols, closing = words, ends
    levels: list[Level] = []
    while True:
        same = symbols[1:] == symbols[:-1]
        if same.any():
            opens = np.append(True, ~same)
            sizes = np.diff(np.append(np.flatnonzero(opens), len(symbols)))
            level, above = regroup(symbols, opens, True, symbols[opens] * np.int64(sizes.max() + 1) + sizes)
            levels.append(level)
            closing, symbols = level.parent[closing], above
        inner = np.ones(len(symbols), dtype=bool)
        inner[closing] = False
        if not (inner[1:] & inner[:-1]).any():
            levels.append(Level(symbols))
            return levels
        alphabet = int(symbols.max()) + 1
        side = chance.integers(0, 2, alphabet).astype(np.int8)
        side[symbols[closing]] = 2
        sides = side[symbols]
        pairs = [(sides[:-1] == one) & (sides[1:] == 1 - one) for one in (0, 1)]
        pair = max(pairs, key=np.count_nonzero)
        if not pair.any():
            continue
        opens = np.append(True, ~pair)
        first = np.flatnonzero(opens)
        second = np.zeros(len(first), dtype=np.int64)
        held = np.append(pair, False)[first]
        second[held] = symbols[first[held] + 1] + 1
        level, above = regroup(symbols, opens, False, symbols[first] * np.int64(alphabet + 1) + second)
        levels.append(level)
        closing, symbols = level.parent[closing], above


def mirrored(levels: list[Level]) -> list[Level]:
    """The same levels read from the right."""
    made = []
    for k, level in enumerate(levels):
        if level.parent is None:
            made.append(Level(level.symbols[::-1]))
            continue
        above = len(levels[k + 1].symbols)
        made.append(
            Level(
                level.symbols[::-1],
                above - 1 - level.parent[::-1],
                level.closes[::-1],
                level.opens[::-1],
                None if level.behind is None else level.behind[::-1],
                None if level.ahead is None else level.ahead[::-1],
                (len(level.symbols) - 1 - level.last)[::-1],
                (len(level.symbols) - 1 - level.first)[::-1],
            )
        )
    return made


def extension(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For pairs of places x < y of one text, how many words from there on are equal.

    On the way up, a pair that does not begin a group steps over the rest of it, and rises when both
    begin one; it waits where its symbols differ. On the way down it goes to the first symbols
    below and steps over what is equal there: within one group, since unlike groups of one level
    differ within their common length.
    """
    start, x, y = x, x.copy(), y.copy()
    waits = np.full(len(x), len(levels) - 1)
    rising = np.arange(len(x))
    for t, level in enumerate(levels[:-1]):
        a, b = x[rising], y[rising]
        equal = level.symbols[a] == level.symbols[b]
        step = equal & ~(level.opens[a] & level.opens[b])
        jump = 1 if level.ahead is None else np.minimum(level.ahead[a], level.ahead[b])[step]
        a[step] += jump
        b[step] += jump
        equal[step] = level.symbols[a[step]] == level.symbols[b[step]]
        equal &= level.opens[a] & level.opens[b]
        x[rising], y[rising] = a, b
        waits[rising[~equal]] = t
        rising = rising[equal]
        x[rising], y[rising] = level.parent[a[equal]], level.parent[b[equal]]
    for t in range(len(levels) - 2, -1, -1):
        level = levels[t]
        low = np.flatnonzero(waits > t)
        a, b = level.first[x[low]], level.first[y[low]]
        equal = level.symbols[a] == level.symbols[b]
        jump = 1 if level.ahead is None else np.minimum(level.ahead[a], level.ahead[b])[equal]
        a[equal] += jump
        b[equal] += jump
        x[low], y[low] = a, b
    return x - start


# ---- runs ---------------------------------------------------------------------------


def grid(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and period of the harmonic grid's points that may lie in a run.

    A run of ``times`` periods holds as many points of its period's grid in a row, and their words
    are equal.
    """
    periods = sizes // times
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (sizes[text] - 1) // period - (times - 2)
    total = np.cumsum(points)
    found = []
    start = 0
    while start < len(text):
        done = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + GRID_POINTS, "right")))
        n = points[start:stop]
        row = np.repeat(np.arange(start, stop), n)
        step = period[row]
        at = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * step + starts[text[row]]
        for k in range(1, times):
            same = np.flatnonzero(words[at] == words[at + k * step])
            row, step, at = row[same], step[same], at[same]
        found.append((text[row], at, step))
        start = stop
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found))


def runs_of(texts: list[list[bytes]], rule: Runs = Runs()) -> list[np.ndarray]:
    """Start, length and smallest period of every run of each text, by start and period."""
    ids: defaultdict = defaultdict(count().__next__)
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    words = np.fromiter((i for found in texts for i in map(ids.__getitem__, found)), dtype=np.int64, count=int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    text, at, period = grid(words, starts, sizes, rule.times)
    none = np.zeros((0, 3), dtype=np.int64)
    result = [none] * len(texts)
    if not len(text):
        return result
    # Only texts with a candidate are compressed, with a symbol that occurs once before and after each.
    held, text = np.unique(text, return_inverse=True)
    moved = np.cumsum(sizes[held] + 1) - sizes[held]
    at = at - starts[held][text] + moved[text]
    ends = np.append(0, moved + sizes[held])
    joined = np.empty(int(ends[-1]) + 1, dtype=np.int64)
    inner = np.ones(len(joined), dtype=bool)
    inner[ends] = False
    joined[inner] = np.concatenate([words[starts[i] : starts[i] + sizes[i]] for i in held])
    joined[ends] = len(ids) + np.arange(len(ends))
    levels = recompress(joined, ends)
    back, n = mirrored(levels), len(joined)
    order = np.lexsort((at, period, text))
    text, at, period = text[order], at[order], period[order]
    made = []
    asked = 1
    while len(at):
        # Of each chain of neighbouring points the first 1, 2, 4, ... are asked for; what lies in the
        # run of the last of them is settled by it.
        opens = np.append(True, (text[1:] != text[:-1]) | (period[1:] != period[:-1]) | (at[1:] != at[:-1] + period[1:]))
        chain, first = np.cumsum(opens) - 1, np.flatnonzero(opens)
        head = np.arange(len(at)) - first[chain] < asked
        x, q, of = at[head], period[head], text[head]
        stop = x + q + extension(levels, x, x + q)
        begin = x - extension(back, n - x - q, n - x)
        made.append(np.stack([of, begin, stop, q], axis=1))
        settled = np.zeros(len(first), dtype=np.int64)
        np.maximum.at(settled, chain[head], stop)
        rest = ~head & (at + (rule.times - 1) * period >= settled[chain])
        text, at, period = text[rest], at[rest], period[rest]
        asked *= 2
    runs = np.concatenate(made)
    # Of several periods of one stretch the smallest is the run's own.
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.append(True, (runs[1:, :3] != runs[:-1, :3]).any(axis=1))]
    length = runs[:, 2] - runs[:, 1]
    runs = runs[length >= np.maximum(rule.words, rule.times * runs[:, 3])]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    cuts = np.searchsorted(runs[:, 0], np.arange(len(held) + 1))
    for k, i in enumerate(held):
        part = runs[cuts[k] : cuts[k + 1]]
        result[i] = np.stack([part[:, 1] - moved[k], part[:, 2] - part[:, 1], part[:, 3]], axis=1)
    return result


def strongest(runs: np.ndarray) -> dict | None:
    """The run with the most periods, exactly; of equals the one of smallest start, then period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best and dict(zip(RUN.fieldNames(), best))


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, of each run only its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(depth[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


Rewrite = Callable[[object, list[bytes]], list[bytes]]


def mark_runs(docs: DataFrame, text: str = "text", row_id: str = "doc_id", rule: Runs = Runs(), rewrite: Rewrite | None = None) -> DataFrame:
    """``docs`` without the text, with n_runs, runs, the strongest run and the collapsed text.

    Words are what stands between whitespace. A run is a stretch of words with smallest period q and
    at least ``max(rule.words, rule.times * q)`` words that no neighbouring word extends; runs are
    listed by start and period. ``strongest`` has the greatest length to period, compared exactly.
    ``collapsed`` keeps of each run its first period. ``rewrite(id, words)`` may change the words of
    a row beforehand; the id is NULL where the row has none.

    NULL and blank texts have no runs (an empty list, no strongest one, an empty text). Rows do not
    depend on one another, so equal rows give equal results; the other columns stay, columns named
    like the new ones are replaced. Each text is worked on whole, in one task, with memory of some
    300 bytes a word of a text with candidates.
    """

    def compute(batch: pa.RecordBatch) -> list:
        texts = [value.split() for value in utf8_texts(batch.column(text))]
        if rewrite:
            texts = [rewrite(i, words) for i, words in zip(batch.column(row_id).to_pylist(), texts)]
        rows = []
        for words, runs in zip(texts, runs_of(texts, rule)):
            listed = [dict(zip(RUN.fieldNames(), run)) for run in runs.tolist()]
            rows.append((len(runs), listed, strongest(runs), collapse(words, runs).decode()))
        return [list(column) for column in zip(*rows)] if rows else [[], [], [], []]

    new = FOUND.fieldNames()
    given = docs.select(*[name for name in docs.columns if name not in new or name in (text, row_id)])
    return with_columns(given, text, FOUND, compute).drop(text)


# ---- the query's texts and digests ---------------------------------------------------


def plant(row_id: object, words: list[bytes]) -> list[bytes]:
    """Words of which every tenth id's repeat from some place on, by the crc32 of the id as text."""
    if row_id is None or not words:
        return words
    h = zlib.crc32(str(row_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_digests() -> list[Column]:
    """The strongest run's numbers, and digests of the list of runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return [
        F.col("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ]
