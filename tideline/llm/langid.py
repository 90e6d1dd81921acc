"""Language by cross-parsing entropy: which language's text needs the fewest phrases to spell a text."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import with_columns

UNKNOWN = "und"
# Bounds of the learning sample: passages per language, and characters of a passage.
PASSAGES, PASSAGE_CHARS = 120, 300
# Letters with a symbol of their own; rarer ones share a symbol.
ALPHABET = 250
# Symbols of a text that are parsed in one go. A phrase ends at the end of such a block.
BLOCK = 1024

SPACE, OTHER = 0, 1


def learning_sample(
    df: DataFrame, text: str = "text", lang: str = "lang", passages: int = PASSAGES, chars: int = PASSAGE_CHARS
) -> dict[str, list[str]]:
    """At most ``passages`` passages of at most ``chars`` characters per language.

    Rows and the places of the passages in them are chosen by hash of the text, so that the
    sample hangs neither on partitions nor on order. Rows without language or letter don't count.
    """
    rows = df.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    draw = F.xxhash64("text")
    # Copies of a text are one text, so texts are counted, not rows; the sketch is off by some 2 %.
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct(draw, 0.02).alias("n")).collect()}
    if not counts:
        return {}
    # Each language's share of a hash range is expected to hold three times the texts wanted.
    scale = 1 << 30
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(scale * min(1.0, 3 * passages / max(n, 1))))])
    near = rows.filter(F.pmod(draw, F.lit(scale)) <= F.element_at(shares, F.col("lang"))).distinct()
    start = F.pmod(F.shiftright(draw, 20), F.greatest(F.length("text") - chars, F.lit(0)) + 1)
    order = Window.partitionBy("lang").orderBy(draw, "passage")
    chosen = (
        near.select("lang", "text", F.substring("text", start.cast("int") + 1, F.lit(chars)).alias("passage"))
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= passages)
    )
    found: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "n").select("lang", "passage").collect():
        found.setdefault(row["lang"], []).append(row["passage"])
    return found


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the root."""
    longest, link, go = [0], [-1], [{}]
    last = 0
    for c in symbols:
        new = len(longest)
        longest.append(longest[last] + 1)
        link.append(0)
        go.append({})
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                clone = len(longest)
                longest.append(longest[p] + 1)
                link.append(link[q])
                go.append(dict(go[q]))
                link[q] = link[new] = clone
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
        last = new
    return go


@dataclass
class LanguageModel:
    """The automata of all languages in one table.

    ``steps[state + symbol]`` is four times the next state plus the phrases that ended on the
    way; states are multiples of ``width``.
    """

    languages: list[str]
    letters: str
    width: int
    roots: np.ndarray
    sizes: np.ndarray
    steps: np.ndarray


def learn(sample: dict[str, list[str]], alphabet: int = ALPHABET) -> LanguageModel:
    counts: dict[str, int] = {}
    for passages in sample.values():
        for letter in "".join(passages):
            if letter.isalpha():
                for c in letter.lower():
                    counts[c] = counts.get(c, 0) + 1
    letters = "".join(sorted(sorted(counts, key=lambda c: (-counts[c], c))[:alphabet]))
    languages = sorted(sample)
    width = len(letters) + 3  # space, other letters, the letters, and an end that leads to the root
    table = symbol_table(letters)
    blocks, roots, sizes, base = [], [], [], 0
    for language in languages:
        symbols = normalise(" ".join(sample[language]), table)
        automaton = suffix_automaton(symbols.tolist())
        go = np.full((len(automaton), width), -1, dtype=np.int64)
        for state, edges in enumerate(automaton):
            for c, target in edges.items():
                go[state, c] = target
        root = np.where(go[0] >= 0, go[0], 0)
        # A missing edge ends a phrase; a symbol that the language lacks is a phrase of its own.
        ended = 1 + (go[0] < 0).astype(np.int64)
        steps = np.where(go >= 0, go * 4, root[None, :] * 4 + ended[None, :])
        steps[0] = np.where(go[0] >= 0, go[0] * 4, 1)
        steps[1:, width - 1] = 1
        steps[0, width - 1] = 0
        state, phrases = steps >> 2, steps & 3
        blocks.append((((state + base) * width) << 2 | phrases).astype(np.int32).ravel())
        roots.append(base * width)
        sizes.append(max(2, len(symbols)))
        base += len(automaton)
    steps = np.concatenate(blocks) if blocks else np.zeros(0, np.int32)
    return LanguageModel(languages, letters, width, np.array(roots), np.array(sizes), steps)


@lru_cache(maxsize=2)
def symbol_table(letters: str) -> np.ndarray:
    """Symbol of every code point: its lower-case letter's, else that of a space."""
    table = np.zeros(0x110000, dtype=np.uint8)
    number = {c: i + 2 for i, c in enumerate(letters)}
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            table[point] = number.get(c.lower()[:1], OTHER)
    return table


def normalise(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of the lower-case letters, with one space for any run of other characters."""
    symbols = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    space = symbols == SPACE
    keep = ~space
    keep[1:] |= ~space[:-1]
    symbols = symbols[keep]
    if len(symbols) and symbols[0] == SPACE:
        symbols = symbols[1:]
    return symbols[:-1] if len(symbols) and symbols[-1] == SPACE else symbols


def phrases(texts: list[np.ndarray], model: LanguageModel) -> np.ndarray:
    """Phrases of each text under each language: blocks of all texts are walked side by side."""
    owner = np.repeat(np.arange(len(texts)), [-(-len(t) // BLOCK) for t in texts])
    counts = np.zeros((len(model.languages), len(texts)), dtype=np.int64)
    if not len(owner):
        return counts
    lengths = np.concatenate([[min(BLOCK, len(t) - i) for i in range(0, len(t), BLOCK)] for t in texts if len(t)])
    cells = np.full((len(owner), BLOCK), model.width - 1, dtype=np.uint8)
    row = 0
    for t in texts:
        whole = len(t) // BLOCK
        cells[row : row + whole] = t[: whole * BLOCK].reshape(whole, BLOCK)
        row += whole
        if len(t) % BLOCK:
            cells[row, : len(t) % BLOCK] = t[whole * BLOCK :]
            row += 1
    order = np.argsort(-lengths, kind="stable")
    columns = np.ascontiguousarray(cells[order].T).astype(np.int32)
    open_at = np.searchsorted(-lengths[order], -np.arange(BLOCK), side="left")
    state = np.repeat(model.roots.astype(np.int32)[:, None], len(owner), axis=1)
    ended = np.zeros(state.shape, dtype=np.int32)
    for i in range(BLOCK):
        n = open_at[i]
        if not n:
            break
        step = model.steps[state[:, :n] + columns[i, :n]]
        ended[:, :n] += step & 3
        state[:, :n] = step >> 2
    ended += state != model.roots[:, None]
    for k in range(len(model.languages)):
        counts[k] = np.bincount(owner[order], weights=ended[k], minlength=len(texts)).astype(np.int64)
    return counts


OUTPUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(df: DataFrame, model: Broadcast, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score; one pass over whole texts, no shuffle.

    A text of n symbols that parses into c phrases under a language of N learnt symbols costs
    c log2 N / n bits a symbol; the least wins, ties go to the first name. The score is the
    winner's share of 2^-bits over all languages. NULL texts, texts without a letter, and all
    texts if nothing was learnt, get ``und`` and 0. Rows are judged one by one, so equal rows get
    equal answers. Columns named lang_pred or score are replaced.
    """

    def compute(batch: pa.RecordBatch) -> list:
        known: LanguageModel = model.value
        table = symbol_table(known.letters)
        texts = [normalise(value or "", table) for value in batch.column(text).to_pylist()]
        if not known.languages:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
        bits = phrases(texts, known) * np.log2(known.sizes)[:, None]
        best = bits.argmin(axis=0)
        share = 1 / np.exp2(np.maximum(bits.min(axis=0) - bits, -1000)).sum(axis=0)
        some = np.array([len(t) > 0 for t in texts])
        names = np.where(some, np.array(known.languages, dtype=object)[best], UNKNOWN)
        return [names.tolist(), np.where(some, share, 0.0).tolist()]

    return with_columns(df, text, OUTPUT, compute)
