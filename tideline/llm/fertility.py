"""Quality rules: word and repetition counts, and how a public vocabulary splits the text's words."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import FEWER_WORDS, CachedWords, utf8_texts, with_columns
from tideline.llm.common import kept as of_worker
from tideline.operators.groups import stored

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Bands:
    """When a text is rejected. Bands reach ``spread`` interquartile ranges beyond the quartiles.

    A band is that of a language's texts of like size (the tokens' power of two); where those are
    fewer than ``least_rows`` that of the language, of the script, and at last of all texts. Token
    entropy grows with the size, so its band falls back to all texts of like size first. Margins
    are added to every band, and ``errors`` times what a measure of so few tokens is off by
    chance: short texts are judged too, by wider bands. A band of texts of like size holds part of
    that chance already and gets ``like_size`` of it. ``token_chars`` and ``token_bits`` are
    standard deviations of the characters and of the information of one token.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    spread: float = 2.0
    least_rows: int = 100
    chars_margin: float = 0.02
    byte_margin: float = 0.05
    entropy_margin: float = 0.1
    errors: float = 2.0
    like_size: float = 0.4
    token_chars: float = 2.0
    token_bits: float = 2.5


# Lead bytes of UTF-8 that tell scripts apart, and names for them. Fixed values.
SCRIPTS = (
    ("latin", (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA))),
    ("greek, cyrillic, armenian", range(0xCD, 0xD6)),
    ("hebrew, arabic", range(0xD6, 0xE0)),
    ("indic, thai", (0xE0, 0xE1)),
    ("han, kana", range(0xE3, 0xEA)),
    ("hangul", range(0xEA, 0xEE)),
)
SCRIPT_OF_BYTE = np.full(256, len(SCRIPTS))
for number, (_, leads) in enumerate(SCRIPTS):
    SCRIPT_OF_BYTE[list(leads)] = number


def script(raw: bytes) -> str:
    """The script that most letters of a UTF-8 text are of; '' without any."""
    found = np.bincount(SCRIPT_OF_BYTE[np.frombuffer(raw, dtype=np.uint8)], minlength=len(SCRIPTS) + 1)[:-1]
    return SCRIPTS[int(found.argmax())][0] if found.any() else ""


FEATURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("n_tokens", T.LongType())]
    + [T.StructField(n, T.DoubleType()) for n in ("chars_per_token", "byte_share", "token_entropy")]
    + [T.StructField("script", T.StringType())]
)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of five words which the text holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered[i : i + WINDOW] = b"\x01" * WINDOW
    return sum(covered)


def entropy(counts: np.ndarray) -> float:
    share = counts / counts.sum()
    return float(-(share * np.log2(share)).sum())


def text_features(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with counts of words and repetitions and with the vocabulary's figures; one pass.

    Words are runs of anything but \\x20 and \\x09-\\x0D; a word is split into tokens by itself,
    so white space plays no part. NULL and empty texts have zeros. Same-named columns of ``df``
    are replaced.
    """

    def words_as_ids():
        pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        n = pieces.get_piece_size()
        fallback = np.array([pieces.is_byte(i) for i in range(n)])
        kind = np.uint16 if n <= 1 << 16 else np.uint32
        words = CachedWords(lambda word: np.array(pieces.encode(word.decode("utf-8", "replace")), dtype=kind).tobytes(), FEWER_WORDS)
        return words, fallback, kind

    def compute(batch: pa.RecordBatch) -> list:
        known, fallback, kind = of_worker(("word pieces", vocabulary), words_as_ids)
        rows = []
        for raw in utf8_texts(batch.column(text)):
            words = raw.split()
            spaces = len(raw) - len(raw.translate(None, SPACES))
            points = len(raw.decode("utf-8", "replace"))
            lines = [line for line in raw.split(b"\n") if line.strip()]
            ids = np.frombuffer(b"".join(map(known.__getitem__, words)), dtype=kind)
            chars = points - spaces
            figures = (0.0, 0.0, 0.0)
            if len(ids):
                counts = np.bincount(ids) if len(ids) > 4000 else np.unique(ids, return_counts=True)[1]
                figures = (chars / len(ids), float(fallback[ids].mean()), entropy(counts[counts > 0]))
            symbols = len(raw) - len(raw.translate(None, SYMBOLS))
            duplicates = len(lines) - len(set(lines))
            rows.append((len(words), chars, symbols, duplicates, repeated_words(words), len(ids), *figures, script(raw)))
        return [list(column) for column in zip(*rows)]

    return with_columns(df, text, FEATURES, compute)


def base_failed(bands: Bands):
    few = F.col("n_words") < bands.min_words
    return few | (100 * F.col("n_repeat_words") > bands.max_repeat_percent * F.col("n_words"))


MEASURES = ("chars_per_token", "byte_share", "token_entropy")


def quartiles(features: DataFrame, group: list[str]) -> DataFrame:
    """Quartiles of each measure, rounded to hundredths, per group: exact, from counts of values.

    Rows are counted before they are shuffled, so what is sorted are different values only.
    """
    named = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), F.round(m, 2).alias("value")) for m in MEASURES])
    )
    counts = features.select(*group, named.alias("m")).groupBy(*group, "m.measure", "m.value").agg(
        F.count(F.lit(1)).alias("n")
    )
    upto = Window.partitionBy(*group, "measure").orderBy("value")
    everything = Window.partitionBy(*group, "measure")
    ranked = counts.withColumns({"upto": F.sum("n").over(upto), "rows": F.sum("n").over(everything)})

    def at(share, measure):
        reached = (F.col("measure") == measure) & (F.col("upto") >= F.ceil(F.col("rows") * share))
        return F.min(F.when(reached, F.col("value")))

    found = [at(q, m).alias(f"_ll_{m}_q{i}") for m in MEASURES for i, q in ((1, 0.25), (3, 0.75))]
    return ranked.groupBy(*group).agg(F.max("rows").alias("_ll_rows"), *found)


def limits(features: DataFrame, group: list[str], bands: Bands, least_rows: int) -> DataFrame:
    """The ends of the bands of each group of enough rows, stored; column names end in the group's."""

    def end(m: str, side: int, margin: float):
        q1, q3 = F.col(f"_ll_{m}_q1"), F.col(f"_ll_{m}_q3")
        return (q1 if side < 0 else q3) + side * (bands.spread * (q3 - q1) + margin)

    ends = {
        "least_chars": end("chars_per_token", -1, bands.chars_margin),
        "most_chars": end("chars_per_token", 1, bands.chars_margin),
        "most_bytes": end("byte_share", 1, bands.byte_margin),
        "least_entropy": end("token_entropy", -1, bands.entropy_margin),
    }
    found = quartiles(features, group).filter(F.col("_ll_rows") >= least_rows)
    return stored(found.select(*group, *[e.alias(f"_ll_{name}{''.join(group)}") for name, e in ends.items()]))


LANGUAGE, SIZE, SCRIPT, ALL = "_ll_lang", "_ll_size", "_ll_script", "_ll_all"
GROUPS = ([LANGUAGE, SIZE], [LANGUAGE], [SCRIPT], [SIZE], [ALL])


def judge_quality(
    df: DataFrame,
    bands: Bands = Bands(),
    text: str = "text",
    lang: str = "lang",
    vocabulary: str = VOCABULARY,
    keep_text: bool = True,
) -> DataFrame:
    """``df`` with its features, base_failed and kept. Bands come from all rows of ``df``.

    Rejected are texts that fail a base rule (too few words, too much of it repeated) and those
    outside their band: characters per token too few or too many, too large a share of byte
    fallback, too little token entropy. Every text is held against a band, however short it is
    and however few texts its language has. Rows without language are a group of their own.
    Features (with the text, unless ``keep_text`` is off) and bands are stored, so Spark knows the
    bands' size when it joins them; they have a row per language and power of two.
    NULL and empty texts fail the base rules; an empty table gives an empty one.
    """
    features = text_features(df, text, vocabulary)
    measured = stored(
        (features if keep_text else features.drop(text))
        .withColumn("base_failed", base_failed(bands))
        .withColumn(SIZE, F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int"))
        .withColumn(LANGUAGE, F.coalesce(F.col(lang).cast("string"), F.lit("")))
        .withColumn(SCRIPT, F.col("script"))
        .withColumn(ALL, F.lit(0))
    )
    sound = measured.filter(~F.col("base_failed"))
    judged = measured
    for group in GROUPS:
        judged = judged.join(limits(sound, group, bands, 1 if group == [ALL] else bands.least_rows), group, "left")

    def limit(name: str, *groups: list[str]):
        return F.coalesce(*[F.col(f"_ll_{name}{''.join(group)}") for group in groups])

    by_size, by_language, by_script, by_length, by_all = GROUPS
    chain = by_size, by_language, by_script, by_all
    errors = F.when(limit("least_chars", by_size).isNotNull(), bands.errors * bands.like_size).otherwise(bands.errors)
    error = errors / F.sqrt(F.greatest("n_tokens", F.lit(1)))
    most_bytes = limit("most_bytes", *chain)
    outside = (
        (F.col("chars_per_token") < limit("least_chars", *chain) - error * bands.token_chars)
        | (F.col("chars_per_token") > limit("most_chars", *chain) + error * bands.token_chars)
        | (F.col("byte_share") > most_bytes + error * F.sqrt(most_bytes * F.greatest(1 - most_bytes, F.lit(0.0))))
        | (F.col("token_entropy") < limit("least_entropy", by_size, by_length, by_all) - error * bands.token_bits)
    )
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False)))
    return judged.select(*[c for c in features.columns if c != text or keep_text], "base_failed", "kept")
