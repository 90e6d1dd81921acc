"""Quality classifier: averaged vectors of hashed words and character n-grams, softmax output."""

from __future__ import annotations

import math
import operator
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import CachedWords, kept, utf8_texts, with_columns

BUCKETS = 1 << 17
# The last bucket stands for the word bigram of a word and itself.
REPEAT = BUCKETS
DIMENSIONS, EPOCHS, RATE, SEED = 10, 8, 0.25, 42
# Bounds of the learning sample: rows per label, and words of a row (a stretch chosen by hash).
ROWS_PER_LABEL, WORDS_PER_ROW = 1_000, 300
SHORTEST, LONGEST = 3, 5


def features(word: bytes) -> list[int]:
    """Buckets of the word and of its character n-grams, with borders marked."""
    marked = f"<{word.decode('utf-8', 'replace')}>"
    found = [zlib.crc32(word)]
    for n in range(SHORTEST, LONGEST + 1):
        found += [zlib.crc32(marked[i : i + n].encode()) for i in range(len(marked) - n + 1)]
    return [h % BUCKETS for h in found]


def document_features(words: list[bytes], of_word) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and how often each occurs."""
    buckets = [b for word in words for b in of_word[word]]
    buckets += [REPEAT] * sum(map(operator.eq, words, words[1:]))
    return np.unique(np.array(buckets, dtype=np.int64), return_counts=True)


def learning_sample(
    docs: DataFrame, labels: DataFrame, key: str, label: str, text: str = "text", rows: int = ROWS_PER_LABEL
) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """At most ``rows`` (text, label) per label 0 and 1, and how many labelled keys there are of each.

    Labelled keys are chosen by hash first, so that only ``2 * rows`` keys are sent to the
    documents and no text is shuffled but the chosen. Rows without key or label don't count.
    """
    labelled = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(label).cast("int").alias("label")
    ).distinct()
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    # A share of the hash range is expected to hold three times the keys wanted; the rest is not sorted.
    scale, draw = 1 << 30, F.xxhash64("key")
    wanted = F.lit(False)
    for k, n in counts.items():
        wanted |= (F.col("label") == k) & (F.pmod(draw, F.lit(scale)) <= int(scale * min(1.0, 3 * rows / n)))
    first = Window.partitionBy("label").orderBy(draw, "key")
    keys = labelled.filter(wanted).withColumn("n", F.row_number().over(first)).filter(F.col("n") <= rows).drop("n")
    # A text may be long, so tasks cut it to the stretch that is learnt from.
    whole = F.coalesce(F.col(text), F.lit(""))
    begin = F.pmod(F.xxhash64(whole), F.greatest(F.length(whole) - 12 * WORDS_PER_ROW, F.lit(0)) + 1)
    stretches = docs.select(
        F.col(key).alias("key"), F.substring(whole, begin.cast("int") + 1, F.lit(12 * WORDS_PER_ROW)).alias("text")
    )
    again = Window.partitionBy("label").orderBy(F.xxhash64("key"), "key", "text")
    chosen = stretches.join(F.broadcast(keys), "key").withColumn("n", F.row_number().over(again)).filter(F.col("n") <= rows)
    return [(r["text"], r["label"]) for r in chosen.orderBy("label", "n").collect()], counts


def learn(sample: list[tuple[str, int]], counts: dict[int, int]) -> tuple[np.ndarray, float]:
    """What each bucket adds to the log odds of label 1, and the log odds of a text without words.

    Vectors and output weights are learnt by stochastic gradient descent on the mean vector of
    each document; both are then multiplied out. The odds of the sample are turned into those of
    all labelled rows.
    """
    of_word = CachedWords(features)
    documents = [(document_features(text.encode().split()[:WORDS_PER_ROW], of_word), label) for text, label in sample]
    documents = [(x, label) for x, label in documents if len(x[0])]
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + 1, DIMENSIONS))
    output = np.zeros((2, DIMENSIONS))
    steps, done = max(1, EPOCHS * len(documents)), 0
    for _ in range(EPOCHS):
        for k in random.permutation(len(documents)):
            (buckets, times), label = documents[k]
            rate = RATE * (1 - done / steps)
            share = times / times.sum()
            hidden = share @ vectors[buckets]
            logits = output @ hidden
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum()
            error[label] -= 1
            back = error @ output
            output -= rate * np.outer(error, hidden)
            vectors[buckets] -= rate * np.outer(share * min(len(buckets), 50), back)
            done += 1
    drawn = {k: sum(label == k for _, label in documents) for k in (0, 1)}
    prior = math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))
    bias = prior - math.log((drawn[1] + 1) / (drawn[0] + 1))
    return vectors @ (output[1] - output[0]), bias if documents else prior


OUTPUT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score(df: DataFrame, model: Broadcast, text: str = "text") -> DataFrame:
    """``df`` with score (chance of label 1) and predicted (score of 0.5 or more); one pass, no shuffle.

    NULL and empty texts and texts without a word get the share of label 1 among the learnt rows
    (0.5 if there were none). Rows are scored one by one; columns named score or predicted are
    replaced. A word's buckets are summed up once and kept, as the mean over a document is linear.
    """
    run = uuid.uuid4().hex

    def compute(batch: pa.RecordBatch) -> list:
        weights, bias = model.value
        # Real part: sum of the weights; imaginary part: number of buckets.
        known = kept(
            ("word odds", run), lambda: CachedWords(lambda w: complex(weights[b := features(w)].sum(), len(b)))
        )
        odds = []
        for value in utf8_texts(batch.column(text)):
            words = value.split()
            total = sum(map(known.__getitem__, words), 0j)
            repeats = sum(map(operator.eq, words, words[1:]))
            total += complex(repeats * weights[REPEAT], repeats)
            odds.append(bias + (total.real / total.imag if total.imag else 0.0))
        chance = 1 / (1 + np.exp(-np.clip(np.array(odds), -500, 500)))
        return [chance.tolist(), (chance >= 0.5).astype(int).tolist()]

    return with_columns(df, text, OUTPUT, compute)
