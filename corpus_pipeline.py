"""A training-corpus pipeline over ``documents``: rules, repeated lines, near duplicates, leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All
but the last return the columns of ``docs``. A stage's result reads what the stage stored on its way;
that is deleted when a later stage is called, by when the result has been written, unless the
later stage's docs read it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontaminate, fertility, line_dedup, near_dups, packing
from tideline.operators.groups import Scope, owning, stored, storing

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# What earlier stages stored.
LEFT: list[Scope] = []


def release(docs: DataFrame) -> None:
    """Delete what stages stored, except for what ``docs`` reads."""
    for scope in [scope for scope in LEFT if not scope.reads(docs)]:
        scope.close()
        LEFT.remove(scope)


def stage(function: Stage) -> Stage:
    """A stage that owns what it stores, and before it starts deletes what earlier ones stored."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(docs)
        scope = Scope(None)
        LEFT.append(scope)
        with owning(scope):
            return function(spark, docs, sf_dir)

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no base rule and lie within their language's bands.

    NULL and empty texts go (they have too few words); equal rows are judged alike; bands come
    from all of ``docs``. An empty table gives an empty one.
    """
    return fertility.judge_quality(docs).filter("kept").select(*docs.columns)


@stage
def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of lines are cut out; documents of which nothing is left go. n_chars follows.

    Earlier is what has the smaller doc_id (NULL first; rows that tie in a fixed order), so of equal
    rows one keeps its lines. NULL and empty texts stay as they are. An empty table gives an empty one.
    """
    cut = line_dedup.dedup_lines(docs).filter("n_deleted = 0 OR n_deleted < n_lines")
    if "n_chars" in docs.columns:
        chars = F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one of smallest doc_id, NULL last, of equal rows one.

    NULL and empty texts are equal, so one of them stays. An empty table gives an empty one.
    """
    return near_dups.drop_near_duplicates(docs)


@stage
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item.

    NULL and empty texts repeat none and stay; equal rows go or stay together. Without items, or without
    documents, nothing goes.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4,096 tokens.

    NULL and empty texts are the one token that ends a document; equal rows have pieces of their own.
    An empty table gives no piece.
    """
    pieces = packing.pack_documents(docs.select("doc_id", "text"), ["doc_id", "ids_crc32"], with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]

# Tokens and samples cannot be had in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored, and read again by the next.

    A stage's result is deleted when the next one's is there, so the disk holds two stages at most.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with storing() as whole:
        for _, made_by in STAGES:
            before, docs = docs, stored(made_by(spark, docs, sf_dir))
            whole.free(before)
        release(docs)
        return whole.keep(docs)
