"""The named queries of this subpackage over a folder of Parquet tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import chat, decontaminate, exact_dedup, fertility, langid, line_dedup, near_dups, packing, passages, periodic, quality_model, repair, urls
from tideline.llm.common import read, remainder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_language(spark, folder):
    docs = read(spark, folder, "documents")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    sample = langid.learning_sample(docs.filter(remainder("doc_id", 5) != 0))
    model = spark.sparkContext.broadcast(langid.learn(sample))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predict(rows, model).drop("text")


@query
def op2_chat(spark, folder):
    control = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(control).alias("text"),
    )
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = chat.read_back(chat.format_conversations(rows.unionByName(extra)))
    first = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return found.select(*first, *[c for c in found.columns if c not in first])


URL_RULES = urls.UrlRules(
    (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
)


@query
def op3_urls(spark, folder):
    pages = read(spark, folder, "pages").select("page_id", "url")
    return urls.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op3_urls"] = urls.verdict_sql(URL_RULES, "pages")


@query
def op4_packing(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    packed = packing.pack_documents(docs, ["doc_id", "ids_crc32"], with_ids=False)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed.select(*columns)


@query
def op5_quality(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    labels = read(spark, folder, "labels").select("doc_id", "quality")
    sample, counts = quality_model.learning_sample(docs, labels.filter(remainder("doc_id", 3) != 1), "doc_id", "quality")
    model = spark.sparkContext.broadcast(quality_model.learn(sample, counts))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return quality_model.score(docs.withColumn("held_out", held_out), model).drop("text")


@query
def op6_fertility(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    judged = fertility.judge_quality(docs, keep_text=False).drop("lang")
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*first, *[c for c in judged.columns if c not in first])


@query
def op8_line_dedup(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).drop("longest_run")


ORACLE["op8_line_dedup"] = line_dedup.dedup_sql("documents")


@query
def op9_decontaminate(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.mark_contaminated(docs, read(spark, folder, "benchmark")).drop("text")


@query
def op10_near_duplicates(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return near_dups.near_duplicates(docs).drop("text")


@query
def op7_passages(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return passages.mark_passages(docs).drop("text")


@query
def op12_exact_copies(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return exact_dedup.mark_copies(docs, exact_dedup.first_half(docs))


ORACLE["op12_exact_copies"] = exact_dedup.copies_sql("documents")


@query
def op11_periodic_runs(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return periodic.mark_runs(docs, rewrite=periodic.plant).select("doc_id", *periodic.run_digests())


@query
def op13_conversation_repair(spark, folder):
    return repair.repair_digests(read(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
