"""Registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from creditmart.llm import (
    decontaminate, filter_audit, hard_negatives, language, licenses, line_dedup, packing, pieces, simhash, toxicity, url_filter, vectors,
    window_packing,
)
from creditmart.llm.common import held_out, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = toxicity.train(docs, read(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "n_sentences",
        F.size("offending").alias("n_offending"))


@query
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex16().alias("fingerprint"), "component_id")


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages have no fetch day: a hash of the URL and the id spreads them over two years."""
    number = F.conv(F.substring(F.md5(F.concat_ws("#", "url", F.col("page_id").cast("string"))), 1, 6), 16, 10).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(number, F.lit(730))).alias("fetched_on"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """The lists' entries: adds and removals of the pages' hosts, their domains and first path segments, dated by a hash."""
    hosts = url_filter.host("url")
    patterns = F.array(
        hosts, F.substring_index(hosts, ".", -2), F.concat(hosts, F.lit("/"), F.split(F.regexp_extract("url", url_filter.PATH, 1), "/")[1]))
    found = pages.where(hosts != "").select(F.explode(patterns).alias("pattern")).where("pattern is not null").distinct()
    code = F.conv(F.substring(F.md5(F.concat(F.col("pattern"), F.lit(":"), F.col("turn").cast("string"))), 1, 6), 16, 10).cast("int")
    lists = F.array(F.lit("adult"), F.lit("malware"), F.lit("spam"))
    turns = found.select("pattern", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("turn")).withColumn("code", code)
    return turns.where("code % 4 = 0").select(
        F.element_at(lists, (F.floor(F.col("code") / 4) % 3 + 1).cast("int")).alias("list"), "pattern",
        F.when(F.floor(F.col("code") / 16) % 2 == 0, "add").otherwise("remove").alias("action"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.floor(F.col("code") / 32) % 730).cast("int")).alias("day"))


@query
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    judged = url_filter.judge(dated_captures(pages), dated_entries(pages))
    return judged.select("page_id", "fetched_on", "blocked", F.array_join("lists", ",").alias("lists"), "rule")


@query
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = pieces.encode_documents(read(spark, folder, "documents"), pieces.load(pieces.default_model()), decoded="decoded")
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return language.predict(docs, language.train(docs)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, x: total + x["e"] - x["s"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


@query
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(read(spark, folder, "documents"))
    words = F.transform("base", lambda b: b["word"])
    base, more = F.transform("base", lambda b: b["label"]), F.transform("detections", lambda d: d["label"])

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"), "score")


@query
def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(read(spark, folder, "embeddings"))


@query
def op9_token_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(read(spark, folder, "documents"))
    return packed.select(
        "shard", "run", "row", F.element_at("cu_seqlens", -1).alias("n_tokens"), F.size("doc_ids").alias("n_segments"),
        F.sha2("ids", 256).alias("ids_sha256"), "cu_seqlens", "doc_ids", "segments")


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_dedup.remove(read(spark, folder, "documents"), n_lines="n_lines", n_removed="n_removed")
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", label.alias("label"), "embedding")).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query
def op12_window_packing(spark: SparkSession, folder: str) -> DataFrame:
    return window_packing.pack(read(spark, folder, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    failed = filter_audit.failures(read(spark, folder, "documents"))
    return filter_audit.audit(failed, read(spark, folder, "labels"))


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
