"""A training corpus from raw documents, in five stages.

Documents have ``doc_id``, ``text``, ``lang``, ``source`` and ``n_chars``; further columns, whatever their
names, pass all stages but the last. In every stage null and empty texts are kept or judged like any
other text, rows that repeat are treated alike, and an empty table gives an empty table.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. Between stages
the documents are written as Parquet and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.llm import decontaminate, line_dedup, pieces, simhash, toxicity
from creditmart.llm.common import free_name, read
from creditmart.session import checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labels of documents that are not held out; documents rejected by the score go.

    A null or empty text has the score of no sentences and stays; rows without id are judged, not learned from.
    """
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many sites, and long ones of two documents, stay at their first occurrence only; n_chars follows the text.

    Needs ``source`` and ``n_chars``. A null text stays null; a text whose lines all go becomes empty and its document stays.
    Rows that repeat id and text keep or lose the same lines.
    """
    removed = free_name(docs, "_removed")
    out = line_dedup.remove(docs, n_removed=removed)
    chars = F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Texts without words are one group. Rows that repeat id and text fold; of each group's rows without id one stays too.
    """
    return simhash.keep_one(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go; null and empty texts have none and stay, repeated rows share their fate."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text back.

    Needs ``lang`` and ``source``; returns doc_id, lang, source, n_tokens, ids and lossless, no other column. A null
    text is encoded like an empty one; every row comes out once.
    """
    coded = pieces.encode_documents(docs, pieces.load(pieces.default_model()), decoded="decoded")
    return coded.select(
        "doc_id", "lang", "source", "n_tokens", "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", keep_one),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

ORACLE_SQL = None  # trained scores, fingerprints and token ids are beyond SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the intermediate tables lie in the shared checkpoint folder."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
