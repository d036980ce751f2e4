"""Near-duplicates by SimHash, found with an inverted index over positional bytes.

A fingerprint has eight byte positions. Two fingerprints that differ in at most two bits differ
in at most two bytes, so they share at least six positional bytes: that is the guaranteed minimum
for count filtering. A posting list for one positional byte would hold 1/256 of all fingerprints
and its pairs would grow with their square, so postings are kept for sets of four positional bytes
instead (two of four byte pairs): any six shared bytes contain at least one of the six sets. For
the pairs of a list the shared positional bytes are tallied, pairs below six are dropped, and the
rest is verified bit by bit.

Equal fingerprints are one entry. Lists of more than ``LIST`` entries, as near copies in their
thousands make, are not paired. Their entries are linked through midpoints instead: two
fingerprints differ in at most two bits exactly when turning over at most one bit of each can make
them equal. Each such entry emits its 65 variants and is linked to the smallest entry with the
same variant. This keeps the reachable sets exact, with a number of rows in proportion to the
entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import cut, free_name, prepare, utf8
from creditmart.llm.components import components

LIST = 32
MOST_BITS = 2
SHARED = 6
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of a text as a signed 64-bit number.

    ASCII letters count as lower case; words are what ASCII white space separates; shingles of
    ``words`` words are hashed with XXH64, repeats included. A shorter text is one shingle; a null,
    empty or blank one has fingerprint zero.
    """
    import xxhash

    found = text.lower().split() if text else []
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    digest, hashes = xxhash.xxh64_digest, []
    ones, n = np.zeros(64, np.int64), 0
    for shingle in shingles:
        hashes.append(digest(shingle, seed))
        if len(hashes) == HASHES_AT_ONCE:
            ones, n = ones + _ones(hashes), n + len(hashes)
            hashes = []
    ones, n = ones + _ones(hashes), n + len(hashes)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big", signed=True)


def _ones(digests: list[bytes]) -> np.ndarray:
    """How many of the hashes have each bit set, highest bit first."""
    bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8)).reshape(-1, 64)
    return bits.sum(axis=0, dtype=np.int64)


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", words: int = 3) -> DataFrame:
    """Add the SimHash of every whole text as a long."""
    prepare(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, words) for t in batch], dtype="int64")

    return docs.withColumn(out, simhash(utf8(text)))


def _byte(column: str | Column, position: int) -> Column:
    return F.shiftrightunsigned(column, 8 * position).bitwiseAND(0xFF)


def _postings(fingerprint: str) -> list[Column]:
    """Six postings: two of the four byte pairs each, with the number of the set in front."""
    pairs = [F.shiftrightunsigned(fingerprint, 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    return [
        F.lit(number << 32) + F.shiftleft(pairs[i], 16) + pairs[j]
        for number, (i, j) in enumerate(combinations(range(4), 2))]


def _links(entries: DataFrame, most_list: int = LIST) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``f`` that reach the same sets as all true links."""
    index = entries.select("f", F.explode(F.array(*_postings("f"))).alias("posting"))
    lists = index.groupBy("posting").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    listed = cut(index.join(lists, "posting"))
    short = listed.where(F.col("n") <= most_list).select("posting", "f")
    pairs = (
        short.select("posting", F.col("f").alias("a")).join(short.select("posting", F.col("f").alias("b")), "posting")
        .where("a < b"))
    tally = sum(((_byte("a", i) == _byte("b", i)).cast("int") for i in range(8)), F.lit(0))
    close = (
        pairs.where(tally >= SHARED).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS)
        .select("a", "b"))
    crowded = listed.where(F.col("n") > most_list).select("f").distinct()
    turned = crowded.select(
        "f", F.explode(F.array(F.col("f"), *(F.col("f").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64))))
        .alias("variant"))
    least = turned.groupBy("variant").agg(F.min("f").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = turned.join(least, "variant").where("f != b").select(F.col("f").alias("a"), "b")
    return close.unionByName(stars).distinct()


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _groups(rows: DataFrame, most_list: int = LIST) -> DataFrame:
    """(f, component) of every distinct fingerprint ``f``; component is the smallest one reachable by links."""
    entries = cut(rows.select("f").distinct())
    found = components(_links(entries, most_list)).select(F.col("node").alias("f"), "component")
    return entries.join(found, "f", "left").select("f", F.coalesce("component", "f").alias("component"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, most_list: int = LIST,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``fingerprint`` is a long; rows whose fingerprints differ in at most two bits are linked, and
    ``component_id`` is the smallest id reachable by links (null where only rows without id are).
    Texts without words have fingerprint zero and are linked like any other. Repeated rows come
    out repeated. An empty table gives an empty table. Other columns of ``docs`` are not read.
    """
    rows = with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), words=words)
    rows = cut(rows.select("doc_id", F.col("fingerprint").alias("f")))
    entries = cut(rows.groupBy("f").agg(F.min("doc_id").alias("least")))
    found = components(_links(entries.select("f"), most_list)).select(F.col("node").alias("f"), "component")
    grouped = entries.join(found, "f", "left").select("f", "least", F.coalesce("component", "f").alias("component"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = grouped.join(least, "component").select("f", "component_id")
    return rows.join(classes, "f").select("doc_id", F.col("f").alias("fingerprint"), "component_id")


def hex16(fingerprint: str = "fingerprint") -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """The documents without all but the smallest id of each group of near-duplicates.

    A row is known by its id and its text. Rows that share an id but belong to different groups are
    chosen in each group apart; of rows of one group that share the smallest id, the one with the
    smallest (fingerprint, hash of the text) stays, so no result depends on the order of tasks. Rows
    without an id have no place in that order: of each group's one stays, besides the one with an id.
    """
    known, absent, printed = (free_name(docs, name) for name in ("_kept_id", "_kept_absent", "_kept_print"))
    marked = docs.select(
        "*", F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias(known), F.col(doc_id).isNull().alias(absent),
        F.xxhash64(text).alias(printed))
    rows = with_fingerprint(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("print")), words=words)
    rows = rows.select("doc_id", F.col("fingerprint").alias("f"), "print")
    least = cut(rows.groupBy("f", F.col("doc_id").isNull().alias("absent")).agg(F.min(F.struct("doc_id", "f", "print")).alias("least")))
    kept = (
        least.join(_groups(least), "f").groupBy("component", "absent").agg(F.min("least").alias("least"))
        .select(F.coalesce(F.col("least.doc_id").cast("string"), F.lit("")).alias(known), F.col("absent").alias(absent),
                F.col("least.print").alias(printed)))
    keys = [known, absent, printed]
    return marked.join(kept, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
