"""Boilerplate lines: lines that stand on many sites are removed but for their first occurrence.

Short lines need many sites. A line of more than ``LONG`` words is a passage nobody writes twice: it
goes from the second document on.

All work is DataFrame functions. The lines' hashes (not their texts) are exploded and grouped;
each line hash gets a HyperLogLog sketch of its sites, its number of occurrences and its first
place. Sketches merge, so they are built before the shuffle and a line that a third of all rows
hold reaches its reducer as one small sketch per task. The sketch decides lines whose estimate is
farther from the threshold than the sketch's error allows; those near it get an exact count of
their distinct sites. Texts are shuffled once, to meet the places that go.

Where lines meet the few candidates, both sides carry one of ``SALTS`` numbers and the candidates
are repeated for each, so that a line that a third of all rows hold is spread over as many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import cut, free_name

MIN_SITES = 10
LONG = 50  # words; a longer line needs two documents only
LG_K = 11
SALTS = 32
ERRORS = 4.0  # an estimate this many standard errors from the threshold is trusted


def lines_of(docs: DataFrame, text: str, site: str, doc_id: str) -> DataFrame:
    """(h, g, long, site, doc_id, print, at, salt) of every line that is not blank; h and g hash the line."""
    lines = docs.select(
        F.col(site).cast("string").alias("site"), F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("print"),
        F.posexplode(F.split(text, "\n")).alias("at", "line"))
    return lines.where(F.trim("line") != "").select(
        F.xxhash64("line").alias("h"), F.xxhash64(F.lit(7), F.col("line")).alias("g"), is_long("line").alias("long"), "site", "doc_id",
        "print", "at",
        F.pmod(F.xxhash64("doc_id", "print", "at"), F.lit(SALTS)).cast("int").alias("salt"))


def is_long(line: str) -> Column:
    """Whether a line has more than ``LONG`` words, i.e. runs without blanks and ASCII control spaces."""
    words = F.when(F.length(line) > 2 * LONG, F.regexp_count(line, F.lit("[^\\x20\\x09-\\x0D]+"))).otherwise(0)
    return words > LONG


def _for_each_salt(candidates: DataFrame) -> DataFrame:
    return candidates.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, errors: float = ERRORS) -> DataFrame:
    """(h, g, n_sites, first) of the lines with at least ``min_sites`` distinct sites, or long ones of two documents.

    ``first`` is the first place (doc_id, print, at). A short line with fewer occurrences than
    ``min_sites`` cannot qualify, so only the others get a sketch. Null sites count for nothing. For a
    long line the first and the last document tell whether there are two; its ``n_sites`` is null.
    """
    place = F.struct("doc_id", "print")
    last = F.max(F.struct("doc_id", "print"))
    repeated = F.bool_or("long") & ~F.min(place).eqNullSafe(last)
    often = cut(
        lines.groupBy("h", "g").agg(
            F.count("site").alias("n"), repeated.alias("passage"), F.min(F.struct("doc_id", "print", "at")).alias("first"))
        .where(F.col("passage") | (F.col("n") >= min_sites)).select("h", "g", "passage", "first"))
    places = _for_each_salt(often.where(~F.col("passage")).select("h", "g"))
    common = cut(lines.join(places, ["h", "g", "salt"], "left_semi").select("h", "g", "site"))
    spread = common.where("site is not null").groupBy("h", "g").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
    slack = max(1.0, errors * 1.04 / 2 ** (lg_k / 2) * min_sites)
    sure = spread.where(F.col("sites") >= min_sites + slack).select("h", "g", "sites")
    near = spread.where(F.abs(F.col("sites") - min_sites) < slack).select("h", "g")
    exact = (
        common.where("site is not null").distinct().join(near, ["h", "g"], "left_semi")
        .groupBy("h", "g").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites))
    found = sure.unionByName(exact)
    short = found.join(often, ["h", "g"]).select("h", "g", F.col("sites").alias("n_sites"), "first")
    return short.unionByName(often.where("passage").select("h", "g", F.lit(None).cast("long").alias("n_sites"), "first"))


def marks(gone: str) -> Column:
    """One byte per line up to the last of the ascending places ``gone``: 1 for those, 0 for the others."""
    gap = lambda at, k: at - F.coalesce(F.get(F.col(gone), k - 1), F.lit(-1)) - 1
    return F.array_join(F.transform(gone, lambda at, k: F.concat(F.repeat(F.lit("0"), gap(at, k)), F.lit("1"))), "").cast("binary")


def remove(
    docs: DataFrame, min_sites: int = MIN_SITES, text: str = "text", site: str = "source", doc_id: str = "doc_id",
    n_lines: str | None = None, n_removed: str | None = None, lg_k: int = LG_K,
) -> DataFrame:
    """The documents without lines that stand on ``min_sites`` or more distinct sites, or in two documents if long.

    Lines are what line breaks separate, compared as they are; blank ones stay. Of a removed line
    its first occurrence in the table (smallest id, nulls first, then place) is kept, so no content is lost;
    rows that repeat both id and text count as one document. A null text stays null; a text whose
    lines all go becomes empty. With names given, ``n_lines`` and ``n_removed`` are added. All
    other columns stay as they are, whatever their names. An empty table gives an empty table.
    """
    work = free_name(docs, "_dedup")
    lines = lines_of(docs, text, site, doc_id)
    found = cut(boilerplate(lines, min_sites, lg_k))
    places = (
        lines.select("h", "g", "doc_id", "print", "at", "salt").join(_for_each_salt(found), ["h", "g", "salt"])
        .where(~F.struct("doc_id", "print", "at").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("at")).alias("gone"))
        .select(F.col("doc_id").alias(f"{work}_id"), F.col("print").alias(f"{work}_print"), F.size("gone").alias(f"{work}_n"),
                marks("gone").alias(f"{work}_gone")))
    out = docs.join(
        places, F.col(doc_id).eqNullSafe(F.col(f"{work}_id")) & (F.xxhash64(text) == F.col(f"{work}_print")), "left")
    gone = F.col(f"{work}_gone")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda line, i: F.substring(gone, i + 1, F.lit(1)) != F.lit(b"1")), "\n")
    out = out.withColumn(f"{work}_text", F.when(gone.isNull(), F.col(text)).otherwise(left))
    if n_lines:
        out = out.withColumn(n_lines, F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(text, "\n"))))
    if n_removed:
        out = out.withColumn(n_removed, F.coalesce(f"{work}_n", F.lit(0)))
    return out.withColumn(text, F.col(f"{work}_text")).drop(f"{work}_id", f"{work}_n", f"{work}_print", f"{work}_gone", f"{work}_text")
