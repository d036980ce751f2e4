"""Documents that hold passages of a benchmark, found by winnowing.

A fingerprint is the hash of ``K`` consecutive words. Of each ``SPAN - K + 1`` consecutive ones the
smallest is kept (the rightmost among equals). Any shared run of ``SPAN`` words contains one whole
such window in both texts, and the same fingerprint is kept in both, so no shared run is missed.
Items of fewer than ``SPAN`` words are one run each; all runs of their length are kept for them.

The items' kept fingerprints also fill a bit table of fixed size that is sent to all tasks: a
document fingerprint that is not in it can meet no item, so almost none is shuffled. Those that
pass carry the words around them, meet the items' fingerprints in an equi-join, and are extended:
every run of ``SPAN`` words around the fingerprint that agrees word by word is an occurrence. The
words themselves are compared, so a collision of hashes changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import cut, free_name, prepare, ship, utf8
from creditmart.llm.textcut import bounds, grams, hashes

SPAN = 10
K = 5
TABLE_BITS = 24  # the bit table has 2**24 bits (2 MB), whatever the benchmark's size


def kept(found: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest of each ``window`` consecutive hashes, rightmost among equals."""
    if len(found) < window:
        return np.empty(0, np.int64)
    best = np.arange(len(found) - window + 1)
    for i in range(1, window):
        other = np.arange(i, len(found) - window + 1 + i)
        best = np.where(found[other] <= found[best], other, best)
    return np.unique(best)


def fingerprints(words: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, position and run length of what is kept of a text.

    Run length is SPAN for winnowed fingerprints of K words; each of the shorter ``lengths`` keeps
    all runs of that many words.
    """
    found = grams(words, K)
    at = kept(found, SPAN - K + 1)
    out = [(found[at], at, np.full(len(at), SPAN))]
    for n in lengths:
        short = grams(words, n)
        out.append((short ^ np.uint64(n), np.arange(len(short)), np.full(len(short), n)))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def _slots(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _context(low: bytes, starts, ends, at: int, run: int) -> tuple[int, str]:
    """First word and the words of all runs of SPAN words that hold the fingerprint at ``at``."""
    first, last = (max(0, at + K - SPAN), min(len(starts), at + SPAN)) if run == SPAN else (at, at + run)
    return first, b" ".join(low[s:e] for s, e in zip(starts[first:last], ends[first:last])).decode("utf-8", "replace")


def _item_rows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(h, run, item_id, at, first, words) of every item's kept fingerprints."""

    def prints(batches):
        for batch in batches:
            rows = []
            for item, body in zip(batch["item"], batch["text"]):
                data, starts, ends = bounds(body or b"")
                if not len(starts):
                    continue
                words, low = hashes(data, starts, ends), data.tobytes()
                short = len(words) < SPAN
                for h, at, run in zip(*fingerprints(words, (len(words),) if short else ())):
                    if short != (run == SPAN):
                        rows.append((int(h.astype(np.int64)), int(run), item, int(at), *_context(low, starts, ends, at, run)))
            yield pd.DataFrame(rows, columns=["h", "run", "item_id", "at", "first", "words"])

    # ids travel as strings: only their identity and order as strings matter
    return items.select(F.col(item_id).cast("string").alias("item"), utf8(text).alias("text")).mapInPandas(
        prints, "h long, run int, item_id string, at int, first int, words string")


def occurrences(words: list[str], at: int, item_words: list[str], item_at: int, run: int) -> list[int]:
    """Starts, within ``words``, of the runs that agree and hold the fingerprint at both places."""
    if run < SPAN:
        return [0] if words == item_words else []
    back = forward = 0
    while back < min(at, item_at) and words[at - back - 1] == item_words[item_at - back - 1]:
        back += 1
    limit = min(len(words) - at, len(item_words) - item_at)
    while forward < limit and words[at + forward] == item_words[item_at + forward]:
        forward += 1
    return list(range(at - back, at + forward - run + 1)) if forward >= K else []


def find(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(row, n_words, hits, items) of every document.

    ``row`` holds the document's other columns; ``hits`` lists start and end (in words) of the
    disjoint spans covered by occurrences, ``items`` the items with an occurrence as sorted strings.
    Null and wordless texts have no words and no hits; an item without words or without an id never
    occurs; repeated rows are told apart by nothing and come out alike. Empty tables on either
    side are allowed. Columns other than the four named are not read.
    """
    spark = prepare(docs.sparkSession)
    prints = cut(_item_rows(items.where(F.col(item_id).isNotNull()), item_id, item_text))
    # at most SPAN - 1 lengths and 2**TABLE_BITS slots, whatever the number of items
    lengths = tuple(sorted(r["run"] for r in prints.where(F.col("run") < SPAN).select("run").distinct().collect()))
    table = np.zeros(1 << TABLE_BITS, bool)
    slots = prints.select(F.shiftrightunsigned("h", 64 - TABLE_BITS).alias("slot")).distinct()
    table[slots.toPandas()["slot"].to_numpy(np.int64)] = True
    shared = ship(spark, np.packbits(table))

    @F.pandas_udf("n_words long, found array<struct<h:long,run:int,at:int,first:int,words:string>>")
    def candidates(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bits = np.unpackbits(shared()).view(bool)
        for batch in batches:
            counts, found = [], []
            for body in batch:
                data, starts, ends = bounds(body or b"")
                counts.append(len(starts))
                words, rows = hashes(data, starts, ends), []
                h, at, run = fingerprints(words, lengths)
                passed = np.flatnonzero(bits[_slots(h)])
                if len(passed):
                    low = data.tobytes()
                    for i in passed.tolist():
                        first, context = _context(low, starts, ends, int(at[i]), int(run[i]))
                        rows.append({"h": int(h[i].astype(np.int64)), "run": int(run[i]), "at": int(at[i]), "first": first, "words": context})
                found.append(rows)
            yield pd.DataFrame({"n_words": counts, "found": found})

    scanned = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("print"), candidates(utf8(text)).alias("c"))
    scanned = cut(scanned.select("doc_id", "print", "c.n_words", "c.found"))
    met = (
        scanned.where(F.size("found") > 0).select("doc_id", "print", F.explode("found").alias("f"))
        .select("doc_id", "print", "f.*").distinct()
        .join(prints.select("h", "run", "item_id", F.col("at").alias("i_at"), F.col("first").alias("i_first"), F.col("words").alias("i_words")), ["h", "run"]))

    @F.pandas_udf("array<int>")
    def extended(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for run, at, first, words, i_at, i_first, i_words in batches:
            yield pd.Series([
                [f + s for s in occurrences(w.split(" "), a - f, iw.split(" "), ia - jf, r)]
                for r, a, f, w, ia, jf, iw in zip(run, at, first, words, i_at, i_first, i_words)])

    hits = (
        met.select("doc_id", "print", "run", "item_id", extended("run", "at", "first", "words", "i_at", "i_first", "i_words").alias("starts"))
        .where(F.size("starts") > 0)
        .groupBy("doc_id", "print").agg(
            F.array_sort(F.collect_set("item_id")).alias("items"),
            F.array_sort(F.flatten(F.collect_set(F.expr("transform(starts, s -> struct(s as s, s + run as e))")))).alias("runs")))
    # merge sorted runs into disjoint spans
    merged = F.expr(
        "aggregate(runs, cast(array() as array<struct<s:int,e:int>>), (acc, x) -> "
        "case when size(acc) > 0 and element_at(acc, -1).e >= x.s then "
        "concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).s as s, greatest(element_at(acc, -1).e, x.e) as e))) "
        "else concat(acc, array(x)) end)")
    hits = hits.select(F.col("doc_id").alias("d"), F.col("print").alias("p"), "items", merged.alias("hits"))
    out = scanned.join(hits, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("print").eqNullSafe(F.col("p")), "left")
    none = F.expr("cast(array() as array<struct<s:int,e:int>>)")
    return out.select(
        "doc_id", "print", "n_words", F.coalesce("hits", none).alias("hits"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The documents without any occurrence of a benchmark passage; columns as they are.

    Rows with a null id count like any other.
    """
    bad = find(docs, items, doc_id, text, item_id).where(F.size("hits") > 0)
    a, b = free_name(docs, "_bad_id"), free_name(docs, "_bad_text")
    bad = bad.select(F.col("doc_id").alias(a), F.col("print").alias(b)).distinct()
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col(a)) & (F.xxhash64(text) == F.col(b)), "left_anti")
