"""How document filters interact: what each removes, alone and in every order.

Five filters fail a document: A few words, B few different words, C many capitals, D markup
characters, E a text that a smaller id has too. The first four need the text alone. E is found with
radix tries: every task inserts its texts into compressed tries of bounded size, whose terminals
hold the least id, so that of equal texts in one task only one goes on. These are partitioned by
ranges of a prefix that is as long as its weight asks for, sorted, and inserted again; a traversal
then tells the least id of every text from its duplicates.

After that a document is five bits. Counts per bit mask and part are small, and every order of
the filters is arithmetic on them.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import prepare
from creditmart.session import checkpoint_dir

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5  # words; percent of words; percent of code points
MARKUP = b"#$%&*|"
DUPLICATE = 1 << FILTERS.index("E")
TRIE_BYTES = 8 << 20  # of text in one trie
PREFIXES = (8, 32, 128, 512, 2048)  # bytes; beyond the last a hash of the text takes over


class Node:
    __slots__ = ("edges", "least", "tags")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, Node]] = {}
        self.least = None  # a terminal's least id
        self.tags: dict[tuple, int] | None = None  # and how many documents of that id have each tag


def common_length(label: bytes, text: bytes, at: int) -> int:
    """Number of leading bytes of ``label`` that stand in ``text`` from ``at`` on."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Compressed radix trie over byte texts."""

    def __init__(self):
        self.root, self.size = Node(), 0

    def _terminal(self, text: bytes) -> Node:
        node, at = self.root, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = Node()
                node.edges[text[at]] = text[at:], leaf
                self.size += len(text) - at
                return leaf
            label, child = edge
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = common_length(label, text, at)
            fork = Node()
            fork.edges[label[same]] = label[same:], child
            node.edges[text[at]] = label[:same], fork
            node, at = fork, at + same
        return node

    def insert(self, text: bytes, key, tag: tuple, n: int = 1) -> list[tuple]:
        """Put in ``n`` documents; returns the (id, tag, n) that are duplicates from now on."""
        node = self._terminal(text)
        if node.tags is None:
            node.least, node.tags = key, {tag: n}
            self.size += 100  # a node's own bytes, about
        elif key == node.least:
            node.tags[tag] = node.tags.get(tag, 0) + n
        elif key > node.least:
            return [(key, tag, n)]
        else:
            lost = [(node.least, *entry) for entry in node.tags.items()]
            node.least, node.tags = key, {tag: n}
            return lost
        return []

    def terminals(self) -> Iterator[tuple]:
        """(text, least id, tag, n) of all terminals."""
        stack = [(b"", self.root)]
        while stack:
            text, node = stack.pop()
            for tag, n in (node.tags or {}).items():
                yield text, node.least, tag, n
            stack += [(text + label, child) for label, child in node.edges.values()]


_NOT_FIRST_BYTES, _CAPITALS = bytes(range(0x80, 0xC0)), bytes(range(ord("A"), ord("Z") + 1))


def mask_of(text: bytes) -> int:
    """Bits of the filters A to D that the UTF-8 text fails."""
    words = text.split()  # of bytes: at 0x20 and 0x09-0x0D
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _NOT_FIRST_BYTES))
    failed = (len(words) < LEAST_WORDS, 100 * len(set(words)) < LEAST_DISTINCT * len(words),
              100 * capitals > MOST_CAPITALS * points, len(text.translate(None, MARKUP)) < len(text))
    return sum(bit << place for place, bit in enumerate(failed))


def failures(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source", trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """(doc_id, part, mask, n): ``n`` documents of that id and part fail the filters in ``mask``.

    A null text counts as empty, a null part as the empty string. Rows with equal id and text do not
    make each other duplicates; all of them are counted. A row without id neither is nor makes a
    duplicate. An empty table gives an empty table. Other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    columns = f"doc_id {kind}, part string, mask int, n long"

    def table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        """Rows of (text, id, tag, n, duplicate or not) as a batch with ``schema``'s columns."""
        values = {
            "text": (r[0] for r in rows), "doc_id": (r[1] for r in rows), "part": (r[2][0] for r in rows),
            "mask": (r[2][1] | (DUPLICATE if r[4] else 0) for r in rows), "n": (r[3] for r in rows)}
        return pa.RecordBatch.from_arrays(
            [pa.array(list(values[field.name]), field.type) for field in schema], schema=schema)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Masks, and of equal texts within one trie only the least id with its text."""
        schema, trie, decided = None, Trie(), []
        for batch in batches:
            if schema is None:
                schema = pa.schema([
                    ("text", pa.binary()), ("doc_id", batch.schema.field("doc_id").type), ("part", pa.string()), ("mask", pa.int32()),
                    ("n", pa.int64())])
            for body, key, where in zip(*(batch.column(c) for c in ("text", "doc_id", "part"))):
                body, key, tag = body.as_py(), key.as_py(), (where.as_py(), mask_of(body.as_py()))
                if key is None:
                    decided.append((None, None, tag, 1, False))
                else:
                    decided += [(None, *lost, True) for lost in trie.insert(body, key, tag)]
                if trie.size > trie_bytes or len(decided) >= 50_000:
                    yield table([*decided, *((*leaf, False) for leaf in trie.terminals())], schema)
                    trie, decided = Trie(), []
        if schema is not None:
            yield table([*decided, *((*leaf, False) for leaf in trie.terminals())], schema)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Duplicates among sorted texts; a trie ends only where the text changes."""
        schema, trie, decided, last = None, Trie(), [], None
        for batch in batches:
            if schema is None:
                schema = pa.schema([batch.schema.field(c) for c in ("doc_id", "part", "mask", "n")])
            for row in zip(*(batch.column(c) for c in ("text", "doc_id", "part", "mask", "n"))):
                body, key, where, mask, n = (cell.as_py() for cell in row)
                if len(decided) >= 50_000 or trie.size > trie_bytes and body != last:
                    out = decided
                    if body != last:
                        out, trie = [*out, *((*leaf, False) for leaf in trie.terminals())], Trie()
                    decided = []
                    yield table(out, schema)
                decided += [(None, *lost, True) for lost in trie.insert(body, key, (where, mask), n)]
                last = body
        if schema is not None:
            yield table([*decided, *((*leaf, False) for leaf in trie.terminals())], schema)

    rows = docs.select(
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"), F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    folder = f"{checkpoint_dir(spark)}/filter-audit-{uuid.uuid4()}"
    rows.mapInArrow(combine, f"text binary, {columns}").write.parquet(folder)
    combined = spark.read.parquet(folder)
    left = combined.where("text is not null")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = left.withColumn("_range", range_key(left, "text", ranges)).repartitionByRange(ranges, "_range")
    decided = keyed.sortWithinPartitions("_range", "text").drop("_range").mapInArrow(reduce, columns)
    return combined.where("text is null").drop("text").unionByName(decided)


def range_key(df: DataFrame, text: str, ranges: int) -> Column:
    """The shortest of the prefixes of a text that less than 1/``ranges`` of all bytes begin with.

    Only prefixes above that weight come to the driver, so never more than ``ranges`` a level.
    Texts that share even the longest heavy prefix are told apart by a hash behind it.
    """
    weight = F.octet_length(text) + 16
    total = df.agg(F.sum(weight)).first()[0] or 0
    levels, rest = [], df
    for length in PREFIXES:
        prefix = F.substring(text, 1, length)
        heavy = [r["p"] for r in rest.groupBy(prefix.alias("p")).agg(F.sum(weight).alias("w")).where(F.col("w") * ranges > total).collect()]
        levels.append((prefix, heavy))
        if not heavy:
            break
        rest = rest.where(prefix.isin(heavy))
    longest = F.concat(levels[-1][0], F.sha2(text, 256).cast("binary"))
    key = longest if levels[-1][1] else levels[-1][0]
    for prefix, heavy in reversed(levels[:-1]):
        key = F.when(prefix.isin(heavy), key).otherwise(prefix)
    return key


def orders() -> str:
    """All orders of the filters, step by step, as JSON: the step's bit and the bits before it."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            steps.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return json.dumps(steps)


def audit(failed: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts per part, order of the filters and step, from ``failures``.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (failing its filter, but removed
    earlier), ``unique_fails`` (failing its filter alone), ``good_lost`` and ``toxic_lost`` (removed
    by it, with a label of quality 1 or toxic 1), ``shapley`` (the filter's removed documents over
    all orders). An id that repeats in ``labels`` has what any of its rows has.
    """
    marks = labels.groupBy(F.col(doc_id).alias("doc_id")).agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    ids = failed.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marked = ids.join(marks, "doc_id", "left")
    counts = marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))
    # A part has at most 32 masks: one short array.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = F.inline(F.from_json(F.lit(orders()), "array<struct<filter_order string, step int, bit int, before int>>"))
    rows = parts.select("part", "masks", steps)

    def total(column: str, where) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda sum_, m: sum_ + F.when(where(m["mask"]), m[column]).otherwise(0))

    bit, before = F.col("bit"), F.col("before")
    removed_here = lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) == 0)
    counted = rows.select(
        "part", "filter_order", "step", "bit",
        total("n", lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total("n", removed_here).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", removed_here).alias("good_lost"), total("toxic", removed_here).alias("toxic_lost"))
    shares = counted.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return counted.join(shares, ["part", "bit"]).drop("bit")
