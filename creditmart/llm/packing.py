"""Token ids in fixed-length rows for training.

Every text is tokenized whole and ends with a separator; token lists longer than a row are split
into segments without loss. Segments are dealt to shards by a hash and packed by best fit
decreasing: longest first, each into the fullest row that still holds it. Rows are found by a
segment tree over the capacities 0..length, whose leaves hold the rows with that room left. A shard
is read in order and packed in runs of bounded size, so a task's memory does not depend on the shard's.

A packed row has the ids (little-endian unsigned 16-bit, or 32-bit for larger vocabularies, padded
with the separator), the cumulative segment lengths, and from these the positions that start anew
with each segment.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import prepare, ship, utf8

LENGTH = 2048
SHARD_BYTES = 8 << 20  # of text, on average
RUN = 8192  # segments packed together
MOST_TASKS = 4096  # that pack; each takes several shards of a larger corpus


class Rooms:
    """Rows by room left; a segment tree over the capacities finds the least room that is enough."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (row, room) with the least room >= need; of equal ones the latest."""
        node, count = need + self.size, self.count
        while not count[node]:
            while node & 1:  # no right neighbour under the same parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.size:
            node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.size
        self._change(room, -1)
        return self.rows[room].pop(), room


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Indices of the segments of each row, in the order placed; longest first, ties by index."""
    rooms, rows = Rooms(length), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = rooms.take(lengths[i])
        if found is None:
            found = len(rows), length
            rows.append([])
        row, room = found
        rows[row].append(i)
        if room > lengths[i]:
            rooms.put(row, room - lengths[i])
    return rows


def byte_pairs(path: str | None = None) -> tuple[Callable, int, int]:
    """(factory of an encode function, separator id, vocabulary size) of the public byte-level BPE."""
    import base64

    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pattern, end = public_tokenizers.PATTERN, len(ranks)

    def make():
        import tiktoken

        coder = tiktoken.Encoding("byte_pairs", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda text: coder.encode_ordinary(text)

    return make, end, end + 1


def segments(
    docs: DataFrame, tokenizer: tuple[Callable, int, int], length: int = LENGTH, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, segment, ids) of every text: its tokens and the separator, cut every ``length`` tokens."""
    spark = prepare(docs.sparkSession)
    make, end, size = tokenizer
    kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
    shared = ship(spark, make)  # the vocabulary

    @F.pandas_udf("array<binary>")
    def tokenize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = shared()()
        for batch in batches:
            out = []
            for body in batch:
                ids = encode(body.decode("utf-8", "replace")) if body else []
                data = np.array([*ids, end], kind)
                out.append([data[at : at + length].tobytes() for at in range(0, len(data), length)])
            yield pd.Series(out)

    return docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(tokenize(utf8(text))).alias("segment", "ids"))


def pack_run(run: pd.DataFrame, shard: int, number: int, length: int, end: int, width: int) -> pd.DataFrame:
    """Packed rows of one run of segments."""
    kind = np.dtype(f"<u{width}")
    ids = run["ids"].to_list()
    lengths = [len(i) // width for i in ids]
    docs, parts, out = run["doc_id"].to_list(), run["segment"].to_list(), []
    for row, inside in enumerate(best_fit(lengths, length)):
        bounds = np.cumsum([0, *(lengths[i] for i in inside)])
        pad = np.full(length - bounds[-1], end, kind).tobytes()
        out.append((
            shard, number, row, b"".join([*(ids[i] for i in inside), pad]), bounds.tolist(),
            [docs[i] for i in inside], [int(parts[i]) for i in inside]))
    return pd.DataFrame(out, columns=["shard", "run", "row", "ids", "cu_seqlens", "doc_ids", "segments"])


def pack(
    docs: DataFrame, tokenizer: tuple[Callable, int, int] | None = None, length: int = LENGTH, doc_id: str = "doc_id",
    text: str = "text", shard_bytes: int = SHARD_BYTES, run_size: int = RUN, most_tasks: int = MOST_TASKS,
) -> DataFrame:
    """(shard, run, row, ids, cu_seqlens, doc_ids, segments) of the packed corpus.

    Every token of every text stands in exactly one row; ``doc_ids`` and ``segments`` name the
    segments in order, ``cu_seqlens`` where they start and end. A null or empty text is a
    separator. ``doc_ids`` are of the type of the ids, of which a null stays null. Rows that repeat an id
    are packed like any other, in no defined order among equal ones; those with different texts, and
    rows without id, are spread over the shards. The number of shards follows the bytes of text, that of
    the tasks has a bound: a task packs its shards one after the other. An empty table gives an empty table.
    """
    tokenizer = tokenizer or byte_pairs()
    _, end, size = tokenizer
    width = 2 if size <= 1 << 16 else 4
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))

    def packed(batches):
        held, shard, number = [], None, 0
        for batch in batches:
            for value, part in batch.groupby("shard", sort=True):
                if value != shard:
                    if held:
                        yield pack_run(pd.concat(held), shard, number, length, end, width)
                    held, shard, number = [], int(value), 0
                held.append(part)
                while sum(map(len, held)) >= run_size:
                    whole = pd.concat(held)
                    yield pack_run(whole[:run_size], shard, number, length, end, width)
                    held, number = [whole[run_size:]], number + 1
        if held:
            yield pack_run(pd.concat(held), shard, number, length, end, width)

    kind = docs.schema[doc_id].dataType.simpleString()
    # Rows without id are told apart by where they stand, so that many equal ones do not meet in one shard.
    stand = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    dealt = segments(docs, tokenizer, length, doc_id, text).withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "segment", "ids", stand), F.lit(shards)).cast("int"))
    dealt = dealt.repartition(int(min(shards, most_tasks)), "shard").sortWithinPartitions("shard", "doc_id", "segment", "ids")
    # pandas would turn long ids beside a null into doubles: the ids travel as text.
    dealt = dealt.select("shard", F.col("doc_id").cast("string").alias("doc_id"), "segment", "ids")
    rows = dealt.mapInPandas(
        packed, "shard int, run int, row int, ids binary, cu_seqlens array<int>, doc_ids array<string>, segments array<int>")
    return rows.withColumn("doc_ids", F.col("doc_ids").cast(f"array<{kind}>"))


def positions(cu_seqlens: str = "cu_seqlens") -> Column:
    """Position of each token within its segment: 0, 1, ... anew from each segment's start."""
    cu = F.col(cu_seqlens)
    return F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(cu) - 1), lambda i: F.sequence(F.lit(0), F.element_at(cu, i + 1) - F.element_at(cu, i) - 1)))


def write(packed: DataFrame, path: str) -> None:
    """Write the rows as Parquet: ids as fixed-width binary (a matrix row each), lengths, positions."""
    packed.withColumn("positions", positions()).write.mode("overwrite").parquet(path)
