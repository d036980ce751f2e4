"""Sequences of one window, packed by non-negative least squares over length combinations.

Texts are tokenized whole and written once. A document's whole windows are sequences of their own;
what is left of it is a remainder shorter than a window. Remainders are counted in a histogram of
length units. Shallow combinations of lengths that fill a window are enumerated, and non-negative
least squares finds how often to repeat each so that together they meet the histogram. Rounded to
what the histogram holds, the repeats are slots, dealt to the remainders by rank. Lengths count in
whole units, so a combination is filled or slightly overfilled; the overhang is cut off. Overhangs
and remainders without a slot are packed greedily, one behind the other. The very last sequence ends in
powers of two, which need no padding.

Only the histogram and the slots, both of fixed size, pass through the driver. Ranks and places are
sums over partitions' totals plus sums inside a partition.
"""

from __future__ import annotations

import json
import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.common import prepare, ship
from creditmart.session import checkpoint_dir

WINDOW, UNIT = 4096, 64
SEPARATOR = 2
WORDS, MOST_PIECES = 300_000, 800_000  # remembered by a worker process
LONG = 1 << 16  # bytes; longer words are not remembered


# ---- tokens ------------------------------------------------------------------------------

# Words of these characters need no library to be lower-cased and split: printable ASCII and Latin
# letters that are one code point in either case. Fixed values of the tokenizer file's own pattern.
PLAIN = "\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
LETTERS = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
PIECES = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


def word_pairs(path: str | None = None) -> tuple[Callable, str]:
    """(factory of an encoder of words to bytes of their ids, array type of an id) of the public tokenizer with word ends."""
    import public_tokenizers

    with open(path or public_tokenizers.path("word_bpe_49k.json")) as file:
        content = file.read()
    kind = "H" if max(json.loads(content)["model"]["vocab"].values()) < 1 << 16 else "I"

    def make() -> Callable[[list[str]], list[bytes]]:
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        coder, letters = Tokenizer.from_str(content), byte_letters()
        merge, plain, pieces = coder.model.tokenize, re.compile(f"[{PLAIN}]+").fullmatch, re.compile(PIECES).findall
        known: dict[str, bytes] = {}

        def piece_ids(piece: str) -> bytes:
            text = piece if piece.isascii() else "".join(letters[b] for b in piece.encode())
            ids = known[piece] = array(kind, [token.id for token in merge(text)]).tobytes()
            return ids

        def encode(words: list[str]) -> list[bytes]:
            if len(known) > MOST_PIECES:
                known.clear()
            out, rest = [], []
            for word in words:
                ascii_ = word.isascii()
                if ascii_ and word.isalpha():
                    piece = word.lower()
                    out.append(known.get(piece) or piece_ids(piece))
                elif (word.isprintable() if ascii_ else plain(word)) and "<|" not in word:
                    out.append(b"".join([known.get(piece) or piece_ids(piece) for piece in pieces(word.lower())]))
                else:  # other characters, or maybe a special token
                    rest.append(len(out))
                    out.append(b"")
            whole = coder.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)
            for place, encoding in zip(rest, whole):
                out[place] = array(kind, encoding.ids).tobytes()
            return out

        return encode

    return make, kind


def tokenized(docs: DataFrame, tokenizer: tuple[Callable, str], separator: int, doc_id: str, text: str) -> DataFrame:
    """(part, place, doc_id, n, ids) per document: ids as little-endian integers of the tokenizer's type.

    This tokenizer drops white space, so a text's ids are those of its words between ASCII blanks
    and line ends. Repeated ones are looked up; a worker process keeps them from task to task.
    """
    make, kind = tokenizer
    shared, name = ship(docs.sparkSession, make), str(uuid.uuid4())

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import sys

        kept = sys.__dict__.setdefault("_window_packing", {})  # of this process, which serves many tasks
        if name not in kept:
            kept.clear()
            kept[name] = shared()(), {}
        (coder, known), end = kept[name], array(kind, [separator]).tobytes()
        for batch in batches:
            out = []
            for body in batch:
                words = [w for w in (body or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if w]
                if len(known) > WORDS:
                    known.clear()
                new = [w for w in dict.fromkeys(words) if w not in known]
                known.update(zip(new, coder(new)))
                out.append(b"".join([*map(known.__getitem__, words), end]))
                for word in new:
                    if len(word) > LONG:  # not worth remembering
                        del known[word]
            yield pd.Series(out)

    coded = docs.select(F.col(doc_id).alias("doc_id"), encode(F.col(text).cast("string")).alias("ids"))
    # The number a row gets here is written with it, so it is the same for every later reader.
    return coded.select(
        "doc_id", "ids", F.spark_partition_id().cast("long").alias("part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),
        (F.octet_length("ids") / array(kind).itemsize).cast("long").alias("n"))


# ---- repeats of combinations -------------------------------------------------------------

def combinations(size: int, depth: int = 3) -> np.ndarray:
    """Counts per length 1..``size`` (columns) of shallow combinations that fill ``size`` (rows).

    Up to ``depth`` lengths, and one length repeated as often as it fits with one other behind it.
    """
    found = set()

    def extend(parts: tuple[int, ...], room: int, most: int) -> None:
        if room == 0:
            found.add(parts)
        elif len(parts) < depth:
            for part in range(min(room, most), 0, -1):
                extend((*parts, part), room - part, part)

    extend((), size, size)
    for part in range(1, size // 2 + 1):
        for times in range(2, size // part + 1):
            rest = size - times * part
            found.add(tuple(sorted([part] * times + [rest] * (rest > 0), reverse=True)))
    rows = sorted(found, reverse=True)
    out = np.zeros((len(rows), size), np.int64)
    for row, parts in enumerate(rows):
        np.add.at(out[row], np.array(parts) - 1, 1)
    return out


def non_negative(a: np.ndarray, b: np.ndarray, steps: int | None = None, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 with least |a x - b|, by active sets: columns enter by gradient, leave at zero."""
    x, inside = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(1.0, np.abs(a.T @ b).max(initial=0.0))
    for _ in range(steps or 10 * a.shape[0]):
        gradient = np.where(inside, -np.inf, a.T @ (b - a @ x))
        enter = int(gradient.argmax())
        if gradient[enter] <= tolerance * scale:
            break
        inside[enter] = True
        while True:
            columns = np.nonzero(inside)[0]
            best = np.linalg.lstsq(a[:, columns], b, rcond=None)[0]
            if (best > 0).all():
                x[:] = 0
                x[columns] = best
                break
            # Walk towards the solution until the first column reaches zero.
            falling = best <= 0
            step = (x[columns][falling] / (x[columns][falling] - best[falling])).min()
            x[columns] += step * (best - x[columns])
            inside[columns[falling & (x[columns] <= 1e-12 * max(1.0, x.max()))]] = False
            x[~inside] = 0
            if not inside.any():
                break
    return x


def repeats(histogram: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """Whole repeats per combination, never more than the histogram holds."""
    total = histogram.sum()
    if not total:
        return np.zeros(len(shapes), np.int64)
    wanted = non_negative(shapes.T.astype(float), histogram / total) * total
    left, out = histogram.copy(), np.zeros(len(shapes), np.int64)
    for row in np.argsort(-wanted, kind="stable"):
        if wanted[row] < 0.5:
            break
        used = shapes[row] > 0
        out[row] = min(int(round(wanted[row])), int((left[used] // shapes[row][used]).min()))
        left -= out[row] * shapes[row]
    return out


def slots(histogram: np.ndarray) -> tuple[list[tuple], int]:
    """(length, first rank, end rank, first sequence, copies of the length in one sequence), and the sequences."""
    shapes = combinations(len(histogram))
    times = repeats(histogram, shapes)
    out, used, sequence = [], np.zeros(len(histogram), np.int64), 0
    for row in np.nonzero(times)[0]:
        for column in np.nonzero(shapes[row])[0]:
            copies = int(shapes[row][column])
            end = int(used[column] + copies * times[row])
            out.append((int(column) + 1, int(used[column]), end, sequence, copies))
            used[column] = end
        sequence += int(times[row])
    return out, sequence


# ---- sums over partitions ----------------------------------------------------------------

def _sums_before(totals: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of ``value`` over smaller ``part``s, per key: blocks of parts, then within a block."""
    block = F.floor(F.col("part") / 1024)
    rows = totals.withColumn("_block", block)
    ahead = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*keys, "_block").agg(F.sum(value).alias("_whole")).select(
        *keys, "_block", F.coalesce(F.sum("_whole").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy(*keys, "_block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(blocks, [*keys, "_block"]).withColumn(
        out, F.col("_ahead") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_block", "_ahead", value)


def running(rows: DataFrame, value: str, order: list[str], out: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows before this one in the order of ``part``, ``order``."""
    totals = rows.groupBy("part").agg(F.sum(value).alias("_sum")).withColumn("_one", F.lit(1))
    ahead = _sums_before(totals, ["_one"], "_sum", "_start").drop("_one")
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(ahead, "part").withColumn(
        out, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_start")


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0, among the rows of the same ``bin``."""
    totals = rows.groupBy("bin", "part").agg(F.count(F.lit(1)).alias("_rows"))
    ahead = _sums_before(totals, ["bin"], "_rows", "_start")
    inside = Window.partitionBy("bin", "part").orderBy("place")
    return rows.join(ahead, ["bin", "part"]).withColumn("rank", F.col("_start") + F.row_number().over(inside) - 1).drop("_start")


# ---- packing -----------------------------------------------------------------------------

def plan(lengths: DataFrame, window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """(part, place, start, length, sequence_id, offset) per piece of the documents (part, place, n).

    ``window`` is a multiple of ``unit``.
    """
    spark = lengths.sparkSession
    rows = lengths.select(
        "part", "place", "n", F.floor(F.col("n") / window).alias("whole"), (F.col("n") % window).alias("left"),
        F.floor(F.col("n") % window / unit).cast("int").alias("bin"))
    size = window // unit
    counts = np.zeros(size, np.int64)
    whole = remainders = 0
    figures = [F.count(F.lit(1)).alias("rows"), F.sum("whole").alias("whole"), F.sum("left").alias("left")]
    for r in rows.groupBy("bin").agg(*figures).collect():  # ``size`` rows
        counts[r["bin"]], whole, remainders = r["rows"], whole + r["whole"], remainders + r["left"]
    dealt, combined = slots(np.append(counts[1:], 0))

    # Whole windows.
    numbered = running(rows.where("whole > 0"), "whole", ["place"], "first")
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("k")
    pieces = numbered.select("part", "place", "first", at).select(
        "part", "place", (F.col("k") * window).alias("start"), F.lit(window).cast("long").alias("length"),
        (F.col("first") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    # Remainders with a slot, one behind the other in their sequence; what hangs over comes back.
    rest = _ranked(rows.where("left > 0").withColumn("start", F.col("whole") * window).drop("n", "whole"))
    table = spark.createDataFrame(dealt, "length int, low long, high long, sequence long, copies int")  # fixed size
    dealt_to = (rest["bin"] == table["length"]) & (rest["rank"] >= table["low"]) & (rest["rank"] < table["high"])
    held = rest.join(F.broadcast(table), dealt_to, "left").select(
        "part", "place", "start", "left", "bin", "rank",
        (F.col("sequence") + F.floor((F.col("rank") - F.col("low")) / F.col("copies"))).alias("slot"))
    inside = Window.partitionBy("slot").orderBy(F.desc("bin"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = held.where("slot is not null").withColumn("offset", F.coalesce(F.sum("left").over(inside), F.lit(0)))
    placed = placed.withColumn("fits", F.greatest(F.lit(0), F.least("left", window - F.col("offset"))))
    pieces = pieces.unionByName(placed.where("fits > 0").select(
        "part", "place", "start", F.col("fits").alias("length"), (F.col("slot") + whole).alias("sequence_id"), "offset"))
    over = placed.where("fits < left").select(
        "part", "place", (F.col("start") + F.col("fits")).alias("start"), (F.col("left") - F.col("fits")).alias("left"))
    loose = held.where("slot is null").select("part", "place", "start", "left").unionByName(over)

    # The others as one stream, cut at every window, and behind the last whole one at powers of two.
    # Every combination fills its window, so the stream's length follows from the counts.
    full, tail = divmod(remainders - combined * window, window)
    ends = np.cumsum([1 << b for b in range(window.bit_length(), -1, -1) if tail >> b & 1]).tolist()
    begins = _longs([full * window + e for e in [0, *ends][:-1]])
    ends = _longs([full * window + e for e in ends])

    def number(at: Column) -> Column:
        return F.when(at < full * window, F.floor(at / window)).otherwise(full + F.size(F.filter(ends, lambda e: e <= at)))

    def bound(k: Column, tails: Column, add: int) -> Column:
        return F.when(k < full, (k + add) * window).otherwise(F.get(tails, (k - full).cast("int")))

    stream = running(loose, "left", ["place"], "at").withColumn("to", F.col("at") + F.col("left"))
    cut = stream.withColumn("k", F.explode(F.sequence(number(F.col("at")), number(F.col("to") - 1))))
    begin, end = bound(F.col("k"), begins, 0), bound(F.col("k"), ends, 1)
    cut = cut.withColumns({"from": F.greatest("at", begin), "till": F.least("to", end), "begin": begin})
    return pieces.unionByName(cut.select(
        "part", "place", (F.col("start") + F.col("from") - F.col("at")).alias("start"), (F.col("till") - F.col("from")).alias("length"),
        (F.col("k") + whole + combined).alias("sequence_id"), (F.col("from") - F.col("begin")).alias("offset")))


def _longs(values: list[int]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<long>")


def pack(
    docs: DataFrame, tokenizer: tuple[Callable, str] | None = None, window: int = WINDOW, unit: int = UNIT, separator: int = SEPARATOR,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) per piece.

    ``ids`` are little-endian unsigned 32-bit integers; every id of every document, the separator
    at its end included, lies in exactly one piece. Pieces of a sequence follow each other from
    offset 0 without a gap. A null or empty text is a separator alone. Rows that repeat an id, or
    have none, are documents like any other. An empty table gives an empty table; other columns are not read.
    Sequences are full but for the last few, whose lengths are powers of two.
    """
    spark = prepare(docs.sparkSession)
    folder = f"{checkpoint_dir(spark)}/window-packing-{uuid.uuid4()}"
    tokenizer = tokenizer or word_pairs()
    tokenized(docs, tokenizer, separator, doc_id, text).write.parquet(folder)
    coded = spark.read.parquet(folder)
    pieces = plan(coded.select("part", "place", "n"), window, unit)
    size, kind = array(tokenizer[1]).itemsize, f"<u{array(tokenizer[1]).itemsize}"

    @F.pandas_udf("binary")
    def widened(ids: pd.Series) -> pd.Series:
        return ids.map(lambda part: np.frombuffer(part, kind).astype("<u4").tobytes())

    part = F.substring("ids", (size * F.col("start") + 1).cast("int"), (size * F.col("length")).cast("int"))
    return coded.join(pieces, ["part", "place"]).select(
        "doc_id", "start", "length", (part if size == 4 else widened(part)).alias("ids"), F.col("n").alias("doc_tokens"), "sequence_id", "offset")


def sequences(pieces: DataFrame, window: int = WINDOW, pad: int = SEPARATOR) -> DataFrame:
    """(sequence_id, n, ids, starts): joined ids, padded to the window unless ``n`` is a power of two, and the pieces' offsets."""
    whole = pieces.groupBy("sequence_id").agg(  # at most ``window`` pieces
        F.sum("length").alias("n"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    fill = F.lit(np.full(window, pad, "<u4").tobytes())
    missing = F.when(F.col("n").bitwiseAND(F.col("n") - 1) == 0, 0).otherwise(window - F.col("n"))
    return whole.select(
        "sequence_id", "n", F.concat(joined, F.substring(fill, F.lit(1), (4 * missing).cast("int"))).alias("ids"),
        F.transform("parts", lambda p: p["offset"]).alias("starts"))
