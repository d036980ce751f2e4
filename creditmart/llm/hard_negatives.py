"""Hard negatives: rows of another label that score nearly as high as a positive.

Vectors become integers, so scores are exact. Anchors and candidates meet in tiles: blocks of
anchors by chunks of candidates, each pair of blocks in one task, whatever label is frequent. A tile
is an integer matrix product by Strassen's recursion on zero-padded int64 matrices. Its scores go
into heaps of fixed size, one per anchor for the positives and then one per anchor and positive for
the negatives in that positive's window. Heaps of different tiles merge, so no task sees all
candidates of an anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
ANCHORS, ROWS = 4096, 16384  # of one task
TILE_ANCHORS, TILE_ROWS = 512, 2048  # of one product
LEAF = 16  # Strassen's recursion ends at this size of the smallest side
NORM = 2.0**58  # of squared integer length: scores times 5 stay within 64 bits
NONE = np.int64(-(1 << 62))  # no entry


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of int64 matrices; zeros fill the sides up to a multiple of a power of two."""
    (m, k), n = a.shape, b.shape[1]
    levels, least = 0, min(m, k, n)
    while least > leaf:
        least, levels = -(-least // 2), levels + 1
    unit = 1 << levels

    def padded(x: np.ndarray) -> np.ndarray:
        return np.pad(x, [(0, -side % unit) for side in x.shape]) if any(side % unit for side in x.shape) else x

    return _product(padded(a), padded(b), levels)[:m, :n]


def _product(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = _product(a11 + a22, b11 + b22, levels - 1)
    p2 = _product(a21 + a22, b11, levels - 1)
    p3 = _product(a11, b12 - b22, levels - 1)
    p4 = _product(a22, b21 - b11, levels - 1)
    p5 = _product(a11 + a12, b22, levels - 1)
    p6 = _product(a21 - a11, b11 + b12, levels - 1)
    p7 = _product(a12 - a22, b21 + b22, levels - 1)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """The best ``size`` (score, id) of many keys: higher scores first, ties by smaller id."""

    def __init__(self, keys: int, size: int):
        self.scores = np.full((keys, size), NONE)
        self.ids = np.zeros((keys, size), np.int64)

    def merge(self, scores: np.ndarray, ids: np.ndarray, at: slice = slice(None)) -> None:
        """Put in entries of the keys ``at``, a row of them per key; those at NONE do not count."""
        size = self.scores.shape[1]
        scores, ids = np.hstack([self.scores[at], scores]), np.hstack([self.ids[at], ids])
        best = np.lexsort((ids, -scores), axis=1)[:, :size]
        self.scores[at] = np.take_along_axis(scores, best, 1)
        self.ids[at] = np.take_along_axis(ids, best, 1)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, id, score) of all entries."""
        key, place = np.nonzero(self.scores != NONE)
        return key, self.ids[key, place], self.scores[key, place]


def highest(scores: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the best columns of each row; ``ids`` ascend. ``scores`` is used up."""
    lines, found = np.arange(len(scores)), []
    for _ in range(min(size, scores.shape[1])):
        column = scores.argmax(1)  # of equal scores the first, i.e. the smallest id
        found.append((scores[lines, column], ids[column]))
        scores[lines, column] = NONE
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def integers(vectors: pd.Series, width: int) -> np.ndarray:
    """floor(SCALE * x) of every component; a shorter vector ends in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for place, vector in enumerate(vectors):
        out[place, : len(vector)] = np.floor(SCALE * np.asarray(vector, np.float64))
    return out


def tiles(anchors: pd.DataFrame, rows: pd.DataFrame) -> Iterator[tuple[slice, pd.DataFrame, np.ndarray]]:
    """(anchors' places, candidates, scores) of one block against one chunk."""
    width = max(map(len, [*anchors["vector"], *rows["vector"]]))
    left = integers(anchors["vector"], width)
    for start in range(0, len(rows), TILE_ROWS):
        part = rows[start : start + TILE_ROWS]
        right = integers(part["vector"], width).T
        for first in range(0, len(left), TILE_ANCHORS):
            at = slice(first, min(first + TILE_ANCHORS, len(left)))
            yield at, part, strassen(left[at], right)


def usable(vectors: DataFrame, vec_id: str, label: str, embedding: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, equal rows once."""
    length = F.aggregate(embedding, F.lit(0.0), lambda sum_, x: sum_ + (SCALE * x.cast("double")) * (SCALE * x.cast("double")))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & (length < NORM))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding).alias("vector"))


def mine(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: tuple[int, int] = (4, 5), vec_id: str = "vec_id",
    label: str = "label", embedding: str = "embedding", block: int = ANCHORS, chunk: int = ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. For each of an anchor's best
    ``positives`` rows of its label, the best ``negatives`` rows of other labels whose score lies
    between ``low`` (as a fraction) of the positive's and the positive's. Higher scores come first, ties by
    smaller id. Rows without id or label, without a vector, or with a null or non-finite component
    take no part, nor do vectors whose squared integer length reaches 2^58 (components in the
    millions), as their scores outgrow 64 bits. Of vectors of different length the shorter one ends in zeros;
    an empty one scores 0. Rows equal in id, label and vector count once; rows that share only the id are rows of their own, but
    never positives of each other. A negative score has no window. An empty table gives an empty
    table; other columns are not read.
    """
    found = usable(vectors, vec_id, label, embedding)
    sizes = found.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("vec_id") % every == 0).alias("anchors")).first()
    blocks, chunks = max(1, -(-sizes["anchors"] // block)), max(1, -(-sizes["rows"] // chunk))
    # Equal rows fold before they meet anything, so that no chunk outgrows its size.
    rows = found.distinct().withColumn("mark", F.xxhash64("vec_id", "label", "vector"))
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("block", F.pmod(F.xxhash64("mark"), F.lit(blocks)))
    candidates = rows.withColumn("chunk", F.pmod("mark", F.lit(chunks))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))

    def per_chunk(df: DataFrame) -> DataFrame:
        df = df.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<long>")))
        return df.toDF(*df.columns)  # columns of its own, told apart from the candidates'

    def positive_heaps(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, heaps = left.reset_index(drop=True), Heaps(len(left), positives)
        if len(left) and len(right):
            ids = left["vec_id"].to_numpy()
            for at, part, scores in tiles(left, right.sort_values("vec_id")):
                others = part["vec_id"].to_numpy()
                scores = np.where(ids[at, None] == others, NONE, scores)
                heaps.merge(*highest(scores, others, positives), at)
        key, other, score = heaps.entries()
        return pd.DataFrame({
            "vec_id": left["vec_id"].to_numpy()[key], "mark": left["mark"].to_numpy()[key], "positive_id": other, "positive_score": score})

    def negative_heaps(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.reset_index(drop=True)
        windows = Heaps(len(left) * positives, negatives)
        if len(left) and len(right):
            most = np.full((len(left), positives), -1, np.int64)  # a window's ends; one that is not there is empty
            for place, scores in enumerate(left["scores"]):
                most[place, : len(scores)] = scores
            least = np.where(most < 0, 1 << 60, -((-low[0] * most) // low[1]))
            labels = left["label"].to_numpy()
            for at, part, scores in tiles(left, right.sort_values("vec_id")):
                others, kinds = part["vec_id"].to_numpy(), part["label"].to_numpy()
                near = (scores >= least[at].min(1)[:, None]) & (scores <= most[at].max(1)[:, None]) & (labels[at, None] != kinds)
                row, column = np.nonzero(near)
                value = scores[row, column]
                order = np.lexsort((column, -value, row))
                row, column, value = row[order], column[order], value[order]
                lines = np.arange(at.start, at.stop)
                for window in range(positives):
                    inside = (value >= least[at][row, window]) & (value <= most[at][row, window])
                    r, c, v = row[inside], column[inside], value[inside]
                    place = np.arange(len(r)) - np.searchsorted(r, r)  # rank within the row
                    first = place < negatives
                    got, ids = np.full((len(lines), negatives), NONE), np.zeros((len(lines), negatives), np.int64)
                    got[r[first], place[first]], ids[r[first], place[first]] = v[first], others[c[first]]
                    windows.merge(got, ids, lines * positives + window)
        key, other, score = windows.entries()
        owner = key // positives
        return pd.DataFrame({
            "vec_id": left["vec_id"].to_numpy()[owner], "mark": left["mark"].to_numpy()[owner],
            "positive_rank": (key % positives + 1).astype(np.int32), "negative_id": other, "negative_score": score})

    keys = ["label", "block", "chunk"]
    near = per_chunk(anchors).groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(
        positive_heaps, "vec_id long, mark long, positive_id long, positive_score long")
    by_score = Window.partitionBy("vec_id", "mark").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("positive_rank", F.row_number().over(by_score)).where(F.col("positive_rank") <= positives)
    listed = near.groupBy("vec_id", "mark").agg(F.array_sort(F.collect_list(F.struct("positive_rank", "positive_id", "positive_score"))).alias("near"))

    keys = ["block", "chunk"]
    asking = anchors.join(listed, ["vec_id", "mark"]).withColumn("scores", F.col("near.positive_score"))
    far = per_chunk(asking.drop("near")).groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(
        negative_heaps, "vec_id long, mark long, positive_rank int, negative_id long, negative_score long")
    by_score = Window.partitionBy("vec_id", "mark", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    return far.join(near, ["vec_id", "mark", "positive_rank"]).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score")
