"""Near-duplicate vectors by a subspace pigeonhole join.

Two unit vectors with cosine c lie at squared distance 2 - 2c. All vectors are turned by one random
rotation, which spreads their length evenly, and split into blocks of ``BLOCK`` dimensions. If the
squared distance is at most D, it is at most D * BLOCK / dimensions in at least one block, so it is
enough to range-join every block under this share and to verify the union exactly.

The entries of a label are dealt to tiles of bounded size by a hash, and every pair of tiles meets in one
task. There each block is range-joined by its squared distances, and the union of what is in range is
verified; a pair of vectors meets once, so it counts once. Copies of a vector are one entry with a number.
A task never returns pairs: it returns each entry's number of links and a spanning forest of the
links, so neither memory nor output grows with the square of a group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import cut, prepare
from creditmart.llm.components import components

COSINE = 0.93
BLOCK = 16
TILE = 8192
ROWS_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 15
SLACK = 1e-9  # of a budget, against rounding


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, turned; row by row the same whatever the other rows are."""
    turn = rotation(vectors.shape[1])
    out = np.empty(vectors.shape)
    for at in range(0, len(vectors), 256):
        part = vectors[at : at + 256]
        unit = part / np.sqrt((part * part).sum(axis=1))[:, None]
        out[at : at + 256] = (unit[:, None, :] * turn[None, :, :]).sum(axis=2)
    return out


def blocks(dims: int, cosine: float, block: int) -> list[tuple[int, int, float]]:
    """First and last dimension and squared range of each block."""
    total = 2 - 2 * cosine
    cuts = list(range(0, dims, block)) + [dims]
    return [(a, b, total * (b - a) / dims * (1 + SLACK) + 1e-12) for a, b in zip(cuts, cuts[1:])]


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that its largest component is near 1: exact, and no norm overflows."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def compare(key, rows: pd.DataFrame, cosine: float, block: int) -> pd.DataFrame:
    """Links between two tiles, or within one: counts, and a spanning forest.

    Gives (entry, root, links): for each entry with a link its root in the forest, and the number of
    vectors it is linked with here.
    """
    _, dims, first, second = key
    tile, copies, entry = (rows[c].to_numpy() for c in ("tile", "copies", "entry"))
    left, right = np.flatnonzero(tile == first), np.flatnonzero(tile == second)
    vectors = scaled(np.vstack([np.frombuffer(v, np.float64) for v in rows["vector"]]))
    norms, turned = np.sqrt((vectors * vectors).sum(axis=1)), rotated(vectors)
    layout = [(a, b, budget, (turned[:, a:b] ** 2).sum(axis=1)) for a, b, budget in blocks(int(dims), cosine, block)]
    root, links = np.arange(len(rows)), np.zeros(len(rows), np.int64)

    for start in range(0, len(left), ROWS_AT_ONCE):
        some = left[start : start + ROWS_AT_ONCE]
        near = np.zeros((len(some), len(right)), bool)
        for a, b, budget, square in layout:
            apart = square[some][:, None] + square[right][None, :] - 2 * turned[some, a:b] @ turned[right, a:b].T
            near |= apart <= budget * (1 + 1e-6) + 1e-9
        i, j = np.nonzero(near)
        x, y = some[i], right[j]
        if first == second:  # each pair of one tile once
            x, y = x[x < y], y[x < y]
        for at in range(0, len(x), PAIRS_AT_ONCE):
            p, q = x[at : at + PAIRS_AT_ONCE], y[at : at + PAIRS_AT_ONCE]
            close = (vectors[p] * vectors[q]).sum(axis=1) / (norms[p] * norms[q]) >= cosine
            p, q = p[close], q[close]
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            while len(p):
                least = np.minimum(root[p], root[q])
                np.minimum.at(root, root[p], least)
                np.minimum.at(root, root[q], least)
                while (root[root] != root).any():
                    root = root[root]
                apart = root[p] != root[q]
                p, q = p[apart], q[apart]
    told = np.flatnonzero(links > 0)
    return pd.DataFrame({"entry": entry[told], "root": entry[root[told]], "links": links[told]})


def usable(vector: str | Column, label: str | Column) -> Column:
    """Has a label, and finite components that are not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(
    rows: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    block: int = BLOCK, tile: int = TILE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors of equal label and dimension whose cosine is at least ``cosine`` are linked; copies are
    linked too. Vectors that are null, zero or hold null or non-finite components, and those
    without label, link with nothing and are their own component. ``component_id`` is the smallest
    id reachable (null where no reachable row has an id); repeated rows count as vectors of their
    own and come out alike. An empty table gives an empty table; other columns are not read.
    """
    spark = prepare(rows.sparkSession)
    name = F.col(label).cast("string")
    # Two hashes: at billions of vectors one alone would take different ones for copies.
    print_ = F.concat(F.hex(F.xxhash64(name, vector)), F.lit("-"), F.hex(F.xxhash64(F.lit(7), name, vector)))
    data = rows.select(
        F.col(vec_id).alias("vec_id"), F.when(usable(vector, label), print_).alias("entry"), name.alias("label"), F.col(vector).alias("vector"))
    whole = data.where(F.col("entry").isNotNull())
    entries = (
        whole.groupBy("entry", "label", "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies")))
    as_bytes = F.pandas_udf(lambda s: pd.Series([np.asarray(v, np.float64).tobytes() for v in s]), "binary")
    entries = cut(entries.select("entry", "label", "least", "copies", F.size("vector").alias("dims"), as_bytes("vector").alias("vector")))

    kinds = ["label", "dims"]
    tiles = entries.groupBy(*kinds).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    dealt = entries.select(*kinds, "entry", "copies", "vector").join(tiles, kinds).withColumn(
        "tile", F.pmod(F.xxhash64("entry"), F.col("tiles")).cast("int"))
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    meets = F.transform(every, lambda i: F.struct(F.least(i, F.col("tile")).alias("first"), F.greatest(i, F.col("tile")).alias("second")))
    dealt = dealt.select(*kinds, "tile", "entry", "copies", "vector", F.inline(meets))
    told = cut(
        dealt.groupBy(*kinds, "first", "second")
        .applyInPandas(lambda key, part: compare(key, part, cosine, block), "entry string, root string, links long"))

    counts = told.groupBy("entry").agg(F.sum("links").alias("links"))
    found = components(told, "entry", "root").select(F.col("node").alias("entry"), "component")
    classes = (
        entries.select("entry", "least", "copies").join(counts, "entry", "left").join(found, "entry", "left")
        .select("entry", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "entry").alias("component")))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "component").select("entry", "n_links", "component_id")
    linked = data.select("vec_id", "entry").join(classes, "entry", "left")
    alone = F.col("entry").isNull()
    out = linked.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
