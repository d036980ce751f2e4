import math

import numpy as np
import pytest

from compare import connect, difference
from creditmart.llm import hard_negatives, oracles, queries


def slow(rows, every, k=5):
    """rows: (vec_id, vector, label) -> (anchor, positive, rank, negative, scores)."""
    good = sorted({(i, x, tuple(math.floor(256 * c) for c in v)) for i, v, x in rows
                   if i is not None and v is not None and x is not None and None not in v and all(map(math.isfinite, v))})

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for a, label, v in good:
        if a % every == 0:
            scored = sorted(((-score(v, w), b, x) for b, x, w in good))
            near = [(s, b) for s, b, x in scored if x == label and b != a][:k]
            for s, b in near:
                far = [(t, c) for t, c, x in scored if x != label and 80 * -s <= 100 * -t <= 100 * -s][:k]
                out += [(a, b, r, c, -s, -t) for r, (t, c) in enumerate(far, 1)]
    return sorted(out)


def run(spark, rows, **more):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, mark int" if len(rows and rows[0]) == 4 else
                                  "vec_id long, embedding array<float>, label int")
    out = hard_negatives.mine(frame, **more)
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in out.collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 70, 5), (64, 64, 64), (130, 33, 257), (200, 100, 41), (5, 0, 4)])
def test_strassen_equals_product(shape):
    m, k, n = shape
    draw = np.random.default_rng(1)
    a, b = draw.integers(-(1 << 24), 1 << 24, (m, k)), draw.integers(-(1 << 24), 1 << 24, (k, n))
    assert (hard_negatives.strassen(a, b, leaf=4) == a @ b).all() and hard_negatives.strassen(a, b).shape == (m, n)


def test_heaps_merge_in_any_order():
    draw = np.random.default_rng(2)
    scores, ids = draw.integers(0, 6, (3, 40)), np.tile(draw.permutation(40), (3, 1))
    whole = hard_negatives.Heaps(3, 5)
    whole.merge(scores, ids)
    for step in (1, 7, 13):
        parts = hard_negatives.Heaps(3, 5)
        for at in reversed(range(0, 40, step)):
            one = hard_negatives.Heaps(3, 5)
            one.merge(scores[:, at : at + step], ids[:, at : at + step])
            parts.merge(one.scores, one.ids)
        assert (parts.scores == whole.scores).all() and (parts.ids == whole.ids).all()
    for row in range(3):
        best = sorted(zip(-scores[row], ids[row]))[:5]
        assert [(-s, i) for s, i in zip(whole.scores[row], whole.ids[row])] == best


@pytest.mark.parametrize("block,chunk", [(4096, 16384), (7, 50)])
def test_against_brute_force(spark, block, chunk):
    draw = np.random.default_rng(4)
    centres = np.abs(draw.normal(size=(6, 12)))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 6] + 0.3 * draw.normal(size=12)], int(draw.choice([0, 0, 1, 2])))
            for i in range(300)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(120)] + [(2000 + i, rows[3][1], 1) for i in range(40)]
    assert run(spark, rows, every=10, block=block, chunk=chunk) == slow(rows, 10)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1, 0), (1, [1.0, 0.5], 1, 0), (2, [1.0, 0.5], 2, 0), (3, None, 1, 0), (4, [nan, 1.0], 2, 0), (5, [None, 1.0], 2, 0),
            (6, [inf, 1.0], 2, 0), (7, [0.9, 0.5], None, 0), (None, [1.0, 0.5], 2, 0), (8, [1.0], 2, 0), (9, [], 1, 0), (10, [-1.0, -1.0], 1, 0),
            (11, [0.9, 0.5], 2, 0), (11, [0.9, 0.5], 2, 0), (0, [0.2, 0.3], 1, 0), (20, [], 3, 0), (30, [0.0, 0.0], 1, 0), (12, [-0.0, 1.5], 2, 0)]
    assert run(spark, rows, every=10) == slow([r[:3] for r in rows], 10)
    assert run(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == [] == run(spark, [(0, [1.0], 1), (1, [1.0], 1)])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(empty).count() == 0
    huge = spark.createDataFrame([(0, [1e300], 1), (1, [1.0], 1), (2, [1.0], 2), (100, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    assert [(r["anchor_id"], r["positive_id"], r["negative_id"]) for r in hard_negatives.mine(huge).collect()] == [(100, 1, 2)]


def test_query_equals_sql(spark, small):
    name = "op11_hard_negatives"
    assert difference(queries.QUERIES[name](spark, small), connect(small), oracles.ORACLES[name]) is None
