"""Small fixtures and brute-force helpers for the operators."""

from __future__ import annotations


class Sets:
    """Union by smallest member."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def documents(spark, texts, first=0, **extra):
    """Rows of ``documents`` for (doc_id, text) pairs or texts."""
    rows = [(t if isinstance(t, tuple) else (first + i, t)) for i, t in enumerate(texts)]
    rows = [(i, t, extra.get("lang", "en"), f"src{n % 3}", None if t is None else len(t)) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
