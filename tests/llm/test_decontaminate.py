import hashlib
import re

import pytest
from helpers import documents

from creditmart.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items):
    windows = {}
    for i, text in items:
        words = words_of(text)
        n = min(10, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k : k + n]), set()).add(str(i))
    out = []
    for d, text in docs:
        words, hit, met = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                who = windows.get(tuple(words[k : k + n]))
                if who:
                    hit.update(range(k, k + n))
                    met |= who
        out.append((d, len(words), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = queries.QUERIES["op6_decontamination"](spark, small).collect()
    assert sorted((tuple(r) for r in got), key=str) == slow(docs, items)
    assert any(r.contaminated for r in got)


def digest(found):
    return sorted(((r.doc_id, r.n_words, sum(h.e - h.s for h in r.hits), len(r.items),
                    hashlib.sha256(",".join(r.items).encode()).hexdigest(), bool(r.hits)) for r in found.collect()), key=str)


def test_spans_ties_and_edges(spark):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (2, "Ünï CODE"), (3, "a " * 12), (4, None), (5, "!!"), (6, " ".join(f"w{i}" for i in range(5, 16))), (2, "x")]
    texts = [
        (1, "pre " + long + " post"), (2, " ".join(f"w{i}" for i in range(9))), (3, " ".join(f"w{i}" for i in range(7, 18))),
        (4, "x-Ünï.code y"), (5, "a " * 10), (6, "a " * 30), (7, None), (None, "w1 " + long), (8, ""), (1, "pre " + long + " post"),
        (9, "filler " * 60_000 + long), (10, " ".join(f"w{i}" for i in [*range(12), *range(3, 20), *range(30, 40)]))]
    docs = documents(spark, texts).withColumnRenamed("source", "item_id").withColumnRenamed("lang", "words")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert digest(decontaminate.find(docs, bench)) == slow(texts, items)
    assert sorted(str(r.doc_id) for r in decontaminate.clean(docs, bench).collect()) == ["2", "7", "8"]
    assert decontaminate.find(docs.limit(0), bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(texts)


@pytest.mark.parametrize("window", [1, 3])
def test_kept_smallest_of_each_window(window):
    import numpy as np

    found = np.array([5, 2, 2, 9, 1, 1, 1, 7], np.uint64)
    expected = {max(range(i, i + window), key=lambda j: (-int(found[j]), j)) for i in range(len(found) - window + 1)}
    assert set(decontaminate.kept(found, window).tolist()) == expected
