import random
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from compare import connect, difference
from creditmart.llm import filter_audit, oracles, queries
from helpers import documents


def slow_masks(rows):
    """rows: (doc_id, text, source) -> Counter of (doc_id, part, mask)."""
    out = Counter()
    for key, text, source in rows:
        text = text or ""
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
        bits = [len(words) < 50, 100 * len(set(words)) < 65 * len(words),
                100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), any(c in "#$%&*|" for c in text),
                key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows)]
        out[key, source or "", sum(b << i for i, b in enumerate(bits))] += 1
    return out


def slow_audit(masks, labels):
    out, shapley = {}, defaultdict(int)
    for order in permutations("ABCDE"):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << "ABCDE".index(letter)
            for part in {p for _, p, _ in masks}:
                line = Counter()
                for (key, p, mask), n in masks.items():
                    if p == part:
                        line["kept"] += n * (mask & (before | bit) == 0)
                        gone = n * (mask & bit != 0 and mask & before == 0)
                        line["removed"] += gone
                        line["redundant"] += n * (mask & bit != 0 and mask & before != 0)
                        line["unique_fails"] += n * (mask == bit)
                        line["good_lost"] += gone * labels.get(key, (0, 0))[0]
                        line["toxic_lost"] += gone * labels.get(key, (0, 0))[1]
                shapley[part, letter] += line["removed"]
                out[part, "".join(order), step] = line, letter
            before |= bit
    return {k: (*(line[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")), shapley[k[0], x])
            for k, (line, x) in out.items()}


def corpus(n=240):
    draw = random.Random(5)
    words = ["alpha", "Beta", "gamma", "GAMMA", "é", "日本", "x#", "\x1f", "\x85a"] + [f"w{i}" for i in range(80)]
    texts = [" ".join(draw.choices(words, k=draw.choice([0, 1, 40, 70, 90]))) for _ in range(n // 3)]
    texts += [None, "", " \t\n", "a", "ab", "abc", "A" * 3000, "A" * 3000 + "b", "A" * 3000 + "c", "A" * 2000]
    rows = [(draw.choice([i, i, i, 7, None]), draw.choice(texts), draw.choice(["s", "s", "t", "", None])) for i in range(n)]
    return rows + [(500 + i, texts[0], "hot") for i in range(150)] + rows[:5]


@pytest.mark.parametrize("trie_bytes", [1, 3000, 8 << 20])
def test_masks_and_orders_against_brute_force(spark, trie_bytes):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mask", __import__("pyspark").sql.functions.lit(1))
    failed = filter_audit.failures(docs.repartition(5), trie_bytes=trie_bytes)
    masks = Counter()
    for r in failed.collect():
        masks[r["doc_id"], r["part"], r["mask"]] += r["n"]
    assert masks == slow_masks(rows)
    if trie_bytes == 1:
        labels = [(i, i % 2, i % 3 == 0) for i in range(0, 600, 2)] + [(None, 1, True), (4, 1, False)]
        marks = {}
        for key, good, bad in labels:
            if key is not None:
                marks[key] = (max(marks.get(key, (0, 0))[0], good), max(marks.get(key, (0, 0))[1], int(bad)))
        frame = spark.createDataFrame([(a, b, int(c)) for a, b, c in labels], "doc_id long, quality int, toxic int")
        out = {(r["part"], r["filter_order"], r["step"]): (
            r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"])
            for r in filter_audit.audit(failed, frame).collect()}
        assert out == slow_audit(masks, marks)


def test_trie_keeps_the_least_id():
    draw = random.Random(3)
    pieces = [b"a", b"ab", b"abc", b"abd", b"", b"b" * 50, b"b" * 50 + b"c", b"\xff\x00"]
    for _ in range(30):
        rows = [(b"".join(draw.choices(pieces, k=2)), draw.randrange(20)) for _ in range(60)]
        trie, lost = filter_audit.Trie(), []
        for text, key in rows:
            lost += trie.insert(text, key, ("p", 0))
        left = {(text, key): n for text, key, _, n in trie.terminals()}
        least = {}
        for text, key in rows:
            least[text] = min(key, least.get(text, key))
        assert left == Counter((t, k) for t, k in rows if least[t] == k)
        assert sum(n for *_, n in lost) + sum(left.values()) == len(rows)


def test_long_texts_and_empty_table(spark):
    long = "word " * 400_000
    got = filter_audit.failures(documents(spark, [long, long, long + "end"])).collect()
    assert sorted((r["doc_id"], r["mask"]) for r in got) == [(0, 2), (1, 18), (2, 2)]
    empty = filter_audit.failures(documents(spark, []) if False else spark.createDataFrame([], "doc_id long, text string, source string"))
    assert filter_audit.audit(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_text_ids(spark):
    rows = spark.createDataFrame([("b", "x", "s"), ("a", "x", "s"), ("c", "y", None)], "doc_id string, text string, source string")
    assert sorted((r["doc_id"], r["mask"]) for r in filter_audit.failures(rows).collect()) == [("a", 1), ("b", 17), ("c", 1)]


def test_query_equals_sql(spark, small):
    name = "op13_filter_audit"
    assert difference(queries.QUERIES[name](spark, small), connect(small), oracles.ORACLES[name]) is None
