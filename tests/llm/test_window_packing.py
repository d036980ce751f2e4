import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from creditmart.llm import queries, window_packing
from creditmart.llm.common import read
from helpers import documents


def reference_ids(texts):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*coder.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def checked(pieces, ids, window):
    """The pieces hold every id once and follow each other in full sequences."""
    docs, rows = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append((p["start"], p["length"], p["ids"], p["doc_tokens"]))
        rows[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(docs) == set(ids)
    for key, parts in docs.items():
        whole = np.array(ids[key], "<u4").tobytes()
        at = 0
        for start, length, piece, n in sorted(parts):
            assert start == at and length > 0 and n == len(ids[key]) and piece == whole[4 * start : 4 * (start + length)]
            at += length
        assert at == len(ids[key])
    partial = []
    for parts in rows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        if at < window:
            partial.append(at)
    assert all(n & (n - 1) == 0 for n in partial) and len(partial) == len(set(partial))


WORDS = ["the", "The", "model", "naïve", "don't", "it's", "日本語", "é", "́x", "<|endoftext|>", "a<|startoftext|>b", "１２", "3.14", "🙂", "ΣΑΣ",
         "İ", "don'T", "Ÿé'LL", "œuvre42Ŀ", "ß×÷µªſŉ", "a<|b", "x_y-Z;'D", "\x1c", "a\x85b", " ", " ", "x　y", "\x0b", "\x0c", "\x00", "ﬁ", "…", "'", "'S"]


def test_words_encode_like_whole_texts(spark):
    draw = random.Random(7)
    texts = [draw.choice(["", " ", "\n"]).join(draw.choices(WORDS, k=draw.choice([0, 1, 9, 40]))) for _ in range(120)]
    texts += ["".join(draw.choice([*WORDS, " ", "\t", "\r\n"]) for _ in range(60)) for _ in range(60)] + [None, "", "x" * 200_000, "a b " * 100_000]
    got = window_packing.tokenized(documents(spark, texts), window_packing.word_pairs(), 2, "doc_id", "text")
    found = {r["doc_id"]: np.frombuffer(r["ids"], "<u2").tolist() for r in got.select("doc_id", "ids").collect()}
    assert [found[i] for i in range(len(texts))] == reference_ids(texts)


def numbers():
    """A stand-in for the tokenizer, shipped by value: one id per word."""
    return (lambda: lambda words: [(100 + len(w)).to_bytes(4, "little") for w in words]), "I"


@pytest.mark.parametrize("window,unit", [(4096, 64), (64, 4), (32, 32)])
@pytest.mark.parametrize("kind", ["mixed", "equal", "short", "one"])
def test_pieces_hold_every_id_once(spark, kind, window, unit):
    draw = random.Random(1)
    sizes = {"mixed": [draw.choice([0, 1, 5, 30, 63, 64, 200, 900, 2000, 4095, 4096, 9000]) for _ in range(150)], "equal": [2600] * 60,
             "short": [7] * 500, "one": [100]}[kind]
    texts = [" ".join("x" * draw.randint(1, 9) for _ in range(n)) for n in sizes]
    out = window_packing.pack(documents(spark, texts).repartition(7), numbers(), window, unit).collect()
    checked(out, {i: [100 + len(w) for w in t.split()] + [2] for i, t in enumerate(texts)}, window)


def test_repeats_and_nulls(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "d"), (None, None), (2**60 + 1, ""), (2**60 + 2, "e f")]
    docs = documents(spark, rows).selectExpr("*", "1 as n", "'x' as ids", "0 as start")
    out = window_packing.pack(docs)
    assert out.schema["doc_id"].dataType.simpleString() == "bigint"
    got = out.collect()
    assert sum(r["length"] for r in got) == 4 + 4 + 2 + 1 + 1 + 3
    assert {r["doc_id"] for r in got} == {1, None, 2**60 + 1, 2**60 + 2}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert window_packing.pack(empty).count() == 0
    text = spark.createDataFrame([("k", "a b")], "doc_id string, text string")
    assert [r["doc_id"] for r in window_packing.pack(text).collect()] == ["k", "k"]  # three tokens: two and one


def test_sequences_are_padded_unless_a_power_of_two(spark):
    texts = ["w " * n for n in (3000, 3000, 70, 5)]
    pieces = window_packing.pack(documents(spark, texts), numbers(), 4096, 64)
    rows = window_packing.sequences(pieces).collect()
    assert sum(r["n"] for r in rows) == sum((3001, 3001, 71, 6))
    for r in rows:
        assert len(r["ids"]) == 4 * (4096 if r["n"] & (r["n"] - 1) else r["n"]) and r["starts"][0] == 0


def brute(a, b):
    """Least squares over every set of columns with a non-negative solution."""
    best = float(b @ b)
    for mask in range(1, 1 << a.shape[1]):
        columns = [i for i in range(a.shape[1]) if mask >> i & 1]
        x = np.linalg.lstsq(a[:, columns], b, rcond=None)[0]
        if (x >= 0).all():
            best = min(best, float(((a[:, columns] @ x - b) ** 2).sum()))
    return best


def test_non_negative_least_squares():
    draw = np.random.default_rng(3)
    for _ in range(60):
        a, b = draw.integers(-2, 4, (5, 7)).astype(float), draw.normal(size=5)
        x = window_packing.non_negative(a, b)
        assert (x >= 0).all() and abs(((a @ x - b) ** 2).sum() - brute(a, b)) < 1e-6


def test_combinations_fill_the_window_and_repeats_fit():
    shapes = window_packing.combinations(64)
    assert (shapes @ np.arange(1, 65) == 64).all() and len(np.unique(shapes, axis=0)) == len(shapes)
    draw = np.random.default_rng(8)
    for histogram in (draw.integers(0, 1000, 64), np.eye(64, dtype=int)[40] * 900, draw.poisson(3, 64), np.zeros(64, int)):
        times = window_packing.repeats(histogram, shapes)
        assert (times >= 0).all() and (shapes.T @ times <= histogram).all()
    even = np.zeros(64, int)
    even[[9, 53]] = 500  # lengths 10 and 54 pair up
    assert (shapes.T @ window_packing.repeats(even, shapes)).sum() == 1000


def test_query_on_whole_table(spark, small):
    out = queries.QUERIES["op12_window_packing"](spark, small).collect()
    rows = read(spark, small, "documents").select("doc_id", "text").collect()
    ids = dict(zip((r["doc_id"] for r in rows), reference_ids([r["text"] for r in rows])))
    docs = defaultdict(int)
    totals = defaultdict(int)
    for r in out:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(part) and r["doc_tokens"] == len(ids[r["doc_id"]])
        docs[r["doc_id"]] += r["length"]
        totals[r["sequence_id"]] += r["length"]
    assert docs == {k: len(v) for k, v in ids.items()}
    padding = sum(4096 - n for n in totals.values() if n & (n - 1))
    assert padding == 0
