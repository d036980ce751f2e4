import zlib

import numpy as np
from helpers import documents

from creditmart.llm import queries, toxicity


def test_spans_cover_the_text():
    text = "Erste Zeile! Hé ho; x\n\nEND".encode()
    parts = list(toxicity.spans(text))
    assert [text[a:b].strip() for a, b, _ in parts] == [b"Erste Zeile", "Hé ho".encode(), b"x", b"END"]


def test_gradient_learns_the_bad_word():
    bags = [(1, 3, [[0], [1]]), (1, 0, [[0, 1]]), (0, 4, [[1]]), (0, 2, []), (0, 1, [[1], [1]])] * 20
    weights, bias, leak = toxicity.fit_bags(bags, 2)
    assert weights[0] > 3 > abs(weights[1]) and bias < -4


def test_noisy_or_of_sentences():
    model = toxicity.Model({b"bad ": 6.0}, -4.0, -3.0)
    known = toxicity.Known(model.weights)
    score, n, offending = toxicity.score_text(b"All good. So BAD!\nbadly", model, known)
    p = [1 / (1 + np.exp(-z)) for z in (-3.0, -4.0, 2.0, -4.0)]
    assert abs(score - (1 - np.prod([1 - x for x in p]))) < 1e-12
    assert n == 3 and [(a, b) for a, b, _ in offending] == [(9, 16)]


def test_held_out_quality(spark, small):
    folder = small.replace("0.001", "0.01")
    rows = queries.QUERIES["op1_toxicity"](spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows) and len(rows) == 1000
    test = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p for y, p in test if y) / sum(y for y, _ in test) >= 0.6
    assert sum(p for y, p in test if not y) <= 1


def test_edge_cases(spark):
    docs = documents(spark, [(1, "fine words"), (1, "fine words"), (None, None), (2, ""), (3, "bad. " * 50_000)])
    docs = docs.withColumnRenamed("lang", "Score").withColumnRenamed("source", "_judged")
    labels = spark.createDataFrame([(1, 1), (None, 1), (9, 7)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model)
    assert out.count() == 5 and "_judged" in out.columns
    assert toxicity.score(docs.limit(0), model).count() == 0
    nothing = toxicity.train(docs.limit(0), labels.limit(0))
    assert nothing.weights == {} and [r.n_sentences for r in toxicity.score(docs, nothing).orderBy("doc_id", "n_chars").collect()][:2] == [0, 1]


def test_sample_is_bounded_when_ids_repeat(spark, monkeypatch):
    from creditmart.llm import toxicity as T
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2][:6]
    docs = spark.createDataFrame([(ids[0], f"bad word {n}.") for n in range(500)] + [(i, "good text here.") for i in ids[1:]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == ids[0])) for i in ids], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(T, "fit_bags", lambda bags, words: (seen.append(len(bags)), (__import__("numpy").zeros(words), 0.0, -5.0))[1])
    T.train(docs, labels, max_rows=3)
    assert seen and seen[0] <= 3
