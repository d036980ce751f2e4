import numpy as np
from helpers import documents

from creditmart.llm import language, queries


def test_gradient_is_the_difference_quotient():
    draw = np.random.default_rng(0)
    n = language.STATES
    params = {"table": draw.normal(0, 0.3, (2, 256, 3 * n)), "gates": draw.normal(0, 0.3, (2, n, 2 * n)),
              "candidate": draw.normal(0, 0.3, (2, n, n)), "out": draw.normal(0, 0.3, (2 * n, 3)), "bias": np.zeros(3)}
    codes, labels = draw.integers(97, 105, (6, 4)).astype(np.uint8), draw.integers(0, 3, 4)
    slopes = language.loss_and_slopes(params, codes, labels)[1]
    places = {"table": (1, int(codes[3, 2]), 5), "gates": (0, 2, 9), "candidate": (1, 3, 4), "out": (7, 1), "bias": (2,)}
    for name, at in places.items():
        sides = []
        for step in (1e-5, -1e-5):
            moved = {k: v.copy() for k, v in params.items()}
            moved[name][at] += step
            sides.append(language.loss_and_slopes(moved, codes, labels)[0])
        assert abs((sides[0] - sides[1]) / 2e-5 - slopes[name][at]) < 1e-7


def test_stretches_agree_with_one_run():
    """A text read in stretches scores as the network run over it in one go, up to the cut-off surroundings."""
    net = language.fit([b"the and of " * 20, b"der und das " * 20], ["en", "de"], steps=30)
    for text in (b"x", b"the und " * 13, b"of das the " * 41):
        codes = np.frombuffer(b" " * language.LEAD + text.translate(language.FOLD) + b" " * language.LEAD, np.uint8)[:, None]
        ahead = language.run_layer(net.table[0], net.gates[0], net.candidate[0], codes)
        back = language.run_layer(net.table[1], net.gates[1], net.candidate[1], codes[::-1])[::-1]
        p = language._softmax(np.concatenate([ahead, back], 2)[language.LEAD : -language.LEAD, 0] @ net.out + net.bias)
        assert np.allclose(language.probabilities([text], net)[0], p.mean(axis=0), atol=0.02)


def test_held_out_accuracy(spark, small):
    folder = small.replace("0.001", "0.01")
    rows = queries.QUERIES["op5_language_id"](spark, folder).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    test = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in test) >= 0.95 * len(test)


def test_edge_cases(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "12 !?"), (None, "the end"), (5, "und so weiter " * 20_000), (5, "é"), (5, "é")])
    docs = docs.withColumnRenamed("source", "Score").withColumnRenamed("n_chars", "_spoken")
    for net in (language.train(docs.limit(0)), language.train(docs, steps=3)):
        out = {(r.doc_id, r.text): r.lang_pred for r in language.predict(docs, net).collect()}
        assert len(out) == 6 and [out[k] for k in ((1, None), (2, ""), (3, "12 !?"))] == ["und"] * 3
        assert language.predict(docs.limit(0), net).count() == 0
    assert out[5, "é"] == "en"


def test_sample_is_bounded_and_knows_rare_languages(spark, monkeypatch):
    """Equal rows count once, one id may have many texts, and each language gets its share."""
    import zlib

    from creditmart.llm import language as G
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(ids[0], "the same text " * 9, "en")] * 300 + [(ids[1], f"one id {n} " * 9, "en") for n in range(300)]
    rows += [(i, f"text {i} " * 9, "en") for i in ids[2:900]] + [(ids[905], "selten " * 9, "de"), (ids[906], "raro " * 9, None)]
    seen = []
    monkeypatch.setattr(G, "fit", lambda texts, names, steps: seen.append(list(names)))
    G.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), max_rows=200)
    assert seen[0].count("de") == 1 and seen[0].count("en") == 100
