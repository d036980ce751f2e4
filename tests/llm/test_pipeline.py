import struct

import public_tokenizers
import sentencepiece
from helpers import documents
from test_decontaminate import slow as slow_hits
from test_line_dedup import slow as slow_lines
from test_simhash import slow_components, slow_fingerprint

import corpus_pipeline
from creditmart.llm import line_dedup, toxicity


def steps(spark, docs, folder):
    """What each stage returns, collected; each is checked on its own input."""
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        rows = out.collect()
        yield name, docs, rows, out.columns
        docs = spark.createDataFrame(rows, out.schema)


def test_stages_against_brute_force(spark, small):
    folder = small.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    seen = []
    for name, before, rows, columns in steps(spark, docs, folder):
        seen.append(name)
        given = [(r.doc_id, r.text, r.source) for r in before.collect()]
        if name != "sentencepiece":
            assert columns == docs.columns
            got = sorted((r.doc_id, r.text) for r in rows)
        if name == "toxicity":
            model = toxicity.train(before, spark.read.parquet(f"{folder}/labels.parquet"))
            known = toxicity.Known(model.weights)
            expected = [(d, t) for d, t, _ in given if toxicity.score_text(t.encode(), model, known)[0] < 0.3]
            assert 0 < len(given) - len(expected) < len(given) / 3
        elif name == "line_dedup":
            expected = slow_lines(given, line_dedup.MIN_SITES)
            assert all(r.n_chars == len(r.text) for r in rows)
        elif name == "simhash":
            least = slow_components([(d, slow_fingerprint(t)) for d, t, _ in given])
            expected = [(d, t) for d, t, _ in given if least[d, slow_fingerprint(t)] == d]
        elif name == "decontamination":
            bad = {r[0] for r in slow_hits([(d, t) for d, t, _ in given], items) if r[-1]}
            expected = [(d, t) for d, t, _ in given if d not in bad]
            assert bad
        else:
            got = sorted((r.doc_id, list(struct.unpack(f"<{r.n_tokens}I", r.ids))) for r in rows)
            expected = [(d, library.encode(t, add_bos=True, add_eos=True)) for d, t, _ in given]
            assert all(r.lossless for r in rows)
        assert got == sorted(expected), name
    assert seen == [s for s, _ in corpus_pipeline.STAGES]


def test_edge_rows_pass_all_stages(spark, small):
    docs = documents(spark, [(1, None), (2, ""), (2, ""), (None, "one two"), (4, "Plain words here."), (4, "Plain words here.")])
    kept = []
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, small)
        kept.append(sorted(str(r.doc_id) for r in rows.collect()))
    assert kept == [["1", "4", "None"], []]


def test_run(spark, small):
    out = corpus_pipeline.run(spark, small)
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    assert 0 < out.count() < n and out.count() == out.select("doc_id").distinct().count()
