"""Toxic documents and the sentences that make them so, learned from document labels.

Multiple-instance learning: a document is a bag of sentences, and only the bag has a label. A
sentence's probability is a logistic function of its words; a document's is their noisy-or,
1 - (1 - leak) * prod(1 - p of each sentence). The leak stands for positive labels that no sentence
explains. The gradient of the document's likelihood reaches each sentence in proportion to how
much it explains the label, so sentence scores come out of document labels, and scoring can point
at the sentences.

A sentence's features are its words and the words' beginnings, so that unseen forms of a known stem
count too.

Training: a bounded sample of labelled documents is chosen on the ids; Spark counts each feature's
documents per label and keeps those that go with either label; the sentences, reduced to these
features, are fitted on the driver. Scoring is one pass over the documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import cut, free_name, held_out, prepare, ship, utf8

MAX_ROWS = 12_000  # labelled documents that are fitted; the sample is drawn by a hash of the id
MAX_FEATURES = 2_000
MIN_DOCS = 3
MIN_G = 16.0  # likelihood ratio statistic of a feature's documents between the labels
STEMS = (3, 4, 5, 6, 7, 8)  # lengths of the beginnings, in bytes
KEPT_WORDS = 300_000  # entries of a worker's word table; it is emptied when full
THRESHOLD = 0.3
ROUNDS = 400
PLAIN = -8.0  # what the bias is drawn to: a sentence without any telling word is clean

# ASCII: letters to lower case, sentence ends to line breaks, the rest to blanks. Same length.
TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 10 if chr(c) in ".!?;\n" else 32
    for c in range(256))


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float
    leak: float  # log odds

    def sentence(self, words) -> float:
        return self.bias + sum(self.weights[w] for w in words)


def _softplus(x):
    return np.logaddexp(0.0, x)


def spans(text: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Start, end (in bytes of the text) and folded content of each sentence."""
    at = 0
    for part in text.translate(TABLE).split(b"\n"):
        if part and not part.isspace():
            yield at, at + len(part), part
        at += len(part) + 1


def _forms(word: bytes) -> list[bytes]:
    """Features of a word: itself, ended by a blank, and its beginnings."""
    return [word + b" ", *(word[:k] for k in STEMS if k <= len(word))]


class Known:
    """Looks up the features of a model in words, and keeps what it found."""

    def __init__(self, features):
        self.features, self.table = frozenset(features), {}

    def of(self, words: list[bytes]) -> set[bytes]:
        table, hit = self.table, set()
        for word in words:
            got = table.get(word)
            if got is None:
                if len(table) >= KEPT_WORDS:
                    table.clear()
                got = table[word] = tuple(f for f in _forms(word) if f in self.features)
            if got:
                hit.update(got)
        return hit


def _bags(text: bytes, known: Known) -> tuple[int, list[list[bytes]]]:
    """Number of sentences without any known feature, and the known features of the others."""
    plain, bags = 0, []
    for _, _, part in spans(text):
        hit = known.of(part.split())
        if hit:
            bags.append(sorted(hit))
        else:
            plain += 1
    return plain, bags


def fit_bags(bags: list[tuple[int, int, list[list[int]]]], n_words: int) -> tuple[np.ndarray, float, float]:
    """Maximise the posterior of (label, plain sentences, word ids of the others) by Adam."""
    labels = np.array([b[0] for b in bags], float)
    plain = np.array([b[1] for b in bags], float)
    doc_of = np.array([d for d, b in enumerate(bags) for _ in b[2]], np.int64)
    sentences = [s for b in bags for s in b[2]]
    sent_of = np.array([i for i, s in enumerate(sentences) for _ in s], np.int64)
    words = np.array([w for s in sentences for w in s], np.int64)
    theta = np.zeros(n_words + 2)
    theta[-2:] = PLAIN / 2, PLAIN  # the leak starts low, so that words explain the labels first
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        w, bias, leak = theta[:-2], theta[-2], theta[-1]
        z = bias + np.bincount(sent_of, weights=w[words], minlength=len(sentences))
        total = _softplus(leak) + plain * _softplus(bias) + np.bincount(
            doc_of, weights=_softplus(z), minlength=len(bags))
        pull = np.where(labels > 0, -1.0 / np.expm1(np.clip(total, 1e-9, 500)), 1.0)
        by_sentence = pull[doc_of] / (1 + np.exp(-z))
        slope = np.empty_like(theta)
        slope[:-2] = np.bincount(words, weights=by_sentence[sent_of], minlength=n_words) + w / 4
        slope[-2] = by_sentence.sum() + (pull * plain).sum() / (1 + np.exp(-bias)) + (bias - PLAIN) * 10
        slope[-1] = pull.sum() / (1 + np.exp(-leak))
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta = theta - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return theta[:-2], float(theta[-2]), float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> Model:
    """Fit on labelled documents that are not held out.

    At most ``max_rows`` ids are drawn, by a hash, and of each one text, so no more documents reach the
    driver. A label other than 0 or 1, a null id and a null text are left aside; of several labels of a
    document the largest counts, and copies of a text count once. Without labelled rows, or with one
    label only, the model has no words and its leak is the rate of the label.
    """
    spark = prepare(docs.sparkSession)
    chosen = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    sample = cut(
        docs.select("doc_id", utf8().alias("text")).where(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")  # max_rows ids and labels
        .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))  # an id may repeat
        .groupBy("text").agg(F.max("toxic").alias("toxic")))  # copies are one example

    def document_counts(batches):
        for batch in batches:
            seen = (Counter(), Counter())
            for toxic, text in zip(batch["toxic"], batch["text"]):
                words = set(text.translate(TABLE).split())
                seen[toxic].update({f for w in words for f in _forms(w)})
            names = sorted(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"word": names, "a": [seen[1][w] for w in names], "b": [seen[0][w] for w in names]})

    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    counts = (
        sample.mapInPandas(document_counts, "word binary, a long, b long").groupBy("word")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where(F.col("a") + F.col("b") >= MIN_DOCS))
    positive, negative = size.get(1, 0), size.get(0, 0)
    share = F.lit(positive / max(1, positive + negative))
    n = F.col("a") + F.col("b")

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g = 2 * (term(F.col("a"), n * share) + term(F.col("b"), n * (1 - share)))
    found = counts.select("word", g.alias("g")).where(F.col("g") >= MIN_G).orderBy(F.desc("g"), "word").limit(max_features)
    words = sorted(bytes(r["word"]) for r in found.collect()) if positive and negative else []
    number = {w: i for i, w in enumerate(words)}

    @F.pandas_udf("plain int, words array<array<int>>")
    def reduced(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Known(number)
        for batch in batches:
            rows = [_bags(t, known) for t in batch]
            yield pd.DataFrame({"plain": [r[0] for r in rows], "words": [[[number[w] for w in s] for s in r[1]] for r in rows]})

    # at most max_rows documents, each reduced to the telling words
    rows = sample.select("toxic", reduced("text").alias("r")).select("toxic", "r.plain", "r.words").collect()
    if not rows:
        return Model({}, PLAIN, -5.0)
    bags = sorted((r["toxic"], r["plain"], [list(s) for s in r["words"]]) for r in rows)
    weights, bias, leak = fit_bags(bags, len(words))
    return Model(dict(zip(words, weights.tolist())), bias, leak)


def score_text(text: bytes | None, model: Model, known: Known, locate: float = THRESHOLD):
    """Document probability, number of sentences, and (start, end, p) of the offending ones."""
    total, n, offending = float(_softplus(model.leak)), 0, []
    plain = float(_softplus(model.bias))
    for start, end, part in spans(text or b""):
        n += 1
        hit = known.of(part.split())
        if not hit:
            total += plain
            continue
        z = model.sentence(sorted(hit))
        total += float(_softplus(z))
        p = float(1 / (1 + np.exp(-z)))
        if p >= locate:
            offending.append((start, end, p))
    return float(-np.expm1(-total)), n, offending


def score(
    docs: DataFrame, model: Model, text: str = "text", locate: float = THRESHOLD,
    names: tuple[str, str, str] = ("score", "n_sentences", "offending"),
) -> DataFrame:
    """Add score (0 to 1), n_sentences and offending sentences to every document.

    The results' ``names`` can be chosen. ``offending`` lists start and end (bytes of the UTF-8 text) and probability of the sentences at
    or over ``locate``. Null, empty and blank texts have no sentences and the leak as score. Repeated
    rows score alike; all other columns stay, save that columns named like results are replaced.
    """
    spark = prepare(docs.sparkSession)
    shared = ship(spark, model)  # at most max_features weights

    @F.pandas_udf("score double, n_sentences int, offending array<struct<start:int,end:int,p:double>>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared()
        known = Known(model.weights)
        for batch in batches:
            rows = [score_text(t, model, known, locate) for t in batch]
            yield pd.DataFrame({
                "score": [r[0] for r in rows], "n_sentences": [r[1] for r in rows],
                "offending": [[{"start": s, "end": e, "p": p} for s, e, p in r[2]] for r in rows]})

    work = free_name(docs, "_judged")
    out = docs.withColumn(work, judge(utf8(text)))
    for name, field in zip(names, ("score", "n_sentences", "offending")):
        out = out.withColumn(name, F.col(f"{work}.{field}"))
    return out.drop(work)


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents that score below ``threshold``; columns as they are."""
    names = tuple(free_name(docs, n) for n in ("_score", "_sentences", "_offending"))
    return score(docs, model, text, threshold, names).where(F.col(names[0]) < threshold).drop(*names)
