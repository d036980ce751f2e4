"""Language of a document: a bidirectional gated recurrent network over its bytes.

Two gated recurrent layers read the bytes forwards and backwards; at every position their states
give a distribution over the languages, and a document's probabilities are the mean over all its
positions. The network is written in numpy and trained by backpropagation through time on stretches of
a bounded sample of documents. A text is read whole: it is laid out in stretches of ``STRETCH``
bytes, each with ``LEAD`` bytes of its surroundings on either side to fill the states, and all
stretches of a batch move through the network together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.common import free_name, held_out, prepare, ship, utf8

UNKNOWN = "und"
STATES = 8  # of each direction
STRETCH = 112
LEAD = 8
TOGETHER = 2048  # stretches that are computed at once
MAX_ROWS = 4_000  # documents that are fitted; the sample is drawn by a hash of the id
TRAIN_BYTES = 64  # length of a training stretch
TRAIN_STEPS = 300
TRAIN_BATCH = 128
# Bytes without a say: ASCII other than letters is one symbol, capitals are small letters.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass
class Network:
    """Weights: input table, recurrent matrices and biases per direction; output layer; labels."""

    labels: list[str]
    table: np.ndarray  # (2, 256, 3 * STATES): what a byte adds to update gate, reset gate, candidate
    gates: np.ndarray  # (2, STATES, 2 * STATES)
    candidate: np.ndarray  # (2, STATES, STATES)
    out: np.ndarray  # (2 * STATES, labels)
    bias: np.ndarray


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def run_layer(table, gates, candidate, codes, keep=None):
    """States (time, batch, STATES) of one direction over codes (time, batch).

    With ``keep`` (a list) it notes what backpropagation needs.
    """
    size = candidate.shape[0]
    h = np.zeros((codes.shape[1], size), table.dtype)
    states = np.empty((codes.shape[0], codes.shape[1], size), table.dtype)
    for t in range(codes.shape[0]):
        x = table[codes[t]]
        both = _sigmoid(x[:, : 2 * size] + h @ gates)
        z, r = both[:, :size], both[:, size:]
        rh = r * h
        c = np.tanh(x[:, 2 * size :] + rh @ candidate)
        new = h + z * (c - h)
        if keep is not None:
            keep.append((h, z, r, rh, c))
        states[t] = h = new
    return states


def back_layer(gates, candidate, codes, kept, slope, n_bytes=256):
    """Gradients of table, gates and candidate from the slope of the loss on every state."""
    size = candidate.shape[0]
    d_table = np.zeros((n_bytes, 3 * size))
    d_gates, d_candidate = np.zeros_like(gates), np.zeros_like(candidate)
    carried = np.zeros_like(slope[0])
    for t in range(len(kept) - 1, -1, -1):
        h, z, r, rh, c = kept[t]
        d = slope[t] + carried
        d_c = d * z * (1 - c * c)
        d_rh = d_c @ candidate.T
        d_candidate += rh.T @ d_c
        d_z = d * (c - h) * z * (1 - z)
        d_r = d_rh * h * r * (1 - r)
        d_both = np.hstack([d_z, d_r])
        d_gates += h.T @ d_both
        carried = d * (1 - z) + d_rh * r + d_both @ gates.T
        np.add.at(d_table, codes[t], np.hstack([d_both, d_c]))
    return d_table, d_gates, d_candidate


def _softmax(x):
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def loss_and_slopes(params: dict, codes: np.ndarray, labels: np.ndarray):
    """Mean cross-entropy over all positions and documents, and its gradient by parameter."""
    kept = ([], [])
    forward = run_layer(params["table"][0], params["gates"][0], params["candidate"][0], codes, kept[0])
    backward = run_layer(params["table"][1], params["gates"][1], params["candidate"][1], codes[::-1], kept[1])[::-1]
    states = np.concatenate([forward, backward], axis=2)
    p = _softmax(states @ params["out"] + params["bias"])
    n = codes.size
    picked = np.take_along_axis(p, labels[None, :, None].repeat(len(codes), 0), 2)
    d = p.copy()
    np.put_along_axis(d, labels[None, :, None].repeat(len(codes), 0), picked - 1, 2)
    d /= n
    slopes = {"out": np.tensordot(states, d, ((0, 1), (0, 1))), "bias": d.sum(axis=(0, 1))}
    d_states = d @ params["out"].T
    size = params["candidate"].shape[1]
    one = back_layer(params["gates"][0], params["candidate"][0], codes, kept[0], d_states[:, :, :size])
    two = back_layer(params["gates"][1], params["candidate"][1], codes[::-1], kept[1], d_states[::-1, :, size:])
    for name, a, b in zip(("table", "gates", "candidate"), one, two):
        slopes[name] = np.stack([a, b])
    return float(-np.log(picked + 1e-30).mean()), slopes


def fit(texts: list[bytes], labels: list[str], steps: int = TRAIN_STEPS, seed: int = 11) -> Network:
    """Train on random stretches of the texts, each language as often as the others (Adam)."""
    names = sorted(set(labels))
    draw = np.random.default_rng(seed)
    by_label = [[t.translate(FOLD) for t, x in zip(texts, labels) if x == name] for name in names]
    params = {
        "table": draw.normal(0, 0.3, (2, 256, 3 * STATES)), "gates": draw.normal(0, 0.3, (2, STATES, 2 * STATES)),
        "candidate": draw.normal(0, 0.3, (2, STATES, STATES)), "out": draw.normal(0, 0.3, (2 * STATES, len(names))),
        "bias": np.zeros(len(names))}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    for step in range(1, steps + 1):
        chosen = draw.integers(0, len(names), TRAIN_BATCH)
        codes = np.full((TRAIN_BATCH, TRAIN_BYTES), 32, np.uint8)
        for row, label in enumerate(chosen):
            text = by_label[label][draw.integers(len(by_label[label]))]
            at = int(draw.integers(max(1, len(text) - TRAIN_BYTES + 1)))
            part = np.frombuffer(text[at : at + TRAIN_BYTES], np.uint8)
            codes[row, : len(part)] = part
        _, slopes = loss_and_slopes(params, codes.T, chosen)
        rate = 0.02 if step < 0.7 * steps else 0.005
        for k, slope in slopes.items():
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope**2
            params[k] = params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    params["table"][:, 0, :STATES] = -40  # what fills up the last stretch of a text leaves the state as it is
    params["table"][:, 1] = params["table"][:, 32]  # the blanks after a text are no positions of it
    return Network(names, **{k: v.astype(np.float32) for k, v in params.items()})


def train(docs: DataFrame, max_rows: int = MAX_ROWS, steps: int = TRAIN_STEPS) -> Network:
    """Fit on documents with text and language that are not held out.

    At most ``max_rows`` documents are fitted, the same number of each language (at least one), chosen by
    a hash of id and text, so a rare language is learned at every size; copies of a text count once.
    Of each, one stretch of the network's training length per thousand bytes (at most 16) travels to
    the driver, drawn by a hash too. Without any such document the network knows no language.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != "") & ~held_out())
    texts = usable.groupBy("lang", F.xxhash64("text").alias("print")).agg(F.min("doc_id").alias("doc_id"))
    share = max(1, max_rows // max(1, usable.agg(F.count_distinct("lang")).first()[0]))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "print")
    chosen = texts.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= share).drop("place")
    size = F.octet_length("text")
    body = F.col("text")
    pieces = F.transform(
        F.sequence(F.lit(0), F.least(F.lit(15), F.floor(size / 1000).cast("int"))),
        lambda i: F.substring(body, 1 + F.pmod(F.xxhash64("doc_id", i), F.greatest(F.lit(1), F.length(body) - TRAIN_BYTES)).cast("int"), F.lit(2 * TRAIN_BYTES)))
    rows = (
        docs.select("doc_id", "lang", F.xxhash64("text").alias("print"), pieces.alias("pieces"))
        .join(F.broadcast(chosen), ["doc_id", "lang", "print"])  # max_rows ids
        .dropDuplicates(["doc_id", "lang", "print"]).select("lang", "pieces").collect())
    texts = sorted((r["lang"], p) for r in rows for p in r["pieces"] if p)
    if not texts:
        return Network([], *(np.zeros(s, np.float32) for s in ((2, 256, 3 * STATES), (2, STATES, 2 * STATES), (2, STATES, STATES), (2 * STATES, 0), (0,))))
    return fit([p.encode() for _, p in texts], [x for x, _ in texts], steps)


def probabilities(texts: list[bytes], net: Network) -> np.ndarray:
    """Mean distribution over the positions of each text (no positions: zeros)."""
    owner, parts, totals = [], [], np.zeros((len(texts), len(net.labels)))
    width = LEAD + STRETCH + LEAD
    # States lie within -1 and 1, so this bounds what goes into exp; only above it must the maximum come off.
    steep = float((np.abs(net.out).sum(axis=0) + np.abs(net.bias)).max(initial=0)) > 80

    def flush():
        codes = np.frombuffer(b"".join(parts), np.uint8).reshape(len(parts), width).T
        states = run_layer(net.table[0], net.gates[0], net.candidate[0], codes[: LEAD + STRETCH])[LEAD:]
        back = run_layer(net.table[1], net.gates[1], net.candidate[1], codes[: LEAD - 1 : -1])[::-1][:STRETCH]
        p = states @ net.out[:STATES] + back @ net.out[STATES:] + net.bias
        p = np.exp(p - p.max(axis=2, keepdims=True) if steep else p)
        p *= (codes[LEAD : LEAD + STRETCH] > 1)[:, :, None]
        p /= p.sum(axis=2, keepdims=True) + np.float32(1e-30)
        np.add.at(totals, np.array(owner), p.sum(axis=0, dtype=np.float64))
        owner.clear()
        parts.clear()

    lead, tail = b" " * LEAD, b"\1" * LEAD
    for i, text in enumerate(texts):
        n = len(text)
        padded = lead + text.translate(FOLD) + tail
        for at in range(0, n, STRETCH):
            part = padded[at : at + width]
            parts.append(part.ljust(width, b"\0"))
            owner.append(i)
            if len(parts) == TOGETHER:
                flush()
    if parts:
        flush()
    return totals / np.maximum(totals.sum(axis=1, keepdims=True), 1e-30)


def predict(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the pooled probability of that language.

    A null text and one without any letter is ``und`` with score 0, as is every text if the network
    knows no language; of equal probabilities the first language by name counts. Repeated rows
    come out alike; other columns stay, save that columns named like results are replaced.
    """
    spark = prepare(docs.sparkSession)
    shared = ship(spark, net)  # a few thousand weights

    @F.pandas_udf("lang_pred string, score double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        net = shared()
        for batch in batches:
            texts = [t or b"" for t in batch]
            if not net.labels:
                yield pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)})
                continue
            p = probabilities(texts, net)
            best = p.argmax(axis=1)
            yield pd.DataFrame({"lang_pred": [net.labels[b] for b in best], "score": p[np.arange(len(p)), best]})

    work = free_name(docs, "_spoken")
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    out = docs.withColumn(work, classify(utf8(text)))
    pred = F.when(letters, F.col(f"{work}.lang_pred")).otherwise(UNKNOWN)
    score = F.when(letters, F.col(f"{work}.score")).otherwise(0.0)
    out = out.withColumn(f"{work}_p", pred).withColumn(f"{work}_s", score)
    return out.withColumn("lang_pred", F.col(f"{work}_p")).withColumn("score", F.col(f"{work}_s")).drop(work, f"{work}_p", f"{work}_s")
