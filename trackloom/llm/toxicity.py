"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the presence of its words, word pairs, pairs with one word between, and the stems of its words
(their first bytes, for coined and inflected forms), hashed to 2**bits coordinates. FTRL-proximal gives every coordinate a learning rate of its own, and its L1 term keeps coordinates at
exactly zero until their gradients add up, so that the weights are a short list. Training runs in one task on a sample
of at most `most` labelled rows, in an order fixed by the ids; only the non-zero weights come back and are broadcast.

Defined cases: null and empty texts have the bias alone; without training rows every score is 0.5; upper and lower
case are one; repeated rows are scored one by one; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackloom.llm.common import column_bytes, hashed_words, labelled_sample, mix, ship, slices, texts

BITS = 22
#: bytes of the stems
STEMS = (4, 5)
#: rows of the training sample at most
MOST = 16_000
_EDGE = b".,;:!?\"'()[]"
_DROP = bytes.maketrans(_EDGE, b" " * len(_EDGE))


def features(docs: list[bytes], bits: int) -> list[np.ndarray]:
    """The distinct coordinates of each text, sorted."""
    low = [d.lower().translate(_DROP) for d in docs]
    words, edges, _ = hashed_words(low)
    shift = np.uint64(64 - bits)
    one = words >> shift
    two = mix(words[:-1] * np.uint64(3) + words[1:]) >> shift if len(words) > 1 else words[:0]
    skip = mix(words[:-2] * np.uint64(5) + words[2:]) >> shift if len(words) > 2 else words[:0]
    stems = [mix(hashed_words(low, n)[0] + np.uint64(n)) >> shift for n in STEMS]
    return [
        np.unique(np.concatenate([one[a:b], *(t[a:b] for t in stems), two[a : max(a, b - 1)], skip[a : max(a, b - 2)]])).astype(np.uint32)
        for a, b in zip(edges, edges[1:])
    ]


def ftrl(
    rows: list[np.ndarray], y: np.ndarray, bits: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 4.0, l2: float = 1.0,
    epochs: int = 5,
) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates with a weight, their weights, bias) after `epochs` passes in the given order."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias = bias_n = 0.0

    def weights(at):
        zz = z[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for at, target in zip(rows, y):
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = p - target
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
            bias_n += g * g
            bias -= alpha * g / (beta + np.sqrt(bias_n))
    every = np.flatnonzero(np.abs(z) > l1)
    return every.astype(np.uint32), weights(every), bias


class Model:
    def __init__(self, at: np.ndarray, w: np.ndarray, bias: float, bits: int):
        self.at, self.w, self.bias, self.bits = at, w, bias, bits

    def scores(self, docs: list[bytes]) -> np.ndarray:
        dense = self.__dict__.get("dense")
        if dense is None:
            dense = self.dense = np.zeros(1 << self.bits)
            dense[self.at] = self.w
        total = np.array([dense[f].sum() for f in features(docs, self.bits)]) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "dense"}


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", bits: int = BITS,
    most: int = MOST,
) -> Model:
    """Fit on at most `most` of the rows of `labels`."""
    ship(docs.sparkSession)
    sample = labelled_sample(docs.select(key, text), labels, key, label, most)

    def extract(batches):
        for batch in slices(batches, text):
            rows = [f.tobytes() for f in features(texts(batch, text), bits)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["tie", "label", "at"])

    def fit(batches):
        rows, y = [], []
        for batch in batches:
            rows += [np.frombuffer(b.as_buffer(), np.uint32) for b in column_bytes(batch, "at")]
            y.append(batch.column(1).to_numpy())
        if rows:
            at, w, bias = ftrl(rows, np.concatenate(y), bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([at.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary()), pa.array([bias])], ["at", "w", "bias"]
            )

    rows = sample.selectExpr(f"xxhash64(`{key}`) as tie", "_label as label", f"`{text}`")
    rows = rows.mapInArrow(extract, "tie long, label double, at binary").repartition(1).sortWithinPartitions("tie", "label", "at")
    got = rows.mapInArrow(fit, "at binary, w binary, bias double").collect()
    if not got:
        return Model(np.zeros(0, np.uint32), np.zeros(0), 0.0, bits)
    return Model(np.frombuffer(got[0]["at"], np.uint32), np.frombuffer(got[0]["w"], float), got[0]["bias"], bits)


def score(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score DOUBLE) of every row; `model` has scores(texts)."""
    spark = docs.sparkSession
    ship(spark)
    share = spark.sparkContext.broadcast(model)
    docs = docs.select(key, text)

    def run(batches):
        for batch in slices(batches, text):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(share.value.scores(texts(batch, text)))], [key, "score"])

    return docs.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double")
