"""Quality classifier: a factorisation machine over hashed words, structure statistics and text metadata.

score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j). The pairwise sum is never written out: it is
half of the sum over factors of (sum v x)^2 - sum (v x)^2, linear in the number of features. Features are the hashed
words (log counts, scaled to length 1) and one indicator per statistic for the bin its value falls in: lengths, shares
of character kinds, repeated lines and windows, distinct words. Training runs in one task on at most `most` labelled
rows, in an order fixed by the ids, with AdaGrad steps; the parameters have a fixed size and are broadcast.

Defined cases: null and empty texts have the statistics of an empty text; without training rows every score is 0.5;
repeated rows are scored one by one; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackloom.llm.common import column_bytes, hashed_words, labelled_sample, mix, ship, slices, texts

BITS = 16
FACTORS = 8
#: rows of the training sample at most
MOST = 16_000
_BINS = 24
_FIXED = 1_024  # coordinates before the hashed words

_KIND = np.zeros((8, 256))
_KIND[0, 65:91] = 1  # upper case
_KIND[1, 97:123] = 1  # lower case
_KIND[2, 48:58] = 1  # digits
_KIND[3, [35, 42, 36, 37, 38, 124, 60, 62]] = 1  # symbols
_KIND[4, [33, 63]] = 1  # exclamation
_KIND[5, [44, 46, 58, 59]] = 1  # punctuation
_KIND[6, [32, *range(9, 14)]] = 1  # white space
_KIND[7, [40, 41, 47, 61, 64, 91, 93, 95, 123, 125]] = 1  # code and address marks


def _share_bin(x: float) -> int:
    """0 for 0, then finer near 0: bins of the square root."""
    return 0 if x <= 0 else min(_BINS - 1, 1 + int(np.sqrt(min(x, 1.0)) * (_BINS - 2)))


def _log_bin(x: float) -> int:
    return min(_BINS - 1, int(2 * np.log2(1 + x) / 1.5))


def statistics(text: bytes, words: np.ndarray) -> list[int]:
    """The coordinates of a text's statistics: number of the statistic times _BINS plus the bin of its value."""
    n = max(1, len(text))
    counts = _KIND @ np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [ln for ln in text.split(b"\n") if ln.strip()]
    windows = words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(5) + words[2:] if len(words) > 2 else words
    bins = [_share_bin(c / n) for c in counts]
    bins += [
        _log_bin(len(words)),
        _log_bin(len(text)),
        _log_bin(len(lines)),
        min(_BINS - 1, int(2 * len(text) / max(1, len(words)) / 1.5)),
        _log_bin(len(words) / max(1, len(lines))),
        _share_bin(1 - len(set(lines)) / max(1, len(lines))),
        _share_bin(1 - len(np.unique(windows)) / max(1, len(windows))),
        _share_bin(len(np.unique(words)) / max(1, len(words))),
    ]
    return [k * _BINS + b for k, b in enumerate(bins)]


def features(docs: list[bytes], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(coordinates, values) per text."""
    words, edges, _ = hashed_words([d.lower() for d in docs])
    out = []
    for text, a, b in zip(docs, edges, edges[1:]):
        at, n = np.unique((words[a:b] >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
        x = np.log1p(n)
        x /= max(1e-9, np.sqrt((x * x).sum()))
        fixed = statistics(text, words[a:b])
        out.append(
            (np.concatenate([fixed, at + _FIXED]).astype(np.uint32), np.concatenate([np.full(len(fixed), 0.5), x]))
        )
    return out


class Machine:
    """Parameters of the machine and its score."""

    def __init__(self, bits: int = BITS, factors: int = FACTORS):
        self.bits = bits
        size = _FIXED + (1 << bits)
        # fixed small starting factors, from a hash of their place
        h = mix(np.arange(size * factors, dtype=np.uint64) + np.uint64(42))
        self.v = ((h >> np.uint64(11)).astype(float) / 2**53 - 0.5).reshape(size, factors) * 0.1
        self.w, self.w0, self.fitted = np.zeros(size), 0.0, False

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[at] * x[:, None]
        s = vx.sum(axis=0)
        return self.w0 + self.w[at] @ x + 0.5 * float(s @ s - (vx * vx).sum())

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 3, rate: float = 0.08, l2: float = 1e-5):
        gw, gv, g0 = np.full(len(self.w), 1e-2), np.full(self.v.shape, 1e-2), 1e-2
        for _ in range(epochs):
            for (at, x), target in zip(rows, y):
                vx = self.v[at] * x[:, None]
                s = vx.sum(axis=0)
                raw = self.w0 + self.w[at] @ x + 0.5 * float(s @ s - (vx * vx).sum())
                g = 1 / (1 + np.exp(-np.clip(raw, -35, 35))) - target
                dw = g * x + l2 * self.w[at]
                dv = g * x[:, None] * (s - vx) + l2 * self.v[at]
                g0 += g * g
                gw[at] += dw * dw
                gv[at] += dv * dv
                self.w0 -= rate * g / np.sqrt(g0)
                self.w[at] -= rate * dw / np.sqrt(gw[at])
                self.v[at] -= rate * dv / np.sqrt(gv[at])
        self.fitted = True
        return self

    def scores(self, docs: list[bytes]) -> np.ndarray:
        if not self.fitted:
            return np.full(len(docs), 0.5)
        raw = np.array([self.raw(at, x) for at, x in features(docs, self.bits)])
        return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", bits: int = BITS,
    most: int = MOST,
) -> Machine:
    """Fit on at most `most` of the rows of `labels`."""
    ship(docs.sparkSession)
    sample = labelled_sample(docs.select(key, text), labels, key, label, most)

    def extract(batches):
        for batch in slices(batches, text):
            got = features(texts(batch, text), bits)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([a.tobytes() for a, _ in got], pa.binary()),
                    pa.array([x.astype(np.float32).tobytes() for _, x in got], pa.binary()),
                ],
                ["tie", "label", "at", "x"],
            )

    def fit(batches):
        rows, y = [], []
        for batch in batches:
            rows += [
                (np.frombuffer(a.as_buffer(), np.uint32), np.frombuffer(x.as_buffer(), np.float32))
                for a, x in zip(column_bytes(batch, "at"), column_bytes(batch, "x"))
            ]
            y.append(batch.column(1).to_numpy())
        if rows:
            m = Machine(bits).fit(rows, np.concatenate(y))
            yield pa.RecordBatch.from_arrays(
                [pa.array([m.w.astype(np.float32).tobytes()], pa.binary()), pa.array([m.v.astype(np.float32).tobytes()], pa.binary()), pa.array([m.w0])],
                ["w", "v", "w0"],
            )

    rows = sample.selectExpr(f"xxhash64(`{key}`) as tie", "_label as label", f"`{text}`")
    rows = rows.mapInArrow(extract, "tie long, label double, at binary, x binary")
    rows = rows.repartition(1).sortWithinPartitions("tie", "label", "at")
    got = rows.mapInArrow(fit, "w binary, v binary, w0 double").collect()
    m = Machine(bits)
    if got:
        m.w = np.frombuffer(got[0]["w"], np.float32)
        m.v = np.frombuffer(got[0]["v"], np.float32).reshape(m.v.shape)
        m.w0, m.fitted = got[0]["w0"], True
    return m
