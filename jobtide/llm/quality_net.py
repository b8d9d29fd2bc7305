"""Quality by a byte-level convolutional network in numpy.

Each byte, together with a mark of whether the four bytes ending there stood a few bytes earlier,
is a symbol. Learned filters over short windows of symbols run over overlapping chunks that cover
the whole text; the largest response of each filter in a chunk is pooled, and the mean and the
largest of these over the chunks are combined into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import (
    arrow_column, arrow_texts, byte_view, learning_rows, logistic_fit, sigmoid, steps,
)

FILTERS, WIDTH = 12, 6
CHUNK = 1024
LAGS, AGAIN = range(2, 25), 4
STEP = 256 << 10
PER_CLASS, CLASS_BYTES = 1200, 3 << 20
EPOCHS, BATCH, RATE = 8, 24, 0.02


def symbols(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts side by side, each followed by WIDTH - 1 empty ones, and their offsets."""
    base, n = offsets[0], len(offsets) - 1
    part = flat[base:offsets[-1]]
    again = np.zeros(len(part), bool)
    for lag in LAGS:
        if len(part) <= lag + AGAIN:
            break
        run = part[lag:] == part[:-lag]
        four = run[AGAIN - 1:].copy()
        for k in range(AGAIN - 1):
            four &= run[k:len(run) - AGAIN + 1 + k]
        again[lag + AGAIN - 1:] |= four
    rows = np.repeat(np.arange(n), np.diff(offsets))
    inside = np.arange(len(part)) - (offsets[:-1] - base)[rows]
    again &= inside >= LAGS[-1] + AGAIN  # never across two texts
    ends = offsets - base + (WIDTH - 1) * np.arange(n + 1)
    out = np.zeros(ends[-1], np.int64)
    out[np.arange(len(part)) + (WIDTH - 1) * rows] = part + 256 * again
    return out, ends


def windows(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window of each chunk, the text of each chunk, and which windows lie in one text."""
    sizes = np.diff(ends) - (WIDTH - 1)
    chunks = -(-sizes // CHUNK)
    rows = np.repeat(np.arange(len(sizes)), chunks)
    number = np.arange(len(rows)) - (np.cumsum(chunks) - chunks)[rows]
    return ends[rows] + number * CHUNK, rows, np.minimum(CHUNK, sizes[rows] - number * CHUNK)


@dataclass
class Net:
    filters: np.ndarray  # WIDTH x 512 x FILTERS
    shift: np.ndarray
    weights: np.ndarray  # 2 * FILTERS
    constant: float
    scale: float = 1.0
    move: float = 0.0

    def respond(self, codes: np.ndarray) -> np.ndarray:
        size = len(codes) - WIDTH + 1
        out = np.take(self.filters[0], codes[:size], axis=0)
        for k in range(1, WIDTH):
            out += np.take(self.filters[k], codes[k:k + size], axis=0)
        return out

    def logits(self, texts: pa.Array) -> np.ndarray:
        flat, offsets = byte_view(texts)
        out = np.full(len(texts), float(self.constant))
        for a, b in steps(np.diff(offsets), STEP):
            codes, ends = symbols(flat, offsets[a:b + 1])
            starts, rows, _ = windows(ends)
            if not len(starts):
                continue
            # one more empty symbol, so that the end of the last chunk is a place, too; windows
            # that reach into the next text lie between the chunks
            response = self.respond(np.append(codes, 0))
            cuts = np.stack([starts, np.minimum(starts + CHUNK, ends[rows + 1] - WIDTH + 1)], 1).reshape(-1)
            pooled = np.maximum.reduceat(response, cuts, axis=0)[::2]
            pooled = np.maximum(pooled + self.shift, 0)
            out[a:b] += self._combine(pooled, rows, b - a) @ self.weights
        return out

    @staticmethod
    def _combine(pooled: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        counts = np.diff(np.append(first, len(rows)))[:, None]
        out = np.zeros((n, 2 * FILTERS))
        out[rows[first], :FILTERS] = np.add.reduceat(pooled, first, axis=0) / counts
        out[rows[first], FILTERS:] = np.maximum.reduceat(pooled, first, axis=0)
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.scale * self.logits(texts) + self.move)


class _Adam:
    def __init__(self, parts: list[np.ndarray]):
        self.parts, self.t = parts, 0
        self.m, self.v = ([np.zeros_like(p) for p in parts] for _ in range(2))

    def step(self, grads: list[np.ndarray], rate: float) -> None:
        self.t += 1
        for p, g, m, v in zip(self.parts, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)


def train(texts: list[str], labels: np.ndarray, seed: int = 5) -> Net:
    """Gradient steps of Adam; the gradient of a pooled response goes to the window that gave it."""
    random = np.random.default_rng(seed)
    filters = random.normal(0, 0.15, (WIDTH, 512, FILTERS)).astype(np.float32)
    shift, weights = np.zeros(FILTERS, np.float32), random.normal(0, 0.3, 2 * FILTERS).astype(np.float32)
    constant = np.zeros(1, np.float32)
    adam = _Adam([filters, shift, weights, constant])
    seen = [symbols(*byte_view(arrow_texts([t]))) for t in texts]
    steps_total, step = EPOCHS * -(-len(texts) // BATCH), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            rate = RATE * 0.5 * (1 + np.cos(np.pi * step / steps_total))
            step += 1
            batch = order[at:at + BATCH]
            net = Net(filters, shift, weights, float(constant[0]))
            grads = [np.zeros_like(p) for p in adam.parts]
            for i in batch.tolist():
                codes, ends = seen[i]
                starts, _, sizes = windows(ends)
                if not len(starts):
                    continue
                response = net.respond(codes)
                best = np.stack([response[s:s + n].argmax(0) + s for s, n in
                                 zip(starts.tolist(), sizes.tolist(), strict=True)])
                raw = np.take_along_axis(response, best, 0) + shift
                pooled = np.maximum(raw, 0)
                top = pooled.argmax(0)
                features = np.concatenate([pooled.mean(0), pooled[top, np.arange(FILTERS)]])
                error = float(sigmoid(features @ weights + constant[0]) - labels[i]) / len(batch)
                grads[2] += error * features
                grads[3] += error
                back = np.broadcast_to(error * weights[:FILTERS] / len(starts), pooled.shape).copy()
                back[top, np.arange(FILTERS)] += error * weights[FILTERS:]
                back *= raw > 0
                grads[1] += back.sum(0)
                column = np.broadcast_to(np.arange(FILTERS), best.shape)
                for k in range(WIDTH):
                    np.add.at(grads[0][k], (codes[best + k], column), back)
            grads[0] += 1e-4 * filters
            adam.step(grads, rate)
    return Net(filters, shift, weights, float(constant[0]))


def fit_texts(sample: dict[int, list[str]], sizes: dict[int, int]) -> Net:
    """Every fourth text calibrates the logits and is not trained on; the constant carries the
    class sizes of all learning rows."""
    learn = {y: [t for i, t in enumerate(x) if i % 4] for y, x in sample.items()}
    check = {y: x[::4] for y, x in sample.items()}
    net = train(learn[0] + learn[1], np.repeat([0.0, 1.0], [len(learn[0]), len(learn[1])]))
    x = np.concatenate([net.logits(arrow_texts(check[y])) for y in (0, 1)])
    y = np.repeat([0.0, 1.0], [len(check[0]), len(check[1])])
    net.scale, net.move = (float(v) for v in logistic_fit(x[:, None], y))
    net.move += float(np.log(sizes[1] / sizes[0]) - np.log(len(check[1]) / len(check[0])))
    return net


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0,
        per_class: int = PER_CLASS, class_bytes: int = CLASS_BYTES) -> Net | None:
    """Learn from a bounded sample of rows that are not held out; None without both classes, and an
    error if a class has too few texts to learn from."""
    sample, sizes = learning_rows(docs, labels, "quality", modulus, remainder, per_class, class_bytes)
    if len(sizes) < 2:
        return None
    return fit_texts(sample, sizes)


def score(df: DataFrame, net: Net | None, text: str = "text", name: str = "quality") -> DataFrame:
    """Add the probability that the whole text of each row is of quality. A null or empty text
    has no response and gets that of the constant alone; without a net every score is 0. A column
    of the same name is replaced."""
    if net is None:
        return df.withColumn(name, F.lit(0.0))
    sent = df.sparkSession.sparkContext.broadcast(net)
    return arrow_column(df, text, name, "double",
                        lambda: lambda texts: pa.array(sent.value.score(texts), pa.float64()))
