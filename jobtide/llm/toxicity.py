"""Toxicity by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary texts, predict each expression after its
predecessor: from the pair of expressions they back off to the expression, by the number of
predecessors it follows, and from there to counts that both classes share. Counts of pairs are
numbers of texts. Absolute discounts, from the numbers of small counts, say how much of a count goes
down an order; for pairs they are taken from the counts of both classes together, so that a context
backs off alike in both. Each model is a distribution after every context. What rare expressions say
by chance is held down: shared counts stand against those of a class, and small differences are
nothing. How much, and how the mean difference is read, is chosen by texts held back from learning.

An expression is a whole word, or one character of a script without spaces between words.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import (
    MIX, GramTable, arrow_column, arrow_texts, byte_view, learning_rows, logistic_fit,
    mix64, release, sigmoid, steps, word_hashes,
)
from jobtide.llm.near_dup import shingle_sets

EVEN = (1.0, 2.0, 4.0, 8.0)  # counts of the shared distribution that stand against those of a class
BANDS = (0.5, 0.75, 1.0, 1.25, 1.5)  # differences that count as chance
POWERS = (1.0, 0.5)
STEP = 256 << 10
PER_CLASS, CLASS_BYTES = 2500, 8 << 20


def not_letters() -> np.ndarray:
    """Bytes that part words: all of ASCII but its letters."""
    out = np.zeros(256, bool)
    out[:128] = True
    out[97:123] = False
    return out


GAP = not_letters()

# (first byte, second bytes, third bytes or none for any) in UTF-8: signs that part words
SIGNS = [
    (0xC2, (0x80, 0xBF), None),  # Latin-1
    (0xE2, (0x80, 0x81), (0x80, 0xBF)),  # quotes, dashes, wide spaces
    (0xE3, (0x80, 0x80), (0x80, 0x84)), (0xE3, (0x80, 0x80), (0x88, 0xBF)),  # Chinese and Japanese
    (0xEF, (0xBC, 0xBC), (0x80, 0xA0)), (0xEF, (0xBD, 0xBD), (0x9B, 0xA5)),  # full width
]
# (first bytes, second bytes, length): characters that are expressions of their own
ALONE = [
    ((0xE0, 0xE0), (0xB8, 0xBB), 3), ((0xE1, 0xE1), (0x80, 0x82), 3),  # Thai, Lao, Myanmar
    ((0xE1, 0xE1), (0x9E, 0x9F), 3),  # Khmer
    ((0xE3, 0xE3), (0x80, 0x83), 3), ((0xE3, 0xE3), (0x90, 0xBF), 3),  # kana, Han
    ((0xE4, 0xE9), (0x80, 0xBF), 3), ((0xF0, 0xF0), (0xA0, 0xBF), 4),
]


def _split(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with signs beyond ASCII made spaces, and where a word begins without a gap."""
    out, cut = part.copy(), np.zeros(len(part), bool)
    at = np.flatnonzero(part >= 0xC2)
    at = at[at + 3 < len(part) + (part[at] < 0xF0) + (part[at] < 0xE0)]
    lead, second = part[at], part[at + 1]
    for first, (a, b), third in SIGNS:
        place = at[(lead == first) & (second >= a) & (second <= b)]
        if third is not None:
            place = place[(part[place + 2] >= third[0]) & (part[place + 2] <= third[1])]
            out[place + 2] = 32
        out[place] = out[place + 1] = 32
    for (a, b), (low, high), size in ALONE:
        place = at[(lead >= a) & (lead <= b) & (second >= low) & (second <= high)]
        cut[place] = True
        cut[place[place + size < len(part)] + size] = True
    return out, cut


def events(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash of the pair with its predecessor, hash, and text of each expression, and the hash of
    its predecessor (0 for the first of a text). The bytes are those of lower-cased texts."""
    base = offsets[0]
    part, cut = _split(flat[base:offsets[-1]])
    words, texts, _, _ = word_hashes(part, offsets - base, GAP, cut)
    before = np.zeros_like(words)
    before[1:] = np.where(texts[1:] == texts[:-1], words[:-1], np.uint64(0))
    return mix64(before * np.uint64(3) + words * MIX), words, texts, before


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return byte_view(pc.utf8_lower(texts))


def _once(names: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """A place of each name in each text: a count is a number of texts, so that one text that
    repeats an expression is no evidence."""
    order = np.lexsort((names, texts))
    names, texts = names[order], texts[order]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (texts[1:] != texts[:-1])
    return order[new]


@dataclass
class Counts:
    """Counts of a class: pairs by texts, with their words and contexts, and texts by word."""

    pairs: np.ndarray
    n: np.ndarray
    words: np.ndarray
    before: np.ndarray
    by_text: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Counts:
        flat, offsets = lowered(arrow_texts(texts))
        found = []
        for a, b in steps(np.diff(offsets), STEP):
            pairs, words, rows, before = events(flat, offsets[a:b + 1])
            at = _once(pairs, rows)
            found.append((pairs[at], words[at], before[at], words[_once(words, rows)]))
        pairs, words, before, by_text = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        pairs, first, n = np.unique(pairs, return_index=True, return_counts=True)
        out = Counts(pairs, n.astype(np.int32), words[first], before[first], by_text)
        del words, before, first
        release()
        return out


def _sums(names: np.ndarray, keys: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(np.searchsorted(names, keys), weights, len(names)).astype(float)


def discounts(counts: np.ndarray) -> np.ndarray:
    """Absolute discounts of counts 0, 1, 2 and of more, from the numbers of counts 1 to 4. Where
    these say nothing, or that nothing of a count may stay, it keeps a quarter."""
    n = [max(int((counts == k).sum()), 0) for k in range(1, 5)]
    share = n[0] / max(n[0] + 2 * n[1], 1)
    out = [0.0]
    for k in range(1, 4):
        found = k - (k + 1) * share * n[k] / n[k - 1] if n[k - 1] and n[k] else 0.75
        out.append(min(max(found, 0.1), k - 0.25))
    return np.array(out)


def _eased(counts: np.ndarray, expected: np.ndarray, even: float, before: np.ndarray | float) -> np.ndarray:
    """How far counts are from what the shared counts make one expect, by a mean of what the class
    counts say, weighted by what is expected, and of what is known `before`, weighted by `even`."""
    return (counts + even * before) / (expected + even)


def _mass(counts: np.ndarray) -> np.ndarray:
    """What the discounts take from each count."""
    return discounts(counts)[np.minimum(counts, 3).astype(int)]


@dataclass
class Model:
    """Log-likelihood differences by pair and, where the sample doesn't hold a pair, by expression,
    beyond that of an expression that only the shared counts know. Differences up to `least` are
    nothing, larger ones less by it. The number of entries is bounded by the learning bytes."""

    by_pair: GramTable
    by_word: GramTable
    least: float = BANDS[0]
    power: float = 0.5
    share: float = 0.5
    weight: float = 1.0
    constant: float = 0.0

    def mean(self, texts: pa.Array) -> np.ndarray:
        """Mean difference per expression of each whole text; 0 for a text without any."""
        flat, offsets = lowered(texts)
        out = np.zeros(len(texts))
        for a, b in steps(np.diff(offsets), STEP):
            pairs, words, rows, _ = events(flat, offsets[a:b + 1])
            value, seen = self.by_pair.get(pairs)
            value = np.where(seen, value, self.by_word.get(words)[0])
            value = np.sign(value) * np.maximum(np.abs(value) - self.least, 0)
            out[a:b] = np.bincount(rows, value, b - a) / np.maximum(np.bincount(rows, minlength=b - a), 1)
        return out

    def difference(self, texts: pa.Array) -> np.ndarray:
        """The mean difference, to a power with its sign: a few expressions may be enough to make a
        text toxic, however many follow."""
        mean = self.mean(texts)
        return np.sign(mean) * np.abs(mean) ** self.power

    def score(self, texts: pa.Array) -> np.ndarray:
        """Of a text without any expression, the share of its class among the learning rows."""
        flat, offsets = lowered(texts)
        said = np.concatenate([np.bincount(events(flat, offsets[a:b + 1])[2], minlength=b - a) > 0 for a, b in steps(
            np.diff(offsets), STEP)] or [np.zeros(0, bool)])
        return np.where(said, sigmoid(self.weight * self.difference(texts) + self.constant), self.share)


@dataclass
class Sample:
    """Counts of both classes over the names that either has: expressions, contexts, pairs."""

    words: np.ndarray
    before: np.ndarray
    pairs: np.ndarray
    word_of: np.ndarray
    context_of: np.ndarray
    follows: list[np.ndarray]  # by class: predecessors of each expression, as far as it has as many texts
    texts: list[np.ndarray]  # by class: texts of each expression
    together: list[np.ndarray]  # by class: texts of each pair

    @staticmethod
    def of(toxic: list[str], plain: list[str]) -> Sample:
        classes = [Counts.of(toxic), Counts.of(plain)]
        words = np.unique(np.concatenate([c.words for c in classes]))
        before = np.unique(np.concatenate([c.before for c in classes]))
        texts = [_sums(words, c.by_text) for c in classes]
        follows = [np.minimum(_sums(words, c.words), t) for c, t in zip(classes, texts, strict=True)]
        word_of = [np.searchsorted(words, c.words).astype(np.int32) for c in classes]
        context_of = [np.searchsorted(before, c.before).astype(np.int32) for c in classes]
        counts = [(c.pairs, c.n) for c in classes]
        del classes
        release()
        pairs, first = np.unique(np.concatenate([x for x, _ in counts]), return_index=True)
        out = Sample(words, before, pairs, np.concatenate(word_of)[first], np.concatenate(context_of)[first],
                     follows, texts, [_sums(pairs, x, n).astype(np.float32) for x, n in counts])
        del first, counts, word_of, context_of
        release()
        return out

    def expressions(self, even: float) -> tuple[list[np.ndarray], list[float]]:
        """Probability by class of each expression, and of all that the sample lacks, as one. Where an
        expression has few predecessors, the number of its texts tells the classes apart."""
        shared, met = (np.append(sum(x), 1.0) / (sum(x).sum() + 1) for x in (self.follows, self.texts))
        out = []
        for follow, texts in zip(self.follows, self.texts, strict=True):
            taken = _mass(follow)
            left = np.append(follow - taken, 0.0) + taken.sum() * shared
            told = _eased(np.append(texts, 0.0), texts.sum() * met, even, 1.0)
            p = _eased(left, left.sum() * shared, even, told) * shared
            out.append(p / p.sum())
        return [p[:-1] for p in out], [float(p[-1]) for p in out]

    def given(self, even: float, known: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """Probability by class of each pair's expression after its context, and the back-off weight
        of each context: what the discounts take from the pairs of both classes together. So how
        often a class has a context tells nothing by itself, and a pair that is seldom met tells
        what its expression tells."""
        size, both = len(self.before), sum(self.together)
        total = np.bincount(self.context_of, both, size)
        back = np.bincount(self.context_of, _mass(both), size) / total
        shared = both / total.astype(np.float32)[self.context_of]
        alike = sum(self.follows) / (sum(f.sum() for f in self.follows) + 1)
        out = []
        for n, word in zip(self.together, known, strict=True):
            here = np.bincount(self.context_of, n, size).astype(np.float32)[self.context_of]
            own = _eased(n, here * shared, even, (word / alike).astype(np.float32)[self.word_of]) * shared
            own /= np.bincount(self.context_of, own, size).astype(np.float32)[self.context_of]
            weight = back.astype(np.float32)[self.context_of]
            out.append((1 - weight) * own + weight * word.astype(np.float32)[self.word_of])
            del own, here, weight
            release()
        return out, back


def _model(sample: Sample, even: float) -> Model:
    known, unknown = sample.expressions(even)
    pairs, _ = sample.given(even, known)
    nothing = float(np.log(unknown[0] / unknown[1]))
    told, pair = (np.log(x[0] / x[1]) - nothing for x in (known, pairs))
    # what is nothing in the narrowest band need not be known, nor a pair without its expression
    tells = np.abs(told) > BANDS[0]
    kept = (np.abs(pair) > BANDS[0]) | tells[sample.word_of]
    return Model(GramTable(sample.pairs[kept], pair[kept]), GramTable(sample.words[tells], told[tells]))


def _learn(toxic: list[str], plain: list[str], even: float = EVEN[0]) -> Model:
    return _model(Sample.of(toxic, plain), even)


def fit(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0,
    per_class: int = PER_CLASS, class_bytes: int = CLASS_BYTES,
) -> Model | None:
    """Learn from a bounded sample of rows that are not held out; None without both classes, and an
    error if a class has too few texts to learn from."""
    sample, sizes = learning_rows(docs, labels, "toxic", modulus, remainder, per_class, class_bytes)
    if len(sizes) < 2:
        return None
    return fit_texts(sample, sizes)


def _sides(texts: list[str]) -> np.ndarray:
    """Which texts, about a fourth, are held back to calibrate: by the least of their shingles, so that
    copies of a text, and mostly near copies, stay on one side."""
    flat, offsets = byte_view(arrow_texts(texts))
    out = np.zeros(len(texts), bool)
    for a, b in steps(np.diff(offsets), STEP):
        sets = shingle_sets(flat, offsets[a:b + 1])
        out[a:b] = [len(s) > 0 and int(mix64(mix64(s).min(keepdims=True))[0]) % 4 == 0 for s in sets]
    return out if 0 < out.sum() < len(out) else np.arange(len(texts)) % 4 == 0


def fit_texts(sample: dict[int, list[str]], sizes: dict[int, int]) -> Model:
    """About a fourth of the texts are not counted at first: how much the shared counts weigh, which
    differences are chance, how their mean is read, weight and constant are those that tell these
    texts best. With these settings the models learn from all texts. The constant carries the class
    sizes of all learning rows."""
    learn, check = {}, {}
    for y, x in sample.items():
        held = _sides(x)
        learn[y] = [t for t, h in zip(x, held) if not h]
        check[y] = [t for t, h in zip(x, held) if h]
    counted = Sample.of(learn[1], learn[0])
    texts = [arrow_texts(check[y]) for y in (0, 1)]
    y = np.repeat([0.0, 1.0], [len(check[0]), len(check[1])])
    best, lowest = (), np.inf
    model = None
    for even in EVEN:
        del model
        model = _model(counted, even)
        for model.least in BANDS:
            mean = np.concatenate([model.mean(t) for t in texts])
            for power in POWERS:
                x = np.sign(mean) * np.abs(mean) ** power
                weight, constant = logistic_fit(x[:, None], y)
                p = sigmoid(np.where(y == 1, 1, -1) * (weight * x + constant))
                if (loss := -np.log(p).mean()) < lowest:
                    best, lowest = (even, model.least, power, float(weight), float(constant)), loss
    del counted, model, texts
    release()
    even, least, power, weight, constant = best
    shift = float(np.log(sizes[1] / sizes[0]) - np.log(len(check[1]) / len(check[0])))
    out = _learn(sample[1], sample[0], even)
    out.least, out.power, out.weight, out.constant = least, power, weight, constant + shift
    out.share = sizes[1] / (sizes[0] + sizes[1])
    release()
    return out


def score(df: DataFrame, model: Model | None, text: str = "text", name: str = "toxicity") -> DataFrame:
    """Add the toxicity, 0 to 1, of the whole text of each row.

    A null or empty text, or one without words, gets the value of no evidence. Without a model
    (no labelled rows of both classes) every score is 0. A column of the same name is replaced.
    """
    if model is None:
        return df.withColumn(name, F.lit(0.0))
    sent = df.sparkSession.sparkContext.broadcast(model)
    return arrow_column(df, text, name, "double",
                        lambda: lambda texts: pa.array(sent.value.score(texts), pa.float64()))
