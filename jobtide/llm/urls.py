"""URL filter: rules by host and path, and a character language-model ratio for the rest.

Two byte models of variable order, one of accepted and one of rejected URLs, are smoothed from
order to order by the Witten-Bell rule. A URL that no rule fits is allowed if the calibrated mean
log-likelihood difference per byte is in favour of the accepted ones. The rules' own verdicts are
what the models learn from.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import (
    GramTable, arrow_column, arrow_texts, byte_view, logistic_fit, lower_ascii, sigmoid, steps,
)

ORDER = 6
PER_CLASS, CLASS_BYTES = 20_000, 4 << 20

Rule = tuple[str, str, str]  # allow or block, host, path


def rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return verdict, host.lower(), slash + path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ://."""
    cut = F.instr(url, "://")
    tail = F.when(cut > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    raw = F.regexp_extract(tail, "^[^/?#]*", 0)
    path = F.regexp_extract(tail, "^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), path


def with_rules(df: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Add host, path, rule (null if none fits) and rule_verdict.

    A rule fits its host and all subdomains where the path starts with the rule's. The longest
    rule wins, among equally long ones that with the longer host, then the first in text order.
    """
    df = df.withColumn("_url", F.coalesce(F.col(url), F.lit("")))
    host, path = host_and_path(F.col("_url"))
    df = df.withColumns({"host": host, "path": path}).drop("_url")
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1] + r[2], r[0]))
    chosen = verdict = None
    for kind, at, start in ranked:
        fits = ((F.col("host") == at) | F.endswith(F.col("host"), F.lit("." + at))) & F.startswith(
            F.col("path"), F.lit(start))
        chosen = (F if chosen is None else chosen).when(fits, F.lit(at + start))
        verdict = (F if verdict is None else verdict).when(fits, F.lit(kind))
    none = F.lit(None).cast("string")
    return df.withColumns({"rule": none if chosen is None else chosen,
                           "rule_verdict": none if verdict is None else verdict})


def grams(flat: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed last `order` bytes at each byte (0 before the start of its URL), and its URL."""
    base = offsets[0]
    part = lower_ascii(flat[base:offsets[-1]]).astype(np.uint64)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = np.arange(len(part)) - (offsets[:-1] - base)[rows]
    key = np.zeros(len(part), np.uint64)
    for k in range(order - 1, -1, -1):
        before = np.zeros(len(part), np.uint64)
        before[k:] = part[:len(part) - k]
        key = (key << np.uint64(8)) | np.where(inside >= k, before, np.uint64(0))
    return key, rows


def _tail(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.uint64((1 << 8 * order) - 1)


def _find(keys: np.ndarray, values: np.ndarray, ask: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(ask))
    at = np.minimum(np.searchsorted(keys, ask), len(keys) - 1)
    return np.where(keys[at] == ask, values[at], 0).astype(float)


class _Markov:
    """Counts of one class for every order up to ORDER."""

    def __init__(self, keys: np.ndarray):
        self.levels = []
        for n in range(1, ORDER + 1):
            g, c = np.unique(_tail(keys, n), return_counts=True)
            context, first = np.unique(g >> np.uint64(8), return_index=True)
            total = np.add.reduceat(c, first) if len(first) else c
            self.levels.append((g, c, context, total, np.diff(np.append(first, len(g)))))

    def logs(self, n: int, ask: np.ndarray) -> np.ndarray:
        """Log probability of the last byte of n-grams."""
        p = np.full(len(ask), 1 / 256)
        for k in range(1, n + 1):
            g, c, context, total, kinds = self.levels[k - 1]
            part = _tail(ask, k)
            t, d = (_find(context, x, part >> np.uint64(8)) for x in (total, kinds))
            p = np.where(t > 0, (_find(g, c, part) + d * p) / np.maximum(t + d, 1), p)
        return np.log(p)

    def backed(self, n: int, contexts: np.ndarray) -> np.ndarray:
        """Log of the weight that contexts of n-grams leave to the shorter ones."""
        _, _, context, total, kinds = self.levels[n - 1]
        t, d = (_find(context, x, contexts) for x in (total, kinds))
        return np.log(np.where(t > 0, d / np.maximum(t + d, 1), 1))


@dataclass
class Model:
    """Differences by n-gram of each order, and of back-off weights by context; the number of
    entries is bounded by the learning bytes."""

    by_gram: list[GramTable]
    by_context: list[GramTable]
    weight: float = 1.0
    constant: float = 0.0

    def difference(self, urls: pa.Array) -> np.ndarray:
        """Mean log-likelihood difference per byte: at each byte that of the longest n-gram that
        is known, after the back-off weights of the longer ones. 0 for an empty URL."""
        flat, offsets = byte_view(urls)
        out = np.zeros(len(urls))
        for a, b in steps(np.diff(offsets)):
            keys, rows = grams(flat, offsets[a:b + 1], ORDER)
            value, todo = np.zeros(len(keys)), np.arange(len(keys))
            for n in range(ORDER, 0, -1):
                ask = _tail(keys[todo], n)
                found, known = self.by_gram[n - 1].get(ask)
                value[todo[known]] += found[known]
                todo = todo[~known]
                value[todo] += self.by_context[n - 1].get(ask[~known] >> np.uint64(8))[0]
            out[a:b] = np.bincount(rows, value, b - a) / np.maximum(np.bincount(rows, minlength=b - a), 1)
        return out

    def score(self, urls: pa.Array) -> np.ndarray:
        return sigmoid(self.weight * self.difference(urls) + self.constant)


def _learn(accepted: list[str], rejected: list[str]) -> Model:
    models, keys = [], []
    for urls in (accepted, rejected):
        key = grams(*byte_view(arrow_texts(urls)), ORDER)[0]
        models.append(_Markov(key))
        keys.append(key)
    by_gram, by_context = [], []
    for n in range(1, ORDER + 1):
        both = np.unique(_tail(np.concatenate(keys), n))
        by_gram.append(GramTable(both, models[0].logs(n, both) - models[1].logs(n, both)))
        contexts = np.unique(both >> np.uint64(8))
        by_context.append(GramTable(
            contexts, models[0].backed(n, contexts) - models[1].backed(n, contexts)))
    return Model(by_gram, by_context)


def fit_urls(accepted: list[str], rejected: list[str]) -> Model | None:
    """Every fourth URL calibrates and is not counted; both classes weigh the same."""
    if len(accepted) < 4 or len(rejected) < 4:
        return None
    model = _learn(*([u for i, u in enumerate(x) if i % 4] for x in (accepted, rejected)))
    x = [model.difference(arrow_texts(u[::4])) for u in (accepted, rejected)]
    y = np.repeat([1.0, 0.0], [len(x[0]), len(x[1])])
    weight, constant = logistic_fit(np.concatenate(x)[:, None], y)
    model.weight = float(weight)
    model.constant = float(constant + np.log(len(x[1]) / len(x[0])))
    return model


def fit(judged: DataFrame, url: str = "url", per_class: int = PER_CLASS,
        class_bytes: int = CLASS_BYTES) -> Model | None:
    """Learn from a bounded sample of the distinct URLs that rules have judged, in the order of a
    hash; a URL longer than class_bytes / per_class bytes is not learned from. None unless rules
    have judged URLs both ways."""
    rows = judged.where(F.col("rule_verdict").isNotNull() & (F.octet_length(url) <= class_bytes // per_class))
    found = []
    for kind in ("allow", "block"):
        some = (rows.where(F.col("rule_verdict") == kind).select(F.col(url).alias("u")).distinct()
                .orderBy(F.xxhash64("u"), "u").limit(per_class))
        found.append([r.u for r in some.collect()])
    return fit_urls(*found)


def judge(judged: DataFrame, model: Model | None, url: str = "url") -> DataFrame:
    """Add accepted (0 to 1, the method's) and verdict (the rule's, else the method's) to rows
    that with_rules has seen. Null is judged as empty; without a model the method allows."""
    if model is None:
        scored = judged.withColumn("accepted", F.lit(1.0))
    else:
        sent = judged.sparkSession.sparkContext.broadcast(model)
        scored = arrow_column(judged, url, "accepted", "double",
                              lambda: lambda urls: pa.array(sent.value.score(urls), pa.float64()))
    method = F.when(F.col("accepted") >= 0.5, "allow").otherwise("block")
    return scored.withColumn("verdict", F.coalesce("rule_verdict", method))
