"""Language identification, words first.

A known word adds its log frequency in each language. A word that is not known falls back to its
character 4-grams, and if none of these is known to its 3-grams, 2-grams and single characters.
Words are runs of letters, lower-cased; the ends of a word count as a character.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from jobtide.llm.common import (
    LONG_PART, MIX, GramTable, arrow_column, arrow_texts, byte_view, fitting, mix64, steps, word_hashes,
)

LONGEST = 4
SMOOTH = 0.5
PER_LANGUAGE, LANGUAGE_BYTES = 800, 2 << 20


def _gap() -> np.ndarray:
    """Bytes that part words: ASCII without letters. Other signs stay inside words, where they
    only make a word unknown."""
    out = np.zeros(256, bool)
    out[:128] = True
    out[97:123] = out[65:91] = False
    return out


GAP = _gap()


def word_grams(words: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of words between their ends, and the word of each."""
    text = "\0" + "\0".join(w.decode("utf-8", "replace") for w in words) + "\0"
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    size = len(codes) - n + 1
    if size <= 0 or not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.full(size, np.uint64(n))
    for k in range(n):
        key = key * MIX + codes[k:k + size] + np.uint64(1)
    end = codes == 0
    whole = np.ones(size, bool)
    for k in range(1, n - 1):
        whole &= ~end[k:k + size]
    if n == 1:
        whole = ~end
    else:
        whole &= ~(end[:size] & end[n - 1:n - 1 + size] & (n == 2))
    word = np.cumsum(end)[:size] - 1
    return mix64(key)[whole], word[whole]


@dataclass
class _Table:
    """Log frequencies of keys by language. Only those of counts are stored, so that the size is
    bounded by the learning bytes, however many languages there are."""

    index: GramTable
    first: np.ndarray  # of the entries of each key
    owners: np.ndarray
    logs: np.ndarray
    without: np.ndarray  # log frequency in each language of a key that it does not have

    @staticmethod
    def of(keys: np.ndarray, languages: np.ndarray, weights: np.ndarray, n: int) -> _Table:
        names, place = np.unique(keys, return_inverse=True)
        entries, at = np.unique(place * n + languages, return_inverse=True)
        rows, owners = np.divmod(entries, n)
        total = np.bincount(languages, weights, n) + SMOOTH * max(len(names), 1)
        logs = np.log((np.bincount(at, weights, len(entries)) + SMOOTH) / total[owners])
        first = np.searchsorted(rows, np.arange(len(names) + 1))
        return _Table(GramTable(names, np.arange(len(names)), kind=np.int64), first, owners.astype(np.int32),
                      logs.astype(np.float32), np.log(SMOOTH / total).astype(np.float32))

    def rows(self, places: np.ndarray) -> np.ndarray:
        """The log frequencies of the keys at these places, a column for each language."""
        out = np.tile(self.without, (len(places), 1))
        sizes = self.first[places + 1] - self.first[places]
        at = np.arange(sizes.sum()) + np.repeat(self.first[places] - np.cumsum(sizes) + sizes, sizes)
        out[np.repeat(np.arange(len(places)), sizes), self.owners[at]] = self.logs[at]
        return out


@dataclass
class Model:
    languages: list[str]
    words: _Table
    grams: dict[int, _Table]

    def score(self, texts: pa.Array) -> pa.Array:
        """Language and its share of the probability, from mean log frequencies of the words."""
        lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False)
        lettered = lettered.to_numpy(zero_copy_only=False)
        flat, offsets = byte_view(pc.utf8_lower(texts))
        n = len(self.languages)
        sums, counts = np.zeros((len(texts), n)), np.zeros(len(texts))
        for a, b in steps(np.diff(offsets)):
            base = offsets[a]
            part = flat[base:offsets[b]]
            hashes, rows, start, stop = word_hashes(part, offsets[a:b + 1] - base, GAP)
            place, known = self.words.index.get(hashes)
            logs = np.zeros((len(hashes), n), np.float32)
            logs[known] = self.words.rows(place[known])
            other = np.flatnonzero(~known)
            if len(other):
                _, first, back = np.unique(hashes[other], return_index=True, return_inverse=True)
                data = part.tobytes()
                spelled = [data[i:j] for i, j in zip(start[other[first]].tolist(), stop[other[first]].tolist(),
                                                     strict=True)]
                logs[other] = self._fall_back(spelled)[back]
            for k in range(n):
                sums[a:b, k] = np.bincount(rows, logs[:, k], b - a)
            counts[a:b] = np.bincount(rows, minlength=b - a)
        # words are not independent: their evidence grows with the root of their number
        x = sums / np.sqrt(np.maximum(counts, 1))[:, None]
        x = np.exp(x - x.max(1, keepdims=True))
        x /= x.sum(1, keepdims=True)
        best = x.argmax(1)
        names = [self.languages[k] if ok else "und" for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
        value = np.where(lettered, x[np.arange(len(x)), best], 0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(value, pa.float64())],
                                          ["lang", "score"])

    def _fall_back(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), len(self.languages)), np.float32)
        todo = np.arange(len(words))
        for n in range(LONGEST, 0, -1):
            if not len(todo):
                break
            keys, word = word_grams([words[i] for i in todo.tolist()], n)
            place, known = self.grams[n].index.get(keys)
            word = word[known]
            logs = self.grams[n].rows(place[known])
            hits = np.bincount(word, minlength=len(todo))
            done = np.flatnonzero(hits)
            for k in range(len(self.languages)):
                total = np.bincount(word, logs[:, k], len(todo))
                out[todo[done], k] = total[done] / hits[done]
            todo = todo[hits == 0]
        return out


def sampled(docs: DataFrame, learn: Column, per_language: int, language_bytes: int) -> list[tuple[str, str]]:
    """(lang, text) of at most per_language rows and language_bytes bytes of each language, in
    the order of a hash of the key; rows that share key and language count once. A text that
    would go beyond is left out, and those after it are still taken; texts of more than
    language_bytes / LONG_PART bytes come after all others.
    Of a language whose texts are all longer than language_bytes the beginning of the first is
    taken, so that no language of the rows is missing."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()
                      & F.col("doc_id").isNotNull())
    size = F.octet_length("text")
    narrow = rows.groupBy("doc_id", "lang").agg(F.max(size).alias("bytes"))
    narrow = narrow.withColumns({"order": F.xxhash64("doc_id"), "long": F.col("bytes") > language_bytes // LONG_PART,
                                 "huge": F.col("bytes") > language_bytes})
    by_order = W.partitionBy("lang").orderBy("huge", "long", "order", "doc_id")
    few = (narrow.withColumn("place", F.row_number().over(by_order)).where(F.col("place") <= per_language)
           .select("lang", "doc_id", "bytes", "place").orderBy("lang", "place").collect())
    chosen = []
    for lang in sorted({r.lang for r in few}):
        own = [r for r in few if r.lang == lang]
        fit_in = fitting([r.bytes for r in own], language_bytes)
        chosen += [(own[i].doc_id, lang) for i in fit_in or [0]]
    if not chosen:
        return []
    kinds = T.StructType([docs.schema["doc_id"], docs.schema["lang"]])
    ids = docs.sparkSession.createDataFrame(sorted(set(chosen)), kinds)
    # at most per_language ids for each language; a character has at most four bytes
    text = F.when(size > language_bytes, F.substring("text", 1, language_bytes // 4)).otherwise(F.col("text"))
    got = rows.select("doc_id", "lang", text.alias("text")).join(F.broadcast(ids), ["doc_id", "lang"])
    got = got.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    return [(r.lang, r.text) for r in got.orderBy("lang", "doc_id").select("lang", "text").collect()]


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE,
        language_bytes: int = LANGUAGE_BYTES) -> Model | None:
    """Learn from a bounded sample of the rows marked; None if no such row has a language."""
    return fit_texts(sampled(docs, learn, per_language, language_bytes))


def fit_texts(sample: list[tuple[str, str]]) -> Model | None:
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    hashes, owners, spelled, weights = [], [], [], []
    for k, lang in enumerate(languages):
        flat, offsets = byte_view(pc.utf8_lower(arrow_texts([t for x, t in sample if x == lang])))
        for a, b in steps(np.diff(offsets)):
            base = offsets[a]
            data = flat[base:offsets[b]]
            h, _, start, stop = word_hashes(data, offsets[a:b + 1] - base, GAP)
            names, first, n = np.unique(h, return_index=True, return_counts=True)
            data = data.tobytes()
            hashes.append(names)
            weights.append(n)
            owners.append(np.full(len(names), k))
            spelled += [data[i:j] for i, j in zip(start[first].tolist(), stop[first].tolist(), strict=True)]
    keys, owner, weight = np.concatenate(hashes), np.concatenate(owners), np.concatenate(weights)
    words = _Table.of(keys, owner, weight, len(languages))
    grams = {}
    for n in range(1, LONGEST + 1):
        g, word = word_grams(spelled, n)
        grams[n] = _Table.of(g, owner[word], weight[word], len(languages))
    return Model(languages, words, grams)


def identify(df: DataFrame, model: Model | None, text: str = "text", name: str = "language") -> DataFrame:
    """Add a struct: lang and score, 0 to 1, of each whole text.

    A null text or one without a letter is `und` with score 0; so is every text without a model.
    A column of the same name is replaced.
    """
    kind = "struct<lang:string,score:double>"
    if model is None:
        return df.withColumn(name, F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score")))
    sent = df.sparkSession.sparkContext.broadcast(model)
    return arrow_column(df, text, name, kind, lambda: lambda texts: sent.value.score(texts))
