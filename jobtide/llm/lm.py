"""Scoring by a bigram model in Elias-Fano tries.

Tokens are words and one end per text; the model is a Dirichlet-smoothed bigram over an add-one
unigram. It is never whole in one place: contexts are dealt to buckets by their hash, and each
bucket builds a trie of its n-grams. The trie has a level of contexts and a level of successors,
both monotone sequences in Elias-Fano form, with monotone pointers from the first into the second
and the smoothed probabilities quantised to one byte; all lie in one memory-mapped area. A query
finds its context and then searches the successor relative to the context's place.

Texts stay in chunks (see chunks.py). A chunk sends each distinct context and pair once, with its
learning counts, which serve as the counts to learn from and as the queries to answer. The few
contexts that make up more than 1 / HOT of all tokens are spread over all buckets by successor;
their totals, at most HOT numbers, go to every task.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.chunks import BUCKET_BYTES, answers_of, chunks, packed, unpacked
from jobtide.llm.common import MIX, byte_view, lower_ascii, mix64, release, steps, stored, word_hashes

START, END = np.uint64(0x51A7), np.uint64(0xE2D)
SUCCESSOR_BITS = 40
STRENGTH = 100.0  # tokens' worth of the unigram in each context
HOT = 1000
LEAST_LOG, LEVELS = -8.0, 255


class EliasFano:
    """A sorted sequence of 64-bit numbers: low bits in whole bytes, high bits in unary, with one
    count of zeros per word of the unary part."""

    def __init__(self, values: np.ndarray, universe: int):
        self.n = len(values)
        bits = min(56, max(0, (max(universe, 1) // max(self.n, 1)).bit_length() - 1))
        self.low_bits = np.uint64(bits)
        width = -(-bits // 8)
        low = values & np.uint64((1 << bits) - 1)
        self.low = np.ascontiguousarray(low.astype("<u8")[:, None].view(np.uint8)[:, :width])
        high = (values >> self.low_bits).astype(np.int64)
        size = (int(high[-1]) if self.n else 0) + self.n + 2
        raised = np.zeros(-(-size // 64) * 64, bool)
        raised[high + np.arange(self.n)] = True
        self.words = np.packbits(raised, bitorder="little").view("<u8")
        zeros = 64 - np.bitwise_count(self.words).astype(np.int64)
        self.zeros = np.concatenate([[0], np.cumsum(zeros)])

    def areas(self) -> list[str]:
        return ["low", "words", "zeros"]

    def _place(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the one or the zero number k of the unary part."""
        before = np.arange(len(self.zeros)) * 64 - self.zeros if ones else self.zeros
        word = np.minimum(np.searchsorted(before, k, side="right") - 1, len(self.words) - 1)
        left, z = k - before[word], self.words[word] if ones else ~self.words[word]
        place = np.zeros(len(k), np.uint64)
        for step in (32, 16, 8, 4, 2, 1):
            part = (z >> place) & np.uint64((1 << step) - 1)
            count = np.bitwise_count(part).astype(np.int64)
            beyond = left >= count
            left = left - count * beyond
            place = place + np.uint64(step) * beyond.astype(np.uint64)
        return word * 64 + place.astype(np.int64)

    def value(self, at: np.ndarray) -> np.ndarray:
        high = (self._place(at, True) - at).astype(np.uint64)
        return (high << self.low_bits) | self._value_low(at)

    def _value_low(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for k in range(self.low.shape[1]):
            out |= self.low[at, k].astype(np.uint64) << np.uint64(8 * k)
        return out

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value that is not less than each x, and whether it equals x."""
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        high = (x >> self.low_bits).astype(np.int64)
        most = int(self.zeros[-1]) - 1
        inside = high <= min(most, (len(self.words) * 64))
        h = np.minimum(high, most)
        at = np.where(h > 0, self._place(np.maximum(h - 1, 0), False) - (h - 1), 0)
        end = np.minimum(np.where(inside, self._place(h, False) - h, self.n), self.n)
        at = np.where(inside, at, self.n)
        low = x & np.uint64((1 << int(self.low_bits)) - 1)
        equal = np.zeros(len(x), bool)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            value = self._value_low(at[open_])
            equal[open_[value == low[open_]]] = True
            go = open_[value < low[open_]]
            at[go] += 1
            open_ = go[at[go] < end[go]]
        return at, equal


def quantised(p: np.ndarray) -> np.ndarray:
    """One byte for a probability: 1 + steps of its logarithm; 0 is kept for the unseen."""
    part = np.clip(np.log10(np.maximum(p, 1e-30)) / LEAST_LOG, 0, 1)
    return (1 + np.round(part * (LEVELS - 1))).astype(np.uint8)


def opened(code: np.ndarray) -> np.ndarray:
    p = 10 ** (LEAST_LOG * (code.astype(float) - 1) / (LEVELS - 1))
    return np.where(code == 0, 0.0, p)


class Trie:
    """Two levels over sorted (context, successor) pairs with counts above 0.

    `totals` gives the count of every context in the same order; contexts without pairs may be
    among them.
    """

    def __init__(self, contexts: np.ndarray, totals: np.ndarray, owner: np.ndarray,
                 successors: np.ndarray, counts: np.ndarray):
        self.contexts = EliasFano(contexts, 1 << 64)
        sizes = np.bincount(owner, minlength=len(contexts))
        self.pointers = EliasFano(np.cumsum(sizes).astype(np.uint64), max(len(owner), 1))
        place = (owner.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | successors
        self.successors = EliasFano(place, max(len(contexts), 1) << SUCCESSOR_BITS)
        self.codes = quantised(counts / (totals[owner] + STRENGTH)) if len(owner) else np.zeros(0, np.uint8)
        self.totals = totals.astype(np.int64)
        self._map()

    def _map(self) -> None:
        """Move all arrays into one memory-mapped area."""
        parts = [(level, name) for level in (self.contexts, self.pointers, self.successors)
                 for name in level.areas()] + [(self, "codes"), (self, "totals")]
        size = sum(-(-getattr(o, n).nbytes // 8) * 8 for o, n in parts)
        self.area = mmap.mmap(-1, max(size, 8))
        at = 0
        for o, n in parts:
            old = getattr(o, n)
            new = np.frombuffer(self.area, old.dtype, old.size, at).reshape(old.shape)
            new[...] = old
            setattr(o, n, new)
            at += -(-old.nbytes // 8) * 8

    def find_contexts(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each context (-1 for an unknown one) and its total count."""
        at, known = self.contexts.successor(contexts)
        at = np.where(known, at, -1)
        return at, np.where(known, self.totals[at] if len(self.totals) else 0, 0)

    def find(self, place: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Quantised probability of each successor after the context at each place (0: unseen).

        The pointers of a context bound its successors; contexts without any need no search.
        """
        out = np.zeros(len(place), np.uint8)
        if not len(self.codes):
            return out
        end = self.pointers.value(np.maximum(place, 0)).astype(np.int64)
        begin = np.where(place > 0, self.pointers.value(np.maximum(place - 1, 0)).astype(np.int64), 0)
        ask = np.flatnonzero((place >= 0) & (begin < end))
        x = (place[ask].astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | successors[ask]
        at, equal = self.successors.successor(x)
        hit = equal & (at >= begin[ask]) & (at < end[ask])
        out[ask[hit]] = self.codes[at[hit]]
        return out


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context and token hash of each event, and the number of events of each text: words, then
    one end."""
    flat, offsets = byte_view(texts)
    words, rows = [], []
    for a, b in steps(np.diff(offsets)):
        base = offsets[a]
        w, r, _, _ = word_hashes(lower_ascii(flat[base:offsets[b]]), offsets[a:b + 1] - base)
        words.append(w)
        rows.append(r + a)
    n = len(offsets) - 1
    words, rows = np.concatenate([*words, np.zeros(0, np.uint64)]), np.concatenate([*rows, np.zeros(0, np.int64)])
    counts = np.bincount(rows, minlength=n) + 1
    ends = np.cumsum(counts) - 1
    token = np.empty(counts.sum(), np.uint64)
    here = np.ones(len(token), bool)
    here[ends] = False
    token[here], token[ends] = words, END
    context = np.empty_like(token)
    context[1:], context[ends[:-1] + 1] = token[:-1], START
    if n:
        context[0] = START
    return context, token, counts


def _fingerprint(token: np.ndarray) -> np.ndarray:
    return mix64(token * MIX) >> np.uint64(64 - SUCCESSOR_BITS)


class Asked:
    """What one chunk asks, by bucket: contexts in order and, for each, its successors in order."""

    def __init__(self, table: pa.Table, n: int, hot: np.ndarray):
        context, self.token, self.counts = tokens(table["text"])
        learn = np.repeat(np.asarray(table["learn"].to_numpy(), bool), self.counts)
        names, self.context = np.unique(context, return_inverse=True)
        key = (self.context.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | _fingerprint(self.token)
        pairs, self.pair = np.unique(key, return_inverse=True)
        owner = (pairs >> np.uint64(SUCCESSOR_BITS)).astype(np.int64)
        successor = pairs & np.uint64((1 << SUCCESSOR_BITS) - 1)
        bucket = (mix64(names) % np.uint64(n)).astype(np.int64)[owner]
        spread = np.isin(names, hot)[owner]
        bucket[spread] = (successor[spread] % np.uint64(n)).astype(np.int64)
        # pairs by bucket; inside a bucket contexts and successors stay in order
        self.order = np.argsort(bucket, kind="stable")
        self.names, self.owner = names, owner[self.order]
        self.successor = successor[self.order]
        self.learned = np.bincount(self.pair, learn, len(pairs)).astype(np.int64)[self.order]
        self.buckets, first = np.unique(bucket[self.order], return_index=True)
        self.cuts = np.append(first, len(self.order))

    def parts(self) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
        """Bucket, its pairs, its contexts (as places in names) and their numbers of pairs."""
        for k, bucket in enumerate(self.buckets.tolist()):
            part = slice(self.cuts[k], self.cuts[k + 1])
            mine, sizes = np.unique(self.owner[part], return_counts=True)
            yield bucket, part, mine, sizes


def _five(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")[:, None].view(np.uint8)[:, :5]).tobytes()


def _unfive(data: bytes) -> np.ndarray:
    part = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(part), 8), np.uint8)
    out[:, :5] = part
    return out.view("<u8")[:, 0]


ASKED = "chunk binary, bucket bigint, contexts binary, sizes binary, successors binary, learned binary"
ANSWERED = "chunk binary, bucket bigint, totals binary, codes binary"


def _ask(n: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table in chunks(batches):
            asked, rows = Asked(table, n, hot), []
            for bucket, part, mine, sizes in asked.parts():
                rows.append((name, bucket, asked.names[mine].tobytes(), sizes.astype("<u4").tobytes(),
                             _five(asked.successor[part]), asked.learned[part].astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if k == 1 else pa.binary()) for k, c in enumerate(zip(*rows, strict=True))],
                ["chunk", "bucket", "contexts", "sizes", "successors", "learned"])
    return run


def _answer(hot: np.ndarray, hot_totals: np.ndarray):
    """Build the trie of one bucket from all its questions, then answer each of them."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        asked = []
        for row in range(table.num_rows):
            c, z, s, k = (table[name][row].as_py() for name in ("contexts", "sizes", "successors", "learned"))
            contexts = np.frombuffer(c, np.uint64)
            asked.append((contexts, np.repeat(np.arange(len(contexts)), np.frombuffer(z, "<u4")),
                          _unfive(s), np.frombuffer(k, "<u4")))
        # chunks of one name ask alike; each is counted as often as it comes
        names, place = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
        ends = np.cumsum([0, *[len(a[0]) for a in asked]])
        cuts = np.cumsum([0, *[len(a[1]) for a in asked]])
        key_of = np.concatenate([place[ends[i]:ends[i + 1]].astype(np.uint64)[a[1]] for i, a in enumerate(asked)])
        key_of <<= np.uint64(SUCCESSOR_BITS)
        key_of |= np.concatenate([a[2] for a in asked])
        learned = np.concatenate([a[3] for a in asked])
        del asked
        # each distinct pair is learned and looked up once, in order
        pairs, at = np.unique(key_of, return_inverse=True)
        counts = np.bincount(at, learned, len(pairs)).astype(np.int64)
        owner = (pairs >> np.uint64(SUCCESSOR_BITS)).astype(np.int64)
        successors = pairs & np.uint64((1 << SUCCESSOR_BITS) - 1)
        totals = np.bincount(owner, counts, len(names)).astype(np.int64)
        known = np.isin(names, hot)
        totals[known] = hot_totals[np.searchsorted(hot, names[known])]
        seen = counts > 0
        trie = Trie(names, totals, owner[seen], successors[seen], counts[seen])
        where, total = trie.find_contexts(names)
        codes = trie.find(where[owner], successors)[at]
        total = total.astype("<i8")[place]
        out = [(total[ends[i]:ends[i + 1]].tobytes(), codes[cuts[i]:cuts[i + 1]].tobytes())
               for i in range(table.num_rows)]
        del key_of, pairs, at, trie, codes, where
        release()
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"],
                         "totals": pa.array([x[0] for x in out], pa.binary()),
                         "codes": pa.array([x[1] for x in out], pa.binary())})
    return run


def _score(n: int, hot: np.ndarray, n_tokens: int, n_known: int, n_ends: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        answers, out = answers_of(right, ["totals", "codes"]), []
        for table in unpacked(left):
            asked = Asked(table, n, hot)
            totals = np.zeros(len(asked.names), np.int64)
            codes = np.zeros(len(asked.order), np.uint8)
            for bucket, part, mine, _ in asked.parts():
                total, code = answers[bucket]
                totals[mine] = np.frombuffer(total.as_py(), "<i8")
                codes[asked.order[part]] = np.frombuffer(code.as_py(), np.uint8)
            first = np.cumsum(asked.counts) - asked.counts
            of_context = totals[asked.context]
            count = np.append(of_context[1:], 0)
            count[np.cumsum(asked.counts) - 1] = n_ends
            base = (count + 1) / (n_tokens + n_known + 1)
            p = opened(codes[asked.pair]) + STRENGTH / (of_context + STRENGTH) * base
            sums = [np.add.reduceat(x, first) if len(first) else np.zeros(0)
                    for x in (np.log10(base), np.log10(p), (count > 0).astype(np.int64))]
            out.append(pa.table({
                "id": table["id"], "learn": table["learn"], "n_tokens": pa.array(asked.counts, pa.int64()),
                "n_known": pa.array(sums[2].astype(np.int64), pa.int64()),
                "train_tokens": pa.array(np.full(len(first), n_tokens), pa.int64()),
                "base_score": pa.array(sums[0], pa.float64()), "score": pa.array(sums[1], pa.float64())}))
        release()
        return pa.concat_tables(out)
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, table in chunks(batches):
        context, _, counts = tokens(table["text"])
        learn = np.repeat(np.asarray(table["learn"].to_numpy(), bool), counts)
        names, n = np.unique(context[learn], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], ["context", "n"])


def score(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, learn, n_tokens, n_known, train_tokens, base_score, score) of each row.

    `learn` marks the rows that are counted; a null mark counts as false. A null or empty text is
    one end. base_score is the add-one unigram, score the model's, both sums of log10 over the
    tokens. Equal rows are counted and returned as often as they come. The rows of `docs` must
    come in the same order whenever they are read, as those of a stored table do.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"))
    kind = rows.schema["id"].dataType.simpleString()
    # each context is a token that was followed by one, so its total is the token's count
    counted = stored(rows.mapInArrow(_counted, "context bigint, n bigint").groupBy("context").agg(
        F.sum("n").alias("n")), "tokens")
    total, distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # at most HOT contexts, and the start of texts, whose count is that of ends
    marked = counted.where((F.col("n") * HOT > total) | (F.col("context") == int(START))).collect()
    hot = np.array([x for x, _ in marked] or [int(START)], np.int64).view(np.uint64)
    hot_totals = np.array([x for _, x in marked] or [0], np.int64)
    hot, hot_totals = hot[np.argsort(hot)], hot_totals[np.argsort(hot)]
    n_ends = next((x for name, x in marked if name == int(START)), 0)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(max(16, size // BUCKET_BYTES + 1))
    whole = rows.mapInArrow(packed, "chunk binary, rows binary")
    answers = (rows.mapInArrow(_ask(n, hot), ASKED).groupBy("bucket")
               .applyInArrow(_answer(hot, hot_totals), ANSWERED))
    return (whole.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(_score(n, hot, int(total), int(distinct), int(n_ends)),
                          f"id {kind}, learn boolean, n_tokens bigint, n_known bigint, "
                          "train_tokens bigint, base_score double, score double")
            .withColumnRenamed("id", key))
