"""What the text operators share: stored tables, learning rows, models sent to tasks."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.session import shared_dir

STEP_BYTES = 2 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)
LEAST = 4  # texts of a class that a model can be learned from
LONG_PART = 16  # a text of more than this part of a sample's bytes does not keep others out


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder of the cluster."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back: lineage is cut, a lost
    executor costs nothing that was computed, and later readers take only their columns."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rest(key: Column | str, modulus: int) -> Column:
    """crc32 of a key written as text, modulo a small number; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string")) % modulus


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Rows that no model may learn from. A null key is not held out, and not learned from."""
    return F.coalesce(rest(key, modulus) == remainder, F.lit(False))


def fitting(sizes: list[int], most: int) -> list[int]:
    """Places of the sizes that fit into `most` together, taken in order; one that does not is
    passed over."""
    out, total = [], 0
    for i, n in enumerate(sizes):
        if total + n <= most:
            out.append(i)
            total += n
    return out


def learning_rows(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int,
    per_class: int, class_bytes: int,
) -> tuple[dict[int, list[str]], dict[int, int]]:
    """A bounded sample of labelled texts for each class, and the class sizes it comes from.

    Rows are taken in the order of a hash of their id, at most `per_class` of a class and at
    most `class_bytes` bytes of their texts, so that the driver holds at most 2 * class_bytes.
    A text that would go beyond is left out, and those after it are still taken; texts of more
    than class_bytes / LONG_PART bytes come after all others of their class. Held-out ids are
    never read. Raises ValueError if both classes have rows, but one has less than LEAST that fit.
    """
    marked = (labels.where(F.col(label).isin(0, 1)).where(~held_out("doc_id", modulus, remainder))
              .groupBy("doc_id").agg(F.max(label).alias("_label")))
    rows = docs.select("doc_id", F.octet_length("text").alias("_bytes")).where(
        F.col("text").isNotNull())
    rows = (rows.groupBy("doc_id").agg(F.max("_bytes").alias("_bytes")).join(marked, "doc_id")
            .withColumn("_order", F.xxhash64("doc_id"))
            .withColumn("_long", F.col("_bytes") > class_bytes // LONG_PART))
    sizes, chosen = {}, []
    for y, n in rows.groupBy("_label").count().collect():
        sizes[y] = n
    for y in sizes:
        top = (rows.where((F.col("_label") == y) & (F.col("_bytes") <= class_bytes))
               .orderBy("_long", "_order", "doc_id").limit(per_class).select("doc_id", "_bytes").collect())
        chosen += [(top[i].doc_id, y) for i in fitting([r._bytes for r in top], class_bytes)]
    if len(sizes) == 2:
        for y in sizes:
            if (n := sum(x == y for _, x in chosen)) < LEAST:
                raise ValueError(f"{n} of {sizes[y]} texts with {label} = {y} to learn from, {LEAST} are needed")
    if not chosen:
        return {}, sizes
    kinds = T.StructType([docs.schema["doc_id"], T.StructField("_label", T.IntegerType())])
    ids = docs.sparkSession.createDataFrame(chosen, kinds)
    # at most 2 * per_class ids go to every task
    texts = (docs.select("doc_id", "text").where(F.col("text").isNotNull())
             .join(F.broadcast(ids), "doc_id").groupBy("doc_id", "_label")
             .agg(F.min("text").alias("text")).orderBy("doc_id").collect())
    out: dict[int, list[str]] = {y: [] for y in sizes}
    for _, y, text in texts:
        out[y].append(text)
    return out, sizes


def arrow_column(
    df: DataFrame, source: str, name: str, kind: str, make: Callable[[], Callable],
) -> DataFrame:
    """Add a column that a function of Arrow arrays computes from another column.

    `make` runs once per task and returns the function. Only the source column goes to Python.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            yield work(batch)
            release()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(run, kind).asNondeterministic()
    return df.withColumn(name, udf(F.col(source)))


def release() -> None:
    """Give freed memory back to the system, where the allocators can. Python workers live on
    between stages, and several of them share an executor with its JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


FILTER_BITS = 1 << 25


def flagged(rows: DataFrame, ids: DataFrame, key: str, name: str) -> DataFrame:
    """Add whether a row's key may be among the ids: whether its hash has its bit set in a filter
    of FILTER_BITS bits (4 MB), which goes to every task. However many ids there are, every row
    with one of them is flagged; others seldom are, and need not be shuffled to be told apart."""
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    marks = ids.groupBy(F.bitmap_bucket_number(place).alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substr("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_part", F.bitmap_bucket_number(place)).join(F.broadcast(marks), "_part", "left")
    hit = F.expr("shiftright(_byte, cast(_bit % 8 as int))").bitwiseAND(F.lit(1)) == 1
    return found.withColumns({"_byte": byte, "_bit": bit}).select(
        *rows.columns, F.coalesce(hit, F.lit(False)).alias(name))


def likely(rows: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The rows whose key may be among the ids (see `flagged`)."""
    return flagged(rows, ids, key, "_likely").where("_likely").drop("_likely")


def steps(lengths: np.ndarray, step: int = STEP_BYTES) -> list[tuple[int, int]]:
    """Cut rows into runs of about `step` bytes; a longer row is a run of its own."""
    cuts, start, total = [], 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > step:
            cuts.append((start, i))
            start, total = i, 0
        total += n
    if len(lengths) > start:
        cuts.append((start, len(lengths)))
    return cuts


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow array and the n + 1 offsets. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type)
                                or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat, offsets


def lower_ascii(flat: np.ndarray) -> np.ndarray:
    return flat + ((flat - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: the finisher of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWER = np.uint64(0x2545F4914F6CDD1D)
_INVERSE = np.uint64(pow(int(_POWER), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next call."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = max(n, STEP_BYTES + 65536)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * STEP_BYTES:
            _POWERS[int(base)] = have
    return have[:n]


def is_space() -> np.ndarray:
    """Bytes that part words: space, tab, line feed, vertical tab, form feed, return."""
    out = np.zeros(256, bool)
    out[[32, 9, 10, 11, 12, 13]] = True
    return out


SPACE = is_space()


def word_hashes(
    flat: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE, cut: np.ndarray | None = None,
) -> tuple[np.ndarray, ...]:
    """Hash, text number, start and end of each word of texts that lie side by side in `flat`.

    A word is a run of bytes that are no gap, within one text; `cut`, if given, tells for each
    byte of the texts whether a word begins there even without a gap. The hash is a polynomial over
    the bytes modulo 2 ** 64, spread with the length; equal words have equal hashes.
    """
    base = offsets[0]
    part, ends = flat[base:offsets[-1]], offsets - base
    n = len(part)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    inside = ~gap[part]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = ends[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    if cut is not None:
        first |= cut & inside
        last[:-1] |= cut[1:] & inside[:-1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(_POWER, n), out=total[1:])
    back = powers(_INVERSE, n)[start]
    hashes = mix64((total[stop] - total[start]) * back + (stop - start).astype(np.uint64) * MIX)
    texts = np.searchsorted(ends, start, side="right") - 1
    return hashes, texts, start + base, stop + base


class GramTable:
    """Exact look-up of 64-bit keys: a cascade of sparse arrays, each for the keys that met a
    taken place in the one before. Size is bounded by the keys given."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: float = 0.0, kind: type = np.float32):
        self.missing, self.kind = missing, kind
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        keys, values, salt = keys.astype(np.uint64), values.astype(kind), 0
        while len(keys):
            bits = max(4, int(2 * len(keys)).bit_length())
            place = self._place(keys, bits, salt)
            _, kept = np.unique(place, return_index=True)
            names = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
            found = np.zeros(1 << bits, kind)
            names[place[kept]], found[place[kept]] = keys[kept], values[kept]
            self.levels.append((bits, names, found))
            left = np.ones(len(keys), bool)
            left[kept] = False
            keys, values, salt = keys[left], values[left], salt + 1

    @staticmethod
    def _place(keys: np.ndarray, bits: int, salt: int) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * salt * 77731)
                >> np.uint64(64 - bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the keys, and which of the keys are known."""
        out = np.full(len(keys), self.missing, self.kind)
        known = np.zeros(len(keys), bool)
        todo = np.arange(len(keys)) if len(self.levels) > 1 else None
        for salt, (bits, names, found) in enumerate(self.levels):
            ask = keys if salt == 0 else keys[todo]
            place = self._place(ask, bits, salt)
            hit = names[place] == ask
            if salt == 0:
                known, out = hit.copy(), np.where(hit, found[place], self.kind(self.missing))
                if todo is not None:
                    todo = np.flatnonzero(~hit)
            else:
                at = todo[hit]
                known[at], out[at] = True, found[place[hit]]
                todo = todo[~hit]
            if todo is None or not len(todo):
                break
        return out, known


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Weights and, last, the constant of a logistic model, by Newton steps on scaled inputs."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - mean) / spread, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) / len(y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + (ridge + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    out = np.empty_like(w)
    out[:-1] = w[:-1] / spread
    out[-1] = w[-1] - (w[:-1] * mean / spread).sum()
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def arrow_texts(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.large_string())
