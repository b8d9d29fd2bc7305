"""Near duplicates by HyperMinHash.

A sketch holds one register per bucket; a register is the number of leading zeros of the least
hash of the bucket and the first bits after them, so that 16 bits say what 64 did. Each bucket
hashes the whole set with a function of its own, for short texts leave most buckets of a
partitioned sketch empty. Bands of registers bring texts together; pairs whose Jaccard estimate,
corrected for registers that agree by chance, is far below the bound go; the others are confirmed
on their full shingle sets.

Texts with the same set are one node. In each bucket of a band every node is first compared with
the least one only (a star). What then still spans several components is compared in blocks, so
that links between nodes that are both unlike the least one are found as well; pairs inside one
component need no test, as they cannot change it. Groups of loose variants have very many pairs
just below the bound, so a longer sketch of fewer bits a register decides here which pairs need
their full sets, and of these the likeliest of each two components come first: the rest goes
unread once the two have become one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from jobtide.llm.common import (
    MIX, arrow_column, byte_view, likely, lower_ascii, mix64, steps, stored, word_hashes,
)
from jobtide.llm.components import components, relabelled, roots

WORDS = 5
SHARE = 75  # least similarity in hundredths
BUCKETS, ROWS = 128, 4
MANTISSA = 10
# five standard errors of the estimate below the bound
LEAST_ESTIMATE = SHARE / 100 - 5 * (SHARE / 100 * (1 - SHARE / 100) / BUCKETS) ** 0.5
# the longer sketch: registers of 4 bits, four standard errors below the bound
LONG, LONG_BITS = 1024, 4
LONG_CHANCE = 1 / (1 << LONG_BITS)
LEAST_LONG = SHARE / 100 - 4 * (SHARE / 100 * (1 - SHARE / 100) / LONG) ** 0.5 / (1 - LONG_CHANCE)
FIRST, MORE = 8, 32  # pairs of two components in the first round, and times as many in the next
STEP = 512 << 10
BLOCK = 512
HUB_PART = 64

_RANDOM = np.random.default_rng(11)
_FACTORS = _RANDOM.integers(0, 1 << 63, LONG, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, LONG, np.uint64)


def shingle_sets(flat: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text; a text of fewer words has its whole
    sequence as its one shingle, a text without words none."""
    base = offsets[0]
    words, texts, _, _ = word_hashes(lower_ascii(flat[base:offsets[-1]]), offsets - base)
    n = len(offsets) - 1
    cut = np.searchsorted(texts, np.arange(n + 1))
    size = len(words) - WORDS + 1
    rolled = np.zeros(max(size, 0), np.uint64)
    for k in range(WORDS):
        rolled = rolled * MIX + words[k:k + size] if size > 0 else rolled
    rolled = mix64(rolled)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b - a >= WORDS:
            s = np.sort(rolled[a:b - WORDS + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mix64(whole * MIX + words[k:k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """Least hash of each set (none is empty) under each of n functions."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    every = np.concatenate(sets)
    least = np.empty((len(sets), n), np.uint64)
    room = np.empty_like(every)
    for k in range(n):
        np.multiply(every, _FACTORS[k], out=room)
        np.add(room, _SHIFTS[k], out=room)
        least[:, k] = np.minimum.reduceat(room, starts)
    return least


def long_sketch(sets: list[np.ndarray]) -> np.ndarray:
    """LONG registers of LONG_BITS bits of the least hash, two in a byte."""
    bits = (mix64(_minima(sets, LONG)) & np.uint64((1 << LONG_BITS) - 1)).astype(np.uint8)
    return bits[:, ::2] << np.uint8(LONG_BITS) | bits[:, 1::2]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BUCKETS registers for each set that is not empty."""
    least = _minima(sets, BUCKETS)
    zeros = np.zeros(least.shape, np.uint16)
    for s in (32, 16, 8, 4, 2, 1):
        small = least < np.uint64(1 << (64 - s))
        zeros += small.astype(np.uint16) * np.uint16(s)
        least = np.where(small, least << np.uint64(s), least)
    bits = (least >> np.uint64(63 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    return (zeros << np.uint16(MANTISSA)) | bits.astype(np.uint16)


def _sketch(texts: pa.Array) -> pa.Array:
    flat, offsets = byte_view(texts)
    sizes, keys, sketches = [], [], []
    for a, b in steps(np.diff(offsets), STEP):
        sets = shingle_sets(flat, offsets[a:b + 1])
        full = [s for s in sets if len(s)]
        rows = iter(registers(full)) if full else iter(())
        for s in sets:
            sizes.append(len(s))
            keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            sketches.append(next(rows).tobytes() if len(s) else None)
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary())],
        ["n", "set", "registers"])


def _long(texts: pa.Array) -> pa.Array:
    flat, offsets = byte_view(texts)
    out, none = [], np.zeros(1, np.uint64)
    for a, b in steps(np.diff(offsets), STEP):
        sets = [s if len(s) else none for s in shingle_sets(flat, offsets[a:b + 1])]
        out += [row.tobytes() for row in long_sketch(sets)]
    return pa.array(out, pa.binary())


def sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, hash of the text, set size, digest of the set and registers of each row."""
    rows = named(docs, key, text)
    out = arrow_column(rows, "text", "s", "struct<n:bigint,set:binary,registers:binary>", lambda: _sketch)
    return out.select("id", "said", "s.n", "s.set", "s.registers")


def named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, text and a hash of the text, which tells apart texts that share an id."""
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("said"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _band_keys(column: pa.Array) -> np.ndarray:
    """One number per band: its registers, spread with the number of the band."""
    keys = _matrix(column).reshape(len(column), -1, ROWS).copy().view(np.uint64)[:, :, 0]
    return mix64(keys + (np.arange(1, BUCKETS // ROWS + 1, dtype=np.uint64) * MIX)[None, :])


def _bands(column: pa.Array) -> pa.Array:
    """The numbers of the bands as lists."""
    flat = pa.array(_band_keys(column).reshape(-1).view(np.int64))
    return pa.ListArray.from_arrays(
        pa.array(np.arange(len(column) + 1, dtype=np.int32) * (BUCKETS // ROWS)), flat)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How likely registers of disjoint sets of these sizes agree: both minima fall into one
    octave, and there on one of its equal cells."""
    high = 0.5 ** np.arange(64)
    low = high / 2

    def octaves(x: np.ndarray) -> np.ndarray:
        x = x[:, None].astype(float)
        return np.exp(x * np.log1p(-low)) - np.exp(x * np.log1p(-np.minimum(high, 1 - 1e-16)))

    return (octaves(n) * octaves(m)).sum(1) / (1 << MANTISSA)


def corrected(agree: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimate from the share of registers that agree."""
    p = chance(n, m)
    return np.maximum((agree - p) / (1 - p), 0)


def _estimate(a: pa.Array, b: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float64())
    agree = (_matrix(a) == _matrix(b)).mean(1)
    return pa.array(corrected(agree, n.to_numpy(), m.to_numpy()))


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of sorted batches. The keys are such that a run stays small."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        if not table.num_rows:
            continue
        new = np.zeros(table.num_rows, bool)
        for name in names:
            column = table[name].to_numpy()
            new[1:] |= column[1:] != column[:-1]
        cuts = np.flatnonzero(new).tolist()
        for a, b in zip([0, *cuts], cuts, strict=False):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1] if cuts else 0)
    if rest is not None and rest.num_rows:
        yield rest


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a block (or of two blocks of one bucket) in different components whose estimate
    reaches the bound. Two nodes that share several buckets are told by the first of these only."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for group in _groups(batches, ["band", "lo", "hi"]):
        node, comp, side, n = (group[c].to_numpy() for c in ("node", "comp", "block", "n"))
        if len(node) < 2 or (comp == comp[0]).all():
            continue
        packed = np.frombuffer(b"".join(group["long"].to_pylist()), np.uint8).reshape(len(node), -1)
        rows = np.concatenate([packed >> np.uint8(LONG_BITS), packed & np.uint8((1 << LONG_BITS) - 1)], 1)
        keys = _band_keys(group["registers"])
        lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
        own = keys[0] == np.uint64(group["band"][0].as_py() % (1 << 64))
        own = int(own.argmax())
        one, two = np.flatnonzero(side == lo), np.flatnonzero(side == hi)
        for i in one.tolist():
            near = two if lo != hi else two[two > i]
            near = near[comp[near] != comp[i]]
            near = near[(100 * n[near] >= SHARE * n[i]) & (100 * n[i] >= SHARE * n[near])]
            if len(near):
                share = ((rows[near] == rows[i]).mean(1) - LONG_CHANCE) / (1 - LONG_CHANCE)
                near, share = near[share >= LEAST_LONG], share[share >= LEAST_LONG]
                first = (keys[near, :own] != keys[i, :own]).all(1)
                near, share = near[first], share[first]
                found.append((np.full(len(near), node[i]), node[near], share))
        if len(found) > 4096:
            yield _pairs(found)
            found = []
    yield _pairs(found)


def _pairs(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b, share = (np.concatenate([np.zeros(0, kind), *(f[k] for f in found)])
                   for k, kind in enumerate((np.int64, np.int64, float)))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)), pa.array(share)], ["a", "b", "estimate"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hub, each hub first, those whose full set is similar to that of the hub."""
    hub, full = None, np.zeros(0, np.uint64)
    for batch in batches:
        flat, offsets = byte_view(batch.column("text"))
        hubs, ids = batch.column("b").to_pylist(), batch.column("id").to_pylist()
        out: list[tuple[int, int]] = []
        for a, b in steps(np.diff(offsets), STEP):
            for k, s in enumerate(shingle_sets(flat, offsets[a:b + 1]), a):
                if ids[k] == hubs[k]:
                    hub, full = ids[k], s
                elif hub == hubs[k]:
                    both = len(np.intersect1d(full, s, assume_unique=True))
                    if 100 * both >= SHARE * (len(full) + len(s) - both):
                        out.append((ids[k], hub))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that the full sets of both texts confirm.

    The members of a hub b are dealt into parts of about HUB_PART; each part gets the hub's text
    once, and a task holds one hub's set and one batch of texts at a time.
    """
    part = pairs.groupBy("b").agg(F.ceil(F.count("*") / HUB_PART).alias("parts"))
    pairs = pairs.join(part, "b").select(
        "a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).alias("part"))
    need = pairs.select(F.col("a").alias("id"), "b", "part").union(
        pairs.select(F.col("b").alias("id"), "b", "part").distinct())
    rows = need.join(texts, "id").withColumn("order", F.when(F.col("id") == F.col("b"), 0).otherwise(1))
    return (rows.repartition("b", "part").sortWithinPartitions("b", "part", "order")
            .select("id", "b", "text").mapInArrow(_confirm, "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: the key, n_shingles, component_id and kept.

    component_id is the least key that links of the asked similarity lead to. A text without
    words is linked with nothing; neither is a row whose key is null, which is kept with a null
    component. Rows that share a key are one document, whatever their texts: these lie in one
    component, and n_shingles is that of the row's own text.
    """
    sketches = stored(sketched(docs, key, text), "sketches")
    full = sketches.where(F.col("id").isNotNull() & (F.col("n") > 0))
    nodes = stored(full.groupBy("set").agg(
        F.min(F.struct("id", "said")).alias("of"), F.any_value("n").alias("n"),
        F.any_value("registers").alias("registers")).select("set", "of.id", "of.said", "n", "registers"), "nodes")
    # a node is named by its least id, so that the hub of a bucket is its first text; where texts share
    # an id, all but one by a hash of the set
    again = nodes.groupBy("id").agg(F.min("set").alias("first"), F.count("*").alias("times")).where("times > 1")
    nodes = nodes.join(again.select("id", "first"), "id", "left").withColumn("node", F.when(
        F.coalesce(F.col("set") == F.col("first"), F.lit(True)), F.col("id")).otherwise(F.xxhash64("set"))).drop("first")
    nodes = stored(nodes, "nodes")
    sketch = nodes.select("node", "n", "registers")
    bands = arrow_column(sketch, "registers", "bands", "array<bigint>", lambda: _bands).select(
        "node", F.explode("bands").alias("band"))
    hubs = bands.groupBy("band").agg(F.min("node").alias("b"), F.count("*").alias("size")).where("size > 1")
    # from here on only buckets of several nodes. Spark counts the bands of a node as one row, and would
    # send all of them through the driver
    bands = stored(bands.join(hubs.hint("merge"), "band").select("band", "node", "b"), "bands")
    star = bands.where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    estimate = F.arrow_udf(_estimate, "double").asNondeterministic()
    one, two = (sketch.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"),
                              F.col("registers").alias(f"r_{k}")) for k in "ab")
    near = (star.join(one, "a").join(two, "b")
            .select("a", "b", estimate("r_a", "r_b", "n_a", "n_b").alias("estimate"))
            .where(F.col("estimate") >= LEAST_ESTIMATE)
            .groupBy("a").agg(F.max_by("b", F.struct("estimate", -F.col("b"))).alias("b")))
    best = stored(near, "best")
    rows = named(docs, key, text)

    def texts_with(ids: DataFrame) -> DataFrame:
        """Nodes (as id) with a text of theirs. The nodes are distinct; a semi join would be moved
        below the filter, and all texts shuffled."""
        of = stored(nodes.select("node", "id", "said").join(ids.select(F.col("id").alias("node")), "node"), "asked")
        return likely(rows, of).join(of, ["id", "said"]).groupBy(F.col("node").alias("id")).agg(
            F.any_value("text").alias("text"))

    def texts_of(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        return texts_with(ids)

    # each node has at most one link, to a lesser node
    links = stored(confirmed(best, texts_of(best)), "links")
    linked = roots(links.select(F.col("a").alias("node"), F.col("b").alias("up")))
    placed = stored(bands.select("node").distinct().join(linked, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")), "placed")

    # buckets that hold several components
    member = bands.join(placed, "node").select("band", "node", F.col("component").alias("comp"))
    mixed = member.groupBy("band").agg(
        F.min("comp").alias("least"), F.max("comp").alias("most"), F.count("*").alias("size")).where(
            "least < most").select("band", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    member = stored(member.join(mixed, "band"), "members")
    ids = member.select(F.col("node").alias("id")).distinct()
    long = stored(arrow_column(texts_with(ids), "text", "long", "binary", lambda: _long).select(
        F.col("id").alias("node"), "long").join(sketch, "node"), "long")
    order = ["band", "lo", "hi"]
    # joined while a node stands once in a bucket, as its blocks are not in Spark's estimate either
    dealt = (member.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .join(long, "node")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
             .select(*order, "node", "comp", "block", "n", "long", "registers")
             .repartition(*order).sortWithinPartitions(*order))
    late = stored(dealt.mapInArrow(_block_pairs, "a bigint, b bigint, estimate double"), "late")

    late = relabelled(late.withColumns({"x": F.col("a"), "y": F.col("b")}), placed, ["x", "y"])
    each = FIRST
    while True:
        likeliest = W.partitionBy(F.least("x", "y"), F.greatest("x", "y")).orderBy(
            F.desc("estimate"), "a", "b")
        late = stored(late.where("x <> y").withColumn("place", F.row_number().over(likeliest)), "late")
        now = late.where(F.col("place") <= each)
        if now.isEmpty():
            break
        new = stored(confirmed(now.select("a", "b"), texts_of(now)).join(now, ["a", "b"]).select(
            F.col("x").alias("a"), F.col("y").alias("b")), "links")
        late, each = late.where(F.col("place") > each).drop("place"), each * MORE
        if not new.isEmpty():
            merged = stored(components(new), "merged")
            placed = stored(relabelled(placed, merged, ["component"]), "placed")
            late = relabelled(late, merged, ["x", "y"])

    of_set = stored(nodes.select("set", "node", "id").join(placed, "node", "left").select(
        "set", "id", F.coalesce("component", "node").alias("component")), "sets")
    shared = full.groupBy("id").agg(F.min("set").alias("lo"), F.max("set").alias("hi")).where("lo <> hi").select("id")
    of_id = stored(full.join(shared, "id").select("id", "set").distinct().join(
        of_set.drop("id"), "set").groupBy("id").agg(
            F.min("component").alias("b"), F.collect_set("component").alias("all")).select(
                F.explode("all").alias("a"), "b"), "same ids")
    if not of_id.isEmpty():
        of_set = relabelled(of_set, stored(components(of_id), "merged"), ["component"])
    # a component's name is the least key of its rows
    least = stored(of_set.groupBy("component").agg(F.min("id").alias("component_id")), "least")
    of_set = of_set.join(least, "component").select("set", "component_id")
    return (sketches.select("id", "n", "set").join(of_set, "set", "left")
            .select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
            .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))))
