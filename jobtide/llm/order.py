"""Running totals along an order, without the rows of a key in one task, and one digest of many rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.common import stored


def _totals(kinds: list[str]) -> Callable:
    """Totals of the rows of a key before each row, inside one task; see `scanned`."""
    join = {"add": (np.add, np.subtract), "xor": (np.bitwise_xor, np.bitwise_xor)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, carry, runs = None, [0] * len(kinds), 0
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column("_key").to_numpy()
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            new[0] = key is not None and keys[0] != key
            run_of = np.cumsum(new)
            start = np.concatenate([[0], np.flatnonzero(new)]) if not new[0] else np.flatnonzero(new)
            part = run_of - run_of[0]
            out = []
            for j, kind in enumerate(kinds):
                put, take = join[kind]
                value = b.column(f"_v{j}").to_numpy()
                before = take(put.accumulate(value), value)
                before = take(before, before[start][part])
                if not new[0]:
                    open_ = part == 0
                    before[open_] = put(before[open_], np.int64(carry[j]))
                carry[j] = put(before[-1:], value[-1:])[0]
                out.append(pa.array(before, pa.int64()))
            more = pa.array(runs + run_of > 0)
            key, runs = keys[-1], runs + int(run_of[-1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *out, more], [*b.schema.names, *[f"_s{j}" for j in range(len(kinds))], "_more"])

    return run


def scanned(
    rows: DataFrame, keys: list[str], order: list[str], name: str,
    add: dict[str, Column] | None = None, xor: dict[str, Column] | None = None,
) -> DataFrame:
    """Add running totals: for each entry of `add` (or `xor`) the sum (or exclusive or) of its
    column over the rows of the same key that come before a row in the order. A place within a key
    is the sum of ones.

    Rows are dealt by ranges of (keys, order), nulls first, and rows that are alike in all of these
    by where they were read, so that neither a key nor a row that is repeated has to fit in one
    task; such rows are in any order. Each task totals its range; the driver gets two keys and the
    totals of each range and returns what is carried over the ends of ranges, a row for a range.
    The result is stored. Names with a leading underscore are replaced.
    """
    spec = [*(("add", n, c) for n, c in (add or {}).items()), *(("xor", n, c) for n, c in (xor or {}).items())]
    kinds, values = [s[0] for s in spec], {f"_v{j}": s[2].cast("long") for j, s in enumerate(spec)}
    sort = [F.col(c).asc_nulls_first() for c in [*keys, *order, "_tie"]]
    laid = rows.withColumns({**values, "_tie": F.monotonically_increasing_id(),
                             "_key": F.xxhash64(*keys) if keys else F.lit(0).cast("long")})
    laid = laid.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("_tie")
    laid = laid.withColumn("_at", F.monotonically_increasing_id())
    kind = T.StructType([*laid.schema.fields, *(T.StructField(f"_s{j}", T.LongType()) for j in range(len(spec))),
                         T.StructField("_more", T.BooleanType())])
    laid = stored(laid.mapInArrow(_totals(kinds), kind), name)
    whole = [F.struct(f"_s{j}", f"_v{j}").alias(f"_s{j}") for j in range(len(spec))]
    part = F.shiftright("_at", 33)  # where the id of a row has its task
    ends = laid.groupBy(part.alias("part")).agg(
        F.min_by("_key", "_at").alias("first"), F.max_by(F.struct("_key", "_more", *whole), "_at").alias("last"))
    put = {"add": lambda a, b: (a + b + (1 << 63)) % (1 << 64) - (1 << 63), "xor": lambda a, b: a ^ b}
    carried, key, tail = [], None, [0] * len(spec)
    for r in ends.orderBy("part").collect():
        come = tail if r.first == key else [0] * len(spec)
        carried.append((r.part, *come))
        tail = [put[k](*r.last[f"_s{j}"]) for j, k in enumerate(kinds)]
        if not r.last["_more"]:
            tail = [put[k](x, y) for k, x, y in zip(kinds, tail, come)]
        key = r.last["_key"]
    starts = rows.sparkSession.createDataFrame(
        carried, "_part long" + "".join(f", _c{j} long" for j in range(len(spec))))
    found = laid.withColumn("_part", part).join(F.broadcast(starts), "_part")
    total = {}
    for j, (how, n, _) in enumerate(spec):
        s, c = F.col(f"_s{j}"), F.col(f"_c{j}")
        total[n] = F.when(F.col("_more"), s).otherwise(s + c if how == "add" else s.bitwiseXOR(c))
    return found.select(*[c for c in rows.columns if c not in total], *[v.alias(n) for n, v in total.items()])


def folded(
    rows: DataFrame, key: str, order: list[str], make: Callable[[], Callable], schema: str,
) -> DataFrame:
    """One row for each key, folded from its rows in order.

    `make()` gives a function of (column lists, from, to) that is called for each run of rows of a
    key and returns None, and with None for the end of the key, when it returns the values of the
    output row; then a new one is made. A key's rows come sorted and in batches, so that a digest over
    a key with very many rows needs no more memory than a batch, but time in one task.
    """
    names = rows.columns
    kind = T.StructType([rows.schema[key], *T._parse_datatype_string(schema).fields])
    arrow = rows.limit(0).select(key).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, work, out = None, None, []

        def block() -> pa.RecordBatch:
            columns = list(zip(*out))
            fixed = [pa.array(list(columns[0]), arrow), *[pa.array(list(c)) for c in columns[1:]]]
            return pa.RecordBatch.from_arrays(fixed, [f.name for f in kind.fields])

        for b in batches:
            lists = {n: b.column(n).to_pylist() for n in names}
            marks, at = lists[key], 0
            while at < len(marks):
                end = at + 1
                while end < len(marks) and marks[end] == marks[at]:
                    end += 1
                if work is None or now != marks[at]:
                    if work is not None:
                        out.append((now, *work(None, 0, 0)))
                    now, work = marks[at], make()
                work(lists, at, end)
                at = end
            if len(out) >= 1024:
                yield block()
                out = []
        if work is not None:
            out.append((now, *work(None, 0, 0)))
        if out:
            yield block()

    sort = [F.col(c).asc_nulls_first() for c in [key, *order]]
    return rows.repartition(F.col(key)).sortWithinPartitions(*sort).mapInArrow(run, kind)
