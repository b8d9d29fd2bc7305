"""Exact quantiles by rank, without the values of a group in one buffer.

Values are counted by ranges that hold a thousandth of an octave each. Running counts over the
ranges of a group say which of them hold the asked ranks; only the values of these, a few ranges a
group, are then put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PARTS = 1024
RANGE = "_range"


def value_range(value: Column) -> Column:
    """Number of the range of a value; it grows with the value. Zero and negative values count
    down from the ranges of their opposites."""
    size = F.abs(value)
    octave = F.floor(F.log2(size))
    part = F.floor((size / F.pow(F.lit(2.0), octave) - 1) * PARTS)
    place = (octave + 2000) * PARTS + part
    return F.when(size == 0, F.lit(0).cast("long")).otherwise(F.when(value > 0, place).otherwise(-place))


def quantiles(folded: DataFrame, group: list[str], value: str, count: str, asked: list[float],
              names: list[str], few_groups: bool = False) -> DataFrame:
    """The asked quantiles of each group, between ranks by linear interpolation.

    `folded` has a row for each distinct value of a group and how often it occurs. Groups are told
    apart as in a grouping, so a null is a group as well. Values are numbers, without nulls. With
    `few_groups` the ranges that hold the ranks go to every task, and the other values are not shuffled.
    """
    keys = [f"_g{i}" for i in range(len(group))]
    ranged = folded.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(value).alias("_x"),
                           F.col(count).alias("_n"), value_range(F.col(value)).alias(RANGE))
    counts = ranged.groupBy(*keys, RANGE).agg(F.sum("_n").alias("_c"))
    # a group has at most PARTS rows an octave here, however many values it has
    line = W.partitionBy(*keys).orderBy(RANGE)
    places = counts.select(
        *keys, RANGE, "_c",
        F.coalesce(F.sum("_c").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_c").over(W.partitionBy(*keys)).alias("_all"))

    def ranks(q: float) -> tuple[Column, Column, Column]:
        at = (F.col("_all") - 1) * F.lit(q)
        return at, F.floor(at), F.ceil(at)

    def holds(rank: Column, start: Column, n: Column) -> Column:
        return (start <= rank) & (rank < start + n)

    wanted = [rank for q in asked for rank in ranks(q)[1:]]
    hit = F.lit(False)
    for rank in wanted:
        hit = hit | holds(rank, F.col("_before"), F.col("_c"))
    found = places.where(hit).drop("_c").withColumnsRenamed({k: f"{k}h" for k in keys})
    same = F.col(RANGE) == F.col("_r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}h"))
    found = found.withColumnRenamed(RANGE, "_r")
    met = ranged.join(F.broadcast(found) if few_groups else found, same)
    inside = W.partitionBy(*keys, RANGE).orderBy("_x").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    ordered = met.select(*keys, "_x", "_n", "_all", start.alias("_start"))
    at_rank = lambda rank: F.max(F.when(holds(rank, F.col("_start"), F.col("_n")), F.col("_x")))
    picked = ordered.groupBy(*keys, "_all").agg(
        *[at_rank(rank).alias(f"_q{i}") for i, rank in enumerate(wanted)])
    out = []
    for i, (q, name) in enumerate(zip(asked, names)):
        at, low, high = ranks(q)
        a, b = F.col(f"_q{2 * i}"), F.col(f"_q{2 * i + 1}")
        between = (high - at) * a + (at - low) * b
        out.append(F.when((low == high) | (a == b), a).otherwise(between).alias(name))
    return picked.select(*[F.col(k).alias(g) for g, k in zip(group, keys)], *out)
