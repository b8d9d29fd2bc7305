"""Helpers that keep one hot key from landing in one task.

Ordered work per key (last value before an event, running sums) is cut into time slices: the
window runs inside (key, slice), a small summary per slice is combined in a second step, and
only that summary is ever grouped by the bare key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from jobtide.session import settle

SLICE = "_slice"


def hour_slice(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def with_last_before(
    df: DataFrame, key: str, order: Column, value: Column, slice_of: Column, name: str,
) -> DataFrame:
    """Add the last non-null `value` seen strictly before each row of its key."""
    rows = df.withColumn("_ord", order).withColumn("_val", value).withColumn(SLICE, slice_of)
    inside = (W.partitionBy(key, SLICE).orderBy("_ord")
              .rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_near", F.last("_val", ignorenulls=True).over(inside))
    ends = rows.groupBy(key, SLICE).agg(
        F.max_by("_val", F.when(F.col("_val").isNotNull(), F.col("_ord"))).alias("_end"))
    carried = ends.select(key, SLICE, F.last("_end", ignorenulls=True).over(
        W.partitionBy(key).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)).alias("_carry"))
    return (rows.join(carried, [key, SLICE], "left")
            .withColumn(name, F.coalesce("_near", "_carry"))
            .drop("_ord", "_val", "_near", "_carry", SLICE))


def with_last_in_line(df: DataFrame, order: Column, value: Column, name: str) -> DataFrame:
    """Add the last non-null `value` before each row, in one order over all rows.

    Rows are dealt by ranges of the order; each range is read by itself, and what is carried over
    the ends of ranges has one row for a range.
    """
    laid = settle(df.withColumn("_ord", order).withColumn("_val", value).repartitionByRange("_ord")
                  .withColumn("_part", F.spark_partition_id()))
    inside = W.partitionBy("_part").orderBy("_ord").rowsBetween(W.unboundedPreceding, -1)
    end = F.max_by("_val", F.when(F.col("_val").isNotNull(), F.col("_ord")))
    ends = laid.groupBy("_part").agg(end.alias("_end"))
    every = ends.agg(F.sort_array(F.collect_list(F.struct("_part", "_end")))).scalar()
    before = F.filter("_every", lambda e: (e["_part"] < F.col("_part")) & e["_end"].isNotNull())
    carried = ends.withColumn("_every", every).select(
        "_part", F.try_element_at(before, F.lit(-1))["_end"].alias("_carry"))
    return (laid.withColumn("_near", F.last("_val", ignorenulls=True).over(inside))
            .join(F.broadcast(carried), "_part", "left")
            .withColumn(name, F.coalesce("_near", "_carry"))
            .drop("_near", "_carry", "_ord", "_val", "_part"))


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread: Column, how: str = "inner",
    salts: int = 16,
) -> DataFrame:
    """Equi-join in which each left key is spread over `salts` tasks.

    `right` is the smaller side; it is repeated once per salt. `spread` is any left column that
    differs within a hot key.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: list[str], spread: Column) -> DataFrame:
    """Left join with a lookup table: sent to every task if it has few rows, else salted, since a
    few dozen names may stand for all rows."""
    if is_small(lookup):
        return rows.join(F.broadcast(lookup), keys, "left")
    return salted_join(rows, lookup, keys, spread, "left")


def is_small(df: DataFrame, rows: int = 10_000) -> bool:
    """Does the frame hold so few rows that every task may have a copy?"""
    return df.limit(rows + 1).count() <= rows
