"""Application tracker: a log of actions folded into the current state.

Actions are (chat_id, listing_id, seq, ts, status, title, company, url); the status 'removed'
deletes the entry, and a later action starts a new one. The fold is cut into hourly slices, so
one busy entry never has to fit in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.functions.skew import SLICE, hour_slice, salted_join
from jobtide.vocab import TRACKER_STATUSES

KEY = ["chat_id", "listing_id"]
REMOVED = "removed"
META = ["title", "company", "url"]


def check_statuses(log: DataFrame) -> DataFrame:
    """Stop on an unknown status."""
    known = F.col("status").isin(*TRACKER_STATUSES, REMOVED)
    bad = F.raise_error(F.concat(F.lit("invalid status "), F.coalesce("status", F.lit("null"))))
    return log.where(F.when(F.coalesce(known, F.lit(False)), True).otherwise(bad.cast("boolean")))


def tracker_state(log: DataFrame) -> DataFrame:
    """One row per tracked listing: latest status, latest known details, first and last stamp."""
    rows = check_statuses(log).withColumns({
        "_ord": F.struct("ts", "seq"), SLICE: hour_slice(F.col("ts")),
        "_gone": F.col("status") == REMOVED})
    cut = F.max(F.when(F.col("_gone"), F.col("_ord"))).over(W.partitionBy(*KEY, SLICE))
    live = ~F.col("_gone") & (F.col("_cut").isNull() | (F.col("_ord") > F.col("_cut")))

    def latest(value: str, keep: Column) -> Column:
        order = F.when(keep & F.col(value).isNotNull(), F.col("_ord"))
        return F.struct(F.max(order).alias("o"), F.max_by(value, order).alias("v"))

    slices = rows.withColumn("_cut", cut).groupBy(*KEY, SLICE).agg(
        F.max("_cut").isNotNull().alias("_reset"),
        F.min(F.when(live, F.col("ts"))).alias("created_at"),
        F.max(F.when(live, F.col("ts"))).alias("updated_at"),
        *[latest(c, live).alias(c) for c in ["status", *META]],
    )
    # from here on there is one row per entry and hour
    last_reset = F.max(F.when(F.col("_reset"), F.col(SLICE))).over(W.partitionBy(*KEY))
    kept = (slices.withColumn("_from", last_reset)
            .where(F.col("_from").isNull() | (F.col(SLICE) >= F.col("_from"))))
    state = kept.groupBy(*KEY).agg(
        *[F.max_by(f"{c}.v", f"{c}.o").alias(c) for c in ["status", *META]],
        F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"))
    return state.where(F.col("status").isNotNull())


def tracker_list(state: DataFrame, status: str | None = None) -> DataFrame:
    """Every user's entries, newest update first. A range sort, so a busy user is split too."""
    rows = state if status is None else state.where(F.col("status") == status)
    return rows.orderBy("chat_id", F.desc("updated_at"), "listing_id")


def tracker_page(state: DataFrame, status: str | None, size: int, page: int) -> DataFrame:
    """One page per user, in an order that a status change does not disturb, and the total."""
    rows = state if status is None else state.where(F.col("status") == status)
    order = W.partitionBy("chat_id").orderBy(F.desc("created_at"), "listing_id")
    paged = rows.withColumn("position", F.row_number().over(order)).where(
        F.col("position") <= (page + 1) * size)
    totals = rows.groupBy("chat_id").agg(F.count(F.lit(1)).alias("total"))
    return paged.where(F.col("position") > page * size).join(totals, "chat_id")


def tracker_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("chat_id", "status").agg(F.count(F.lit(1)).alias("n"))


def tracked_ids(state: DataFrame) -> DataFrame:
    return state.select(*KEY)


def fill_metadata(state: DataFrame, meta: DataFrame) -> DataFrame:
    """Fill title, company and link from the snapshot where the title is missing.

    All three are replaced together, as one lookup found them; a lookup without a title
    changes nothing, and a null company or link keeps what was stored.
    """
    missing = F.coalesce(F.col("title"), F.lit("")) == ""
    found = meta.where(F.coalesce(F.col("title"), F.lit("")) != "").select(
        "listing_id", F.struct(*META).alias("_meta"))
    # one popular listing may be tracked by very many users: only tracked listings are looked
    # up, and their rows are spread
    wanted = state.where(missing).select("listing_id").distinct()
    found = found.join(wanted, "listing_id", "left_semi")
    joined = salted_join(state, found, ["listing_id"], F.col("chat_id"), "left")
    fill = missing & F.col("_meta").isNotNull()
    return joined.select(
        *[F.when(fill, F.coalesce(F.col(f"_meta.{c}"), F.col(c))).otherwise(F.col(c)).alias(c)
          if c in META else F.col(c) for c in state.columns])
