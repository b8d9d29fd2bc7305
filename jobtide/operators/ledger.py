"""Subscription ledger: payment events folded into the state at a point in time.

Events are (chat_id, seq, ts, kind, charge_id, tier) with the kinds charge, trial, refund,
revoke and reminder. Each step is a closed form over windows inside (user, hour); only hourly
summaries are grouped by user, so a very busy account is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.functions.skew import SLICE, hour_slice, salted_join
from jobtide.session import settle
from jobtide.vocab import (
    FREE_CAP, GRACE_DAYS, REMIND_COOLDOWN_SECONDS, REMIND_DAYS, TIERS, TRIAL_DAYS, TRIAL_TIER,
)

DAY = 86_400_000_000  # microseconds


def tier_value(tier: Column, field: str, default: int | None = None) -> Column:
    out = F.lit(default)
    for name, spec in TIERS.items():
        out = F.when(tier == name, F.lit(spec[field])).otherwise(out)
    return out


def tier_features(tier: Column) -> Column:
    out = F.array().cast("array<string>")
    for name, spec in TIERS.items():
        out = F.when(tier == name, F.array(*[F.lit(x) for x in spec["features"]])).otherwise(out)
    return out


# ---------------------------------------------------------------- payments
def _moment() -> Column:
    return F.struct("ts", "seq")


def payments(events: DataFrame) -> DataFrame:
    """First event of each charge, with the first valid refund after it.

    A repeated charge changes nothing; a refund of an unknown charge does nothing, and only the
    first refund of a charge counts.
    """
    charges = events.where((F.col("kind") == "charge") & F.col("tier").isin(list(TIERS)))
    first = (
        charges.withColumn("_n", F.row_number().over(
            W.partitionBy("charge_id").orderBy("ts", "seq")))
        .where("_n = 1")
        .select("charge_id", "chat_id", "tier", _moment().alias("paid"))
    )
    refunds = events.where("kind = 'refund'").select("charge_id", _moment().alias("asked"))
    # only charges with a refund request are repeated for the salted join
    in_question = first.select("charge_id", "paid").join(
        refunds.select("charge_id").distinct(), "charge_id", "left_semi")
    valid = (
        salted_join(refunds, in_question, ["charge_id"], F.col("asked.seq"))
        .where(F.col("asked") > F.col("paid"))
        .groupBy("charge_id").agg(F.min("asked").alias("refunded"))
    )
    return first.join(valid, "charge_id", "left").withColumn(
        "stars", tier_value(F.col("tier"), "stars"))


def payment_list(paid: DataFrame) -> DataFrame:
    return paid.select("charge_id", "chat_id", "tier", "stars", F.col("paid.ts").alias("paid_at"),
                       F.col("refunded.ts").alias("refunded_at"))


def _cuts(events: DataFrame, paid: DataFrame) -> DataFrame:
    """Moments at which a user's subscription ends: valid refunds and revocations."""
    refunded = paid.where(F.col("refunded").isNotNull()).select(
        "chat_id", F.col("refunded").alias("at"))
    revoked = events.where("kind = 'revoke'").select("chat_id", _moment().alias("at"))
    return refunded.unionByName(revoked)


# ---------------------------------------------------------------- trials
def trials(events: DataFrame, paid: DataFrame) -> DataFrame:
    """The one trial of each user that was granted.

    A trial is granted if the user has no subscription row at that moment and had no trial
    before, that is, if nothing but a cut (or nothing at all) comes right before it; the first
    such request is the one.
    """
    asked = events.where("kind = 'trial'").select("chat_id", _moment().alias("at"))
    line = (
        paid.select("chat_id", F.col("paid").alias("at"), F.lit("grant").alias("what"))
        .unionByName(asked.withColumn("what", F.lit("trial")))
        .unionByName(_cuts(events, paid).withColumn("what", F.lit("cut")))
        .withColumn(SLICE, hour_slice(F.col("at.ts")))
    )
    before = F.lag("what").over(W.partitionBy("chat_id", SLICE).orderBy("at"))
    hours = line.withColumn("_before", before).groupBy("chat_id", SLICE).agg(
        F.min("at").alias("start"), F.min_by("what", "at").alias("opens_with"),
        F.max_by("what", "at").alias("ends_with"),
        F.min(F.when((F.col("what") == "trial") & (F.col("_before") == "cut"), F.col("at")))
        .alias("inside"))
    handed = F.lag("ends_with").over(W.partitionBy("chat_id").orderBy(SLICE))
    at_start = F.when((F.col("opens_with") == "trial")
                      & (F.coalesce(F.col("_handed"), F.lit("cut")) == "cut"), F.col("start"))
    return (
        hours.withColumn("_handed", handed)
        .withColumn("granted", F.coalesce(at_start, F.col("inside")))
        .groupBy("chat_id").agg(F.min("granted").alias("granted"))
        .where(F.col("granted").isNotNull())
    )


# ---------------------------------------------------------------- state
def subscriptions(events: DataFrame, paid: DataFrame) -> DataFrame:
    """Subscription rows: tier, expiry and last reminder of users who hold one.

    Paying again extends from the later of now and the current expiry. With S the running sum
    of granted time this folds to  expiry = S_n + max over j of (t_j - S_(j-1)),  which splits
    into hourly parts: each part gives its sum and its own maximum, and the parts combine in
    the same way.
    """
    extra = F.lit(None)
    line = (
        paid.select("chat_id", F.col("paid").alias("at"), F.lit("grant").alias("what"), "tier",
                    (tier_value(F.col("tier"), "days") * F.lit(DAY)).cast("bigint").alias("span"))
        .unionByName(trials(events, paid).select(
            "chat_id", F.col("granted").alias("at"), F.lit("grant").alias("what"),
            F.lit(TRIAL_TIER).alias("tier"), F.lit(TRIAL_DAYS * DAY).cast("bigint").alias("span")))
        .unionByName(_cuts(events, paid).select(
            "chat_id", "at", F.lit("cut").alias("what"), extra.cast("string").alias("tier"),
            extra.cast("bigint").alias("span")))
        .unionByName(events.where("kind = 'reminder'").select(
            "chat_id", _moment().alias("at"), F.lit("reminder").alias("what"),
            extra.cast("string").alias("tier"), extra.cast("bigint").alias("span")))
        .withColumn(SLICE, hour_slice(F.col("at.ts")))
    )
    part = W.partitionBy("chat_id", SLICE)
    line = line.withColumn("_cut", F.max(F.when(F.col("what") == "cut", F.col("at"))).over(part))
    alive = F.col("_cut").isNull() | (F.col("at") > F.col("_cut"))
    grant = alive & (F.col("what") == "grant")
    line = line.withColumn("_span", F.when(grant, F.col("span")).otherwise(F.lit(0)))
    earlier = F.coalesce(F.sum("_span").over(
        part.orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    line = line.withColumn("_lead", F.when(grant, F.unix_micros("at.ts") - earlier))
    hours = line.groupBy("chat_id", SLICE).agg(
        F.max("_cut").isNotNull().alias("_reset"),
        F.sum("_span").alias("span"), F.max("_lead").alias("lead"),
        F.min(F.when(grant, F.col("at"))).alias("opened"),
        F.max(F.when(grant, F.col("at"))).alias("renewed"),
        F.max_by("tier", F.when(grant, F.col("at"))).alias("tier"),
        F.max(F.when(alive & (F.col("what") == "reminder"), F.col("at"))).alias("reminded"))
    whole = W.partitionBy("chat_id")
    kept = (hours.withColumn("_from", F.max(F.when(F.col("_reset"), F.col(SLICE))).over(whole))
            .where(F.col("_from").isNull() | (F.col(SLICE) >= F.col("_from"))))
    sums = F.coalesce(F.sum("span").over(
        whole.orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    users = kept.withColumn("_before", sums).groupBy("chat_id").agg(
        (F.sum("span") + F.max(F.col("lead") - F.col("_before"))).alias("expiry"),
        F.max_by("tier", "renewed").alias("tier"), F.min("opened").alias("opened"),
        F.max("renewed").alias("renewed"), F.max("reminded").alias("reminded"))
    # a reminder is kept only while a subscription row exists
    noted = F.when(F.col("reminded") > F.col("opened"), F.col("reminded.ts"))
    return users.where(F.col("opened").isNotNull()).select(
        "chat_id", "tier", F.timestamp_micros("expiry").alias("expires_at"),
        F.col("renewed.ts").alias("updated_at"), noted.alias("last_reminded_at"))


def lifecycle(expires_at: Column, as_of: Column) -> Column:
    """active, grace, or null once the grace period is over."""
    grace_end = expires_at + F.expr(f"interval {GRACE_DAYS} days")
    return (F.when(as_of < expires_at, "active").when(as_of < grace_end, "grace"))


def subscription_state(events: DataFrame, as_of: Column) -> DataFrame:
    """Rows as of a moment, with status, rank, listing cap and features.

    The payments are read by several steps, so they are computed once and stored.
    """
    past = events.where(F.col("ts") <= as_of)
    rows = subscriptions(past, settle(payments(past))).withColumn(
        "status", lifecycle(F.col("expires_at"), as_of))
    open_tier = F.when(F.col("status").isNotNull(), F.col("tier"))
    return rows.withColumns({
        "in_grace": F.coalesce(F.col("status") == "grace", F.lit(False)),
        "rank": F.coalesce(tier_value(open_tier, "rank"), F.lit(0)),
        "cap": F.coalesce(tier_value(open_tier, "max_listings"), F.lit(FREE_CAP)),
        "features": tier_features(open_tier),
    })


def is_subscribed(tier: str | None = None) -> Column:
    return F.col("rank") >= (1 if tier is None else TIERS[tier]["rank"])


def has_feature(feature: str) -> Column:
    return F.array_contains("features", feature)


def listing_caps(state: DataFrame) -> DataFrame:
    """Caps by user; users without a row, or with no numeric id, fall back to the free cap."""
    return state.select(F.col("chat_id").cast("string").alias("chat_id"), "cap")


def due_for_reminder(state: DataFrame, as_of: Column) -> DataFrame:
    """Who gets a renewal nudge now: near expiry every 20 hours, after expiry once."""
    last = F.col("last_reminded_at")
    near = F.col("expires_at") - F.expr(f"interval {REMIND_DAYS} days") <= as_of
    waited = (F.unix_micros(as_of) - F.unix_micros(last)) > REMIND_COOLDOWN_SECONDS * 1_000_000
    due = F.when(F.col("status") == "grace",
                 F.coalesce(last < F.col("expires_at"), F.lit(True))
                 ).otherwise(F.coalesce(waited, F.lit(True)))
    return (state.where(F.col("status").isNotNull() & near & due)
            .select("chat_id", "tier", "expires_at", "status"))


# ---------------------------------------------------------------- invoices
def payload(tier: Column, chat_id: Column) -> Column:
    return F.concat_ws(":", F.lit("sub"), tier, chat_id.cast("string"))


def tier_of_payload(text: Column) -> Column:
    parts = F.split(text, ":")
    tier = F.get(parts, F.lit(1))
    return F.when((F.get(parts, F.lit(0)) == "sub") & tier.isin(list(TIERS)), tier)
