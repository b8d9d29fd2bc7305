"""Matching users with listings, skill ranking and the daily digest.

The listing side is the pool of the newest listings, a fixed number of rows by definition; users
are the side that grows. The pair work is an equi-join on seniority, not a product, and where only
passing pairs are wanted on seniority and a value that both have. A pool is sent to every task
once its row count has been checked; a larger listing side is joined through salted keys instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.functions.skew import is_small, salted_join
from jobtide.functions.text import html_escape, lower_set, no_strings, offer_url, strip, truthy
from jobtide.operators.serving import SNAPSHOT_ORDER
from jobtide.vocab import FREE_CAP, OFFER_URL, POOL_SIZE, TIERS

LISTS = ("technologies", "required_skills", "nice_to_have_skills")


def newest_pool(snapshot: DataFrame, size: int = POOL_SIZE) -> DataFrame:
    """The newest `size` snapshot rows with their place in that order."""
    order = [F.desc_nulls_last("posted_date")] + [F.asc_nulls_last(c) for c in SNAPSHOT_ORDER]
    return (snapshot.orderBy(*order).limit(size)
            .withColumn("pool_rank", F.row_number().over(W.orderBy(*order))))


# ---------------------------------------------------------------- listing side
def _kinds(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.typeName() for f in df.schema.fields}


def _variant_fields(df: DataFrame) -> list[str]:
    if _kinds(df).get("salary_variants") != "array":
        return []
    return df.schema["salary_variants"].dataType.elementType.names


def listing_techs(df: DataFrame) -> Column:
    """All technology names of a listing; a plain text value is one name."""
    kinds, parts = _kinds(df), [no_strings()]
    for name in LISTS:
        if kinds.get(name) == "array":
            parts.append(F.filter(F.coalesce(F.col(name), no_strings()), truthy))
        elif kinds.get(name) == "string":
            parts.append(F.when(truthy(F.col(name)), F.array(name)).otherwise(no_strings()))
    return F.concat(*parts)


def ranked_techs(df: DataFrame) -> Column:
    """Lower-case technology set for ranking; here a plain text value is split on commas."""
    kinds, parts = _kinds(df), [no_strings()]
    for name in LISTS:
        c = F.coalesce(F.col(name), no_strings()) if kinds.get(name) == "array" else None
        if kinds.get(name) == "string":
            c = F.split(F.coalesce(name, F.lit("")), ",")
        if c is not None:
            clean = F.transform(F.filter(c, truthy), lambda t: F.lower(strip(t)))
            parts.append(clean if kinds[name] == "array" else F.filter(clean, truthy))
    return F.array_distinct(F.concat(*parts))


def listing_types(df: DataFrame) -> Column:
    """Employment types from the variants and from the direct column."""
    kinds, parts = _kinds(df), [no_strings()]
    if "employment_type" in _variant_fields(df):
        parts.append(F.coalesce(F.filter(
            F.transform("salary_variants", lambda v: v["employment_type"]), truthy), no_strings()))
    if "employment_type" in kinds:
        c = F.col("employment_type")
        parts.append(F.when(truthy(c), F.array(c)).otherwise(no_strings()))
    return F.concat(*parts)


def _whole_number(c: Column, kind: str) -> Column:
    """Truncate numbers; text counts only if it is written as a whole number."""
    if kind == "string":
        return F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c).try_cast("bigint"))
    return c.cast("bigint")


def max_salary(df: DataFrame) -> Column:
    """Highest pay: the direct column, else the best variant, else null (undisclosed)."""
    kinds, options = _kinds(df), []
    if "salary_max" in kinds:
        options.append(_whole_number(F.col("salary_max"), kinds["salary_max"]))
    if "salary_max" in _variant_fields(df):
        kind = df.schema["salary_variants"].dataType.elementType["salary_max"].dataType.typeName()
        options.append(F.array_max(F.transform(
            "salary_variants", lambda v: _whole_number(v["salary_max"], kind))))
    return F.coalesce(*options) if options else F.lit(None).cast("bigint")


def listing_cities(df: DataFrame) -> Column:
    if "cities" not in df.columns:
        return no_strings()
    if _kinds(df).get("cities") == "string":
        return F.when(truthy(F.col("cities")), F.array("cities")).otherwise(no_strings())
    return F.coalesce(F.col("cities"), no_strings())


# ---------------------------------------------------------------- match
def _listing_side(listings: DataFrame) -> dict[str, Column]:
    def low(name: str) -> Column:
        return F.lower(F.coalesce(name, F.lit(""))) if name in listings.columns else F.lit("")

    return {
        "_techs": lower_set(listing_techs(listings)), "_types": lower_set(listing_types(listings)),
        "_pay": max_salary(listings), "_cities": lower_set(listing_cities(listings)),
        "_category": low("category"), "_workplace": low("workplace_type"),
        "_seniority": low("seniority"),
    }


def _user_side(value: Callable[[str], Column]) -> dict[str, Column]:
    """Wanted values; `value` gives a setting by name."""
    lists = ("technologies", "categories", "workplace_types", "employment_types", "cities")
    return ({f"_want_{n}": lower_set(value(n)) for n in lists}
            | {"_floor": value("salary_min"), "_tolerance": value("tolerance")})


def _misses() -> Column:
    """Number of active filters a pair misses. Undisclosed pay is no miss."""
    def missed(wants: str, hit: Column) -> Column:
        return F.when((F.size(wants) > 0) & ~hit, 1).otherwise(0)

    return (
        missed("_want_technologies", F.arrays_overlap("_techs", "_want_technologies"))
        + missed("_want_categories", F.array_contains("_want_categories", F.col("_category")))
        + missed("_want_workplace_types",
                 F.array_contains("_want_workplace_types", F.col("_workplace")))
        + missed("_want_employment_types", F.arrays_overlap("_types", "_want_employment_types"))
        + F.when((F.col("_floor") > 0) & (F.col("_pay") < F.col("_floor")), 1).otherwise(0)
        + missed("_want_cities", F.arrays_overlap("_cities", "_want_cities"))
    )


def _sides(pool: DataFrame, users: DataFrame, keep: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Listings and users by the key of seniority.

    Seniority is a hard filter, so it is the join key: each user is listed under every accepted
    seniority, or under 'any' if the list is empty; each listing under its own and under 'any'.
    """
    side = pool.withColumns(_listing_side(pool)).withColumn(
        "_key", F.explode(F.array(F.concat(F.lit("="), "_seniority"), F.lit("any"))))
    accepted = F.array_distinct(F.transform("seniorities", lambda s: F.concat(F.lit("="), s)))
    keys = F.when(F.size("seniorities") > 0, accepted).otherwise(F.array(F.lit("any")))
    return side, users.select(
        "chat_id", *keep, *[c.alias(n) for n, c in _user_side(F.col).items()],
        F.explode(keys).alias("_key"))


def _paired(pool: DataFrame, side: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    if is_small(pool):
        return wanted.join(F.broadcast(side), keys)
    # few keys, many users: spread the users of each
    return salted_join(wanted, side, keys, F.col("chat_id"), salts=64)


def match(pool: DataFrame, users: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pairs whose seniority fits, with the number of missed filters and the verdict.

    `keep` names further user columns to carry along.
    """
    pairs = _paired(pool, *_sides(pool, users, keep), ["_key"])
    return (pairs.withColumn("mismatches", _misses())
            .withColumn("passes", F.col("mismatches") <= F.col("_tolerance"))
            .select("chat_id", *keep, *pool.columns, "mismatches", "passes"))


# filters of which a value can be looked up, those that tell most apart first, and what they look at
_LOOKED_UP = {
    "technologies": "_techs", "cities": "_cities", "categories": "array(_category)",
    "employment_types": "_types", "workplace_types": "array(_workplace)",
}
EVERY, UNKNOWN = "", "?"


def _postings(name: str, values: Column) -> Column:
    return F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: F.concat(F.lit(f"{name}="), v))


def candidates(pool: DataFrame, users: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of fitting seniority that may pass, each once.

    A user who tolerates t misses passes a listing only if at least one of any t + 1 active
    filters is hit. So listings are posted under each of their values, users look up the values of
    their first t + 1 filters, and users with at most t filters all listings. A null among the
    wanted values, or among a listing's, is never a miss: such a filter is passed over, and such a
    listing is looked up by everybody.
    """
    side, wanted = _sides(pool, users, keep)
    unknown = F.exists(F.concat("_techs", "_types", "_cities"), lambda v: v.isNull())
    posted = F.array_distinct(F.concat(
        F.array(F.lit(EVERY)), F.when(unknown, F.array(F.lit(UNKNOWN))).otherwise(no_strings()),
        *[_postings(name, F.expr(values)) for name, values in _LOOKED_UP.items()]))
    asked = F.filter(F.array(*[
        F.when(~F.exists(f"_want_{n}", lambda v: v.isNull()), _postings(n, F.col(f"_want_{n}")))
        for n in _LOOKED_UP]), lambda values: F.size(values) > 0)
    first = F.slice("_asked", 1, F.greatest(F.col("_tolerance") + 1, F.lit(0)).cast("int"))
    wanted = wanted.withColumn("_asked", asked).withColumn("_asked", F.when(
        F.size("_asked") > F.col("_tolerance"), F.concat(F.flatten(first), F.array(F.lit(UNKNOWN))))
        .otherwise(F.array(F.lit(EVERY)))).withColumn("_hit", F.explode("_asked"))
    side = side.withColumn("_posted", posted).withColumn("_hit", F.explode("_posted"))
    pairs = _paired(pool, side, wanted, ["_key", "_hit"])
    # a pair that meets under several values is told under the first that the user asked for
    return pairs.where(F.col("_hit") == F.get(F.array_intersect("_asked", "_posted"), F.lit(0)))


def passing(pool: DataFrame, users: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The pairs of `match` that pass, found among the candidates only."""
    return (candidates(pool, users, keep).withColumn("mismatches", _misses())
            .where(F.col("mismatches") <= F.col("_tolerance"))
            .select("chat_id", *keep, *pool.columns, "mismatches"))


def judge(listings: DataFrame, config: dict) -> DataFrame:
    """One user's verdict on every listing of any frame; -1 where the seniority does not fit.

    The settings are literals of the plan, so there is no join at all.
    """
    def value(name: str) -> Column:
        v = config.get(name, {"salary_min": 0, "tolerance": 1}.get(name, []))
        return F.array(*[F.lit(x) for x in v]).cast("array<string>") if isinstance(v, list) \
            else F.lit(v)

    rows = listings.withColumns(_listing_side(listings) | _user_side(value))
    wanted = config.get("seniorities", [])
    fits = F.col("_seniority").isin(wanted) if wanted else F.lit(True)
    return (rows.withColumn("mismatches", F.when(fits, _misses()).otherwise(-1))
            .withColumn("passes", fits & (F.col("mismatches") <= F.col("_tolerance")))
            .select(*listings.columns, "mismatches", "passes"))


# ---------------------------------------------------------------- skill ranking
def rank_by_skills(matches: DataFrame, users: DataFrame) -> DataFrame:
    """Add the share of a listing's technologies the user has, and which ones.

    Users without skills keep their rows and get no percentage.
    """
    mine = users.select("chat_id", F.col("skills").alias("_skills"))
    return _with_share(matches.join(mine, "chat_id", "left"), "_skills").drop("_skills")


def _with_share(rows: DataFrame, skills: str) -> DataFrame:
    wanted = F.array_distinct(F.filter(
        F.transform(skills, lambda s: F.lower(strip(s))), truthy))
    rows = rows.withColumns({"_techs": ranked_techs(rows), "_wanted": wanted})
    hits = F.array_sort(F.array_intersect("_techs", "_wanted"))
    total = F.size("_techs")
    pct = F.when(total > 0, F.bround(100 * F.size(hits) / total, 0)).otherwise(0).cast("bigint")
    has_skills = F.coalesce(F.size("_wanted") > 0, F.lit(False))
    return rows.withColumns({
        "match_pct": F.when(has_skills, pct), "matched_skills": F.when(has_skills, hits),
    }).drop("_techs", "_wanted")


# ---------------------------------------------------------------- digest and latest
def max_cap() -> int:
    return max(FREE_CAP, *(t["max_listings"] for t in TIERS.values()))


def _listed_before(pairs: DataFrame, pool: DataFrame) -> DataFrame:
    """Per user, the listings of the pool that a log of (listing_id, chat_id) names.

    The log is narrowed to the pool first, so a set holds at most the listings of one pool.
    """
    listings = pool.select("listing_id").distinct()
    if is_small(pool):
        listings = F.broadcast(listings)
    return (pairs.select("listing_id", "chat_id").join(listings, "listing_id", "left_semi")
            .groupBy("chat_id").agg(F.collect_set("listing_id").alias("_listed")))


def _prepared(pool: DataFrame, users: DataFrame, log: DataFrame, caps: DataFrame) -> DataFrame:
    """Matching pairs with the user's cap, skills and logged listings.

    All of these are joined to the one row of a user before pairs are formed, so no pair is
    shuffled to be compared with the log.
    """
    side = (users.join(caps.select("chat_id", "cap"), "chat_id", "left")
            .join(_listed_before(log, pool), "chat_id", "left"))
    return passing(pool, side, ("cap", "skills", "_listed"))


def _unlisted() -> Column:
    return ~F.coalesce(F.array_contains("_listed", F.col("listing_id")), F.lit(False))


def _capped(rows: DataFrame) -> DataFrame:
    """First rows per user up to the user's own cap. A user has at most one pool of rows."""
    place = F.row_number().over(W.partitionBy("chat_id").orderBy("pool_rank"))
    return (rows.withColumn("_n", place).where(F.col("_n") <= max_cap())
            .where(F.col("_n") <= F.coalesce("cap", F.lit(FREE_CAP))).drop("_n"))


def _slotted(rows: DataFrame) -> DataFrame:
    order = W.partitionBy("chat_id").orderBy(F.desc_nulls_last("match_pct"), "pool_rank")
    ranked = _with_share(rows, "skills").drop("cap", "skills", "_listed")
    return ranked.withColumn("slot", F.row_number().over(order))


def digest(pool: DataFrame, users: DataFrame, sent: DataFrame, caps: DataFrame) -> DataFrame:
    """What every user is to be told now: matches not sent before, capped, then ranked."""
    return _slotted(_capped(_prepared(pool, users, sent, caps).where(_unlisted())))


def without_news(pool: DataFrame, users: DataFrame, told: DataFrame) -> DataFrame:
    """Users to be told that there is nothing new; nobody if the pool is empty."""
    some = pool.select(F.count(F.lit(1))).scalar() > 0
    return users.select("chat_id").join(told.select("chat_id"), "chat_id", "left_anti").where(some)


def latest(pool: DataFrame, users: DataFrame, tracked: DataFrame, caps: DataFrame) -> DataFrame:
    """Matches on demand. Tracked listings go after the cap, so fewer than the cap may stay."""
    return _slotted(_capped(_prepared(pool, users, tracked, caps)).where(_unlisted()))


def alert_text(rows: DataFrame) -> Column:
    """The message of one listing. A null value is written as 'None', as it is sent today."""
    def shown(c: Column) -> Column:
        return html_escape(F.coalesce(c.cast("string"), F.lit("None")))

    cities = F.when(F.size("cities") > 0, F.array_join("cities", ", ")).when(
        F.col("cities").isNotNull(), "Remote")
    techs = F.when(F.col("technologies").isNotNull(),
                   F.array_join(F.slice("technologies", 1, 8), ", ")).otherwise(F.lit("N/A"))
    low, high = F.col("salary_min"), F.col("salary_max")
    paid = low.isNotNull() & high.isNotNull() & (low != 0) & (high != 0)
    pay = F.when(paid, F.concat(
        low.cast("bigint"), F.lit("-"), high.cast("bigint"), F.lit(" "),
        F.coalesce("currency", F.lit("None")), F.lit(" ("),
        F.coalesce("employment_type", F.lit("None")), F.lit(")"))).otherwise(F.lit("Undisclosed"))
    head = F.when(F.col("match_pct").isNotNull(),
                  F.concat(F.lit("🎯 "), F.col("match_pct"), F.lit("% skill match\n")))
    link = F.concat(F.lit("\n"), offer_url(F.col("slug"), OFFER_URL))
    blank = F.lit("")
    return F.concat(
        F.coalesce(head, blank), F.lit("<b>"), shown(F.col("title")), F.lit("</b>\n"),
        shown(F.col("company_name")), F.lit(" | "), shown(cities), F.lit(" | "),
        shown(F.col("workplace_type")), F.lit("\n"), shown(pay), F.lit("\n"), shown(techs),
        F.coalesce(link, blank))
