"""Lookups over the marts. Each answers for all keys at once; one key is a filter on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.functions.pay import basis_label, contract_basis
from jobtide.functions.text import offer_url
from jobtide.vocab import MONTHLY_TYPES, OFFER_URL, SENIORITIES, STALE_SECONDS


def whole(c: Column) -> Column:
    """Round half to even, as the reports do."""
    return F.bround(c, 0).cast("bigint")


def _top(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    """First n rows per key; the limit is applied before the shuffle as well."""
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)


def after_first(mart: DataFrame, col: str) -> DataFrame:
    """Without the bootstrap period, the first one of the whole mart."""
    return mart.where(F.col(col) > mart.select(F.min(col)).scalar())


# ---------------------------------------------------------------- salaries
def salary_groups(mart: DataFrame, seniority: str | None = None) -> DataFrame:
    """Count-weighted pay per technology (any case), contract basis and currency."""
    rows = mart.where(F.col("listing_count") > 0)
    if seniority is not None:
        rows = rows.where(F.lower("seniority") == seniority.lower())

    def weighted(col: str) -> Column:
        known = F.when(F.col(col).isNotNull(), F.col("listing_count"))
        return whole(F.sum(F.col(col) * F.col("listing_count")) / F.sum(known))

    rows = rows.withColumns({
        "technology": F.lower("technology_name"),
        "basis": contract_basis(F.col("employment_type")),
        "currency": F.coalesce(F.nullif("currency", F.lit("")), F.lit("PLN")),
    })
    groups = rows.groupBy("technology", "basis", "currency").agg(
        F.sum("listing_count").alias("count"), weighted("median_salary").alias("median"),
        weighted("p25_salary").alias("p25"), weighted("p75_salary").alias("p75"))
    total = F.sum("count").over(W.partitionBy("technology"))
    return groups.withColumns({"label": basis_label(F.col("basis")), "listing_count": total})


def seniority_rank(level: Column) -> Column:
    out = F.lit(99)
    for i, name in enumerate(SENIORITIES):
        out = F.when(F.lower(F.coalesce(level, F.lit(""))) == name, i).otherwise(out)
    return out


def salary_by_seniority(mart: DataFrame) -> DataFrame:
    """Weighted median per technology and seniority: monthly contracts in PLN."""
    rows = mart.where(F.lower("employment_type").isin(MONTHLY_TYPES)
                      & (F.upper("currency") == "PLN"))
    weight = F.col("median_salary") * F.col("listing_count")
    return (
        rows.groupBy(F.lower("technology_name").alias("technology"), "seniority")
        .agg(F.sum("listing_count").alias("n"),
             (F.sum(weight) / F.nullif(F.sum("listing_count"), F.lit(0))).alias("median"))
        .withColumn("rank", seniority_rank(F.col("seniority")))
    )


# ---------------------------------------------------------------- skills and demand
def technology_totals(demand: DataFrame) -> DataFrame:
    return (after_first(demand, "week_start").groupBy(F.lower("technology_name").alias("technology"))
            .agg(F.sum("listing_count").alias("total")))


def related_skills(pairs: DataFrame, demand: DataFrame, n: int = 8) -> DataFrame:
    """Most frequent companions of each technology and their share of its listings."""
    a, b = F.lower("tech_a"), F.lower("tech_b")
    both = F.array(F.struct(a.alias("technology"), F.col("tech_b").alias("other")),
                   # a pair that differs in case only is read in one direction
                   F.when(a != b, F.struct(b.alias("technology"), F.col("tech_a").alias("other"))))
    rows = (pairs.select("co_occurrence_count", F.inline(F.filter(both, lambda x: x.isNotNull())))
            .withColumnRenamed("co_occurrence_count", "count"))
    best = _top(rows, ["technology"], [F.desc("count"), F.asc("other")], n, "rank")
    totals = technology_totals(demand)
    total = F.coalesce("total", F.lit(0))
    return best.join(totals, "technology", "left").select(
        "technology", total.alias("total"), "rank", "other", "count",
        whole(100 * F.col("count") / F.nullif(total, F.lit(0))).alias("pct"))


def tech_trend(demand: DataFrame, n: int = 12) -> DataFrame:
    """The newest n periods of each technology, numbered oldest first."""
    rows = after_first(demand, "week_start").withColumn("technology", F.lower("technology_name"))
    order = [F.desc("week_start"), F.asc("technology_name")]
    newest = _top(rows, ["technology"], order, n, "age")
    position = F.count(F.lit(1)).over(W.partitionBy("technology")) - F.col("age") + 1
    return newest.select("technology", position.alias("position"), "week_start",
                         "listing_count", "wow_change")


def demand_series(trend: DataFrame) -> DataFrame:
    """The demand chart of each technology: its line of weekly counts, gaps drawn as 0."""
    return trend.select("technology", "position", F.col("week_start").alias("x"),
                        F.coalesce("listing_count", F.lit(0)).alias("demand"))


def hot_technologies(demand: DataFrame, n: int = 10) -> DataFrame:
    latest = demand.where(F.col("week_start") == demand.select(F.max("week_start")).scalar())
    return (latest.select("technology_name", "listing_count", "wow_change")
            .orderBy(F.desc("wow_change"), F.asc("technology_name")).limit(n))


# ---------------------------------------------------------------- market
def market_trend(trends: DataFrame, weeks: int = 8) -> DataFrame:
    """The newest weeks * 7 rows, numbered oldest first. At most that many rows remain."""
    newest = (after_first(trends, "full_date")
              .select("full_date", "new_listings", "rolling_7d_listings", "rolling_7d_avg_salary")
              .orderBy(F.desc("full_date")).limit(weeks * 7))
    return newest.withColumn("position", F.row_number().over(W.orderBy("full_date")))


def chart_series(trend: DataFrame) -> DataFrame:
    """The two lines of the trend chart; gaps are drawn as 0."""
    return trend.select(
        "position", F.col("full_date").alias("x"),
        F.coalesce("rolling_7d_listings", F.lit(0)).alias("volume"),
        F.coalesce("rolling_7d_avg_salary", F.lit(0.0)).alias("salary"))


def top_companies(snapshot: DataFrame, n: int = 10) -> DataFrame:
    return (snapshot.where(F.col("company_name").isNotNull()).groupBy("company_name")
            .agg(F.count(F.lit(1)).alias("listing_count"))
            .orderBy(F.desc("listing_count"), F.asc("company_name")).limit(n))


SNAPSHOT_ORDER = ["listing_id", "employment_type", "salary_min", "salary_max", "currency",
                  "is_gross"]


def company_intel(snapshot: DataFrame, term: str) -> DataFrame:
    """Offers of the companies whose name holds the term; % and _ in it are wildcards."""
    rows = snapshot.where(F.lower("company_name").like(f"%{term.lower()}%"))

    def mean(col: str) -> Column:
        return whole(F.avg(F.when(F.col(col) != 0, F.col(col))))

    totals = rows.agg(F.count(F.lit(1)).alias("listing_count"),
                      mean("salary_min").alias("avg_min"), mean("salary_max").alias("avg_max"))
    return intel(term, totals, rows.select("title", *SNAPSHOT_ORDER))


def intel(term: str, totals: DataFrame, offers: DataFrame) -> DataFrame:
    """The one row of `totals`, if it counts any listing, with the first five of the offers."""
    order = [F.asc_nulls_last(c) for c in SNAPSHOT_ORDER]
    first = offers.orderBy(*order).limit(5)
    # five rows at most from here on
    placed = first.select(F.struct(F.row_number().over(W.orderBy(*order)).alias("n"),
                                   "currency", "title").alias("x"))
    picked = placed.agg(F.array_sort(F.collect_list("x")).alias("s")).select(F.struct(
        F.get("s", F.lit(0))["currency"].alias("currency"),
        F.transform("s", lambda x: x["title"]).alias("titles")))
    return (totals.where("listing_count > 0").withColumn("_s", picked.scalar())
            .select(F.lit(term).alias("company"), "listing_count", "avg_min", "avg_max",
                    F.col("_s.currency").alias("currency"),
                    F.filter("_s.titles", lambda t: t != "").alias("sample_titles")))


def market_report(trends: DataFrame, snapshot: DataFrame, demand: DataFrame,
                  weeks: int = 8, n: int = 8) -> DataFrame:
    """The weekly report as rows (section, position, name, value, change)."""
    trend = market_trend(trends, weeks)
    ends = trend.agg(
        F.min_by("rolling_7d_listings", "full_date").alias("then"),
        F.max_by("rolling_7d_listings", "full_date").alias("now"),
        F.max_by("rolling_7d_avg_salary", "full_date").alias("pay"))

    def section(df: DataFrame, title: str, name: Column, value: Column, change: Column,
                position: Column) -> DataFrame:
        return df.select(F.lit(title).alias("section"), position.cast("bigint").alias("position"),
                         name.cast("string").alias("name"), value.cast("double").alias("value"),
                         change.cast("double").alias("change"))

    def ranked(df: DataFrame, *order: Column) -> DataFrame:
        # at most n rows reach this window
        return df.withColumn("_p", F.row_number().over(W.orderBy(*order)))

    one, none = F.lit(1), F.lit(None)
    companies = ranked(top_companies(snapshot, n), F.desc("listing_count"), F.asc("company_name"))
    hot = ranked(hot_technologies(demand, n), F.desc("wow_change"), F.asc("technology_name"))
    return (
        section(ends.where("now is not null and then <> 0"), "volume",
                F.lit("rolling_7d_listings"), F.col("now"), F.col("now") - F.col("then"), one)
        .unionByName(section(ends.where("pay <> 0"), "salary", F.lit("rolling_7d_avg_salary"),
                             F.bround("pay", 0), none, one))
        .unionByName(section(companies, "companies", F.col("company_name"),
                             F.col("listing_count"), none, F.col("_p")))
        .unionByName(section(hot, "technologies", F.col("technology_name"),
                             F.col("listing_count"), F.coalesce("wow_change", F.lit(0)),
                             F.col("_p")))
    )


# ---------------------------------------------------------------- listings and state
def listing_meta(snapshot: DataFrame) -> DataFrame:
    """Title, company and link per listing. The variants of a listing agree on all three."""
    return (snapshot.select("listing_id", "title", F.col("company_name").alias("company"),
                            offer_url(F.col("slug"), OFFER_URL).alias("url"))
            .dropDuplicates(["listing_id"]))


def freshness(table: DataFrame, stamp: str, as_of: Column, ttl: int = STALE_SECONDS) -> DataFrame:
    """Is there data, and is it older than the allowed age? No data counts as stale."""
    newest = table.agg(F.count(F.lit(1)).alias("n"), F.max(stamp).alias("last_loaded"))
    age = F.unix_timestamp(as_of) - F.unix_timestamp("last_loaded")
    return newest.select((F.col("n") > 0).alias("ready"), "last_loaded",
                         F.coalesce(age > ttl, F.lit(True)).alias("stale"))
