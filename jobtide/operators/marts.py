"""Marts over the star schema.

All of them read `priced` listings (one row per listing, variants and skills nested), so the
joins fact x bridge of the star schema turn into generators inside one row. What is left to
shuffle is one partially aggregated groupBy per mart. A listing is counted once by marking its
first row, which keeps exact distinct counts out of the shuffle.

The generators are the outer ones followed by a null check. For a plain `explode` the optimizer
adds a filter on the size of the array, which would parse pay and skills of every row twice.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.functions.skew import is_small, lookup_join
from jobtide.functions.keys import member
from jobtide.functions.quantile import quantiles
from jobtide.functions.text import no_strings
from jobtide.session import shared_dir
from jobtide.sources.layers import write_layer


def _skills() -> Column:
    return F.concat(F.coalesce("required_skills", no_strings()),
                    F.coalesce("nice_to_have_skills", no_strings()))


def _positive(v: Column) -> Column:
    return v["salary_min_monthly"] > 0


def _sane(v: Column) -> Column:
    return _positive(v) & (v["salary_max_monthly"] >= v["salary_min_monthly"])


def salary_by_technology(listings: DataFrame) -> DataFrame:
    """Monthly pay by technology, seniority, employment type and currency."""
    rows = (
        listings
        .select(member(F.col("seniority")).alias("seniority"), _skills().alias("skills"),
                F.explode_outer(F.filter("variants", _sane)).alias("v"))
        .where(F.col("v").isNotNull())
        .select("seniority", member(F.col("v.employment_type")).alias("employment_type"),
                F.col("v.currency").alias("currency"),
                F.col("v.salary_min_monthly").alias("lo"),
                F.col("v.salary_max_monthly").alias("hi"),
                F.explode_outer("skills").alias("technology_name"))
        .where(F.col("technology_name").isNotNull())
    )
    return salary_statistics(rows)


def salary_statistics(rows: DataFrame) -> DataFrame:
    """Statistics of (technology_name, seniority, employment_type, currency, lo, hi) rows.

    The first step folds equal values into (value, count) and spreads even a hot group over all
    tasks; exact quantiles come from these by rank (see `quantiles`), so that no group has all its
    amounts in one buffer. Amounts are whole numbers, so the sums are exact in any order.
    """
    group = ["technology_name", "seniority", "employment_type", "currency"]
    folded = (
        rows.withColumn("mid", (F.col("lo") + F.col("hi")) / 2)
        .groupBy(*group, "mid")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("lo").alias("sum_lo"),
             F.sum("hi").alias("sum_hi"), F.min("lo").alias("min_lo"),
             F.max("hi").alias("max_hi"))
    )
    # the sums and the ranks read it, and what is below it is dear; its texts take little room in columns
    folded = write_layer(folded, f"{shared_dir(rows.sparkSession)}/folded-{uuid.uuid4().hex}")
    n = F.sum("n")
    stats = folded.groupBy(*group).agg(
        n.alias("listing_count"),
        F.round(F.sum("sum_lo") / n, 0).alias("avg_salary_min"),
        F.round(F.sum("sum_hi") / n, 0).alias("avg_salary_max"),
        F.round((F.sum("sum_lo") + F.sum("sum_hi")) / 2 / n, 0).alias("avg_salary_mid"),
        F.min("min_lo").alias("min_salary"), F.max("max_hi").alias("max_salary"),
    )
    ranked = quantiles(folded, group, "mid", "n", [0.5, 0.25, 0.75], ["q50", "q25", "q75"],
                       few_groups=is_small(folded.select(*group).distinct()))
    ranked = ranked.withColumnsRenamed({g: f"_{g}" for g in group})
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group])
    return stats.join(ranked, same).select(
        *group, "listing_count", "avg_salary_min", "avg_salary_max", "avg_salary_mid",
        F.round("q50", 0).alias("median_salary"), F.round("q25", 0).alias("p25_salary"),
        F.round("q75", 0).alias("p75_salary"), "min_salary", "max_salary",
    )


# what the mart reads of the fact
SALARY_FACT = ["listing_id", "seniority_key", "employment_type_key", "salary_min_monthly", "salary_max_monthly", "currency"]


def salary_from_tables(fact: DataFrame, bridge: DataFrame, dim_seniority: DataFrame,
                       dim_employment: DataFrame) -> DataFrame:
    """The same mart from stored fact, bridge and dimension tables."""
    valid = fact.where((F.col("salary_min_monthly") > 0)
                       & (F.col("salary_max_monthly") >= F.col("salary_min_monthly")))
    rows = (
        valid.join(bridge.select("listing_id", "technology_name"), "listing_id")
    )
    for key, dim, natural, name in (
        ("seniority_key", dim_seniority, "level", "seniority"),
        ("employment_type_key", dim_employment, "type", "employment_type"),
    ):
        rows = lookup_join(rows, dim.select(key, F.col(natural).alias(name)), [key], F.col("listing_id"))
    rows = (
        rows.select("technology_name", "seniority", "employment_type", "currency",
                F.col("salary_min_monthly").alias("lo"), F.col("salary_max_monthly").alias("hi"))
    )
    return salary_statistics(rows)


def demand_by_technology(listings: DataFrame) -> DataFrame:
    """Listings per technology and posting day, with the change to the row before.

    A listing counts if it has at least one pay variant, once per technology.
    """
    daily = (
        listings.where((F.size("variants") > 0) & F.col("posted_on").isNotNull())
        .select(F.col("posted_on").alias("week_start"),
                F.explode_outer(F.array_distinct(_skills())).alias("technology_name"))
        .where(F.col("technology_name").isNotNull())
        .groupBy("technology_name", "week_start").agg(F.count(F.lit(1)).alias("listing_count"))
    )
    # after the count a technology has one row per day, so the window input is small; the day
    # is the last key because several days share a week
    dated = daily.withColumns({"year": F.year("week_start"),
                               "week_of_year": F.weekofyear("week_start")})
    order = W.partitionBy("technology_name").orderBy("year", "week_of_year", "week_start")
    before = F.lag("listing_count").over(order)
    return dated.select(
        "technology_name", "year", "week_of_year", "week_start", "listing_count",
        before.alias("prev_week_count"),
        (F.col("listing_count") - F.coalesce(before, F.lit(0))).alias("wow_change"),
    )


def co_occurrence(listings: DataFrame, min_count: int = 3) -> DataFrame:
    """Pairs of technologies named by the same listing, counted over listings.

    Listings with the same skill set are folded into one row with a count before any pair is
    formed, so the pair work grows with distinct skill sets, not with listings. The two
    generators run one after the other and never hold all pairs of a set at once.
    """
    names = F.array_sort(F.array_distinct(F.filter(_skills(), lambda s: s.isNotNull())))
    sets = (
        listings.select(names.alias("techs")).where(F.size("techs") > 1)
        .groupBy("techs").agg(F.count(F.lit(1)).alias("n"))
    )
    pairs = (
        sets.select("n", "techs", F.posexplode("techs").alias("i", "tech_a"))
        .select("n", "tech_a", F.explode(F.slice("techs", F.col("i") + 2, F.size("techs")))
                .alias("tech_b"))
    )
    return (pairs.groupBy("tech_a", "tech_b").agg(F.sum("n").alias("co_occurrence_count"))
            .where(F.col("co_occurrence_count") >= min_count))


def city_summary(listings: DataFrame) -> DataFrame:
    """Listings and mean monthly pay per city (currencies mixed)."""
    rows = (
        listings
        .select("cities", F.posexplode_outer(F.filter("variants", _positive)).alias("i", "v"))
        .where(F.col("v").isNotNull())
        .select("cities", "i", "v.salary_min_monthly", "v.salary_max_monthly",
                F.posexplode_outer("cities").alias("j", "city_name"))
        .where(F.col("city_name").isNotNull())
    )
    # a city named twice by one listing counts the listing once, its pay twice
    first = (F.col("i") == 0) & (F.array_position("cities", F.col("city_name")) == F.col("j") + 1)
    lo, hi = F.col("salary_min_monthly"), F.col("salary_max_monthly")
    return rows.groupBy("city_name").agg(
        F.count_if(first).alias("listing_count"),
        F.round(F.avg(lo), 0).alias("avg_salary_min"),
        F.round(F.avg(hi), 0).alias("avg_salary_max"),
        F.round(F.avg((lo + hi) / 2), 0).alias("avg_salary_mid"),
    )


def market_trends(listings: DataFrame) -> DataFrame:
    """New listings and mean pay per posting day, with means over the last seven rows."""
    rows = (
        listings.where(F.col("posted_on").isNotNull())
        .select(F.col("posted_on").alias("full_date"),
                F.posexplode_outer(F.filter("variants", _positive)).alias("i", "v"))
        .where(F.col("v").isNotNull())
    )
    mid = (F.col("v.salary_min_monthly") + F.col("v.salary_max_monthly")) / 2
    daily = rows.groupBy("full_date").agg(
        F.count_if(F.col("i") == 0).alias("new_listings"),
        F.round(F.avg(mid), 0).alias("avg_salary_mid"))
    # one row per day at this point: a single ordered window is small at any data size
    last7 = W.orderBy("full_date").rowsBetween(-6, 0)
    return daily.select(
        "full_date", F.weekofyear("full_date").alias("week_of_year"),
        F.month("full_date").alias("month"), F.year("full_date").alias("year"),
        "new_listings", "avg_salary_mid",
        F.sum("new_listings").over(last7).alias("rolling_7d_listings"),
        F.avg("avg_salary_mid").over(last7).alias("rolling_7d_avg_salary"),
    )


def market_snapshot(listings: DataFrame) -> DataFrame:
    """Listing x distinct raw pay tuple, with technologies and cities as arrays."""
    return with_lists(snapshot_rows(listings))


def with_lists(rows: DataFrame, *more: str) -> DataFrame:
    """Rows of the snapshot with their lists, sorted and distinct; an empty one comes out as null."""
    def collected(c: Column) -> Column:
        names = F.array_sort(F.array_distinct(F.filter(c, lambda s: s.isNotNull())))
        return F.when(F.size(names) > 0, names)

    plain = [c for c in rows.columns if c not in (*_LISTS, *more)]
    return rows.select(*plain, collected(_skills()).alias("technologies"),
                       collected(F.col("cities")).alias("cities"), *more)


_LISTS = ("required_skills", "nice_to_have_skills", "cities")


def snapshot_rows(listings: DataFrame) -> DataFrame:
    """Listing x distinct raw pay tuple, with the lists as they are.

    Grouping by a listing's own columns is a distinct inside its row: no shuffle.
    """
    tuples = F.array_distinct(F.transform("variants", lambda v: F.struct(
        v["salary_min"].alias("salary_min"), v["salary_max"].alias("salary_max"),
        v["currency"].alias("currency"), v["is_gross"].alias("is_gross"),
        member(v["employment_type"]).alias("employment_type"))))

    return (
        listings.select("*", F.explode_outer(tuples).alias("v")).where(F.col("v").isNotNull())
        .select("*", "v.*")
        .select(
            "listing_id", "listing_sk", "title", "slug", "salary_min", "salary_max", "currency",
            "is_gross", member(F.col("seniority")).alias("seniority"), "employment_type",
            member(F.col("workplace_type")).alias("workplace_type"),
            member(F.col("category")).alias("category"),
            member(F.col("company_name")).alias("company_name"),
            F.col("posted_on").alias("posted_date"), *_LISTS,
        )
    )


def junior(snapshot: DataFrame) -> DataFrame:
    return snapshot.where(F.col("seniority") == "junior")
