"""Star schema: dimensions, fact, bridges.

Staging holds one row per listing with its pay variants, skills and cities nested. Everything
that belongs to one listing is therefore computed inside its row: the fact and both bridges are
generators over staging and need no shuffle. `priced` is the shared form with parsed pay.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.keys import member_key, surrogate_key
from jobtide.functions.pay import parse_variants, variants_of
from jobtide.functions.skew import lookup_join


# ---------------------------------------------------------------- dimensions
def dimension(stg: DataFrame, col: str, key: str, name: str) -> DataFrame:
    """Distinct non-empty values of one staging column with their key."""
    values = stg.select(F.col(col).alias(name)).where(F.col(name) != "").distinct()
    return values.select(surrogate_key(F.col(name)).alias(key), name)


def employment_types(stg: DataFrame) -> DataFrame:
    # an outer generator, so that pay is not parsed a second time for a size filter
    types = stg.select(F.explode_outer(variants_of(stg)["employment_type"]).alias("type"))
    return dimension(types, "type", "employment_type_key", "type")


def seed_dimension(seed: DataFrame, natural: str, key: str) -> DataFrame:
    return seed.select(surrogate_key(F.col(natural)).alias(key), *seed.columns)


def date_dimension(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from start up to, not including, end."""
    days = spark.sql(
        f"select explode(sequence(date'{start}', date'{end}' - interval 1 day)) as full_date")
    dow = F.dayofweek("full_date") - 1
    return days.select(
        surrogate_key(F.col("full_date")).alias("date_key"), "full_date",
        F.year("full_date").alias("year"), F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
        F.weekofyear("full_date").alias("week_of_year"), dow.alias("day_of_week"),
        dow.isin(0, 6).alias("is_weekend"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.quarter("full_date").alias("quarter"),
    )


def on_calendar(day: Column, start: date, end: date) -> Column:
    """The day if the date dimension holds it, else null."""
    return F.when((day >= F.lit(start)) & (day < F.lit(end)), day)


# ---------------------------------------------------------------- listings with parsed pay
def priced(stg: DataFrame, start: date, end: date) -> DataFrame:
    """Staging plus `variants` (typed pay), `posted_on` and `collected_on` on the calendar."""
    return stg.withColumns({
        "variants": parse_variants(F.col("salary_variants")),
        "posted_on": on_calendar(F.col("posted_date").try_cast("date"), start, end),
        "collected_on": on_calendar(F.col("date_collected").try_cast("date"), start, end),
    })


_FACT = [
    "listing_id", "listing_sk", "title", "slug", "company_key", "seniority_key",
    "employment_type_key", "workplace_type_key", "category_key", "date_posted_key",
    "date_collected_key", "salary_min", "salary_max", "pay_unit", "salary_min_monthly",
    "salary_max_monthly", "currency", "is_gross", "listing_status",
]


# what the fact and its dimensions read of staging
FACT_SOURCES = [
    "listing_id", "listing_sk", "title", "slug", "company_name", "category", "seniority",
    "workplace_type", "salary_variants", "posted_date", "date_collected",
]
# what the mart of pay by technology and its dimensions read of it
SALARY_SOURCES = [
    "listing_id", "company_name", "category", "seniority", "workplace_type", "salary_variants", "posted_date",
    "date_collected", "required_skills", "nice_to_have_skills",
]


def _variant_rows(listings: DataFrame) -> DataFrame:
    """One row per variant. The outer generator with a null check keeps the optimizer from
    parsing the pay text a second time for a size filter."""
    rows = listings.select("*", F.explode_outer("variants").alias("v"))
    return rows.where(F.col("v").isNotNull()).select("*", "v.*")


def fact(priced_listings: DataFrame, columns: list[str] = _FACT) -> DataFrame:
    """One row per listing and pay variant, with the key of every dimension.

    The dimensions come from the same staging rows, so each key is computed where the left
    join would have found it (see `member_key`); `fact_by_joins` is the same through joins.
    `columns` are those asked for; the listings need not hold what only others are made from.
    """
    made = {
        "company_key": member_key(F.col("company_name")),
        "seniority_key": member_key(F.col("seniority")),
        "employment_type_key": member_key(F.col("employment_type")),
        "workplace_type_key": member_key(F.col("workplace_type")),
        "category_key": member_key(F.col("category")),
        "date_posted_key": F.when(F.col("posted_on").isNotNull(),
                                  surrogate_key(F.col("posted_on"))),
        "date_collected_key": F.when(F.col("collected_on").isNotNull(),
                                     surrogate_key(F.col("collected_on"))),
        "listing_status": F.lit("active"),
    }
    rows = _variant_rows(priced_listings)
    return rows.withColumns({c: made[c] for c in columns if c in made}).select(*columns)


def fact_by_joins(stg: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The fact through left joins, for dimensions that were built elsewhere.

    A dimension of few rows goes to every task, another is joined with its hot names spread. What
    belongs to a listing is joined before its variants become rows, their names are left behind, and
    dimensions that `stg` itself feeds are better read from a stored one.
    """
    rows = stg.select(*FACT_SOURCES).withColumns({
        "_posted": F.col("posted_date").try_cast("date"),
        "_collected": F.col("date_collected").try_cast("date"),
        "listing_status": F.lit("active"),
    }).drop("posted_date", "date_collected")

    def keyed(rows: DataFrame, dim: str, natural: str, col: str) -> DataFrame:
        side = dims[dim].select(f"{dim}_key", F.col(natural).alias(col))
        return lookup_join(rows, side, [col], F.col("listing_id")).drop(col)

    for dim, natural, col in (
        ("company", "company_name", "company_name"), ("seniority", "level", "seniority"),
        ("workplace_type", "type", "workplace_type"), ("category", "category", "category"),
    ):
        rows = keyed(rows, dim, natural, col)
    for col, key in (("_posted", "date_posted_key"), ("_collected", "date_collected_key")):
        side = dims["date"].select(F.col("date_key").alias(key), F.col("full_date").alias(col))
        rows = lookup_join(rows, side, [col], F.col("listing_id"))
    rows = _variant_rows(rows.withColumn("variants", parse_variants(F.col("salary_variants"))))
    return keyed(rows, "employment_type", "type", "employment_type").select(*_FACT)


# ---------------------------------------------------------------- bridges
def bridge_technology(stg: DataFrame, dim_technology: DataFrame) -> DataFrame:
    """Listing x skill x requirement type. A skill of both kinds stands twice.

    One generator over both lists, so that staging runs once. The lookup is the packaged seed as a
    rule, whose size Spark knows: it goes to every task and the skills are not shuffled.
    """
    dim = dim_technology.select(
        "technology_key", F.col("canonical_name").alias("technology_name"))

    def tagged(skills: str, kind: str) -> Column:
        return F.transform(F.coalesce(skills, F.array().cast("array<string>")), lambda s: F.struct(
            s.alias("technology_name"), F.lit(kind).alias("requirement_type")))

    both = F.concat(tagged("required_skills", "required"), tagged("nice_to_have_skills", "nice_to_have"))
    rows = stg.select("listing_id", F.explode_outer(both).alias("s")).where(F.col("s").isNotNull())
    return (rows.select("listing_id", "s.*").join(dim, "technology_name", "left")
            .select("listing_id", "technology_key", "technology_name", "requirement_type"))


def bridge_city(stg: DataFrame, dim_city: DataFrame) -> DataFrame:
    dim = dim_city.select("city_key", "city_name")
    rows = stg.select("listing_id", F.explode_outer("cities").alias("city_name"), F.size("cities").alias("n"))
    return (rows.where(F.col("n") > 0).drop("n")
            .join(dim, "city_name", "left").select("listing_id", "city_key", "city_name"))
