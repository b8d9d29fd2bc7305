"""The batch build: bronze -> silver -> staging -> star schema -> marts."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.operators import checks, history, marts, silver, star
from jobtide.sources.layers import read_seed, write_layer


def staging(bronze: DataFrame, as_of: Column | None = None, derive: silver.Derive | silver.Narrow | None = None) -> DataFrame:
    cleaned = silver.clean(bronze, loaded_at=as_of, derive=derive)
    return silver.stage(silver.tech_parse(cleaned, parsed_at=as_of))


def dimensions(spark: SparkSession, stg: DataFrame, start: date, end: date) -> dict[str, DataFrame]:
    return {
        "company": star.dimension(stg, "company_name", "company_key", "company_name"),
        "category": star.dimension(stg, "category", "category_key", "category"),
        "seniority": star.dimension(stg, "seniority", "seniority_key", "level"),
        "workplace_type": star.dimension(stg, "workplace_type", "workplace_type_key", "type"),
        "employment_type": star.employment_types(stg),
        "technology": star.seed_dimension(
            read_seed(spark, "technology_lookup"), "canonical_name", "technology_key"),
        "city": star.seed_dimension(read_seed(spark, "city_lookup"), "city_name", "city_key"),
        "date": star.date_dimension(spark, start, end),
    }


def gold(spark: SparkSession, stg: DataFrame, start: date, end: date,
         listings: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every table of the star schema and every mart, by name. `listings` are the priced ones, where
    they are stored already."""
    if listings is None:
        listings = star.priced(stg, start, end)
    dims = dimensions(spark, listings, start, end)
    snapshot = marts.market_snapshot(listings)
    out = {f"dim_{name}": df for name, df in dims.items()}
    out |= {
        "fact_job_listings": star.fact(listings),
        "bridge_listing_technology": star.bridge_technology(stg, dims["technology"]),
        "bridge_listing_city": star.bridge_city(stg, dims["city"]),
        "mart_salary_by_technology": marts.salary_by_technology(listings),
        "mart_demand_by_technology": marts.demand_by_technology(listings),
        "mart_tech_co_occurrence": marts.co_occurrence(stg),
        "mart_city_summary": marts.city_summary(listings),
        "mart_market_trends": marts.market_trends(listings),
        "mart_market_snapshot": snapshot,
        "mart_junior_market_snapshot": marts.junior(snapshot),
    }
    return out


def build(spark: SparkSession, bronze: DataFrame, target: str, start: date, end: date,
          as_of: str, derive: silver.Derive | silver.Narrow | None = None) -> dict[str, DataFrame]:
    """Write every layer under `target`, each from the stored one below it. Pay is parsed once, for
    a stored layer that the fact and the marts read. `derive` is that of `silver.clean`.

    Gold goes to a folder of its own for each build; the change history is one stored table, of
    which a load is staged. The stored tables and the staged history are checked; only a build
    without failed checks is published (see `published`), its load of the history first. An empty
    silver layer, a failed check or another load of the history in between stops the build and
    leaves what is published as it was. If a build ends between the two, the history is ahead of
    the tables, and the next build finds no changes in it.
    """
    now = F.lit(as_of).cast("timestamp")
    cleaned = write_layer(silver.clean(bronze, now, derive), f"{target}/silver/cleaned_listings")
    if cleaned.isEmpty():
        raise ValueError("silver is empty; gold tables are left as they are")
    parsed = write_layer(silver.tech_parse(cleaned, parsed_at=now),
                         f"{target}/silver/listings_with_tech")
    stg = silver.stage(parsed)
    priced = write_layer(star.priced(stg, start, end), f"{target}/silver/priced_listings")
    folder = f"{target}/gold/{uuid.uuid4().hex}"
    tables = {name: write_layer(df, f"{folder}/{name}")
              for name, df in gold(spark, stg, start, end, priced).items()}
    batch = history.listing_versions(priced, now)
    load = history.stage(spark, f"{target}/gold/history", batch, now)
    tables["snapshot_listings"] = load.rows
    checks.gate(checks.run_checks(
        parsed, stg, tables["fact_job_listings"], tables["snapshot_listings"],
        tables["bridge_listing_technology"]))
    if not load.publish():
        raise ValueError("another build has changed the history; nothing is published")
    spark.range(1).select(
        F.lit(as_of).alias("as_of"), F.lit(folder).alias("folder"),
        F.current_timestamp().alias("published_at")).write.mode("append").parquet(_log(target))
    return tables


def _log(target: str) -> str:
    return f"{target}/published"


def published(spark: SparkSession, target: str) -> str | None:
    """Folder of the gold tables of the newest build that passed its checks."""
    try:
        log = spark.read.schema("as_of string, folder string, published_at timestamp").parquet(_log(target))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.agg(F.max_by("folder", F.struct("published_at", "folder"))).first()[0]
