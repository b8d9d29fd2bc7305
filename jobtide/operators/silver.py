"""Silver: newest record per listing, standardised values, canonical skills."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.functions.keys import surrogate_key
from jobtide.functions.text import canonical_skills, scan_terms, truthy, union_sorted
from jobtide.vocab import CANONICAL_TECHS, TECH_ALIASES

# Ties on date_collected are settled by these, so that reruns agree. The list is short: each
# column in it has to be read and shuffled by every query over silver.
TIE_BREAK = ["ingested_at", "source_run_id", "title", "company_name", "slug", "salary_variants"]
# the first of the order; only records that agree in these are compared by their texts
STAMPS = ["date_collected", "ingested_at", "source_run_id"]

Derive = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Narrow:
    """Rows that hold less than the bronze columns, one row for one record. Rows are of one listing if
    they agree in `key`, and `stamps` order those of a listing as STAMPS order its records. `widen`
    turns any of the rows into bronze records, one each, and may join what they refer to. `tied`, if it
    is known, holds `key_hash` of all listings of which several rows agree in `stamps`."""

    key: list[str]
    stamps: list[str]
    widen: Derive
    tied: DataFrame | None = None


def key_hash(narrow: Narrow) -> Column:
    return F.xxhash64(*narrow.key)


def tied_keys(rows: DataFrame, narrow: Narrow) -> DataFrame:
    """`key_hash` of listings of which several rows agree in their stamps, newest or not."""
    same = rows.groupBy(key_hash(narrow).alias("_key"), F.xxhash64(*narrow.stamps).alias("_stamps"))
    return same.agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_key").distinct()


def _newest_of_narrow(rows: DataFrame, narrow: Narrow) -> DataFrame:
    """Only the newest rows are widened. Few listings have several of these; their records are shuffled
    by listing once more and told apart by their texts. Where it is known which listings may have
    several, only their rows are looked through for these: all columns of a row are needed for that."""
    order = W.partitionBy(*narrow.key).orderBy(*[F.desc_nulls_last(c) for c in narrow.stamps])
    group = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)

    def newest(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("_rank", F.rank().over(order)).where("_rank = 1").drop("_rank")
                .withColumn("_tied", F.count(F.lit(1)).over(group)))

    alone = narrow.widen(newest(rows).where("_tied = 1").select(*rows.columns))
    may_tie = rows
    if narrow.tied is not None:
        may_tie = rows.join(F.broadcast(narrow.tied), key_hash(narrow) == narrow.tied["_key"], "left_semi")
    tied = newest_per_listing(narrow.widen(newest(may_tie).where("_tied > 1").select(*rows.columns)))
    return alone.unionByName(tied)


def newest_per_listing(bronze: DataFrame, derive: Derive | Narrow | None = None) -> DataFrame:
    """Latest record per listing_id.

    `row_number() = 1` lets Spark keep one row per key on the map side already, so a listing
    collected millions of times does not travel.

    With `derive`, the rows are not bronze yet: they hold listing_id, the STAMPS and what the other
    columns are made from, and `derive` adds these. Then only such rows are sorted and shuffled, and
    the wide texts are made of the newest ones; rows that tie in the stamps are told apart by texts
    made for them alone. Rows of a `Narrow` hold neither listing_id nor STAMPS, only what stands for them.
    """
    if isinstance(derive, Narrow):
        return _newest_of_narrow(bronze, derive)
    if derive is None:
        order = [F.desc_nulls_last(c) for c in ["date_collected", *TIE_BREAK]]
        ranked = bronze.withColumn("_rn", F.row_number().over(
            W.partitionBy("listing_id").orderBy(*order)))
        return ranked.where("_rn = 1").drop("_rn")
    order = W.partitionBy("listing_id").orderBy(*[F.desc_nulls_last(c) for c in STAMPS])
    group = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    newest = (bronze.withColumn("_rank", F.rank().over(order)).where("_rank = 1").drop("_rank")
              .withColumn("_tied", F.count(F.lit(1)).over(group)))
    texts = F.when(F.col("_tied") > 1, F.struct(*[c for c in TIE_BREAK if c not in STAMPS]))
    told = derive(newest).select(*bronze.columns, texts.alias("_texts"))
    best = told.withColumn("_best", F.max("_texts").over(group)).where(
        F.col("_texts").eqNullSafe(F.col("_best")))
    one = best.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").select(*bronze.columns)
    made = derive(one)
    carried = set(bronze.columns) - {"listing_id", *STAMPS}
    return made.select(*[c for c in made.columns if c not in carried])


def clean(bronze: DataFrame, loaded_at: Column | None = None, derive: Derive | Narrow | None = None) -> DataFrame:
    """Deduplicate first, then standardise and drop invalid rows.

    The order matters: a newer record with a blank title hides an older good one. With `derive`
    the bronze columns are made after that (see `newest_per_listing`).
    """
    workplace = F.lower(F.trim("workplace_type"))
    return (
        newest_per_listing(bronze, derive)
        .where(F.col("listing_id").isNotNull() & truthy(F.col("title"))
               & truthy(F.col("company_name")))
        .withColumns({
            "category": F.trim("category"),
            "seniority": F.lower(F.trim("seniority")),
            "workplace_type": F.when(workplace == "office", "onsite").otherwise(workplace),
            "silver_loaded_at": F.current_timestamp() if loaded_at is None else loaded_at,
        })
    )


def tech_parse(cleaned: DataFrame, aliases: dict[str, str] = TECH_ALIASES,
               terms: list[str] = CANONICAL_TECHS, parsed_at: Column | None = None) -> DataFrame:
    """Add canonical skill lists, technologies named in the description and their union."""
    named = cleaned.withColumns({
        "canonical_required_skills": canonical_skills(F.col("required_skills"), aliases),
        "canonical_nice_to_have_skills": canonical_skills(F.col("nice_to_have_skills"), aliases),
        "description_techs": scan_terms(F.col("description"), terms),
    })
    return named.withColumns({
        "all_technologies": union_sorted(
            F.col("canonical_required_skills"), F.col("canonical_nice_to_have_skills"),
            F.col("description_techs")),
        "tech_parsed_at": F.current_timestamp() if parsed_at is None else parsed_at,
    })


def stage(listings: DataFrame) -> DataFrame:
    """Staging view of the star schema: valid rows, surrogate key, canonical skills."""
    return (
        listings
        .where(F.col("listing_id").isNotNull() & truthy(F.col("title"))
               & truthy(F.col("company_name")))
        .select(
            surrogate_key(F.col("listing_id"), F.col("date_collected")).alias("listing_sk"),
            "listing_id", "slug", "title", "apply_url", "company_name", "category", "seniority",
            "workplace_type", "cities",
            F.col("canonical_required_skills").alias("required_skills"),
            F.col("canonical_nice_to_have_skills").alias("nice_to_have_skills"),
            "all_technologies", "salary_variants", "description", "posted_date", "expiry_date",
            "date_collected", "source_run_id", "ingested_at", "silver_loaded_at",
            "tech_parsed_at",
        )
    )
