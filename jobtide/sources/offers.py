"""Raw offers of the job site -> listing records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import no_strings, strip, truthy


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _non_zero(first: Column, second: Column) -> Column:
    """The per-unit amount, or the plain one where that is missing or 0."""
    return F.when(first.isNotNull() & (first != 0), first).otherwise(second)


def _names(skills: str) -> Column:
    return F.coalesce(F.filter(F.transform(skills, lambda s: s["name"]), truthy), no_strings())


def _category() -> Column:
    raw = F.col("category")
    return F.coalesce(
        F.when(F.ltrim(raw).startswith("{"), F.get_json_object(raw, "$.key")).otherwise(raw),
        F.lit(""))


def _cities() -> Column:
    listed = F.array_sort(F.array_distinct(
        F.filter(F.transform("locations", lambda x: x["city"]), truthy)))
    single = F.when(truthy(F.col("city")), F.array("city")).otherwise(no_strings())
    return F.when(F.size("locations") > 0, listed).otherwise(single)


def _variants() -> Column:
    quoted = F.filter("employmentTypes", lambda e: (e["currencySource"] == "original")
                      & (e["from"].isNotNull() | e["to"].isNotNull()))
    shaped = F.transform(quoted, lambda e: F.struct(
        F.coalesce(e["type"], F.lit("")).alias("employment_type"),
        _non_zero(e["fromPerUnit"], e["from"]).alias("salary_min"),
        _non_zero(e["toPerUnit"], e["to"]).alias("salary_max"),
        F.coalesce(e["currency"], F.lit("PLN")).alias("currency"),
        F.coalesce(e["unit"], F.lit("month")).alias("unit"),
        F.coalesce(e["gross"], F.lit(True)).alias("is_gross"),
    ))
    return F.coalesce(shaped, F.array().cast(
        "array<struct<employment_type:string,salary_min:double,salary_max:double,"
        "currency:string,unit:string,is_gross:boolean>>"))


def _description() -> Column:
    texts = [F.when(strip(F.col(c)) != "", F.col(c))
             for c in ("description", "body", "descriptionText")]
    return F.coalesce(*texts, F.lit(""))


def offer_id() -> Column:
    return F.coalesce(F.nullif("guid", F.lit("")), F.nullif("slug", F.lit("")))


def normalize_offers(raw: DataFrame, run_id: str, collected_at: str) -> DataFrame:
    """Flat listing records; offers without guid and slug are dropped."""
    return raw.where(offer_id().isNotNull()).select(
        offer_id().alias("listing_id"),
        _text("slug").alias("slug"),
        _text("title").alias("title"),
        _text("applyUrl").alias("apply_url"),
        _text("applyMethod").alias("apply_method"),
        _text("companyName").alias("company_name"),
        _category().alias("category"),
        _text("experienceLevel").alias("seniority"),
        _text("workplaceType").alias("workplace_type"),
        _text("workingTime").alias("working_time"),
        _cities().alias("cities"),
        _variants().alias("salary_variants"),
        _names("requiredSkills").alias("required_skills"),
        _names("niceToHaveSkills").alias("nice_to_have_skills"),
        F.coalesce("languages", F.array().cast("array<struct<code:string,level:string>>"))
        .alias("languages"),
        _description().alias("description"),
        _text("publishedAt").alias("posted_date"),
        _text("lastPublishedAt").alias("last_published_date"),
        _text("expiredAt").alias("expiry_date"),
        F.coalesce("isPromoted", F.lit(False)).alias("is_promoted"),
        F.coalesce("isSuperOffer", F.lit(False)).alias("is_super_offer"),
        F.coalesce("isRemoteInterview", F.lit(False)).alias("is_remote_interview"),
        F.lit(collected_at).alias("date_collected"),
        F.lit(run_id).alias("source_run_id"),
    )


def as_listing_text(listings: DataFrame) -> DataFrame:
    """Render normalised records in the text form that envelopes carry."""
    out = []
    for field in listings.schema.fields:
        if field.name == "languages":
            continue
        kind = field.dataType.typeName()
        c = F.col(field.name)
        out.append((F.to_json(c) if kind == "array" else c.cast("string")).alias(field.name))
    return listings.select(*out)


def parse_report(raw: DataFrame) -> DataFrame:
    """How many offers were parsed and how many had no id."""
    return raw.agg(F.count(F.lit(1)).alias("offers"),
                   F.count_if(offer_id().isNotNull()).alias("parsed"),
                   F.count_if(offer_id().isNull()).alias("rejected"))
