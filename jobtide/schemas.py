"""Schemas of the stored and exchanged tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())

# Text fields of one collected listing, in bronze order. Array and flag fields are read as
# text as well, so that a malformed field never spoils its whole document.
LISTING_FIELDS = [
    "listing_id", "slug", "title", "apply_url", "apply_method", "company_name", "category",
    "seniority", "workplace_type", "working_time", "cities", "salary_variants",
    "required_skills", "nice_to_have_skills", "description", "posted_date",
    "last_published_date", "expiry_date", "is_promoted", "is_super_offer",
    "is_remote_interview", "date_collected", "source_run_id",
]
LISTING_TEXT = T.StructType([T.StructField(f, T.StringType()) for f in LISTING_FIELDS])

ENVELOPE = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField("date_collected", T.StringType())])),
    T.StructField("listings", T.ArrayType(LISTING_TEXT)),
    T.StructField("_corrupt_record", T.StringType()),
])

_BRONZE_TYPES = {
    "cities": STRINGS, "required_skills": STRINGS, "nice_to_have_skills": STRINGS,
    "is_promoted": T.BooleanType(), "is_super_offer": T.BooleanType(),
    "is_remote_interview": T.BooleanType(),
}
BRONZE = T.StructType(
    [T.StructField(f, _BRONZE_TYPES.get(f, T.StringType())) for f in LISTING_FIELDS]
    + [T.StructField("source_file", T.StringType()),
       T.StructField("ingested_at", T.TimestampType())]
)

# Variant fields are text on purpose: a number, a quoted number and a bad value must all
# reach try_cast.
VARIANTS_TEXT = "array<struct<employment_type:string,salary_min:string,salary_max:string," \
                "currency:string,unit:string,is_gross:string>>"

RAW_OFFER = (
    "guid string, slug string, title string, workplaceType string, workingTime string, "
    "experienceLevel string, city string, companyName string, publishedAt string, "
    "lastPublishedAt string, expiredAt string, applyMethod string, applyUrl string, "
    "isRemoteInterview boolean, isPromoted boolean, isSuperOffer boolean, category string, "
    "locations array<struct<city:string>>, "
    "employmentTypes array<struct<`from`:double,fromPerUnit:double,`to`:double,"
    "toPerUnit:double,currency:string,currencySource:string,type:string,unit:string,"
    "gross:boolean>>, "
    "requiredSkills array<struct<name:string,level:int>>, "
    "niceToHaveSkills array<struct<name:string,level:int>>, "
    "languages array<struct<code:string,level:string>>, "
    "description string, body string, descriptionText string"
)

CONFIG_LISTS = [
    "seniorities", "technologies", "categories", "workplace_types", "employment_types",
    "cities", "skills",
]
USER_CONFIG = T.StructType(
    [T.StructField(f, STRINGS) for f in CONFIG_LISTS]
    + [T.StructField("salary_min", T.LongType()), T.StructField("tolerance", T.IntegerType())]
)
