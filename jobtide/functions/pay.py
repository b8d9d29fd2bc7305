"""Pay variants of a listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import literal_map
from jobtide.schemas import VARIANTS_TEXT
from jobtide.vocab import BASIS_LABELS, MONTHLY_TYPES, PAY_FACTORS


def pay_factor(unit: Column) -> Column:
    """Factor from a pay period to a month; unknown and missing periods count as months."""
    table = literal_map(PAY_FACTORS, "double")
    return F.coalesce(F.try_element_at(table, F.lower(unit)), F.lit(1.0))


def variant_texts(json_text: Column) -> Column:
    """JSON array text -> array of variants with all fields as text; null where it is no array.

    An element that is no object becomes a variant of nulls. It makes the typed parse of the
    whole array null; only then the elements are parsed one by one.
    """
    one = VARIANTS_TEXT.removeprefix("array<").removesuffix(">")
    apart = F.transform(F.from_json(json_text, "array<string>"), lambda e: F.from_json(e, one))
    return F.when(F.ltrim(json_text).startswith("["),
                  F.coalesce(F.from_json(json_text, VARIANTS_TEXT), apart))


def parse_variants(json_text: Column) -> Column:
    """JSON array text -> array of typed variants; null where it is not a JSON array."""
    parsed = variant_texts(json_text)
    typed = F.transform(parsed, lambda v: F.struct(
        v.alias("raw"), v["salary_min"].try_cast("double").alias("low"),
        v["salary_max"].try_cast("double").alias("high"), pay_factor(v["unit"]).alias("factor")))
    return F.transform(typed, lambda t: F.struct(
        t["raw"]["employment_type"].alias("employment_type"),
        t["low"].alias("salary_min"),
        t["high"].alias("salary_max"),
        t["raw"]["currency"].alias("currency"),
        t["raw"]["unit"].alias("pay_unit"),
        (t["raw"]["is_gross"] == "true").alias("is_gross"),
        F.round(t["low"] * t["factor"], 0).alias("salary_min_monthly"),
        F.round(t["high"] * t["factor"], 0).alias("salary_max_monthly"),
    ))


def variants_of(listings: DataFrame) -> Column:
    """Typed variants of listings: their column `variants` if they are priced already, else parsed."""
    return F.col("variants") if "variants" in listings.columns else parse_variants(F.col("salary_variants"))


def contract_basis(employment_type: Column) -> Column:
    name = F.lower(F.coalesce(employment_type, F.lit("")))
    return (F.when(name.isin(MONTHLY_TYPES), "permanent")
            .when(name == "b2b", "b2b").otherwise("mandate"))


def basis_label(basis: Column) -> Column:
    out = basis
    for key, label in BASIS_LABELS.items():
        out = F.when(basis == key, label).otherwise(out)
    return out
