"""Data-quality checks: one row per check with its severity and number of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.vocab import WORKPLACE_ACCEPTED


def _result(counted: DataFrame, name: str, severity: str) -> DataFrame:
    return counted.select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
                          F.col("n").alias("violations"))


Check = tuple[str, str, Column]


def row_checks(df: DataFrame, wanted: list[Check]) -> DataFrame:
    """Checks that look at one row at a time, all of a table in one pass."""
    counts = df.agg(*[F.count_if(bad).alias(name) for name, _, bad in wanted])
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
                              F.col(name).alias("violations")) for name, severity, _ in wanted])
    return counts.select(F.inline(rows))


def not_null(table: str, cols: list[str], severity: str = "error") -> list[Check]:
    return [(f"not_null_{table}_{c}", severity, F.col(c).isNull()) for c in cols]


def accepted_values(table: str, col: str, values: list[str], severity: str = "error") -> Check:
    """Nulls pass."""
    return f"accepted_values_{table}_{col}", severity, ~F.col(col).isin(values)


def salary_range(severity: str = "warn") -> Check:
    low, high = F.col("salary_min"), F.col("salary_max")
    bad = low.isNotNull() & high.isNotNull() & ((low > high) | (low <= 0))
    return "salary_range_valid", severity, bad


def unique(df: DataFrame, table: str, col: str, severity: str = "error") -> DataFrame:
    repeated = df.where(F.col(col).isNotNull()).groupBy(col).count().where("count > 1")
    return _result(repeated.agg(F.count(F.lit(1)).alias("n")), f"unique_{table}_{col}", severity)


def one_open_version(history: DataFrame, severity: str = "error") -> DataFrame:
    open_rows = history.where(F.col("valid_to").isNull()).groupBy("listing_id").count()
    return _result(open_rows.where("count > 1").agg(F.count(F.lit(1)).alias("n")),
                   "snapshot_one_open_version", severity)


def known_in_seed(bridge: DataFrame, col: str, key: str, severity: str = "warn") -> DataFrame:
    """Names that the seed lookup does not know (their key stayed null)."""
    unknown = bridge.where(F.col(key).isNull()).select(col).distinct()
    return _result(unknown.agg(F.count(F.lit(1)).alias("n")), f"relationship_{col}", severity)


def run_checks(source: DataFrame, stg: DataFrame, fact: DataFrame, history: DataFrame,
               bridge: DataFrame) -> DataFrame:
    parts = [
        row_checks(source, not_null("source", ["listing_id", "title", "company_name"])),
        row_checks(stg, [
            *not_null("stg", ["listing_sk", "listing_id", "category", "seniority"]),
            accepted_values("stg", "workplace_type", WORKPLACE_ACCEPTED)]),
        unique(stg, "stg", "listing_sk"),
        unique(stg, "stg", "listing_id"),
        row_checks(fact, [salary_range()]),
        one_open_version(history),
        known_in_seed(bridge, "technology_name", "technology_key"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def gate(checks: DataFrame) -> None:
    """Stop on failed checks of level error; warnings only report. One row per check."""
    failed = checks.where("severity = 'error' and violations > 0").collect()
    if failed:
        raise ValueError("failed checks: " + ", ".join(
            f"{r.check_name} ({r.violations})" for r in failed))
