"""Bronze: defensive coercion of listing records and append of new runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.skew import is_small
from jobtide.functions.text import no_strings, texts_of_json, truthy
from jobtide.schemas import BRONZE
from jobtide.session import short_methods
from jobtide.sources import commits

TEXT = [
    "slug", "title", "apply_url", "apply_method", "company_name", "category", "seniority",
    "workplace_type", "working_time", "description", "posted_date", "last_published_date",
    "expiry_date", "date_collected", "source_run_id",
]
FLAGS = ["is_promoted", "is_super_offer", "is_remote_interview"]
ORDER = [
    "listing_id", "slug", "title", "apply_url", "apply_method", "company_name", "category",
    "seniority", "workplace_type", "working_time", "cities", "salary_variants",
    "required_skills", "nice_to_have_skills", "description", "posted_date",
    "last_published_date", "expiry_date", "is_promoted", "is_super_offer",
    "is_remote_interview", "date_collected", "source_run_id", "source_file",
]
STORED = T.StructType([*BRONZE.fields, T.StructField("run", T.StringType())])


def _is_list(c: Column) -> Column:
    return F.ltrim(c).startswith("[")


def _list(name: str) -> Column:
    c = F.col(name)
    return F.coalesce(F.when(_is_list(c), texts_of_json(c)), no_strings())


def _flag(name: str) -> Column:
    c = F.lower(F.col(name))
    return F.coalesce(~c.isin("", "false", "0", "0.0", "null", "[]", "{}"), F.lit(False))


def coerce_bronze(listings: DataFrame, source_file: Column | None = None,
                  ingested_at: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """Text listings -> typed bronze rows. Bad fields become defaults, never errors. `keep` names
    further columns to carry along."""
    city = F.col("cities")
    cols = {c: F.coalesce(F.col(c), F.lit("")).alias(c) for c in TEXT}
    cols["listing_id"] = F.coalesce("listing_id", F.lit("")).alias("listing_id")
    # a lone city becomes a list of one; empty skills go, empty cities stay
    listed = F.transform(_list("cities"), lambda c: F.coalesce(c, F.lit("None")))
    cols["cities"] = (F.when(truthy(city) & ~_is_list(city), F.array(city))
                      .otherwise(listed).alias("cities"))
    for c in ("required_skills", "nice_to_have_skills"):
        cols[c] = F.filter(_list(c), truthy).alias(c)
    variants = F.col("salary_variants")
    cols["salary_variants"] = (F.when(_is_list(variants), variants).otherwise(F.lit("[]"))
                               .alias("salary_variants"))
    for c in FLAGS:
        cols[c] = _flag(c).alias(c)
    cols["source_file"] = (F.col("source_file") if source_file is None
                           else source_file).alias("source_file")
    extra = [F.col("guard_run_id")] if "guard_run_id" in listings.columns else []
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return listings.select(*[cols[c] for c in ORDER], stamp.alias("ingested_at"), *extra, *(keep or []))


def rows_to_append(batch: DataFrame, bronze: DataFrame, few_runs: bool = False) -> DataFrame:
    """Rows of documents whose run is not in bronze yet.

    The run list is one row per run, so Spark can send it to every task when it is small. Of a
    stored table only the folder column is read for it. Spark takes the list for as large as what
    it is read from; with `few_runs` it is sent, and documents are not shuffled by their run.
    """
    run = "run" if "run" in bronze.columns else "source_run_id"
    known = bronze.select(F.col(run).alias("guard_run_id")).distinct()
    known = F.broadcast(known) if few_runs else known
    return batch.join(known, "guard_run_id", "left_anti").drop("guard_run_id")


def read_bronze(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The published loads of the bronze table, up to a version; empty before the first."""
    found = commits.loads(spark, path, version)
    if not found:
        return spark.createDataFrame([], STORED)
    return _read(spark, path, found).drop("load")


def _read(spark: SparkSession, path: str, loads: list[str]) -> DataFrame:
    return spark.read.schema(STORED).option("basePath", path).parquet(*[f"{path}/load={x}" for x in loads])


def append_new_runs(batch: DataFrame, path: str, derive: Callable[[DataFrame], DataFrame] | None = None) -> bool:
    """Append the runs that the bronze table lacks as one load; False if it lacks none.

    The load is staged, one folder per run, and published by one commit. If another load came
    first, the guard looks again and what it staged is left unread; so does a load that was cut off,
    whose runs come again with the next call.

    With `derive`, the rows are not bronze yet: they hold guard_run_id and what the columns are made
    from, and `derive` makes bronze rows of those of new runs only, any number of a row. It may add
    `run`, a copy of source_run_id, and sort by it while rows are narrow: then they are not sorted again.
    """
    spark = batch.sparkSession
    while True:
        version = commits.last(spark, path)
        bronze = read_bronze(spark, path, version)
        fresh = rows_to_append(batch, bronze, is_small(bronze.select("run").distinct()))
        if fresh.isEmpty():
            return False
        load = stage(fresh if derive is None else derive(fresh), path)
        if derive is not None and _read(spark, path, [load]).isEmpty():
            return False
        if commits.publish(spark, path, version + 1, load):
            return True


def stage(fresh: DataFrame, path: str) -> str:
    """Write rows as a load that is not published; gives back its name."""
    load = uuid.uuid4().hex
    rows = fresh if "run" in fresh.columns else fresh.withColumn("run", F.col("source_run_id"))
    with short_methods(fresh.sparkSession):
        rows.write.partitionBy("run").parquet(f"{path}/load={load}")
    return load
