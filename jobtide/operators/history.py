"""Change history of listings (slowly changing dimension, type 2) and listing lifetime."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.pay import variants_of
from jobtide.session import short_methods
from jobtide.sources import commits
from jobtide.sources.layers import write_layer

KEY = "listing_id"
CHECKED = ["listing_status", "salary_min", "salary_max"]
BUCKETS = 256
ENDS = [T.StructField("valid_from", T.TimestampType()), T.StructField("valid_to", T.TimestampType())]


def listing_versions(stg: DataFrame, as_of: Column) -> DataFrame:
    """What the history watches: first pay variant and the status by the expiry date."""
    first = F.get(variants_of(stg), F.lit(0))
    expired = F.coalesce(F.col("expiry_date").try_cast("timestamp") < as_of, F.lit(False))
    return stg.select(
        "listing_id", "title", "company_name", "category", "seniority", "workplace_type",
        first["salary_min"].alias("salary_min"), first["salary_max"].alias("salary_max"),
        first["currency"].alias("currency"),
        F.when(expired, "expired").otherwise("active").alias("listing_status"),
        "date_collected",
    )


def first_history(batch: DataFrame, as_of: Column) -> DataFrame:
    return batch.withColumns({"valid_from": as_of, "valid_to": F.lit(None).cast("timestamp")})


def scd2(history: DataFrame, batch: DataFrame, as_of: Column, key: str = KEY,
         checked: list[str] = CHECKED) -> DataFrame:
    """Next state of the history.

    Closed versions pass through untouched. Open versions meet the batch in one outer join on
    the key, unique on both sides; a row that differs in a checked column closes the open
    version and opens a new one. Keys missing from the batch stay open.
    """
    data = [c for c in batch.columns if c != key]
    closed = history.where(F.col("valid_to").isNotNull())
    old = history.where(F.col("valid_to").isNull()).select(
        key, F.struct(*data, "valid_from").alias("old"))
    new = batch.select(key, F.struct(*data).alias("new"))
    both = old.join(new, key, "full_outer")
    same = F.lit(True)
    for c in checked:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    changed = F.col("old").isNotNull() & F.col("new").isNotNull() & ~same
    shape = [f"{c} {history.schema[c].dataType.simpleString()}"
             for c in [*data, "valid_from", "valid_to"]]
    kind = "struct<" + ",".join(s.replace(" ", ":", 1) for s in shape) + ">"
    open_end = F.lit(None).cast("timestamp")
    kept = F.struct(*[F.col(f"old.{c}") for c in [*data, "valid_from"]],
                    F.when(changed, as_of).otherwise(open_end)).cast(kind)
    fresh = F.struct(*[F.col(f"new.{c}") for c in data], as_of, open_end).cast(kind)
    versions = F.filter(
        F.array(F.when(F.col("old").isNotNull(), kept),
                F.when(F.col("old").isNull() | changed, fresh)), lambda v: v.isNotNull())
    moved = both.select(key, F.inline(versions))
    return closed.select(moved.columns).unionByName(moved)


def lifetime(history: DataFrame, as_of: Column) -> DataFrame:
    """Days between the first version of a listing and its end (or now, if still open)."""
    return history.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("versions"),
        F.date_diff(F.max(F.coalesce("valid_to", as_of)), F.min("valid_from"))
        .alias("lifetime_days"))


def store(spark: SparkSession, batch: DataFrame, previous: str | None, target: str,
          as_of: Column) -> DataFrame:
    """Write the next version of the history to the new folder `target`.

    The version before it is read while this one is written, so it must lie elsewhere.
    """
    if previous is not None and previous.rstrip("/") == target.rstrip("/"):
        raise ValueError("a history cannot replace the version it is made from")
    if previous is None:
        history = first_history(batch, as_of)
    else:
        history = scd2(spark.read.parquet(previous), batch, as_of)
    history.write.parquet(target)
    return spark.read.parquet(target)


@dataclass
class Load:
    """A load of a stored history that is staged: its rows, and which buckets of keys it writes."""

    path: str
    name: str
    version: int
    parts: dict[str, str]
    buckets: list[int]
    rows: DataFrame

    def publish(self) -> bool:
        """Make the load the newest version; False if another one was published since it was staged."""
        return not self.buckets or commits.publish(
            self.rows.sparkSession, self.path, self.version + 1, self.name, self.parts)


def _digest(checked: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*checked)), 256)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _open(spark: SparkSession, path: str, schema: T.StructType, parts: dict[str, str],
          buckets: list[int] | None = None) -> DataFrame:
    """Open versions of the buckets asked for, each from the load that wrote it last."""
    kind = T.StructType([*schema.fields, ENDS[0], T.StructField("digest", T.StringType()),
                         T.StructField("bucket", T.IntegerType())])
    wanted = [f"{path}/open/load={load}/bucket={b}" for b, load in parts.items()
              if buckets is None or int(b) in buckets]
    if not wanted:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).option("basePath", f"{path}/open").parquet(*wanted).drop("load")


def stage(spark: SparkSession, path: str, batch: DataFrame, as_of: Column, buckets: int = BUCKETS,
          key: str = KEY, checked: list[str] = CHECKED) -> Load:
    """Stage the next version of the history stored under `path`.

    Open versions lie in buckets by a hash of the key, each with a digest of its checked columns;
    the newest commit says which load wrote each bucket last. Only keys and digests of the batch
    and of the open versions are compared. Buckets in which they differ are read whole, closed and
    opened as `scd2` does, once, and written anew; the others keep their files. Closed versions are
    added and never read again by a load. The first load compares nothing and fixes the number of
    buckets. A batch without changes stages nothing.
    """
    entry = commits.entries(spark, path).orderBy(F.desc("version")).limit(1).collect()
    version, parts = (entry[0].version, dict(entry[0].parts)) if entry else (-1, {})
    parts, count = {b: x for b, x in parts.items() if b != "of"}, int(parts.get("of", buckets))
    placed = batch.withColumns({"bucket": _bucket(key, count), "digest": _digest(checked)})
    differ = placed
    if parts:
        # half as many bytes are shuffled as the hex digits have
        known = _open(spark, path, batch.schema, parts).select("bucket", key, F.unhex("digest").alias("before"))
        met = placed.select("bucket", key, F.unhex("digest").alias("digest")).join(known, ["bucket", key], "left")
        differ = met.where(~F.col("digest").eqNullSafe(F.col("before")))
    with short_methods(spark):
        moved = sorted(r.bucket for r in differ.select("bucket").distinct().collect())
    name = uuid.uuid4().hex
    if moved:
        here = placed.where(F.col("bucket").isin(moved)).drop("bucket", "digest")
        if parts:
            old = _open(spark, path, batch.schema, parts, moved).drop("digest", "bucket").withColumn(
                "valid_to", F.lit(None).cast("timestamp"))
            after = scd2(old, here, as_of, key, checked).select(*batch.columns, "valid_from", "valid_to")
            # the open and the closed versions are both read from it
            after = write_layer(after, f"{path}/merged/load={name}")
        else:
            after = first_history(here, as_of)
        now_open = after.where("valid_to is null").drop("valid_to").withColumn("bucket", _bucket(key, count))
        with short_methods(spark):
            # one task for a bucket, so that a bucket is one file; the digests are not shuffled
            now_open.repartition("bucket").withColumn("digest", _digest(checked)).write.partitionBy("bucket").parquet(
                f"{path}/open/load={name}")
            after.where("valid_to is not null").write.parquet(f"{path}/closed/load={name}")
        parts = {**parts, **{str(b): name for b in moved}}
    loads = [*commits.loads(spark, path, version), *([name] if moved else [])]
    return Load(path, name, version, {**parts, "of": str(count)}, moved,
                _versions(spark, path, batch.schema, parts, loads))


def _versions(spark: SparkSession, path: str, schema: T.StructType, parts: dict[str, str], loads: list[str]) -> DataFrame:
    names = [*schema.names, "valid_from", "valid_to"]
    now = _open(spark, path, schema, parts).withColumn("valid_to", F.lit(None).cast("timestamp")).select(names)
    if not loads:
        return now
    kind = T.StructType([*schema.fields, *ENDS])
    closed = spark.read.schema(kind).option("basePath", f"{path}/closed").parquet(
        *[f"{path}/closed/load={x}" for x in loads])
    return closed.select(names).unionByName(now)


def read(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The stored history as of a version (the newest by default). `schema` is that of the batches."""
    found = commits.entries(spark, path)
    if version is not None:
        found = found.where(F.col("version") <= version)
    entry = found.orderBy(F.desc("version")).limit(1).collect()
    parts = {b: x for b, x in entry[0].parts.items() if b != "of"} if entry else {}
    return _versions(spark, path, schema, parts, commits.loads(spark, path, version) if entry else [])


def load(spark: SparkSession, path: str, batch: DataFrame, as_of: Column, buckets: int = BUCKETS,
         key: str = KEY, checked: list[str] = CHECKED) -> Load:
    """Stage and publish a load. If another load was published in between, it is staged again upon
    that one."""
    while True:
        staged = stage(spark, path, batch, as_of, buckets, key, checked)
        if staged.publish():
            return staged
