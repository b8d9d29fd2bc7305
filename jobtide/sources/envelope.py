"""Raw envelopes: JSON documents of the form {metadata: {...}, listings: [...]}."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.schemas import ENVELOPE, LISTING_FIELDS
from jobtide.vocab import RAW_POOL_SIZE


def read_envelope(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per listing, all fields as text, plus source_file and guard_run_id.

    A document that is not an object, or whose `listings` is there but no list, stops the job;
    one without `listings` holds none. With `lines` every line is a document of its own, so that
    large files split.
    """
    return listings_of(spark.read.text(path, wholetext=not lines))


def stream_envelopes(spark: SparkSession, folder: str, lines: bool = False,
                     files_per_batch: int = 100) -> DataFrame:
    """The same rows as files arrive in a folder."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return listings_of(reader.text(folder, wholetext=not lines))


def listings_of(documents: DataFrame) -> DataFrame:
    """Listings of documents given as text, with their file."""
    options = {"columnNameOfCorruptRecord": "_corrupt_record"}
    docs = documents.where(F.trim("value") != "").select(
        F.from_json("value", ENVELOPE, options).alias("d"),
        F.json_object_keys("value").alias("keys"), F.col("_metadata.file_name").alias("source_file"))
    docs = docs.select("d.*", "keys", "source_file")
    # keys are null where the text is no object
    shape = (F.col("_corrupt_record").isNull() & F.col("keys").isNotNull()
             & (F.col("listings").isNotNull() | ~F.array_contains("keys", "listings")))
    bad = F.raise_error(F.concat(F.lit("not a listing envelope: "), F.col("source_file")))
    sound = docs.where(F.when(F.coalesce(shape, F.lit(False)), F.lit(True))
                       .otherwise(bad.cast("boolean")))
    # all listings of a document belong to the run of its first one
    first_run = F.get("listings", F.lit(0))["source_run_id"]
    guard = F.coalesce(F.nullif(first_run, F.lit("")), F.col("metadata.date_collected"))
    return (sound.select("source_file", guard.alias("guard_run_id"), F.posexplode("listings"))
            .select("col.*", "source_file", "guard_run_id", F.col("pos").alias("position")))


# packed files are read by one task each, so none holds more envelopes
FILE_ROWS = 200_000


def write_envelope(listings: DataFrame, path: str, collected_at: str) -> None:
    """Write text listings as packed JSON lines, one envelope per line: names and texts repeat from
    line to line, and packed they take a small part of the room."""
    body = F.struct(*[F.col(f) for f in LISTING_FIELDS])
    (listings.select(F.struct(F.lit(collected_at).alias("date_collected")).alias("metadata"),
                     F.array(body).alias("listings"))
     .write.mode("overwrite").options(compression="gzip", maxRecordsPerFile=FILE_ROWS).json(path))


def newest_file(listings: DataFrame) -> DataFrame:
    """Listings of the newest file by name; its name comes from that column alone."""
    return listings.where(F.col("source_file") == listings.select(F.max("source_file")).scalar())


def newest_file_listings(listings: DataFrame, limit: int = RAW_POOL_SIZE) -> DataFrame:
    """The first listings of the newest file (the feature is a short preview)."""
    return newest_file(listings).where(F.col("position") < limit)
