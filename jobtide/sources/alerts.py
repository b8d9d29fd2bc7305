"""Log of alerts already sent: one row per (listing_id, chat_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pairs_to_record(sent: DataFrame, log: DataFrame, sent_at: Column) -> DataFrame:
    """Insert-or-ignore: the pairs of `sent` that the log does not hold yet."""
    pair = ["listing_id", "chat_id"]
    return (sent.select(*pair).dropDuplicates(pair)
            .join(log.select(*pair), pair, "left_anti")
            .withColumn("sent_at", sent_at))


def run_stats(bronze: DataFrame, log: DataFrame) -> DataFrame:
    """Raw files, last collection stamp and alerts sent, as one row."""
    runs = bronze.agg(F.countDistinct("source_file").alias("raw_files"),
                      F.max("date_collected").alias("last_scrape"))
    return runs.withColumn("alerts_sent", log.select(F.count(F.lit(1))).scalar())
