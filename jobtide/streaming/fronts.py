"""File arrivals into bronze, and alerts into the alert log.

Both steps are incremental by nature. Arrivals run the batch operator with its own guard, alerts
keep the pairs they have told as state of the stream, so a replayed batch writes nothing twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from jobtide.sources.bronze import append_new_runs, coerce_bronze
from jobtide.sources.envelope import stream_envelopes


def ingest_arrivals(spark: SparkSession, folder: str, bronze_path: str, checkpoint: str,
                    lines: bool = False, files_per_batch: int = 100) -> StreamingQuery:
    """Coerce listings of new files and append the runs bronze does not hold yet.

    Two files of the same run in one micro-batch would both pass the guard, so that of the least
    name stands for the run.
    """
    def write(batch: DataFrame, _: int) -> None:
        first = batch.groupBy("guard_run_id").agg(F.min("source_file").alias("_first"))
        chosen = batch.join(first.withColumnRenamed("guard_run_id", "_run"), F.col(
            "guard_run_id").eqNullSafe(F.col("_run")) & (F.col("source_file") == F.col("_first")))
        append_new_runs(coerce_bronze(chosen.drop("_run", "_first")), bronze_path)

    source = stream_envelopes(spark, folder, lines, files_per_batch)
    return (source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


PAIR = "listing_id string, chat_id string"


def _once(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A pair that is new, once: neither told before nor in the log."""
    known, fresh = state.exists, False
    for frame in frames:
        known = known or bool(frame["known"].any())
        fresh = fresh or not bool(frame["known"].all())
    if not state.exists:
        state.update((True,))
    if fresh and not known:
        yield pd.DataFrame([key], columns=["listing_id", "chat_id"])


def record_alerts(spark: SparkSession, digests: DataFrame, log_path: str,
                  checkpoint: str) -> StreamingQuery:
    """Append each (listing, user) pair of a digest stream to the log once.

    Which pairs were told is state of the stream, by pair, in its state store. The log is a second
    source of the stream: what other jobs have added to it is read once, with the files that are
    new, and no batch reads the log again. Each batch writes to a folder of its own, so that a batch
    that is repeated replaces what it wrote.
    """
    spark.createDataFrame([], LOG).write.mode("ignore").parquet(log_path)
    told = spark.readStream.schema(LOG).option("recursiveFileLookup", "true").parquet(log_path)
    pair = ["listing_id", "chat_id"]
    both = told.select(*pair, F.lit(True).alias("known")).unionByName(
        digests.select(*pair, F.lit(False).alias("known")))
    new = both.groupBy(*pair).applyInPandasWithState(
        _once, PAIR, "told boolean", "append", GroupStateTimeout.NoTimeout)
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("sent_at", F.current_timestamp()).write.mode("overwrite").parquet(
            f"{log_path}/stream={name}/batch={number}")

    return (new.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


LOG = f"{PAIR}, sent_at timestamp"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The alert log, of streams and of batch jobs; empty before the first alert."""
    try:
        return spark.read.schema(LOG).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)
