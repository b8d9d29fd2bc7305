"""Session set-up and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM does not compile longer methods to machine code
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "jobtide", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Actions inside run wide projections as methods short enough to be compiled to machine code,
    also in a session without SETTINGS, whose one long method would be interpreted."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, SETTINGS[name])
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    own = getattr(shared_dir, "own", None)
    if own is None:
        own = shared_dir.own = tempfile.mkdtemp(prefix="jobtide-")
    return own


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame once, keep it in the shared folder and cut its lineage.

    Used where several consumers read the same frame; survives lost executors.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
