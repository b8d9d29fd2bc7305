"""Layer tables and seed lookups."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession

from jobtide.session import short_methods
from jobtide.vocab import SEED_DIR


def write_layer(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Full-overwrite table (or append); gives back the stored table."""
    with short_methods(df.sparkSession):
        df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# how a layer is kept, unless a model says otherwise: fixed values of the job
KINDS = {"staging": "ephemeral", "intermediate": "view", "marts": "table"}


def materialize(df: DataFrame, name: str, layer: str, folder: str, kind: str | None = None) -> DataFrame:
    """Keep a model as its layer says: an `ephemeral` one is a plan inside those that read it, a
    `view` is a plan that SQL finds by name, a `table` is stored below `folder` and read from there.
    `kind` overrides the layer."""
    kind = kind or KINDS[layer]
    if kind == "table":
        return write_layer(df, f"{folder}/{name}")
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind != "ephemeral":
        raise ValueError(f"no such kind of layer: {kind}")
    return df


def read_seed(spark: SparkSession, name: str) -> DataFrame:
    """A packaged lookup table of a few dozen rows, as a literal relation: Spark knows its size and
    sends it to every task of a join by itself."""
    with (SEED_DIR / f"{name}.csv").open(encoding="utf-8", newline="") as f:
        header, *rows = [row for row in csv.reader(f) if row]
    quoted = [", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in row) for row in rows]
    return spark.sql(f"select * from values {', '.join(f'({q})' for q in quoted)} as t({', '.join(header)})")
