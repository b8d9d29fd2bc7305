"""The training corpus: documents judged, filtered, deduplicated, decontaminated and encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import decontamination, near_dup, quality_rules, toxicity
from jobtide.llm.catalog import bpe_digests
from jobtide.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the voting rules keep; the rules learn from all rows given."""
    names = [f"`{c}`" for c in docs.columns]
    row = docs.select(F.struct(*names).alias("_row"), "text")
    counted = stored(quality_rules.counts(row).drop("text"), "counted")
    return quality_rules.judge(counted, quality_rules.learn(counted)).where("kept").select("_row.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    names = [f"`{c}`" for c in docs.columns]
    row = docs.select(F.struct(*names).alias("_row"), "text")
    return toxicity.score(row, model).where("toxicity < 0.5").select("_row.*")


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates. Rows that share an id are
    one document and stay or go together."""
    groups = near_dup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(groups, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    names = [f"`{c}`" for c in docs.columns]
    row = docs.select(F.struct(*names).alias("_row"), "text")
    found = decontamination.scan(row, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("found.spans") == 0).select("_row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of each document, digests of its ids and of the text they decode to."""
    return bpe_digests(docs)


STAGES: list[tuple[str, Callable]] = [
    ("quality", quality),
    ("toxicity", toxic),
    ("near_duplicates", duplicates),
    ("decontamination", clean),
    ("encoding", encoded),
]
# SQL cannot learn the toxicity models
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
