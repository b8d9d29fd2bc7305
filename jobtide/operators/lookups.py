"""Marts laid out for lookups of a few keys, and substring search over names by postings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.functions.skew import is_small, lookup_join
from jobtide.operators.serving import SNAPSHOT_ORDER, intel, whole
from jobtide.sources.layers import write_layer

ROW_GROUP = 8 << 20
GRAM = 3
SAMPLES = 5
PARTS = 16


# ---------------------------------------------------------------- layout
def write_keyed(df: DataFrame, path: str, key: str, *then: str, row_group: int = ROW_GROUP) -> DataFrame:
    """Store a table for reads of a few keys, and give it back.

    Rows are dealt by ranges of the key and sorted by it, in small row groups with a Bloom filter,
    so that a filter on the key opens the row groups that may hold it and of these the pages that
    do. Columns named in `then` go on with the order, so that a hot key is cut into several ranges.
    The ranges are found in a first copy beside it, since the table would be computed a second time
    for the sample they are taken from.
    """
    laid = write_layer(df, f"{path}-rows")
    (laid.repartitionByRange(key, *then).sortWithinPartitions(key, *then).write.mode("overwrite")
     .option("parquet.block.size", row_group)
     .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_of(stored: DataFrame, key: str, values: list) -> DataFrame:
    """Rows of the given keys; the filter reaches the scan."""
    return stored.where(F.col(key).isin(values))


# ---------------------------------------------------------------- substrings
def _pieces(pattern: Column) -> Column:
    """The literal pieces of a search term, in which % and _ are wildcards and \\ takes the sign after it
    as it stands."""
    parts = F.regexp_extract_all(pattern, F.lit(r"(?s)((?:[^%_\\]|\\.)+)"), F.lit(1))
    return F.transform(parts, lambda p: F.regexp_replace(p, r"(?s)\\(.)", "$1"))


def _grams(text: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.when(F.length(text) >= size, F.transform(starts, lambda i: F.substr(text, i, F.lit(size)))).otherwise(
        F.array().cast("array<string>"))


def postings(names: DataFrame, name: str) -> DataFrame:
    """(gram, name): each distinct name, in lower case, under all its stretches of 1 to GRAM signs and
    under the empty one. A frequent gram has many rows, never one long list."""
    lowered = names.select(F.lower(name).alias("name")).where("name is not null").distinct()
    grams = F.concat(F.array(F.lit("")), *[_grams(F.col("name"), n) for n in range(1, GRAM + 1)])
    return lowered.select(F.explode(F.array_distinct(grams)).alias("gram"), "name")


def term_grams(term: Column) -> Column:
    """Grams that every name with the term must hold: those of GRAM signs, and pieces that are shorter
    as they stand; the empty one for a term of wildcards."""
    low = F.lower(term)
    every = F.flatten(F.transform(_pieces(low), lambda p: F.when(F.length(p) < GRAM, F.array(p)).otherwise(
        _grams(p, GRAM))))
    return F.when(F.size(every) > 0, F.array_distinct(every)).otherwise(F.array(F.lit("")))


def names_holding(terms: DataFrame, posted: DataFrame) -> DataFrame:
    """(term, name) for each distinct term and each name that is `like` it.

    A term reads the postings of its rarest gram only; what it finds there is compared whole. Terms
    with a gram that no name has are out before anything is compared.
    """
    term = F.col("term")
    asked = terms.select("term").where("term is not null").distinct().select(
        "term", F.explode(term_grams(term)).alias("gram"))
    frequent = posted.groupBy("gram").agg(F.count(F.lit(1)).alias("names"))
    rarest = (lookup_join(asked, frequent, ["gram"], term).groupBy("term")
              .agg(F.min_by("gram", F.struct(F.coalesce("names", F.lit(0)), "gram")).alias("gram")))
    if is_small(rarest):
        found = posted.join(F.broadcast(rarest), "gram")
    else:
        # a frequent gram is not one task: its terms are dealt into parts, its names repeated for each
        asked = rarest.withColumn("_part", F.pmod(F.xxhash64("term"), F.lit(PARTS)).cast("int"))
        found = posted.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).join(
            asked, ["gram", "_part"])
    return found.select("term", "name").where(F.expr("name like concat('%', lower(term), '%')"))


# ---------------------------------------------------------------- companies
def company_facts(snapshot: DataFrame) -> DataFrame:
    """One row per company, in lower case: offers, sums and counts of known pay, and its first
    offers in the order of the snapshot."""
    rows = snapshot.withColumn("name", F.lower("company_name")).where("name is not null")

    def known(col: str) -> Column:
        return F.when(F.col(col) != 0, F.col(col))

    totals = rows.groupBy("name").agg(
        F.count(F.lit(1)).alias("listings"),
        *[f(known(f"salary_{c}")).alias(f"{n}_{c}") for c in ("min", "max")
          for n, f in (("sum", F.sum), ("known", F.count))])
    order = [F.asc_nulls_last(c) for c in SNAPSHOT_ORDER]
    first = rows.withColumn("_n", F.row_number().over(W.partitionBy("name").orderBy(*order))).where(
        F.col("_n") <= SAMPLES)
    # SAMPLES rows at most for a name
    first = first.groupBy("name").agg(F.collect_list(F.struct(*SNAPSHOT_ORDER, "title")).alias("first"))
    return totals.join(first, "name")


def _totals() -> list[Column]:
    return [F.sum("listings").alias("listing_count"),
            *[whole(F.sum(f"sum_{c}") / F.nullif(F.sum(f"known_{c}"), F.lit(0))).alias(f"avg_{c}")
              for c in ("min", "max")]]


def company_lookup(term: str, facts: DataFrame, posted: DataFrame) -> DataFrame:
    """`serving.company_intel` from stored facts and postings. The names under one gram of the term are
    read, the last of its longest piece, and compared with the whole term."""
    low = term.lower()
    pieces = [re.sub(r"(?s)\\(.)", r"\1", p) for p in re.findall(r"(?s)(?:[^%_\\]|\\.)+", low)]
    gram = max(pieces, key=len, default="")[-GRAM:]
    names = posted.where((F.col("gram") == gram) & F.col("name").like(f"%{low}%")).select("name")
    hits = facts.join(names, "name", "left_semi")
    return intel(term, hits.agg(*_totals()), hits.select(F.inline("first")))


def company_search(terms: DataFrame, facts: DataFrame, posted: DataFrame) -> DataFrame:
    """What `serving.company_intel` says of one term, for each distinct term that some company's
    name holds. Offers are folded by company first, so a term meets companies, not offers."""
    hits = names_holding(terms, posted).join(facts, "name")
    totals = hits.groupBy("term").agg(*_totals())
    order = [F.asc_nulls_last(c) for c in SNAPSHOT_ORDER]
    first = (hits.select("term", F.inline("first"))
             .withColumn("n", F.row_number().over(W.partitionBy("term").orderBy(*order)))
             .where(F.col("n") <= SAMPLES)
             .groupBy("term").agg(F.array_sort(F.collect_list(F.struct("n", "currency", "title"))).alias("s")))
    return totals.join(first, "term").select(
        F.col("term").alias("company"), "listing_count", "avg_min", "avg_max",
        F.get("s", F.lit(0))["currency"].alias("currency"),
        F.filter(F.transform("s", lambda x: x["title"]), lambda t: t != "").alias("sample_titles"))
