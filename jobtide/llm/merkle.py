"""A Merkle manifest of a dataset: digests of rows, of runs of three, of sources, and one root.

The tree of a source has its rows as leaves, by `doc_id`; the top tree has the roots of the sources
as leaves, by source. Nodes are records digest -> children; those of LEVELS levels lie in one row, a
page, found by the digest of its top. A request for a leaf descends from the root, page by page, by
the digits of its rank to base FAN, and collects the children that it doesn't select.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import stored
from jobtide.llm.order import scanned

FAN = 3
LEVELS = 5
PAGE = FAN ** LEVELS
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_PATH = "array<struct<before:string,after:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: of each field its length in bytes, a colon and its value; null is `-`."""
    texts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def climb(digests: list[str], whole: bool) -> tuple[str, int, list[tuple[str, list[str]]]]:
    """Top, height and records over neighbouring nodes: all levels up to one node if they are the
    whole tree, else LEVELS levels."""
    records, height = [], 0
    while len(digests) > 1 if whole else height < LEVELS:
        runs = [digests[i:i + FAN] for i in range(0, len(digests), FAN)]
        digests = [digest("".join(run)) for run in runs]
        records += zip(digests, runs)
        height += 1
    return digests[0], height, records


def descend(top: str, height: int, records: dict[str, list[str]], slot: int) -> tuple[str, list]:
    """Digest at a slot below a page's top, and the children left and right of the way down."""
    path = []
    for level in reversed(range(height)):
        digit = slot // FAN ** level % FAN
        run = records[top]
        path.append({"before": "".join(run[:digit]), "after": "".join(run[digit + 1:])})
        top = run[digit]
    return top, path


_PAGE = "struct<top:string,height:int,records:array<struct<digest:string,children:array<string>>>>"


def _climb(nodes: pa.Array, whole: pa.Array) -> pa.Array:
    out = []
    for row, all_ in zip(nodes.to_pylist(), whole.to_pylist()):
        top, height, records = climb([x["digest"] for x in row], all_)
        out.append({"top": top, "height": height, "records": [
            {"digest": d, "children": run} for d, run in records]})
    return pa.array(out, pa.struct([
        ("top", pa.string()), ("height", pa.int32()), ("records", pa.list_(pa.struct([
            ("digest", pa.string()), ("children", pa.list_(pa.string()))])))]))


def _descend(top: pa.Array, height: pa.Array, records: pa.Array, slots: pa.Array) -> pa.Array:
    out = []
    for t, h, known, wanted in zip(top.to_pylist(), height.to_pylist(), records.to_pylist(), slots.to_pylist()):
        known = {x["digest"]: x["children"] for x in known}
        found = (descend(t, h, known, s) for s in wanted)
        out.append([{"digest": d, "path": path} for d, path in found])
    return pa.array(out, pa.list_(pa.struct([
        ("digest", pa.string()), ("path", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))])))


@dataclass
class Manifest:
    root: str | None  # of an empty table None
    rounds: int  # pages from the root to a source's root
    pages: DataFrame  # top, height, records
    trees: DataFrame  # tree, source, n, digest, rounds: the root of each source and the pages below it
    leaves: DataFrame  # the rows given, with tree, place


def _trees(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
    """Roots (tree, digest, rounds) and pages of trees whose leaves are (tree, n, place, digest).

    Each round makes pages of PAGE nodes and goes on with their tops, so a round has a row for PAGE
    rows of the last.
    """
    roots, pages, rounds = [], [], 1
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        held = nodes.groupBy("tree", "n", F.floor(F.col("place") / PAGE).alias("place")).agg(
            F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("nodes"))
        whole = F.col("n") <= PAGE
        held = held.withColumn("page", F.arrow_udf(_climb, _PAGE)("nodes", whole)).select("tree", "n", "place", "page.*")
        held = stored(held, f"{name}{rounds}")
        level = F.when(F.col("height") > 0, F.lit(rounds)).otherwise(0)
        roots.append(held.where(whole).select("tree", F.col("top").alias("digest"), level.alias("rounds")))
        pages.append(held.where("height > 0").select("top", "height", "records"))
        if most <= PAGE:
            break
        nodes = held.where(~whole).select(
            "tree", F.ceil(F.col("n") / PAGE).alias("n"), "place", F.col("top").alias("digest"))
        most, rounds = -(-most // PAGE), rounds + 1
    every, all_pages = roots[0], pages[0]
    for r, p in zip(roots[1:], pages[1:]):
        every, all_pages = every.unionByName(r), all_pages.unionByName(p)
    return every, all_pages


def manifest(rows: DataFrame) -> Manifest:
    """Manifest over rows of (doc_id, source, leaf) and any other columns but `tree` and `place`.

    Rows without a doc_id come first in their source, those that share one by their leaf. A null
    source is a source. Rows are ranked by ranges, so that a source may hold any part of them.
    """
    leaves = scanned(rows, ["source"], ["doc_id", "leaf"], "leaves", {"place": F.lit(1)})
    sizes = stored(leaves.groupBy("source").agg(F.count("*").alias("n")), "sizes")
    sizes = stored(scanned(sizes, [], ["source"], "sources", {"tree": F.lit(1)}), "sources")
    known = sizes.select(F.col("source").alias("_source"), "tree", "n")
    leaves = stored(leaves.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), "leaves")
    roots, pages = _trees(leaves.select("tree", "n", "place", F.col("leaf").alias("digest")), "pages")
    trees = stored(sizes.join(roots, "tree"), "trees")
    n = trees.count()
    top, more = _trees(trees.select(F.lit(0).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"),
                                    F.col("tree").alias("place"), "digest"), "top")
    root = top.first()
    # equal rows make equal pages, of which one is kept
    held = stored(pages.unionByName(more).groupBy("top").agg(
        F.any_value("height").alias("height"), F.any_value("records").alias("records")), "dag")
    return Manifest(root and root.digest, root.rounds if root else 0, held, trees, leaves.drop("n"))


def _down(frontier: DataFrame, asked: DataFrame, pages: DataFrame) -> DataFrame:
    """One page further: from (tree, place, digest, path) to the nodes below the page that are
    asked for, as (tree, place, row): `row` is what is asked, with the place."""
    wanted = asked.groupBy("tree", F.floor(F.col("place") / PAGE).alias("_block")).agg(
        F.collect_list(F.struct(*asked.columns)).alias("asked"))
    met = frontier.withColumnsRenamed({"place": "_block", "digest": "top"}).join(wanted, ["tree", "_block"]).join(pages, "top")
    slots = F.transform("asked", lambda a: (a["place"] % PAGE).cast("int"))
    walk = F.arrow_udf(_descend, f"array<struct<digest:string,path:{_PATH}>>")
    met = met.withColumn("found", walk("top", "height", "records", slots))
    each = met.select(F.col("path").alias("_above"), F.explode(F.arrays_zip("asked", "found")).alias("_x"))
    return each.select("_x.asked.*", F.col("_x.found.digest").alias("digest"),
                       F.concat("_above", "_x.found.path").alias("path"))


def proofs(made: Manifest, requests: DataFrame) -> DataFrame:
    """Proof of each request (tree, place and any other columns but `digest` and `path`): the leaf's
    `digest` in the manifest and `path`, from the root down, of the digests left and right of it.

    Requests below one page travel as one row until the last page. A request asked twice comes twice.
    """
    spark = requests.sparkSession
    start = spark.createDataFrame([(0, 0, made.root)], "tree long, place long, digest string").where(
        F.col("digest").isNotNull()).withColumn("path", F.array().cast(_PATH))
    trees = made.trees.join(requests.select("tree").distinct(), "tree", "left_semi")
    asked = stored(trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "rounds"), "asked")
    for r in reversed(range(made.rounds)):
        start = _down(start, _at(asked, r), made.pages)
    if not made.rounds:
        start = start.join(asked, ["tree", "place"])
    roots = stored(start.select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"),
                                "digest", "path", "rounds"), "roots")
    most = roots.agg(F.max("rounds")).first()[0] or 0
    steps = ["tree", "place", "digest", "path"]
    now = roots.where(F.col("rounds") == most).select(steps)
    for r in reversed(range(1, most)):
        below = requests.select("tree", F.floor(F.col("place") / PAGE ** r).alias("place")).distinct()
        now = _down(now, below, made.pages).select(steps)
        now = stored(now.unionByName(roots.where(F.col("rounds") == r).select(steps)), "frontier")
    if most:
        now = _down(now, requests, made.pages)
        alone = roots.where("rounds = 0").select(steps).join(requests, ["tree", "place"])
        return now.unionByName(alone.select(now.columns))
    return now.join(requests, ["tree", "place"])


def _at(asked: DataFrame, r: int) -> DataFrame:
    if not r:
        return asked
    return asked.select("tree", F.floor(F.col("place") / PAGE ** r).alias("place")).distinct()


def siblings(path: Column) -> Column:
    """Digest of the path's digests, from the leaf up."""
    return F.sha2(F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s["before"], s["after"])), "")
                  .cast("binary"), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(F.reverse(path), start, lambda d, s: F.sha2(
        F.concat(s["before"], d, s["after"]).cast("binary"), 256))


def with_leaves(docs: DataFrame, tamper: Callable[[Column], Column], tampered: Column) -> DataFrame:
    """(doc_id, source, leaf, now): the digest of each row, and what it is where `tampered` holds and
    the text has gone through `tamper`."""
    fields = [F.col(c) for c in FIELDS]
    changed = leaf([*fields[:-1], tamper(fields[-1])])
    return docs.select("doc_id", "source", leaf(fields).alias("leaf"),
                       F.when(F.coalesce(tampered, F.lit(False)), changed).otherwise(leaf(fields)).alias("now"))


def verified(rows: DataFrame) -> DataFrame:
    """Manifest of (doc_id, source, leaf, now) rows, the proof of every row, and whether it holds for
    `now`: doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified, path.

    An empty table gives none.
    """
    made = manifest(rows)
    found = proofs(made, made.leaves.select("tree", "place", "doc_id", "source", "now"))
    subroots = made.trees.select("tree", F.col("digest").alias("subroot"))
    root = F.lit(made.root)
    return found.join(subroots, "tree").select(
        "doc_id", "source", F.col("digest").alias("leaf"), "subroot", root.alias("root"),
        siblings(F.col("path")).alias("proof_sha256"), fold(F.col("now"), F.col("path")).alias("folded_root"), "path",
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
