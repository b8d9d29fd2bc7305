import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from jobtide.llm import merkle, order
from jobtide.llm.common import rest

KIND = "doc_id long, text string, lang string, source string, n_chars long, tree string, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """(doc_id, leaf) -> (subroot, root, proof, folded), by the definition."""
    def one(row, text):
        values = [row[0], row[3], row[2], row[4], text]
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(nodes):
        """Root, and for each node the runs from the lowest up, with its place in them."""
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
            for way, i in zip(ways, at):
                way.append((runs[i // 3], i % 3))
            nodes, at = [sha("".join(r)) for r in runs], [i // 3 for i in at]
        return nodes[0], ways

    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0], one(r, r[1])))
        trees[s] = own, *tree([one(r, r[1]) for r in own])
    root, above = tree([trees[s][1] for s in sources])
    out = []
    for s, up in zip(sources, above):
        own, subroot, ways = trees[s]
        for r, way in zip(own, ways):
            way = way + up
            bad = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now = one(r, r[1].replace("\n", "") if bad else r[1])
            for run, i in way:
                now = sha("".join([*run[:i], now, *run[i + 1:]]))
            proof = sha("".join("".join([*run[:i], *run[i + 1:]]) for run, i in way))
            out.append((r[0], one(r, r[1]), subroot, root, proof, now, now == root))
    return out


def mine(docs):
    rows = merkle.with_leaves(docs, lambda t: F.replace(t, F.lit("\n"), F.lit("")), rest("doc_id", 2) == 0)
    return [tuple(r) for r in merkle.verified(rows).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def docs_of(seed, n, sources, repeat=0):
    rng = random.Random(seed)
    text = lambda: rng.choice([None, "", "é\nü", "a\nb\n", "x" * 20000, f"plain {rng.random()}"])
    rows = [(rng.choice([None, i, i, i, 7]), text(), rng.choice(["de", None]), rng.choice(sources),
             rng.choice([None, i]), "t", "d") for i in range(n)]
    return rows + [rows[0]] * repeat


@pytest.mark.parametrize("rows", [
    docs_of(1, 1, ["a"]), docs_of(2, 3, ["a", None]), docs_of(3, 40, [None, "", "b", "ä", "z", "Z"]),
    docs_of(4, 300, ["hot", "hot", "hot", "b", None], 600), docs_of(5, 244, ["one"])],
    ids=["row", "three", "sources", "hot", "one source"])
def test_proofs_against_a_plain_tree(spark, rows):
    got = mine(spark.createDataFrame(rows, KIND))
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_an_empty_table_has_no_root(spark):
    docs = spark.createDataFrame([], KIND)
    assert mine(docs) == [] and merkle.manifest(merkle.with_leaves(docs, lambda t: t, F.lit(False))).root is None


def test_some_leaves_only(spark):
    rows = docs_of(6, 900, ["a", "b"])
    made = merkle.manifest(merkle.with_leaves(spark.createDataFrame(rows, KIND), lambda t: t, F.lit(False)))
    some = made.leaves.where("tree = 1 and place % 97 = 5").select("tree", "place", "leaf")
    found = merkle.proofs(made, some).select("leaf", "digest", merkle.fold(F.col("digest"), F.col("path"))).collect()
    assert len(found) == some.count() > 1
    assert all(r[0] == r[1] and r[2] == made.root for r in found)


def test_running_totals(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["hot", "hot", "hot", None, "b"]), rng.randrange(50), rng.randrange(-5, 9)) for _ in range(3000)]
    rows += [("hot", 3, 1)] * 3000
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = order.scanned(df, ["k"], ["o", "v"], "totals", {"place": F.lit(1), "total": F.col("v")}, {"x": F.col("v")})
    got = sorted(map(tuple, got.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[3]))
    want, now = [], {}
    for k, o, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        place, total, x = now.get(k, (0, 0, 0))
        want.append((k, o, v, place, total, x))
        now[k] = place + 1, total + v, x ^ v
    assert got == want
