"""Keyed layouts and substring search against plain Python."""

import glob
import random
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from jobtide.operators import lookups, serving
from jobtide.session import shared_dir
from test_queries import plan_of


def like(name, term):
    parts = re.findall(r"(?s)\\.|[^\\]", "%" + term.lower() + "%")
    body = "".join(".*" if p == "%" else "." if p == "_" else re.escape(p[-1]) for p in parts)
    return re.fullmatch(body, name.lower(), re.DOTALL) is not None


def search(spark, names, terms):
    n = spark.createDataFrame([(x,) for x in names], "name string")
    t = spark.createDataFrame([(x,) for x in terms], "term string")
    return sorted(tuple(r) for r in lookups.names_holding(t, lookups.postings(n, "name")).collect())


def wanted(names, terms):
    return sorted({(t, n.lower()) for t in terms if t is not None for n in names
                   if n is not None and like(n, t)})


def test_substrings_against_every_pair(spark, monkeypatch):
    rng = random.Random(3)
    names = ["".join(rng.choices("abAB _%ł.", k=rng.randint(0, 9))) for _ in range(120)]
    names += ["Acme", "ACME", "acme\nsp", "", None, "a\\b", "100%"]
    terms = ["".join(rng.choices("abAB _%ł.", k=rng.randint(0, 5))) for _ in range(80)]
    terms += ["ac", "ME", "a", "%", "_", "", None, "\\%", "0\\%", "\\_", "a\\\\b", "zzzz", "acme sp"]
    assert search(spark, names, terms) == wanted(names, terms)
    monkeypatch.setattr(lookups, "is_small", lambda df: False)
    assert search(spark, names, terms) == wanted(names, terms)


def test_substrings_of_nothing(spark):
    assert search(spark, [], ["a"]) == search(spark, ["a"], []) == search(spark, [None], [None]) == []


def test_grams_of_a_term(spark):
    df = spark.createDataFrame([("%ab_Cdef%\\%",), ("%",), ("",)], "t string")
    got = [sorted(r[0]) for r in df.select(lookups.term_grams(F.col("t"))).collect()]
    assert got == [["%", "ab", "cde", "def"], [""], [""]]


SNAPSHOT = ("listing_id string, employment_type string, salary_min double, salary_max double, "
            "currency string, is_gross boolean, title string, company_name string")


def test_search_says_what_one_term_says(spark):
    rng = random.Random(8)
    rows = [(f"l{i:03}", rng.choice(["b2b", None]), rng.choice([None, 0.0, 100.0, 300.0]),
             rng.choice([None, 0.0, 500.0]), rng.choice(["PLN", None, "EUR"]), rng.choice([True, None]),
             rng.choice(["", "Dev", "Boss"]) + (str(i) if i % 3 else ""),
             # most offers are of one company
             rng.choice(["Acme", "acme", "Acme", "Globex", "Initech sp", None])) for i in range(200)]
    snapshot = spark.createDataFrame(rows, SNAPSHOT)
    facts = lookups.company_facts(snapshot)
    terms = ["acme", "E", "x", "e_", "%", "nobody", "h sp"]
    got = {r.company: tuple(r)[1:] for r in lookups.company_search(
        spark.createDataFrame([(t,) for t in terms], "term string"), facts,
        lookups.postings(facts, "name")).collect()}
    one = {t: serving.company_intel(snapshot, t).collect() for t in terms}
    assert got == {t: tuple(r[0])[1:] for t, r in one.items() if r}
    posted = lookups.postings(facts, "name")
    stored = {t: lookups.company_lookup(t, facts, posted).collect() for t in [*terms, "\\\\_", ""]}
    assert {t: stored[t] for t in terms} == one and not stored["\\\\_"]
    assert stored[""][0].listing_count == one["%"][0].listing_count
    assert "nobody" not in got and len(got) == 6


def test_point_reads_open_one_row_group(spark):
    path = f"{shared_dir(spark)}/keyed-{random.random()}"
    rows = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id")
    stored = lookups.write_keyed(rows.repartition(7), path, "k", row_group=1 << 20)
    key = rows.where("id = 777").first().k
    found = lookups.rows_of(stored, "k", [key])
    assert [r.id for r in found.collect()] == [777]
    assert f"EqualTo(k,{key})" in plan_of(found) or f"In(k, [{key}])" in plan_of(found)
    groups = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        groups += [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
    assert len(groups) > 4 and sum(g.min <= key <= g.max for g in groups) == 1


def test_a_hot_key_is_cut(spark):
    path = f"{shared_dir(spark)}/hot-{random.random()}"
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(
        F.col("id").cast("string")).alias("k"), "id").repartition(4)
    stored = lookups.write_keyed(rows, path, "k", "id")
    assert stored.count() == 40_000
    hot = lookups.rows_of(stored, "k", ["hot"])
    assert hot.count() == 26_666
