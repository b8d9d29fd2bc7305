"""Newest listings from lines alone, against the way that carries along what a line refers to."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from jobtide.operators import history, lookups, silver
from jobtide.plans import catalog

DAY = datetime(1996, 3, 1, 10)
LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
         "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
         "l_linestatus string, l_shipdate timestamp")


def line(order, part, supplier, number, quantity=5.0, price=1000.0, day=DAY):
    return (order, part, supplier, number, quantity, price, 0.05, 0.05, "N", "O", day)


ROWS = [
    line(1, 1, 1, 2), line(1, 2, 1, 2),  # a tie that the titles settle
    line(2, 1, 1, 2), line(2, 1, 2, 2), line(2, 1, 2, 2, price=2000.0),  # the companies, the pay
    line(3, 1, 1, 3), line(3, 9, 1, 3, day=datetime(1997, 1, 1)),  # the newer one has no part
    line(4, 1, 1, 3), line(4, 1, 9, 3, day=datetime(1997, 1, 1)),  # no supplier
    line(5, None, 1, 1), line(6, 1, None, 1),
    line(7, 2, 1, 4, quantity=48.0), line(7, 1, 1, 4),  # a named run goes before none
    line(8, 1, 2, 5, day=None), line(8, 1, 1, 5, day=datetime(1999, 5, 5)),
    line(None, 1, 1, 1), line(None, 2, 1, 4), line(9, 2, 2, None), line(None, 1, 2, None, day=None),
    line(10, 1, 1, 1, quantity=None), line(10, 2, 1, 1, quantity=48.0),
    line(11, 1, 1, 1, quantity=14.0), line(11, 2, 1, 1, quantity=13.0), line(11, 2, 1, 1),
]


def tables(spark, folder, *more_parts):
    parts = [(1, "blue tin", "B#1", "PROMO TIN", 3, 1.0), (2, "red tin", "B#2", "LARGE TIN", 4, 1.0), *more_parts]
    for name, rows, schema in (
        ("lineitem", ROWS, LINES),
        ("part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        ("supplier", [(1, "S1", 1, 0.0), (2, "S2", 1, 0.0), (9, "S9", 7, 0.0)],
         "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        ("nation", [(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return catalog.Tables(spark, str(folder))


def rows_of(df):
    return sorted((repr(r) for r in df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("more", [[], [(1, "a second row", "B#3", "PROMO TIN", 3, 1.0)]])
def test_newest_lines(spark, tmp_path, more):
    t = tables(spark, tmp_path, *more)
    rows, derive = t.source()
    # keys that repeat among the parts make several listings of a line
    assert isinstance(derive, silver.Narrow) == (not more)
    assert ("p_name" in rows.columns) == bool(more)
    found = rows_of(t.silver())
    assert found == rows_of(silver.clean(t.raw().transform(
        lambda raw: catalog.bronze.coerce_bronze(raw, ingested_at=F.col("ingested_at"))), t.now))
    assert len(found) >= 8


def test_many_keys_without_a_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "FEW", 0)
    t = tables(spark, tmp_path)
    assert t.referred() is None
    assert rows_of(t.silver()) == rows_of(silver.clean(t.bronze(), t.now))


def test_lifetime_reads_what_makes_a_version(spark, tmp_path):
    t = tables(spark, tmp_path)

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "seniority" in plan(catalog._history(t))
    narrow = catalog._history(t, history.KEY, *history.CHECKED)
    assert "seniority" not in plan(narrow)
    assert "seniority" not in plan(catalog.QUERIES["listing_lifetime"](spark, str(tmp_path)))
    assert rows_of(history.lifetime(narrow, t.now)) == rows_of(history.lifetime(catalog._history(t), t.now))


def test_keyed_table_is_computed_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        calls.add(1)
        return x

    df = spark.range(100).select(seen("id").alias("k"))
    stored = lookups.write_keyed(df, str(tmp_path / "keyed"), "k")
    assert (stored.count(), calls.value) == (100, 100)


def test_ties_are_looked_for_among_few_rows(spark, tmp_path, monkeypatch):
    t = tables(spark, tmp_path)
    rows, derive = t.source()
    key = silver.key_hash(derive)
    may = rows.join(derive.tied, key == derive.tied["_key"], "left_semi")
    # every listing with equal stamps, newest or not, the one without an id (order 9), and no other
    assert {r[0] for r in may.select("l_orderkey").collect()} == {1, 2, 11, 9, None}
    found = rows_of(t.silver())
    monkeypatch.setattr(catalog, "SENT", 2)
    whole = catalog.Tables(spark, str(tmp_path))
    assert whole.source()[1].tied is None
    assert found == rows_of(whole.silver())


def loads_as_before(t):
    """What two loads of the whole bronze table leave, the second with runs that the first lacks."""
    old = F.col("date_collected") < catalog.b.HALFWAY
    first = t.bronze().where(old)
    rest = t.bronze().join(first.select(F.col("source_run_id").alias("guard_run_id")).distinct(), "guard_run_id", "left_anti")
    return first.unionByName(rest, allowMissingColumns=True).drop("guard_run_id")


@pytest.mark.parametrize("more", [[], [(1, "a second row", "B#3", "PROMO TIN", 3, 1.0)]])
def test_loads_make_texts_of_new_runs(spark, tmp_path, monkeypatch, more):
    monkeypatch.setattr(catalog, "shared_dir", lambda _: str(tmp_path))
    t = tables(spark, tmp_path, *more)
    taken = []
    monkeypatch.setattr(catalog.Tables, "loaded", lambda self, rows, made=catalog.Tables.loaded: (
        taken.append(rows.count()), made(self, rows))[1])
    found = rows_of(catalog.QUERIES["bronze_loads"].__closure__[0].cell_contents(t))
    columns = ["listing_id", "title", "source_run_id", "date_collected"]
    assert found == rows_of(loads_as_before(t).select(*columns))
    # the second load makes rows of the lines of 1999, and of those without a run of their own
    assert len(taken) == 2 and 0 < taken[1] < len(ROWS) and taken[0] < len(ROWS)
    (folder,) = tmp_path.glob("bronze-*")
    stored = catalog.bronze.read_bronze(spark, str(folder))
    assert rows_of(stored.drop("run")) == rows_of(loads_as_before(t))
    assert stored.where("coalesce(run, '') != source_run_id").isEmpty()


def test_load_is_sorted_before_texts_are_made(spark, tmp_path):
    t = tables(spark, tmp_path)
    lines = catalog.b.lines_of_runs(t.table("lineitem"))
    plan = t.loaded(lines)._jdf.queryExecution().optimizedPlan().toString()
    sort = plan.index("Sort [run#")
    assert "https://apply.example.com/" in plan[:sort] and "https://apply.example.com/" not in plan[sort:]


def test_rows_without_a_listing_are_no_load(spark, tmp_path):
    t = tables(spark, tmp_path)
    lines = catalog.b.lines_of_runs(t.table("lineitem").where("l_orderkey = 5"))
    assert not catalog.bronze.append_new_runs(lines, str(tmp_path / "none"), t.loaded)
    assert catalog.bronze.read_bronze(spark, str(tmp_path / "none")).isEmpty()
