"""Every registered query against its SQL twin on the smallest test tables."""

import contextlib
import io

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows
from jobtide.operators import usage
from jobtide.plans import catalog, twins
from jobtide.plans.bindings import _TABLES

SF = "/root/testdata/sf0.001"
QUERIES, TWINS = catalog.QUERIES, twins.all_twins()


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for name in _TABLES:
        db.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return db


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    for product in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert product not in plan
    mine = rows(df.columns, df.collect())
    cur = con.execute(TWINS[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine and mine == rows(columns, cur.fetchall())


def test_dedup_limits_each_listing_before_the_shuffle(spark):
    plan = plan_of(QUERIES["silver_clean"](spark, SF))
    shuffle = plan.index("Exchange hashpartitioning(listing_id")
    assert plan.rindex("WindowGroupLimit") > shuffle > plan.index("WindowGroupLimit")


def test_marts_shuffle_listings_once_and_then_only_partial_counts(spark):
    for name in ("mart_demand", "mart_city", "mart_trends", "mart_cooccurrence"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert plan.count("Exchange hashpartitioning(listing_id") == 1
        assert "partial_count" in plan and "SortMergeJoin" not in plan
    assert plan_of(QUERIES["mart_snapshot"](spark, SF)).count("Exchange hashpartitioning") == 1
    assert "PushedFilters: [IsNotNull(l_partkey)" in plan_of(QUERIES["mart_trends"](spark, SF))


def test_digest_pairs_are_not_shuffled(spark):
    plan = plan_of(QUERIES["daily_digest"](spark, SF))
    assert "Exchange" not in plan[:plan.index("BroadcastHashJoin [_key")]


def test_bridges_shuffle_listings_once_and_no_names(spark):
    for name in ("bridge_technology", "bridge_city"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert plan.count("Exchange hashpartitioning(listing_id") == 1
        assert "BroadcastHashJoin" in plan and "hashpartitioning(technology_name" not in plan


def test_resets_are_looked_up_without_a_window_over_all_events(spark):
    plan = plan_of(QUERIES["usage_resets"](spark, SF))
    assert "_all" not in plan and "SinglePartition" not in plan.split("Subquery")[0]


def test_quantiles_order_only_the_ranges_that_hold_the_ranks(spark):
    plan = plan_of(QUERIES["mart_salary"](spark, SF))
    assert "percentile" not in plan and "ObjectHashAggregate" not in plan
    # every window over amounts is one inside a range; those over a group see ranges
    for line in plan.splitlines():
        if "Window [" in line and "_x" in line:
            assert "_range" in line.split("windowspecdefinition(")[1].split("_x")[0]


def test_no_window_on_a_literal(spark, monkeypatch):
    monkeypatch.setattr(usage, "is_small", lambda marks, n: False)
    df = catalog.flat(usage.reset_counts(catalog.tables(spark, SF).usage()))
    assert "_all" not in plan_of(df) and "SinglePartition" not in plan_of(df).split("Subquery")[0]
    want = QUERIES["usage_resets"](spark, SF)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.collect())
