"""Sources, silver, star schema, marts, history and checks on hand-made rows."""

import csv
import glob
import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from jobtide.functions.pay import parse_variants
from jobtide.operators import checks, history, marts, silver, star
from jobtide.plans import build
from jobtide.schemas import LISTING_FIELDS, RAW_OFFER
from jobtide.sources import alerts, bronze, commits, configs, envelope, export, layers, offers

START, END = date(2026, 1, 1), date(2026, 12, 31)


def now():
    return F.lit(datetime(2026, 9, 1))


def listing(**fields):
    base = {f: None for f in LISTING_FIELDS} | {
        "listing_id": "x", "title": "T", "company_name": "C", "date_collected": "2026-08-01",
        "posted_date": "2026-08-01T08:00:00.000Z", "source_run_id": "r1"}
    base |= {k: json.dumps(v) if isinstance(v, list) else v for k, v in fields.items()}
    return tuple(base[f] for f in LISTING_FIELDS)


def bronze_of(spark, *rows):
    df = spark.createDataFrame(list(rows), ", ".join(f"{f} string" for f in LISTING_FIELDS))
    return bronze.coerce_bronze(df, F.lit("f.json"), F.lit(datetime(2026, 8, 1)))


def pay(low, high, kind="b2b", unit="month", currency="PLN"):
    return {"employment_type": kind, "salary_min": low, "salary_max": high, "currency": currency,
            "unit": unit, "is_gross": True}


# ---------------------------------------------------------------- sources
def test_envelope(spark, tmp_path):
    doc = {"metadata": {"date_collected": "2026-08-01"},
           "listings": [{"listing_id": "a", "cities": "Opole", "is_promoted": True,
                         "salary_variants": [{"salary_min": 1}], "extra": 1},
                        {"listing_id": "b", "source_run_id": "late"}]}
    (tmp_path / "raw_listings_1.json").write_text(json.dumps(doc, indent=1))
    rows = envelope.read_envelope(spark, str(tmp_path / "raw_listings_1.json")).orderBy("position")
    first, second = rows.collect()
    assert (first.cities, first.is_promoted) == ("Opole", "true")
    assert json.loads(first.salary_variants) == [{"salary_min": 1}]
    assert (first.guard_run_id, second.guard_run_id) == ("2026-08-01", "2026-08-01")
    (tmp_path / "raw_listings_2.json").write_text('{"metadata": {}, "listings": []}')
    assert envelope.read_envelope(spark, str(tmp_path / "raw_listings_2.json")).count() == 0
    both = envelope.read_envelope(spark, str(tmp_path / "raw_listings_1.json"))
    assert envelope.newest_file_listings(both, 1).count() == 1


def test_envelope_without_listings_is_empty(spark, tmp_path):
    (tmp_path / "none.json").write_text('{"metadata": {}}')
    assert envelope.read_envelope(spark, str(tmp_path / "none.json")).count() == 0


@pytest.mark.parametrize("text", [
    '[1, 2]', '{"metadata": {}, "listings": {"a": 1}}', 'nonsense', '{"listings": null}', '[]',
    '[{"metadata": {}, "listings": []}]'])
def test_envelope_of_wrong_shape_stops(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="not a listing envelope"):
        envelope.read_envelope(spark, str(tmp_path / "bad.json")).collect()


def test_coerce(spark):
    r = bronze_of(spark, listing(
        cities="Opole", required_skills=["a", "", None, "b"], nice_to_have_skills="text",
        salary_variants="5", is_promoted="true", is_super_offer="0", slug=None)).first()
    assert (r.cities, r.required_skills, r.nice_to_have_skills, r.salary_variants) == (
        ["Opole"], ["a", "b"], [], "[]")
    assert (r.is_promoted, r.is_super_offer, r.is_remote_interview, r.slug) == (
        True, False, False, "")


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "bronze")
    batch = bronze_of(spark, listing(listing_id="a")).withColumn("guard_run_id", F.lit("r1"))
    bronze.append_new_runs(batch, path)
    bronze.append_new_runs(batch, path)
    later = bronze_of(spark, listing(listing_id="b", source_run_id="r2"))
    bronze.append_new_runs(later.withColumn("guard_run_id", F.lit("r2")), path)
    stored = spark.read.parquet(path)
    assert sorted(r.listing_id for r in stored.collect()) == ["a", "b"]


def test_offers(spark):
    raw = {
        "guid": "g", "slug": "s", "category": '{"key":"data"}',
        "locations": [{"city": "B"}, {"city": "A"}, {"city": "B"}, {"city": ""}], "city": "Z",
        "employmentTypes": [
            {"from": 8000.0, "fromPerUnit": 165.0, "to": 9000.0, "toPerUnit": 190.0,
             "currencySource": "original", "type": "b2b", "unit": "hour", "currency": "PLN"},
            {"from": 1.0, "currencySource": "converted"},
            {"currencySource": "original", "type": "b2b"}],
        "requiredSkills": [{"name": "X"}, {"name": ""}, {"name": "W"}], "description": " ",
        "body": "text"}
    df = spark.createDataFrame([raw, {"guid": "", "slug": "only-slug", "locations": [{"city": ""}],
                                      "city": "Z"}, {"city": "Q"}], RAW_OFFER)
    a, b = offers.normalize_offers(df, "run", "now").orderBy("listing_id").collect()
    assert (a.listing_id, a.category, a.cities, a.required_skills, a.description) == (
        "g", "data", ["A", "B"], ["X", "W"], "text")
    assert [tuple(v) for v in a.salary_variants] == [("b2b", 165.0, 190.0, "PLN", "hour", True)]
    # locations that are there but hold no city do not fall back to the single city
    assert (b.listing_id, b.cities, b.salary_variants, b.is_promoted) == ("only-slug", [], [], False)
    assert offers.parse_report(df).first() == (3, 2, 1)
    again = bronze.coerce_bronze(offers.as_listing_text(
        offers.normalize_offers(df, "run", "now")), F.lit("f"), now()).orderBy("listing_id").first()
    assert (again.cities, again.required_skills) == (["A", "B"], ["X", "W"])


def test_configs(spark):
    stores = ['{"1": {"tolerance": 2, "cities": []}, "2": "gone", "3": {}}',
              '{"tolerance": 1, "seniorities": ["mid"]}', "[1]", "broken"]
    df = spark.createDataFrame([(s,) for s in stores], "value string")
    got = {r.chat_id: r for r in configs.load_configs(df).collect()}
    assert set(got) == {"1", "3"}
    assert (got["1"].tolerance, got["1"].cities, got["3"].tolerance) == (2, [], 1)
    assert len(got["1"].seniorities) == 7 and got["3"].skills == []


def test_alert_log_and_export(spark, tmp_path):
    pairs = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1")], "listing_id string, chat_id string")
    log = spark.createDataFrame([("b", "1")], "listing_id string, chat_id string")
    assert [r.listing_id for r in alerts.pairs_to_record(pairs, log, now()).collect()] == ["a"]
    rows = spark.createDataFrame([("a", 'say "hi"', ["X", "Y"], 1)],
                                 "listing_id string, title string, cities array<string>, other int")
    export.write_csv(rows, str(tmp_path / "csv"))
    part = max(glob.glob(str(tmp_path / "csv" / "*.csv")), key=os.path.getsize)
    out = list(csv.DictReader(open(part, encoding="utf-8", newline="")))
    assert (out[0]["cities"], out[0]["title"], len(out[0])) == ("X, Y", 'say "hi"', 13)


# ---------------------------------------------------------------- silver and gold
def test_clean_dedups_before_it_filters(spark):
    rows = silver.clean(bronze_of(
        spark,
        listing(listing_id="a", title="old", date_collected="2026-01-01"),
        listing(listing_id="a", title="", date_collected="2026-02-01"),
        listing(listing_id="b", seniority=" Mid ", workplace_type=" Office ", category=" x "),
        listing(listing_id=""), listing(listing_id="c", company_name=None)), now()).collect()
    got = {r.listing_id: r for r in rows}
    assert set(got) == {"b", ""}
    assert (got["b"].seniority, got["b"].workplace_type, got["b"].category) == ("mid", "onsite", "x")


@pytest.fixture(scope="module")
def stg(spark):
    return build.staging(bronze_of(
        spark,
        listing(listing_id="a", seniority="junior", cities=["Opole", "Opole", "Berlin"],
                required_skills=["py", "Rust"], nice_to_have_skills=["python", "sql"],
                salary_variants=[pay(100, 200, unit="Hour"), pay("8000", 9000, "permanent"),
                                 pay(100, 200, unit="Hour"), pay(0, 5)],
                expiry_date="2026-08-20T00:00:00Z"),
        listing(listing_id="b", seniority="", cities=["Opole"], required_skills=["Rust", "Python"],
                salary_variants=[pay("n/a", 10, ""), pay(5, None)], posted_date="2020-01-01"),
        listing(listing_id="c", required_skills=["python", "rust"], salary_variants=[],
                nice_to_have_skills=["Rust"]),
        listing(listing_id="d", required_skills=["Python", "Rust"],
                salary_variants=[pay(60000, 120000, unit="year")], posted_date="bad")), now())


def test_fact(spark, stg):
    priced = star.priced(stg, START, END)
    rows = star.fact(priced)
    got = sorted((r.listing_id, r.salary_min_monthly, r.salary_max_monthly) for r in rows.collect()
                 if r.salary_min_monthly)
    assert got == [("a", 8000.0, 9000.0), ("a", 16800.0, 33600.0), ("a", 16800.0, 33600.0),
                   ("b", 5.0, None), ("d", 5000.0, 10000.0)]
    joined = star.fact_by_joins(stg, build.dimensions(spark, stg, START, END))
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, joined.collect()))
    outside = rows.where("listing_id in ('b', 'd') and date_posted_key is not null")
    assert outside.count() == 0 and rows.where("listing_id = 'c'").count() == 0


def test_pay_by_technology_reads_no_ids_and_texts_of_listings(spark, stg):
    narrow = stg.select(*star.SALARY_SOURCES)
    assert not {"listing_sk", "title", "slug"} & set(narrow.columns)
    rows = star.fact(star.priced(narrow, START, END), marts.SALARY_FACT)
    whole = star.fact(star.priced(stg, START, END)).select(*marts.SALARY_FACT)
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, whole.collect()))


def test_marts(spark, stg):
    priced = star.priced(stg, START, END)
    salary = {(r.technology_name, r.employment_type): r
              for r in marts.salary_by_technology(priced).where("seniority = 'junior'").collect()}
    # Python is required and nice to have, so each of its variants counts twice
    assert salary["Python", "b2b"].listing_count == 4
    assert salary["Rust", "b2b"].listing_count == 2
    assert salary["SQL", "permanent"].median_salary == 8500.0
    demand = marts.demand_by_technology(priced).collect()
    assert sorted((r.technology_name, r.listing_count, r.wow_change) for r in demand) == [
        ("Python", 1, 1), ("Rust", 1, 1), ("SQL", 1, 1)]
    # 'rust' is another name than 'Rust'
    pairs = marts.co_occurrence(stg, 1).collect()
    assert sorted((r.tech_a, r.tech_b, r.co_occurrence_count) for r in pairs) == [
        ("Python", "Rust", 4), ("Python", "SQL", 1), ("Python", "rust", 1), ("Rust", "SQL", 1),
        ("Rust", "rust", 1)]
    city = {r.city_name: (r.listing_count, r.avg_salary_min)
            for r in marts.city_summary(priced).collect()}
    assert city["Opole"] == (2, round((2 * (16800 * 2 + 8000) + 5) / 7))
    snapshot = marts.market_snapshot(priced)
    assert snapshot.where("listing_id = 'a'").count() == 3
    b = snapshot.where("listing_id = 'b' and currency = 'PLN' and employment_type is null").first()
    assert (b.seniority, b.posted_date, b.cities) == (None, None, ["Opole"])
    assert snapshot.where("listing_id = 'd'").first().cities is None
    assert marts.junior(snapshot).count() == 3


def test_city_and_trend_counts(spark):
    rows = build.staging(bronze_of(
        spark, *[listing(listing_id=str(i), cities=["Opole"], salary_variants=[pay(0, 1), pay(10 + i, 20)],
                         posted_date=f"2026-08-{i + 1:02}") for i in range(9)]), now())
    priced = star.priced(rows, START, END)
    assert marts.city_summary(priced).first().listing_count == 9
    last = marts.market_trends(priced).orderBy(F.desc("full_date")).first()
    assert (last.new_listings, last.rolling_7d_listings) == (1, 7)


def test_date_dimension(spark):
    days = {str(r.full_date): r for r in
            star.date_dimension(spark, date(2026, 12, 30), date(2027, 1, 3)).collect()}
    assert sorted(days) == ["2026-12-30", "2026-12-31", "2027-01-01", "2027-01-02"]
    r = days["2027-01-02"]
    assert (r.year, r.week_of_year, r.day_of_week, r.is_weekend, r.day_name, r.month_name,
            r.quarter) == (2027, 53, 6, True, "Saturday", "January", 1)


def test_seeds(spark):
    assert layers.read_seed(spark, "technology_lookup").count() == 31
    assert layers.read_seed(spark, "city_lookup").where("city_name = 'Łódź'").count() == 1


# ---------------------------------------------------------------- history, checks, build
def test_scd2_over_three_loads(spark):
    ddl = ("listing_id string, title string, listing_status string, salary_min double, "
           "salary_max double")

    def load(*rows):
        return spark.createDataFrame(list(rows), ddl)

    t1, t2, t3 = (F.lit(datetime(2026, 8, d)) for d in (1, 5, 9))
    h = history.first_history(load(("a", "A", "active", 1.0, 2.0), ("b", "B", "active", None, 2.0)), t1)
    h = history.scd2(h, load(("a", "A2", "active", 1.0, 3.0), ("b", "B2", "active", None, 2.0)), t2)
    h = history.scd2(h, load(("c", "C", "active", 1.0, 1.0), ("a", "A3", "expired", 1.0, 3.0)), t3)
    got = sorted((r.listing_id, r.title, r.valid_from.day, r.valid_to and r.valid_to.day)
                 for r in h.collect())
    assert got == [("a", "A", 1, 5), ("a", "A2", 5, 9), ("a", "A3", 9, None),
                   ("b", "B", 1, None), ("c", "C", 9, None)]
    days = {r.listing_id: (r.versions, r.lifetime_days)
            for r in history.lifetime(h, F.lit(datetime(2026, 8, 11))).collect()}
    assert days == {"a": (3, 10), "b": (1, 10), "c": (1, 2)}
    assert checks.one_open_version(h).first().violations == 0


def test_checks_and_gate(spark, stg):
    facts = star.fact(star.priced(stg, START, END))
    versions = history.first_history(history.listing_versions(stg, now()), now())
    bridge = star.bridge_technology(stg, build.dimensions(spark, stg, START, END)["technology"])
    result = checks.run_checks(stg, stg, facts, versions, bridge)
    got = {r.check_name: r.violations for r in result.collect()}
    assert got["unique_stg_listing_id"] == 0 and got["salary_range_valid"] == 1
    assert got["relationship_technology_name"] == 2
    assert got["accepted_values_stg_workplace_type"] == 4
    with pytest.raises(ValueError, match="accepted_values"):
        checks.gate(result)
    checks.gate(result.where("severity = 'warn'"))
    twice = checks.unique(stg.unionAll(stg), "stg", "listing_id").first()
    assert twice.violations == 4


def test_a_build_parses_pay_once(spark, tmp_path, stg):
    priced = star.priced(stg, START, END)
    versions = history.listing_versions(priced, now())
    assert sorted(map(repr, versions.collect())) == sorted(map(repr, history.listing_versions(stg, now()).collect()))
    types = star.employment_types(priced)
    assert sorted(map(repr, types.collect())) == sorted(map(repr, star.employment_types(stg).collect()))
    stored = layers.write_layer(priced, str(tmp_path / "priced"))
    tables = build.gold(spark, stg, START, END, stored)
    for df in (tables["dim_employment_type"], tables["fact_job_listings"], history.listing_versions(stored, now())):
        assert "from_json" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_build(spark, tmp_path):
    rows = bronze_of(spark, listing(listing_id="a", required_skills=["py"], salary_variants=[pay(1, 2)]))
    target = str(tmp_path)
    assert build.published(spark, target) is None
    rows = rows.withColumn("workplace_type", F.lit("Remote"))
    out = build.build(spark, rows, target, START, END, "2026-09-01 00:00:00")
    assert out["mart_salary_by_technology"].count() == 1 and out["dim_date"].count() == 364
    with pytest.raises(ValueError, match="silver is empty"):
        build.build(spark, rows.where("false"), target, START, END, "2026-09-01")


def test_daily_builds_into_one_target(spark, tmp_path):
    target = str(tmp_path)

    def day(n, *rows):
        return build.build(spark, bronze_of(spark, *rows), target, START, END, f"2026-09-0{n} 00:00:00")

    day(1, listing(listing_id="a", workplace_type="remote", salary_variants=[pay(1, 2)]))
    day(2, listing(listing_id="a", workplace_type="remote", salary_variants=[pay(1, 3)]),
        listing(listing_id="b", workplace_type="Office", salary_variants=[pay(5, 6)]))
    good = build.published(spark, target)
    with pytest.raises(ValueError, match="accepted_values"):
        day(3, listing(listing_id="a", workplace_type="the moon", salary_variants=[pay(1, 4)]))
    assert build.published(spark, target) == good
    assert spark.read.parquet(f"{good}/mart_market_snapshot").count() == 2
    versions = day(4, listing(listing_id="a", workplace_type="remote", salary_variants=[pay(1, 9)]))["snapshot_listings"]
    assert sorted((r.listing_id, r.salary_max, r.valid_from.day, r.valid_to and r.valid_to.day)
                  for r in versions.collect()) == [
        ("a", 2.0, 1, 2), ("a", 3.0, 2, 4), ("a", 9.0, 4, None), ("b", 6.0, 2, None)]
    path = str(tmp_path / "whole")
    versions.write.parquet(path)
    with pytest.raises(ValueError, match="cannot replace"):
        history.store(spark, versions, path, path + "/", now())
    assert spark.read.parquet(path).count() == 4
    # the load that failed its checks was staged, and nobody reads it
    assert len(commits.loads(spark, f"{target}/gold/history")) == 3


LISTING = "listing_id string, title string, listing_status string, salary_min double, salary_max double"


def files_of(path, kind):
    return {str(p.relative_to(path)) for p in (path / kind).rglob("*.parquet")}


def test_a_load_rewrites_only_buckets_with_changes(spark, tmp_path):
    def batch(change):
        rows = [(f"l{i}", f"T{i}", "active", 1.0, 2.0 + (i in change)) for i in range(2000)]
        return spark.createDataFrame(rows, LISTING)

    path, days = str(tmp_path), [F.lit(datetime(2026, 8, d)) for d in range(1, 6)]
    assert len(history.load(spark, path, batch([]), days[0], buckets=64).buckets) == 64
    first = files_of(tmp_path, "open")
    assert len(first) == 64
    # no change: no load
    assert history.load(spark, path, batch([]), days[1]).buckets == [] and commits.last(spark, path) == 0
    done = history.load(spark, path, batch([5, 6]), days[2])
    new = files_of(tmp_path, "open") - first
    assert first <= files_of(tmp_path, "open") and len(new) == len(done.buckets) <= 2
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in new} == set(done.buckets)
    # the same versions as a history that is written whole; what the batch lacks stays open
    some = batch([6, 7]).where("listing_id <> 'l9'").unionByName(
        spark.createDataFrame([("new", "N", "active", None, None)], LISTING))
    history.load(spark, path, some, days[3])
    want = history.first_history(batch([]), days[0])
    for b, day in ((batch([]), 1), (batch([5, 6]), 2), (some, 3)):
        want = history.scd2(want, b, days[day])
    schema = batch([]).schema
    got = history.read(spark, path, schema)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select(got.columns).collect()), key=repr)
    assert history.read(spark, path, schema, 0).count() == 2000 and history.read(spark, path, schema, 1).count() == 2002
    # keys and digests only are read to find the changes
    state = history._open(spark, path, schema, {str(done.buckets[0]): done.name}).select("bucket", "listing_id", "digest")
    plan = state._jdf.queryExecution().toString()
    assert "salary_min" not in plan.split("ReadSchema")[-1]


def test_a_load_compares_versions_once_and_the_first_none(spark, tmp_path, monkeypatch):
    calls, scd2 = [], history.scd2
    monkeypatch.setattr(history, "scd2", lambda *args: calls.append(1) or scd2(*args))
    path, days = str(tmp_path), [F.lit(datetime(2026, 8, d)) for d in (1, 2)]

    def batch(*rows):
        return spark.createDataFrame([(k, k, "active", x, 2.0) for k, x in rows], LISTING)

    one, two = batch(("a", 1.0), ("b", 1.0), (None, 1.0), (None, 3.0)), batch(("a", 5.0), ("c", 1.0))
    history.load(spark, path, one, days[0])
    assert not calls and files_of(tmp_path, "closed") is not None
    want = history.first_history(one, days[0])
    got = history.read(spark, path, one.schema)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))
    done = history.load(spark, path, two, days[1])
    assert len(calls) == 1
    # both kinds of versions come from one stored comparison
    merged = spark.read.parquet(f"{path}/merged/load={done.name}")
    assert merged.where("valid_to is not null").count() == 1 and merged.where("listing_id = 'a'").count() == 2
    got, want = history.read(spark, path, one.schema), scd2(want, two, days[1])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))


def test_two_loads_staged_at_once(spark, tmp_path):
    path, day = str(tmp_path), F.lit(datetime(2026, 8, 1))
    one, two = (spark.createDataFrame([(k, k, "active", 1.0, 2.0)], LISTING) for k in "ab")
    first, second = history.stage(spark, path, one, day), history.stage(spark, path, two, day)
    assert first.publish() and not second.publish()
    assert [r.listing_id for r in history.read(spark, path, one.schema).collect()] == ["a"]
    history.load(spark, path, two, day)
    assert sorted(r.listing_id for r in history.read(spark, path, one.schema).collect()) == ["a", "b"]


def test_a_load_that_was_cut_off_comes_again(spark, tmp_path):
    path = str(tmp_path / "bronze")

    def run(name, *ids):
        rows = [listing(listing_id=i, source_run_id=name) for i in ids]
        return bronze_of(spark, *rows).withColumn("guard_run_id", F.lit(name))

    def ids():
        return sorted(r.listing_id for r in bronze.read_bronze(spark, path).collect())

    assert bronze.append_new_runs(run("r1", "a"), path)
    # a write that ended before its commit: nobody sees it, and the run comes again
    bronze.stage(run("r2", "b").limit(1).drop("guard_run_id"), path)
    assert ids() == ["a"]
    assert bronze.append_new_runs(run("r2", "b", "c"), path) and ids() == ["a", "b", "c"]
    assert not bronze.append_new_runs(run("r2", "b", "c"), path) and ids() == ["a", "b", "c"]


def test_two_appends_of_one_run_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    batch = bronze_of(spark, listing(listing_id="a")).withColumn("guard_run_id", F.lit("r1"))
    staged = bronze.stage

    def after_another(fresh, to):
        """The other append passes the guard and is published while this one is being written."""
        monkeypatch.setattr(bronze, "stage", staged)
        assert bronze.append_new_runs(batch, to)
        return staged(fresh, to)

    monkeypatch.setattr(bronze, "stage", after_another)
    assert not bronze.append_new_runs(batch, path)
    assert bronze.read_bronze(spark, path).count() == 1 and commits.last(spark, path) == 0
    assert commits.publish(spark, path, 0, "x") is False


def test_one_bad_pay_element_keeps_the_others(spark):
    texts = ['["negotiable",{"employment_type":"b2b","salary_min":"1"}]', "[1,null]", "[", "x", "[]", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in rows.select("i", parse_variants(F.col("t")).alias("v")).collect()}
    assert [(v.employment_type, v.salary_min) for v in got[0]] == [(None, None), ("b2b", 1.0)]
    assert [v.salary_min for v in got[1]] == [None, None]
    assert got[4] == [] and got[2] is got[3] is got[5] is None


def test_dedup_of_rows_that_are_widened_afterwards(spark):
    """The same rows as from wide records, ties told apart by the derived texts, and the shuffle holds
    none of these."""
    lines = [(i, d, n) for i, d, n in [
        ("a", "2026-01-01", 3), ("a", "2026-02-01", 1), ("b", "2026-01-01", 1), ("b", "2026-01-01", 2),
        ("b", "2026-01-01", 2), ("c", None, 5), ("c", None, 4), (None, "2026-01-01", 1), (None, "2026-01-01", 7)]]
    rows = spark.createDataFrame(lines, "listing_id string, date_collected string, n int").selectExpr(
        "listing_id", "date_collected", "timestamp'2026-01-01' as ingested_at", "'r' as source_run_id", "n")

    def derive(df):
        return df.selectExpr("*", "if(n = 4, null, 'title ' || n) as title", "'x' as company_name",
                             "'s' as slug", "'[]' as salary_variants", "repeat('wide', n) as description")

    def got(df):
        return sorted(map(tuple, df.select("listing_id", "date_collected", "title", "description").collect()), key=str)

    slim = silver.newest_per_listing(rows, derive)
    assert got(slim) == got(silver.newest_per_listing(derive(rows)))
    assert [r[2] for r in got(slim)] == ["title 1", "title 2", "title 5", "title 7"]
    assert "n" not in slim.columns
    plan = slim._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(listing_id") == 1
    assert "wide" not in plan[plan.index("Exchange hashpartitioning(listing_id"):]


def test_envelopes_are_packed_and_cut_into_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(envelope, "FILE_ROWS", 40)
    names = LISTING_FIELDS
    rows = spark.range(100).select(*[F.concat(F.lit(f"{c} "), F.col("id").cast("string")).alias(c)
                                     for c in names]).coalesce(1)
    envelope.write_envelope(rows, str(tmp_path / "e"), "now")
    files = glob.glob(str(tmp_path / "e" / "part-*"))
    assert len(files) == 3 and sum(map(os.path.getsize, files)) < 100 * len(names) * 12
    back = envelope.read_envelope(spark, str(tmp_path / "e"), lines=True)
    assert sorted(r.title for r in back.collect()) == sorted(f"title {i}" for i in range(100))


def test_fact_by_joins_meets_lookups_before_its_variants_become_rows(spark, stg, monkeypatch):
    seen = []
    real = star.lookup_join

    def watched(rows, lookup, keys, spread):
        seen.append((keys[0], "salary_min" in rows.columns))
        return real(rows, lookup, keys, spread)

    monkeypatch.setattr(star, "lookup_join", watched)
    rows = star.fact_by_joins(stg, build.dimensions(spark, stg, START, END))
    assert {c for c, wide in seen if wide} == {"employment_type"} and len(seen) == 7
    assert "description" not in rows.columns


def test_a_build_parses_pay_once_for_fact_and_marts(spark, tmp_path, monkeypatch):
    made = []
    real = star.priced
    monkeypatch.setattr(star, "priced", lambda *a: made.append(1) or real(*a))
    target = str(tmp_path / "b")
    tables = build.build(spark, bronze_of(spark, listing(
        listing_id="a", category="c", seniority="mid", workplace_type="remote",
        salary_variants=[pay(1, 2)])), target, START, END, "2026-09-01")
    assert len(made) == 1 and tables["fact_job_listings"].count() == 1
    assert spark.read.parquet(f"{target}/silver/priced_listings").first().variants[0].salary_min == 1.0
