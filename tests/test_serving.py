"""Known answers on small marts."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from jobtide.operators import matching, serving

USER = {"seniorities": [], "technologies": [], "categories": [], "workplace_types": [],
        "employment_types": [], "salary_min": 0, "cities": [], "tolerance": 0}


@pytest.fixture(scope="module")
def salary(spark):
    rows = [("Python", level, kind, "PLN", n, med, p25, p75) for level, kind, n, med, p25, p75 in [
        ("junior", "b2b", 10, 9500.0, 8000.0, 11000.0),
        ("senior", "b2b", 20, 21000.0, 19000.0, 24000.0),
        ("junior", "permanent", 15, 14000.0, 12000.0, 16000.0),
        ("senior", "permanent", 30, 26000.0, 22000.0, 33500.0)]]
    return spark.createDataFrame(rows, "technology_name string, seniority string, "
                                 "employment_type string, currency string, listing_count long, "
                                 "median_salary double, p25_salary double, p75_salary double")


@pytest.fixture(scope="module")
def demand(spark):
    rows = [("Python", date(2026, 7, 13), 3, 3), ("Python", date(2026, 7, 20), 30, 5),
            ("Python", date(2026, 7, 27), 40, 10), ("SQL", date(2026, 7, 27), 22, 2)]
    return spark.createDataFrame(
        rows, "technology_name string, week_start date, listing_count long, wow_change long")


@pytest.fixture(scope="module")
def snapshot(spark):
    rows = [
        ("l1", "Junior Python Dev", "Acme", "jr-py", "junior", "b2b", "remote", "python", 7000.0,
         9000.0, "PLN", True, date(2026, 8, 1), ["Python", "SQL"], ["Warszawa"]),
        ("l2", "Junior Data Analyst", "Acme", "jr-da", "junior", "b2b", "hybrid", "data", 6000.0,
         8000.0, "PLN", True, date(2026, 8, 1), ["SQL", "Excel"], ["Kraków"]),
        ("l3", "Senior Backend Engineer", "Globex", "sr-be", "senior", "b2b", "remote", "backend",
         25000.0, 35000.0, "PLN", True, date(2026, 8, 2), ["Java", "Spring"], ["Warszawa"])]
    return spark.createDataFrame(rows, (
        "listing_id string, title string, company_name string, slug string, seniority string, "
        "employment_type string, workplace_type string, category string, salary_min double, "
        "salary_max double, currency string, is_gross boolean, posted_date date, "
        "technologies array<string>, cities array<string>"))


@pytest.fixture(scope="module")
def trends(spark):
    rows = [(date(2026, 7, 31), 2, 2, 18000.0), (date(2026, 8, 1), 12, 60, 19500.0),
            (date(2026, 8, 2), 15, 70, 20000.0)]
    return spark.createDataFrame(rows, "full_date date, new_listings long, "
                                       "rolling_7d_listings long, rolling_7d_avg_salary double")


def test_salary_groups(salary):
    got = {r.basis: (r["count"], r.median, r.p25, r.p75, r.label, r.listing_count)
           for r in serving.salary_groups(salary).collect()}
    assert got["permanent"] == (45, 22000, 18667, 27667, "Permanent (UoP)", 75)
    assert got["b2b"][1] == 17167
    senior = {r.basis: (r.median, r.p25, r.p75)
              for r in serving.salary_groups(salary, "SENIOR").collect()}
    assert senior == {"permanent": (26000, 22000, 33500), "b2b": (21000, 19000, 24000)}


def test_salary_by_seniority(salary):
    got = [(r.seniority, r.median) for r in
           serving.salary_by_seniority(salary).orderBy("rank").collect()]
    assert got == [("junior", 14000.0), ("senior", 26000.0)]


def test_related_skills(spark, demand):
    pairs = spark.createDataFrame(
        [("Python", "SQL", 50), ("Airflow", "Python", 30), ("Java", "Spring", 40),
         ("Rust", "rust", 5)], "tech_a string, tech_b string, co_occurrence_count long")
    rows = serving.related_skills(pairs, demand).orderBy("technology", "rank").collect()
    python = [(r.other, r["count"], r.pct, r.total) for r in rows if r.technology == "python"]
    assert python == [("SQL", 50, 71, 70), ("Airflow", 30, 43, 70)]
    assert [(r.other, r.pct) for r in rows if r.technology == "java"] == [("Spring", None)]
    assert [r.other for r in rows if r.technology == "rust"] == ["rust"]
    assert [r.rank for r in serving.related_skills(pairs, demand, 1).collect()
            if r.technology == "python"] == [1]


def test_trends(demand, trends):
    market = serving.market_trend(trends).orderBy("position").collect()
    assert [r.rolling_7d_listings for r in market] == [60, 70]
    python = [(r.position, r.listing_count, r.wow_change) for r in
              serving.tech_trend(demand).where("technology = 'python'").orderBy("position").collect()]
    assert python == [(1, 30, 5), (2, 40, 10)]
    assert serving.hot_technologies(demand).first().technology_name == "Python"


def test_companies(snapshot):
    acme = serving.company_intel(snapshot, "acme").first()
    assert (acme.listing_count, acme.avg_min, acme.currency) == (2, 6500, "PLN")
    assert acme.sample_titles == ["Junior Python Dev", "Junior Data Analyst"]
    assert serving.company_intel(snapshot, "nobody").count() == 0
    assert [r.company_name for r in serving.top_companies(snapshot).collect()] == ["Acme", "Globex"]


def test_report_freshness_meta(trends, snapshot, demand):
    report = {(r.section, r.position): (r.name, r.value, r.change)
              for r in serving.market_report(trends, snapshot, demand).collect()}
    assert report["volume", 1] == ("rolling_7d_listings", 70.0, 10.0)
    assert report["salary", 1][1] == 20000.0
    assert report["companies", 1] == ("Acme", 2.0, None)
    assert report["technologies", 1] == ("Python", 40.0, 10.0)
    stamped = snapshot.withColumn("at", F.lit(datetime(2026, 8, 2)))
    fresh = serving.freshness(stamped, "at", F.lit(datetime(2026, 8, 2, 23)))
    assert fresh.first()[::2] == (True, False)
    empty = serving.freshness(stamped.where("false"), "at", F.lit(datetime(2026, 8, 2)))
    assert empty.first() == (False, None, True)
    meta = {r.listing_id: r.url for r in serving.listing_meta(snapshot).collect()}
    assert meta["l1"] == "https://justjoin.it/offers/jr-py"


# ---------------------------------------------------------------- matching
def verdict(spark, ddl, row, **user):
    df = spark.createDataFrame([row], ddl)
    r = matching.judge(df, USER | user).first()
    return r.passes, r.mismatches


@pytest.mark.parametrize("ddl, row, user, want", [
    ("title string", ("any",), {}, (True, 0)),
    ("seniority string", ("senior",), {"seniorities": ["junior"]}, (False, -1)),
    ("seniority string", ("senior",), {"seniorities": ["junior"], "tolerance": 3}, (False, -1)),
    ("seniority string", ("Junior",), {"seniorities": ["junior"]}, (True, 0)),
    ("seniority string", ("junior",), {"seniorities": ["Junior"]}, (False, -1)),
    ("workplace_type string, technologies array<string>", ("office", ["Python"]),
     {"workplace_types": ["remote"], "technologies": ["python"], "tolerance": 1}, (True, 1)),
    ("technologies array<string>", (["Go"],), {"technologies": ["Python"]}, (False, 1)),
    ("technologies string", ("Python, SQL",), {"technologies": ["sql"]}, (False, 1)),
    ("required_skills array<string>, nice_to_have_skills array<string>", (["Python"], ["AWS"]),
     {"technologies": ["aws"]}, (True, 0)),
    ("title string", ("any",), {"salary_min": 10000}, (True, 0)),
    ("salary_max double", (5000.9,), {"salary_min": 10000}, (False, 1)),
    ("salary_max double", (5000.9,), {"salary_min": 5000}, (True, 0)),
    ("salary_max string", ("7000.5",), {"salary_min": 9000}, (True, 0)),
    ("salary_max string", ("7000",), {"salary_min": 9000}, (False, 1)),
    ("salary_variants array<struct<salary_max:double>>", ([(20000.0,), (8000.0,)],),
     {"salary_min": 10000}, (True, 0)),
    ("salary_variants array<struct<employment_type:string>>", ([("b2b",)],),
     {"employment_types": ["B2B"]}, (True, 0)),
    ("salary_variants array<struct<employment_type:string>>", ([("b2b",)],),
     {"employment_types": ["permanent"]}, (False, 1)),
    ("cities string", ("Warszawa",), {"cities": ["warszawa"]}, (True, 0)),
    ("cities array<string>", (["Kraków", "Warszawa"],), {"cities": ["Warszawa"]}, (True, 0)),
    ("cities array<string>", (["Gdańsk"],), {"cities": ["Warszawa"]}, (False, 1)),
])
def test_judge(spark, ddl, row, user, want):
    assert verdict(spark, ddl, row, **user) == want


USERS_DDL = ("chat_id string, seniorities array<string>, technologies array<string>, "
             "categories array<string>, workplace_types array<string>, "
             "employment_types array<string>, cities array<string>, skills array<string>, "
             "salary_min long, tolerance int")


def test_match_agrees_with_judge(spark, snapshot):
    users = [("a", [], ["sql"], [], [], [], [], [], 0, 0),
             ("b", ["junior", "junior"], [], ["data"], ["remote"], [], [], ["sql"], 8500, 1),
             ("c", ["senior"], ["x"], ["x"], ["x"], ["x"], ["x"], [], 99999, 5),
             ("d", ["lead"], [], [], [], [], [], [], 0, 9)]
    pool = matching.newest_pool(snapshot)
    got = {(r.chat_id, r.listing_id): (r.passes, r.mismatches) for r in
           matching.match(pool, spark.createDataFrame(users, USERS_DDL)).collect()}
    names = [x.split()[0] for x in USERS_DDL.split(", ")]
    for u in users:
        for r in matching.judge(snapshot, dict(zip(names, u))).collect():
            if r.mismatches == -1:
                assert (u[0], r.listing_id) not in got
            else:
                assert got[u[0], r.listing_id] == (r.passes, r.mismatches)


def test_passing_pairs_come_from_few_candidates(spark, monkeypatch):
    """Passing pairs are those of all pairs of a seniority, each once, with nulls in either side's
    lists; few more are formed, also where the listings are not sent to every task."""
    rng = random.Random(5)

    def some(kind, most, null=0.0):
        values = rng.sample([f"{kind}{i}" for i in range(40)], rng.randint(0, most))
        return [None if rng.random() < null else v for v in values]

    rows = [(f"l{i}", rng.choice(["junior", "mid", None]), some("t", 4), rng.choice(["c1", "c2", None]),
             rng.choice(["remote", "office"]), rng.choice(["b2b", None]), rng.choice([some("x", 3, 0.05), None]),
             rng.choice([None, 5000.0, 9000.0])) for i in range(200)]
    pool = spark.createDataFrame(rows, (
        "listing_id string, seniority string, technologies array<string>, category string, workplace_type string, "
        "employment_type string, cities array<string>, salary_max double"))
    users = [(str(u), rng.choice([[], ["mid"], ["mid", "junior"]]), some("T", 5, 0.05), some("c", 3), rng.choice([[], ["remote"]]),
              rng.choice([[], ["B2B"]]), some("X", 4), [], rng.choice([0, 6000]), rng.choice([0, 0, 1, 2, 6, -3, None]))
             for u in range(120)]
    users = spark.createDataFrame(users, USERS_DDL)
    every = matching.match(pool, users)
    want = sorted((r.chat_id, r.listing_id, r.mismatches) for r in every.where("passes").collect())
    for small in (True, False):
        monkeypatch.setattr(matching, "is_small", lambda df, small=small: small)
        got = matching.passing(pool, users).select("chat_id", "listing_id", "mismatches").collect()
        assert sorted(map(tuple, got)) == want and len(want) > 1000
    strict = users.where("tolerance = 0 and size(technologies) > 0 and not exists(technologies, t -> t is null)")
    formed, kept = matching.candidates(pool, strict).count(), matching.passing(pool, strict).count()
    assert kept <= formed < 0.35 * matching.match(pool, strict).count()


def test_rank_by_skills(spark):
    df = spark.createDataFrame([("u", "a", ["Python", "Django"]), ("u", "b", ["Python", "SQL", "Airflow"]),
                                ("u", "c", ["Java"]), ("v", "a", ["Python"]), ("u", "d", None)],
                               "chat_id string, listing_id string, technologies array<string>")
    users = spark.createDataFrame([("u", [" python", "SQL", "airflow", " "]), ("v", [])],
                                  "chat_id string, skills array<string>")
    got = {(r.chat_id, r.listing_id): (r.match_pct, r.matched_skills)
           for r in matching.rank_by_skills(df, users).collect()}
    assert got == {("u", "a"): (50, ["python"]), ("u", "b"): (100, ["airflow", "python", "sql"]),
                   ("u", "c"): (0, []), ("u", "d"): (0, []), ("v", "a"): (None, None)}
    text = spark.createDataFrame([("u", "Python, Rust")], "chat_id string, technologies string")
    assert matching.rank_by_skills(text, users).first().match_pct == 50


def test_digest_caps_before_ranking(spark):
    rows = [(f"l{i:02}", "T", "C", "s", "mid", "b2b", "remote", "x", 1.0, 2.0, "PLN", True,
             date(2026, 1, 30 - i), ["Go"] if i == 29 or i == 3 else ["SQL"], ["Opole"])
            for i in range(30)]
    snapshot = spark.createDataFrame(rows, (
        "listing_id string, title string, company_name string, slug string, seniority string, "
        "employment_type string, workplace_type string, category string, salary_min double, "
        "salary_max double, currency string, is_gross boolean, posted_date date, "
        "technologies array<string>, cities array<string>"))
    pool = matching.newest_pool(snapshot, 30)
    users = spark.createDataFrame(
        [("1", [], [], [], [], [], [], ["go"], 0, 0), ("2", [], [], [], [], [], [], [], 0, 0),
         ("3", ["lead"], [], [], [], [], [], [], 0, 0)], USERS_DDL)
    sent = spark.createDataFrame([("l00", "1"), ("l01", "2")], "listing_id string, chat_id string")
    caps = spark.createDataFrame([("2", 50)], "chat_id string, cap int")
    told = matching.digest(pool, users, sent, caps)
    one = [r.listing_id for r in told.where("chat_id = '1'").orderBy("slot").collect()]
    # free cap of 20: l01..l20; the match at l29 lies beyond the cap, l03 is ranked first
    assert len(one) == 20 and one[0] == "l03" and "l00" not in one and "l29" not in one
    assert told.where("chat_id = '2'").count() == 29
    assert [r.chat_id for r in matching.without_news(pool, users, told).collect()] == ["3"]
    assert matching.without_news(pool.where("false"), users, told.where("false")).count() == 0
    tracked = spark.createDataFrame([("l05", "1")], "listing_id string, chat_id string")
    assert matching.latest(pool, users, tracked, caps).where("chat_id = '1'").count() == 19


def test_alert_text(spark, snapshot):
    pool = snapshot.where("listing_id = 'l1'").withColumns({
        "match_pct": F.lit(50), "title": F.lit("A <b> & 'c'"), "slug": F.lit("a b"),
        "cities": F.lit(None).cast("array<string>")})
    assert pool.select(matching.alert_text(pool)).first()[0] == (
        "🎯 50% skill match\n<b>A &lt;b&gt; &amp; &#x27;c&#x27;</b>\nAcme | None | remote\n"
        "7000-9000 PLN (b2b)\nPython, SQL\nhttps://justjoin.it/offers/a%20b")
