"""Event folds against a plain walk through the log, one event at a time."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from jobtide.functions.quantile import quantiles
from jobtide.functions.skew import hour_slice, salted_join, with_last_before, with_last_in_line
from jobtide.operators import ledger, tracker, usage
from jobtide.sources import configs

BASE = datetime(2024, 1, 1)
DAYS = {"plus": 30, "pro": 30}


def moments(rng, n, hours):
    return sorted(BASE + timedelta(seconds=rng.randint(0, hours * 3600)) for _ in range(n))


def test_ledger_state(spark):
    rng = random.Random(11)
    log = []
    for user in range(60):
        n = 120 if user == 0 else rng.randint(1, 14)
        for ts in moments(rng, n, 24 * 80 if user else 30):
            kind = rng.choices(["charge", "trial", "refund", "revoke", "reminder"],
                               [4, 3, 2, 1, 3])[0]
            log.append((user, ts, kind, f"{user}/{rng.randint(0, 5)}",
                        rng.choice(["plus", "pro", "pro", "gold"])))
    log = [(i, *e) for i, e in enumerate(sorted(log, key=lambda e: e[1]))]
    now = BASE + timedelta(days=75)

    paid, refunded, subs, trials = {}, {}, {}, {}
    for seq, user, ts, kind, charge, tier in log:
        if ts > now:
            continue

        def grant(days, t):
            base = max(ts, subs[user]["end"]) if user in subs else ts
            last = subs[user]["last"] if user in subs else None
            subs[user] = {"end": base + timedelta(days=days), "tier": t, "last": last, "at": ts}
        if kind == "charge" and tier in DAYS and charge not in paid:
            paid[charge] = (user, tier, ts)
            grant(DAYS[tier], tier)
        elif kind == "trial" and user not in trials and user not in subs:
            trials[user] = ts
            grant(1, "plus")
        elif kind == "refund" and charge in paid and charge not in refunded:
            refunded[charge] = ts
            subs.pop(paid[charge][0], None)
        elif kind == "revoke":
            subs.pop(user, None)
        elif kind == "reminder" and user in subs:
            subs[user]["last"] = ts

    events = spark.createDataFrame(
        log, "seq long, chat_id long, ts timestamp, kind string, charge_id string, tier string")
    as_of = F.lit(now)
    past = events.where(F.col("ts") <= as_of)
    payments = ledger.payments(past)
    assert {r.charge_id: (r.chat_id, r.tier, r.paid_at) for r in
            ledger.payment_list(payments).collect()} == paid
    assert {r.charge_id: r.refunded_at for r in ledger.payment_list(payments).collect()
            if r.refunded_at} == refunded
    assert {r.chat_id: r.granted.ts for r in ledger.trials(past, payments).collect()} == trials
    state = ledger.subscription_state(events, as_of)
    rows = {r.chat_id: r for r in state.collect()}
    assert {u: (r.expires_at, r.tier, r.last_reminded_at, r.updated_at) for u, r in rows.items()} == \
        {u: (s["end"], s["tier"], s["last"], s["at"]) for u, s in subs.items()}

    due = set()
    for user, s in subs.items():
        if now < s["end"]:
            ok = s["last"] is None or now - s["last"] > timedelta(hours=20)
        elif now < s["end"] + timedelta(days=3):
            ok = s["last"] is None or s["last"] < s["end"]
        else:
            continue
        if ok and s["end"] - timedelta(days=3) <= now:
            due.add(user)
    assert {r.chat_id for r in ledger.due_for_reminder(state, as_of).collect()} == due


def test_lifecycle_and_tiers(spark):
    events = spark.createDataFrame(
        [(1, 1, BASE, "charge", "a", "plus"), (2, 1, BASE + timedelta(days=1), "charge", "a", "pro"),
         (3, 2, BASE, "charge", "b", "pro"), (4, 3, BASE, "charge", "c", "gold")],
        "seq long, chat_id long, ts timestamp, kind string, charge_id string, tier string")

    def at(days):
        rows = ledger.subscription_state(events, F.lit(BASE + timedelta(days=days))).withColumn(
            "export", ledger.has_feature("export")).withColumn(
            "pro", ledger.is_subscribed("pro")).collect()
        return {r.chat_id: (r.status, r.cap, r.export, r.pro) for r in rows}
    assert at(29) == {1: ("active", 50, False, False), 2: ("active", 100, True, True)}
    assert at(31) == {1: ("grace", 50, False, False), 2: ("grace", 100, True, True)}
    assert at(33) == {1: (None, 20, False, False), 2: (None, 20, False, False)}


def test_tracker_state(spark):
    rng = random.Random(7)
    log = []
    for i, ts in enumerate(moments(rng, 1500, 60)):
        chat, lid = rng.choice([0, 0, 0, 1, 2, 3]), rng.choice(["a", "a", "b", "c"])
        log.append((i, ts, chat, lid, rng.choice(["applied", "interested", "rejected", "removed"]),
                    *[rng.choice([None, None, f"{f}{i}"]) for f in "tcu"]))
    want = {}
    for i, ts, chat, lid, status, *meta in log:
        old = want.get((chat, lid))
        if status == "removed":
            want.pop((chat, lid), None)
        elif old:
            want[chat, lid] = [status, *[m or o for m, o in zip(meta, old[1:4])], old[4], ts]
        else:
            want[chat, lid] = [status, *meta, ts, ts]
    df = spark.createDataFrame(log, "seq long, ts timestamp, chat_id long, listing_id string, "
                                    "status string, title string, company string, url string")
    got = {(r.chat_id, r.listing_id): [r.status, r.title, r.company, r.url, r.created_at,
                                       r.updated_at]
           for r in tracker.tracker_state(df).collect()}
    assert got == want


def test_tracker_rejects_unknown_status(spark):
    df = spark.createDataFrame([(1, BASE, 1, "a", "maybe", None, None, None)],
                               "seq long, ts timestamp, chat_id long, listing_id string, "
                               "status string, title string, company string, url string")
    try:
        tracker.tracker_state(df).collect()
    except Exception as error:
        assert "invalid status maybe" in str(error)
    else:
        raise AssertionError("accepted")


def usage_log(rng):
    kinds = ["command", "choice", "feedback", "opt_out", "opt_in", "reset"]
    return [(i, ts, rng.choice([0, 0, 0, 1, 2, 3, 4]), rng.choices(kinds, [9, 6, 2, 2, 2, 0.2])[0],
             f"c{rng.randint(0, 3)}", rng.choice(["technology", "seniority"]),
             [f"v{rng.randint(0, 20)}", f"v{rng.randint(0, 3)}"])
            for i, ts in enumerate(moments(rng, 1500, 40))]


def test_usage(spark):
    log = usage_log(random.Random(2))
    users, out, stored, resets, new = {}, {}, [], [], set()
    for e in log:
        i, ts, user, kind, *_ = e
        if kind == "reset":
            gone = [x for x in stored if x[3] != "feedback"]
            resets.append((i, sum(x[3] == "command" for x in gone),
                           sum(len(x[6]) for x in gone if x[3] == "choice")))
            stored = [x for x in stored if x[3] == "feedback"]
            continue
        if kind in ("command", "opt_out", "opt_in"):
            if user not in users:
                users[user] = ts
                new.add(i)
        if kind in ("opt_out", "opt_in"):
            out[user] = kind == "opt_out"
        elif kind == "feedback" or not out.get(user, False):
            stored.append(e)
    df = spark.createDataFrame(log, "seq long, ts timestamp, chat_id long, kind string, "
                                    "command string, dimension string, choices array<string>")
    assert resets
    assert {r.seq for r in usage.kept_after_reset(df).collect()} == {e[0] for e in stored}
    assert sorted((r.seq, r.events_deleted, r.filter_choices_deleted)
                  for r in usage.reset_counts(df).collect()) == resets
    assert {r.chat_id: (r.first_seen, r.opted_out) for r in usage.users(df).collect()} == \
        {u: (ts, out.get(u, False)) for u, ts in users.items()}
    flagged = {r.seq for r in usage.command_log(df).where("is_new").collect()}
    assert flagged <= new
    summary = defaultdict(dict)
    for r in usage.usage_summary(df).collect():
        summary[r.section][r.name] = r.n
    commands = [e for e in stored if e[3] == "command"]
    assert summary["total_users"] == {"": len(users)}
    assert summary["opted_out_users"] == {"": sum(out.values())}
    assert summary["total_events"] == {"": len(commands)}
    assert sum(summary["commands"].values()) == len(commands)
    assert len(summary["top_technology"]) == 10 < len(summary["top_seniority"])


def test_edit_list(spark):
    rng = random.Random(4)
    log = [(rng.randint(0, 3), i, rng.choices(["add", "remove", "clear"], [6, 2, 0.3])[0],
            rng.choice(["Go", "go", "GO", "SQL", "sql", "dbt"])) for i in range(300)]
    want = defaultdict(list)
    for chat, _, action, value in log:
        if action == "clear":
            want[chat] = []
        elif action == "remove":
            want[chat] = [v for v in want[chat] if v.lower() != value.lower()]
        elif value.lower() not in {v.lower() for v in want[chat]}:
            want[chat].append(value)
    df = spark.createDataFrame(log, "chat_id int, seq int, action string, value string")
    got = defaultdict(list)
    for r in configs.edit_list(df).orderBy("chat_id", "seq").collect():
        got[r.chat_id].append(r.value)
    assert got == {c: v for c, v in want.items() if v}


def test_last_before_and_salted_join(spark):
    rng = random.Random(9)
    log = [(rng.choice([0, 0, 1]), i, ts, rng.choice([None, None, i]))
           for i, ts in enumerate(moments(rng, 600, 50))]
    df = spark.createDataFrame(log, "k int, seq int, ts timestamp, v int")
    got = {r.seq: r.p for r in with_last_before(
        df, "k", F.struct("ts", "seq"), F.col("v"), hour_slice(F.col("ts")), "p").collect()}
    last, want = {}, {}
    for k, i, _, v in log:
        want[i] = last.get(k)
        if v is not None:
            last[k] = v
    assert got == want
    side = spark.createDataFrame([(0, "x"), (5, "y")], "k int, s string")
    joined = salted_join(df, side, ["k"], F.col("seq"), "left")
    assert joined.count() == 600
    assert joined.where("s = 'x'").count() == sum(e[0] == 0 for e in log)


def test_quantiles_by_rank(spark):
    rng = random.Random(5)
    value = lambda: rng.choice([rng.randrange(1, 40) / 2, rng.randrange(-9, 9) * 1.0, 2.0 ** rng.randrange(-3, 30),
                                rng.random() * 10 ** rng.randrange(1, 9)])
    df = spark.createDataFrame([(rng.choice(["a", "b", None]), value()) for _ in range(3000)] + [("one", 3.0)],
                               "g string, x double")
    asked = [0.5, 0.25, 0.9, 0.0, 1.0]
    folded = df.groupBy("g", "x").agg(F.count("*").alias("n"))
    got = quantiles(folded, ["g"], "x", "n", asked, list("abcde"))
    want = df.groupBy("g").agg(F.percentile("x", asked).alias("q"))
    assert {r.g: [r.a, r.b, r.c, r.d, r.e] for r in got.collect()} == {r.g: list(r.q) for r in want.collect()}
    assert quantiles(folded.limit(0), ["g"], "x", "n", [0.5], ["a"]).isEmpty()


def test_quantiles_of_few_groups_do_not_shuffle_values(spark):
    folded = spark.createDataFrame(
        [(g, float(x), x % 3 + 1) for g in ("a", None) for x in range(-40, 900)], "g string, x double, n long")
    asked = dict(group=["g"], value="x", count="n", asked=[0.0, 0.25, 0.5, 1.0], names=list("abcd"))
    few, many = quantiles(folded, **asked, few_groups=True), quantiles(folded, **asked)
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    plan = few._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_last_mark_over_the_ends_of_ranges(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([None] * 30 + [i])) for i in range(2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "o long, v long")
    got = {r.o: r.p for r in with_last_in_line(df, F.struct("o"), F.col("v"), "p").collect()}
    last = None
    for o, v in sorted(rows):
        assert got[o] == last
        last = v if v is not None else last
