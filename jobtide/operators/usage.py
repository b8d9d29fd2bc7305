"""Usage analytics with privacy switches, and popularity of filter values.

Events are (chat_id, seq, ts, kind, command, dimension, choices) with the kinds command, choice,
feedback, opt_out, opt_in and reset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.functions.keys import pseudonym
from jobtide.functions.skew import hour_slice, is_small, with_last_before, with_last_in_line

SWITCHES = ["opt_out", "opt_in"]
TOP = 10
RESETS = 1000  # as many are looked up in a list that every task gets
LIMITED = ["technology", "category", "city"]
POPULAR = ["technologies", "categories", "cities", "seniorities", "workplace_types"]


def users(events: DataFrame) -> DataFrame:
    """Known users: first seen and whether they are opted out now.

    Commands and switches register a user; filter choices and feedback do not.
    """
    seen = events.where(F.col("kind").isin("command", *SWITCHES))
    switched = F.when(F.col("kind").isin(SWITCHES), F.struct("ts", "seq"))
    return seen.groupBy("chat_id").agg(
        F.min("ts").alias("first_seen"),
        F.coalesce(F.max_by(F.col("kind") == "opt_out", switched), F.lit(False))
        .alias("opted_out"))


def logged(events: DataFrame) -> DataFrame:
    """Events that were stored: a user opted out at that moment leaves only feedback."""
    flag = F.when(F.col("kind").isin(SWITCHES), F.col("kind") == "opt_out")
    with_flag = with_last_before(events, "chat_id", F.struct("ts", "seq"), flag,
                                 hour_slice(F.col("ts")), "_out")
    out = F.coalesce("_out", F.lit(False))
    return with_flag.where((F.col("kind") == "feedback")
                           | (F.col("kind").isin("command", "choice") & ~out)).drop("_out")


def command_log(events: DataFrame) -> DataFrame:
    """Commands with the flag `is_new` on a user's very first interaction."""
    seen = events.where(F.col("kind").isin("command", *SWITCHES)).groupBy("chat_id").agg(
        F.min(F.struct("ts", "seq")).alias("_first"))
    rows = logged(events).where("kind = 'command'")
    firsts = seen.select("chat_id", F.col("_first.seq").alias("seq"), F.lit(True).alias("_new"))
    return (rows.join(firsts, ["chat_id", "seq"], "left")
            .withColumn("is_new", F.coalesce("_new", F.lit(False))).drop("_new"))


def _resets(events: DataFrame) -> DataFrame:
    return events.where("kind = 'reset'")


def kept_after_reset(events: DataFrame) -> DataFrame:
    """Stored events that no reset has deleted; feedback survives every reset."""
    last = _resets(events).select(F.max(F.struct("ts", "seq"))).scalar()
    later = F.coalesce(F.struct("ts", "seq") > last, F.lit(True))
    return logged(events).where((F.col("kind") == "feedback") | later)


def reset_counts(events: DataFrame) -> DataFrame:
    """Rows deleted by each reset: stored commands and choices since the reset before it."""
    marks = _resets(events).select("ts", "seq", "kind", F.lit(0).alias("n"))
    stored = logged(events).where("kind <> 'feedback'").select(
        "ts", "seq", "kind",
        F.when(F.col("kind") == "choice", F.size("choices")).otherwise(1).alias("n"))
    if is_small(marks, RESETS):
        # the first reset after an event, from a short sorted list
        later = F.filter(F.col("_marks"), lambda m: m > F.struct("ts", "seq"))
        marks = marks.agg(F.sort_array(F.collect_list(F.struct("ts", "seq")))).scalar()
        dated = stored.withColumn("_marks", marks).withColumn("_by", F.get(later, F.lit(0)))
    else:
        # read backwards in time, the reset before a row is the one that deletes it
        order = F.struct((-F.unix_micros("ts")).alias("t"), (-F.col("seq")).alias("s"))
        mark = F.when(F.col("kind") == "reset", F.struct("ts", "seq"))
        dated = with_last_in_line(marks.unionByName(stored), order, mark, "_by")
    deleted = dated.where((F.col("kind") != "reset") & F.col("_by").isNotNull()).groupBy(
        F.col("_by.seq").alias("seq")).agg(
        F.sum(F.when(F.col("kind") == "command", F.col("n"))).alias("c"),
        F.sum(F.when(F.col("kind") == "choice", F.col("n"))).alias("f"))
    return _resets(events).select("seq", F.col("ts").alias("reset_at")).join(
        deleted, "seq", "left").select(
        "seq", "reset_at", F.coalesce("c", F.lit(0)).alias("events_deleted"),
        F.coalesce("f", F.lit(0)).alias("filter_choices_deleted"))


def usage_summary(events: DataFrame) -> DataFrame:
    """(section, name, n): users, opted-out users, commands, values per filter dimension."""
    known = users(events).agg(F.count(F.lit(1)).alias("total_users"),
                              F.count_if("opted_out").alias("opted_out_users"))
    totals = known.select(F.inline(F.array(
        F.struct(F.lit("total_users").alias("section"), F.lit("").alias("name"),
                 F.col("total_users").alias("n")),
        F.struct(F.lit("opted_out_users").alias("section"), F.lit("").alias("name"),
                 F.col("opted_out_users").alias("n")))))

    def entry(section: Column, name: Column) -> Column:
        return F.struct(section.alias("section"), name.alias("name"))

    # one pass over the stored events: each adds to the counters it belongs to
    counters = F.when(F.col("kind") == "command", F.array(
        entry(F.lit("total_events"), F.lit("")), entry(F.lit("commands"), F.col("command")))
    ).when(F.col("kind") == "choice", F.transform(
        "choices", lambda v: entry(F.concat(F.lit("top_"), F.col("dimension")), v)))
    counted = (kept_after_reset(events).select(F.inline(counters))
               .groupBy("section", "name").agg(F.count(F.lit(1)).alias("n")))
    # sections without a limit are split by name, so only limited ones are ranked as a whole, and
    # of those just the first rows travel
    limited = F.col("section").isin([f"top_{d}" for d in LIMITED])
    place = F.row_number().over(W.partitionBy(
        "section", F.when(~limited, F.col("name"))).orderBy(F.desc("n"), "name"))
    best = counted.withColumn("_n", place).where(F.col("_n") <= TOP).drop("_n")
    return totals.unionByName(best)


def pseudonymous(df: DataFrame, salt: str) -> DataFrame:
    """Replace chat_id by its keyed pseudonym."""
    return df.withColumn("user_hash", pseudonym(F.col("chat_id"), salt)).drop("chat_id")


def filter_popularity(configs: DataFrame, known: DataFrame) -> DataFrame:
    """Users per filter value they have set (of `raw_configs`), without opted-out users.

    An absent or null list counts nothing: defaults are nobody's choice.
    """
    out = known.where("opted_out").select(F.col("chat_id").cast("string").alias("chat_id"))
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col("cfg")[d].alias("values"))
                      for d in POPULAR])
    return (
        configs.join(out, "chat_id", "left_anti").select(F.inline(pairs))
        .select("dimension", F.explode("values").alias("value"))
        .groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("user_count"))
    )
