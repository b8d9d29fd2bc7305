"""Quality rules as weak supervision, in built-in Spark expressions only.

Each rule looks at counts of a text and votes good (1), bad (-1) or abstains (0). The votes of
all texts fold into a table of vote patterns (at most 3 ** number of rules rows), on which
expectation-maximisation estimates the share of good texts and, for each rule, how often it is
right on good and on bad texts where it votes. A text is kept if its posterior of being good is
at least a half and BASE_FAILED does not hold; no rule decides by itself, so that a bad vote of a
rule that errs can be outvoted, and several weak ones can reject. Abstentions say nothing.

Votes alone cannot tell good from bad, so the estimate starts from rules that are seldom wrong on
good texts and see a part of the bad ones (GOOD, START), which count as PRIOR votes.
A null text counts as empty; rows are judged one by one, repeated ones alike; an empty table gives
the start values and no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAKS = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"
COMMON = ["the", "of", "and", "to", "in", "de", "la", "le", "et", "der", "die", "und", "el",
          "que", "en", "a", "is"]
ROUNDS = 30
GOOD = 0.8  # start value of the share of good texts
START = (0.98, 0.3)  # start values: how often a rule is right on good texts, on bad texts
PRIOR = 10.0  # votes that the start values count as
PLACE = 20  # bits of a position beside the leading bits of a hash
TEXT = "_text"
INNER = (TEXT, "_words", "_lines", "_marks", "_hashes", "_windows")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_marks", "n_common"]


def _taken(text: Column, marks: str) -> Column:
    """How often one-byte characters of a class occur: the bytes that go with them."""
    return (F.octet_length(text) - F.octet_length(F.regexp_replace(text, f"[{marks}]+", ""))).cast("long")


def _fixed(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns behind a generator of one row, so that lambdas over them don't compute them
    again for each element."""
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    names = [c for c in df.columns if c not in values]
    out = df.select("*", F.explode(F.array(row)).alias("_fixed"))
    return out.select(*[F.col(f"`{c}`") for c in names], *[F.col(f"_fixed.{k}") for k in values])


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that the rules look at (columns of COUNTS and MORE, replacing any of the
    same name). A null text counts as empty; all counts of a text without words are 0 but that of
    its lines."""
    df = df.withColumn(TEXT, F.coalesce(F.col(text), F.lit("")))
    t, w, h, s = (F.col(c) for c in (TEXT, "_words", "_hashes", "_windows"))
    plain = F.replace(t, F.lit("\n"), F.lit(" "))
    for gap in "\t\x0b\f\r":
        plain = F.when(~F.contains(t, F.lit(gap)), plain)
    df = _fixed(
        df, _words=F.array_remove(F.coalesce(F.split(plain, " "), F.split(t, f"[{BREAKS}]+")), ""),
        _lines=F.filter(F.split(t, "\n"), lambda x: F.ltrim(x, F.lit(" \t\x0b\f\r")) != ""),
        _marks=F.regexp_replace(t, f"[^{SYMBOLS}!A-Z]+", ""))
    df = _fixed(df, _hashes=F.when(F.size(w) >= 3, F.slice(F.transform(
        w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), 1, F.size(w) - 2)))
    # only texts in which a window comes again need their windows in order: by the leading bits
    # of the hash and the position, in one number that sorts fast, or by hash and position
    packed = F.sort_array(F.transform(
        h, lambda x, i: x.bitwiseAND(F.lit(-1 << PLACE)).bitwiseOR(i.cast("long"))))
    wide = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    order = F.when(F.size(h) < (1 << PLACE), F.transform(
        packed, lambda x: x.bitwiseAND(F.lit((1 << PLACE) - 1)).cast("int"))).otherwise(
            F.transform(wide, lambda x: x["i"]))
    df = _fixed(df, _windows=F.when(F.size(F.array_distinct(h)) < F.size(h), order))

    def met_again(x: Column, k: Column) -> Column:
        return (F.get(h, F.get(s, k - 1)).eqNullSafe(F.get(h, x))
                | F.get(h, F.get(s, k + 1)).eqNullSafe(F.get(h, x)))

    found = F.sort_array(F.filter(s, met_again))
    covered = F.aggregate(
        found, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct((i + 3).alias("end"),
                                (acc["n"] + i + 3 - F.greatest(i, acc["end"])).alias("n")),
        lambda acc: acc["n"])
    m = F.col("_marks")
    values = {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.char_length(F.array_join(w, "")).cast("long"),
        "n_symbols": _taken(m, SYMBOLS),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_upper": _taken(m, "A-Z"),
        "n_marks": _taken(m, "!"),
        "n_common": F.size(F.array_intersect(w, F.array(*[F.lit(x) for x in COMMON]))).cast("long"),
    }
    names = [c for c in df.columns if c not in values and c not in INNER]
    return df.select(*[F.col(f"`{c}`") for c in names], *[v.alias(k) for k, v in values.items()])


def _vote(bad: str, good: str) -> str:
    return f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"


# SQL over the counts; the same text runs in Spark and in the SQL twin
RULES = {
    "symbols": _vote("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "repeats": _vote("10 * n_repeat_words > 3 * n_words", "10 * n_repeat_words <= n_words"),
    "dup_lines": _vote("n_lines >= 5 AND 2 * n_dup_lines > n_lines", "n_lines >= 5 AND 10 * n_dup_lines <= n_lines"),
    "length": _vote("word_chars < 2 * n_words OR word_chars > 15 * n_words",
                    "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    "upper": _vote("2 * n_upper > word_chars", "10 * n_upper <= word_chars"),
    "marks": _vote("10 * n_marks > n_words", "50 * n_marks <= n_words"),
    "common": _vote("n_words >= 100 AND n_common <= 1", "n_common >= 4"),
}
BASE_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"

# the share of good texts, and how often each rule is right on good and on bad texts
Right = tuple[float, list[tuple[float, float]]]


def estimate(patterns: list[tuple[tuple[int, ...], int]]) -> Right:
    """Share and accuracies by expectation-maximisation over the vote patterns and their numbers
    of texts."""
    right = (GOOD, [START] * len(RULES))
    for _ in range(ROUNDS):
        good, texts = GOOD * PRIOR, PRIOR
        hit = [[g * PRIOR, b * PRIOR] for g, b in [START] * len(RULES)]
        seen = [[PRIOR, PRIOR] for _ in RULES]
        for votes, n in patterns:
            p = posterior(votes, right)
            good, texts = good + n * p, texts + n
            for h, s, v in zip(hit, seen, votes, strict=True):
                if v:
                    s[0] += n * p
                    s[1] += n * (1 - p)
                    h[v < 0] += n * (p if v > 0 else 1 - p)
        right = (good / texts, [(h[0] / s[0], h[1] / s[1]) for h, s in zip(hit, seen, strict=True)])
    return right


def weights(right: Right) -> tuple[float, list[tuple[float, float]]]:
    """Log odds of a good text without votes, and what a bad and a good vote of each rule adds."""
    share, rules = right
    return math.log(share / (1 - share)), [
        (math.log((1 - good) / bad), math.log(good / (1 - bad))) for good, bad in rules]


def posterior(votes: tuple[int, ...], right: Right) -> float:
    start, each = weights(right)
    odds = start + sum(w[v > 0] for v, w in zip(votes, each, strict=True) if v)
    return 1 / (1 + math.exp(-odds))


def learn(counted: DataFrame) -> Right:
    """Run the estimate over the vote patterns of all rows."""
    votes = counted.select(*[F.expr(rule).alias(name) for name, rule in RULES.items()])
    found = votes.groupBy(*RULES).count().collect()  # at most 3 ** len(RULES) rows
    return estimate(sorted((tuple(row[:-1]), row[-1]) for row in found))


def judge(counted: DataFrame, right: Right) -> DataFrame:
    """Add base_failed, quality (the posterior) and kept to rows with counts."""
    start, each = weights(right)
    odds = F.lit(start)
    for rule, (down, up) in zip(RULES.values(), each, strict=True):
        vote = F.expr(rule)
        odds = odds + F.when(vote < 0, F.lit(down)).when(vote > 0, F.lit(up)).otherwise(F.lit(0.0))
    failed = F.expr(BASE_FAILED)
    return counted.withColumns({"base_failed": failed, "quality": 1 / (1 + F.exp(-odds)),
                                "kept": ~failed & (odds >= 0)})
