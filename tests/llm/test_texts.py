"""Text operators against plain Python, on rows that are easy to get wrong."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobtide.llm import bpe, decontamination, language, lm, near_dup, quality_net, quality_rules, toxicity, urls
from jobtide.llm.catalog import vocabulary
from jobtide.llm.common import GramTable, byte_view, stored, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 7919} Ünï" for i in range(60_000))
TEXTS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One  TWO three\tfour"),
    (6, "a b c d e f g h i j k l"), (7, "A B C D E F G H I J K L"), (7, "A B C D E F G H I J K L"),
    (8, LONG), (9, LONG + " and more"), (None, "a b c d e f g h i j k l"), (10, "x\x1cy z\x85 \U0001f642"),
    (11, "a b c a b c a b c " * 30), (12, "l'ÉTÉ\n\nl'ÉTÉ\nΟΔΟΣ <|endoftext|> it's 12a"),
]
# names that operators use themselves
EXTRA = "doc_id long, text string, score string, _text string, n string, node string, found string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*row, "s", "t", "u", "v", "w") for row in TEXTS]
    return stored(spark.createDataFrame(rows, EXTRA).coalesce(2), "texts")


@pytest.fixture(scope="module")
def empty(spark):
    return stored(spark.createDataFrame([], EXTRA), "texts")


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def test_hashes_are_equal_for_equal_words_only():
    texts = ["a b", "", "b", "ab a", "ba"]
    got, rows, start, stop = word_hashes(*byte_view(pa.array(texts)))
    flat = "".join(texts)
    named = collections.defaultdict(set)
    for h, i, j in zip(got.tolist(), start.tolist(), stop.tolist(), strict=True):
        named[flat[i:j]].add(h)
    assert rows.tolist() == [0, 0, 2, 3, 3, 4]
    assert all(len(x) == 1 for x in named.values()) and len(set.union(*named.values())) == len(named)


def test_gram_table_is_exact():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 5000, np.uint64))
    value, known = GramTable(keys, np.arange(len(keys))).get(np.concatenate([keys, keys + np.uint64(1)]))
    assert known[:len(keys)].all() and (value[:len(keys)] == np.arange(len(keys))).all()
    assert (known[len(keys):] == np.isin(keys + np.uint64(1), keys)).all()


def plain_counts(text):
    w, t = words(text), text or ""
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
            len(covered))


def test_quality_counts(docs, empty):
    got = quality_rules.counts(docs).select("doc_id", *quality_rules.COUNTS).collect()
    want = [(i, *plain_counts(t)) for i, t in TEXTS]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert quality_rules.judge(quality_rules.counts(empty), quality_rules.learn(
        quality_rules.counts(empty))).count() == 0


def vote(**votes):
    return tuple(votes.get(n, 0) for n in quality_rules.RULES)


def test_estimates_on_planted_votes():
    """Rules of known accuracy vote at random on texts of a known kind; the estimate finds share
    and accuracies, and a noisy bad vote is outvoted while two sound ones are not."""
    rng, n, good_share = np.random.default_rng(3), 40_000, 0.85
    kind = rng.random(n) < good_share
    truth = {"symbols": (0.99, 0.6), "repeats": (0.98, 0.7), "dup_lines": (0.99, 0.5), "length": (0.7, 0.35),
             "upper": (0.99, 0.6), "marks": (0.97, 0.6), "common": (0.95, 0.8)}
    votes = np.array([np.where(rng.random(n) < 0.9, np.where(
        kind, np.where(rng.random(n) < truth[r][0], 1, -1), np.where(rng.random(n) < truth[r][1], -1, 1)), 0)
        for r in quality_rules.RULES]).T
    found = sorted(collections.Counter(map(tuple, votes.tolist())).items())
    share, rules = right = quality_rules.estimate(found)
    assert share == pytest.approx(good_share, abs=0.01)
    for name, each in zip(quality_rules.RULES, rules, strict=True):
        assert each == pytest.approx(truth[name], abs=0.03)
    clean = dict.fromkeys(quality_rules.RULES, 1)
    assert quality_rules.posterior(vote(**clean | {"length": -1}), right) > 0.5
    assert quality_rules.posterior(vote(**clean | {"upper": -1, "common": -1}), right) < 0.5
    judged = np.array([quality_rules.posterior(tuple(v), right) >= 0.5 for v in votes[:4000].tolist()])
    assert (judged == kind[:4000]).mean() > 0.97
    assert ((votes[:4000] < 0).any(axis=1) & judged).sum() > 500  # all-must-pass would reject these


def test_estimate_without_texts():
    assert quality_rules.estimate([]) == (quality_rules.GOOD, [pytest.approx(quality_rules.START)] * len(quality_rules.RULES))


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_components(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return [(i, len(s), top(i), top(i) == i) for i, s in sets]


def test_texts_that_share_an_id(spark):
    """Both texts of an id are compared; what is like either is one component."""
    one, two, other = ([f"{w}{i}" for i in range(60)] for w in "abc")
    like = lambda words, n: " ".join([*words[:-n], *["new"] * n])
    rows = [(9, " ".join(one)), (5, like(one, 3)), (5, like(two, 2)), (7, " ".join(two)), (8, " ".join(other)),
            (5, None), (6, "a short one"), (6, "a short one"), (6, ""), (None, " ".join(one))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in near_dup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(9, 56, 5, False), (5, 56, 5, True), (5, 56, 5, True), (5, 0, 5, True), (7, 56, 5, False),
                          (8, 56, 8, True), (6, 1, 6, True), (6, 1, 6, True), (6, 0, 6, True), (None, 56, None, True)], key=repr)


def test_near_duplicates(docs, empty):
    got = [tuple(r) for r in near_dup.near_duplicates(docs).collect()]
    assert (None, 8, None, True) in got
    assert sorted(r for r in got if r[0] is not None) == sorted(plain_components(TEXTS))
    assert near_dup.near_duplicates(empty).count() == 0


def test_links_between_texts_unlike_the_least_one(spark):
    """A chain of texts, each like the next only, groups of copies, and a passage all share."""
    shared = [f"s{i}" for i in range(60)]
    rows = [(k, " ".join(shared + [f"p{i}" for i in range(30 * k, 30 * k + 300)])) for k in range(40)]
    rows += [(100 + k, " ".join(shared + [f"q{k}x{i}" for i in range(40)])) for k in range(60)]
    rows += [(200 + k, " ".join(shared + ["r"] * 3 + [f"r{i}" for i in range(80)] + [f"e{k}"])) for k in range(80)]
    rows += [(300 + k, rows[3][1].upper()) for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in near_dup.near_duplicates(df).collect()]
    assert sorted(got) == sorted(plain_components(rows))


def test_lists_that_become_rows_are_not_broadcast(spark, monkeypatch):
    """Spark takes a list for one row, so that a broadcast of its rows would be larger than it allows."""
    plans, stored = {}, near_dup.stored

    def seen(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(near_dup, "stored", seen)
    shared = [f"s{i}" for i in range(60)]
    rows = [(k, " ".join(shared + [f"p{i}" for i in range(30 * k, 30 * k + 300)])) for k in range(12)]
    near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert any("Generate explode" in p for p in plans["bands"]) and any("Generate explode" in p for p in plans["late"])
    for plan in (p for found in plans.values() for p in found):
        lines = [(len(x) - len(x.lstrip(" :+-")), x) for x in plan.splitlines()]
        for at, (depth, line) in enumerate(lines):
            if "BroadcastExchange" in line:
                for below, under in lines[at + 1:]:
                    if below <= depth:
                        break
                    assert "Generate explode" not in under


def test_estimate_is_corrected_for_chance():
    random = np.random.default_rng(3)
    one, two = (np.unique(random.integers(0, 1 << 63, 4000, np.uint64)) for _ in range(2))
    both = np.unique(np.concatenate([one, two[:1000]]))
    rows = near_dup.registers([one, two, both])
    n = np.array([len(one)]), np.array([len(two)])
    assert 0 < near_dup.chance(*n)[0] < 0.01
    assert near_dup.corrected(np.array([near_dup.chance(*n)[0]]), *n)[0] == pytest.approx(0)
    share = (rows[0] == rows[2]).mean()
    assert near_dup.corrected(np.array([share]), n[0], np.array([len(both)]))[0] == pytest.approx(0.8, abs=0.15)


ITEMS = [(1, "A b, c d e f g h i j"), (2, "c d e f g h i j k l and on"), (3, "one"), (4, None), (5, " .,"),
         (None, "three four"), (1, "a b c d e f g h i j"), (6, "w5 ünï w6 Ünï w7 ünï w8 ünï w9 ünï w10 ünï")]


def bench_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def test_benchmark_passages(spark, docs, empty, monkeypatch):
    items = spark.createDataFrame([(*r, "clash") for r in ITEMS], "item_id long, text string, k string")
    windows = collections.defaultdict(set)
    for i, text in ITEMS:
        w = bench_words(text)
        for k in range(max(len(w) - 10, 0) + 1 if w else 0):
            windows[tuple(w[k:k + 10])] |= {str(i)} if i is not None else set()

    def plain(text):
        w, hit, found = bench_words(text), set(), set()
        for n in {len(p) for p in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        return len(w), len(hit), sorted(found)

    want = sorted(((i, *plain(t)) for i, t in TEXTS), key=repr)
    for size in (1 << 20, 16):  # one table, and one for nearly every item
        monkeypatch.setattr(decontamination, "TABLE_BYTES", size)
        found = decontamination.scan(docs, items)
        assert set(found.columns) == set(docs.columns)
        got = found.select("doc_id", "found.n_words", decontamination.n_hit(F.col("found.spans")), "found.items")
        assert sorted(((*r[:3], list(r[3])) for r in got.collect()), key=repr) == want
    assert decontamination.scan(empty, items).count() == 0
    none = decontamination.scan(docs, items.limit(0)).select(F.sum(F.size("found.spans"))).first()[0]
    assert none == 0


def test_bpe_equals_the_library(docs, empty):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    coder = Tokenizer.from_file(path)
    got = bpe.decode(bpe.encode(docs, path), path).collect()
    want = []
    for i, text in TEXTS:
        ids = coder.encode(text or "", add_special_tokens=False).ids
        want.append((i, np.array(ids, "<u4").tobytes(), coder.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, bytes(r.ids), r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(empty, path), path).count() == 0


def test_lm_scores(docs, empty):
    learn = ~F.col("doc_id").isin(5, 7)
    got = lm.score(docs, learn).collect()
    tokens = [(i, words((t or "").translate(LOWER)) + ["\n"]) for i, t in TEXTS]
    count, pair, before = collections.Counter(), collections.Counter(), collections.Counter()
    for i, w in tokens:
        if i is not None and i not in (5, 7):
            count.update(w)
            pair.update(zip([" ", *w], w, strict=False))
            before.update([" ", *w[:-1]])
    total = count.total()
    want = []
    for i, w in tokens:
        base = [(count[x] + 1) / (total + len(count) + 1) for x in w]
        p = [(pair[a, x] + lm.STRENGTH * q) / (before[a] + lm.STRENGTH)
             for a, x, q in zip([" ", *w], w, base, strict=False)]
        want.append((i, len(w), sum(count[x] > 0 for x in w), total, sum(map(math.log10, base)),
                     sum(map(math.log10, p))))
    key = lambda r: (str(r[0]), r[1])
    rows = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got]
    for mine, other in zip(sorted(rows, key=key), sorted(want, key=key), strict=True):
        assert mine[:4] == other[:4] and mine[4] == pytest.approx(other[4])
        # one byte for a probability
        assert abs(mine[5] - other[5]) <= 0.02 * other[1]
    assert lm.score(empty, F.lit(True)).count() == 0


def test_elias_fano_finds_every_successor():
    random = np.random.default_rng(0)
    for most, n in ((1 << 63, 1000), (1 << 63, 1), (1000, 500), (1 << 50, 20_000), (5, 5)):
        values = np.unique(random.integers(0, most, n, np.uint64))
        level = lm.EliasFano(values, most)
        ask = np.concatenate([values, values + np.uint64(1), random.integers(0, most, 500, np.uint64)])
        at, equal = level.successor(ask)
        assert (at == np.searchsorted(values, ask)).all() and (equal == np.isin(ask, values)).all()
        assert (level.value(np.arange(len(values))) == values).all()


def labelled(spark):
    plain = [f"the house of number {i} and the garden of {i * 7} stands in the street" for i in range(200)]
    bad = [f"the zonk {i} of number {i} and zonky zonks in the street {i * 3}" for i in range(100)]
    rows = list(enumerate(plain + bad)) + [(1000, None), (1001, ""), (1002, "1 2"), (None, "zonk zonk")]
    docs = stored(spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, score string"), "d")
    labels = spark.createDataFrame([(i, int(i < 200), int(i >= 200)) for i in range(300)] + [(0, 1, 0), (5000, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def test_toxicity_of_held_out_rows(spark, empty):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, name="score").collect()}
    out = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((got[i] >= 0.5) == (i >= 200) for i in out) and got[None] >= 0.5
    assert got[1000] == got[1001] == got[1002] < 0.5
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.score(empty, None).count() == 0 == toxicity.score(empty, model).count()


def test_quality_net_of_held_out_rows(spark, empty):
    docs, labels = labelled(spark)
    net = quality_net.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality_net.score(docs, net, name="score").collect()}
    out = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == (i < 200) for i in out]) > 0.9
    assert got[1000] == got[1001] and all(0 <= x <= 1 for x in got.values())
    assert quality_net.fit(docs, labels.limit(0)) is None
    assert quality_net.score(empty, net).count() == 0
    # a text's score does not depend on its neighbours, and all of it counts
    alone = [net.score(pa.array([t], pa.string()))[0] for t in ("x " * 3000, "y", None)]
    assert net.score(pa.array(["x " * 3000, "y", None], pa.string())) == pytest.approx(alone, abs=1e-6)
    assert net.score(pa.array(["calm " * 800])) != net.score(pa.array(["calm " * 799 + "zonk!"]))


def test_language_words_first_then_characters(spark, empty):
    rows = [(i, "the house and the cat of this street", "en") for i in range(40)]
    rows += [(100 + i, "das Haus und die Katze der Straße", "de") for i in range(40)]
    rows += [(200, None, "de"), (201, "", None), (202, "12 + 3", "en"), (203, "Katzen", None),
             (204, "STREETS", None), (205, "the", None), (206, "Ж", None), (None, "und", "en")]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "d")
    model = language.fit(docs, F.lit(True))
    got = {r.doc_id: r.language for r in language.identify(docs.drop("lang"), model).collect()}
    assert [got[i].lang for i in (0, 100, 203, 204, 205, None)] == ["en", "de", "de", "en", "en", "de"]
    assert [tuple(got[i]) for i in (200, 201, 202)] == [("und", 0.0)] * 3
    assert got[206].lang in ("en", "de") and all(0 <= x.score <= 1 for x in got.values())
    assert language.fit(empty.withColumn("lang", F.lit("x")), F.lit(True)) is None
    assert language.identify(empty, model).count() == 0


URLS = [None, "", "no scheme.org/", "http://ORG/", "http://a.org", "http://a.org/x", "http://example.org/es/",
        "http://EXAMPLE.org/es?x", "https://m.example.org/en/1?y#z", "http://notexample.org/en/1", "x://a.com/de/1",
        "x://a.com/fr/", "ftp://b.com#/fr/", "http://É.com/fr/É", "http://a.com/fr/\n?q", "http://torg/", "://x.org/"]


def test_url_rules_and_models(spark):
    rules = [urls.rule("allow", "org/"), urls.rule("block", "example.org/es/"),
             urls.rule("block", "example.org/en/1"), urls.rule("allow", "com/fr/"), urls.rule("block", "com/de/")]
    rows = [(i, u, "clash") for i, u in enumerate(URLS)]
    rows += [(100 + i, f"http://s{i}.com/{'fr' if i % 2 else 'de'}/{i}", "clash") for i in range(200)]
    rows += [(400, "http://s1.net/fr/7", "c"), (401, "http://s1.net/de/8", "c")]
    df = stored(spark.createDataFrame(rows, "page_id long, url string, host string"), "u")
    judged = urls.with_rules(df, rules)
    got = {r.page_id: r for r in urls.judge(judged, urls.fit(judged)).collect()}
    for i, url, _ in rows:
        rest = (url or "").partition("://")[2]
        host = re.match("[^/?#]*", rest)[0].translate(LOWER)
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fit = [(len(h + p), h + p, v) for v, h, p in rules
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, None, None))
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best[1])
        assert got[i].verdict == (best[2] or ("allow" if got[i].accepted >= 0.5 else "block"))
    assert got[400].verdict == "allow" and got[401].verdict == "block"
    assert urls.fit(judged.limit(0)) is None and urls.judge(judged.limit(0), None).count() == 0


def test_digests():
    assert hashlib.sha256(b"").hexdigest() == hashlib.sha256(np.array([], "<u4").tobytes()).hexdigest()
