import random
import weakref

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobtide.llm import decontamination, language, toxicity
from jobtide.llm.common import arrow_texts, held_out, learning_rows


def texts_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def in_hash_order(spark, n):
    """Ids that are not held out, in the order in which samples take them."""
    ids = spark.range(n).select(F.col("id").alias("doc_id")).where(~held_out("doc_id", 5, 0))
    return [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id")).collect()]


def test_a_huge_text_does_not_keep_others_out(spark):
    ids = in_hash_order(spark, 60)
    huge = {ids[0], ids[5]}
    docs = texts_of(spark, [(i, "x" * (5000 if i in huge else 10)) for i in ids])
    labels = spark.createDataFrame([(i, 1) for i in ids] + [(1000 + i, 0) for i in ids], "doc_id long, toxic int")
    docs = docs.unionByName(docs.select((F.col("doc_id") + 1000).alias("doc_id"), F.lit("plain").alias("text")))
    sample, sizes = learning_rows(docs, labels, "toxic", 5, 0, 100, 1000)
    assert len(sample[1]) == len(ids) - 2 and max(map(len, sample[1])) == 10
    assert sizes[1] == len(ids)
    # neither do texts that fit by themselves, in rows or in bytes
    sample, _ = learning_rows(docs, labels, "toxic", 5, 0, 20, 5100)
    assert len(sample[1]) == 20 and max(map(len, sample[1])) == 10


def test_labelled_rows_that_do_not_fit_are_an_error(spark):
    ids = in_hash_order(spark, 40)
    docs = texts_of(spark, [(i, "word " * 300) for i in ids])
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, toxic int")
    with pytest.raises(ValueError, match="needed"):
        toxicity.fit(docs, labels, class_bytes=1000)
    assert toxicity.fit(docs, labels.where("toxic = 1")) is None


def test_no_language_vanishes_behind_a_long_text(spark):
    rows = [(i, "de", "x " * (600 if i % 3 == 0 else 5)) for i in range(30)] + [(90, "fr", "le chat " * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = language.sampled(docs, F.lit(True), 100, 1000)
    assert sum(lang == "de" for lang, _ in got) == 20
    assert [text for lang, text in got if lang == "fr"] == [("le chat " * 900)[:250]]


def words_of(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.choice('klmnr')}o" for _ in range(n)]


def differences(toxic, plain, texts):
    return toxicity._learn(toxic, plain).difference(arrow_texts(texts)).tolist()


def test_a_pair_counts_before_its_words():
    rng = random.Random(1)
    plain = [" ".join([*words_of(rng, 40), "burn", *words_of(rng, 3), "them"]) for _ in range(400)]
    toxic = [" ".join([*words_of(rng, 40), *["burn", "them"][:i % 2 * 2]]) for i in range(400)]
    around = words_of(rng, 20)
    pair, apart = differences(toxic, plain, [" ".join([*around, "burn", "them"]),
                                             " ".join(["them", *around, "burn"])])
    assert pair > 0.1 and apart < 0


def test_pairs_back_off_to_expressions():
    rng = random.Random(2)
    plain = [" ".join(words_of(rng, 40)) for _ in range(400)]
    toxic = [" ".join([*words_of(rng, 20), "scum", *words_of(rng, 20)]) for _ in range(400)]
    met, new, unknown = differences(toxic, plain, ["maro scum", "neverseen scum", "neverseen other"])
    assert met > 0.3 and new > 0.3 and abs(unknown) < 0.01


@pytest.mark.parametrize("bad, good", [
    ("identxicals", "identxicon"), ("сволочами", "сволочка"), ("verdammtheit", "verdammung")])
def test_whole_words_are_told_apart(bad, good):
    rng = random.Random(3)
    plain = [" ".join([*words_of(rng, 40), good]) for _ in range(400)]
    toxic = [" ".join([*words_of(rng, 40), bad]) for _ in range(400)]
    up, down = differences(toxic, plain, [f"xx {bad.upper()}", f"xx {good}"])
    assert up > 0.3 and down < -0.3


def test_scripts_without_spaces_are_read_whole():
    rng = random.Random(4)
    signs = "".join(map(chr, range(0x4E00, 0x4E80)))
    around = lambda n: "".join(rng.choices(signs, k=n))
    plain = [around(40) for _ in range(300)]
    toxic = [f"{around(20)}白痴{around(20)}" for _ in range(300)]
    up, down = differences(toxic, plain, [f"{around(10)}白痴{around(10)}", around(20)])
    assert up > 0.1 and abs(down) < 0.05


def test_expressions():
    def parts(text):
        flat, offsets = toxicity.lowered(pa.array([text, "end"], pa.large_string()))
        return len(toxicity.events(flat, offsets)[1]) - 1

    assert [parts(x) for x in ("a b", "“a” – b…", "白痴、x。ab漢", "ไทย", "Слово слово", "", "é", "漢")] == [
        2, 2, 5, 3, 2, 0, 1, 1]
    same = [toxicity.events(*toxicity.lowered(arrow_texts([x])))[1] for x in ("СЛОВО", "«слово»")]
    assert np.array_equal(*same)


def test_copies_of_a_key_are_one_text(spark):
    rows = [(1, "de", "ein Text")] * 50 + [(2, "de", "zwei"), (1, "fr", "un")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert language.sampled(docs, F.lit(True), 100, 1000) == [("de", "ein Text"), ("de", "zwei"), ("fr", "un")]


def test_no_word_is_dropped_from_many_languages():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))
    languages = [f"l{k:02}" for k in range(12)]
    often = {x: " ".join([word() for _ in range(40_000)] * 2) for x in languages[:-1]}
    last = " ".join(word() for _ in range(2_000))
    model = language.fit_texts([*often.items(), (languages[-1], last)])
    assert model.words.index.get(toxicity.events(*toxicity.lowered(arrow_texts([last])))[1])[1].all()
    assert model.score(pa.array(last.split()[:200])).field("lang").to_pylist() == [languages[-1]] * 200


def test_one_search_table_at_a_time(spark, monkeypatch):
    rng = random.Random(7)
    items = spark.createDataFrame([(f"i{i}", " ".join(words_of(rng, 30))) for i in range(20)], "item_id string, text string")
    texts = [r.text for r in items.collect()]
    docs = texts_of(spark, [(i, f"start {x} {' '.join(words_of(rng, 20))} {texts[i - 1]}") for i, x in enumerate(texts)])
    one = decontamination.scan(docs, items).orderBy("doc_id").collect()
    monkeypatch.setattr(decontamination, "TABLE_BYTES", 500)
    alive, most, build = [], [], decontamination.WuManber.__init__

    def counted(self, *args):
        build(self, *args)
        alive.append(weakref.ref(self))
        most.append(sum(x() is not None for x in alive))

    monkeypatch.setattr(decontamination.WuManber, "__init__", counted)
    found = decontamination.scan(docs, items)
    assert len(most) > 3 and max(most) == 1
    assert found.orderBy("doc_id").collect() == one
    assert all(len(r.found["items"]) == 2 for r in one)


def test_each_model_is_a_distribution():
    """Counts, continuation types and sums, against dictionaries."""
    rng = random.Random(9)
    toxic = [" ".join([*words_of(rng, 30), "scum", "it"]) for _ in range(60)] + ["scum scum", ""]
    plain = [" ".join(words_of(rng, 30)) for _ in range(150)]
    sample = toxicity.Sample.of(toxic, plain)
    hash_of = lambda w: toxicity.events(*toxicity.lowered(arrow_texts([w])))[1][0]
    for texts, follows, together in zip((toxic, plain), sample.follows, sample.together):
        before, in_texts, pairs = {}, {}, {}
        for i, t in enumerate(texts):
            words = t.split()
            for h, w in zip(["", *words], words):
                before.setdefault(w, set()).add(h)
                in_texts.setdefault(w, set()).add(i)
                pairs.setdefault((h, w), set()).add(i)
        got = dict(zip(sample.words.tolist(), follows.tolist()))
        for w in before:
            assert got[hash_of(w)] == min(len(before[w]), len(in_texts[w]))
        assert sum(follows) == sum(min(len(before[w]), len(in_texts[w])) for w in before)
        assert sorted(x for x in together if x) == sorted(map(len, pairs.values()))
    for even in toxicity.EVEN:
        known, unknown = sample.expressions(even)
        given, back = sample.given(even, known)
        for k in range(2):
            assert known[k].sum() + unknown[k] == pytest.approx(1)
            n = len(sample.before)
            held = np.bincount(sample.context_of, given[k], n)
            rest = back * (1 - np.bincount(sample.context_of, known[k][sample.word_of], n))
            assert held + rest == pytest.approx(np.ones(n)) and (given[k] > 0).all()


def test_a_word_of_all_toxic_texts_tells_after_any_other(spark):
    """The predecessor is new, and the word has no other in the sample."""
    rows = [(i, f"the house {i} of number {i * 7} in the street") for i in range(200)]
    rows += [(200 + i, f"the zonk {i} of number {i * 7} in the street") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") >= 200).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    got = model.score(arrow_texts(["the zonk", "zonk zonk", "a zonk here", "you zonk", "a house here", "", "7"]))
    assert (got[:4] > 0.5).all() and (got[4:] < 0.5).all()
    assert got[5] == got[6] == pytest.approx(model.share)
