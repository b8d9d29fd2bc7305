import hashlib
import hmac
import html
import random
import re
from urllib.parse import quote

from pyspark.sql import functions as F

from jobtide.functions import keys, text
from jobtide.operators import names
from jobtide.vocab import CANONICAL_TECHS, KNOWN_TECHS, TECH_ALIASES


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(expr(F.col("v")).alias("o"), "i").orderBy("i").collect()]


def test_canonical_skills(spark):
    lists = [[" Python3 ", "py", "Rust", "rust"], None, [], ["", "  ", "K8S\t"], [" sql "]]
    got = column(spark, lists, lambda c: text.canonical_skills(c, TECH_ALIASES), "array<string>")
    want = [sorted({TECH_ALIASES.get(s.strip().lower()) or s.strip() for s in x or [] if s})
            for x in lists]
    assert got == want


def test_scan_terms_against_one_search_per_term(spark):
    rng = random.Random(5)
    words = CANONICAL_TECHS + ["javascripts", "gone", "GO", "é", "ego", "go_", "node.jsx", "Apache",
                               "power", "bi", "Goé", "éGo", "my sql", "C++"]
    texts = [rng.choice([" ", ", ", "-", "\n"]).join(rng.choices(words, k=12)) for _ in range(300)]
    texts += ["", None, "Apache Apache Spark", "POWER BI", "python-go/dbt"]
    terms = CANONICAL_TECHS + ["Apache", "Power"]
    got = column(spark, texts, lambda c: text.scan_terms(c, terms))
    assert got == [sorted(t for t in terms if re.search(rf"\b{re.escape(t)}\b", x or "", re.I))
                   for x in texts]


def test_scan_terms_of_signs_and_many_names(spark):
    rng = random.Random(6)
    terms = ["C++", ".NET", "c#", "node.js", "Node", "++", "CI/CD", "a b", "A  B", "-", "go-", "_x", "ci"]
    texts = ["c++", "c++11", "asp.net", ".net", "x .net core", "a++b", "node.js", "Node.JSX", "ci/cd", "CI / CD",
             "a b", "a  b", "go-to", "go-", "-", "x-y", "_x", "c#4 c#", "", None]
    texts += ["".join(rng.choices(["c", "+", "#", ".net", " ", "go", "-", "/", "ci", "node", "a", "b"], k=9))
              for _ in range(200)]
    many = terms + [f"Name{i} {i % 7}" for i in range(3000)] + ["name12 5 name13 6"]
    texts += ["name12 5 name13 6", "see NAME2999 3, name299"]
    got = column(spark, texts, lambda c: text.scan_terms(c, many))
    assert got == [sorted({t for t in many if re.search(rf"\b{re.escape(t)}\b", x or "", re.I)}) for x in texts]
    assert column(spark, ["a", None], lambda c: text.scan_terms(c, [])) == [[], []]


def test_percent_encoding_and_escaping(spark):
    values = ["a b+c*d~e", "ł&<>\"'/?%", "", "x-y_z.1"]
    assert column(spark, values, text.percent_encode) == [quote(v, safe="") for v in values]
    assert column(spark, values, text.html_escape) == [html.escape(v) for v in values]


def test_listing_id_of(spark):
    tokens = [" abc ", "https://x.io/offers/s-1", "https://x.io/offers/s-2//", "http://", "a/b"]
    assert column(spark, tokens, text.listing_id_of) == ["abc", "s-1", "s-2", "http:", "a/b"]


def test_pseudonym_is_hmac(spark):
    ids, salt = ["1", "-100200", "42"], "s" * 80
    assert column(spark, ids, lambda c: keys.pseudonym(c, salt)) == [
        hmac.new(salt.encode(), i.encode(), hashlib.sha256).hexdigest()[:16] for i in ids]


def greedy(words):
    phrases = {n.lower(): n for n in KNOWN_TECHS if " " in n}
    single = {}
    for n in KNOWN_TECHS:
        single.setdefault(n.lower(), n)
    out, i = [], 0
    while i < len(words):
        for size in (3, 2):
            joined = " ".join(words[i:i + size]).lower()
            if i + size <= len(words) and joined in phrases:
                out.append(phrases[joined])
                i += size
                break
        else:
            out.append(single.get(words[i].lower(), words[i]))
            i += 1
    return out


def test_phrase_tokens_against_a_greedy_walk(spark):
    rng = random.Random(3)
    pool = [w for n in KNOWN_TECHS for w in n.split()] + ["foo", "APACHE", "c++x", "spark."]
    lines = [" ".join(rng.choices(pool, k=rng.randint(1, 8))) for _ in range(300)]
    assert column(spark, lines, lambda c: text.phrase_tokens(c, KNOWN_TECHS)) == [
        greedy(line.split()) for line in lines]


def test_cities(spark):
    df = spark.createDataFrame([("KRAKÓW",), ("Gda",), ("Atlantis",), ("Warszawa Centrum",)], "c string")
    got = {r.c: (r.city_name, r.recognised, r.suggestions)
           for r in names.canonical_city(df, "c").collect()}
    assert got["KRAKÓW"] == ("Kraków", True, [])
    assert got["Gda"] == ("Gda", False, ["Gdańsk"])
    assert got["Atlantis"] == ("Atlantis", False, [])
    assert got["Warszawa Centrum"][2] == ["Warszawa"]


def test_texts_of_json_are_those_of_the_parser(spark):
    texts = ['["a","b",""]', '[""]', "[]", '["a"]', '["a", "b"]', '["a\\"b","c"]', '["a\tb"]', '["ż ó","😀"]', '["a","b"]x',
             '["a","b"]\n', '["a"b","c"]', '[1,"a"]', '["a",null]', '[["a","b"]]', "none", "", None, '["a","b"', '["a,b","]["]']
    df = spark.createDataFrame([(x,) for x in texts], "c string")
    found = df.select("c", text.texts_of_json(F.col("c")).alias("mine"), F.from_json("c", "array<string>").alias("parser")).collect()
    assert all(r.mine == r.parser for r in found), [r for r in found if r.mine != r.parser]


def test_known_spellings_and_blanks(spark):
    skills = [[" Python ", "python", "JS", " js ", "odd one ", "", None, " padded"], [], None]
    df = spark.createDataFrame([(x,) for x in skills], "s array<string>")
    aliases = {"python": "Python", "js": "JavaScript", " padded": "never"}
    found = [r[0] for r in df.select(text.canonical_skills(F.col("s"), aliases)).collect()]
    assert found == [["JavaScript", "Python", "odd one", "padded"], [], []]
