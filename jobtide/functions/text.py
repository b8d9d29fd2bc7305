"""Text and array expressions."""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
import zlib
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def no_strings() -> Column:
    return F.array().cast("array<string>")


def strip(c: Column) -> Column:
    """Remove white space of every kind at both ends (`trim` drops blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def texts_of_json(c: Column) -> Column:
    """`from_json` to a list of texts. A list of quoted texts without escapes, which most are, is cut at
    its quotes, without a parser that has to be set up for each."""
    plain = c.rlike(r'^\["[^"\\\x00-\x1f]*+(?:","[^"\\\x00-\x1f]*+)*+"\]\z')
    return F.when(plain, F.split(F.substring(c, F.lit(3), F.length(c) - 4), '","')).otherwise(
        F.from_json(c, "array<string>"))


def truthy(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def literal_map(pairs: dict, value_type: str = "string") -> Column:
    """A constant map; Spark folds it into one literal of the plan."""
    text = json.dumps(pairs, ensure_ascii=False)
    return F.from_json(F.lit(text), f"map<string,{value_type}>")


def literal_list(values: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(values, ensure_ascii=False)), "array<string>")


def canonical_skills(skills: Column, aliases: dict[str, str]) -> Column:
    """Strip, map known spellings to their canonical name, keep unknown ones; sorted set."""
    table = literal_map({spelling: name for spelling, name in aliases.items() if spelling == spelling.strip()})

    def named(s: Column) -> Column:
        # most are known as they stand, and need not be stripped
        return F.coalesce(F.try_element_at(table, F.lower(s)), F.try_element_at(table, F.lower(strip(s))), strip(s))

    found = F.array_distinct(F.transform(F.filter(skills, truthy), named))
    return F.coalesce(F.sort_array(found), no_strings())


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also where a lambda inside reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _is_word(sign: str) -> bool:
    """What `(?U)\\w` takes."""
    kind = unicodedata.category(sign)
    return kind[0] in "LM" or kind in ("Nd", "Nl", "Pc") or sign in "\u200c\u200d"


def _runs(term: str) -> list[str]:
    """Stretches of word signs and of other signs, in turn."""
    return ["".join(g) for _, g in itertools.groupby(term, _is_word)]


def hash_table(entries: dict[str, list], value_type: str) -> Column:
    """A constant table of texts to lists: an array of small maps, dealt by crc32. Spark looks up a
    map by reading it from the start; here that is a few entries, however many there are in all."""
    slots: list[dict[str, list]] = [{} for _ in range(max(len(entries), 1))]
    for name, value in entries.items():
        slots[zlib.crc32(name.encode()) % len(slots)][name] = value
    return F.from_json(F.lit(json.dumps(slots, ensure_ascii=False)), f"array<map<string,array<{value_type}>>>")


def hash_lookup(table: Column, slots: int, name: Column) -> Column:
    """The list of a text, null if there is none."""
    slot = F.pmod(F.crc32(name.cast("binary")), F.lit(max(slots, 1))).cast("int")
    return F.try_element_at(F.get(table, slot), name)


def scan_terms(text: Column, terms: list[str]) -> Column:
    """Sorted subset of `terms` that occur in the text as whole words, in any case.

    A word bound lies wherever word signs and other signs meet, so a term between two bounds is a
    row of whole runs of either kind. The text is cut into runs once; a run that begins some term
    (a lookup by hash) leads to the terms that begin with it, and each of these is compared with as
    many runs from there on as it has. Time does not grow with the number of terms, except for
    terms of one first word.
    """
    by_first: dict[str, dict[str, dict]] = {}
    for term in terms:
        low = term.lower()
        runs = _runs(low)
        if not runs:
            continue
        entry = by_first.setdefault(runs[0], {}).setdefault(low, {
            "term": low, "runs": len(runs), "names": [],
            # signs other than word signs have a bound beside word signs only
            "before": not _is_word(low[0]), "after": not _is_word(low[-1])})
        entry["names"].append(term)
    firsts = {first: list(found.values()) for first, found in by_first.items()}
    table = hash_table(firsts, "struct<term:string,runs:int,names:array<string>,before:boolean,after:boolean>")

    def hits(cut: Column) -> Column:
        n = F.size(cut)

        def at(run: Column, i: Column) -> Column:
            def fits(t: Column) -> Column:
                inside = (~t["before"] | (i > 0)) & (~t["after"] | (i + t["runs"] < n))
                return inside & (F.array_join(F.slice(cut, i + 1, t["runs"]), "") == t["term"])

            begun = hash_lookup(table, len(firsts), run)
            return F.flatten(F.transform(F.filter(begun, fits), lambda t: t["names"]))

        return F.flatten(F.array_compact(F.transform(cut, at)))

    cut = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(\w+|\W+)"), F.lit(1))
    return F.coalesce(F.array_sort(F.array_distinct(_let(cut, hits))), no_strings())


def _quote(term: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", term)


def union_sorted(*arrays: Column) -> Column:
    whole = F.concat(*[F.coalesce(a, no_strings()) for a in arrays])
    return F.array_sort(F.array_distinct(whole))


def lower_set(array: Column) -> Column:
    return F.array_distinct(F.transform(F.coalesce(array, no_strings()), F.lower))


def percent_encode(c: Column) -> Column:
    """Percent-encoding that keeps only letters, digits and `_.-~` (form encoding differs in
    three characters)."""
    form = F.url_encode(c)
    return F.replace(F.replace(F.replace(form, F.lit("+"), F.lit("%20")),
                               F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def html_escape(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"),
                      ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def offer_url(slug: Column, base: str) -> Column:
    return F.when(truthy(slug), F.concat(F.lit(base), percent_encode(slug)))


def listing_id_of(token: Column) -> Column:
    """A raw id as it stands, or the last path part of a link."""
    clean = strip(token)
    tail = F.regexp_extract(clean, r"([^/]+)/*$", 1)
    return F.when(clean.startswith("http") & (tail != ""), tail).otherwise(clean)


def phrase_tokens(text: Column, names: list[str]) -> Column:
    """Split typed words into technology names: known phrases of up to three words are kept
    together (longest first), known single words get their usual casing, others stay."""
    phrases = sorted((n for n in names if " " in n), key=lambda n: -len(n.split()))
    body = "|".join(r"\s+".join(_quote(w) for w in p.split()) for p in phrases)
    found = F.regexp_extract_all(text, F.lit(rf"(?iu)(?<!\S)((?:{body})(?!\S)|\S+)"), F.lit(1))
    table: dict[str, str] = {}
    for n in names:
        table.setdefault(n.lower(), n)
    known = literal_map(table)
    return F.transform(
        F.transform(found, lambda t: F.regexp_replace(t, r"\s+", " ")),
        lambda t: F.coalesce(F.try_element_at(known, F.lower(t)), t),
    )
