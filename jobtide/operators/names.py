"""Typed names: technology phrases and cities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import literal_list, literal_map, no_strings, phrase_tokens
from jobtide.vocab import KNOWN_CITIES, KNOWN_TECHS


def parse_terms(df: DataFrame, col: str, names: list[str] = KNOWN_TECHS) -> DataFrame:
    """Add `terms`: the technology names in a line of typed words."""
    return df.withColumn("terms", phrase_tokens(F.col(col), names))


def canonical_city(df: DataFrame, col: str, names: list[str] = KNOWN_CITIES) -> DataFrame:
    """Add the usual casing of a known city, or up to three similar names for an unknown one."""
    typed = F.lower(col)
    known = F.try_element_at(literal_map({n.lower(): n for n in names}), typed)
    close = F.filter(literal_list(names),
                     lambda n: F.contains(F.lower(n), typed) | F.contains(typed, F.lower(n)))
    return df.withColumns({
        "city_name": F.coalesce(known, F.col(col)), "recognised": known.isNotNull(),
        "suggestions": F.when(known.isNull(), F.slice(close, 1, 3)).otherwise(no_strings()),
    })
