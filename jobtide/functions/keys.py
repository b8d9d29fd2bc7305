"""Surrogate keys and keyed pseudonyms."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.vocab import NULL_KEY


def surrogate_key(*cols: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def member_key(c: Column) -> Column:
    """Key of a dimension that was built from this very column.

    Such a dimension holds every value but null and '', and its key is a hash of the value, so
    the left join to it needs no join at all.
    """
    return F.when(c.isNotNull() & (c != ""), surrogate_key(c))


def member(c: Column) -> Column:
    """The natural value as it comes back from such a dimension: '' turns into null."""
    return F.when(c != "", c)


def pads(salt: str) -> tuple[bytes, bytes]:
    """Inner and outer HMAC-SHA256 pads of a secret."""
    key = salt.encode()
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def pseudonym(value: Column, salt: str) -> Column:
    """First 16 hex digits of HMAC-SHA256, built from the plain hash function."""
    inner, outer = pads(salt)
    first = F.sha2(F.concat(F.lit(bytearray(inner)), F.encode(value.cast("string"), "UTF-8")), 256)
    return F.substring(F.sha2(F.concat(F.lit(bytearray(outer)), F.unhex(first)), 256), 1, 16)
