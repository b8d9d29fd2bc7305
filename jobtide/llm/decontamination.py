"""Benchmark passages in documents by Wu-Manber multi-pattern search.

Texts are brought to one form: lower-cased words parted by single spaces, with a space at both
ends, so that a window of words occurs exactly where its bytes do. Windows are sorted into
classes of like length. For each class a table says for every block of bytes how far a window can
lie ahead at least; blocks that no window has let the search skip nearly a whole window. Where
the table says 0, a bucket of windows is chosen by the bytes seen and compared in full.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import arrow_column

WINDOW = 10
BLOCK = 12
# bytes of test items in one search table; the table has about one entry a byte
TABLE_BYTES = 1 << 20


def _form() -> bytes:
    """Digits, lower-case letters and bytes beyond ASCII stay, capitals become small, the rest
    becomes a space."""
    out = bytearray(b" " * 256)
    for c in range(256):
        if chr(c).isascii() and chr(c).isalnum():
            out[c] = ord(chr(c).lower())
        elif c >= 128:
            out[c] = c
    return bytes(out)


FORM = _form()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FORM).split()


class WuManber:
    """Search tables for windows of items; `items` gives for each window the items that have it."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for name, text in items:
            words = words_of(text)
            for i in range(max(len(words) - window, 0) + 1 if words else 0):
                pattern = b" " + b" ".join(words[i:i + window]) + b" "
                owners.setdefault(pattern, set()).update(() if name is None else (name,))
        self.items = {p: tuple(sorted(x)) for p, x in owners.items()}
        classes: dict[int, list[bytes]] = {}
        for pattern in self.items:
            classes.setdefault(len(pattern).bit_length(), []).append(pattern)
        self.classes = [self._class(x) for _, x in sorted(classes.items())]

    @staticmethod
    def _class(patterns: list[bytes]) -> tuple:
        least = min(map(len, patterns))
        block = max(1, min(BLOCK, least // 3))
        shift: dict[bytes, int] = {}
        bucket: dict[bytes, list[bytes]] = {}
        for p in patterns:
            for end in range(block, least + 1):
                part, ahead = p[end - block:end], least - end
                if shift.get(part, least) > ahead:
                    shift[part] = ahead
            bucket.setdefault(p[:least], []).append(p)
        return least, block, shift, bucket

    def search(self, text: bytes) -> list[tuple[int, bytes]]:
        """Places and windows of all occurrences in a text in form, in order of place."""
        found = []
        for least, block, shift, bucket in self.classes:
            skip, end, size = least - block + 1, least, len(text)
            ahead = shift.get
            while end <= size:
                step = ahead(text[end - block:end], skip)
                if step:
                    end += step
                    continue
                for p in bucket.get(text[end - least:end], ()):
                    if text.startswith(p, end - least):
                        found.append((end - least, p))
                end += 1
        found.sort()
        return found

    def spans(self, text: bytes) -> tuple[int, list[dict], list[str]]:
        """Number of words, spans of hit words (merged), items with an occurring window."""
        words = words_of(text)
        text = b" " + b" ".join(words) + b" "
        at = seen = 0
        spans: list[list[int]] = []
        items: set[str] = set()
        for place, p in self.search(text):
            at, seen = at + text.count(b" ", seen, place), place
            end = at + p.count(b" ") - 1
            if spans and at <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([at, end])
            items.update(self.items[p])
        return len(words), [{"start": a, "end": b} for a, b in spans], sorted(items)


KIND = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>"
ARROW = pa.struct([("n_words", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                   ("items", pa.list_(pa.string()))])


def _scan(table: WuManber, texts: pa.Array) -> pa.Array:
    out = [table.spans(x or b"") for x in texts.cast(pa.binary()).to_pylist()]
    return pa.array([{"n_words": a, "spans": b, "items": c} for a, b, c in out], ARROW)


def _tables(items: DataFrame, key: str, text: str, window: int) -> list[Broadcast]:
    """Search tables for blocks of items, sent to the tasks; only one block of items and its table
    are in the driver's memory at a time, those sent are files."""
    rows = items.select(F.col(key).cast("string").alias("k"), F.col(text).cast("binary").alias("t")).where(
        F.col("t").isNotNull())
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = total // TABLE_BYTES + 1
    part = F.pmod(F.xxhash64("k", "t"), F.lit(n))

    def table(i: int) -> WuManber:
        found = sorted(((k, bytes(t)) for k, t in rows.where(part == i).collect()),
                       key=lambda x: (x[0] or "", x[1]))
        return WuManber(found, window)

    return [items.sparkSession.sparkContext.broadcast(table(i)) for i in range(n)]


def _searcher(sent: Broadcast, only: bool) -> Callable[[pa.Array], pa.Array]:
    """A search with a table that a task keeps if it is the only one, and else loads for each
    batch, so that it holds one table at a time."""
    def run(texts: pa.Array) -> pa.Array:
        held = only or hasattr(sent, "_value")  # as it came, if Spark encrypts its files
        return _scan(sent.value if held else sent.load_from_path(sent._path), texts)

    return run


def scan(
    docs: DataFrame, items: DataFrame, text: str = "text", name: str = "found",
    item_key: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Add a struct: n_words, spans of hit words (start, end), items with an occurring window.

    A null text has no words. A null or empty item has no window; an item without a key marks
    words, but is not listed. Rows keep their other columns; one named like the struct is
    replaced. Items go to the tasks in tables of TABLE_BYTES bytes of text; each adds a column
    and the columns are merged, so that no row is shuffled. Every text is searched once per table,
    and the number of tables grows with the items.
    """
    tables, parts = _tables(items, item_key, item_text, window), []
    only = len(tables) == 1
    for i, sent in enumerate(tables):
        parts.append(f"_part{i}")
        docs = arrow_column(docs, text, parts[-1], KIND,
                            lambda sent=sent: _searcher(sent, only))
    if len(parts) == 1:
        return docs.withColumn(name, F.col(parts[0])).drop(*parts)
    spans = F.array_sort(F.flatten(F.array(*[F.col(p)["spans"] for p in parts])))
    merged = F.aggregate(
        spans, F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))
        ).otherwise(F.concat(acc, F.array(x))))
    listed = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(p)["items"] for p in parts]))))
    whole = F.struct(F.col(parts[0])["n_words"].alias("n_words"), merged.alias("spans"), listed.alias("items"))
    return docs.withColumn(name, whole).drop(*parts)


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
