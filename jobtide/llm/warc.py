"""WARC archives: write pages with revisits, read records back by boundary-chain verification.

Spark's text source cuts an archive at every magic string, also inside payloads and across the
byte ranges of tasks. Each piece is a candidate record with the offset of its successor. Inside
a byte range candidates are linked by pointer jumping to the offset at which they leave it; the
same jumps over the ranges of a file then find where the chain from the file's start enters each
range. Candidates off that chain lie in payloads and are no records. Only narrow rows take part;
a payload is looked at where it lies, and those that hold the magic are put together afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from jobtide.llm.common import flagged, stored

MAGIC = "WARC/1.0\r\n"
GAP = "\r\n\r\n"
PROFILE = "http://netpreservecommons.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
# fixed values: the digits of base 32 as Spark's conv writes them and as RFC 4648 does
CONV_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexes: Column) -> Column:
    """Base 32 of 40 hexadecimal digits: 5 of them are 4 digits of base 32."""
    parts = [F.lpad(F.conv(F.substring(hexes, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32_DIGITS)


def with_roles(pages: DataFrame, key: str, payload: Column, least_bytes: int = 0) -> DataFrame:
    """Add _payload, _digest and _first: the largest key of the pages with the same payload.

    Counting goes by digest with partial sums, and the join back is one that Spark can split, so
    that one payload may be on any share of the pages. Only pages whose digest may be a repeated
    one are shuffled for it; for the others _first is null.
    """
    pages = pages.withColumn("_payload", F.coalesce(payload, F.lit("")))
    pages = pages.withColumn("_digest", base32(F.sha1(F.col("_payload").cast("binary"))))
    large = F.octet_length("_payload") >= least_bytes
    first = stored(pages.where(large).groupBy("_digest").agg(
        F.max(key).alias("_first"), F.count("*").alias("n")).where("n > 1").drop("n"), "first")
    marked = flagged(pages.withColumn("_large", large), first.select("_digest"), "_digest", "_again")
    again = marked.where("_again AND _large").drop("_again", "_large").join(first, "_digest", "left")
    alone = marked.where("NOT (_again AND _large)").drop("_again", "_large").withColumn(
        "_first", F.lit(None).cast(first.schema["_first"].dataType))
    return again.unionByName(alone)


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
          least_bytes: int = 0) -> None:
    """One record per row: a response, or for a payload of at least least_bytes bytes that a page
    with a larger key also has, a revisit of that page.

    A null payload is an empty one, a null URL is left out, line breaks in a URL are escaped. A
    row with a null key is a response unless another row has its payload.
    """
    rows = with_roles(pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"),
                                   F.col(payload).alias("_body")), "_key", F.col("_body"), least_bytes)
    again = F.coalesce(~F.col("_first").eqNullSafe(F.col("_key")) & F.col("_first").isNotNull(), F.lit(False))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))
    uri = F.replace(F.replace(F.col("_url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("_payload").cast("string"), F.lit(GAP))
    block = F.when(again, http).otherwise(F.concat(http, F.col("_payload")))
    head = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("_key"))), line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        F.when(again, F.concat(line("WARC-Refers-To", name(F.col("_first"))),
                               line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(GAP))
    rows.select(F.concat(head, block).alias("value")).write.option("lineSep", GAP).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"))


def _field(head: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def _parsed(df: DataFrame, derive: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Header fields of the text after a magic, whether its whole block is there, and what is
    derived from the payload if so."""
    head = F.substring_index("value", GAP, 1)
    df = df.withColumns({"head": head, "size": F.octet_length("value").cast("long")})
    length = F.regexp_extract("head", r"(?im)^Content-Length:[ \t]*(\d{1,15})[ \t]*$", 1)
    df = df.withColumns({
        "head_bytes": (F.octet_length("head") + len(GAP)).cast("long"),
        "length": F.when(length != "", length.cast("long")),
        "type": _field(F.col("head"), "WARC-Type"), "record_id": _field(F.col("head"), "WARC-Record-ID"),
        "uri": _field(F.col("head"), "WARC-Target-URI"),
        "refers_to": _field(F.col("head"), "WARC-Refers-To"),
        "digest": _field(F.col("head"), "WARC-Payload-Digest"),
        "content": _field(F.col("head"), "Content-Type")})
    df = df.withColumn("whole", F.coalesce(F.col("size") >= F.col("head_bytes") + F.col("length"), F.lit(False)))
    block = F.expr("substring(cast(value AS binary), cast(head_bytes AS int) + 1, cast(length AS int))")
    df = df.withColumn("block", F.when(F.col("whole"), block))
    http = F.substring_index(F.col("block").cast("string"), GAP, 1)
    payload = F.when(F.startswith(F.lower("content"), F.lit("application/http")),
                     F.expr("substring(block, _http + 1)")).otherwise(F.col("block"))
    df = df.withColumn("_http", F.octet_length(http) + len(GAP)).withColumn("payload", payload)
    return df.withColumns(derive(F.col("payload"))).drop("value", "head", "block", "_http", "payload", "content")


def _leave(key: tuple, table: pa.Table) -> pa.Table:
    """For each candidate of one byte range, where its chain leaves the range; -1 if it breaks."""
    off, after = table["off"].to_numpy(), table["after"].to_numpy()
    order = np.argsort(off)
    off, after = off[order], after[order]
    end = int(table["range_end"][0].as_py())
    place = np.minimum(np.searchsorted(off, after), len(off) - 1)
    inside = off[place] == after
    to = np.where(inside, place, np.arange(len(off)))
    for _ in range(max(1, len(off).bit_length())):
        to = to[to]
    leave = np.where(after[to] >= end, after[to], -1)
    return pa.table({"file": table["file"], "range": table["range"], "off": pa.array(off),
                     "after": pa.array(after), "leave": pa.array(leave)})


def _walk(key: tuple, table: pa.Table) -> pa.Table:
    """Candidates of one byte range on the chain from its entry."""
    off, after = table["off"].to_numpy(), table["after"].to_numpy()
    entry = np.flatnonzero(table["entry"].to_numpy(zero_copy_only=False))
    found: list[int] = []
    if len(entry):
        where = {int(x): i for i, x in enumerate(off)}
        at = int(entry[0])
        while at is not None:
            found.append(at)
            nxt = int(after[at])
            at = where.get(nxt) if nxt > off[at] else None
    return table.select(["file", "range", "off"]).take(pa.array(found, pa.int64()))


def chained(candidates: DataFrame) -> DataFrame:
    """(file, range, off) of the candidates that the chain from offset 0 of their file reaches.

    candidates: file, range, range_end, off, after. A byte range is one group: its candidates are
    bounded by its bytes. Over the ranges of a file the number of rounds is the logarithm of their
    number, as the jumps double.
    """
    jumps = stored(candidates.groupBy("file", "range").applyInArrow(
        _leave, "file string, range bigint, off bigint, after bigint, leave bigint"), "jumps")
    reached = stored(jumps.where(F.col("off") == 0).select("file", "off"), "reached")
    n, hop = reached.count(), jumps.where("leave >= 0").select("file", "off", "leave")
    while n:
        more = reached.join(hop, ["file", "off"]).select("file", F.col("leave").alias("off"))
        # a jump that ends where no candidate is ends the chain
        more = more.join(jumps.select("file", "off"), ["file", "off"], "left_semi")
        reached = stored(reached.union(more).distinct(), "reached")
        new = reached.count()
        if new == n:
            break
        n = new
        again = hop.select("file", F.col("off").alias("leave"), F.col("leave").alias("far"))
        hop = stored(hop.join(again, ["file", "leave"]).select(
            "file", "off", F.col("far").alias("leave")), "hops")
    entries = reached.withColumn("entry", F.lit(True))
    return jumps.join(entries, ["file", "off"], "left").select(
        "file", "range", "off", "after", F.coalesce("entry", F.lit(False)).alias("entry")).groupBy(
            "file", "range").applyInArrow(_walk, "file string, range bigint, off bigint")


def read(spark: SparkSession, path: str, derive: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Records of the archives under a path: file, off, type, record_id, uri, refers_to, digest
    (of the header) and the columns that `derive` makes of the payload (binary).

    A record whose chain is broken before it is not returned, one cut off at the end of its file
    neither. The payload is the block, without its HTTP head if it is a HTTP message. An archive
    without records gives no rows.
    """
    step = len(MAGIC)
    pieces = _pieces(spark, path).withColumn("id", F.monotonically_increasing_id())
    pieces = pieces.withColumn("mark", F.sha1(F.col("value").cast("binary")))
    parsed = stored(_parsed(pieces, derive), "pieces")
    # where each piece starts: after the pieces and magics before it
    width = F.col("size") + step
    ranges = parsed.groupBy("file", "range").agg(F.sum(width).alias("bytes"))
    before = F.sum("bytes").over(W.partitionBy("file").orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    ranges = ranges.withColumn("base", F.coalesce(before, F.lit(0))).withColumn(
        "range_end", F.col("base") + F.col("bytes") - step)
    inside = W.partitionBy("file", "range").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
    placed = stored(parsed.withColumn("near", F.coalesce(F.sum(width).over(inside), F.lit(0)))
                    .join(ranges, ["file", "range"])
                    .withColumn("off", F.col("base") + F.col("near") - step), "placed")
    # the text before the first magic of a file is no candidate
    candidates = placed.where((F.col("off") >= 0) & F.col("length").isNotNull()).select(
        "file", "range", "range_end", "off",
        (F.col("off") + step + F.col("head_bytes") + F.col("length") + len(GAP)).alias("after"))
    good = stored(chained(candidates), "chain").withColumn("record", F.col("off"))
    owned = placed.join(good.select("file", "range", "off", "record"), ["file", "range", "off"], "left")
    fields = ["file", "off", "type", "record_id", "uri", "refers_to", "digest"]
    derived = [c for c in parsed.columns if c not in _parsed(pieces, lambda _: {}).columns]
    records = owned.where(F.col("record").isNotNull())
    alone = records.where("whole").select(*fields, *derived)
    if records.where(~F.col("whole")).isEmpty():
        return alone

    # pieces of records that hold the magic: those up to the next record
    last = F.last("record", ignorenulls=True)
    near = last.over(W.partitionBy("file", "range").orderBy("off"))
    ends = records.groupBy("file", "range").agg(F.max("record").alias("end"))
    carry = ranges.join(ends, ["file", "range"], "left").select("file", "range", F.last(
        "end", ignorenulls=True).over(W.partitionBy("file").orderBy("range").rowsBetween(
            W.unboundedPreceding, -1)).alias("carry"))
    parts = (owned.withColumn("near", near).join(carry, ["file", "range"])
             .withColumn("owner", F.coalesce("near", "carry")).where(F.col("off") >= 0))
    broken = records.where(~F.col("whole")).select("file", F.col("off").alias("owner"))
    parts = stored(parts.join(broken, ["file", "owner"], "left_semi").select(
        "file", "range", "owner", "off", "mark"), "parts")
    texts = _pieces(spark, path).withColumn("mark", F.sha1(F.col("value").cast("binary"))).join(
        parts.select("file", "range", "mark").distinct(), ["file", "range", "mark"], "left_semi")
    texts = texts.groupBy("file", "range", "mark").agg(F.first("value").alias("value"))
    joined = parts.join(texts, ["file", "range", "mark"]).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("off", "value"))).alias("all"))  # one record's pieces
    rebuilt = _parsed(joined.select("file", F.col("owner").alias("off"), F.array_join(
        F.transform("all", lambda x: x["value"]), MAGIC).alias("value")), derive)
    return alone.unionByName(rebuilt.where("whole").select(*fields, *derived))
