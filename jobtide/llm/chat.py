"""Formatting of conversations as one prefix tree, in which turns that conversations share from their
start on are said once.

A node of the tree is a turn after the same turns before it, known by its place and digests over all
turns up to it. Every node belongs to one of the conversations through it, that of the least digest
of its id, so that a conversation owns the end of its way, its branch, and passes few other branches:
about as many as the logarithm of the number of conversations, wherever they part. Branches are told
depth first: a branch, then those that leave it, the last to leave first. The stream is the text of
all nodes in this order; a branch is one stretch of it, and what a node may look at is one stretch of
each branch on its way.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import stored
from jobtide.llm.order import folded, scanned

# a turn is <s>role[INST]text[/INST]</s>
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]"]
TURN = re.compile(r"<s>(.*?)\[INST\](.*)\[/INST\]</s>", re.DOTALL)
ASSISTANT = "assistant"
_SPAN = "struct<position:bigint,from:bigint,to:bigint,branch:string,first:bigint,last:bigint>"
_RUN = 1024
_DEPTH = 15  # hexadecimal digits of a place


def escaped(text: Column) -> Column:
    """Double every backslash, then put one after the first sign of every control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        text = F.replace(text, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return text


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def formatted(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<s>"), escaped(role), F.lit("[INST]"), escaped(text), F.lit("[/INST]</s>"))


def _marked(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, mark): nulls of role and text are empty, mark is their digest."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text")).withColumn(
        "mark", F.md5(F.concat("role", F.lit("\n"), "text").cast("binary")))


def _ways(rows: DataFrame) -> DataFrame:
    """A row for each turn: conv_id, key (digest of it), place, mark, position and length in signs,
    and the digest of all turns up to it (h, with place)."""
    size = F.char_length(formatted(F.col("role"), F.col("text"))).cast("long")
    narrow = rows.select("conv_id", "turn", "mark", size.alias("length"))
    laid = scanned(narrow, ["conv_id"], ["turn", "mark"], "turns", {"place": F.lit(1)}).drop("turn")
    hashes = [F.xxhash64(F.lit(j), "place", "mark") for j in range(2)]
    laid = scanned(laid.withColumns({"h0": hashes[0], "h1": hashes[1]}), ["conv_id"], ["place"], "ways",
                   {"position": F.col("length")}, {"p0": F.col("h0"), "p1": F.col("h1")})
    key = F.md5(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")).cast("binary"))
    up = lambda j: F.col(f"p{j}").bitwiseXOR(F.col(f"h{j}"))
    return laid.select("conv_id", key.alias("key"), "place", "mark", "position", "length",
                       F.struct("place", up(0).alias("a"), up(1).alias("b")).alias("node"))


def _branches(ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Owned turns (branch, place, mark, position, length), and a row for each conversation: where it
    leaves the branch before its own (up, last, cut: branch, place and position) and what it has."""
    owners = ways.groupBy("node").agg(F.min("key").alias("branch"))
    met = stored(ways.join(owners, "node").drop("node"), "owned")
    other = F.col("branch") != F.col("key")
    far = F.max(F.when(other, F.struct("place", "branch", (F.col("position") + F.col("length")).alias("cut"))))
    convs = met.groupBy("key").agg(
        F.any_value("conv_id").alias("conv_id"), F.count("*").alias("turns"), F.sum("length").alias("chars"),
        far.alias("far"))
    convs = convs.select(
        "key", "conv_id", "turns", "chars", F.col("far.branch").alias("up"),
        F.coalesce("far.place", F.lit(-1)).cast("long").alias("last"), F.coalesce("far.cut", F.lit(0)).cast("long").alias("cut"))
    return met.where(~other).select("branch", "place", "mark", "position", "length"), stored(convs, "convs")


def _ordered(convs: DataFrame) -> DataFrame:
    """Each conversation with its branches from the root (`way`), where its own starts in the stream
    (`start`, null without one), in the order of a key that grows along the way (`path`)."""
    own = F.col("turns") > F.col("last") + 1
    turned = F.lpad(F.hex(F.lit((1 << 4 * _DEPTH) - 2) - F.col("last")), _DEPTH, "0")
    named = convs.withColumns({"own": own, "name": F.concat(turned, "key")})
    step = F.struct(F.col("up").alias("branch"), "last", "cut")
    now = named.where("up is null").withColumns({
        "path": F.col("name"), "way": F.array().cast("array<struct<branch:string,last:bigint,cut:bigint>>")})
    rest, found = named.where("up is not null"), None
    while True:
        now = stored(now, "branches")
        found = now if found is None else found.unionByName(now)
        above = now.where("own").select(F.col("key").alias("up"), F.col("path").alias("_path"), F.col("way").alias("_way"))
        now = rest.join(above, "up").withColumns({
            "path": F.concat("_path", "name"), "way": F.concat("_way", F.array(step))}).select(now.columns)
        if above.isEmpty():
            break
    length = F.when(F.col("own"), F.col("chars") - F.col("cut")).otherwise(0)
    return stored(scanned(found, [], ["path"], "stream", {"start": length}), "starts")


def pack(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stream and its index, both stored.

    `rows` has conv_id, turn, role and text; other columns are left. Turns go by turn, nulls first,
    then by the digest of role and text; rows of a null conv_id are one conversation; a null role or
    text is empty. The stream, sorted by `start`, has a row for each node: start and length in the
    stream, position in its conversation, branch and place, `said` (the formatted turn), the signs of
    `said` that are learned from (loss_from, loss_to; an assistant's text), and `attends`, the stretches of
    the stream before it on its way. The index has for each conversation turns, chars and the spans of the
    stream that it is read from.
    """
    marked = _marked(rows)
    owned, convs = _branches(_ways(marked))
    placed = _ordered(convs)
    starts = placed.where("own").select(
        F.col("key").alias("branch"), "start", F.col("cut").alias("base"), (F.col("last") + 1).alias("first"))
    steps = placed.select("key", F.explode("way").alias("_s")).select("key", "_s.*").join(starts, "branch")
    span = F.struct(
        F.col("base").alias("position"), F.col("start").alias("from"),
        (F.col("start") + F.col("cut") - F.col("base")).alias("to"), "branch", "first", "last")
    spans = steps.groupBy("key").agg(F.array_sort(F.collect_list(span)).cast(f"array<{_SPAN}>").alias("spans"))
    known = stored(placed.join(spans, "key", "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast(f"array<{_SPAN}>"))), "spans")
    mine = F.array(F.struct(
        F.col("cut").alias("position"), F.col("start").alias("from"), (F.col("start") + F.col("chars") - F.col("cut")).alias("to"),
        F.col("key").alias("branch"), (F.col("last") + 1).alias("first"), (F.col("turns") - 1).alias("last"))).cast(f"array<{_SPAN}>")
    index = known.select("conv_id", "turns", "chars", F.when(F.col("own"), F.concat("spans", mine)).otherwise(
        F.col("spans")).alias("spans"))
    branches = known.where("own").select(F.col("key").alias("branch"), "start", "cut", "spans")
    texts = marked.groupBy("mark").agg(F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    nodes = owned.join(branches, "branch").join(texts, "mark")
    at = F.col("start") + F.col("position") - F.col("cut")
    spoken = F.char_length(F.concat(F.lit("<s>"), escaped(F.col("role")), F.lit("[INST]")))
    learned = F.when(F.col("role") == ASSISTANT, spoken)
    here = F.array(F.struct(F.col("start").alias("from"), at.alias("to")))
    attends = F.filter(F.concat(F.transform("spans", lambda s: F.struct(s["from"].alias("from"), s["to"].alias("to"))), here),
                       lambda s: s["from"] < s["to"])
    stream = nodes.select(
        at.alias("start"), "length", "position", "branch", "place", formatted(F.col("role"), F.col("text")).alias("said"),
        learned.alias("loss_from"), (learned + F.char_length(escaped(F.col("text")))).alias("loss_to"),
        attends.alias("attends"))
    ordered = stream.repartitionByRange("start").sortWithinPartitions("start")
    return stored(ordered, "packed"), stored(index, "index")


def _reader() -> Callable:
    """Turns and learned text of one conversation from its formatted turns."""
    turns, loss = hashlib.sha256(), hashlib.sha256()
    n = learned = chars = 0

    def work(rows: dict | None, start: int, end: int) -> tuple | None:
        nonlocal n, learned, chars
        if rows is None:
            return n, turns.hexdigest(), learned, loss.hexdigest(), chars
        for i in range(start, end):
            said = rows["said"][i]
            role, text = map(unescaped, TURN.fullmatch(said).groups())
            turns.update(f"{role}\n{text}\n".encode())
            n, chars = n + 1, chars + len(said)
            if rows["loss_from"][i] is not None:
                part = unescaped(said[rows["loss_from"][i]:rows["loss_to"][i]])
                loss.update(part.encode())
                learned += len(part)
        return None

    return work


def read_back(stream: DataFrame, index: DataFrame) -> DataFrame:
    """What the stream says of each conversation, in its turns and under the loss mask: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    spans = index.select("conv_id", F.explode("spans").alias("_s")).select("conv_id", "_s.*")
    runs = spans.withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("last") - F.col("first")) / _RUN))))
    low = F.col("first") + F.col("_run") * _RUN
    asked = runs.select("conv_id", "branch", F.explode(F.sequence(low, F.least(low + _RUN - 1, F.col("last")))).alias("place"))
    met = asked.join(stream.select("branch", "place", "said", "loss_from", "loss_to"), ["branch", "place"])
    return folded(met.drop("branch"), "conv_id", ["place"], _reader,
                  "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
