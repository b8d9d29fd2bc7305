"""Repair of the turn structure of conversations by the cheapest edits.

The rows of a conversation and the states of `(s?(ua)+)?` span a lattice: node (i, q) stands for i
rows used up and state q, its arcs are edits. A shortest path comes from an auction: the path grows
by the cheapest arc at the prices of the nodes, and where it cannot, its last node's price rises to
what its arcs ask and the path shrinks by that node. At the end prices and path are tight, and since
arcs of equal price are taken in the order of their letters, the path is the least of all cheapest.

A conversation is cut into blocks of BLOCK rows, which are auctioned side by side: first for the
costs between the states at a block's two ends, from which the prices at its end follow from the last
block to the first, then for the path at these prices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import stored
from jobtide.llm.order import folded, scanned

BLOCK = 32
SPACES = " \t\n\x0b\x0c\r"
LETTERS = "DIKR"  # delete, insert, keep, rerole: in the order of their characters
DELETE, INSERT, REROLE, OPEN = 4, 3, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])  # what an inserted or reroled row leads to
CLOSING = [0, 2 * INSERT, INSERT, 0]  # from each state to a proper end, without more rows
NONE = 1 << 28
AT_ONCE = 4096
_REACH = np.array([  # states from which each state can be reached
    [1, 0, 0, 0], [1, 1, 0, 0], [1, 1, 1, 1], [1, 1, 1, 1]], bool)


def lattice(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray, into: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs and targets of the arcs of (problem, node, letter). `codes` has a class for each row: 0 to
    3 system, user, assistant, other; 4 more if left open; 8 if it must go. `ends` are the prices at
    the last row, `into` the states that may be entered. The last node is the end of all."""
    m, n = codes.shape
    end = 4 * (n + 1)
    cost = np.full((m, end + 1, 4), NONE, np.int32)
    to = np.full((m, end + 1, 4), end, np.int32)
    rows = np.arange(n)
    must, opened, kind = codes == 8, (codes >= 4) & (codes < 8), codes % 4
    real = rows < sizes[:, None]
    for q in range(4):
        at = 4 * rows + q
        step = 4 * (rows + 1)
        cost[:, at, 0], to[:, at, 0] = DELETE, step + q
        cost[:, at, 1], to[:, at, 1] = INSERT, 4 * rows + NEXT[q]
        fits = {START: (kind == 0) | (kind == 1), USER: kind == 2}.get(q, kind == 1)
        cost[:, at, 2] = np.where(fits & ~must, OPEN * opened, NONE)
        to[:, at, 2] = step + kind % 3 + 1
        cost[:, at, 3] = np.where(must, NONE, REROLE + OPEN * opened)
        to[:, at, 3] = step + NEXT[q]
        cost[:, at] = np.where(real[:, :, None], cost[:, at], NONE)
    cost[~into[np.arange(m)[:, None, None], to % 4] & (to < end)] = NONE
    last = 4 * sizes[:, None] + np.arange(4)
    each = np.arange(m)[:, None]
    cost[each, last], to[each, last] = NONE, end
    cost[each, last, 0] = ends
    return cost, to


def auction(cost: np.ndarray, to: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Cost, letters and next to last node of the least shortest path of each problem from its start
    to the last node. Where there is none, the cost is NONE."""
    m, nodes, _ = cost.shape
    price = np.zeros((m, nodes), np.int32)
    path = np.zeros((m, nodes + 1), np.int32)
    taken = np.zeros((m, nodes + 1), np.uint8)
    depth, top, live = np.zeros(m, np.int64), start.astype(np.int64), np.arange(m)
    path[:, 0] = top
    while len(live):
        at, deep = top[live], depth[live]
        asked = cost[live, at] + price[live[:, None], to[live, at]]
        letter = asked.argmin(1)
        best = np.minimum(asked[np.arange(len(live)), letter], NONE)
        rise = best > price[live, at]
        price[live[rise], at[rise]] = best[rise]
        # contract
        back = live[rise & (deep > 0)]
        depth[back] -= 1
        top[back] = path[back, depth[back]]
        # extend
        on = live[~rise]
        taken[on, depth[on]] = letter[~rise]
        depth[on] += 1
        top[on] = to[on, at[~rise], letter[~rise]]
        path[on, depth[on]] = top[on]
        lost = rise & (deep == 0) & (best >= NONE)
        live = live[~lost & (top[live] != nodes - 1)]
    name = np.frombuffer(LETTERS.encode(), np.uint8)
    letters = [name[taken[k, :max(0, depth[k] - 1)]].tobytes().decode() for k in range(m)]
    return price[np.arange(m), start], letters, path[np.arange(m), np.maximum(depth - 1, 0)]


def _solve(codes: list[bytes], start: np.ndarray, ends: np.ndarray, into: np.ndarray) -> tuple[list, list, list]:
    """Costs, letters and states at the end of blocks."""
    cost, letters, last = [], [], []
    order = sorted(range(len(codes)), key=lambda k: len(codes[k]))
    for i in range(0, len(order), AT_ONCE):
        part = order[i:i + AT_ONCE]
        sizes = np.array([len(codes[k]) for k in part])
        grid = np.full((len(part), int(sizes.max())), 8, np.int8)
        for j, k in enumerate(part):
            grid[j, :sizes[j]] = np.frombuffer(codes[k], np.uint8) - 48
        c, x, node = auction(*lattice(grid, sizes, ends[part], into[part]), start[part])
        cost += c.tolist()
        letters += x
        last += (node % 4).tolist()
    back = np.argsort(order)
    return [[v[k] for k in back] for v in (cost, letters, last)]


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs from each state at the first row of a block to each state after its last."""
    for b in batches:
        codes = [c.encode() for c in b.column("codes").to_pylist()]
        pairs = [(q, r) for q in range(4) for r in range(4) if _REACH[r, q]]
        start = np.tile([q for q, _ in pairs], len(codes))
        goal = np.tile([r for _, r in pairs], len(codes))
        ends = np.where(np.arange(4) == goal[:, None], 0, NONE)
        found, _, _ = _solve([c for c in codes for _ in pairs], start, ends, _REACH[goal])
        table = np.full((len(codes), 4, 4), NONE)
        table[np.repeat(np.arange(len(codes)), len(pairs)), start, goal] = found
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("block"), pa.array(table.reshape(-1, 16).tolist(), pa.list_(pa.int64()))],
            ["conv_id", "block", "costs"])


def _prices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prices after the last row of each block; blocks come last first, conversation by conversation."""
    now, price, some = None, None, False
    for b in batches:
        out = []
        for conv, costs in zip(b.column("conv_id").to_pylist(), b.column("costs").to_pylist()):
            if not some or conv != now:
                now, price, some = conv, np.array(CLOSING), True
            out.append(price.tolist())
            price = np.minimum((np.array(costs).reshape(4, 4) + price).min(1), NONE)
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("block"), pa.array(out, pa.list_(pa.int64()))],
            ["conv_id", "block", "prices"])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least path through each block from each state that it may be entered in: letters and the state
    at the end by state at the start, and the cost from the start state to the conversation's end."""
    for b in batches:
        codes = [c.encode() for c in b.column("codes").to_pylist()]
        prices = np.array(b.column("prices").to_pylist()).reshape(-1, 4)
        block = b.column("block").to_pylist()
        asks = [(k, q) for k in range(len(codes)) for q in (range(4) if block[k] else [START])]
        of, start = np.array([k for k, _ in asks], np.int64), np.array([q for _, q in asks], np.int64)
        cost, letters, last = _solve([codes[k] for k in of], start, prices[of], np.ones((len(of), 4), bool))
        audits, states, costs = [[""] * 4 for _ in codes], [[0] * 4 for _ in codes], [0] * len(codes)
        for (k, q), x, s, c in zip(asks, letters, last, cost):
            audits[k][q], states[k][q] = x, s
            if q == START:
                costs[k] = c
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("block"), pa.array(audits, pa.list_(pa.string())),
             pa.array(states, pa.list_(pa.int32())), pa.array(costs, pa.int64())],
            ["conv_id", "block", "audits", "states", "cost"])


def _joined() -> Callable:
    """Letters and cost of a whole conversation from its blocks in order."""
    state, out, cost = START, [], 0

    def work(rows: dict | None, start: int, end: int) -> tuple | None:
        nonlocal state, cost
        if rows is None:
            return "".join(out) + {SYSTEM: "II", USER: "I"}.get(state, ""), cost
        if not out:
            cost = rows["cost"][start]
        for audits, states in zip(rows["audits"][start:end], rows["states"][start:end]):
            out.append(audits[state])
            state = states[state]
        return None

    return work


def names(audit: str) -> Iterator[str]:
    """Roles, in order, of the rows that an audit leaves."""
    n = len(audit) - audit.count("D")
    if n % 2:
        yield "system"
    for _ in range(n // 2):
        yield "user"
        yield "assistant"


def _repaired() -> Callable:
    """Digest of the repaired `role:text` lines from an audit, which comes first, and the rows."""
    state = hashlib.sha256()
    audit, roles, at, some = "", iter(()), 0, False

    def say(role: str, text: str) -> None:
        nonlocal some
        state.update(f"{chr(10) if some else ''}{role}:{text}".encode())
        some = True

    def inserts() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            say(next(roles), "")
            at += 1

    def work(rows: dict | None, start: int, end: int) -> tuple | None:
        nonlocal audit, roles, at
        if rows is None:
            inserts()
            return (state.hexdigest(),)
        for i in range(start, end):
            if rows["audit"][i] is not None:
                audit, roles = rows["audit"][i], names(rows["audit"][i])
                continue
            inserts()
            letter, at = audit[at], at + 1
            if letter != "D":
                role = next(roles)
                say(role if letter == "R" else rows["role"][i], rows["text"][i])
        return None

    return work


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with planted faults: by a hash of conversation and turn, one in
    twenty each goes, loses its text, loses its sentence ends, comes twice or becomes the user's.
    Null fields are one space, but conv_id and turn stay null."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    drawn = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), draw.alias("_draw"))
    copies = F.when(F.col("_draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return drawn.where("_draw <> 0").select(
        "conv_id", "turn", F.when(F.col("_draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _marked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("mark", F.sha2(F.col("text").cast("binary"), 256))


def faults(rows: DataFrame) -> DataFrame:
    """Each row's place in its conversation, the class of its role (0 to 3: system, user, assistant,
    other, by the first letter) and its first fault: conv_id, turn, place, kind, fault ('blank',
    'duplicate', 'truncated' or null).

    Rows go by turn, nulls first, then by role and by the digest of the text. A row is a duplicate if
    role and text were seen before in its conversation.
    """
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    narrow = _marked(rows).select(
        "conv_id", "turn", "role", "mark", (end == "").alias("blank"), end.isin(".", "!", "?").alias("ended"))
    laid = scanned(narrow, ["conv_id"], ["turn", "role", "mark"], "turns", {"place": F.lit(1)})
    again = laid.groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("mark").alias("_mark")).agg(
        F.min("place").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    met = laid.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
                    & (F.col("mark") == F.col("_mark")), "left")
    initial = F.left("role", F.lit(1))
    fault = F.when(F.col("blank"), "blank").when(F.col("place") > F.col("_first"), "duplicate").when(
        ~F.col("ended"), "truncated")
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return stored(met.select("conv_id", "turn", "place", kind.alias("kind"), fault.alias("fault")), "faults")


def audits(found: DataFrame) -> DataFrame:
    """Cheapest edits of each conversation of `faults`, as letters, and their cost: conv_id, audit, cost."""
    code = F.when(F.col("fault").isin("blank", "duplicate"), 8).when(
        F.col("fault") == "truncated", F.col("kind") + 4).otherwise(F.col("kind"))
    blocks = found.withColumn("block", F.floor(F.col("place") / BLOCK)).groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("place", code.cast("string").alias("code")))).alias("rows"))
    blocks = stored(blocks.select("conv_id", "block", F.array_join("rows.code", "").alias("codes")), "blocks")
    long_ = blocks.where("block > 0").select(F.col("conv_id").alias("_conv")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    kind = found.schema["conv_id"].dataType.simpleString()
    costs = blocks.join(long_, same, "left_semi").mapInArrow(_costs, f"conv_id {kind}, block long, costs array<long>")
    prices = costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block")).mapInArrow(
        _prices, f"conv_id {kind}, block long, prices array<long>")
    priced = prices.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "prices")
    met = blocks.join(priced, same & (F.col("block") == F.col("_block")), "left").select(
        "conv_id", "block", "codes", F.coalesce("prices", F.array(*map(F.lit, CLOSING)).cast("array<long>")).alias("prices"))
    paths = met.mapInArrow(_paths, f"conv_id {kind}, block long, audits array<string>, states array<int>, cost long")
    return stored(folded(paths, "conv_id", ["block"], _joined, "audit string, cost long"), "audits")


def misfits(found: DataFrame) -> DataFrame:
    """Neighbouring rows that are not system-user, user-assistant or assistant-user, by conversation.
    A row meets the one before it in a grouping by place, so that a conversation is never one group."""
    here = found.select("conv_id", "place", (F.col("kind") * 10).alias("pair"), F.lit(True).alias("first"))
    there = found.where("place > 0").select("conv_id", (F.col("place") - 1).alias("place"),
                                            F.col("kind").alias("pair"), F.lit(False).alias("first"))
    pairs = here.unionByName(there).groupBy("conv_id", "place").agg(
        F.sum("pair").alias("pair"), F.count("*").alias("n")).where("n = 2")
    return pairs.where(~F.col("pair").isin(1, 12, 21)).groupBy("conv_id").agg(F.count("*").alias("illegal"))


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired rows of each conversation: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `rows` has conv_id, turn, role and text, without nulls in the last two; other columns are left.
    Order and faults are as in `faults`; rows of a null conv_id are one conversation. `audit` has a
    letter for each edit: K keeps a row, R gives it the role that its place asks for, D deletes it, I
    inserts one without text. The digest is of the repaired `role:text` lines, joined by a line feed.
    """
    found = faults(rows)
    made = audits(found)
    count = lambda x: F.count(F.when(F.col("fault") == x, 1)).alias(x)
    counted = found.groupBy("conv_id").agg(*map(count, ("blank", "duplicate", "truncated")))
    turns = found.where("turn is not null").groupBy("conv_id", "turn").agg(F.count("*").alias("n")).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    lines = _marked(rows).select("conv_id", F.lit(1).alias("part"), "turn", "role", "mark", "text", F.lit(None).cast(
        "string").alias("audit"))
    void = F.lit(None)
    first = made.select("conv_id", F.lit(0).alias("part"), void.cast(rows.schema["turn"].dataType).alias("turn"),
                        void.cast("string").alias("role"), void.cast("string").alias("mark"),
                        void.cast("string").alias("text"), "audit")
    digests = folded(first.unionByName(lines), "conv_id", ["part", "turn", "role", "mark"], _repaired,
                     "repaired_sha256 string")
    out = counted
    for part in (turns, misfits(found), made, digests):
        names_ = [c for c in part.columns if c != "conv_id"]
        out = out.join(part.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")),
                       "left").select(*out.columns, *names_)
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], "audit", "repaired_sha256")
