import hashlib
import random

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from jobtide.llm import catalog, chat, twins

KIND = "conv_id long, turn long, role string, text string, branch string, start string, key string"
BITS = ["\\", "<s>", "</s>", "[INST]", "[/INST]", "<", "[", "s>", "\\<s>", "<\\s>", "é", "\n", "/INST]", ""]


def conversations(seed):
    """Conversations that share beginnings: many one, some more, one very long, odd rows."""
    rng = random.Random(seed)
    text = lambda: "".join(rng.choices(BITS, k=rng.randrange(5)))
    rows = []
    for conv in [None, *range(60)]:
        same = rng.random() < 0.6
        for t in range(rng.choice([1, 2, 3, 5])):
            role = "assistant" if t % 2 else "user"
            few = f"turn {t} {rng.randrange(1 + t)}" if same else text()
            rows.append((conv, rng.choice([t] * 9 + [None]), rng.choice([role] * 9 + [None]), rng.choice([few] * 9 + [None])))
    rows += [(200, t, "user", "turn 0 0" if t == 0 else f"{t}") for t in range(3000)]
    rows += [(201, 5, "assistant", "x<s>" * 9000)] * 3 + [(c, 0, "user", "turn 0 0") for c in (202, 203)]
    return [(*r, "b", "s", "k") for r in rows]


def formatted(role, text):
    def escape(x):
        x = x.replace("\\", "\\\\")
        for c in chat.CONTROLS:
            x = x.replace(c, c[0] + "\\" + c[1:])
        return x
    return f"<s>{escape(role or '')}[INST]{escape(text or '')}[/INST]</s>"


def ways(rows):
    """Formatted turns of each conversation, in order."""
    out = {}
    mark = lambda r: hashlib.md5(f"{r[2] or ''}\n{r[3] or ''}".encode()).hexdigest()
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, mark(r))):
        out.setdefault(r[0], []).append(formatted(r[2], r[3]))
    return out


def test_the_stream_is_a_prefix_tree_told_depth_first(spark):
    rows = conversations(1)
    want = ways(rows)
    stream, index = chat.pack(spark.createDataFrame(rows, KIND))
    nodes, found = stream.orderBy("start").collect(), index.collect()
    said = "".join(r.said for r in nodes)
    at = 0
    for r in nodes:
        assert (r.start, r.length) == (at, len(r.said))
        at += r.length
    # every beginning once
    starts = {tuple(w[:n]) for w in want.values() for n in range(1, len(w) + 1) if len(w) < 1000}
    assert len(nodes) == len(starts | {tuple(want[200][:1])}) + 2999
    # what a conversation is read from
    assert {r.conv_id for r in found} == set(want)
    for r in found:
        assert "".join(said[s["from"]:s["to"]] for s in r.spans) == "".join(want[r.conv_id])
        assert r.turns == len(want[r.conv_id]) and r.chars == sum(map(len, want[r.conv_id]))
    assert max(len(r.spans) for r in found) <= 8
    # each node looks at the turns before it, which end where it is
    seen = {r.start: "".join(said[s["from"]:s["to"]] for s in r.attends) for r in nodes}
    begun = {"".join(w[:n]) for w in want.values() for n in range(len(w))}
    assert all(len(seen[r.start]) == r.position and seen[r.start] in begun for r in nodes)
    # depth first: the way of a node begins with that of the node before it, or leaves it
    last = ""
    for r in nodes:
        assert last.startswith(seen[r.start])
        last = seen[r.start] + r.said
    for r in nodes:
        if r.loss_from is not None:
            assert chat.TURN.fullmatch(r.said).group(2) == r.said[r.loss_from:r.loss_to]


def test_read_back_against_sql(spark, tmp_path):
    for name, rows in (("many", conversations(2)), ("none", [])):
        df = spark.createDataFrame(rows, KIND)
        (tmp_path / name).mkdir()
        df.write.parquet(str(tmp_path / name / "conversations.parquet"))
        got = catalog.op13_chat_format(spark, str(tmp_path / name))
        con = duckdb.connect()
        con.register("conversations", pa.Table.from_pandas(
            df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"})) if rows else df.toArrow())
        want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({twins.chat_format()})").fetchall()
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_escapes_are_reversible(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(BITS, k=rng.randrange(9))) for _ in range(3000)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escaped(F.col("t")).alias("e"), chat.formatted(F.col("t"), F.col("t")).alias("f")).collect()
    for r in got:
        assert chat.unescaped(r.e) == r.t and not any(c in r.e for c in chat.CONTROLS)
        assert chat.TURN.fullmatch(r.f).groups() == (r.e, r.e)


def test_nothing_to_format(spark):
    stream, index = chat.pack(spark.createDataFrame([], KIND))
    assert stream.isEmpty() and index.isEmpty() and chat.read_back(stream, index).isEmpty()
