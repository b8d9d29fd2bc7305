import random
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from jobtide.llm import catalog, repair, twins

KIND = "conv_id long, turn long, role string, text string, audit string, place string"


def least(codes, q, i=0):
    """Cost and letters of the least cheapest edits of rows i on, from state q."""
    @lru_cache(None)
    def best(i, q, inserted):
        out = [(0, "")] if i == len(codes) and q in (0, 3) else []
        goes = {0: 2, 1: 2, 2: 3, 3: 2}[q]
        if inserted < 2:
            c, x = best(i, goes, inserted + 1)
            out.append((c + 3, "I" + x))
        if i < len(codes):
            code = codes[i]
            late, kind = 3 * (4 <= code < 8), code % 4
            c, x = best(i + 1, q, 0)
            out.append((c + 4, "D" + x))
            if code != 8:
                to = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}.get((q, kind))
                if to:
                    c, x = best(i + 1, to, 0)
                    out.append((c + late, "K" + x))
                c, x = best(i + 1, goes, 0)
                out.append((c + late + 3, "R" + x))
        return min(out, default=(10 ** 6, ""))
    return best(i, q, 0)


def test_auction_against_all_paths():
    rng = random.Random(1)
    codes = [[rng.choice([0, 1, 1, 2, 2, 3, 5, 6, 8]) for _ in range(rng.randrange(1, 14))] for _ in range(400)]
    start = np.array([rng.randrange(4) for _ in codes])
    ends = np.tile(repair.CLOSING, (len(codes), 1))
    cost, letters, last = repair._solve(
        ["".join(map(str, c)).encode() for c in codes], start, ends, np.ones((len(codes), 4), bool))
    for c, q, n, x, s in zip(codes, start.tolist(), cost, letters, last):
        assert (n, x + {1: "II", 2: "I"}.get(s, "")) == least(tuple(c), q)


def test_states_that_cannot_be_reached():
    into = repair._REACH[[1, 1]]
    ends = np.where(np.arange(4) == 1, 0, repair.NONE)[None].repeat(2, 0)
    cost, _, _ = repair._solve([b"1182", b"1082"], np.array([0, 0]), ends, into)
    assert cost[0] == repair.NONE and cost[1] == 12


def conversations(seed):
    rng = random.Random(seed)
    role = lambda: rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None, "u\n"])
    text = lambda: rng.choice([None, "", " \n", "Yes.", "no", "Why? ", "a.\n\n", "é!", f"t{rng.random()}."])
    rows = []
    for conv in [None, *range(40)]:
        n = rng.choice([1, 1, 2, 3, 6, 9])
        rows += [(conv, rng.choice([None, t, t, t, t, t, 2 * t]), role(), text(), "x", "y") for t in range(n)]
    for conv, n in ((100, 33), (101, 64), (102, 200)):
        rows += [(conv, t, role(), text(), "x", "y") for t in range(n)]
    rows += [(103, 0, "user", "Same.", "x", "y")] * 70 + [(104, t, "user", "x" * 30000, "x", "y") for t in range(3)]
    return rows


@pytest.mark.parametrize("rows", [conversations(2), [], conversations(3)[:1]], ids=["many", "none", "one"])
def test_repair_against_sql(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, KIND)
    (tmp_path / "t").mkdir()
    df.write.parquet(str(tmp_path / "t" / "conversations.parquet"))
    got = catalog.op12_conversation_repair(spark, str(tmp_path / "t"))
    con = duckdb.connect()
    con.register("conversations", pa.Table.from_pandas(df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"})) if rows
                 else df.toArrow())
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({twins.conversation_repair()})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
