import random

from jobtide.llm.components import components


def plain(edges):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return sorted((x, top(x)) for x in up)


def test_chain_star_loops_and_random_links(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(60)]
    edges += [(2000 + draw.randrange(80), 2000 + draw.randrange(80)) for _ in range(50)]
    edges += [(3000, 3000), (40, 39), (9, 5000)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = [r for r in plain(edges) if r[0] not in {a for a, b in edges if a == b} or r[0] != r[1]
            or sum(r[0] in e and e[0] != e[1] for e in edges)]
    assert sorted(map(tuple, got)) == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
