"""Connected components against union-find."""

import random

import pytest

from kestrel.llm.components import components


def union_find(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


CHAIN = [(i, i + 1) for i in range(40)]
STAR = [(5, i) for i in range(60) if i != 5]


@pytest.mark.parametrize("edges", [
    [], [(3, 3)], [(1, 2), (2, 1), (1, 2)], CHAIN, [(b, a) for a, b in reversed(CHAIN)], STAR, STAR + [(100 + a, 100 + b) for a, b in CHAIN],
    [(random.Random(1).randrange(60), random.Random(i).randrange(60)) for i in range(30)], [(-(1 << 62), 1 << 62), (1 << 62, 0)]])
def test_against_union_find(spark, edges):
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = union_find([e for e in edges if e[0] != e[1]])
    assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)
