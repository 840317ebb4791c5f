import random

import pytest

from stellate.llm.graph import connected_components


def union_find(edges):
    parent: dict[int, int] = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(parent)}


RNG = random.Random(1)
SHAPES = {
    "path": [(i, i + 1) for i in range(60)],
    "star": [(0, i) for i in range(1, 200)],
    "star around the largest": [(999, i) for i in range(100)],
    "random": [(RNG.randrange(200), RNG.randrange(200)) for _ in range(140)],
    "negative ids, repeats and loops": [(-5, 3), (3, 7), (3, 7), (7, 3), (4, 4)],
    "none": [],
}


@pytest.mark.parametrize("name", SHAPES)
def test_components(spark, name):
    edges = SHAPES[name]
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = union_find([e for e in edges if e[0] != e[1]])
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
