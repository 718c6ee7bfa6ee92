import random

import pytest

from tierline.llm.components import components


def brute(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return sorted((x, find(x)) for x in up)


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(None, 2)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)],
    [(2 * i, 2 * i + 1) for i in range(50)], [(-5, 3), (3, 9), (9, -7)], [(1, 2), (2, 1), (1, 2)]])
def test_shapes(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    assert sorted(map(tuple, components(df).collect())) == brute(edges)


def test_random(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(600), rng.randrange(600)) for _ in range(450)]
    assert sorted(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect())) == brute(edges)
