"""Connected components against union-find."""

import random

from rolemill.llm.components import connected_components


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(f"n{rng.randrange(60):02}", f"n{rng.randrange(60):02}") for _ in range(45)] + [("chain%02d" % i, "chain%02d" % (i + 1)) for i in range(30)] + [("z", "z"), (None, "y")]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a and b and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = dict(connected_components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect())
    assert got == {x: find(x) for x in parent}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0
