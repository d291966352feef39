import random

import pytest

from telmart.llm.components import components


def brute(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {x: root(x) for x in parent}


def found(spark, links):
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(rows) == len({row.node for row in rows})
    return {row.node: row.label for row in rows}


@pytest.mark.parametrize("nodes, links", [(200, 60), (200, 150), (60, 400)])
def test_random_links(spark, nodes, links):
    rnd = random.Random(nodes + links)
    pairs = [(rnd.randrange(nodes), rnd.randrange(nodes)) for _ in range(links)] * 2
    assert found(spark, pairs) == brute(pairs)


def test_long_paths_and_wide_stars(spark):
    order = list(range(100, 400))
    random.Random(1).shuffle(order)
    links = list(zip(order, order[1:])) + [(5, 1000 + i) for i in range(500)] + [(7, 7)]
    assert found(spark, links) == brute(links)


def test_no_links(spark):
    assert found(spark, []) == {}
