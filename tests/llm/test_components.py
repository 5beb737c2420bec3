"""Components against a union-find over all edges."""

import random

import pytest

import llm.components as components


@pytest.mark.parametrize("seed, slice_size", [(1, 100_000), (2, 3), (3, 1)])
def test_equals_union_find(spark, monkeypatch, seed, slice_size):
    monkeypatch.setattr(components, "EDGES_AT_ONCE", slice_size)
    r = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 300), r.randrange(100, 300)) for _ in range(120)]
    edges += [(400, n) for n in range(401, 460)] + [(5, 5), (None, 3), (7, None)] + edges[:5]
    r.shuffle(edges)
    parent = list(range(500))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()
    assert sorted(tuple(x) for x in got) == [(n, root(n)) for n in range(500) if root(n) != n]


def test_no_edges(spark):
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
