"""Spanning tree and single-linkage cuts against Kruskal's method."""

from __future__ import annotations

import numpy as np
import pytest

from tickloom.operators import relationships as rel

SCHEMA = "instrument_i string, instrument_j string, distance double"


def kruskal(edges, nodes, most=None):
    """Tree edges and the cluster of every node after the first ``most`` merges."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    tree = []
    for d, a, b in sorted((d, *sorted((a, b))) for a, b, d in edges if d is not None and a != b):
        x, y = find(a), find(b)
        if x != y and (most is None or len(tree) < most):
            root[max(x, y)] = min(x, y)
            tree.append((a, b, d))
    return set(tree), {n: find(n) for n in nodes}


def graph(kind: str):
    rng = np.random.default_rng(3)
    names = [f"i{k:03d}" for k in range(120)]
    if kind == "path":  # weights that grow along the path make one long chain of choices
        return names, [(names[k], names[k + 1], float(k)) for k in range(119)]
    if kind == "ties":
        picks = rng.integers(0, 120, (900, 2))
        return names, [(names[a], names[b], float(rng.integers(0, 4))) for a, b in picks]
    picks = rng.integers(0, 60, (200, 2)) + 60 * rng.integers(0, 2, (200, 1))
    rows = [(names[a], names[b], float(rng.random())) for a, b in picks]
    return names, [*rows, (names[0], names[1], None)]


@pytest.mark.parametrize("kind", ["path", "ties", "parts"])
def test_tree_and_cuts_equal_kruskal(spark, kind):
    names, rows = graph(kind)
    nodes = spark.createDataFrame([(n,) for n in names], "instrument string")
    want, whole = kruskal(rows, names)
    tree = rel.spanning_tree(spark.createDataFrame(rows, SCHEMA))
    assert {tuple(r) for r in tree.collect()} == want
    parts = len(set(whole.values()))
    for k in (1, parts + 5):
        _, clusters = kruskal(rows, names, len(names) - max(k, parts))
        cut = {r.instrument: r.cluster for r in rel.cut_tree(nodes, tree, k).collect()}
        assert cut == clusters
        assert len(set(cut.values())) == max(k, parts)


def test_no_edges(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("a",)], "instrument string")
    edges = spark.createDataFrame([("a", "a", 0.0), ("a", "b", float("nan"))], SCHEMA)
    assert rel.spanning_tree(edges).collect() == []
    assert sorted(map(tuple, rel.fixed_clusters(nodes, edges, 1).collect())) == [("a", "a"), ("b", "b")]
