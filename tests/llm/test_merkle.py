"""Merkle manifests against plain trees."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tickloom.llm import merkle, queries
from tickloom.llm.common import table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([h(*last[i : i + arity]) for i in range(0, len(last), arity)])
    return out


def siblings(tree, at, arity):
    """(before, behind) at each level under the top."""
    out = []
    for nodes in tree[:-1]:
        first = at // arity * arity
        out.append((nodes[first:at], nodes[at + 1 : first + arity]))
        at //= arity
    return out


def plain(rows, arity=2):
    """For rows of ``COLUMNS``: the sorted results of the query."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in groups[g]], arity)
    top = levels([trees[g][-1][0] for g in order], arity)
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            path = siblings(trees[g], i, arity) + siblings(top, k, arity)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            now = leaf((*r[:3], r[3] + 1, r[4])) if changed else leaf(r)
            for before, behind in path:
                now = h(*before, now, *behind)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[g][-1][0], root, h(*[x for a, b in path for x in (*a, *b)]), now, now == root))
    return sorted(out, key=str)


def test_query_equals_plain_trees(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select(*COLUMNS).collect()]
    got = [tuple(r) for r in queries.QUERIES["op11_merkle"](spark, SF).collect()]
    assert sorted(got, key=str) == plain(rows)


def odd(n, seed):
    r = random.Random(seed)
    langs = [None, "", "a", "é", "￿", "\U0001f600", "solo"]
    rows = [(i, "s", "hot" if r.random() < 0.6 else r.choice(langs[:-1]), r.randint(0, 9), r.choice(["", "x", "é\n", None])) for i in range(n)]
    rows += [(None, None, None, None, None)] * 3 + [(5, "s", "hot", 1, "twice")] * 2 + [(5, "s", "hot", None, "other"), (-1, "s", "solo", 3, "z" * 50_000)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, arity", [(0, 2), (700, 2), (700, 3), (40, 256)])
def test_odd_rows(spark, n, arity):
    rows = odd(n, n)
    df = spark.createDataFrame([(*x, 1, "y") for x in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, digest int, path string")
    got = merkle.manifest(df, COLUMNS, "lang", "doc_id", arity, keep={"near": F.col("digest")})
    assert got.columns == ["id", "group_key", "rank", "leaf", "subroot", "root", "path", "near"]
    got = got.select("id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("p"), merkle.folded(F.col("leaf"), F.col("path")).alias("f"))
    want = [(*x[:5], x[3]) for x in plain(rows, arity)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_nodes_cover_their_children(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(900)], "i bigint, g string")
    tree = merkle.Tree(df.select("g", F.col("i").alias("o"), merkle.leaf_of(F.col("i")).alias("digest")), 4)
    nodes = tree.nodes().toPandas()
    for g, count in (("a", 600), ("b", 300)):
        mine = nodes[nodes.g == g]
        for level, part in mine.groupby("level"):
            part = part.sort_values("lo")
            assert part.lo.tolist() == list(range(0, count, 4**level)) and part.hi.tolist()[-1] == count
            assert (part.hi.values[:-1] == part.lo.values[1:]).all()
        assert mine.level.max() == 5 and len(mine[mine.level == 5]) == 1
    tree.drop()


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert merkle.manifest(df, COLUMNS, "lang", "doc_id").count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(df, COLUMNS, "lang", "doc_id", keep={"path": F.lit(1)})
    with pytest.raises(ValueError):
        merkle.manifest(df, COLUMNS, "lang", "doc_id", 1)
