import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jsonstrata.llm.kdtree import Tree, build_index, nearest

SCHEMA = "vec_id long, embedding array<double>, shard string, rank string, score string, block string"


def brute(rows, k, queries):
    ints = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q in queries & set(ints):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q)
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def found(spark, rows, queries, k=5, **options):
    df = spark.createDataFrame([(i, v, "c", "c", "c", "c") for i, v in rows], SCHEMA)
    got = nearest(df, df.where(df.vec_id.isin(list(queries))), k, **options)
    return {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()}


@pytest.mark.parametrize("shard_rows", [10_000, 60])
def test_equals_brute_force_with_ties(spark, shard_rows):
    draw = random.Random(4)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(6)]) for i in range(500)]
    rows += [(900 + i, [0.25] * 6) for i in range(40)]
    queries = set(range(0, 500, 50)) | {900, 901}
    assert found(spark, rows, queries, shard_rows=shard_rows) == brute(rows, 5, queries)


def test_odd_vectors(spark):
    rows = [(1, [0.5, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0]), (7, []), (8, [-1.0, 0.1])]
    assert found(spark, rows, {1, 2, 3, 4}) == brute(rows, 5, {1})
    assert found(spark, rows[1:5], {2, 3}) == set()
    assert found(spark, rows, set(), 5) == set()
    big = [(1, [1e7, 1.0]), (2, [1e7, 2.0]), (3, [1e7, 2.01])]
    assert found(spark, big, {1}) == brute(big, 5, {1})
    assert found(spark, [(1, [1e9]), (2, [1e9]), (3, [-1e9])], {1}) == {(1, 1, 2, 2**63 - 1), (1, 2, 3, 1 - 2**63)}


def test_search_prunes():
    draw = np.random.default_rng(0)
    vectors = draw.integers(-100, 100, (4000, 3)).astype(float)
    tree = Tree(vectors, np.arange(4000), leaf=32)
    query = np.array([5.0, -3.0, 2.0])
    want = sorted(((int(s), -i) for i, s in enumerate(vectors @ query)), reverse=True)[:5]
    assert sorted(tree.search(query, -1, 5, -np.inf), reverse=True)[0][0] == want[0][0]
    assert sorted(((s, -i) for s, i in tree.search(query, -1, 5, -np.inf)), reverse=True) == want
    visited = []
    tree.vectors = type("Seen", (), {"__getitem__": lambda _, s: visited.append(s) or vectors[tree.ids[s]]})()
    tree.search(query, -1, 5, -np.inf)
    assert len(visited) < len(tree.nodes) / 4


def test_a_tree_is_built_once_a_shard(spark):
    """The index has one tree a shard, in whose order its vectors stand, so that searches build none."""
    draw = np.random.default_rng(3)
    rows = [(i % 4, i, [float(x) for x in draw.integers(-99, 99, 3)]) for i in range(1200)]
    index = build_index(spark.createDataFrame(rows, "shard int, vec_id long, vector array<double>"), 3, True)
    assert {(r["kind"], r["n"]) for r in index.groupBy("kind").agg(F.count("*").alias("n")).collect()} == {(0, 4), (1, 1200)}
    one = index.where("shard = 2").orderBy("kind", "pos").collect()
    vectors = np.array([r["vector"] for r in one[1:]])
    tree = Tree.of(pickle.loads(one[0]["tree"]), vectors, np.array([r["vec_id"] for r in one[1:]]))
    for (first, last, _), low, high in zip(tree.nodes, tree.low, tree.high):
        assert (vectors[first:last].min(axis=0) == low).all() and (vectors[first:last].max(axis=0) == high).all()
