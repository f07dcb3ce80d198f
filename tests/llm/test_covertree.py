import random

import numpy as np
import pytest

from jsonstrata.llm.covertree import LEAF, Search, Shard, cover, hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>, shard string, rank string, score string, kind string, no string"


def brute(rows, anchors, positives=5, negatives=3, low=50, high=95):
    sound = {(i, lab, tuple(v)) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    ints = [(i, lab, [int(np.floor(256 * x)) for x in v]) for i, lab, v in sound]
    out = set()
    for i, lab, v in ints:
        if i not in anchors:
            continue
        scored = [(-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j, other) for j, other, w in ints if j != i]
        for p, j, _ in sorted(s for s in scored if s[2] == lab)[:positives]:
            hits = sorted(s for s in scored if s[2] != lab and low * -p <= 100 * -s[0] <= high * -p)
            out |= {(i, j, rank, k, -p, -s) for rank, (s, k, _) in enumerate(hits[:negatives], 1)}
    return out


def found(spark, rows, anchors, **options):
    df = spark.createDataFrame([(*r, "c", "c", "c", "c", "c") for r in rows], SCHEMA).repartition(3)
    got = hard_negatives(df, df.where(df.vec_id.isin(list(anchors))), **options)
    return [tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]


@pytest.mark.parametrize("shard_rows", [10_000, 90])
def test_equals_brute_force(spark, shard_rows):
    draw = random.Random(5)
    rows = [(i, i % 4, [draw.choice([-0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(5)]) for i in range(500)]
    # One vector, and one label, of a third of all rows; ties in plenty.
    rows += [(1000 + i, 7, [0.25, 0.3, 1.0, 0.3, 0.25]) for i in range(250)] + [(2000 + i, i % 3, [1.0, 1.0, 0.5, 0.25, 0.3]) for i in range(40)]
    anchors = {0, 50, 1000, 1001, 2000, 450}
    want = brute(rows, anchors)
    got = found(spark, rows, anchors, shard_rows=shard_rows)
    assert len(got) == len(want) > 60 and set(got) == want


def test_odd_rows(spark):
    rows = [
        (1, 0, [0.5, 0.5]), (2, 0, [0.5, 0.4]), (3, 1, [0.4, 0.4]), (4, 1, None), (5, None, [1.0, 1.0]), (None, 1, [0.4, 0.4]),
        (6, 1, [None, 1.0]), (7, 1, [float("nan"), 1.0]), (8, 1, [float("inf"), 0.0]), (9, 1, [0.6]), (10, 1, []), (3, 1, [0.4, 0.4]), (11, 0, [-1.0, -1.0]),
    ]
    want = brute([(i, lab, None if v is None else v + [0.0] * (2 - len(v))) for i, lab, v in rows], {1, 4, 5, 11})
    got = found(spark, rows, {1, 4, 5, 11})
    assert len(got) == len(want) > 0 and set(got) == want
    assert found(spark, rows[3:5], {4, 5}) == [] and found(spark, rows, set()) == [] and found(spark, [], {1}) == []
    big = [(1, 0, [1e7, 1.0]), (2, 0, [1e7, 2.0]), (3, 1, [7e6, 2.01]), (4, 1, [7e6, 2.02])]
    assert set(found(spark, big, {1})) == brute(big, {1})


def _shard(vectors, labels):
    order, nodes = cover(vectors)
    return Shard(nodes, vectors[order], np.arange(len(vectors))[order], labels[order])


def test_tree_covers_and_separates():
    draw = np.random.default_rng(1)
    vectors = np.floor(draw.normal(size=(3000, 3)) * 100)
    order, nodes = cover(vectors)
    norms = (vectors**2).sum(axis=1)
    points = np.column_stack([vectors, np.sqrt(norms.max() - norms)])[order]
    for a, b, low, high, radius in zip(*(nodes[x] for x in ("first", "last", "low", "high", "radius"))):
        assert np.linalg.norm(points[a:b] - points[a], axis=1).max() <= radius + 1e-6
        if low < high:
            centres = points[nodes["first"][low:high]]
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2) + np.eye(len(centres)) * radius
            assert apart.min() > radius / 2 - 1e-6 and (nodes["radius"][low:high] <= radius / 2 + 1e-6).all()
        else:
            assert b - a <= LEAF or radius == 0


def test_search_skips_what_is_outside():
    draw = np.random.default_rng(2)
    vectors = np.floor(np.repeat(draw.normal(size=(60, 3)) * 100, 100, axis=0) + draw.normal(size=(6000, 3)))
    labels = draw.integers(0, 5, 6000)
    shard = _shard(vectors, labels)
    query = np.array([50.0, -30.0, 20.0])
    scores = vectors @ query
    windows = [(2000, 4000), (0, 100)]
    got = shard.find(Search(query, 17, 2, False, 3, windows))
    for (low, high), some in zip(windows, got):
        want = sorted((-int(s), i) for i, s in enumerate(scores) if low <= s <= high and labels[i] != 2 and i != 17)[:3]
        assert some == [(-s, i) for s, i in want]
    assert shard.checked < 2000
    shard.checked = 0
    assert shard.find(Search(query, -1, 2, True, 1, [(-np.inf, np.inf)]))[0][0][0] == scores[labels == 2].max()
    assert shard.checked < 300
