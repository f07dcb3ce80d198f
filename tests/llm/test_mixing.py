import random
from itertools import product

import pytest

from jsonstrata.llm.mixing import PASS_COSTS, capped_shares, mix, route
from samples import documents


def test_shares_are_capped_and_shared_again():
    assert capped_shares([10, 100, 1000], [1, 1, 1], 3) == [30.0, 300.0, 780.0]
    assert capped_shares([0, 100], [1, 1], 3) == [0.0, 100.0]
    assert capped_shares([], [], 3) == []


def cost(flow, patterns):
    """What the passes over each pattern cost."""
    total = 0
    for p, tokens in patterns.items():
        left = sum(v for (q, _), v in flow.items() if q == p)
        for c in PASS_COSTS:
            total += c * min(left, tokens)
            left -= min(left, tokens)
    return total


def test_flow_is_cheapest():
    draw = random.Random(1)
    shapes = [("a",), ("b",), ("a", "b"), ("a", "b", "c"), ("c",)]
    for _ in range(20):
        patterns = {p: draw.randint(0, 3) for p in draw.sample(shapes, 3)}
        names = sorted({s for p in patterns for s in p})
        quotas = {s: draw.randint(0, 4) for s in names}
        flow = route(patterns, quotas)
        keys = [(p, s) for p in patterns for s in p]
        best = None
        for amounts in product(range(5), repeat=len(keys)):
            trial = dict(zip(keys, amounts))
            into = {s: sum(v for (_, t), v in trial.items() if t == s) for s in names}
            if any(into[s] > quotas[s] for s in names) or any(sum(v for (q, _), v in trial.items() if q == p) > 3 * t for p, t in patterns.items()):
                continue
            rank = (-sum(amounts), cost(trial, patterns))
            best = rank if best is None or rank < best else best
        assert (-sum(flow.values()), cost(flow, patterns)) == best


def taken(df):
    out = {}
    for r in df.collect():
        s = r["sources"][0]
        size, target, words = out.get(s, (0, 0, 0))
        out[s] = (r["source_size"], r["target"], words + r["size"] * r["passes"])
        assert 0 <= r["passes"] <= 3 and (r["size"] > 0 or r["passes"] == 0)
    return out


def test_sources_come_near_their_targets(spark):
    draw = random.Random(2)
    rows = [(i, "w " * draw.randint(0, 30), draw.choice(["a", "b", "b", "b", "é", None])) for i in range(600)]
    rows += [(1000, None, "a"), (1001, "", "a"), (None, "x y", "b"), (1003, "x y", "b"), (1003, "x y", "b"), (1004, "v " * 5000, "b")]
    docs = documents(spark, rows)
    got = taken(mix(docs, rows_per_bucket=40))
    assert got == taken(mix(docs, rows_per_bucket=40))
    total = sum(len((t or "").split()) for _, t, _ in rows)
    assert list(got) and abs(sum(t for _, t, _ in got.values()) - total) < 1e-6
    for s, (size, target, words) in got.items():
        assert target <= 3 * size + 1e-6 and abs(words - target) <= 30, s
    ids = [r["doc_id"] for r in mix(docs).collect()]
    assert len(ids) == len(rows)


def test_what_a_long_document_leaves_open_is_filled(spark):
    rows = []
    for s in range(12):
        rows += [(s * 100 + i, "w " * (400 if i == 0 else 10), f"s{s}") for i in range(61)]
    rows += [(10_000 + i, "w " * 10, "other") for i in range(1200)]
    weights = {f"s{s}": 1 for s in range(12)} | {"other": 36}
    # 500 words of each source: its buckets hold a few documents, and the long one is skipped or not.
    for s, (_, target, words) in taken(mix(documents(spark, rows), weights, rows_per_bucket=4)).items():
        assert abs(words - target) <= 5, s


def test_one_document_past_the_end(spark):
    rows = [(1, "w " * 100, "a"), (1, "w " * 100, "a"), (2, "w " * 70, "a"), (3, "w " * 270, "b")]
    # 135 words of a: the one of 70, and neither of 100, which would take both its rows.
    got = taken(mix(documents(spark, rows), {"a": 1, "b": 3}, rows_per_bucket=1))
    assert got["a"] == (270, 135.0, 100) or got["a"] == (270, 135.0, 70)
    rows = [(1, "w " * 100, "a"), (2, "w " * 100, "b")]
    assert [taken(mix(documents(spark, rows), {"a": a, "b": b}))["a"][2] for a, b in ((2, 1), (3, 7))] == [100, 100]


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a"] if i < 10 else ["a", "b"]) for i in range(20)]
    docs = documents(spark, rows, "doc_id long, text string, source array<string>")
    got = mix(docs, weights={"a": 1, "b": 2}).collect()
    # 300 words with their overlaps: 100 for a, which its own documents give, and 200 for b.
    passes = {r["doc_id"]: r["passes"] for r in got}
    assert sum(passes[i] for i in range(10)) == 10 and sum(passes[i] for i in range(10, 20)) == 20


@pytest.mark.parametrize("rows", [[], [(1, None, "a")], [(1, "", None)]])
def test_nothing_to_mix(spark, rows):
    assert [r["passes"] for r in mix(documents(spark, rows)).collect()] == [0] * len(rows)
