import hashlib
import math
import random
import zlib

import pytest

from jsonstrata.llm import trie
from jsonstrata.llm.trie import SENT, SpillingQueue, prefix_trie, steps, time_forward, with_heads

SCHEMA = "conv_id long, turn long, role string, text string, at string, depth string, key string, shard string, tag string, part string"


def brute(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((t is not None, t or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def totals(p):
        below = [totals(x) for x in children.get(p, [])]
        own_saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        return (sum(b[0] for b in below) or 1, own_saved + sum(b[1] for b in below))

    out = []
    for p, m in members.items():
        ends = sorted(c for c in m if len(built[c]) == len(p))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *totals(p), sha))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, *"cccccc") for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in prefix_trie(*with_heads(steps(df)), **options).collect()), key=repr)


def sample():
    draw = random.Random(9)
    rows = []
    for c in range(120):
        turns = [(draw.choice("ua"), draw.choice(["x", "yé", "zz"])) for _ in range(draw.randint(1, 12))]
        # A third of all are one conversation; others grow turn by turn, or share a first turn.
        if c % 3 == 0:
            turns = [("u", "same")] * 10
        elif c % 7 == 0:
            turns = [("u", str(i)) for i in range(c // 7 + 9)]
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    rows += [(500, t, "u", f"long {t % 3}") for t in range(400)] + [(503, t, "u", f"long {t % 3}") for t in range(390)]
    rows += [(600, None, None, None), (600, 1, "u", "x"), (600, 1, "a", "x"), (600, 1, "a", "x"), (None, 1, "u", "x"), (-3, 1, "u", "x")]
    rows += [(1007, 0, "u", "gone")]
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_nodes": 40, "piece_nodes": 7}, {"shard_nodes": 1, "piece_nodes": 1}])
def test_equals_brute_force(spark, options):
    rows = sample()
    assert found(spark, rows, **options) == brute(rows)


def test_top_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(trie, "BROADCAST_ROWS", 0)
    rows = sample()[:400]
    assert found(spark, rows, shard_nodes=30, piece_nodes=5) == brute(rows)


def test_small_tables(spark):
    assert found(spark, []) == [] and found(spark, [(None, 1, "u", "x")]) == []
    # All turns go and there is no head: a conversation without turns, a member of the root alone.
    turnless = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    assert found(spark, [(turnless, 1, "u", "x")]) == brute([(turnless, 1, "u", "x")])
    assert len(found(spark, [(turnless, 1, "u", "x")])) == 1


def test_queue_spills_in_order():
    draw = random.Random(1)
    keys = [(draw.randint(0, 50), draw.randint(0, 50), 0) for _ in range(3000)]
    queue, got = SpillingQueue(held=100), []
    for i, key in enumerate(keys):
        queue.push(key, (key, i))
        if i % 3 == 0:
            assert queue.head() == min(keys[: i + 1]) or got
            got.append(queue.pop())
    assert queue.runs > 5
    while queue.head() is not None:
        got.append(queue.pop())
    assert sorted(got) == sorted((key, i) for i, key in enumerate(keys))
    plain, queue = sorted(keys), SpillingQueue(held=7)
    for key in keys:
        queue.push(key, key)
    assert [queue.pop() for _ in keys] == plain


def test_totals_do_not_depend_on_memory():
    # A star of 500 leaves under one node, and a node whose parent is elsewhere.
    assert SENT[:4] == ["shard", "k0", "k1", "k2"]
    rows = [(0, -2, i, 0, -1, 7, 7, i, 1, None, i) for i in range(500)] + [(0, -1, 7, 7, 0, 9, 9, 70, 1, None, 1)]
    for held in (3, 10_000):
        out = list(time_forward(rows, held))
        assert out[-1] == (-1, 7, 7, 9, 9, 70, 1, 500, 500, sum(range(500)) + 1, None)
        assert len(out) == 501 and {r[-1] for r in out[:-1]} == {70}
