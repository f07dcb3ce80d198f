import random
import zlib

from pyspark.sql import functions as F

from jsonstrata.llm.sharding import OVERHEAD, best_fit, pack, shard_documents
from samples import documents


def sharded(spark, rows, shards):
    return [tuple(r) for r in shard_documents(documents(spark, rows), shards).select("doc_id", "size", "text_crc32", "shard", "slot").collect()]


def test_sizes_groups_and_slots(spark):
    draw = random.Random(1)
    rows = [(i, "é" * draw.randint(0, 90)) for i in range(400)] + [(1000 + i, "large " * 40) for i in range(300)]
    rows += [(5000, None), (5001, ""), (None, "x"), (None, "x")]
    got = sharded(spark, rows, 8)
    assert len(got) == len(rows)
    texts = {i: (t or "").encode() for i, t in rows}
    assert all(s == len(texts[i]) + OVERHEAD and c == zlib.crc32(texts[i]) for i, s, c, _, _ in got)
    load = [sum(s for _, s, _, n, _ in got if n == shard) for shard in range(8)]
    assert max(load) - min(load) < 0.03 * max(load)
    for shard in range(8):
        slots = sorted(x for *_, n, x in got if n == shard)
        assert slots == list(range(len(slots)))
    homes = {}
    for i, _, _, shard, _ in got:
        homes.setdefault(texts[i], set()).add(shard)
    # The 300 copies are far more than a shard holds; every other text is in one shard.
    assert [len(h) for t, h in homes.items() if t != b"large " * 40] == [1] * (len(homes) - 1)
    assert 1 < len(homes[b"large " * 40]) <= 8
    assert sorted(got, key=repr) == sorted(sharded(spark, rows, 8), key=repr)


def test_few_rows_and_empty_tables(spark):
    assert sharded(spark, [], 40) == []
    assert sharded(spark, [(1, None)], 40) == [(1, 16, 0, 0, 0)]
    assert sorted(r[3] for r in sharded(spark, [(1, "a"), (2, "b"), (3, "c")], 3)) == [0, 1, 2]


def test_best_fit_takes_the_tightest_bin():
    items = [(7.0, 1, "a"), (5.0, 1, "b"), (3.0, 1, "c"), (4.0, 1, "d")]
    assert best_fit(items, 10) == [("a", 1, 0), ("b", 1, 1), ("d", 1, 1), ("c", 1, 0)]
    assert best_fit(items, 8, 2) is None
    assert best_fit([(12.0, 1, "x"), (2.0, 3, "y")], 10) == [("x", 1, 0), ("y", 3, 1)]


def test_best_fit_equals_one_by_one():
    draw = random.Random(3)
    for _ in range(50):
        items = [(float(s), draw.randint(1, 9), s) for s in draw.sample(range(1, 60), 12)]
        room = []
        for size, count, _ in sorted(items, key=lambda x: -x[0]):
            for _ in range(count):
                fits = [x for x in range(len(room)) if room[x] >= size]
                if fits:
                    room[min(fits, key=lambda x: (room[x], x))] -= size
                else:
                    room.append(100 - size)
        load = {}
        for label, n, bin_ in best_fit(items, 100):
            load[bin_] = load.get(bin_, 0) + label * n
        assert sorted(load.values()) == sorted(100 - r for r in room)
        assert max(n for *_, n in pack(items, 4)) <= 3


def test_query_is_balanced(spark):
    import __spark_entry__ as entry

    got = entry.queries()["op7_best_fit_shards"](spark, "/root/testdata/sf0.001").groupBy("shard").agg(F.sum("size").alias("b"))
    load = [r["b"] for r in got.collect()]
    assert len(load) == 40
