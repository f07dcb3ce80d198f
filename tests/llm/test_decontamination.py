import random

import numpy as np

from jsonstrata.llm import decontamination
from jsonstrata.llm.decontamination import find_contamination, tile
from samples import documents

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi"


def found(spark, rows, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string, block string, doc_id string")
    got = find_contamination(documents(spark, rows), bench, **options)
    return sorted((r["doc_id"] or 0, r["item_id"], r["n_tiles"], r["tile_words"], r["item_words"]) for r in got.collect())


def test_whole_reordered_and_partial_passages(spark):
    w = ITEM.split()
    rows = [
        (1, f"before {ITEM} after"),
        (2, "x " + " ".join(w[8:]) + " y " + " ".join(w[:8])),
        (3, ITEM.upper().replace(" ", ", ")),
        (4, " ".join(w[:6]) + " and the rest is new"),
        (5, " ".join(w[:4]) + " q " + " ".join(w[4:8]) + " q " + " ".join(w[8:12])),
        (6, None),
        (7, ""),
        (None, ITEM),
        (8, ITEM),
        (8, ITEM),
        (9, "filler " * 50_000 + ITEM),
    ]
    items = [(10, ITEM, "c", "c"), (11, "too short", "c", "c"), (12, None, "c", "c"), (13, "", "c", "c")]
    want = [(i, 10, 1, 16, 16) for i in (0, 1, 3, 8, 8, 9)] + [(2, 10, 2, 16, 16)]
    assert found(spark, rows, items) == sorted(want)
    assert found(spark, rows, items, block_bytes=40) == sorted(want)
    assert found(spark, [(4, rows[3][1])], items, min_coverage=0.3) == [(4, 10, 1, 6, 16)]
    assert found(spark, rows, []) == [] and found(spark, [], items) == []


def brute_tiling(doc, item, k):
    """Longest common free stretch again and again, the earliest in the document first."""
    used_d, used_i, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and d + n not in used_d and i + n not in used_i:
                    n += 1
                if (n, -d, -i) > (best[0], -best[1], -best[2]):
                    best = (n, d, i)
        n, d, i = best
        if n < k:
            return total
        used_d.update(range(d, d + n))
        used_i.update(range(i, i + n))
        total += n


def test_tiling_equals_brute_force():
    draw = random.Random(2)
    for _ in range(60):
        doc, item = draw.choices("abc", k=draw.randint(3, 40)), draw.choices("abc", k=draw.randint(3, 20))
        k = draw.randint(2, 4)
        pairs = [(d, i) for d in range(len(doc) - k + 1) for i in range(len(item) - k + 1) if doc[d : d + k] == item[i : i + k]]
        tiles = tile(np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int), k)
        assert sum(n for _, _, n in tiles) == brute_tiling(doc, item, k)
        assert all(doc[d : d + n] == item[i : i + n] for d, i, n in tiles)


def test_query_finds_every_whole_item(spark):
    import __spark_entry__ as entry

    sf_dir = "/root/testdata/sf0.001"
    got = {(r["doc_id"], r["item_id"]) for r in entry.queries()["op6_string_tiling"](spark, sf_dir).collect()}
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    flat = lambda t: " ".join(t.split())
    want = {(d["doc_id"], i["item_id"]) for d in docs for i in items if flat(i["text"]) in flat(d["text"])}
    assert want and want <= got and decontamination.FILTER_BITS


def test_scripts_without_spaces_and_short_items(spark):
    chinese = "这是一个关于语言模型的测试问题请回答"
    items = [(1, chinese, "c", "c"), (2, "the answer is", "c", "c"), (3, "is", "c", "c"), (4, "Où – «déjà» vu l’été dernier ici", "c", "c")]
    rows = [
        (1, f"前面的文字，{chinese[:9]}，{chinese[9:]}。后面"),
        (2, "so The ANSWER, is: 4"),
        (3, "the answer and this is"),
        (4, "où déjà-vu l'été\u00a0dernier ici"),
        (5, "完全不同的另外一段文字没有任何关系"),
        (6, "𠀀" * 30),
    ]
    assert found(spark, rows, items) == [(1, 1, 1, 18, 18), (2, 2, 1, 3, 3), (4, 4, 1, 7, 7)]
    assert (3, 3, 1, 1, 1) in found(spark, rows, items, min_item_words=1)


def test_hot_seeds_are_met_in_pieces(spark, monkeypatch):
    """A stock phrase in every item and again and again in a document: the same pairs, in small pieces."""
    phrase = "all rights reserved by the author of"
    items = [(i, f"{phrase} item{i}", "c", "c") for i in range(40)]
    rows = [(d, f"{phrase} x{d} " * 30 + f"{phrase} item{d}") for d in range(6)]
    want = found(spark, rows, items)
    assert len(want) == 240
    monkeypatch.setattr(decontamination, "PLACES", 50)
    built = decontamination.build([i for i, *_ in items], [t for _, t, *_ in items], 5, 3)[0]
    import pyarrow as pa

    values, owner = decontamination.word_values(pa.array([t for _, t in rows]))
    seeds, at = decontamination.runs(values, owner, 5)
    distinct, rank = np.unique(built.seeds, return_inverse=True)
    keys = rank * 40 + built.seed_item
    mine = np.searchsorted(distinct, seeds)
    real = distinct[np.minimum(mine, len(distinct) - 1)] == seeds
    parts = list(decontamination._pairs(built, owner, seeds[real], at[real], mine[real], keys, 0, 40))
    assert len(parts) == 240 and all(len(set(zip(d.tolist(), i.tolist()))) == 1 for d, i, _, _ in parts)
