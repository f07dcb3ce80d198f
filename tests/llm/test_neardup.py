import random

import pytest

from jsonstrata.llm import neardup
from jsonstrata.llm.graph import components
from jsonstrata.llm.neardup import band_size, near_duplicates
from samples import documents, groups, shingles


def near_copies(seed):
    """Chains of copies, each changed a little more than the one before."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    texts = []
    for base in range(4):
        w = [word() for _ in range(draw.choice([6, 40, 120]))]
        for _ in range(12):
            texts.append((base * 100 + draw.randint(0, 10**6) * 1000, " ".join(w)))
            w = list(w)
            w[draw.randrange(len(w))] = word()
    return texts


@pytest.mark.parametrize("percent", [85, 80, 60])
def test_groups_equal_brute_force(spark, percent):
    texts = near_copies(percent)
    texts += [(1, "one two three"), (2, "One  two\tthree"), (3, "one two"), (4, ""), (5, None), (6, " \n"), (7, "a b c d e"), (8, "A b c d e")]
    found = near_duplicates(documents(spark, texts), percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == groups(texts, percent)
    sizes = dict(texts)
    assert all(r["n_shingles"] == len(shingles(sizes[r["doc_id"]])) for r in found)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_hot_bucket_is_compared_in_blocks(spark, monkeypatch):
    """Star checks leave several groups in one bucket: all of them are found across blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    draw = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(40):
        w = list(base)
        for _ in range(draw.randint(0, 6)):
            w[draw.randrange(60)] = f"x{draw.randint(0, 3)}"
        texts.append((i, " ".join(w)))
    found = near_duplicates(documents(spark, texts), 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == groups(texts, 80)


def test_odd_rows(spark):
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (9, None), (9, None)]
    found = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(documents(spark, rows)).collect())
    assert found == [(0, 2, None, True), (2, 2, 2, True), (4, 2, 2, False), (4, 2, 2, False), (9, 0, 9, True), (9, 0, 9, True)]
    assert near_duplicates(documents(spark, rows).where("false")).count() == 0


def test_bands_miss_few():
    assert (band_size(85), band_size(80), band_size(60)) == (8, 6, 3)
    for percent in range(50, 100):
        size = band_size(percent)
        assert size == 1 or (1 - (percent / 100) ** size) ** (neardup.WIDTH // size) <= neardup.MISS


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 130)] + [(200, 200)]
    random.Random(1).shuffle(chain)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_open_buckets_make_rows_in_proportion(spark):
    """A bucket of one large group and a stray: rows of the order of its members."""
    rows = [(1, 0, i, 9, 1) for i in range(5000)] + [(1, 0, 9000, 9, 9000)] + [(2, 0, i, 9, 1) for i in range(50)]
    grouped = spark.createDataFrame(rows, "key long, band byte, node long, n long, component long")
    found = neardup.open_rows(grouped)
    assert found.count() == 5002 and {r["key"] for r in found.select("key").distinct().collect()} == {1}
    assert [r["node"] for r in found.where("visits").collect()] == [9000]
