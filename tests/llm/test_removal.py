import random

import numpy as np
import pytest

from jsonstrata.llm import removal, suffixes
from jsonstrata.llm.sentences import drop_repeated_sentences
from jsonstrata.llm.suffixes import drop_repeated_strings
from samples import documents, repeated_strings


def result(df):
    return {r["doc_id"]: bytes(r["kept"]) for r in df.collect()}


def check_spans(df, texts):
    texts = {i: (t or "").encode() for i, t in texts}
    for r in df.collect():
        whole = texts[r["doc_id"]]
        left, at = b"", 0
        for s in r["spans"]:
            assert at <= s["start"] < s["end"] and (s["start"] > at or at == 0)
            left += whole[at : s["start"]]
            at = s["end"]
        assert left + whole[at:] == bytes(r["kept"]) and r["n_bytes"] == len(whole)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("buckets", ["one", "many"])
def test_strings_equal_brute_force(spark, monkeypatch, seed, buckets):
    if buckets == "many":
        monkeypatch.setattr(removal, "BUCKET_BYTES", 200)
    draw = random.Random(seed)
    parts = ["".join(draw.choices("ab", k=draw.randint(3, 30))) for _ in range(6)] + ["a" * 25, "é€" * 4]
    texts = [(i * 7 % 97, "".join(draw.choices([*parts, "x", "b"], k=draw.randint(0, 8)))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "abc")]
    for length in (6, 9):
        got = drop_repeated_strings(documents(spark, texts), length)
        assert result(got) == repeated_strings(texts, length)
        check_spans(got, texts)


def test_strings_in_slices_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 64)
    monkeypatch.setattr(suffixes, "TOGETHER", 200)
    draw = random.Random(5)
    long = "".join(draw.choices("abc", k=900))
    texts = [(1, long), (2, long[:400] + "zz" + long[300:]), (3, "q" + long[200:300] + "q"), (4, "c" * 300), (5, "c" * 70)]
    got = drop_repeated_strings(documents(spark, texts), 8)
    assert result(got) == repeated_strings(texts, 8)


def test_strings_of_odd_rows(spark):
    passage = "the same fifty bytes and more stand in every one of these documents, word by word."
    rows = [(5, passage), (5, passage), (9, "x " + passage), (None, passage), (3, None), (7, "")]
    got = drop_repeated_strings(documents(spark, rows))
    assert sorted((r["doc_id"] or 0, len(r["kept"]), len(r["spans"])) for r in got.collect()) == [
        (0, len(passage), 0),
        (3, 0, 0),
        (5, len(passage), 0),
        (5, len(passage), 0),
        (7, 0, 0),
        (9, 2, 1),
    ]
    assert drop_repeated_strings(documents(spark, rows).where("false")).count() == 0


def brute_sentences(texts, k, min_words):
    """Sentences kept, by their words, of (id, text) pairs in order of id."""
    import re

    def split(t):
        found = [m.group() for m in re.finditer(r"[^.!?\n]*(?:[.!?](?!\s|$)[^.!?\n]*)*(?:[.!?]+(?=\s|$)|\n|$)", t or "")]
        return [s.split() for s in found if s.split()]

    parts = {i: split(t) for i, t in texts}
    seen, gone = set(), {i: set() for i in parts}
    for i in sorted(parts):
        s = [[w.lower() for w in x] for x in parts[i]]
        for a in range(len(s)):
            b = a + k
            while b <= len(s) and sum(map(len, s[a:b])) < min_words:
                b += 1
            if b > len(s):
                continue
            key = tuple(map(tuple, s[a:b]))
            if key in seen:
                gone[i].update(range(a, b))
            seen.add(key)
    return {i: [x for n, x in enumerate(parts[i]) if n not in gone[i]] for i in parts}


@pytest.mark.parametrize("seed", range(3))
def test_sentences_equal_brute_force(spark, seed):
    draw = random.Random(seed)
    pool = [" ".join(draw.choices(["red", "Blue", "sky", "is", "ok", "a1"], k=draw.randint(1, 5))) + draw.choice([".", "!", "?", "\n"]) for _ in range(8)]
    texts = [(i, " ".join(draw.choices(pool, k=draw.randint(0, 9)))) for i in range(30)] + [(40, None), (41, ""), (42, "no end")]
    got = drop_repeated_sentences(documents(spark, texts), 2, 4)
    check_spans(got, texts)
    want = brute_sentences(texts, 2, 4)
    assert {i: k.decode().split() for i, k in result(got).items()} == {i: [w for s in want[i] for w in s] for i in want}


def test_sentences_of_odd_rows(spark):
    passage = "One sentence of six whole words. Another one that has seven of them. A third to end the passage."
    rows = [(5, passage), (5, passage), (9, f"New start. {passage} New end."), (None, passage), (3, None), (7, "")]
    got = drop_repeated_sentences(documents(spark, rows))
    assert sorted((r["doc_id"] or 0, bytes(r["kept"]).decode().strip()) for r in got.collect()) == sorted(
        [(0, passage), (3, ""), (5, passage), (5, passage), (7, ""), (9, "New start. New end.")]
    )
    assert drop_repeated_sentences(documents(spark, rows).where("false")).count() == 0


def test_repeats_of_one_sentence_or_inside_one(spark):
    draw = random.Random(3)
    make = lambda n: " ".join(f"{draw.choice('bcdfg')}{draw.randrange(10**6)}" for _ in range(n))
    inside, alone, line, short = make(60), make(10) + ".", make(30), make(9) + "."
    texts = [
        (1, f"{make(40)} {inside} {make(40)}"),
        (2, f"Own start. {alone} Own end."),
        (3, line),
        (4, f"Some. {short} Thing."),
        (5, f"{make(25)} {inside.upper()} {make(33)}. {make(9)}"),
        (6, f"Other. {alone} Last."),
        (7, line),
        (8, f"Any. {short} Word."),
        (9, f"{make(12)} {inside}"),
    ]
    got = drop_repeated_sentences(documents(spark, texts))
    check_spans(got, texts)
    kept = {i: k.decode() for i, k in result(got).items()}
    assert all(kept[i] == t for i, t in texts if i in (1, 2, 3, 4, 8))
    assert kept[7] == "" and kept[6] == "Other. Last."
    for i, own in ((5, 67), (9, 12)):
        words = dict(texts)[i].split()
        assert set(words) - set(inside.split()) - set(inside.upper().split()) <= set(kept[i].split())
        # Up to 8 words before the first common place, and less than a part and 8 words at the end.
        assert own <= len(kept[i].split()) <= own + 8 + 12
    # Sentences shorter than a window of words, and one repeated word.
    odd = documents(spark, [(1, "a b c"), (2, "z a b c"), (3, "x " * 500), (4, "a b c")])
    tiny = drop_repeated_sentences(odd.where("doc_id <> 3"), alone_words=1)
    assert {i: len(k.split()) for i, k in result(tiny).items()} == {1: 3, 2: 4, 4: 0}
    assert {i: len(k.split()) for i, k in result(drop_repeated_sentences(odd)).items()} == {1: 3, 2: 4, 3: 1, 4: 3}


def test_rows_are_packed_and_unpacked():
    ids = np.array([7, 3, 7, 2**40])
    start, size = np.arange(4), np.arange(4) + 10
    key, check = np.arange(4).astype("u8") << np.uint64(40), np.arange(4).astype("u8")
    bucket = np.array([1, 0, 1, 0])
    rows = removal.as_table(removal.packed(removal.KEYED, bucket, ids, start, size, key, check))
    assert rows.num_rows == 2
    back = removal.unpacked(rows, removal.KEYED)
    assert back["ids"].tolist() == [3, 2**40, 7, 7] and back["start"].tolist() == [1, 3, 0, 2]
    assert back["key"].tolist() == [key[1], key[3], key[0], key[2]]
    assert removal.packed(removal.KEYED, ids[:0], ids[:0], ids[:0], ids[:0]) == []
