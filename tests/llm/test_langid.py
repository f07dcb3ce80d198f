import random

import pytest
from pyspark.sql import functions as F

from jsonstrata.llm import langid
from jsonstrata.llm.langid import UNKNOWN, identify, reject, train
from samples import documents

SYLLABLES = {"aa": ["ka", "lo", "mi", "ru"], "bb": ["sch", "ten", "und", "er"], "gg": ["λο", "γος", "και", "τη"]}


def prose(lang, words, seed):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, prose(lang, 60, i), "s", lang) for lang in SYLLABLES for i in range(20)]
    return train(documents(spark, [*rows, (900, None, "s", "aa"), (901, "ka", "s", None), (902, "", "s", "bb")]))


def test_languages_and_spans(spark, model):
    mixed = prose("aa", 40, 98) + ". " + prose("bb", 15, 99)
    rows = [(1, prose("aa", 30, 77)), (2, prose("bb", 2000, 78)), (3, mixed), (4, "ΛΟΓΟΣ 12"), (5, "12 +-"), (6, ""), (7, None), (7, None), (None, "und er")]
    found = identify(documents(spark, rows), model).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 9
    assert {i: r["lang_pred"] for i, r in by_id.items()} == {1: "aa", 2: "bb", 3: "aa", 4: "gg", 5: UNKNOWN, 6: UNKNOWN, 7: UNKNOWN, None: "bb"}
    assert [s["lang"] for s in by_id[3]["spans"]] == ["aa", "bb"]
    cut = by_id[3]["spans"][1]
    assert mixed[cut["start"] : cut["end"]] == prose("bb", 15, 99)
    assert 0.5 < by_id[3]["score"] < 1 and by_id[1]["score"] == 1 and by_id[5]["score"] == 0 and by_id[5]["spans"] == []


def test_viterbi_equals_brute_force(model):
    """The best of all labellings of a few words, by scores and switches."""
    from itertools import product

    texts = ["ka und lo er", "sch mi mi", "", "ru"]
    words = langid.Words(texts)
    got = langid.label_words(words, model, 3.0)
    score = [[sum(model.scores[c][k] for c in words.cells[f : f + n]) for k in (0, 1)] for f, n in zip(words.first, words.letters)]
    at = 0
    for number, text in enumerate(texts):
        n = int((words.text == number).sum())
        if n:
            value = lambda p: sum(score[at + i][k] for i, k in enumerate(p)) - 3.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
            best = max(product((0, 1), repeat=n), key=value)
            assert tuple(got[at : at + n]) == best
        at += n


def test_reject_keeps_rows_whole(spark, model):
    docs = documents(spark, [(1, "ka lo mi", "s", "aa"), (2, "123"), (3, None), (4, ""), (5, "und er ten")])
    kept = reject(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 5]


def test_scripts_that_no_language_is_written_in(spark, model):
    rows = [(1, "这是一个没有学过的语言"), (2, "Это русский текст"), (3, "ka lo это русский текст"), (4, "kalo miru ру"), (5, "這是 λογος και τη λο")]
    docs = documents(spark, rows)
    found = {r["doc_id"]: r for r in identify(docs, model).collect()}
    assert {i: r["lang_pred"] for i, r in found.items()} == {1: "aa", 2: "aa", 3: "aa", 4: "aa", 5: "gg"}
    assert {i: round(r["score"], 3) for i, r in found.items()} == {1: 0, 2: 0, 3: round(4 / 19, 3), 4: 0.8, 5: round(12 / 14, 3)}
    assert [tuple(s) for s in found[2]["spans"]] == [(0, 17, UNKNOWN)]
    assert sorted(r["doc_id"] for r in reject(docs, model, min_score=0.5).collect()) == [4, 5]


def test_without_labels_everything_is_unknown(spark):
    docs = documents(spark, [(1, "ka lo"), (2, None)])
    model = train(docs)
    assert [r["lang_pred"] for r in identify(docs, model).collect()] == [UNKNOWN] * 2
    assert identify(docs.where("false"), model).count() == 0
    assert reject(docs, model).count() == 0


def test_held_out_accuracy(spark):
    import __spark_entry__ as entry

    found = entry.queries()["op1_language_spans"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    right = found.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.95


def test_shortcut_changes_no_label(model, monkeypatch):
    draw = random.Random(8)
    texts = [" ".join(prose(draw.choice(["aa", "bb"]), draw.randint(1, 9), draw.random()) for _ in range(draw.randint(1, 5))) for _ in range(300)]
    words = langid.Words([*texts, "", "12"])
    for switch in (1.0, 6.0, 20.0):
        short = langid.label_words(words, model, switch)
        with monkeypatch.context() as patch:
            patch.setattr(langid, "_alone", lambda s, f, c, p: (f * 0, f < 0))
            assert (langid.label_words(words, model, switch) == short).all()
