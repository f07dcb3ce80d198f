"""Documents parsed once, fields set aside, ranges of progress, repeats on a stream, driving again."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from fixtures import BODY, PROD_SCHEMA, messages, rows
from jsonstrata.functions.names import strip_prefix
from jsonstrata.operators import ranges
from jsonstrata.operators.parse import parse_messages, readable, unreadable
from jsonstrata.operators.poison import isolate, of_data
from jsonstrata.operators.ranges import contiguous, merge_ranges, not_covered, offset_ranges
from jsonstrata.operators.skew import JoinLimits
from jsonstrata.operators.variants import parse_documents, with_documents
from jsonstrata.plans.layers import load_batch
from jsonstrata.plans.redrive import open_quarantine, redrive, redrive_states
from jsonstrata.plans.spec import GOLD_LAYER, RAW_LAYER, GoldTag, LoadPlan, RawTag
from jsonstrata.session import shared_folder
from jsonstrata.streaming.runner import resume_offsets
from test_load import make_plan, snapshot

FIELDS = "id bigint, name string, d double, b boolean, t date, s struct<x:int, y:struct<z:string>>, a array<struct<n:int>>, m map<string,int>"
DOCUMENTS = [
    '{"id":1,"name":"x","d":1.5,"b":true,"t":"2024-01-02","s":{"x":1,"y":{"z":"q"}},"a":[{"n":1},{"n":2}],"m":{"k":3}}',
    '{"id":"7"}', '{"id":1.5}', '{"id":12345678901234567890}', '{"name":5}', '{"name":{"z":[1, 2]}}', '{"d":1}', '{"d":"1"}',
    '{"b":1}', '{"t":"soon"}', '{"s":5}', '{"s":{"x":"no","y":{"z":"q"}}}', '{"a":[{"n":1},{"n":"no"}]}', '{"a":{"n":1}}', '{"m":{"k":"v"}}',
    '{"id":null,"s":null,"a":null}', '{"a":[]}', '{}', "not json", "[1]", '"s"', "", None, '{"id":2,"more":1}',
]


def document_messages(spark, texts):
    return messages(spark, [(0, i, t, "t") for i, t in enumerate(texts)])


def test_documents_read_like_the_typed_json(spark):
    schema = StructType.fromDDL(FIELDS)
    given = document_messages(spark, DOCUMENTS)
    text = lambda df: rows(df.select("_msg_offset", "_corrupt_record", *[F.to_json(F.struct(c)) if c in "sam" else c for c in schema.names]))
    plain = parse_messages(given, schema)
    once = parse_documents(with_documents(given), schema)
    assert [(f.name, f.dataType) for f in once.schema.fields if f.name in schema.names] == [(f.name, f.dataType) for f in schema.fields]
    # Of a corrupt document the typed read keeps some fields; the load uses none of them.
    keep = lambda found: [r for r in found if r[1] is None]
    assert keep(text(once)) == keep(text(plain))
    corrupt = lambda df: sorted(r["offset"] for r in unreadable(df).collect())
    assert corrupt(once) == corrupt(plain)


def test_what_does_not_fit_is_set_aside(spark):
    schema = StructType.fromDDL(FIELDS)
    found = parse_documents(with_documents(document_messages(spark, DOCUMENTS)), schema, "rescue")
    told = {DOCUMENTS[r["_msg_offset"]]: r for r in found.collect()}
    aside = {t: r["_rescued"] for t, r in told.items() if r["_rescued"]}
    misfit = lambda path, value: f'{{"{path}":{{"value":"{value}","reason":"does not fit"}}}}'
    assert aside == {
        '{"id":"7"}': misfit("id", '\\"7\\"'),
        '{"id":1.5}': misfit("id", "1.5"),
        '{"id":12345678901234567890}': misfit("id", "12345678901234567890"),
        '{"d":"1"}': misfit("d", '\\"1\\"'),
        '{"b":1}': misfit("b", "1"),
        '{"t":"soon"}': misfit("t", '\\"soon\\"'),
        '{"s":5}': misfit("s", "5"),
        '{"s":{"x":"no","y":{"z":"q"}}}': misfit("s.x", '\\"no\\"'),
        '{"a":[{"n":1},{"n":"no"}]}': misfit("a", '[{\\"n\\":1},{\\"n\\":\\"no\\"}]'),
        '{"a":{"n":1}}': misfit("a", '{\\"n\\":1}'),
        '{"m":{"k":"v"}}': misfit("m", '{\\"k\\":\\"v\\"}'),
        '{"id":2,"more":1}': '{"more":{"value":"1","reason":"unknown"}}',
    }
    kept = told['{"s":{"x":"no","y":{"z":"q"}}}']["s"]
    assert kept["x"] is None and kept["y"]["z"] == "q"
    assert {t for t, r in told.items() if r["_corrupt_record"] is not None} == {"not json", "[1]", '"s"'}


def test_lists_of_documents(spark):
    schema = ArrayType(StructType.fromDDL("k int, `odd name` string"))
    given = document_messages(spark, ['[{"k":1},{"k":2,"odd name":"x"}]', '[{"k":"no"}]', "[]", '{"k":1}', "broken", None])
    once = with_documents(given)
    plain = rows(readable(parse_messages(given, schema)).where("k IS NOT NULL"))
    assert rows(readable(parse_documents(once, schema)).where("k IS NOT NULL")) == plain == [(1, None), (1, None), (2, "x")]
    assert sorted(r["offset"] for r in unreadable(parse_documents(once, schema)).collect()) == [1, 4]
    assert parse_documents(once, schema, "rescue").where("_rescued IS NOT NULL").count() == 1
    with pytest.raises(ValueError, match="misfits"):
        parse_documents(once, schema, "drop")


def test_load_that_parses_once_gives_the_same_tables(spark, prefix):
    plain, once = make_plan(spark, prefix + "p"), make_plan(spark, prefix + "o", parse_once=True)
    for plan in (plain, once):
        load_batch(messages(spark), "b-0", plan, keep_progress=True)
    assert list(snapshot(spark, once).values()) == list(snapshot(spark, plain).values())
    given = with_documents(messages(spark)).persist()
    frames = [strip_prefix(readable(parse_documents(given, PROD_SCHEMA))) for _ in range(3)]
    plan = frames[0].unionByName(frames[1]).unionByName(frames[2])._jdf.queryExecution().optimizedPlan().toString()
    given.unpersist()
    # Below the three reads is the one kept frame; nothing is parsed above it.
    assert "InMemoryRelation" in plan and "try_parse_json" not in plan.split("InMemoryRelation")[0]
    with pytest.raises(ValueError, match="parse_once"):
        LoadPlan("/x", raw_tags=(RawTag("a", PROD_SCHEMA, misfits="rescue"),))


def test_ranges_merge_and_cover(spark, monkeypatch):
    monkeypatch.setattr(ranges, "CHUNK", 10)
    given = [(0, o, "{}", "t") for o in [*range(0, 25), *range(27, 31), 27, 40]] + [(1, o, "{}", None) for o in range(5)]
    found = offset_ranges(messages(spark, given))
    assert rows(found) == [("t", 0, 0, 24), ("t", 0, 27, 30), ("t", 0, 40, 40), (None, 1, 0, 4)]
    filled = merge_ranges(found.unionByName(offset_ranges(messages(spark, [(0, 25, "{}", "t"), (0, 26, "{}", "t")]))))
    assert rows(filled) == [("t", 0, 0, 30), ("t", 0, 40, 40), (None, 1, 0, 4)]
    every = messages(spark, [(p, o, "{}", s) for p, s in [(0, "t"), (1, None), (0, "u")] for o in range(45)])
    want = {(0, o, "t") for o in (25, 26, *range(31, 40), *range(41, 45))} | {(1, o, None) for o in range(5, 45)} | {(0, o, "u") for o in range(45)}
    for limits in (JoinLimits(), JoinLimits(broadcast_rows=0)):
        left = not_covered(every, found, limits)
        assert left.columns == every.columns and {(r["partition"], r["offset"], r["source"]) for r in left.collect()} == want
    assert rows(contiguous(found, ["source", "partition"])) == [("t", 0, 24), (None, 1, 4)]
    assert rows(merge_ranges(found.where("false"))) == []


def test_many_ranges_are_not_compared_with_every_message(spark, capsys):
    loaded = [o for o in range(-50, 2_000) if o % 7 not in (3, 5)] + [3_000_000_000, 2**62]
    known = [(1, o, "{}", "t") for o in loaded] + [(1, 5, "{}", None), (1, None, "{}", "t"), (None, 3, "{}", "t")]
    found = offset_ranges(messages(spark, known))
    assert found.count() > ranges.FEW_RANGES
    every = [(p, o, f"{p}{o}", s) for p in (1, 2) for o in [*range(-60, 2_010), 3_000_000_000, 2**62] for s in ("t", "u", None)]
    every += [(1, 4, "again", "t"), (1, 4, "again", "t"), (1, 10, "again", "t"), (1, None, "x", "t"), (None, 3, "x", "t")]
    left = not_covered(messages(spark, every), found)
    taken = {(1, o, "t") for o in loaded} | {(1, 5, None)}
    assert rows(left) == sorted([m for m in every if (m[0], m[1], m[3]) not in taken], key=repr)
    assert left.columns == messages(spark).columns
    left.explain()
    assert "NestedLoop" not in capsys.readouterr().out


def test_progress_by_ranges(spark, prefix):
    plan = make_plan(spark, prefix, progress="ranges")
    text = lambda o: (0, o, f'{{"_extract_id":"A{o}"}}', "t")
    load_batch(messages(spark, [text(o) for o in (1, 2, 5)]), "b-0", plan, keep_progress=True)
    load_batch(messages(spark, [text(o) for o in (6, 7)]), "b-1", plan, keep_progress=True)
    # Read again from behind the first range, so that the hole can be filled.
    assert resume_offsets(spark, plan, "t", 1) == '{"t": {"0": 3}}'
    load_batch(messages(spark, [text(o) for o in range(1, 9)]), "b-2", plan, keep_progress=True)
    got = plan.raw("prod").read(spark, only_batch="b-2").select("id")
    assert rows(got) == [("A3",), ("A4",), ("A8",)]
    assert resume_offsets(spark, plan, "t", 1) == '{"t": {"0": 9}}'
    with pytest.raises(ValueError, match="progress"):
        LoadPlan("/x", progress="some")


def test_driving_again(spark, prefix):
    narrow = StructType.fromDDL("id string, qty int")
    wide = StructType.fromDDL("id string, qty string")
    root = shared_folder(spark)

    def plan(schema):
        return LoadPlan(
            root=root,
            raw_tags=(RawTag("p", schema, "SELECT id, cast(qty AS int) AS qty FROM {p}" if schema is narrow else "SELECT id, try_cast(qty AS int) AS qty FROM {p}"),),
            gold_tags=(GoldTag("g", schema, "SELECT id FROM {g}", "id"),),
            insert_only="g",
            database_prefix=prefix,
        )

    given = [(0, 1, '{"id":"a","qty":1}', "t"), (0, 2, '{"id":"b","qty":"many"}', "t"), (0, 3, "broken", "t"), (None, None, '{"id":"c","qty":"x"}', None)]
    load_batch(messages(spark, given), "b-0", plan(narrow), keep_progress=False)
    assert open_quarantine(spark, plan(wide), RAW_LAYER, "p").count() == 3
    assert redrive(spark, plan(wide), RAW_LAYER, "p", "r-0") == {"loaded": 2, "failed": 1}
    assert redrive(spark, plan(wide), RAW_LAYER, "p", "r-0") == {}
    assert rows(plan(wide).raw("p").read(spark).select("id", "qty")) == [("a", 1), ("b", None), ("c", None)]
    assert redrive(spark, plan(wide), RAW_LAYER, "p", "r-1", max_attempts=2) == {"given up": 1}
    assert redrive(spark, plan(wide), RAW_LAYER, "p", "r-2") == {}
    assert rows(plan(wide).raw("p").read(spark).select("id")) == [("a",), ("b",), ("c",)]
    assert rows(redrive_states(spark, plan(wide), RAW_LAYER, "p").select("offset", "attempts", "state")) == [
        (2, 1, "loaded"), (3, 2, "given up"), (None, 1, "loaded"),
    ]
    # The other layer's quarantine is its own.
    assert redrive(spark, plan(wide), GOLD_LAYER, "g", "r-3") == {"loaded": 2, "failed": 1}
    assert rows(plan(wide).gold("g").read(spark).select("id")) == [("a",), ("b",), ("c",)]
    for layer, tag, text in [("INTAKE", "files", "never reached"), (RAW_LAYER, "q", "no tag")]:
        with pytest.raises(ValueError, match=text):
            redrive(spark, plan(wide), layer, tag, "r-9")


def test_errors_that_are_not_of_the_data_do_not_quarantine(spark):
    given = messages(spark).persist()

    def lost(_):
        raise PySparkException("executor lost")

    assert not of_data(PySparkException("executor lost"))
    with pytest.raises(PySparkException, match="lost"):
        isolate(given, lost)

    def odd(part):
        part.select(F.when(F.col("offset") == 2, F.raise_error("odd").cast("int"))).write.format("noop").mode("overwrite").save()

    good, bad = isolate(given, odd)
    assert rows(bad.select("offset")) == [(2,)] and good.count() == 5 and "odd" in bad.first()["reason"]
    assert good.columns == given.columns
    given.unpersist()


def test_a_faulty_message_costs_few_attempts(spark):
    given = messages(spark, [(i % 3, i, "{}", "t") for i in range(2_000)] + [(1, 7, "{}", None)] * 2).persist()
    wrong, sizes = {5, 700, 1_999}, []

    def odd(part):
        found = [r["offset"] for r in part.select("offset").collect()]
        sizes.append(len(found))
        if wrong & set(found):
            part.select(F.raise_error("odd")).write.format("noop").mode("overwrite").save()

    good, bad = isolate(given, odd)
    assert {r["offset"] for r in bad.collect()} == wrong and good.count() == 1_999
    assert good.where("source IS NULL").count() == 2
    assert len(sizes) <= 20 * len(wrong) + 1
    given.unpersist()


def test_poison_in_curate_goes_to_the_quarantine(spark, prefix):
    curate = "SELECT id, CAST(id AS int) AS n FROM {curate_prod}"
    plan = make_plan(spark, prefix, raw_tags=(RawTag("prod", StructType.fromDDL("id string"), None, curate, on_error="quarantine"),), gold_tags=(), insert_only=())
    given = messages(spark, [(0, i, f'{{"id":"{t}"}}', "t") for i, t in enumerate(["1", "x", "3", "x"])] + [(1, 1, BODY, "t")])
    load_batch(given, "b-0", plan, keep_progress=False)
    assert rows(plan.curated("prod").read(spark)) == [("1", "1"), ("3", "3")]
    assert rows(plan.quarantine.read(spark).select("offset")) == [(1,), (3,)]
