import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from fixtures import BODY, PROD_SCHEMA, messages, rows
from jsonstrata.functions.names import strip_prefix
from jsonstrata.operators.audit import audit_rows, audit_summary
from jsonstrata.operators.fanout import fan_out, fan_out_counts
from jsonstrata.operators.gold import history, insert_only
from jsonstrata.operators.metrics import batch_volume, observed_count
from jsonstrata.operators.parse import explode_structs, parse_messages, readable, unreadable
from jsonstrata.operators.progress import (
    advance,
    after_watermark,
    latest_watermarks,
    layer_watermarks,
    start_offsets,
    starting_offsets_option,
)
from jsonstrata.operators.quality import (
    business_columns,
    distinct_rows,
    project,
    split_null_records,
    standardise,
)
from jsonstrata.operators.sqlflow import Stage, StagedFlow, run_staged, transformed

WATERMARKS = [
    ("RAW_CURPIT", "prod", 0, 1),
    ("RAW_CURPIT", "prod", 1, 1),
    ("GOLD_PIT", "prod", 0, 0),
]
WATERMARK_SCHEMA = "layer string, tag string, partition int, offset bigint"


def watermarks(spark, given=None):
    return spark.createDataFrame(WATERMARKS if given is None else given, WATERMARK_SCHEMA)


def test_parse_splits_readable_and_unreadable(spark):
    parsed = parse_messages(messages(spark), PROD_SCHEMA)
    good = strip_prefix(readable(parsed))
    assert good.columns == ["id", "name", "EVNT_TS", "items"]
    assert sorted(r["id"] or "" for r in good.collect()) == ["", "A1", "A1", "A2", "A3"]
    assert rows(unreadable(parsed).drop("reason")) == [("t", 2, 1, "not json")]


def test_parse_of_odd_documents(spark):
    texts = ["", "[]", "null", "42", '{"_extract_id":7}', '{"_extract_items":"x"}', '{"_extract_id":"a"} tail', None]
    parsed = parse_messages(messages(spark, [(0, i, t, "t") for i, t in enumerate(texts)]), PROD_SCHEMA)
    good, bad = readable(parsed).count(), unreadable(parsed).count()
    assert good + bad == len(texts)
    # What is unreadable does not depend on the columns that a query takes.
    kept = {r["offset"] for r in unreadable(parsed).collect()}
    assert {3, 5} <= kept and not kept & {4, 7}
    assert readable(parsed).select("_extract_name").count() == good
    assert {r["offset"] for r in unreadable(parsed.cache()).collect()} == kept
    parsed.unpersist()


def test_parse_array_documents(spark):
    schema = ArrayType(StructType([StructField("a", IntegerType())]))
    data = messages(spark, [(0, 1, '[{"a":1},{"a":2}]', "t"), (0, 2, "[]", "t"), (0, 3, "oops", "t")])
    parsed = parse_messages(data, schema)
    assert rows(readable(parsed)) == [(1,), (2,), (None,)]
    assert rows(unreadable(parsed).select("offset", "json")) == [(3, "oops")]


def test_parse_reads_each_document_once(spark):
    plan = parse_messages(messages(spark), PROD_SCHEMA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_explode_structs_keeps_empty_rows(spark):
    df = strip_prefix(readable(parse_messages(messages(spark), PROD_SCHEMA)))
    got = explode_structs(df.select("id", "items"), "items")
    assert got.columns == ["id", "code", "qty"]
    assert rows(got.where("id in ('A1', 'A2')")) == [
        ("A1", "x", 1),
        ("A1", "x", 1),
        ("A1", "y", 2),
        ("A1", "y", 2),
        ("A2", None, None),
    ]


def test_null_split(spark):
    df = spark.createDataFrame(
        [("A1", "gold", "t", 1), (None, "gold", "t", 1), (None, None, "t", 1)],
        "id string, name string, EVNT_TS string, load_id int",
    )
    etl = "EVNT_TS, 'load_id'"
    assert business_columns(df, etl) == ["id", "name"]
    valid, rejected = split_null_records(df, etl)
    assert (valid.count(), rejected.count()) == (2, 1)
    valid, rejected = split_null_records(df, etl, "any")
    assert (valid.count(), rejected.count()) == (1, 2)
    valid, rejected = split_null_records(df, df.columns)
    assert (valid.count(), rejected.count()) == (0, 3)
    with pytest.raises(ValueError):
        split_null_records(df, etl, "most")


def test_standardise(spark):
    df = spark.createDataFrame(
        [(1, " ab ", True), (1, "AB", True), (2, "\tab", False)], "id bigint, name string, flag boolean"
    )
    got = standardise(df)
    assert {f.dataType.simpleString() for f in got.schema.fields} == {"string"}
    assert rows(got) == [("1", "AB", "TRUE"), ("2", "\tAB", "FALSE")]
    assert rows(standardise(got)) == rows(got)


def test_standardise_and_distinct_on_nested_columns(spark):
    df = spark.createDataFrame(
        [(1, {"k": "v"}, [("a",)]), (1, {"k": "v"}, [("a",)])],
        "id int, m map<string, string>, l array<struct<x:string>>",
    )
    assert rows(standardise(df)) == [("1", '{"K":"V"}', '[{"X":"A"}]')]
    got = distinct_rows(df)
    assert got.schema.simpleString() == df.schema.simpleString()
    assert got.count() == 1


def test_watermark_filter(spark):
    latest = latest_watermarks(watermarks(spark), "RAW_CURPIT", "prod")
    kept = after_watermark(messages(spark), latest)
    assert kept.columns == ["partition", "offset", "json", "source"]
    assert rows(kept.select("partition", "offset")) == [(0, 2), (0, 3), (2, 1), (3, 3000000000)]
    nothing = latest_watermarks(watermarks(spark, []), "RAW_CURPIT", "prod")
    assert after_watermark(messages(spark), nothing).count() == 6
    assert layer_watermarks(watermarks(spark), "GOLD_PIT").count() == 1


def test_advance(spark):
    assert rows(advance(messages(spark), "RAW_CURPIT", "prod")) == [
        ("RAW_CURPIT", "prod", 0, 3),
        ("RAW_CURPIT", "prod", 1, 1),
        ("RAW_CURPIT", "prod", 2, 1),
        ("RAW_CURPIT", "prod", 3, 3000000000),
    ]


def test_start_offsets_follow_the_slowest_tag(spark):
    offsets = start_offsets(watermarks(spark), [("RAW_CURPIT", "prod"), ("GOLD_PIT", "prod")])
    assert rows(offsets) == [(0, 1), (1, -2)]
    text = starting_offsets_option(offsets, "products", 3)
    assert text == '{"products": {"0": 1, "1": -2, "2": -2}}'


def test_insert_only(spark):
    incoming = spark.createDataFrame(
        [("1", "a"), ("2", "b"), ("2", "c"), (None, "d")], "id string, body string"
    )
    target = spark.createDataFrame([("2", "x"), ("3", "y")], "id string, body string")
    assert rows(insert_only(incoming, target, "id")) == [("1", "a"), (None, "d")]
    # De-duplication is over the whole row, so two bodies of one id both stay.
    both = incoming.unionByName(incoming)
    assert rows(insert_only(both, target.where("id = '3'"), "id").where("id = '2'")) == [
        ("2", "b"),
        ("2", "c"),
    ]


def test_history(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01 00:00:07.179Z"), ("1", "2023-12-31 18:00:07.179-06:00")], "id string, EVNT_TS string"
    )
    assert history(df).count() == 1


def test_audit(spark):
    df = spark.createDataFrame([("A", 1), ("B", None)], "id string, v int")
    audit = audit_rows(df, "prod", ["id"], F.col("v").isNotNull())
    assert rows(audit) == [("A", "YES", "prod"), ("B", "NO", "prod")]
    assert rows(audit_summary(audit)) == [("prod", "NO", 1), ("prod", "YES", 1)]


def test_fan_out(spark):
    other = StructType([StructField("qty", IntegerType())])
    data = messages(spark, [(0, 1, BODY, "t"), (0, 2, '{"qty":1}', "t"), (0, 3, "not json", "t")])
    schemas = {"prod": PROD_SCHEMA, "other": other}
    frames = fan_out(data, schemas)
    assert {tag: readable(df).count() for tag, df in frames.items()} == {"prod": 2, "other": 2}
    counts = fan_out_counts(data, schemas, "EVNT_TS")
    assert rows(counts) == [("other", 1, 1, 1), ("prod", 1, 1, 1)]


def test_batch_volume_and_observation(spark, tmp_path):
    data = messages(spark, [(0, 1, "abc", "t"), (0, 2, None, "t")])
    assert rows(batch_volume(data)) == [(2, 1, 3)]
    assert rows(batch_volume(messages(spark, []))) == [(0, 0, 0)]
    counted, seen = observed_count(data.where("offset = 1"), "n")
    counted.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 1}


def test_staged_flow(spark):
    source = spark.createDataFrame([(1, 2), (1, 3), (2, 5)], "k int, v int")
    flow = StagedFlow(
        stages=(
            Stage("sums", "SELECT k, sum(v) AS s FROM {src} GROUP BY k", keep=True),
            Stage("top", "SELECT max(s) AS m FROM {sums}"),
        ),
        final="SELECT sums.k, s = m AS is_top, (SELECT count(*) FROM {src}) AS n FROM {sums} sums, {top}",
    )
    result, kept = run_staged(flow, {"src": source})
    assert rows(result) == [(1, True, 3), (2, True, 3)]
    assert len(kept) == 1 and kept[0].is_cached
    kept[0].unpersist()
    with transformed(flow, {"src": source}) as result:
        assert result.count() == 2
    assert not spark.catalog.listTables()
    with pytest.raises(ValueError, match="hides"):
        run_staged(StagedFlow("SELECT 1", (Stage("src", "SELECT 1 FROM {src}"),)), {"src": source})


def test_two_tags_can_use_the_same_stage_names(spark):
    flow = StagedFlow("SELECT * FROM {step}", (Stage("step", "SELECT k + 1 AS k FROM {src}"),))
    one, _ = run_staged(flow, {"src": spark.range(1).toDF("k")})
    two, _ = run_staged(flow, {"src": spark.range(10, 11).toDF("k")})
    assert (one.first()["k"], two.first()["k"]) == (1, 11)


def test_project_keeps_order(spark):
    assert project(spark.createDataFrame([(1, 2)], "`a b` int, c int"), ["c", "a b"]).columns == ["c", "a b"]
