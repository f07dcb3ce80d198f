import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fixtures import rows
from jsonstrata.functions.names import DuplicateNameError, clean_type, split_names, strip_prefix
from jsonstrata.functions.scalars import message_base_name, message_id, parse_event_time


def ddl(spark, text):
    return spark.createDataFrame([], text)


def test_strip_prefix_at_every_depth(spark):
    df = ddl(
        spark,
        "_extract_id string, EVNT_TS string, _extract_items array<struct<_extract_code:string, qty:int>>,"
        " m map<string, struct<_extract_v:bigint>>, deep struct<_extract_a:struct<_extract_b:int>>",
    )
    assert strip_prefix(df).schema.simpleString() == (
        "struct<id:string,EVNT_TS:string,items:array<struct<code:string,qty:int>>,"
        "m:map<string,struct<v:bigint>>,deep:struct<a:struct<b:int>>>"
    )
    assert strip_prefix(strip_prefix(df)).schema == strip_prefix(df).schema


def test_strip_prefix_keeps_values_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, ("x", [("c", 1)]), {"k": (5,)}), (2, None, None), (3, (None, None), {"k": None})],
        "`_extract_a.b` int, s struct<_extract_n:string, l:array<struct<_extract_c:string, q:int>>>,"
        " m map<string, struct<_extract_v:int>>",
    )
    got = strip_prefix(df)
    assert got.columns == ["a.b", "s", "m"]
    assert [r.asDict(True) for r in got.orderBy("`a.b`").collect()] == [
        {"a.b": 1, "s": {"n": "x", "l": [{"c": "c", "q": 1}]}, "m": {"k": {"v": 5}}},
        {"a.b": 2, "s": None, "m": None},
        {"a.b": 3, "s": {"n": None, "l": None}, "m": {"k": None}},
    ]


def test_strip_prefix_collisions(spark):
    for text in ["_extract_id int, id int", "s struct<_extract_a:int, a:int>", "_extract_ID int, id int"]:
        with pytest.raises(DuplicateNameError):
            strip_prefix(ddl(spark, text))
    schema = ddl(spark, "_extract_ID int, id int").schema
    assert clean_type(schema, case_sensitive=True).names == ["ID", "id"]
    with pytest.raises(DuplicateNameError, match="no name"):
        clean_type(StructType().add("_extract_", "integer"))


def test_strip_prefix_lets_the_scan_prune(spark, tmp_path):
    path = str(tmp_path / "nested")
    wide = F.struct(F.col("id").alias("_extract_a"), F.lit("x").alias("_extract_wide"))
    spark.range(3).select(wide.alias("s"), F.lit(1).alias("other")).write.parquet(path)
    plan = strip_prefix(spark.read.parquet(path)).select("s.a")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<s:struct<_extract_a:bigint>>" in text


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-01 00:00:07.179Z", "2024-01-01 00:00:07.179"),
        ("2024-01-01 00:00:07.179-06", "2024-01-01 06:00:07.179"),
        ("2024-01-01 00:00:07.179-0600", "2024-01-01 06:00:07.179"),
        ("2024-01-01 00:00:07.179-06:00", "2024-01-01 06:00:07.179"),
        ("2024-01-01 00:00:07.179+05:30", "2023-12-31 18:30:07.179"),
        ("2024-01-01 00:00:07.17Z", "2024-01-01 00:00:07.17"),
        ("2024-01-01 00:00:07Z", None),
        ("2024-01-01 00:00:07.179575Z", None),
        ("2024-01-01 00:00:07.179", None),
        ("2024-01-01 00:00:07", None),
        ("bad", None),
        ("", None),
        (None, None),
    ],
)
def test_event_time(spark, text, expected):
    df = parse_event_time(spark.createDataFrame([(text,)], "EVNT_TS string"))
    assert df.schema["EVNT_TS"].dataType.simpleString() == "timestamp"
    assert df.select(F.col("EVNT_TS").cast("string")).first()[0] == expected


def test_event_time_passes_other_frames(spark):
    df = spark.createDataFrame([("x",)], "a string")
    assert parse_event_time(df) is df
    assert parse_event_time(ddl(spark, "EVNT_TS timestamp")).schema.simpleString() == (
        "struct<EVNT_TS:timestamp>"
    )
    # The name is matched exactly.
    lower = ddl(spark, "evnt_ts string")
    assert parse_event_time(lower) is lower


def test_split_names():
    assert split_names(" a, 'b' ,\"c\",, ") == ["a", "b", "c"]
    assert split_names(None) == []
    assert split_names(["x ", "y"]) == ["x", "y"]


def test_message_identity(spark):
    paths = [
        ("/in/f0.json",),
        ("/in/f0.json.0a1b2c3d",),
        ("/in/f0.json.0A1B2C3D",),
        ("f0.json.0a1b2c3",),
    ]
    df = spark.createDataFrame(paths, "path string").select(
        message_base_name(F.col("path")).alias("base"),
        message_id(F.col("path"), F.timestamp_millis(F.lit(1700000000123))).alias("id"),
    )
    assert rows(df) == [
        ("f0.json", "hdfs-f0.json-1700000000123"),
        ("f0.json", "hdfs-f0.json-1700000000123"),
        ("f0.json.0A1B2C3D", "hdfs-f0.json.0A1B2C3D-1700000000123"),
        ("f0.json.0a1b2c3", "hdfs-f0.json.0a1b2c3-1700000000123"),
    ]
