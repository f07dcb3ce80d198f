import pytest
from pyspark import StorageLevel

from fixtures import PROD_SCHEMA, messages, rows
from jsonstrata.operators.sqlflow import Stage, StagedFlow, run_sql, run_staged
from jsonstrata.plans.files import gold_tag, parse_schema, raw_tag, read_flow, read_text
from jsonstrata.plans.layers import load_batch
from jsonstrata.plans.spec import LoadPlan
from jsonstrata.session import shared_folder

# Statements with plain view names, as existing definitions have them.
FLATTEN = """
select id as _extract_id, name, EVNT_TS, item.code
from prod lateral view outer explode(items) t as item
where name rlike '^.{1,9}$' or name is null
"""
FILES = {
    "prod_incr": PROD_SCHEMA.json(),
    "prod_incr_raw_spark_sql": FLATTEN,
    "prod_curate_sql": "select id, code from curate_prod",
    "prod_incr_gold": (
        "_extract_id string, _extract_name string, EVNT_TS string,"
        " _extract_items array<struct<_extract_code: string, qty: int>>"
    ),
    "prod_incr_gold_sql": "select id, name from prod",
    "stage_items": "select id, explode(items) as item from prod",
    "final": "select i.id, count(*) as items from items i join prod p on p.id = i.id group by i.id",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_schemas(folder, spark):
    assert parse_schema(read_text(spark, f"{folder}/prod_incr")) == PROD_SCHEMA
    assert parse_schema(FILES["prod_incr_gold"]).simpleString() == PROD_SCHEMA.simpleString()
    array = '{"type":"array","elementType":"string","containsNull":true}'
    assert parse_schema(array).simpleString() == "array<string>"


def test_plain_names_are_views_only_while_analysed(spark):
    kept = spark.range(3).toDF("k").persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    got = run_sql("select k + 1 as k from src where cast(k as string) rlike '^.{1}$'", {"src": kept})
    assert not spark.catalog.listTables()
    assert rows(got) == [(1,), (2,), (3,)]
    # The cached data is still there, for the statement and for others.
    assert "InMemory" in kept.where("k > 0")._jdf.queryExecution().executedPlan().toString()
    assert "InMemory" in got._jdf.queryExecution().executedPlan().toString()
    kept.unpersist()
    flow = StagedFlow("select * from b", (Stage("a", "select k * 2 as k from src"), Stage("b", "select k + 1 as k from a")))
    assert rows(run_staged(flow, {"src": spark.range(2).toDF("k")})[0]) == [(1,), (3,)]


def test_definitions_from_files_load_a_batch(spark, prefix, folder):
    flow = read_flow(spark, folder, [("items", "stage_items")], "final")
    plan = LoadPlan(
        root=shared_folder(spark),
        raw_tags=(raw_tag(spark, folder, "prod", ("id",)),),
        gold_tags=(gold_tag(spark, folder, "prod", flows={"prod": flow}),),
        database_prefix=prefix,
    )
    load_batch(messages(spark), "b-0", plan, keep_progress=False)
    assert rows(plan.raw("prod").read(spark).groupBy("id").count()) == [("A1", 4), ("A2", 1), ("A3", 1)]
    assert rows(plan.curated("prod").read(spark)) == [("A1", "X"), ("A1", "Y"), ("A2", None), ("A3", None)]
    assert rows(plan.gold("prod").read(spark)) == [("A1", 8)]
    assert gold_tag(spark, folder, "prod").transform == FILES["prod_incr_gold_sql"]
