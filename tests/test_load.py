import pytest
from pyspark.sql import functions as F

from fixtures import BODY, FLATTEN, PROD_SCHEMA, messages, rows
from jsonstrata.plans import layers
from jsonstrata.plans.layers import load_batch
from jsonstrata.plans.spec import GoldTag, LoadPlan, RawTag
from jsonstrata.session import shared_folder
from jsonstrata.streaming.runner import resume_offsets


def make_plan(spark, prefix, **changes):
    settings = dict(
        root=shared_folder(spark),
        raw_tags=(
            RawTag(
                "prod",
                PROD_SCHEMA,
                FLATTEN,
                "SELECT id, name, code FROM {curate_prod}",
                audit_keys=("id",),
            ),
        ),
        gold_tags=(
            GoldTag("prod", PROD_SCHEMA, "SELECT id, name, EVNT_TS FROM {prod}", None, ("id",)),
            GoldTag("prod_id", PROD_SCHEMA, "SELECT id, name, EVNT_TS FROM {prod_id}", "id", ("id",)),
        ),
        insert_only="prod_id",
        database_prefix=prefix,
    )
    return LoadPlan(**(settings | changes))


def snapshot(spark, plan):
    """All rows of all tables, without clock values."""
    found = {}
    for table, columns in [
        (plan.raw("prod"), ["id", "name", "EVNT_TS", "code", "qty"]),
        (plan.curated("prod"), ["id", "name", "code"]),
        (plan.gold("prod"), ["id", "name", "EVNT_TS"]),
        (plan.gold("prod_id"), ["id", "name", "EVNT_TS"]),
        (plan.raw_audit, ["record_key", "data_status", "table_name"]),
        (plan.gold_audit, ["record_key", "data_status", "table_name"]),
        (plan.quarantine, ["layer", "tag", "partition", "offset", "json", "reason"]),
        (plan.load_events, ["layer", "tag", "rows", "signal_text"]),
        (plan.batch_metrics, ["messages", "resolved", "payload_chars"]),
        (plan.watermarks.table, ["layer", "tag", "partition", "offset"]),
    ]:
        found[table.name] = rows(table.read(spark).select(*columns))
    return found


def test_one_batch_fills_every_layer(spark, prefix):
    plan = make_plan(spark, prefix)
    load_batch(messages(spark), "b-0", plan, keep_progress=True)
    raw = plan.raw("prod").read(spark)
    assert raw.schema["EVNT_TS"].dataType.simpleString() == "timestamp"
    assert raw.count() == 6  # two copies of A1 with two items each, A2 and A3
    assert rows(plan.curated("prod").read(spark)) == [
        ("A1", "GOLD", "X"),
        ("A1", "GOLD", "Y"),
        ("A2", None, None),
        ("A3", None, None),
    ]
    assert sorted(r[0] for r in rows(plan.gold("prod").read(spark))) == ["A1", "A2", "A3"]
    assert sorted(r[0] for r in rows(plan.gold("prod_id").read(spark))) == ["A1", "A2", "A3"]
    audit = plan.raw_audit.read(spark).groupBy("table_name", "data_status").count()
    assert rows(audit) == [("prod", "NO", 1), ("prod", "YES", 6)]
    bad = plan.quarantine.read(spark).select("layer", "json", "partition")
    assert rows(bad) == [
        ("GOLD_PIT", "not json", 2),
        ("GOLD_PIT", "not json", 2),
        ("RAW_CURPIT", "not json", 2),
    ]
    events = plan.load_events.read(spark)
    assert rows(events.select("layer", "tag", "rows", "signal_text")) == [
        ("GOLD_PIT", "prod", 3, "prodTable is Loaded"),
        ("RAW_CURPIT", "prod", 6, "prodTable is Loaded"),
    ]
    assert events.where(~F.col("signal_name").rlike(r"^prod\.d\d{17}\.trg$")).count() == 0
    assert spark.read.text(plan.archive_directory).count() == 6


def test_replayed_batch_changes_nothing(spark, prefix):
    plan = make_plan(spark, prefix)
    assert resume_offsets(spark, plan, "t", 4) is None
    load_batch(messages(spark), "b-0", plan, keep_progress=True)
    assert resume_offsets(spark, plan, "t", 5) == (
        '{"t": {"0": 4, "1": 2, "2": 2, "3": 3000000001, "4": -2}}'
    )
    more = messages(spark, [(0, 4, BODY, "t"), (1, 2, '{"_extract_id":"B9"}', "t"), (0, 2, BODY, "t")])
    load_batch(more, "b-1", plan, keep_progress=True)
    before = snapshot(spark, plan)
    load_batch(more, "b-1", plan, keep_progress=True)
    assert snapshot(spark, plan) == before
    # Offset 2 of partition 0 had been loaded by the first batch.
    raw = plan.raw("prod").read(spark, only_batch="b-1")
    assert rows(raw.groupBy("id").count()) == [("A1", 2), ("B9", 1)]
    # A1 exists in the insert-only table, so only B9 is new.
    new = plan.gold("prod_id").read(spark, only_batch="b-1")
    assert [r[0] for r in rows(new)] == ["B9"]


@pytest.mark.parametrize("fail_at", ["load_gold_tag", "completion_event", "audit_rows"])
def test_batch_that_failed_midway_converges(spark, prefix, monkeypatch, fail_at):
    whole = make_plan(spark, prefix + "w")
    broken = make_plan(spark, prefix + "b")
    load_batch(messages(spark), "b-0", whole, keep_progress=True)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(layers, fail_at, fail)
        with pytest.raises(RuntimeError):
            load_batch(messages(spark), "b-0", broken, keep_progress=True)
    load_batch(messages(spark), "b-0", broken, keep_progress=True)
    assert list(snapshot(spark, broken).values()) == list(snapshot(spark, whole).values())


def test_parallel_tags_give_the_same_tables(spark, prefix):
    one = make_plan(spark, prefix + "s", parallel_tags=1, parallel_writes=1)
    many = make_plan(spark, prefix + "p", parallel_tags=3, parallel_writes=3)
    load_batch(messages(spark), "b-0", one, keep_progress=True)
    load_batch(messages(spark), "b-0", many, keep_progress=True)
    assert list(snapshot(spark, one).values()) == list(snapshot(spark, many).values())


def test_empty_batch_and_sample(spark, prefix):
    plan = make_plan(spark, prefix)
    load_batch(messages(spark, []), "b-0", plan, keep_progress=True)
    assert plan.raw("prod").read(spark).count() == 0
    load_batch(messages(spark), "b-1", plan, keep_progress=True, sample=2)
    assert plan.batch_metrics.read(spark, only_batch="b-1").first()["messages"] == 2
    assert plan.watermarks.read(spark).count() == 0
    assert spark.read.text(plan.archive_directory).count() == 0


def test_overwrite_mode_keeps_the_last_batch(spark, prefix):
    plan = make_plan(spark, prefix, raw_mode="overwrite", curated_mode="overwrite")
    load_batch(messages(spark), "b-0", plan, keep_progress=True)
    load_batch(messages(spark, [(7, 1, '{"_extract_id":"Z"}', "t")]), "b-1", plan, keep_progress=True)
    assert [r[0] for r in rows(plan.raw("prod").read(spark))] == ["Z"]
    assert rows(plan.curated("prod").read(spark)) == [("Z", None, None)]


def test_new_session_finds_the_tables_again(spark, prefix):
    plan = make_plan(spark, prefix)
    load_batch(messages(spark), "b-0", plan, keep_progress=True)
    before = snapshot(spark, plan)
    # A catalog that forgot the tables, as with a new application and no metastore.
    for layer in ("raw", "curated", "gold", "gold_history", "work"):
        for table in spark.catalog.listTables(plan.database(layer)):
            spark.sql(f"DROP TABLE {plan.database(layer)}.{table.name}")
    more = messages(spark, [(0, 2, BODY, "t")])
    load_batch(more, "b-1", plan, keep_progress=True)
    after = snapshot(spark, plan)
    assert after[plan.raw("prod").name] == before[plan.raw("prod").name]
    assert after[plan.watermarks.table.name] != []


def test_plan_checks():
    with pytest.raises(ValueError, match="without a definition"):
        LoadPlan("/x", insert_only="nope")
    with pytest.raises(ValueError, match="id column"):
        LoadPlan("/x", gold_tags=(GoldTag("a", PROD_SCHEMA),), insert_only="a")
    # Exact membership: a name inside another one does not count.
    plan = LoadPlan(
        "/x",
        gold_tags=(GoldTag("pln", PROD_SCHEMA), GoldTag("pln_covrg", PROD_SCHEMA, None, "id")),
        insert_only="'pln_covrg' ",
    )
    assert plan.gold("pln").name == "gold_history.pln"
    assert plan.gold("pln_covrg").name == "gold.pln_covrg"
