"""Published batches, joined batches, bucketed tables and filters of ids."""

import pytest
from pyspark.sql import functions as F

from fixtures import BODY, PROD_SCHEMA, messages, rows
from jsonstrata.operators.gold import rows_not_in_buckets
from jsonstrata.operators.membership import Buckets, id_filter, may_hold, merged
from jsonstrata.plans import layers
from jsonstrata.plans.layers import load_batch
from jsonstrata.plans.spec import GoldTag, LoadPlan
from jsonstrata.session import shared_folder
from jsonstrata.sinks import files
from jsonstrata.sinks.commits import CommitLog
from jsonstrata.sinks.tables import BatchTable
from test_load import make_plan, snapshot

MORE = [(0, 4, BODY, "t"), (1, 2, '{"_extract_id":"B9"}', "t"), (2, 9, "broken", "t")]


def test_nothing_is_seen_before_all_tables_are_written(spark, prefix, monkeypatch):
    plan = make_plan(spark, prefix)
    load_batch(messages(spark), "b-0", plan, keep_progress=True)
    before = snapshot(spark, plan)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", fail)
        with pytest.raises(RuntimeError):
            load_batch(messages(spark, MORE), "b-1", plan, keep_progress=True)
    assert snapshot(spark, plan) | {plan.watermarks.table.name: 0} == before | {plan.watermarks.table.name: 0}
    assert plan.raw("prod").read(spark, only_batch="b-1").count() == 3
    # Progress that was stored and never published does not count, so another batch loads the messages.
    assert {r["offset"] for r in plan.watermarks.read(spark).where("partition = 1").collect()} == {1}
    load_batch(messages(spark, MORE), "b-2", plan, keep_progress=True)
    assert plan.raw("prod").read(spark).count() == 6 + 3
    assert {r["offset"] for r in plan.watermarks.read(spark).where("partition = 1").collect()} == {2}


def test_joined_batches_survive_a_replay(spark, prefix):
    plan = make_plan(spark, prefix)
    load_batch(messages(spark), "b-0", plan, keep_progress=True)
    load_batch(messages(spark, MORE), "b-1", plan, keep_progress=True)
    load_batch(messages(spark, [(5, 1, '{"_extract_id":"C"}', "t")]), "b-2", plan, keep_progress=True)
    before = snapshot(spark, plan)
    plan.compact(spark, ["b-0", "b-1"], "day-1")
    assert snapshot(spark, plan) == before
    for batch, given in [("b-0", messages(spark)), ("b-1", messages(spark, MORE))]:
        load_batch(given, batch, plan, keep_progress=True)
        assert snapshot(spark, plan) == before
    # A joined part is joined up again, and the call is repeated.
    for _ in range(2):
        plan.compact(spark, ["day-1", "b-2"], "month-1")
    assert snapshot(spark, plan) == before and plan.commits.parts(spark) == ["month-1"]
    assert plan.commits.holds(spark, "b-1") and not plan.commits.holds(spark, "b-9")
    load_batch(messages(spark), "b-0", plan, keep_progress=True)
    assert snapshot(spark, plan) == before
    folders = files.names(spark, plan.raw("prod").path)
    assert [n for n in folders if n.startswith("_batch_id")] == ["_batch_id=month-1"]
    with pytest.raises(ValueError, match="not published"):
        plan.compact(spark, ["b-7"], "day-7")


def test_one_table_joined_up_alone_survives_a_replay(spark, prefix):
    plan = make_plan(spark, prefix)
    load_batch(messages(spark), "b-0", plan, keep_progress=False)
    before = snapshot(spark, plan)
    for _ in range(2):
        plan.raw("prod").compact(spark, ["b-0"], "day-1")
    load_batch(messages(spark), "b-0", plan, keep_progress=False)
    assert snapshot(spark, plan) == before
    assert plan.commits.parts(spark) == ["b-0"] and plan.commits.parts(spark, plan.raw("prod").name) == ["day-1"]


def test_commit_log(spark):
    log = CommitLog(f"{shared_folder(spark)}/commits")
    assert log.parts(spark) == [] and not log.holds(spark, "a")
    for batch in ("a", "b", "c", "a"):
        log.commit(spark, batch)
    assert log.parts(spark) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="cannot name"):
        log.commit(spark, "../a")
    log.replace(spark, ["a", "b"], "d", "one")
    assert log.parts(spark, "one") == ["c", "d"] and log.parts(spark, "two") == ["a", "b", "c"]


def _target(spark, prefix, buckets, ids_by_batch, cells):
    folder = shared_folder(spark)
    spark.sql(f"CREATE DATABASE {prefix}db LOCATION '{folder}'")
    target = BatchTable(f"{prefix}db.t", f"{folder}/t", buckets=buckets)
    filters = BatchTable(f"{prefix}db.f", f"{folder}/f")
    for i, ids in enumerate(ids_by_batch):
        part = spark.createDataFrame([(x, f"old {x}") for x in ids], "id long, name string")
        target.write(part, f"b-{i}")
        filters.write(id_filter(part, "id", cells), f"b-{i}")
    return target, filters


def test_scan_opens_the_buckets_of_the_batch_alone(spark, prefix):
    buckets = Buckets("id", 32)
    target, filters = _target(spark, prefix, buckets, [range(0, 3000), range(3000, 6000), [None, 7]], 4)
    assert target.read(spark).count() == 6002
    asked = []

    def read(some):
        asked.append(sorted(some))
        return target.read(spark, in_buckets=some)

    batch = spark.createDataFrame([(5, "a"), (5, "a"), (6001, "b"), (None, "c")], "id long, name string")
    got = rows_not_in_buckets(batch, read, buckets)
    assert rows(got) == [(6001, "b"), (None, "c")]
    opened = target.read(spark, in_buckets=asked[0]).inputFiles()
    every = target.read(spark).inputFiles()
    assert len(asked[0]) <= 2 and len(opened) <= len(every) / 10
    assert all(any(f"/_bucket={b}/" in f for b in asked[0]) for f in opened)
    # The plan names the buckets as partitions, so Spark does not list the others.
    plan = target.read(spark, in_buckets=asked[0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan
    # With filters only ids that may be in the table are looked for.
    asked.clear()
    got = rows_not_in_buckets(batch, read, buckets, filters=filters.read(spark), cells=4)
    assert rows(got) == [(6001, "b"), (None, "c")] and len(asked[0]) <= 2
    asked.clear()
    new = spark.createDataFrame([(10**9 + i, "x") for i in range(20)], "id long, name string")
    assert rows_not_in_buckets(new, read, buckets, filters=filters.read(spark), cells=4).count() == 20
    assert sum(map(len, asked)) <= 3


def test_filters_have_no_false_negatives_and_merge(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "k")
    one, two = id_filter(ids.where("k % 2 = 0"), "k", 8), id_filter(ids.where("k % 2 = 1"), "k", 8)
    both = one.unionByName(two)
    assert may_hold(ids, both, "k", 8).count() == 20_000
    assert rows(merged(both).select("cell", F.md5("bits"))) == rows(id_filter(ids, "k", 8).select("cell", F.md5("bits")))
    other = spark.range(10**6, 10**6 + 20_000).withColumnRenamed("id", "k")
    assert 0 < may_hold(other, both, "k", 8).count() < 2_000
    names = spark.createDataFrame([("a",), ("é",), ("c",)], "k string")
    assert rows(may_hold(names, id_filter(names.where("k <> 'c'"), "k", 8), "k", 8)) == [("a",), ("é",)]
    assert id_filter(names.where("false"), "k", 8).count() == 0


def test_bucketed_load_equals_the_plain_one(spark, prefix):
    tag = GoldTag("prod_id", PROD_SCHEMA, "SELECT id, name, EVNT_TS FROM {prod_id}", "id", ("id",))
    found = []
    for i, options in enumerate([{}, {"buckets": 4}, {"buckets": 4, "filter_cells": 2}]):
        gold = GoldTag(tag.name, tag.schema, tag.transform, tag.id_column, tag.audit_keys, **options)
        plan = make_plan(spark, f"{prefix}{i}", raw_tags=(), gold_tags=(gold,))
        for batch, given in [("b-0", None), ("b-1", MORE), ("b-1", MORE), ("b-2", MORE)]:
            load_batch(messages(spark, given), batch, plan, keep_progress=False)
        plan.compact(spark, ["b-0", "b-1"], "day-1")
        load_batch(messages(spark, MORE), "b-3", plan, keep_progress=False)
        found.append(rows(plan.gold("prod_id").read(spark).select("id", "name", "EVNT_TS")))
        assert layers.load_batch is load_batch
    assert found[0] == found[1] == found[2] and len(found[0]) == 4


def test_bucket_settings_are_checked():
    with pytest.raises(ValueError, match="not insert-only"):
        LoadPlan("/x", gold_tags=(GoldTag("a", PROD_SCHEMA, buckets=4),))
    with pytest.raises(ValueError, match="needs buckets"):
        LoadPlan("/x", gold_tags=(GoldTag("a", PROD_SCHEMA, None, "id", filter_cells=4),), insert_only="a")
