"""Joins with one key owning a third of the rows, and with broadcasts ruled out."""

import pytest
from pyspark.sql import functions as F

from fixtures import rows
from jsonstrata.operators.gold import insert_only, rows_not_in_target
from jsonstrata.operators.progress import after_watermark
from jsonstrata.operators.skew import (
    JoinLimits,
    KeyProfile,
    fits_broadcast,
    hot_keys,
    key_profile,
    salted_join,
)
from jsonstrata.sources.envelopes import resolve_claim_checks

TIGHT = JoinLimits(broadcast_rows=2, rows_per_split=50, max_hot_keys=5, max_splits=4)


def skewed(spark, n=900):
    """A third of the rows has key 0, a third no key, the others have keys 1 to 99."""
    key = F.expr("CASE id % 3 WHEN 0 THEN 0 WHEN 1 THEN null ELSE 1 + id % 99 END")
    return spark.range(n).select(key.alias("k"), F.col("id").alias("row"))


def test_fits_broadcast(spark):
    keys = spark.range(10).select(F.col("id").cast("string"))
    assert fits_broadcast(keys, JoinLimits(broadcast_rows=10))
    assert not fits_broadcast(keys, JoinLimits(broadcast_rows=9))
    assert not fits_broadcast(keys, JoinLimits(broadcast_bytes=9))
    assert fits_broadcast(keys.where("false"), JoinLimits(broadcast_rows=0))


def test_key_profile(spark):
    assert key_profile(skewed(spark), "k") == KeyProfile(34, 1 + 3 + 30 * 2, 300)
    assert key_profile(skewed(spark).where("false"), "k") == KeyProfile(0, 0, 0)
    assert not KeyProfile(34, 64, 300).fits(TIGHT)


def test_hot_keys_are_bounded(spark):
    assert rows(hot_keys(skewed(spark), "k", TIGHT)) == [(0, 4)]
    loose = JoinLimits(rows_per_split=1, max_hot_keys=3)
    assert hot_keys(skewed(spark), "k", loose).count() == 3


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    left = skewed(spark)
    right = spark.range(0, 60, 2).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    plain = left.join(right, "k", how)
    salted = salted_join(left, right, "k", how, ["row"], TIGHT)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_salted_join_divides_hot_and_null_keys(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    seen = salted_join(
        skewed(spark),
        spark.range(1).select(F.col("id").alias("k")),
        "k",
        "left",
        ["row"],
        TIGHT,
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = seen._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(k" in plan and "_salt" in plan
        sizes = seen.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 300  # no task holds a whole third
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


@pytest.mark.parametrize("limits", [JoinLimits(), TIGHT], ids=["broadcast", "shuffled"])
def test_watermark_filter_on_one_large_partition(spark, limits):
    messages = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).cast("int").alias("partition"),
        F.col("id").alias("offset"),
    )
    latest = spark.createDataFrame([(0, 300), (1, 100), (2, 599)], "partition int, offset bigint")
    want = [
        r
        for r in rows(messages)
        if r[1] > {0: 300, 1: 100, 2: 599}.get(r[0], -1)
    ]
    assert rows(after_watermark(messages, latest, limits)) == want


EVEN = JoinLimits(broadcast_rows=2)


@pytest.mark.parametrize("limits", [JoinLimits(), EVEN, TIGHT], ids=["broadcast", "even", "salted"])
def test_insert_only_with_hot_ids_and_copies(spark, limits):
    incoming = skewed(spark).select(
        F.col("k").cast("string").alias("id"),
        (F.col("row") % 200).alias("body"),
        F.create_map(F.lit("a"), F.lit(1)).alias("m"),
    )
    copies = incoming.unionByName(incoming)
    target = spark.range(1000).select((F.col("id") % 40).cast("string").alias("id"))
    want = sorted(
        {(r["id"], r["body"]) for r in incoming.collect() if r["id"] is None or int(r["id"]) >= 40},
        key=repr,
    )
    got = insert_only(copies, target, "id", limits=limits)
    assert got.columns == ["id", "body", "m"]
    assert rows(got.select("id", "body")) == want
    # With an empty target, hot ids survive whole.
    none = target.where("false")
    everything = {(r["id"], r["body"]) for r in incoming.collect()}
    assert insert_only(copies, none, "id", limits=limits).count() == len(everything)


def test_target_is_not_shuffled_while_ids_are_few(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.range(1000).select(F.col("id"), F.lit("wide").alias("body")).write.parquet(path)
    target = spark.read.parquet(path)
    got = rows_not_in_target(spark.range(5).toDF("id"), target, "id")
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "ReadSchema: struct<id:bigint>" in scan and "IsNotNull(id)" in scan
    assert "SortMergeJoin" not in plan
    assert got.count() == 0


def test_hot_claim_check(spark):
    envelopes = spark.range(300).select(
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("inline"), F.col("id"))).alias("json"),
        F.lit("t").alias("source"),
        F.expr("CASE id % 3 WHEN 0 THEN null WHEN 1 THEN 'hot' ELSE concat('p', id) END").alias("payload_ref"),
    )
    payloads = spark.range(150).select(
        F.concat(F.lit("p"), F.col("id")).alias("payload_ref"), F.concat(F.lit("text"), "id").alias("payload")
    )
    payloads = payloads.unionByName(spark.createDataFrame([("hot", "HOT")], payloads.schema))
    got = {r["offset"]: r["json"] for r in resolve_claim_checks(envelopes, payloads, TIGHT).collect()}
    want = {}
    for i in range(300):
        want[i] = [f"inline{i}", "HOT", f"text{i}" if i < 150 else None][i % 3]
    assert got == want
