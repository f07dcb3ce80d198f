"""Queries over published batches, joined batches and insert-only tables that are scanned in part."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from jsonstrata.operators.gold import rows_not_in_buckets
from jsonstrata.operators.membership import Buckets, id_filter
from jsonstrata.plans.layers import load_batch
from jsonstrata.plans.spec import GoldTag, LoadPlan, RawTag
from jsonstrata.queries.frames import EVENT_SCHEMA, Query, event_messages, event_time_text, local, table
from jsonstrata.queries.loads import new_prefix
from jsonstrata.session import shared_folder
from jsonstrata.sinks.tables import BatchTable
from jsonstrata.sources.messages import as_messages

FLATTEN = "SELECT event_id, event_type, user_id, value FROM {events}"
CURATE = "SELECT event_type, user_id FROM {curate_events}"


def _event_plan(root: str, prefix: str, curate: str = CURATE) -> LoadPlan:
    return LoadPlan(
        root=root,
        raw_tags=(RawTag("events", EVENT_SCHEMA, FLATTEN, curate, audit_keys=("event_id",)),),
        raw_etl_columns="event_id, event_type",
        database_prefix=prefix,
    )


def _counted(spark: SparkSession, plan: LoadPlan, step: str) -> DataFrame:
    """Rows that readers see, by table."""
    tables = {"raw": plan.raw("events"), "curated": plan.curated("events"), "audit": plan.raw_audit, "metrics": plan.load_metrics}
    parts = []
    for name, target in tables.items():
        known = spark.catalog.tableExists(target.name)
        rows = target.read(spark) if known else spark.range(0)
        parts.append(rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(step).alias("step"), F.lit(name).alias("name"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def crash_between_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that stops after RAW was written shows nothing; run again it shows every table."""
    root, prefix = shared_folder(spark), new_prefix()
    messages = event_messages(spark, sf_dir)
    stopped = _event_plan(root, prefix, "SELECT CAST(raise_error('lost') AS string) AS event_type, user_id FROM {curate_events}")
    try:
        load_batch(messages, "b-0", stopped, keep_progress=True)
    except PySparkException:
        # RAW is written and belongs to no published batch.
        written = stopped.raw("events").read(spark, only_batch="b-0").count()
    seen = [tuple(r) for r in _counted(spark, stopped, "stopped").collect()]
    plan = _event_plan(root, prefix)
    load_batch(messages, "b-0", plan, keep_progress=True)
    before = spark.createDataFrame([*seen, ("stopped", "raw, draft", written)], "step string, name string, rows bigint")
    return before.unionByName(_counted(spark, plan, "again"))


def compact_then_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, two of them joined up in all tables; then these two are run again."""
    plan = _event_plan(shared_folder(spark), new_prefix())
    messages = event_messages(spark, sf_dir)
    batches = {f"b-{i}": messages.where(F.col("offset") % 3 == i) for i in range(3)}
    for name, rows in batches.items():
        load_batch(rows, name, plan, keep_progress=False)
    plan.compact(spark, ["b-0", "b-1"], "day-1")
    for name in ("b-0", "b-1"):
        load_batch(batches[name], name, plan, keep_progress=False)
    parts = plan.raw("events").read(spark, with_partitions=True).select("_batch_id").distinct()
    return _counted(spark, plan, "joined").unionByName(
        parts.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("joined").alias("step"), F.lit("parts").alias("name"), "rows")
    )


ORDER_SCHEMA = StructType(
    [StructField("id", LongType()), StructField("status", StringType()), StructField("EVNT_TS", StringType())]
)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        event_time_text(F.col("o_orderdate")).alias("EVNT_TS"),
    )


def _as_messages(orders: DataFrame) -> DataFrame:
    document = F.to_json(F.struct("id", "status", "EVNT_TS"))
    return as_messages(orders, F.lit(0), F.col("id"), document, F.lit("orders"))


def gold_bucketed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are loaded into a bucketed table whose ids are kept as filters. All orders then
    arrive twice with a new status, and that batch is run again: loaded ids keep their row."""
    plan = LoadPlan(
        root=shared_folder(spark),
        gold_tags=(GoldTag("orders", ORDER_SCHEMA, id_column="id", buckets=16, filter_cells=64),),
        insert_only="orders",
        database_prefix=new_prefix(),
    )
    orders = _orders(spark, sf_dir)
    later = _as_messages(orders.withColumn("status", F.lit("N")))
    load_batch(_as_messages(orders.where("status = 'F'")), "b-0", plan, keep_progress=False)
    for _ in range(2):
        load_batch(later.unionByName(later), "b-1", plan, keep_progress=False)
    return plan.gold("orders").read(spark).select("id", "status", local(F.col("EVNT_TS")).alias("event_ts"))


def gold_filter_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of all orders against those of a third, in a bucketed table with filters of three
    batches. The filters decide which buckets are opened, the ids found there which rows are new."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    known = orders.where("o_orderkey % 3 = 0").select("o_custkey").distinct()
    buckets, cells = Buckets("o_custkey", 16), 8
    database, folder = f"{new_prefix()}tables", shared_folder(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
    target = BatchTable(f"{database}.customers", f"{folder}/customers", buckets=buckets)
    filters = BatchTable(f"{database}.filters", f"{folder}/filters")
    for i in range(3):
        part = known.where(F.col("o_custkey") % 3 == i)
        target.write(part, f"b-{i}")
        filters.write(id_filter(part, "o_custkey", cells), f"b-{i}")
    return rows_not_in_buckets(
        orders, lambda some: target.read(spark, in_buckets=some), buckets, filters=filters.read(spark), cells=cells
    )


def _rows(step: str, name: str, sql: str) -> str:
    return f"SELECT '{step}' AS step, '{name}' AS name, CAST(({sql}) AS BIGINT) AS \"rows\""


_VALID = "SELECT count(*) FROM events WHERE event_type <> 'error'"
_ALL = "SELECT count(*) FROM events"
_CURATED = (
    "SELECT DISTINCT upper(trim(event_type)), CASE WHEN event_type = 'view' THEN NULL ELSE user_id END{}"
    " FROM events WHERE event_type <> 'error'"
)

CATALOGUE = {
    "crash_between_tables": Query(
        crash_between_tables,
        " UNION ALL ".join(
            [_rows("stopped", n, "SELECT 0") for n in ("raw", "curated", "audit", "metrics")]
            + [
                _rows("stopped", "raw, draft", _VALID),
                _rows("again", "raw", _VALID),
                _rows("again", "curated", f"SELECT count(*) FROM ({_CURATED.format('')})"),
                _rows("again", "audit", _ALL),
                _rows("again", "metrics", "SELECT 1"),
            ]
        ),
    ),
    "compact_then_replay": Query(
        compact_then_replay,
        " UNION ALL ".join(
            [
                _rows("joined", "raw", _VALID),
                _rows("joined", "curated", f"SELECT count(*) FROM ({_CURATED.format(', event_id % 3')})"),
                _rows("joined", "audit", _ALL),
                _rows("joined", "metrics", "SELECT 3"),
                _rows("joined", "parts", "SELECT 2"),
            ]
        ),
    ),
    "gold_bucketed_load": Query(
        gold_bucketed_load,
        "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'N' END AS status,"
        " o_orderdate AS event_ts FROM orders",
    ),
    "gold_filter_anti": Query(
        gold_filter_anti,
        "SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey NOT IN"
        " (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)",
    ),
}
