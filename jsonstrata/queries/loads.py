"""Queries that write tables or run streams and return what was loaded."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from jsonstrata.operators.gold import insert_only
from jsonstrata.operators.quality import standardise
from jsonstrata.plans.layers import load_batch
from jsonstrata.plans.spec import GoldTag, LoadPlan, RawTag
from jsonstrata.queries.frames import (
    EVENT_SCHEMA,
    Query,
    event_messages,
    event_time_text,
    local,
    one_file_each,
    table,
)
from jsonstrata.session import shared_folder
from jsonstrata.sinks.signals import archive_payloads, completion_event
from jsonstrata.sinks.tables import BatchTable
from jsonstrata.sources.dropdir import read_drop_stream
from jsonstrata.sources.messages import as_messages
from jsonstrata.streaming.runner import start_load


def new_prefix() -> str:
    """A database prefix of its own for each run, so that runs do not meet."""
    return f"q{uuid.uuid4().hex[:12]}_"


def new_table(spark: SparkSession, name: str) -> BatchTable:
    database = f"{new_prefix()}tables"
    folder = shared_folder(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
    return BatchTable(f"{database}.{name}", f"{folder}/{name}")


def raw_payload_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    messages = as_messages(events, F.lit(0), F.col("event_id"), F.col("props"))
    written = archive_payloads(messages, shared_folder(spark), "b-0")
    return spark.read.text(written).withColumnRenamed("value", "json")


def layer_table_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, each written twice: the second time replaces the first."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    target = new_table(spark, "orders")
    first, second = orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'")
    for batch_id, rows in [("b-0", first), ("b-1", second), ("b-0", first), ("b-1", second)]:
        target.write(rows, batch_id)
    return target.read(spark)


def curated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    target = new_table(spark, "lines")
    target.write(standardise(lines), "b-0")
    return target.read(spark)


def gold_insert_only_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are loaded first. All orders then arrive twice with a new status, and that
    batch is run again: loaded ids keep their row, the others are added once."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        event_time_text(F.col("o_orderdate")).alias("EVNT_TS"),
    )
    target = new_table(spark, "orders")
    later = orders.withColumn("status", F.lit("N"))
    incoming = later.unionByName(later)
    target.create(spark, insert_only(orders, orders, "id").schema)
    for batch_id, rows in [("b-0", orders.where("status = 'F'")), ("b-1", incoming), ("b-1", incoming)]:
        known = target.read(spark, without_batch=batch_id)
        target.write(insert_only(rows, known, "id"), batch_id)
    return target.read(spark).select("id", "status", local(F.col("EVNT_TS")).alias("event_ts"))


def completion_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A signal per loaded table; the clock value in its name is masked."""
    events = []
    for name, key in [("orders", "o_orderkey"), ("customer", "c_custkey"), ("lineitem", "l_orderkey")]:
        loaded = new_table(spark, name).write(table(spark, sf_dir, name).select(key), "b-0")
        events.append(completion_event(spark, "RAW_CURPIT", name, "b-0", loaded, "ready_"))
    signals = events[0].unionByName(events[1]).unionByName(events[2])
    return signals.select(
        F.col("rows"),
        F.col("signal_text"),
        F.regexp_replace("signal_name", r"\.d\d{17}\.", ".d<time>.").alias("signal_name"),
    )


def watermark_skip_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first batch holds the messages up to the middle offset, a second one all messages again.
    Stored progress keeps the second from loading the first's messages twice."""
    messages = event_messages(spark, sf_dir)
    span = messages.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).first()
    middle = (span["lo"] + span["hi"]) // 2
    plan = LoadPlan(
        root=shared_folder(spark),
        raw_tags=(
            RawTag(
                "events",
                EVENT_SCHEMA,
                "SELECT event_id, event_type, EVNT_TS, user_id, value FROM {events}",
                "SELECT event_type FROM {curate_events}",
            ),
        ),
        raw_etl_columns="event_id, event_type, EVNT_TS",
        database_prefix=new_prefix(),
    )
    load_batch(messages.where(F.col("offset") <= middle), "b-0", plan, keep_progress=True)
    load_batch(messages, "b-1", plan, keep_progress=True)
    return plan.raw("events").read(spark).select(
        "event_id", "event_type", "user_id", "value", local(F.col("EVNT_TS")).alias("event_ts")
    )


ORDER_SCHEMA = StructType(
    [
        StructField(
            "_extract_purchase",
            StructType(
                [
                    StructField("_extract_key", LongType()),
                    StructField("_extract_customer", LongType()),
                ]
            ),
        ),
        StructField("_extract_status", StringType()),
        StructField("EVNT_TS", StringType()),
    ]
)


def _order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order per message. Low priority ones are broken, pending ones hold only a time."""
    purchase = F.struct(
        F.col("o_orderkey").alias("_extract_key"), F.col("o_custkey").alias("_extract_customer")
    )
    filled = F.col("o_orderstatus") != "P"
    document = F.struct(
        F.when(filled, purchase).alias("_extract_purchase"),
        F.when(filled, F.concat(F.lit(" "), F.lower("o_orderstatus"))).alias("_extract_status"),
        event_time_text(F.col("o_orderdate")).alias("EVNT_TS"),
    )
    broken = F.concat(F.lit("broken "), F.col("o_orderkey").cast("string"))
    text = F.when(F.col("o_orderpriority") == "5-LOW", broken).otherwise(F.to_json(document))
    return as_messages(
        table(spark, sf_dir, "orders"), F.lit(0), F.col("o_orderkey"), text, F.lit("orders")
    )


def e2e_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of the same orders through every layer; rows per table and status."""
    plan = LoadPlan(
        root=shared_folder(spark),
        raw_tags=(
            RawTag(
                "orders",
                ORDER_SCHEMA,
                "SELECT purchase.key AS order_key, purchase.customer AS customer_key, status, EVNT_TS"
                " FROM {orders}",
                "SELECT status, customer_key FROM {curate_orders}",
                audit_keys=("order_key",),
            ),
        ),
        gold_tags=(
            GoldTag(
                "orders",
                ORDER_SCHEMA,
                "SELECT purchase.key AS order_key, status, EVNT_TS FROM {orders}",
                audit_keys=("order_key",),
            ),
            GoldTag(
                "customers",
                ORDER_SCHEMA,
                "SELECT purchase.customer AS customer_key FROM {customers}",
                id_column="customer_key",
                audit_keys=("customer_key",),
            ),
        ),
        insert_only="customers",
        database_prefix=new_prefix(),
    )
    messages = _order_messages(spark, sf_dir)
    for batch_id in ("b-0", "b-1", "b-1"):
        load_batch(messages, batch_id, plan, keep_progress=False)

    def counted(layer: str, rows: DataFrame, name, status) -> DataFrame:
        groups = rows.groupBy(name.alias("table_name"), status.alias("status"))
        return groups.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), "table_name", "status", "rows"
        )

    loaded = F.lit("loaded")
    parts = [
        counted("raw", plan.raw("orders").read(spark), F.lit("orders"), loaded),
        counted("curated", plan.curated("orders").read(spark), F.lit("orders"), loaded),
        counted("gold_history", plan.gold("orders").read(spark), F.lit("orders"), loaded),
        counted("gold", plan.gold("customers").read(spark), F.lit("customers"), loaded),
        counted("raw_audit", plan.raw_audit.read(spark), F.col("table_name"), F.col("data_status")),
        counted("gold_audit", plan.gold_audit.read(spark), F.col("table_name"), F.col("data_status")),
        counted("quarantine", plan.quarantine.read(spark), F.col("tag"), F.col("layer")),
        counted("events", plan.load_events.read(spark), F.col("tag"), F.col("layer")),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


PAGE_SCHEMA = StructType(
    [
        StructField("_extract_page_id", LongType()),
        StructField("_extract_url", StringType()),
        StructField("_extract_html", StringType()),
        StructField("_extract_delivery", StringType()),
        StructField("EVNT_TS", StringType()),
    ]
)


def drop_pages(spark: SparkSession, sf_dir: str, directory: str, delivery: str) -> None:
    """Write one JSON file per page; the pages are dealt out evenly."""
    document = F.struct(
        F.col("page_id").alias("_extract_page_id"),
        F.col("url").alias("_extract_url"),
        F.col("html").alias("_extract_html"),
        F.lit(delivery).alias("_extract_delivery"),
        F.lit("2024-01-01 00:00:07.179-06:00").alias("EVNT_TS"),
    )
    pages = table(spark, sf_dir, "pages").select(F.to_json(document).alias("value"))
    spread = pages.repartition(spark.sparkContext.defaultParallelism)
    one_file_each(spread, directory)


def _page_plan(spark: SparkSession, root: str) -> LoadPlan:
    return LoadPlan(
        root=root,
        raw_tags=(RawTag("pages", PAGE_SCHEMA, None, "SELECT page_id, url FROM {curate_pages}"),),
        gold_tags=(GoldTag("page_ids", PAGE_SCHEMA, None, id_column="page_id"),),
        insert_only="page_ids",
        database_prefix=new_prefix(),
    )


def _load_dropped(spark: SparkSession, root: str, plan: LoadPlan) -> None:
    files = read_drop_stream(spark, f"{root}/incoming", suffix=".txt", max_files=100_000)
    query = start_load(
        files, plan, f"{root}/checkpoint", keep_progress=False, poll_interval=None
    )
    query.awaitTermination()


def stream_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages dropped as files and loaded by a stream, which is then started a second time."""
    root = shared_folder(spark)
    plan = _page_plan(spark, f"{root}/layers")
    drop_pages(spark, sf_dir, f"{root}/incoming", "first")
    _load_dropped(spark, root, plan)
    _load_dropped(spark, root, plan)
    return plan.raw("pages").read(spark).select(
        "page_id", "url", "html", local(F.col("EVNT_TS")).alias("event_ts")
    )


def stream_gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of the same pages: the insert-only table keeps the first body of each."""
    root = shared_folder(spark)
    plan = _page_plan(spark, f"{root}/layers")
    for delivery in ("first", "second"):
        drop_pages(spark, sf_dir, f"{root}/incoming", delivery)
        _load_dropped(spark, root, plan)
    return plan.gold("page_ids").read(spark).select("page_id", "url", "delivery")


_GOOD = "o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'"
_EMPTY = "o_orderpriority <> '5-LOW' AND o_orderstatus = 'P'"
_BAD = "o_orderpriority = '5-LOW'"


def _count(layer: str, name: str, status: str, rows: str) -> str:
    return (
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, '{status}' AS status,"
        f' CAST(({rows}) AS BIGINT) AS "rows"'
    )


_E2E = " UNION ALL ".join(
    [
        _count("raw", "orders", "loaded", f"SELECT 2 * count(*) FROM orders WHERE {_GOOD}"),
        _count(
            "curated",
            "orders",
            "loaded",
            "SELECT 2 * count(*) FROM (SELECT DISTINCT o_orderstatus, o_custkey FROM orders"
            f" WHERE {_GOOD})",
        ),
        _count("gold_history", "orders", "loaded", f"SELECT 2 * count(*) FROM orders WHERE {_GOOD}"),
        _count("gold", "customers", "loaded", f"SELECT count(DISTINCT o_custkey) FROM orders WHERE {_GOOD}"),
        _count("raw_audit", "orders", "YES", f"SELECT 2 * count(*) FROM orders WHERE {_GOOD}"),
        _count("raw_audit", "orders", "NO", f"SELECT 2 * count(*) FROM orders WHERE {_EMPTY}"),
        _count("gold_audit", "orders", "YES", f"SELECT 2 * count(*) FROM orders WHERE {_GOOD}"),
        _count("gold_audit", "orders", "NO", f"SELECT 2 * count(*) FROM orders WHERE {_EMPTY}"),
        _count(
            "gold_audit", "customers", "YES", f"SELECT count(DISTINCT o_custkey) FROM orders WHERE {_GOOD}"
        ),
        _count("gold_audit", "customers", "NO", f"SELECT 2 * count(*) FROM orders WHERE {_EMPTY}"),
        _count("quarantine", "orders", "RAW_CURPIT", f"SELECT 2 * count(*) FROM orders WHERE {_BAD}"),
        _count("quarantine", "orders", "GOLD_PIT", f"SELECT 2 * count(*) FROM orders WHERE {_BAD}"),
        _count("quarantine", "customers", "GOLD_PIT", f"SELECT 2 * count(*) FROM orders WHERE {_BAD}"),
        _count("events", "orders", "RAW_CURPIT", "SELECT 2"),
        _count("events", "orders", "GOLD_PIT", "SELECT 2"),
    ]
)

CATALOGUE = {
    "raw_payload_archive": Query(raw_payload_archive, "SELECT props AS json FROM events"),
    "layer_table_replay": Query(
        layer_table_replay, "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders"
    ),
    "curated_load": Query(
        curated_load,
        "SELECT DISTINCT upper(trim(l_returnflag)) AS l_returnflag, upper(trim(l_linestatus))"
        " AS l_linestatus, CAST(l_linenumber AS VARCHAR) AS l_linenumber FROM lineitem",
    ),
    "gold_insert_only_load": Query(
        gold_insert_only_load,
        "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'N' END AS status,"
        " o_orderdate AS event_ts FROM orders",
    ),
    "completion_events": Query(
        completion_events,
        " UNION ALL ".join(
            f"SELECT count(*) AS \"rows\", '{t}Table is Loaded' AS signal_text,"
            f" 'ready_{t}.d<time>.trg' AS signal_name FROM {t}"
            for t in ("orders", "customer", "lineitem")
        ),
    ),
    "watermark_skip_loaded": Query(
        watermark_skip_loaded,
        "SELECT event_id, event_type,"
        " CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE user_id END AS user_id,"
        " CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE value END AS value,"
        " date_trunc('milliseconds', ts) AS event_ts FROM events WHERE event_type <> 'error'",
    ),
    "e2e_layers": Query(e2e_layers, _E2E),
    "stream_file_ingest": Query(
        stream_file_ingest,
        "SELECT page_id, url, html, TIMESTAMP '2024-01-01 06:00:07.179' AS event_ts FROM pages",
    ),
    "stream_gold_incremental": Query(
        stream_gold_incremental, "SELECT page_id, url, 'first' AS delivery FROM pages"
    ),
}
