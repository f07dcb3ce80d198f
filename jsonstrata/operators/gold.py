"""GOLD rows: insert-only by id, or full history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonstrata.functions.names import free_name, quoted
from jsonstrata.functions.scalars import EVENT_TIME_COLUMN, parse_event_time
from jsonstrata.operators.membership import Buckets, may_hold
from jsonstrata.operators.quality import distinct_rows, has_map, project
from jsonstrata.operators.skew import (
    DEFAULT_LIMITS,
    JoinLimits,
    hot_keys,
    key_profile,
    salted_join,
)


def rows_not_in_target(
    incoming: DataFrame, target: DataFrame, id_column: str, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Distinct incoming rows whose id is absent from the target; rows with a null id stay.

    Copies go first, so the result is the same whichever way the sizes choose below.

    Only the id column of the target is read. While the batch's ids are few enough to broadcast,
    the target is scanned without a shuffle and only ids found in both come back. Beyond that the
    target's distinct ids are shuffled against the incoming rows, which are divided further where
    one id, or the lack of one, has too many rows for a task.
    """
    key = quoted(id_column)
    name = free_name("_id", incoming.columns)
    given, known_id = F.col(key), F.col(name)
    ids = incoming.select(given.alias(name))
    target_ids = target.select(given.alias(name)).where(known_id.isNotNull())
    profile = key_profile(ids, name)
    distinct = distinct_rows(incoming)
    if profile.fits(limits):
        wanted = ids.where(known_id.isNotNull()).distinct()
        # A subset of the incoming ids, so the same bound holds for it.
        known = target_ids.join(F.broadcast(wanted), name, "left_semi").distinct()
        return distinct.join(F.broadcast(known), given == known_id, "left_anti")
    known = target_ids.distinct()
    if profile.largest <= limits.rows_per_split:
        return distinct.join(known, given == known_id, "left_anti")
    rows = distinct.withColumn(name, given)
    spread = [
        F.to_json(quoted(f.name)) if has_map(f.dataType) else F.col(quoted(f.name))
        for f in incoming.schema.fields
    ]
    # Counted with the copies, which needs the id column alone and can only add splits.
    hot = hot_keys(ids, name, limits)
    kept = salted_join(rows, known, name, "left_anti", spread, limits, hot)
    return project(kept, incoming.columns)


def rows_not_in_buckets(
    incoming: DataFrame,
    read: Callable[[list[int]], DataFrame],
    buckets: Buckets,
    limits: JoinLimits = DEFAULT_LIMITS,
    filters: DataFrame | None = None,
    cells: int = 0,
) -> DataFrame:
    """``rows_not_in_target`` for a target divided into ``buckets`` of the id.

    ``read`` gives the target's rows in some buckets. The buckets of the batch's ids come first, at
    most ``buckets.count`` numbers, and the others are not opened. With ``filters`` of the target's
    ids only the buckets of ids that these may hold are.
    """
    key = quoted(buckets.column)
    ids = incoming.where(F.col(key).isNotNull()).select(key).distinct()
    if filters is not None:
        ids = may_hold(ids, filters, buckets.column, cells, limits)
    wanted = [r["bucket"] for r in ids.select(buckets.of().alias("bucket")).distinct().collect()]
    if not wanted:
        return distinct_rows(incoming)
    return rows_not_in_target(incoming, read(wanted), buckets.column, limits)


def insert_only(
    incoming: DataFrame,
    target: DataFrame,
    id_column: str,
    time_column: str = EVENT_TIME_COLUMN,
    limits: JoinLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Distinct rows to add to an insert-only table."""
    timed = parse_event_time(incoming, time_column)
    return project(rows_not_in_target(timed, target, id_column, limits), timed.columns)


def history(incoming: DataFrame, time_column: str = EVENT_TIME_COLUMN) -> DataFrame:
    """Distinct rows to append to a history table."""
    return distinct_rows(parse_event_time(incoming, time_column))
