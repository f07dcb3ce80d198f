"""Joins that hold when one key owns a large share of the rows, and size-checked broadcasts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonstrata.functions.names import free_name


@dataclass(frozen=True)
class JoinLimits:
    """Bounds used by the joins; a side beyond them is shuffled instead of broadcast.

    A hot key gets as many splits as its rows need. ``max_hot_keys`` and ``max_splits`` lower that
    only where a caller sets them.
    """

    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 64 * 1024 * 1024
    rows_per_split: int = 1_000_000
    max_hot_keys: int | None = None
    max_splits: int | None = None


DEFAULT_LIMITS = JoinLimits()


def _splits(rows: Column, limits: JoinLimits) -> Column:
    needed = F.ceil(rows / limits.rows_per_split).cast("int")
    return needed if limits.max_splits is None else F.least(F.lit(limits.max_splits), needed)


def fits_broadcast(keys: DataFrame, limits: JoinLimits = DEFAULT_LIMITS) -> bool:
    """Whether a narrow key frame is within the broadcast bounds: one aggregate, one row back."""
    width = sum((F.octet_length(F.col(c).cast("string")) for c in keys.columns), F.lit(0))
    size = keys.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return size["rows"] <= limits.broadcast_rows and size["bytes"] <= limits.broadcast_bytes


@dataclass(frozen=True)
class KeyProfile:
    """Size of a key column: distinct non-null keys, their bytes, and the rows of the largest
    group, where rows without a key are a group too."""

    keys: int
    bytes: int
    largest: int

    def fits(self, limits: JoinLimits) -> bool:
        return self.keys <= limits.broadcast_rows and self.bytes <= limits.broadcast_bytes


def key_profile(df: DataFrame, key: str) -> KeyProfile:
    """One aggregate over the key column; copies of a key combine before the shuffle."""
    n = free_name("_n", [key])
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(n))
    row = counts.agg(
        F.count(key).alias("keys"),
        F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(n), F.lit(0)).alias("largest"),
    ).first()
    return KeyProfile(row["keys"], row["bytes"], row["largest"])


def hot_keys(df: DataFrame, key: str, limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """Keys with more than ``rows_per_split`` rows and the number of splits each one gets.

    Every such key is listed, so the list has at most as many rows as ``df`` has
    ``rows_per_split``. Counting combines map-side.
    """
    n = free_name("_n", [key])
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(n))
    hot = counts.where(F.col(n) > limits.rows_per_split)
    if limits.max_hot_keys is not None:
        hot = hot.orderBy(F.desc(n), F.col(key)).limit(limits.max_hot_keys)
    return hot.select(key, _splits(F.col(n), limits).alias("_splits"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    spread: list[str] | list[Column],
    limits: JoinLimits = DEFAULT_LIMITS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on ``key`` where hot keys of ``left`` are divided over several tasks.

    ``spread`` are the columns whose hash picks the split of a left row. They should tell rows of
    one key apart; a hash, not a random number, keeps recomputed tasks consistent. The right rows
    of a hot key are repeated once per split, so the result is that of the plain join. ``how`` is
    a join type that keeps left rows at most once per match: inner, left or left_anti. ``hot``
    replaces the ``hot_keys`` of ``left`` where a cheaper frame has the same hot keys.
    """
    splits, salt_name = (free_name(n, left.columns, right.columns) for n in ("_splits", "_salt"))
    hot = (hot_keys(left, key, limits) if hot is None else hot).withColumnRenamed("_splits", splits)
    if fits_broadcast(hot, limits):
        hot = F.broadcast(hot)
    row_hash = F.xxhash64(*spread)
    # Rows without a key match nothing; they are spread by their own number.
    nulls = left.where(F.col(key).isNull()).agg(F.count(F.lit(1)).alias("n"))
    spread_nulls = nulls.select(F.greatest(_splits(F.col("n"), limits), F.lit(1)).alias("n")).first()["n"]
    salt = (
        F.when(F.col(key).isNull(), F.pmod(row_hash, F.lit(spread_nulls)))
        .when(F.col(splits).isNotNull(), F.pmod(row_hash, F.col(splits)))
        .otherwise(F.lit(0))
        .cast("int")
    )
    salted_left = left.join(hot, key, "left").withColumn(salt_name, salt).drop(splits)
    copies = F.sequence(F.lit(0), F.coalesce(F.col(splits), F.lit(1)) - 1)
    salted_right = (
        right.join(hot, key, "left").withColumn(salt_name, F.explode(copies)).drop(splits)
    )
    return salted_left.join(salted_right, [key, salt_name], how).drop(salt_name)
