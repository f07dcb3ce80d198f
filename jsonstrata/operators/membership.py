"""Where an id may be: the bucket of a table it belongs to, and filters of the ids a table has.

A filter is a set of bitmaps, one for each cell; an id's cell and bits come from hashes. Filters of
several batches are merged by OR. An id with a bit that is not set is absent for sure; one whose bits
are all set may be absent as well, so it is looked up in the table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonstrata.functions.names import free_name, quoted
from jsonstrata.operators.skew import DEFAULT_LIMITS, JoinLimits, fits_broadcast

BUCKET_COLUMN = "_bucket"
#: Bits of Spark's bitmap aggregates.
CELL_BITS = 32_768
#: Bits that an id sets. At 10 bits an id about one absent id in a hundred finds all of its own set.
PROBES = 4
BITS_PER_ID = 10
FILTER_SCHEMA = "cell int, bits binary"


@dataclass(frozen=True)
class Buckets:
    """The division of a table by a hash of ``column``; rows without a value share a bucket."""

    column: str
    count: int

    def of(self, column: Column | None = None) -> Column:
        value = F.col(quoted(self.column)) if column is None else column
        return F.pmod(F.xxhash64(value, F.lit("bucket")), F.lit(self.count)).cast("int")


def _cell(value: Column, cells: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit("cell")), F.lit(cells)).cast("int")


def _probes(value: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(value, F.lit(i)), F.lit(CELL_BITS)) for i in range(PROBES)]


def id_filter(rows: DataFrame, id_column: str, cells: int) -> DataFrame:
    """``(cell, bits)``: the filter of the rows' ids. Bits are set map-side."""
    value = F.col(quoted(id_column))
    bits = rows.where(value.isNotNull()).select(_cell(value, cells).alias("cell"), F.explode(F.array(*_probes(value))).alias("bit"))
    return bits.groupBy("cell").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged(filters: DataFrame) -> DataFrame:
    """One bitmap for each cell."""
    return filters.groupBy("cell").agg(F.bitmap_or_agg("bits").alias("bits"))


def may_hold(
    ids: DataFrame, filters: DataFrame, id_column: str, cells: int, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """The ids that may be in the table of the filters; all others are not. ``ids`` are distinct.

    Only cells of the given ids are read and merged.
    """
    cell, bits = free_name("_cell", ids.columns), free_name("_bits", ids.columns)
    value = F.col(quoted(id_column))
    given = ids.withColumn(cell, _cell(value, cells))
    touched = given.select(F.col(cell).alias("cell")).distinct()
    if fits_broadcast(touched, limits):
        touched = F.broadcast(touched)
    known = merged(filters.join(touched, "cell", "left_semi")).withColumnsRenamed({"cell": cell, "bits": bits})

    set_ = reduce(and_, [_bit(F.col(bits), bit) for bit in _probes(value)])
    return given.join(known, cell).where(set_).select(*map(quoted, ids.columns))


def packed_filter(ids: DataFrame, id_column: str, most_cells: int) -> Callable[[Column], Column]:
    """A test of whether a value may be one of the distinct ``ids``, as a condition without a join.

    It holds all bitmaps as one constant of at most ``most_cells`` times 4 KB, whatever the number of ids:
    beyond that more absent values pass. Only the bitmaps come to the driver.
    """
    cells = min(most_cells, max(1, -(-ids.count() * BITS_PER_ID // CELL_BITS)))
    size = CELL_BITS // 8
    bits = bytearray(cells * size)
    for row in id_filter(ids, id_column, cells).toLocalIterator():
        bits[row["cell"] * size : (row["cell"] + 1) * size] = row["bits"]

    def test(value: Column) -> Column:
        first = _cell(value, cells).cast("bigint") * CELL_BITS
        return reduce(and_, [_bit(F.lit(bits), first + bit) for bit in _probes(value)])

    return test


def _bit(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.call_function("getbit", byte, (bit % 8).cast("int")) == 1
