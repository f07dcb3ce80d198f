"""Shards of near-equal bytes by best-fit-decreasing bin packing of indivisible groups.

A group is all documents of one text. Groups enter in descending size the bin with the least room
that still holds them; the bins stand in an ordered structure by room, so a step is a search in it.
The driver packs size classes instead of groups: a class is one of 512 steps per doubling of the
group's bytes, so there are at most a few ten thousand however many documents there are, and the
groups of a class then fill the places of their class in Spark. A group larger than a whole bin
can't stay together: its copies are divided into bins' worths of equal texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jsonstrata.llm.frames import col, keep, ranked

#: Bytes that a document takes besides its text.
OVERHEAD = 16
STEPS = 512

Item = tuple[float, int, object]  # bytes of one item, number of items, what it stands for
Run = tuple[object, int, int]  # what it stands for, number of items, bin


def best_fit(items: list[Item], capacity: float, bins: int | None = None) -> list[Run] | None:
    """Best-fit-decreasing packing into bins of ``capacity``, as runs of equal items.

    Without ``bins`` a new bin is opened when nothing fits; with it the result is None when the
    items need more. An item above the capacity has a bin of its own.
    """
    room: list[tuple[float, int]] = []  # ordered by room
    opened = 0
    runs: list[Run] = []
    for size, count, label in sorted(items, key=lambda x: -x[0]):
        while count:
            at = bisect_left(room, (size, -1))
            if at < len(room):
                left, bin_ = room.pop(at)
            elif bins is None or opened < bins:
                left, bin_, opened = max(capacity, size), opened, opened + 1
            else:
                return None
            take = min(count, int(left / size)) if size else count
            take = max(take, 1)
            insort(room, (left - take * size, bin_))
            runs.append((label, take, bin_))
            count -= take
    return runs


def level(runs: list[Run], sizes: dict[object, float], bins: int) -> list[Run]:
    """Moves items to the emptiest bin from the fullest that has one small enough.

    Best fit fills one bin after another, so with few items the last ones would stay short.
    """
    held: list[dict[object, int]] = [{} for _ in range(bins)]
    load = [0.0] * bins
    for label, count, bin_ in runs:
        held[bin_][label] = held[bin_].get(label, 0) + count
        load[bin_] += count * sizes[label]
    mean = sum(load) / bins
    for _ in range(100 * bins):
        empty = min(range(bins), key=load.__getitem__)
        for full in sorted(range(bins), key=load.__getitem__, reverse=True):
            gap = load[full] - load[empty]
            fits = [x for x in held[full] if 0 < sizes[x] < gap]
            if gap <= 1e-4 * mean or fits:
                break
        if gap <= 1e-4 * mean or not fits:
            break
        label = min(fits, key=lambda x: (abs(sizes[x] - gap / 2), str(x)))
        count = min(held[full][label], max(1, int(gap / 2 / sizes[label])))
        held[full][label] -= count
        if not held[full][label]:
            del held[full][label]
        held[empty][label] = held[empty].get(label, 0) + count
        load[full] -= count * sizes[label]
        load[empty] += count * sizes[label]
    return [(label, count, bin_) for bin_, items in enumerate(held) for label, count in items.items()]


def pack(items: list[Item], bins: int) -> list[Run]:
    """The packing into ``bins`` bins of the least capacity that suffices, found by halving, and
    then levelled."""
    if not items:
        return []
    total = sum(size * count for size, count, _ in items)
    low = max(total / bins, 1.0)
    high = low
    while (found := best_fit(items, high, bins)) is None:
        high *= 1.02
    for _ in range(24):
        middle = (low + high) / 2
        if (tighter := best_fit(items, middle, bins)) is None:
            low = middle
        else:
            high, found = middle, tighter
    return level(found, {label: size for size, _, label in items}, bins)


def _size_class(size: Column) -> Column:
    return F.floor(F.log2(size) * STEPS).cast("int")


def _places(runs: list[Run], labels: dict[object, list[tuple[int, int]]]) -> None:
    """Adds to each label its bins with the number of items up to and including each."""
    for label, take, bin_ in runs:
        ends = labels.setdefault(label, [])
        ends.append(((ends[-1][0] if ends else 0) + take, bin_))


def _place(rank: Column, ends: Column, bins: Column) -> Column:
    """The bin of the item of this rank."""
    return F.element_at(bins, F.size(F.filter(ends, lambda e: e <= rank)) + 1)


def shard_documents(
    docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A shard and a slot for every document: (doc_id, size, text_crc32, shard, slot).

    Equal texts share a shard unless they are more than a shard holds. ``size`` is the UTF-8 bytes
    of the text plus 16. Slots number the documents of a shard without a gap from 0.

    A null text counts as an empty one, with which it shares a group. Repeated rows and rows
    without an id are documents of their own. Empty tables give no rows. Only the two named columns
    are read, so other columns may have any name.
    """
    text = F.coalesce(col(text_column), F.lit(""))
    rows = keep(
        docs.select(
            col(id_column).alias("doc_id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("text_key"),
        )
    )
    spark = docs.sparkSession
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()["bytes"]
    room = total / shards
    groups = keep(
        rows.groupBy("text_key")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"))
        .withColumn("bytes", F.col("copies") * F.col("size"))
    )
    whole = groups.where((F.col("bytes") <= room) | (F.col("copies") == 1))
    # Fewer than `shards` groups are larger than a shard.
    large = groups.where((F.col("bytes") > room) & (F.col("copies") > 1)).collect()

    whole = whole.withColumn("size_class", _size_class(F.col("bytes")))
    classes = whole.groupBy("size_class").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()
    items: list[Item] = [(c["bytes"] / c["n"], c["n"], c["size_class"]) for c in classes]
    per_piece = {}
    for g in large:
        part = per_piece[bytes(g["text_key"])] = max(1, int(room // g["size"]))
        key = bytes(g["text_key"])
        full, rest = divmod(g["copies"], part)
        items += [(float(part * g["size"]), 1, (key, i)) for i in range(full)]
        items += [(float(rest * g["size"]), 1, (key, full))] if rest else []
    places: dict[object, list[tuple[int, int]]] = {}
    _places(pack(items, shards), places)

    of_class = spark.createDataFrame(
        [(k, [e for e, _ in v], [b for _, b in v]) for k, v in places.items() if not isinstance(k, tuple)],
        "size_class int, ends array<long>, bins array<int>",
    )
    numbered = ranked(whole.select("text_key", "size_class"), ["size_class"], ["text_key"], "rank")
    # One row for each size class: bounded by the steps.
    placed = numbered.join(F.broadcast(of_class), "size_class").select(
        "text_key", _place(F.col("rank"), F.col("ends"), F.col("bins")).alias("shard")
    )
    together = rows.join(placed, "text_key")
    if large:
        parts = spark.createDataFrame(
            [
                (key, part, [places[key, i][0][1] for i in range(sum(k[0] == key for k in places if isinstance(k, tuple)))])
                for key, part in per_piece.items()
            ],
            "text_key binary, part long, bins array<int>",
        )
        copies = keep(rows.join(F.broadcast(parts.select("text_key")), "text_key", "left_semi"))
        divided = ranked(copies, ["text_key"], ["doc_id"], "rank").join(F.broadcast(parts), "text_key")
        divided = divided.withColumn("shard", F.element_at("bins", F.floor(F.col("rank") / F.col("part")).cast("int") + 1))
        together = together.unionByName(divided.select(together.columns))
    sharded = keep(together.select("doc_id", "size", "text_crc32", "shard"))
    return ranked(sharded, ["shard"], ["doc_id", "text_crc32"], "slot")
