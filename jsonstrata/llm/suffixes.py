"""Repeated byte strings by buckets of blocks and one refinement.

Bucket-pointer refinement deals suffixes to buckets by their leading q-gram and refines a bucket, round
after round, by the bucket identifiers of its suffixes at later offsets. Here identifiers are hashes of
q-grams, with q half the length of the sought strings, so that one refinement tells whole strings
apart. There are no further rounds, and no identifiers of one are used in another.

Refining every suffix would move many times the text: an entry for a string at each byte has 22 bytes,
in every round. So the strings that start at neighbouring bytes
and share the least identifier among their q-grams form a block, which stands in that q-gram's
bucket. Equal text has equal blocks, except where it begins or ends. In a bucket of equal blocks all
strings are equal at once and it is finished; a bucket with different blocks is refined: the
identifiers of its strings at both offsets are hashed again from the text, and equal pairs meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonstrata.llm.arrays import BASES, U64, buffers, mix, powers, spans, stretches
from jsonstrata.llm.frames import keep
from jsonstrata.llm.removal import (
    ASKED,
    COVERED,
    KEYED,
    OPEN,
    SCHEMA,
    as_table,
    by_bucket,
    cut,
    groups,
    id_bucket,
    meet,
    packed,
    texts,
    unpacked,
)

#: Bytes of text whose blocks are sorted together before they are sent.
TOGETHER = 8 << 20
#: Bytes of one round of array operations: with the overlap of slices, just below a power of two.
PIECE = (1 << 18) - 4096


def gram_ids(data: np.ndarray, q: int, base: int) -> np.ndarray:
    """The identifier of the q-gram at every byte that starts one."""
    n = len(data)
    up, down = powers(base, n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:n], out=sums[1:])
    return mix((sums[q:] - sums[: n + 1 - q]) * down[: n + 1 - q])


def blocks(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Blocks of strings: identifier of their q-gram, hash of the block, text number, first byte, strings."""
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < length:
        return none.astype(U64), none.astype(U64), none, none, none
    q = length // 2
    ids = gram_ids(data, q, BASES[0])
    # The leftmost least identifier among the q-grams of each string; the low bits tell where.
    low = U64((1 << 32) - 1)
    least = (ids & ~low) | np.arange(len(ids), dtype=U64)
    width, reach = 1, length - q + 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    at = (least & low).astype(np.int64)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(at)]
    whole = np.arange(len(at)) + length <= bounds[owner + 1]
    new = whole.copy()
    new[1:] &= (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    new[1:] |= whole[1:] & ~whole[:-1]
    last = whole.copy()
    last[:-1] &= new[1:] | ~whole[1:]
    start, stop = np.flatnonzero(new), np.flatnonzero(last) + 1
    return ids[at[start]], stretches(data, start, stop + length - 1, BASES[1]), owner[start], start, stop - start


def _slices(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Ranges of texts: number of the first, bytes, bounds, and the offset of the first byte in its text.

    A very long text comes in slices that overlap, so that every string is whole in one of them. A
    slice may divide a block; the parts then differ from whole ones and are refined.
    """
    _, bounds = buffers(column)
    for i, j in spans(bounds, PIECE):
        data, inner = buffers(column.slice(i, j - i))
        if len(data) <= PIECE + length or j - i > 1:
            yield i, data, inner, 0
            continue
        for a in range(0, len(data) - length + 1, PIECE):
            part = data[a : a + PIECE + length - 1]
            yield i, part, np.array([0, len(part)]), a


def _firsts(key, check, ids, start):
    """Order of the rows, their first row of equal key and check, and which rows a smaller id precedes."""
    order = np.lexsort((start, ids, check, key))
    first = groups(key[order], check[order])
    return order, first, ids[order] != ids[order][first]


def drop_repeated_strings(
    docs: DataFrame, length: int = 50, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Texts without strings that a smaller id holds: (doc_id, n_bytes, spans, kept).

    A byte is removed when a string of ``length`` UTF-8 bytes that covers it also starts in a
    document of a smaller id. Strings never cross documents and are judged on the input. ``spans``
    are the maximal removed runs of bytes, the end exclusive, and ``kept`` is the rest. Equality is
    that of 96 bits of two hashes.

    Null texts are empty; texts shorter than ``length`` stay whole. Rows without an id stay and take
    no part. A repeated row has an equal id, not a smaller one, so it is treated like the first. Ids
    are whole numbers and name one text. Empty tables give no rows; other columns may have any name.
    """
    rows, buckets = texts(docs, id_column, text_column)
    half = length // 2

    def by_key(key: np.ndarray) -> np.ndarray:
        return (key % U64(buckets)).astype(np.int64)

    def covered_rows(ids: np.ndarray, start: np.ndarray, strings: np.ndarray) -> list[pa.RecordBatch]:
        return packed(COVERED, id_bucket(ids, buckets), ids, start, strings + (length - 1))

    def find_blocks(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for i, data, bounds, offset in _slices(batch.column("text"), length):
                key, check, text, start, strings = blocks(data, bounds, length)
                start = (start - bounds[text] + offset).astype(np.uint32)
                held.append((key, (check >> U64(32)).astype(np.uint32), ids[i + text], start, strings.astype(np.uint32)))
                size += len(data)
                if size >= TOGETHER:
                    yield from send(held)
                    held, size = [], 0
        if held:
            yield from send(held)

    def send(held: list) -> Iterator[pa.RecordBatch]:
        key, check, ids, start, strings = (np.concatenate(x) for x in zip(*held, strict=True))
        order, first, covered = _firsts(key, check, ids, start)
        late = order[covered]
        yield from covered_rows(ids[late], start[late], strings[late])
        # A bucket that already holds different blocks is asked about here and marked for the others.
        of = groups(key[order])
        mixed = np.zeros(len(order), bool)
        mixed[of[check[order] != check[order][of]]] = True
        mixed = mixed[of]
        asked = order[mixed & ~covered]
        yield from packed(ASKED, id_bucket(ids[asked], buckets), ids[asked], start[asked], strings[asked])
        marks = order[np.flatnonzero(mixed & (of == np.arange(len(order))))]
        yield from packed(OPEN, by_key(key[marks]), ids[marks], start[marks], strings[marks], key[marks], check[marks])
        sent = np.sort(order[~mixed & ~covered])
        yield from packed(KEYED, by_key(key[sent]), ids[sent], start[sent], strings[sent], key[sent], check[sent])

    def meet_blocks(table: pa.Table) -> pa.Table:
        x, marks = unpacked(table, KEYED), unpacked(table, OPEN)
        order, _, covered = _firsts(x["key"], x["check"], x["ids"], x["start"])
        key, check, ids, start, strings = (x[n][order] for n in ("key", "check", "ids", "start", "size"))
        of = groups(key)
        mixed = np.zeros(len(order), bool)
        mixed[of[check != check[of]]] = True
        mixed = mixed[of] | np.isin(key, marks["key"])
        out = covered_rows(ids[covered], start[covered], strings[covered])
        asked = mixed & ~covered
        out += packed(ASKED, id_bucket(ids[asked], buckets), ids[asked], start[asked], strings[asked])
        through = pa.compute.is_in(table.column("kind"), pa.array([COVERED, ASKED], pa.int32()))
        return pa.concat_tables([table.filter(through), as_table(out)])

    def refine(left: pa.Table, right: pa.Table) -> pa.Table:
        x = unpacked(right, ASKED)
        numbers = left.column("doc_id").combine_chunks()
        texts_ = left.column("text").combine_chunks()
        order = np.argsort(x["ids"], kind="stable")
        ids, start, strings = (x[n][order].astype(np.int64) for n in ("ids", "start", "size"))
        names, place = np.unique(numbers.fill_null(0).to_numpy(), return_index=True)
        found = []
        edges = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else []
        for i, j in zip(edges, [*edges[1:], len(ids)], strict=True):
            data, _ = buffers(texts_.slice(int(place[np.searchsorted(names, ids[i])]), 1))
            # Every string of the asked blocks, by the identifiers at its start and in its middle.
            at = np.repeat(start[i:j] - np.cumsum(strings[i:j]) + strings[i:j], strings[i:j]) + np.arange(strings[i:j].sum())
            at = np.unique(at)
            pairs = [(stretches(data, at, at + half, b), stretches(data, at + half, at + length, b)) for b in BASES]
            up, _ = powers(BASES[0], 2)
            key, check = (mix(a * up[1] + b * up[2]) for a, b in pairs)
            found.append((key, check >> U64(32), np.full(len(at), ids[i]), at))
        if not found:
            return as_table([])
        key, check, ids, start = (np.concatenate(c) for c in zip(*found, strict=True))
        order, _, covered = _firsts(key, check, ids, start)
        late, early = order[covered], np.sort(order[~covered])
        one = np.ones(len(key), np.int64)
        out = covered_rows(ids[late], start[late], one[late])
        out += packed(KEYED, by_key(key[early]), ids[early], start[early], one[early], key[early], check[early])
        return as_table(out)

    def meet_strings(table: pa.Table) -> pa.Table:
        x = unpacked(table, KEYED)
        order, _, covered = _firsts(x["key"], x["check"], x["ids"], x["start"])
        late = order[covered]
        through = table.filter(pa.compute.equal(table.column("kind"), COVERED))
        return pa.concat_tables([through, as_table(covered_rows(x["ids"][late], x["start"][late], x["size"][late]))])

    known = rows.where("doc_id IS NOT NULL").select("doc_id", "text")
    found = by_bucket(known.mapInArrow(find_blocks, SCHEMA), buckets)
    first = keep(found.groupBy("bucket").applyInArrow(meet_blocks, SCHEMA))
    strings = by_bucket(meet(rows, first.where(F.col("kind") == ASKED), buckets, refine, SCHEMA), buckets)
    second = strings.groupBy("bucket").applyInArrow(meet_strings, SCHEMA)
    return cut(rows, first.where(F.col("kind") == COVERED).unionByName(second), buckets)
