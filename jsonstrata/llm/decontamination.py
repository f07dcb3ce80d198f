"""Benchmark decontamination by greedy string tiling.

Shared seeds of a few words point to the benchmark items that a document may hold. For these pairs
the longest common stretches of words are marked one after another, none overlapping, in any order
of place, so reordered passages are found. The marked share of the item's words decides.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonstrata.llm.arrays import buffers, runs, spans, stretches
from jsonstrata.llm.frames import col, keep, ready

#: Bits of the table that tells most words' seeds apart from the benchmark's before they are searched.
FILTER_BITS = 24
#: Characters whose kind is looked up: the first two planes of Unicode.
TABLE = 0x20000
#: First and last characters of scripts without spaces between words (Thai and Lao,
#: Myanmar, Khmer, Japanese syllables, Han characters).
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF))
#: Places of equal seeds that are compared at once; more are divided by items, then by documents.
PLACES = 1 << 22


@dataclass(frozen=True)
class Items:
    """The words of a block of benchmark items, and their seeds of one length in order of hash and item."""

    ids: np.ndarray
    bounds: np.ndarray
    k: int
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray


@cache
def _kinds() -> np.ndarray:
    """What each character is to words: 0 between them, 1 a part of one, 2 one of its own.

    Letters, marks and digits make words; in scripts that are written without spaces each of them is
    a word. Characters beyond the table are such ones too (further Han characters).
    """
    kinds = np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(TABLE)], np.uint8)
    for first, last in UNSPACED:
        kinds[first : last + 1] *= 2
    return np.append(kinds, np.uint8(2))


def word_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word: letters and digits in lower case, without punctuation."""
    data, bounds = buffers(pc.utf8_lower(column))
    if (data >= 0x80).any():
        # From here on characters, where bytes were; an ASCII text has the same numbers for both.
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        data = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        bounds = at[bounds]
    kind = _kinds()[np.minimum(data.astype(np.uint32), TABLE)]
    inside = kind > 0
    first, last = inside.copy(), inside.copy()
    joined = (kind[1:] == 1) & (kind[:-1] == 1)
    first[1:] &= ~joined
    last[:-1] &= ~joined
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return stretches(data, start, end), np.searchsorted(bounds, start, "right") - 1


def build(ids: list, texts: list, k: int, least: int) -> list[Items]:
    """The seeds of ``k`` words, and for each smaller length those of the items of just so many words."""
    values, owner = word_values(pa.array(texts, pa.string()))
    bounds = np.searchsorted(owner, np.arange(len(ids) + 1))
    size = np.diff(bounds)
    out = []
    for length in range(k, least - 1, -1):
        seeds, at = runs(values, owner, length)
        here = size[owner[at]] >= k if length == k else size[owner[at]] == length
        seeds, at = seeds[here], at[here]
        if length == k or len(seeds):
            order = np.lexsort((owner[at], seeds))
            item = owner[at][order]
            out.append(Items(np.array(ids), bounds, length, seeds[order], item, at[order] - bounds[item]))
    return out


def tile(doc_at: np.ndarray, item_at: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from the places of equal ``k``-word seeds: (doc word, item word, length).

    Neighbouring seeds on one diagonal make a match. The longest match is marked first, at equal
    length the earliest; a match that meets marked words is cut to its free stretches, which go on
    if they have ``k`` words.
    """
    order = np.lexsort((doc_at, item_at - doc_at))
    doc_at, item_at = doc_at[order], item_at[order]
    new = np.ones(len(doc_at), bool)
    new[1:] = (np.diff(item_at - doc_at) != 0) | (np.diff(doc_at) != 1)
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(doc_at))) + k - 1
    waiting = [(-int(n), int(d), int(i)) for n, d, i in zip(length, doc_at[head], item_at[head], strict=True)]
    heapq.heapify(waiting)
    in_doc: set[int] = set()
    in_item: set[int] = set()
    tiles = []
    while waiting:
        n, d, i = heapq.heappop(waiting)
        n = -n
        free = [d + x not in in_doc and i + x not in in_item for x in range(n)]
        if all(free):
            tiles.append((d, i, n))
            in_doc.update(range(d, d + n))
            in_item.update(range(i, i + n))
            continue
        x = 0
        while x < n:
            y = x
            while y < n and free[y]:
                y += 1
            if y - x >= k:
                heapq.heappush(waiting, (x - y, d + x, i + x))
            x = y + 1
    return tiles


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    seed_words: int = 5,
    min_coverage: float = 0.5,
    min_item_words: int = 3,
    block_bytes: int = 16 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Documents and the items they hold: (doc_id, item_id, n_tiles, tile_words, item_words, coverage).

    A pair is returned when tiles of at least ``seed_words`` words cover ``min_coverage`` of the
    item's words. Words are letters and digits in lower case, so case and punctuation don't matter; in
    scripts without spaces every character is a word. An item of fewer than ``seed_words`` words is
    found where all of them stand in a row. Items of fewer than ``min_item_words`` words are not
    searched for, since they stand in almost any text.

    The items go to the tasks in blocks of about ``block_bytes`` of text, one pass over the
    documents for each block, so what is broadcast is bounded. Documents aren't shuffled and whole
    texts are read. Equal seeds are met in pieces of bounded size, by items and documents. Null or
    empty texts match nothing.
    Repeated rows of either table give repeated pairs. Empty tables give no rows; other columns may
    have any name.
    """
    spark = docs.sparkSession
    ready(spark)
    rows = docs.select(col(id_column).alias("doc_id"), col(text_column).alias("text"))
    items = benchmark.select(col(item_column).alias("item_id"), col(item_text_column).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    blocks = max(1, -(-total // block_bytes))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    dealt = keep(dealt) if blocks > 1 else dealt
    kinds = dict(rows.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_tiles int, tile_words int, item_words int, coverage double"
    found = None
    for block in range(blocks):
        # At most about block_bytes of text.
        part = dealt.where(F.col("block") == block).drop("block").toArrow()
        built = build(part.column("item_id").to_pylist(), part.column("text").to_pylist(), seed_words, min_item_words)
        pairs = rows.mapInArrow(_matcher(spark.sparkContext.broadcast(built), min_coverage, part.schema), schema)
        found = pairs if found is None else found.unionByName(pairs)
    return found


def _pairs(items: Items, owner: np.ndarray, seeds: np.ndarray, at: np.ndarray, rank: np.ndarray, keys: np.ndarray, a: int, b: int) -> Iterator[tuple]:
    """Places of equal seeds of the documents and of the items a to b, whole pairs in every piece.

    ``rank`` is the number of a document's seed among the different seeds of the items, and ``keys``
    are rank and item of the items' seeds as one number, in order.
    """
    n = len(items.ids)
    low = np.searchsorted(keys, rank * n + a)
    many = np.searchsorted(keys, rank * n + b) - low
    total = int(many.sum())
    if not total:
        return
    if total > PLACES and b - a > 1:
        middle = (a + b) // 2
        yield from _pairs(items, owner, seeds, at, rank, keys, a, middle)
        yield from _pairs(items, owner, seeds, at, rank, keys, middle, b)
        return
    docs = owner[at]
    if total > PLACES and docs[0] != docs[-1]:
        cut = int(np.searchsorted(docs, (docs[0] + docs[-1]) // 2, "right"))
        for part in (slice(None, cut), slice(cut, None)):
            yield from _pairs(items, owner, seeds[part], at[part], rank[part], keys, a, b)
        return
    place = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(total)
    where = np.repeat(at, many)
    yield owner[where], items.seed_item[place], where, items.seed_at[place]


def _matcher(shared, min_coverage: float, item_schema: pa.Schema):
    item_type = item_schema.field("item_id").type

    def tiled(items: Items, values: np.ndarray, owner: np.ndarray, maybe: np.ndarray, distinct: np.ndarray, keys: np.ndarray) -> Iterator[tuple]:
        seeds, at = runs(values, owner, items.k)
        hit = np.flatnonzero(maybe[seeds >> np.uint64(64 - FILTER_BITS)])
        rank = np.searchsorted(distinct, seeds[hit])
        real = distinct[np.minimum(rank, len(distinct) - 1)] == seeds[hit]
        hit, rank = hit[real], rank[real]
        for doc, item, where, inner in _pairs(items, owner, seeds[hit], at[hit], rank, keys, 0, len(items.ids)):
            order = np.lexsort((item, doc))
            doc, item, where, inner = doc[order], item[order], where[order], inner[order]
            edge = np.flatnonzero(np.append(True, (np.diff(doc) != 0) | (np.diff(item) != 0)))
            for a, b in zip(edge, np.append(edge[1:], len(doc)), strict=True):
                size = int(items.bounds[item[a] + 1] - items.bounds[item[a]])
                # Distinct item words in seeds bound what tiles can cover.
                covered = np.zeros(size + items.k, np.int32)
                np.add.at(covered, inner[a:b], 1)
                np.add.at(covered, inner[a:b] + items.k, -1)
                if np.count_nonzero(np.cumsum(covered[:size])) < min_coverage * size:
                    continue
                tiles = tile(where[a:b], inner[a:b], items.k)
                marked = sum(n for _, _, n in tiles)
                if marked >= min_coverage * size:
                    yield int(doc[a]), items.ids[item[a]], len(tiles), marked, size, marked / size

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepared = []
        for items in shared.value:
            if not len(items.seeds):
                continue
            maybe = np.zeros(1 << FILTER_BITS, bool)
            maybe[items.seeds >> np.uint64(64 - FILTER_BITS)] = True
            distinct, rank = np.unique(items.seeds, return_inverse=True)
            prepared.append((items, maybe, distinct, rank * len(items.ids) + items.seed_item))
        for batch in batches:
            texts = batch.column("text")
            rows = []
            _, bounds = buffers(texts)
            for i, j in spans(bounds):
                values, owner = word_values(texts.slice(i, j - i))
                for items, maybe, distinct, keys in prepared:
                    rows += [(i + doc, *rest) for doc, *rest in tiled(items, values, owner, maybe, distinct, keys)]
            if rows:
                number, item, *rest = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(number)),
                        pa.array([x.item() if hasattr(x, "item") else x for x in item], item_type),
                        *(pa.array(x, pa.int32()) for x in rest[:3]),
                        pa.array(rest[3], pa.float64()),
                    ],
                    ["doc_id", "item_id", "n_tiles", "tile_words", "item_words", "coverage"],
                )

    return match
