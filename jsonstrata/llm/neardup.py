"""Near-duplicate groups by fast similarity sketches, banding and exact verification.

A sketch is filled in rounds. In each round every shingle falls into a hashed coordinate; a coordinate
keeps the least value of the first round that reaches it. After as many rounds as coordinates, round
i gives all shingles to coordinate i, so every coordinate is filled. The share of equal coordinates
estimates the Jaccard similarity with the concentration of independent samples.

A few coordinates make a band. Documents that agree in a band are candidates. First each is verified
against the smallest document of its band's bucket, which settles groups of copies with one check for
each; then, in buckets that still hold several groups, documents of different groups are compared by
their sketches and close pairs are verified. A pair within one group needs no check, as it changes
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonstrata.llm.arrays import U64, buffers, mix, shingles, spans
from jsonstrata.llm.frames import col, keep, ready
from jsonstrata.llm.graph import components

#: Coordinates of one byte.
WIDTH = 384
#: A pair at the threshold may agree in no band with this probability; any closer pair has a lower one.
MISS = 1e-6
#: Least estimate of a pair worth an exact check, in standard deviations below the threshold: a linked
#: pair is estimated lower with a probability of MISS.
MARGIN = 4.75
#: Documents of a bucket that a task holds, while others pass by.
BLOCK = 8192


def band_size(percent: int) -> int:
    """The most coordinates to a band that keep the chance to miss a pair at the threshold: 8 at 85, 6 at 80."""
    for size in (8, 6, 4, 3, 2):
        if (1 - (percent / 100) ** size) ** (WIDTH // size) <= MISS:
            return size
    return 1


def _sketch(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of bytes for each set; the sets' values stand one after another."""
    sets = len(counts)
    filled = np.full((sets, WIDTH), np.iinfo(np.uint64).max, U64)
    flat = filled.ravel()
    owner = np.repeat(np.arange(sets), counts)
    for step in range(2 * WIDTH):
        h = mix(values ^ U64((0x9E3779B97F4A7C15 * (step + 1)) & (2**64 - 1)))
        value = (h & U64((1 << 40) - 1)) | U64(step << 40)
        at = (h >> U64(40)) % U64(WIDTH) if step < WIDTH else U64(step - WIDTH)
        place = owner * WIDTH + at.astype(np.int64)
        # A coordinate reached in an earlier round holds a lower value and stays.
        np.minimum.at(flat, place, value)
        todo = (filled == np.iinfo(np.uint64).max).any(axis=1) & (counts > 0)
        if not todo.any():
            break
        if not todo[owner].all():
            keep_ = todo[owner]
            values, owner = values[keep_], owner[keep_]
    return (mix(filled) >> U64(56)).astype(np.uint8)


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of texts with their distinct shingles, sorted within a text, and the number of each."""
    _, bounds = buffers(column)
    for i, j in spans(bounds):
        value, owner = shingles(*buffers(column.slice(i, j - i)), k)
        parts = np.split(value, np.searchsorted(owner, np.arange(1, j - i)))
        parts = [np.unique(p) for p in parts]
        yield i, j, np.concatenate(parts), np.array([len(p) for p in parts])


def _words(sketch: np.ndarray, size: int) -> np.ndarray:
    """A number for each band: the band's bytes, filled up with zeros."""
    words = np.zeros((len(sketch), WIDTH // size, 8), np.uint8)
    words[:, :, :size] = sketch.reshape(len(sketch), -1, size)
    return words.reshape(len(sketch), -1).view(np.int64)


def _sketcher(k: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, values, counts in _sets(batch.column("text"), k):
                sketch = _words(_sketch(values, counts), size)
                ends = np.concatenate([[0], np.cumsum(counts)])
                sums = []
                for salt in (1, 2):
                    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(values ^ U64(salt)), dtype=U64)])
                    sums.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        pa.array(counts, pa.int64()),
                        *map(pa.array, sums),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, sketch.size + 1, WIDTH // size), pa.int32()), pa.array(sketch.ravel())),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "sketch"],
                )

    return run


def _verifier(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            texts: dict[int, np.ndarray] = {}
            for ids, column in ((a, batch.column("text_a")), (b, batch.column("text_b"))):
                new, first = np.unique(ids, return_index=True)
                first = first[[x not in texts for x in new]]
                for i, j, values, counts in _sets(column.take(pa.array(first)), k):
                    texts |= zip(ids[first[i:j]].tolist(), np.split(values, np.cumsum(counts)[:-1]), strict=True)
            linked = np.zeros(len(a), bool)
            for x, (p, q) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
                left, right = texts[p], texts[q]
                both = len(np.intersect1d(left, right, assume_unique=True))
                linked[x] = 100 * both >= percent * (len(left) + len(right) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(b[linked])], ["a", "b"])

    return run


def _linked(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    kind = dict(pairs.dtypes)["a"]
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(
        _verifier(k, percent), f"a {kind}, b {kind}"
    )


def _comparer(percent: int, size: int):
    """Pairs of different groups that are close by their sketches, at the first band they share.

    Rows come in the order of (key, block, visits): the members of a block first, which are held, and
    then those that visit it, which pass by.
    """
    j = percent / 100
    bands = WIDTH // size
    least = WIDTH * (j - MARGIN * (j * (1 - j) / WIDTH) ** 0.5) + bands * (8 - size)

    def arrays(rows: pa.Table) -> dict[str, np.ndarray]:
        out = {c: rows.column(c).to_numpy() for c in ("node", "n", "component", "band", "main")}
        words = rows.column("sketch").combine_chunks().flatten().to_numpy()
        return {**out, "words": words.reshape(rows.num_rows, bands)}

    def compare(held: dict[str, np.ndarray], visitors: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        lefts, rights = [held["node"][:0]], [held["node"][:0]]
        bytes_ = held["words"].view(np.uint8)
        for x, node in enumerate(visitors["node"]):
            n, words, band = visitors["n"][x], visitors["words"][x], visitors["band"][x]
            # Members of the main group visit nobody; two others meet twice and are compared once.
            ok = (held["component"] != visitors["component"][x]) & (held["main"] | (held["node"] > node))
            ok &= 100 * np.minimum(held["n"], n) >= percent * np.maximum(held["n"], n)
            y = np.flatnonzero(ok)
            if band and len(y):
                y = y[~(held["words"][y, :band] == words[:band]).any(axis=1)]
            equal = (bytes_[y] == words.view(np.uint8)).sum(axis=1)
            y = y[equal >= least]
            lefts.append(np.full(len(y), node))
            rights.append(held["node"][y])
        return np.concatenate(lefts), np.concatenate(rights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, held = None, [], None
        for batch in batches:
            key, block, visits = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "block", "visits"))
            new = (key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (visits[1:] != visits[:-1])
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if i == j:
                    continue
                if (key[i], block[i]) != at:
                    at, parts, held = (key[i], block[i]), [], None
                part = batch.slice(i, j - i)
                if not visits[i]:
                    parts.append(part)
                    continue
                if held is None and parts:
                    held = arrays(pa.Table.from_batches(parts))
                if held is not None:
                    yield _pairs(*compare(held, arrays(pa.Table.from_batches([part]))))

    return run


def open_rows(grouped: DataFrame) -> DataFrame:
    """Buckets that hold several groups, as rows of blocks: (key, block, visits, main, ...).

    ``grouped`` has (key, component, node, ...). Every member stands in one block of its bucket. Only
    those outside of the bucket's largest group, the main one, visit all blocks. So a bucket of m
    members, s of them not of the main group, makes m + s * ceil(m / BLOCK) rows.
    """
    mixed = grouped.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = grouped.join(mixed.where("low <> high").select("key"), "key")
    groups = open_.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = groups.groupBy("key").agg(F.max(F.struct("size", "component")).alias("largest"), F.sum("size").alias("members"))
    open_ = open_.join(largest, "key").withColumn("main", F.col("component") == F.col("largest.component"))
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    stays = F.pmod(F.xxhash64("node"), blocks).cast("int")
    places = F.array(F.struct(stays.alias("block"), F.lit(False).alias("visits")))
    calls = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(b.alias("block"), F.lit(True).alias("visits")))
    places = F.when(F.col("main"), places).otherwise(F.concat(places, calls))
    kept = [c for c in grouped.columns if c != "key"]
    return open_.select("key", *kept, "main", F.inline(places))


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])


def near_duplicates(
    docs: DataFrame, percent: int = 80, shingle_words: int = 5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The near-duplicate group of every document: (doc_id, n_shingles, component_id, kept).

    Two documents are linked when ``100 * shared >= percent * union`` holds for their sets of
    ``shingle_words``-word shingles (fewer words: the whole sequence). Words are separated by white
    space, A to Z in lower case. ``component_id`` is the smallest id that links reach, and the
    document of that id is kept. Bands are chosen so that a
    linked pair is missed with a probability of at most 1e-6, and the estimate that spares far pairs
    the exact check is as sure.

    Documents of equal sets are one node, its smallest id. Null or empty texts have an empty set and
    are linked with nothing; rows without an id take no part and are kept. A repeated row is in the
    same group and kept like the first. Ids are whole numbers and name one text. Empty tables give
    no rows; other columns may have any name.
    """
    size = band_size(percent)
    ready(docs.sparkSession)
    texts = docs.select(col(id_column).cast("long").alias("doc_id"), col(text_column).alias("text"))
    rows = keep(
        texts.mapInArrow(
            _sketcher(shingle_words, size), "doc_id long, n_shingles long, set_a long, set_b long, sketch array<long>"
        )
    )
    sets = ["set_a", "set_b"]
    full = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    copies = keep(full.groupBy(*sets).agg(F.min("doc_id").alias("node")))
    nodes = full.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "sketch")
    nodes = nodes.join(copies.select("node"), "node").dropDuplicates(["node"])

    banded = nodes.select("node", "n", F.posexplode("sketch").alias("band", "word"))
    banded = banded.select("node", "n", F.col("band").cast("byte").alias("band"), F.xxhash64("band", "word").alias("key"))
    heads = banded.groupBy("key").agg(F.min(F.struct("node", "n")).alias("head"), F.count(F.lit(1)).alias("members"))
    buckets = keep(banded.join(heads.where("members > 1"), "key"))
    close = F.lit(100) * F.least("n", "head.n") >= F.lit(percent) * F.greatest("n", "head.n")
    stars = buckets.where((F.col("node") != F.col("head.node")) & close)
    stars = stars.select(F.col("node").alias("a"), F.col("head.node").alias("b")).distinct()
    # Only documents in a bucket with another are ever read again.
    candidates = buckets.select(F.col("node").alias("doc_id")).distinct()
    some = keep(texts.join(candidates, "doc_id").dropDuplicates(["doc_id"]))
    star_links = keep(_linked(stars, some, shingle_words, percent))
    settled = keep(components(star_links))

    grouped = buckets.join(settled, "node", "left").withColumn("component", F.coalesce("component", "node"))
    grouped = grouped.select("key", "band", "node", "n", "component")
    rows_of = open_rows(grouped).join(nodes.select("node", "sketch"), "node")
    group = ["key", "block"]
    spread = rows_of.repartition(*group).sortWithinPartitions(*group, "visits", "node")
    crossing = keep(spread.mapInArrow(_comparer(percent, size), "a long, b long").distinct())
    cross_links = _linked(crossing, some, shingle_words, percent)
    star_edges = settled.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = components(star_edges.unionByName(cross_links))

    of_set = copies.join(found, "node", "left").select(*sets, F.coalesce("component", "node").alias("component_id"))
    return (
        rows.select("doc_id", "n_shingles", *sets)
        .join(of_set, sets, "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
