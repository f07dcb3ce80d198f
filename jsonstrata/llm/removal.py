"""Finding stretches of text that occurred before, and cutting them out.

Stretches travel between tasks as packed arrays: a row holds those that one task has for one bucket.
A bucket is either one of keys, where equal stretches meet, or one of documents, where a document
meets what was found about it. The number of buckets follows the bytes of the texts, so a bucket is
of a bounded size. A task sends a key's first stretch only and knows by itself that its others came
later, so even a key that a third of all documents hold has one row a task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonstrata.llm.arrays import U64, buffers
from jsonstrata.llm.frames import col, ready

#: Kinds of rows.
KEYED, COVERED, ASKED, OPEN = range(4)
#: Arrays of a row. Documents of a row are listed once and numbered.
ARRAYS = {"key": "u8", "check": "u4", "ids": "i8", "number": "u2", "start": "u4", "size": "u4"}
SCHEMA = "bucket long, kind int, " + ", ".join(f"{name} binary" for name in ARRAYS)
#: Bytes of text for each bucket, and documents that a task looks at together.
BUCKET_BYTES = 8 << 20
MOST_IDS = 60_000
#: Tasks over which buckets are dealt: one each up to this number, several each beyond it, in turn.
MOST_TASKS = 20_000


def texts(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, int]:
    """(doc_id, text) with the bucket of each document, and the number of buckets."""
    ready(docs.sparkSession)
    rows = docs.select(col(id_column).cast("long").alias("doc_id"), col(text_column).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    buckets = -(-total // BUCKET_BYTES) | 1
    folded = F.col("doc_id").bitwiseXOR(F.shiftrightunsigned("doc_id", 15))
    return rows.withColumn("bucket", F.coalesce(F.pmod(folded, F.lit(buckets)), F.lit(0)).cast("long")), buckets


def id_bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The same bucket as that of the documents."""
    ids = ids.astype(np.int64)
    return (ids ^ (ids.view(U64) >> U64(15)).view(np.int64)) % buckets


def packed(kind: int, bucket: np.ndarray, ids: np.ndarray, start, size, key=None, check=None) -> list[pa.RecordBatch]:
    """Rows of one kind: all stretches of a bucket in one row, or in more if they have many documents."""
    if not len(bucket):
        return []
    order = np.argsort(bucket, kind="stable")
    bucket, ids, start, size = bucket[order], ids[order], start[order], size[order]
    if key is not None:
        key, check = key[order], check[order]
    edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    rows = []
    for i, j in zip(edges, [*edges[1:], len(bucket)], strict=True):
        # A row numbers at most as many documents as its numbers can tell apart.
        for a in range(i, j, MOST_IDS if j - i > MOST_IDS else j - i):
            b = min(j, a + MOST_IDS) if j - i > MOST_IDS else j
            names, number = np.unique(ids[a:b], return_inverse=True)
            parts = {
                "ids": names,
                "number": number,
                "start": start[a:b],
                "size": size[a:b],
                "key": key[a:b] if key is not None else (),
                "check": check[a:b] if key is not None else (),
            }
            rows.append((int(bucket[a]), [np.asarray(parts[n], t).tobytes() for n, t in ARRAYS.items()]))
    columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([kind] * len(rows), pa.int32())]
    columns += [pa.array([r[1][x] for r in rows], pa.binary()) for x in range(len(ARRAYS))]
    return [pa.RecordBatch.from_arrays(columns, ["bucket", "kind", *ARRAYS])]


def unpacked(table: pa.Table, kind: int) -> dict[str, np.ndarray]:
    """The stretches of one kind in a bucket's rows."""
    kinds = table.column("kind").to_numpy()
    rows = table.take(pa.array(np.flatnonzero(kinds == kind)))
    parts = {n: [np.frombuffer(x, t) for x in rows.column(n).to_pylist()] for n, t in ARRAYS.items()}
    parts["ids"] = [i[n] for i, n in zip(parts["ids"], parts["number"], strict=True)]
    return {n: np.concatenate([np.zeros(0, ARRAYS[n]), *p]) for n, p in parts.items() if n != "number"}


def as_table(batches: list[pa.RecordBatch]) -> pa.Table:
    kinds = {"bucket": pa.int64(), "kind": pa.int32()} | dict.fromkeys(ARRAYS, pa.binary())
    return pa.Table.from_batches(batches, pa.schema(list(kinds.items())))


def groups(*keys: np.ndarray) -> np.ndarray:
    """For rows sorted by the keys: the place of the first row of each row's group."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return np.repeat(first, np.diff(np.append(first, n)))


def by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """The rows dealt by bucket over tasks whose number follows that of the buckets."""
    return rows.repartition(min(buckets, MOST_TASKS), "bucket")


def cut(docs: DataFrame, covered: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the texts without the bytes that any stretch covers.

    ``spans`` are the maximal removed runs as byte offsets, the end exclusive; ``kept`` is the rest.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        found = unpacked(right, COVERED)
        ids = left.column("doc_id").combine_chunks()
        known = np.flatnonzero(~ids.is_null().to_numpy(zero_copy_only=False))
        numbers = ids.fill_null(0).to_numpy()
        data, bounds = buffers(left.column("text").combine_chunks())
        edge = np.zeros(len(data) + 1, np.int32)
        by_id = known[np.argsort(numbers[known], kind="stable")]
        names = numbers[by_id]
        first, last = np.searchsorted(names, found["ids"], "left"), np.searchsorted(names, found["ids"], "right")
        while (some := first < last).any():  # a repeated row is cut like the first
            base = bounds[by_id[first[some]]]
            begin = base + found["start"][some]
            np.add.at(edge, begin, 1)
            np.add.at(edge, begin + found["size"][some], -1)
            found = {n: v[some] for n, v in found.items() if n in ("ids", "start", "size")}
            first, last = first[some] + 1, last[some]
        gone = np.cumsum(edge[:-1]) > 0
        begins, ends = gone.copy(), gone.copy()
        begins[1:] &= ~gone[:-1]
        ends[:-1] &= ~gone[1:]
        inner = bounds[(bounds > 0) & (bounds < len(data))]
        begins[inner] = gone[inner]
        ends[inner - 1] = gone[inner - 1]
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        owner = np.searchsorted(bounds, begin, "right") - 1
        offsets = np.searchsorted(owner, np.arange(len(bounds)))
        pairs = pa.StructArray.from_arrays(
            [pa.array(begin - bounds[owner], pa.int32()), pa.array(end - bounds[owner], pa.int32())], ["start", "end"]
        )
        rest = np.concatenate([[0], np.cumsum(~gone)])[bounds]
        kept = pa.Array.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(rest.astype(np.int64).tobytes()), pa.py_buffer(data[~gone].tobytes())]
        )
        return pa.table(
            [ids, pa.array(np.diff(bounds), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs), kept.cast(pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )

    return meet(docs, covered, buckets, run, "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")


def meet(docs: DataFrame, found: DataFrame, buckets: int, run: Callable, schema: str) -> DataFrame:
    """``run`` on the documents of each bucket and what was found about them."""
    left, right = by_bucket(docs, buckets), by_bucket(found, buckets)
    return left.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInArrow(run, schema)
