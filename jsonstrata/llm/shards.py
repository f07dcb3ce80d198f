"""Search structures that are built once a shard and written, and queries that are sent to them.

An index has a row for each shard's structure and one for each of its points, in the structure's
order. A search sends the queries, which are few beside the points, to the shards: a task reads a
shard, then lets its queries pass by, batch by batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of rows, in the order in which a task meets them.
TREE, POINT, QUERY = 0, 1, 2


def index_rows(group: pa.Table, order: np.ndarray, tree: object, columns: list[str]) -> pa.Table:
    """A shard's rows (shard, kind, pos, columns, tree): its structure, then its points in ``order``."""
    rows = group.take(pa.array(order))
    n = len(rows)
    shard = rows.column("shard").combine_chunks()
    points = pa.table(
        [shard, pa.array(np.full(n, POINT, np.int32)), pa.array(np.arange(n, dtype=np.int32)),
         *(rows.column(c).combine_chunks() for c in columns), pa.nulls(n, pa.binary())],
        names=["shard", "kind", "pos", *columns, "tree"],
    )
    head = [shard.slice(0, 1), pa.array([TREE], pa.int32()), pa.array([0], pa.int32())]
    head += [pa.nulls(1, points.schema.field(c).type) for c in columns]
    return pa.concat_tables([pa.table([*head, pa.array([pickle.dumps(tree)], pa.binary())], schema=points.schema), points])


def send(index: DataFrame, queries: DataFrame, shards: int) -> DataFrame:
    """The index beside queries that name their ``shard``, in the order in which :func:`let_pass` wants them."""
    sent = queries.withColumns({"kind": F.lit(QUERY), "pos": F.lit(0), "tree": F.lit(None).cast("binary")})
    more = {f.name: F.lit(None).cast(f.dataType) for f in sent.schema.fields if f.name not in index.columns}
    both = index.withColumns(more).unionByName(sent) if more else index.unionByName(sent)
    return both.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "pos")


def let_pass(
    batches: Iterator[pa.RecordBatch],
    columns: list[str],
    make: Callable[[object, pa.Table], object],
    answer: Callable[[object, pa.RecordBatch], pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """``answer(made, queries)`` for each batch of a shard's queries, with ``made = make(tree, points)``
    once a shard; a shard that no query reaches is passed over."""
    made, parts, tree, at = None, [], None, None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "kind")])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            if i == j:
                continue
            part, kind = batch.slice(i, j - i), keys[1, i]
            if kind == TREE:
                tree, made, parts, at = pickle.loads(part.column("tree")[0].as_py()), None, [], keys[0, i]
            elif kind == POINT:
                parts.append(part.select(columns))
            elif keys[0, i] == at:
                if made is None:
                    made, parts = make(tree, pa.Table.from_batches(parts)), []
                yield answer(made, part)
