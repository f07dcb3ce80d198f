"""Exact search for the highest inner products with a KD-tree in every shard.

Vectors are dealt to shards. Each shard builds a tree by median splits, every node with the tight box
of its vectors. A query visits the nodes of a shard best-first by the highest inner product that a
box allows, and stops when no box can reach its k-th best. The k-th best that a query finds in its
first shard goes with it to all others. Trees are built once and written with their vectors; queries
are sent to them.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jsonstrata.llm.frames import col, keep, ready
from jsonstrata.llm.shards import index_rows, let_pass, send

LEAF = 128
#: Up to here sums of products are whole numbers as doubles.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


class Tree:
    """A tree over integer vectors, as arrays of nodes."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.vectors, self.ids = vectors, ids
        self.order = np.arange(len(ids))
        low, high, nodes = [], [], []  # node: (first, last, left child or -1); the right child follows the left
        waiting = [(0, len(ids), None)]
        while waiting:
            first, last, parent = waiting.pop(0)
            rows = vectors[self.order[first:last]]
            a, b = rows.min(axis=0), rows.max(axis=0)
            if parent is not None and nodes[parent][2] < 0:
                nodes[parent][2] = len(nodes)
            number = len(nodes)
            low.append(a)
            high.append(b)
            nodes.append([first, last, -1])
            widest = int(np.argmax(b - a))
            if last - first <= leaf or a[widest] == b[widest]:
                continue
            middle = (last - first) // 2
            part = np.argsort(rows[:, widest], kind="stable")
            self.order[first:last] = self.order[first:last][part]
            waiting += [(first, first + middle, number), (first + middle, last, number)]
        self.nodes = nodes
        self.low, self.high = np.array(low), np.array(high)
        self.vectors = vectors[self.order]
        self.ids = ids[self.order]

    @classmethod
    def of(cls, parts: tuple, vectors: np.ndarray, ids: np.ndarray) -> Tree:
        """A tree that was built before, over its vectors in its order."""
        tree = cls.__new__(cls)
        tree.nodes, tree.low, tree.high = parts
        tree.vectors, tree.ids = vectors, ids
        return tree

    def search(self, query: np.ndarray, own: int, k: int, kth: float) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) with scores of ``kth`` or more; ties to the smaller id."""
        up, down = np.maximum(query, 0), np.minimum(query, 0)

        def bounds(first: int, last: int) -> np.ndarray:
            return self.high[first:last] @ up + self.low[first:last] @ down

        found: list[tuple] = []  # a heap of the best so far, the worst first
        waiting = [(-bounds(0, 1)[0], 0)]
        while waiting:
            bound, number = heapq.heappop(waiting)
            if -bound < kth:
                break
            first, last, child = self.nodes[number]
            if child >= 0:
                both = bounds(child, child + 2)
                for x in (0, 1):
                    if both[x] >= kth:
                        heapq.heappush(waiting, (-both[x], child + x))
                continue
            scores = self.vectors[first:last] @ query
            if scores.dtype == object:
                scores = np.clip(scores, -LONG, LONG)
            for x in np.flatnonzero(scores >= kth):
                if self.ids[first + x] == own:
                    continue
                entry = (int(scores[x]), -int(self.ids[first + x]))
                if len(found) < k:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
            if len(found) == k:
                kth = max(kth, found[0][0])
        return [(score, -i) for score, i in found]


def matrix(column: pa.ChunkedArray | pa.Array, width: int, exact: bool) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros; Python's numbers where doubles are not ``exact``."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.float64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out if exact else np.array([[int(x) for x in row] for row in out.tolist()], dtype=object).reshape(out.shape)


def integers(vector: Column) -> Column:
    """Components as the floor of 256 times their value."""
    return F.transform(vector, lambda x: F.floor(F.lit(256) * x.cast("double")).cast("double"))


INDEX = "shard int, kind int, pos int, vec_id long, vector array<double>, tree binary"
COLUMNS = ["vec_id", "vector"]
FOUND = "query_id long, vec_id long, score long"


def build_index(dealt: DataFrame, width: int, exact: bool) -> DataFrame:
    """The tree of every shard with its vectors, of rows (shard, vec_id, vector)."""

    def build(group: pa.Table) -> pa.Table:
        tree = Tree(matrix(group.column("vector"), width, exact), group.column("vec_id").to_numpy())
        return index_rows(group, tree.order, (tree.nodes, tree.low, tree.high), COLUMNS)

    return dealt.groupBy("shard").applyInArrow(build, INDEX)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    shard_rows: int = 8_192,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` vectors of highest integer inner product: (query_id, rank, vec_id, score).

    Both frames have an id and an array of numbers, of which the floor of 256 times each is used.
    Every vector but those of the query's own id is a candidate; ties go to the smaller id; ranks
    start from 1. Vectors that are null or hold a null, infinite or undefined component take no
    part, nor do rows without an id; a missing component of a shorter vector counts as 0. A score
    beyond the range of a long counts as the nearest long. A row repeated among the vectors may be
    returned as often, a row repeated among the queries is answered once. Empty tables give no rows;
    other columns may have any name.

    Shards have about ``shard_rows`` vectors.
    """

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(col(id_column).cast("long").alias("vec_id"), col(vector_column).alias("vector"))
        sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
        return rows.where(F.col("vec_id").isNotNull() & sound).select("vec_id", integers(F.col("vector")).alias("vector"))

    ready(vectors.sparkSession)
    base = keep(usable(vectors))
    asked = keep(usable(queries).dropDuplicates(["vec_id"]))
    size = lambda df: df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width"),
        F.coalesce(F.max(F.array_max(F.transform("vector", lambda x: F.abs(x)))), F.lit(0.0)).alias("most"),
    ).first()
    of_base, of_asked = size(base), size(asked)
    shards = max(1, -(-of_base["n"] // shard_rows))
    width = max(of_base["width"], of_asked["width"], 1)
    exact = width * max(of_base["most"], of_asked["most"]) ** 2 < EXACT

    # By the vector too, so that rows of one id are spread as well.
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    index = keep(build_index(base.select(shard.alias("shard"), "vec_id", "vector"), width, exact))

    def make(parts: tuple, points: pa.Table) -> Tree:
        return Tree.of(parts, matrix(points.column("vector"), width, exact), points.column("vec_id").to_numpy())

    def answer(tree: Tree, part: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        columns = (part.column(c).to_pylist() for c in ("vec_id", "kth"))
        for query, own, kth in zip(matrix(part.column("vector"), width, exact), *columns, strict=True):
            rows += [(own, i, s) for s, i in tree.search(query, own, k, -np.inf if kth is None else kth)]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    def meet(queries: DataFrame) -> DataFrame:
        sent = send(index, queries.select("shard", *COLUMNS, "kth"), shards)
        return sent.mapInArrow(lambda batches: let_pass(batches, COLUMNS, make, answer), FOUND)

    asked = asked.withColumn("home", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int"))
    first = keep(meet(asked.withColumn("shard", F.col("home")).withColumn("kth", F.lit(None).cast("long"))))
    every = first
    if shards > 1:
        # A full answer of the home shard bounds the k-th best from below.
        reached = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
        others = asked.join(reached.select(F.col("query_id").alias("vec_id"), "kth"), "vec_id", "left")
        others = others.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
        every = first.unionByName(meet(others))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        every.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
