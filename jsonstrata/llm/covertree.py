"""Hard negatives of anchors, by cover trees over norm-augmented vectors.

A further component gives all vectors of a shard the same length, so that the inner product with a
query falls as the distance grows. Every node of a shard's cover tree is a vector, with the radius
that covers all below it; at each level the radius is halved and nodes lie further apart than it.
The distance to a node and its radius bound the scores below it from both sides. A search goes down
best-first, skips nodes that are outside all of its windows of scores, and checks leaves exactly.

A shard's tree is built once and written with its vectors, in the tree's order. Searches send the
queries, the narrow side, to the shards: a task reads a shard and then lets its queries pass.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jsonstrata.llm.frames import col, keep, ready
from jsonstrata.llm.kdtree import EXACT, LONG, integers, matrix
from jsonstrata.llm.shards import index_rows, let_pass, send

#: Vectors that are checked without further levels.
LEAF = 16
#: Vectors of leaves that are checked at once, before the bounds are looked at again.
CHECKED = 1024
#: Relative rounding error that bounds allow for.
SLACK = 1e-6


def cover(vectors: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """A cover tree of whole vectors: their order, and its nodes level by level as arrays.

    ``first`` and ``last`` are the places of a node's vectors in that order, its own vector first;
    ``low`` and ``high`` are its children (none: a leaf), which stand one after another.
    """
    flat = vectors.astype(np.float64)
    norms = np.einsum("ij,ij->i", flat, flat)
    longest = norms.max(initial=0.0)
    points = np.column_stack([flat, np.sqrt(np.maximum(longest - norms, 0.0))])
    order = np.arange(len(points))
    first, last, radius, low, high = [0], [len(points)], [], [], []
    number = 0
    while number < len(first):
        a, b = first[number], last[number]
        here = points[order[a:b]]
        gaps = here - here[0]
        r = float(np.sqrt(np.einsum("ij,ij->i", gaps, gaps).max(initial=0.0)))
        radius.append(r)
        low.append(len(first))
        if b - a > LEAF and r > 0 and np.isfinite(r):
            places = _net(here, r / 2)
            order[a:b] = order[a:b][np.concatenate(places)]
            ends = a + np.cumsum([len(p) for p in places])
            first += [a, *ends[:-1].tolist()]
            last += ends.tolist()
        high.append(len(first))
        number += 1
    nodes = {"first": first, "last": last, "low": low, "high": high}
    return order, {**{k: np.array(v, np.int32) for k, v in nodes.items()}, "radius": np.array(radius), "longest": np.array(longest)}


def _net(points: np.ndarray, reach: float) -> list[np.ndarray]:
    """Places of the points, each with the first centre within ``reach``; a centre is no other's."""
    places, left = [], np.arange(len(points))
    open_ = np.ones(len(left), bool)
    while True:
        at = np.flatnonzero(open_)
        if not len(at):
            return places
        if 4 * len(at) < 3 * len(open_):
            left, points = left[at], points[at]
            open_, at = np.ones(len(left), bool), np.arange(len(left))
        gaps = points - points[at[0]]
        near = open_ & (np.einsum("ij,ij->i", gaps, gaps) <= reach * reach)
        near[at[0]] = True
        places.append(left[near])
        open_ &= ~near


@dataclass
class Search:
    """What a query looks for: the ``k`` best of the same or of other labels, in each window of scores."""

    vector: np.ndarray
    own: int
    label: int
    same: bool
    k: int
    windows: list[tuple[float, float]]


class Shard:
    """The vectors of a shard with their tree."""

    def __init__(self, nodes: dict[str, np.ndarray], vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.nodes, self.vectors, self.ids, self.labels = nodes, vectors, ids, labels
        self.centres = vectors[nodes["first"]]
        self.checked = 0

    def _bounds(self, search: Search, length: float, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and highest score below each of the nodes a to b."""
        score = (self.centres[a:b] @ search.vector).astype(np.float64)
        both = float(self.nodes["longest"]) + length
        if not np.isfinite(both):
            return np.full(b - a, -np.inf), np.full(b - a, np.inf)
        distance = np.sqrt(np.maximum(both - 2 * score, 0.0))
        radius, slack = self.nodes["radius"][a:b], SLACK * both + 1
        nearest = np.maximum(distance - radius, 0.0)
        return (both - (distance + radius) ** 2) / 2 - slack, (both - nearest**2) / 2 + slack

    def find(self, search: Search) -> list[list[tuple[int, int]]]:
        """For each window the best (score, id); ties to the smaller id."""
        best: list[list[tuple[int, int]]] = [[] for _ in search.windows]
        lows = np.array([w[0] for w in search.windows], np.float64)
        highs = np.array([w[1] for w in search.windows], np.float64)
        length = float(sum(float(x) ** 2 for x in search.vector))
        kind = self.vectors.dtype

        def inside(below: np.ndarray, above: np.ndarray) -> np.ndarray:
            return ((above[:, None] >= lows) & (below[:, None] <= highs)).any(axis=1)

        def check(places: np.ndarray) -> None:
            self.checked += len(places)
            scores = self.vectors[places] @ search.vector
            if kind == object:
                scores = np.clip(scores, -LONG, LONG)
            right = (self.labels[places] == search.label) == search.same
            right &= self.ids[places] != search.own
            for w, (low, high) in enumerate(search.windows):
                # Beyond doubles the bound is only near the k-th best, so the window itself decides.
                least = low if kind == object else lows[w]
                some = np.flatnonzero(right & (scores >= least) & (scores <= high))
                if not len(some):
                    continue
                found = [(int(scores[x]), -int(self.ids[places[x]])) for x in some[np.lexsort((self.ids[places[some]], -scores[some]))][: search.k]]
                best[w] = heapq.nlargest(search.k, [*best[w], *found])
                if len(best[w]) == search.k:
                    lows[w] = max(lows[w], best[w][-1][0] - (SLACK * abs(best[w][-1][0]) if kind == object else 0))

        waiting: list[tuple[float, int, float]] = [(-np.inf, 0, -np.inf)]
        first, last, low, high = (self.nodes[x] for x in ("first", "last", "low", "high"))
        while waiting:
            above, number, below = heapq.heappop(waiting)
            if not inside(np.array([below]), np.array([-above]))[0]:
                continue
            a, b = low[number], high[number]
            if a == b:
                check(np.arange(first[number], last[number]))
                continue
            below, above = self._bounds(search, length, a, b)
            ok = np.flatnonzero(inside(below, above))
            ends = ok[low[a + ok] == high[a + ok]]
            for x in ok[low[a + ok] != high[a + ok]]:
                heapq.heappush(waiting, (-above[x], int(a + x), below[x]))
            ends = ends[np.argsort(-above[ends], kind="stable")]
            while len(ends):
                sizes = last[a + ends] - first[a + ends]
                n = max(1, int(np.searchsorted(np.cumsum(sizes), CHECKED, "right")))
                part = np.repeat(first[a + ends[:n]] - np.concatenate([[0], np.cumsum(sizes[:n])[:-1]]), sizes[:n])
                check(part + np.arange(len(part)))
                ends = ends[n:]
                ends = ends[inside(below[ends], above[ends])]
        return [[(score, -i) for score, i in some] for some in best]


INDEX = "shard int, kind int, pos int, vec_id long, label long, vector array<double>, tree binary"
POSITIVES = "array<struct<no:int,vec_id:bigint,score:bigint>>"
FOUND = "anchor_id long, no int, positive_id long, positive_score long, vec_id long, score long"
COLUMNS = ["vec_id", "label", "vector"]


def _builder(width: int, exact: bool):
    def build(group: pa.Table) -> pa.Table:
        order, nodes = cover(matrix(group.column("vector"), width, exact))
        return index_rows(group, order, nodes, COLUMNS)

    return build


def _searcher(width: int, exact: bool, same: bool, k: int, low: int, high: int):
    """Lets the queries of a shard pass by its tree; rows come in the order of (shard, kind, pos)."""

    def make(nodes: dict[str, np.ndarray], points: pa.Table) -> Shard:
        ids, labels = (points.column(c).to_numpy() for c in ("vec_id", "label"))
        return Shard(nodes, matrix(points.column("vector"), width, exact), ids, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return let_pass(batches, COLUMNS, make, _answers)

    def _answers(shard: Shard, part: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        vectors = matrix(part.column("vector"), width, exact)
        columns = (part.column(c).to_pylist() for c in ("vec_id", "label", "positives"))
        for vector, own, label, positives in zip(vectors, *columns, strict=True):
            goals = positives or [{"no": None, "vec_id": None, "score": None}]
            windows = [(-np.inf, np.inf)] if positives is None else [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in goals]
            found = shard.find(Search(vector, own, label, same, k, windows))
            rows += [(own, p["no"], p["vec_id"], p["score"], i, s) for p, some in zip(goals, found, strict=True) for s, i in some]
        names = ["anchor_id", "no", "positive_id", "positive_score", "vec_id", "score"]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        kinds = [pa.int32() if c == "no" else pa.int64() for c in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return run


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    shard_rows: int = 8_192,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
) -> DataFrame:
    """For each anchor and each of its positives, the hardest negatives:
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of the floors of 256 times the components. An anchor's positives
    are the ``positives`` best other rows of its label; the negatives of a positive are the
    ``negatives`` best rows of other labels with ``low * positive_score <= 100 * negative_score <=
    high * positive_score``. Higher scores come first, ties by the smaller id; ranks start from 1.
    An anchor without positives and a positive without negatives have no rows.

    Rows without an id, label or vector, and those whose vector holds a null, infinite or undefined
    component, take no part. Rows that repeat whole count once; further rows of the anchor's own id
    are not others. Of several anchors of one id the least label and vector counts. A missing
    component of a shorter vector is 0, a score beyond a long the nearest long. Empty tables give no
    rows; other columns may have any name. Every shard has about ``shard_rows`` vectors, whatever
    their labels and however often a vector occurs under different ids.
    """

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(col(id_column).cast("long").alias("vec_id"), col(label_column).cast("long").alias("label"), col(vector_column).alias("vector"))
        sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
        whole = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound)
        return whole.select("vec_id", "label", integers(F.col("vector")).alias("vector"))

    ready(vectors.sparkSession)
    base = keep(usable(vectors).distinct())
    asked = keep(usable(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*"))
    size = lambda df: df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width"),
        F.coalesce(F.max(F.array_max(F.transform("vector", lambda x: F.abs(x)))), F.lit(0.0)).alias("most"),
    ).first()
    n, of_asked = size(base), size(asked)
    shards = max(1, -(-n["n"] // shard_rows))
    width = max(n["width"], of_asked["width"], 1)
    exact = width * max(n["most"], of_asked["most"]) ** 2 < EXACT

    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    dealt = base.select(shard.alias("shard"), "vec_id", "label", "vector")
    index = keep(dealt.groupBy("shard").applyInArrow(_builder(width, exact), INDEX))

    def search(queries: DataFrame, same: bool, k: int) -> DataFrame:
        sent = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), *COLUMNS, "positives")
        both = send(index, sent, shards)
        return both.mapInArrow(_searcher(width, exact, same, k, low, high), FOUND)

    best = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id"))
    none = F.lit(None).cast(POSITIVES)
    first = search(asked.withColumn("positives", none), True, positives).withColumn("no", best).where(F.col("no") <= positives)
    # At most ``positives`` of each anchor come together.
    goals = first.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("no", "vec_id", "score"))).cast(POSITIVES).alias("positives"))
    goals = keep(asked.join(goals.withColumnRenamed("anchor_id", "vec_id"), "vec_id"))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "no").orderBy(F.desc("score"), "vec_id"))
    return (
        search(goals, False, negatives)
        .withColumn("rank", rank)
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
