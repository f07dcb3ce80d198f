"""The trie of all conversations' prefixes, with totals of every subtree, by time-forward processing.

A prefix is known by two 64-bit polynomials over its turns' hashes, so its node needs no pointer. The
nodes of a shard are sorted by reverse level order, and each sends its subtree's totals forward to
its parent through a priority queue that spills to disk: when a parent's turn comes, the messages
of all its children are at the head of the queue.

A shard holds whole subtrees of a bounded size. The few nodes above them are cut into pieces of one
path each; shards of pieces are processed in the same way, then the tree of the pieces' roots, and
then the pieces once more with what their roots' children sent.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonstrata.llm.arrays import BASES, U64
from jsonstrata.llm.frames import col, keep, ready

#: Messages of a queue that are held in memory.
HELD = 1 << 17
#: Turns of one conversation that meet its row of the conversations in one task.
CHUNK = 4096
#: Rows up to which the top of the trie is broadcast; they are counted first.
BROADCAST_ROWS = 200_000
#: Parts that a prefix is spread over where the top is joined without a broadcast.
SPREAD = 64


class SpillingQueue:
    """A priority queue of (key, message) with a bounded number of entries in memory.

    Full queues are written, sorted, to a file that only this task reads, in the folder where the
    executor spills too. A task that is run again starts a queue of its own.
    """

    def __init__(self, held: int = HELD):
        self.held, self.heap, self.heads = held, [], []
        self.count = itertools.count()
        self.runs = 0

    def push(self, key: tuple, message: tuple) -> None:
        heapq.heappush(self.heap, (key, next(self.count), message))
        if len(self.heap) > self.held:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        self.heap.sort()
        for i in range(0, len(self.heap), 1024):
            pickle.dump(self.heap[i : i + 1024], file)
        file.seek(0)
        self.heap = []
        self.runs += 1
        self._advance(self._read(file))

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: Iterator[tuple]) -> None:
        entry = next(run, None)
        if entry is not None:
            heapq.heappush(self.heads, (*entry, run))

    def head(self) -> tuple | None:
        """The least key."""
        if self.heap and (not self.heads or self.heap[0][:2] < self.heads[0][:2]):
            return self.heap[0][0]
        return self.heads[0][0] if self.heads else None

    def pop(self) -> tuple:
        """The message of the least key."""
        if self.heap and (not self.heads or self.heap[0][:2] < self.heads[0][:2]):
            return heapq.heappop(self.heap)[2]
        _, _, message, run = heapq.heappop(self.heads)
        self._advance(run)
        return message


#: A node's place in the order and its parent's (null: in another piece), what it is known by to its
#: children, and its own share of the totals (leaves null: one if no message comes).
SENT = ["shard", "k0", "k1", "k2", "q0", "q1", "q2", "tag", "n_convs", "leaves", "saved"]
TOTALS = "k0 long, k1 long, k2 long, q1 long, q2 long, tag long, n_convs long, children long, leaves long, saved long, parent_tag long"


def _batches(rows: Iterable[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while part := list(itertools.islice(rows, 4096)):
        columns = zip(*part, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def time_forward(rows: Iterable[tuple], held: int = HELD) -> Iterator[tuple]:
    """Every node with its subtree's totals, of rows of ``SENT`` in the order of shard and key.

    A node is given out when its parent's turn has come, with what the parent is known by; without
    that if the parent is not among the shard's nodes.
    """
    queue, at = SpillingQueue(held), None

    def rest() -> Iterator[tuple]:
        while queue.head() is not None:
            yield (*queue.pop(), None)

    for shard, k0, k1, k2, q0, q1, q2, tag, n_convs, leaves, saved in rows:
        if shard != at:
            yield from rest()
            at = shard
        key, children, below = (k0, k1, k2), 0, 0
        while (head := queue.head()) is not None and head <= key:
            message = queue.pop()
            if head < key:
                yield (*message, None)
                continue
            children += 1
            below += message[8]
            saved += message[9]
            yield (*message, tag)
        below += leaves if leaves is not None else not children
        done = (k0, k1, k2, q1, q2, tag, n_convs, children, below, saved)
        if q0 is None:
            yield (*done, None)
        else:
            queue.push((q0, q1, q2), done)
    yield from rest()


def _forward(df: DataFrame, shards: int) -> DataFrame:
    """``time_forward`` in every shard of the rows of ``SENT``."""
    names = [part.split()[0] for part in TOTALS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in SENT), strict=True))
        yield from _batches(time_forward(rows), names, [pa.int64()] * len(names))

    dealt = df.select(*SENT).repartition(shards, "shard").sortWithinPartitions("shard", "k0", "k1", "k2")
    return dealt.mapInArrow(run, TOTALS)


def _power(base: int, n: np.ndarray) -> np.ndarray:
    out, square, n = np.ones(len(n), U64), base, n.astype(U64)
    while n.any():
        out[(n & U64(1)) == 1] *= U64(square)
        square = square * square & (1 << 64) - 1
        n >>= U64(1)
    return out


def _running(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows of (conv_id, key, ...) with ``at``, their rank in their conversation from 1, and (``a``,
    ``b``), the hash of the keys up to theirs, and (``pa``, ``pb``), the hash before.

    Rows are dealt by ranges of (conv_id, ``order``), so a conversation of any length is divided. What
    its earlier parts add to a part is put together on the driver: two rows for each partition at most.
    """
    names = ["part", "at", "a", "b", "pa", "pb"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, total = TaskContext.get().partitionId(), None, 0, [U64(0), U64(0)]
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id").to_numpy()
            n = len(conv)
            new = np.append(True, conv[1:] != conv[:-1])
            start = np.flatnonzero(new)
            segment = np.cumsum(new) - 1
            goes_on = last is not None and conv[0] == last
            at = np.arange(n) - start[segment] + 1
            if goes_on:
                at[segment == 0] += count
            keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), U64).reshape(n, 2)
            after, before = [], []
            for x, base in enumerate(BASES):
                value = keys[:, x] * _power(base, at)
                sums = np.cumsum(value, dtype=U64)
                sums -= (sums - value)[start][segment]
                if goes_on:
                    sums[segment == 0] += total[x]
                total[x] = sums[-1]
                after.append(sums)
                before.append(sums - value)
            last, count = conv[-1], int(at[-1])
            columns = [pa.array(np.full(n, part, np.int32)), pa.array(at), *(pa.array(v.view(np.int64)) for v in (*after, *before))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    ranges = df.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    scanned = keep(ranges.mapInArrow(scan, f"{schema}, part int, at long, a long, b long, pa long, pb long"))
    ends = scanned.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high")).collect()
    seen, divided = set(), set()
    for row in ends:
        for conv in {row["low"], row["high"]}:
            (divided if conv in seen else seen).add(conv)
    if not divided:
        return scanned.drop("part")
    spark = df.sparkSession
    chosen = F.broadcast(spark.createDataFrame([(c,) for c in divided], "conv_id long"))
    last = F.max(F.struct("at", "a", "b")).alias("last")
    parts = sorted((r["conv_id"], r["part"], *r["last"]) for r in scanned.join(chosen, "conv_id").groupBy("conv_id", "part").agg(last).collect())
    carry: dict[tuple[int, int], tuple[int, int, int]] = {}
    mask = (1 << 64) - 1
    for conv, some in itertools.groupby(parts, lambda p: p[0]):
        n, total = 0, [0, 0]
        for _, part, rows, *hashes in some:
            carry[conv, part] = (n, *total)
            total = [(t + pow(base, n, 1 << 64) * (h & mask)) & mask for t, base, h in zip(total, BASES, hashes, strict=True)]
            n += rows

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [carry.get(k, (0, 0, 0)) for k in zip(batch.column("conv_id").to_pylist(), batch.column("part").to_pylist(), strict=True)]
            n, *sums = (np.array(c, U64) for c in zip(*found, strict=True)) if found else [np.zeros(0, U64)] * 3
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["at"] = pa.array(columns["at"].to_numpy() + n.astype(np.int64))
            for x, base in enumerate(BASES):
                power = _power(base, n)
                for c in ("ab"[x], "p" + "ab"[x]):
                    columns[c] = pa.array((columns[c].to_numpy().view(U64) * power + sums[x]).view(np.int64))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return keep(scanned.mapInArrow(carried, scanned.schema)).drop("part")


def steps(
    turns: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """The turns of every conversation in order: (conv_id, at, key, n_bytes).

    ``at`` counts from 1 by the turn's number, null first; turns of one number are ordered by their
    ``key``, the MD5 of role and text (null: empty). Rows without a conversation take no part.
    """
    role, text = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where(col(conv_column).isNotNull()).select(
        col(conv_column).cast("long").alias("conv_id"),
        col(turn_column).cast("long").alias("turn"),
        F.unhex(F.md5(named.cast("binary"))).alias("key"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    ready(turns.sparkSession)
    return _running(rows, ["turn", "key"]).select("conv_id", "at", "key", "n_bytes")


def with_heads(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the head of their group of five: (steps with length, all conv_ids).

    Conversation c starts with the first h turns of c - c % 5 (all if there are fewer), followed by
    its own turns after its first h, with h = crc32(decimal c) % 9.
    """
    convs = keep(rows.groupBy("conv_id").agg(F.max("at").alias("n")))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    group = F.col("conv_id") - F.col("conv_id") % 5
    of_head = convs.select(F.col("conv_id").alias("head"), F.col("n").alias("head_n"))
    info = convs.select("conv_id", "n", h.alias("h"), group.alias("head")).join(of_head, "head", "left")
    info = info.withColumn("m", F.least("h", F.coalesce("head_n", F.lit(0))))
    info = keep(info.withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    heads = rows.where((F.col("conv_id") % 5 == 0) & (F.col("at") <= 8)).withColumnRenamed("conv_id", "head")
    taken = info.select("conv_id", "head", "m", "length").join(heads, "head").where("at <= m")
    taken = taken.select("conv_id", F.col("at").alias("depth"), "key", "n_bytes", "length")
    # A conversation's row meets its turns in chunks, so that a long one is divided.
    chunk = lambda at: F.floor(at / F.lit(CHUNK)).cast("int")
    own = info.where("n > h").select("conv_id", "h", "m", "length", F.explode(F.sequence(F.lit(0), chunk(F.col("n")))).alias("chunk"))
    rest = rows.withColumn("chunk", chunk(F.col("at"))).join(own, ["conv_id", "chunk"]).where("at > h")
    rest = rest.select("conv_id", (F.col("m") + F.col("at") - F.col("h")).alias("depth"), "key", "n_bytes", "length")
    return taken.unionByName(rest), convs.select("conv_id")


def _on_top(rows: DataFrame, by: list[str], top: DataFrame, n_top: int, how: str) -> DataFrame:
    """``rows`` joined with the top's ``by``: broadcast if it is small, else each key spread over parts."""
    if n_top <= BROADCAST_ROWS:
        return rows.join(F.broadcast(top), by, how)
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("conv_id"), F.lit(SPREAD)).cast("int"))
    copies = top.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return dealt.join(copies, [*by, "_part"], how).drop("_part")


def prefix_trie(rows: DataFrame, convs: DataFrame, shard_nodes: int = 100_000, piece_nodes: int = 10_000) -> DataFrame:
    """The nodes of the trie: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256).

    ``rows`` are the turns of all conversations (conv_id, depth from 1 without gaps, key, n_bytes,
    length: its number of turns), ``convs`` all their ids once, also of those without turns. A node
    stands for the conversations that start with one sequence of keys; the root is that of none.
    ``conv_id`` is its smallest member, ``n_leaves`` counts nodes without children in its subtree,
    itself included, ``saved_tokens`` adds up ``(n_convs - 1) * n_bytes`` there, and ``ends_sha256``
    is the SHA-256 of the ids of the members that end there, in order, joined by commas. Without any
    conversation there is no node. Sequences are equal by 128 bits.

    A subtree is *light* when its members have no more than ``shard_nodes`` turns from there on; the
    nodes above light subtrees are the top, with at most the number of turns times the mean length
    over ``shard_nodes`` nodes, cut into paths of ``piece_nodes``.
    """
    ready(rows.sparkSession)
    prefixes = _running(rows.select("conv_id", "depth", "key", "n_bytes", "length"), ["depth"])
    nodes = prefixes.groupBy("a", "b").agg(
        F.min("depth").alias("depth"),
        F.min("pa").alias("pa"),
        F.min("pb").alias("pb"),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("n_bytes").alias("n_bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    nodes = keep(nodes)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("a"), zero.alias("b"), zero.alias("depth"), none.alias("pa"), none.alias("pb"), "conv_id", "n_convs", zero.alias("n_bytes")
    )
    heavy = F.col("weight") > shard_nodes
    top = keep(nodes.where(heavy).drop("weight").unionByName(root))
    n_top = top.count()

    # Light subtrees: a node's shard is that of the first light node on its smallest member's path.
    below = _on_top(prefixes.select("conv_id", "depth", "a", "b"), ["a", "b"], top.select("a", "b"), n_top, "left_anti")
    first = below.groupBy("conv_id").agg(F.min(F.struct("depth", "a", "b")).alias("first"))
    light = nodes.where(~heavy)
    shards = max(1, -(-light.count() // shard_nodes))
    light = light.join(first, "conv_id").select(
        F.pmod(F.xxhash64("first.a", "first.b"), F.lit(shards)).alias("shard"),
        (-F.col("depth")).alias("k0"), F.col("a").alias("k1"), F.col("b").alias("k2"),
        (1 - F.col("depth")).alias("q0"), F.col("pa").alias("q1"), F.col("pb").alias("q2"),
        F.col("conv_id").alias("tag"), "n_convs", none.alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
    )
    light = keep(_forward(light, shards))
    # What the roots of the light subtrees hand to the top.
    sent = light.where("parent_tag IS NULL").groupBy(F.col("q1").alias("a"), F.col("q2").alias("b"))
    sent = sent.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count(F.lit(1)).alias("children"))

    # The top: pieces of paths, then the tree of the pieces, then the pieces again.
    inner = top.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("inner"))
    parents = top.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent"))
    top = top.join(sent, ["a", "b"], "left").join(inner, ["a", "b"], "left").join(parents, ["pa", "pb"], "left")
    got = lambda c: F.coalesce(c, F.lit(0))
    band = lambda depth: F.floor(depth / F.lit(piece_nodes))
    top = top.withColumn("children", got("children") + got("inner"))
    top = top.withColumn("leaves", got("leaves") + (F.col("children") == 0).cast("long"))
    top = top.withColumn("saved", got("saved") + (F.col("n_convs") - 1) * F.col("n_bytes"))
    top = top.withColumn("band", band(F.col("depth"))).withColumn("parent_band", band(F.col("depth") - 1))
    top = keep(top.withColumn("within", F.coalesce((F.col("parent") == F.col("conv_id")) & (F.col("parent_band") == F.col("band")), F.lit(False))))
    top_shards = max(1, -(-n_top // shard_nodes))

    def through(pieces: DataFrame) -> DataFrame:
        return _forward(
            pieces.select(
                F.pmod(F.xxhash64("conv_id", "band"), F.lit(top_shards)).alias("shard"),
                (-F.col("depth")).alias("k0"), F.col("a").alias("k1"), F.col("b").alias("k2"),
                F.when(F.col("within"), 1 - F.col("depth")).alias("q0"), F.col("pa").alias("q1"), F.col("pb").alias("q2"),
                F.col("conv_id").alias("tag"), "n_convs", "leaves", "saved",
            ),
            top_shards,
        )

    roots = top.where(~F.col("within")).select(F.col("a").alias("k1"), F.col("b").alias("k2"), "band", "parent", "parent_band", "pa", "pb")
    alone = through(top).join(roots, ["k1", "k2"])
    # A parent's piece lies in an earlier band, or in the same one with a smaller conversation.
    tree = alone.select(
        F.lit(0).cast("long").alias("shard"), (-F.col("band")).alias("k0"), (-F.col("tag")).alias("k1"), zero.alias("k2"),
        F.when(F.col("parent").isNotNull(), -F.col("parent_band")).alias("q0"), (-F.col("parent")).alias("q1"), zero.alias("q2"),
        "tag", "n_convs", "leaves", "saved", "pa", "pb",
    )
    tree = keep(tree)
    whole = _forward(tree, 1).select("k0", "k1", "leaves", "saved")
    whole = tree.select("k0", "k1", "pa", "pb").join(whole, ["k0", "k1"]).where("pa IS NOT NULL")
    arrived = whole.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    full = top.join(arrived, ["a", "b"], "left")
    full = full.withColumn("leaves", F.col("leaves") + got("more_leaves")).withColumn("saved", F.col("saved") + got("more_saved"))
    upper = through(full).select("k1", "k2", "leaves", "saved")
    upper = top.select(F.col("a").alias("k1"), F.col("b").alias("k2"), "conv_id", "depth", "parent", "n_convs", "children").join(upper, ["k1", "k2"])

    of_top = parents.select(F.col("pa").alias("q1"), F.col("pb").alias("q2"), "parent")
    light = light.withColumnRenamed("tag", "conv_id")
    lower = light.where("parent_tag IS NOT NULL").withColumn("parent", F.col("parent_tag"))
    lower = lower.unionByName(_on_top(light.where("parent_tag IS NULL"), ["q1", "q2"], of_top, n_top, "inner"))
    lower = lower.select("k1", "k2", "conv_id", (-F.col("k0")).alias("depth"), "parent", "n_convs", "children", "leaves", "saved")

    last = prefixes.where("depth = length").select("a", "b", "conv_id")
    turnless = convs.join(rows.where("depth = 1").select("conv_id"), "conv_id", "left_anti").select(zero.alias("a"), zero.alias("b"), "conv_id")
    ends = _digests(last.unionByName(turnless)).select(F.col("a").alias("k1"), F.col("b").alias("k2"), "sha256")
    return lower.unionByName(upper).join(ends, ["k1", "k2"], "left").select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _digests(ends: DataFrame) -> DataFrame:
    """(a, b, sha256) of the ids of each (a, b) in order, joined by commas.

    Ids are sorted by ranges and joined up by batches, in all tasks; what a task hashes in sequence
    for one node are those texts, passing by.
    """

    def runs(*columns: np.ndarray) -> list[int]:
        new = np.zeros(len(columns[0]) - 1, bool)
        for c in columns:
            new |= c[1:] != c[:-1]
        return [0, *(np.flatnonzero(new) + 1).tolist(), len(columns[0])]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, conv = (batch.column(c).to_numpy() for c in ("a", "b", "conv_id"))
                edges = runs(a, b)
                text = [",".join(map(str, conv[i:j].tolist())) for i, j in itertools.pairwise(edges)]
                at = edges[:-1]
                yield pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(b[at]), pa.array(conv[at]), pa.array(text)], ["a", "b", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            at, sha = None, None
            for batch in batches:
                for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
                    if (a, b) == at:
                        sha.update(b"," + ids.encode())
                        continue
                    if at is not None:
                        yield (*at, sha.hexdigest())
                    at, sha = (a, b), hashlib.sha256(ids.encode())
            if at is not None:
                yield (*at, sha.hexdigest())

        yield from _batches(rows(), ["a", "b", "sha256"], [pa.int64(), pa.int64(), pa.string()])

    packed = ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    packed = packed.mapInArrow(pack, "a long, b long, first long, ids string")
    return packed.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(digest, "a long, b long, sha256 string")
