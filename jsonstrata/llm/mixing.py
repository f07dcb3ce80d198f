"""Mixing sources to target weights with a min-cost flow over membership patterns.

Documents are added up by the set of sources they belong to. Tokens flow from each pattern to its
sources and on to their quotas; a pattern's first pass over its documents is free and every further
pass costs more, so that a source is repeated only where fresh documents don't suffice. The flow
says how many tokens each pattern gives; documents are then chosen in an order made from a seed.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jsonstrata.llm.frames import col, keep

#: Cost of a token in the first, second and third pass. The growth makes repetition convex.
PASS_COSTS = (0, 1, 3)
#: Patterns up to which their table is broadcast.
BROADCAST_PATTERNS = 100_000
#: The words of a text: runs of anything but space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def capped_shares(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Targets that share the sum of ``sizes`` by weight, none above ``most`` times its size.

    What a source can't take is shared by weight among those that aren't full, until none is above.
    """
    target = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    left = float(sum(sizes))
    while free:
        weight = sum(weights[i] for i in free)
        full = {i for i in free if left * weights[i] / weight > most * sizes[i]}
        if not full:
            for i in free:
                target[i] = left * weights[i] / weight
            break
        for i in full:
            target[i] = most * sizes[i]
        left -= sum(target[i] for i in full)
        free -= full
    return target


def route(patterns: dict[tuple[str, ...], int], quotas: dict[str, int], costs: tuple[int, ...] = PASS_COSTS) -> dict:
    """Tokens from each pattern to each of its sources at the least cost of repetition.

    Successive cheapest paths: sources that share no pattern are settled apart.
    """
    root = {s: s for s in quotas}

    def find(s: str) -> str:
        while root[s] != s:
            root[s] = root[root[s]]
            s = root[s]
        return s

    for pattern in patterns:
        for s in pattern[1:]:
            root[find(s)] = find(pattern[0])
    parts = defaultdict(dict)
    for pattern, tokens in patterns.items():
        if pattern:
            parts[find(pattern[0])][pattern] = tokens
    flow: dict = {}
    for part in parts.values():
        flow |= _flow(part, {s: quotas[s] for p in part for s in p}, costs)
    return flow


def _flow(patterns: dict[tuple[str, ...], int], quotas: dict[str, int], costs: tuple[int, ...]) -> dict:
    start, stop = ("start",), ("stop",)
    arcs: list[list] = []  # to, room, cost, flow back is the next or previous arc
    out = defaultdict(list)

    def arc(a: tuple, b: tuple, room: int, cost: int) -> int:
        out[a].append(len(arcs))
        arcs.append([b, room, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])
        return len(arcs) - 2

    between = {}
    for pattern, tokens in sorted(patterns.items()):
        for cost in costs:
            arc(start, ("pattern", pattern), tokens, cost)
        for s in pattern:
            between[pattern, s] = arc(("pattern", pattern), ("source", s), tokens * len(costs), 0)
    for s, quota in sorted(quotas.items()):
        arc(("source", s), stop, quota, 0)
    while True:
        cost, by = {start: 0}, {}
        queue, waiting = deque([start]), {start}
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for i in out[a]:
                b, room, c = arcs[i]
                if room > 0 and cost[a] + c < cost.get(b, float("inf")):
                    cost[b], by[b] = cost[a] + c, i
                    if b not in waiting:
                        waiting.add(b)
                        queue.append(b)
        if stop not in by:
            break
        path, at = [], stop
        while at != start:
            path.append(by[at])
            at = arcs[by[at] ^ 1][0]
        amount = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= amount
            arcs[i ^ 1][1] += amount
    return {key: arcs[i ^ 1][1] for key, i in between.items()}


def _taken(pdf):
    """Documents of the bucket where one pattern's share ends, taken in order while they fit, and what is left."""
    left = int(pdf["need"].iloc[0])
    pdf = pdf.sort_values(["order", "doc_id", "size"], kind="stable")
    extra = []
    for size in pdf["size"].tolist():
        extra.append(int(size <= left))
        left -= size if size <= left else 0
    pdf["extra"] = extra
    return pdf, left


def _fill(pdf):
    return _taken(pdf)[0][["doc_id", "sources", "size", "passes", "order", "extra"]]


def _rest(pdf):
    pdf, left = _taken(pdf)
    pdf["rest"] = left
    return pdf[["sources", "rest"]].head(1)


def _beside(df: DataFrame, rows: int) -> DataFrame:
    """A table of a row for each pattern, sent to all tasks if it has few rows.

    A source may hold a third of the documents, so they should not be shuffled by pattern; beyond the
    bound Spark's join divides such a source.
    """
    return F.broadcast(df) if rows <= BROADCAST_PATTERNS else df


def _rounds(rows: DataFrame, left: dict[tuple[str, ...], int], most: dict[tuple[str, ...], int]) -> dict[tuple[str, ...], tuple[list[int], int]]:
    """For each pattern the sizes up to which documents get one more pass each, and what is left then.

    Only documents that fit what is left can be chosen for it. Where even all of them are too few,
    as beside one very long document, all are taken and the rest is sought once more, up to ``most`` times.
    """
    spark = rows.sparkSession
    done = {p: ([], n) for p, n in left.items()}
    while True:
        open_ = [(list(p), n) for p, (up_to, n) in done.items() if n and len(up_to) < most[p]]
        if not open_:
            break
        words_left = spark.createDataFrame(open_, "sources array<string>, left long")
        fits = rows.join(_beside(words_left, len(open_)), "sources")
        sums = fits.where("size <= left").groupBy("sources").agg(F.sum("size").alias("tokens")).collect()
        short = {tuple(r["sources"]): r["tokens"] for r in sums}
        changed = False
        for p, n in ((tuple(p), n) for p, n in open_):
            if 0 < short.get(p, 0) < n:
                done[p] = ([*done[p][0], n], n - short[p])
                changed = True
        if not changed:
            break
    return done


def _ends(dealt: DataFrame, left: dict[tuple[str, ...], int]) -> tuple[dict[tuple[str, ...], list], dict[tuple[str, ...], int]]:
    """For each pattern the steps that take what is left, and what no document fits at last.

    A step is a size, the bucket where the share ends, and what is left there: documents of up to that
    size are taken in all buckets since the last step, and one by one in its own. What a longer
    document left open there is sought in the next step among the later buckets, by documents that
    still fit. A step goes on by a bucket at least, and each is two small jobs.
    """
    spark = dealt.sparkSession
    steps, open_ = {p: [] for p in left}, {p: (n, -1) for p, n in left.items() if n}
    left = dict(left)
    before = Window.partitionBy("sources").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    past = F.col("start") + F.col("tokens") > F.col("left")
    while open_:
        state = [(list(p), n, after) for p, (n, after) in open_.items()]
        state = _beside(spark.createDataFrame(state, "sources array<string>, left long, after long"), len(state))
        found = (
            dealt.join(state, "sources")
            .where("bucket > after AND size <= left")
            .groupBy("sources", "bucket", "left")
            .agg(F.sum("size").alias("tokens"))
            .withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
            .groupBy("sources")
            .agg(
                F.sum("tokens").alias("tokens"),
                F.min(F.when(past, F.struct("bucket", (F.col("left") - F.col("start")).alias("need")))).alias("end"),
            )
            .collect()
        )
        ended = []
        for r in found:
            p, end = tuple(r["sources"]), r["end"]
            n = open_[p][0]
            steps[p].append((n, end["bucket"] if end else None, end["need"] if end else 0))
            left[p] = end["need"] if end else n - r["tokens"]
            if left[p] and end:
                ended.append((list(p), n, end["bucket"], left[p]))
        open_ = {}
        if ended:
            here = _beside(spark.createDataFrame(ended, "sources array<string>, left long, bucket long, need long"), len(ended))
            rows = dealt.join(here, ["sources", "bucket"]).where("size <= left")
            rest = rows.select("sources", "order", "doc_id", "size", "need").groupBy("sources")
            for r in rest.applyInPandas(_rest, "sources array<string>, rest long").collect():
                left[tuple(r["sources"])] = r["rest"]
            open_ = {tuple(p): (left[tuple(p)], bucket) for p, _, bucket, _ in ended if left[tuple(p)]}
    return steps, left


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    most: int = 3,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    rows_per_bucket: int = 2_000,
) -> DataFrame:
    """How often the mix takes each document: (doc_id, sources, size, source_size, target, passes).

    ``source_column`` holds a source or an array of sources; null is a source of its own. ``size``
    is the number of words (null text: 0). The mix has as many words as the documents, shared by
    weight; without ``weights`` sources weigh 1, 2, 3, repeating, in code point order, null last.
    A source gives at most ``most`` times its size. ``source_size`` and ``target`` are the sums over
    the document's sources. ``passes`` times ``size`` words are taken.

    Sources are part of the mix's definition: the driver holds a number for each source and pattern,
    never documents. Documents are ordered by a hash of seed and id, in buckets, so a source may hold
    any share of the rows; only the buckets where a source's share ends are looked at row by row. What a
    long document leaves open there is filled from the later buckets until nothing fits, and a document
    (with its repeated rows) that passes the end by less than is open is taken last.
    Repeated rows are documents of their own, documents without words are taken 0 times, empty tables
    give no rows, and other columns may have any name.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[source_column]
    listed = col(source_column) if kind.startswith("array") else F.array(col(source_column))
    named = F.transform(listed, lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit("~")))
    rows = keep(
        docs.select(
            col(id_column).alias("doc_id"),
            F.array_sort(F.array_distinct(F.coalesce(named, F.array(F.lit("~"))))).alias("sources"),
            F.coalesce(F.regexp_count(col(text_column), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), col(id_column)).alias("order"),
        )
    )
    found = rows.groupBy("sources").agg(F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("n")).collect()
    patterns = {tuple(r["sources"]): r["tokens"] for r in found}
    sizes: dict[str, int] = defaultdict(int)
    for pattern, tokens in patterns.items():
        for s in pattern:
            sizes[s] += tokens
    names = sorted(sizes, key=lambda s: (s[0] == "~", s))  # "=" names a source, "~" is null
    weigh = [float(weights.get(s[1:] if s[0] == "=" else None, 0)) if weights else 1.0 + i % 3 for i, s in enumerate(names)]
    weigh_sum = sum(weigh)
    shares = capped_shares([sizes[s] for s in names], weigh, most) if weigh_sum else [0.0] * len(names)
    target = dict(zip(names, shares, strict=True))
    flow = route(patterns, {s: round(t) for s, t in target.items()}, PASS_COSTS[:most])
    given: dict[tuple[str, ...], int] = defaultdict(int)
    for (pattern, _), tokens in flow.items():
        given[pattern] += tokens
    full = {p: divmod(given[p], t) if t else (0, 0) for p, t in patterns.items()}
    rounds = _rounds(
        rows, {p: left for p, (_, left) in full.items()}, {p: most - passes for p, (passes, _) in full.items()}
    )
    plan = [(list(p), full[p][0], rounds[p][0]) for p in patterns]
    plan = _beside(spark.createDataFrame(plan, "sources array<string>, passes long, up_to array<long>"), len(patterns))
    buckets = max(1, -(-sum(r["n"] for r in found) // rows_per_bucket))
    more = F.size(F.filter("up_to", lambda most_words: most_words >= F.col("size")))
    dealt = (
        rows.join(plan, "sources")
        .withColumn("passes", F.col("passes") + more)
        .withColumn("bucket", F.pmod(F.xxhash64(F.col("order")), F.lit(buckets)).cast("long"))
        .drop("up_to")
    )
    # A document may be taken once more if it has words, and not as often as a document may be.
    can = (F.col("size") > 0) & (F.col("passes") < most)
    steps, left = _ends(dealt.where(can), {p: n for p, (_, n) in rounds.items()})
    ends = [(list(p), steps[p], left[p], sum(sizes[s] for s in p), float(sum(target[s] for s in p))) for p in patterns]
    ends = spark.createDataFrame(
        ends,
        "sources array<string>, steps array<struct<up_to:long,bucket:long,need:long>>, left long, source_size long, target double",
    )
    ends = _beside(ends, len(patterns))
    # The first step that ends here or later; the last may take all buckets.
    later = F.filter("steps", lambda s: s["bucket"].isNull() | (s["bucket"] >= F.col("bucket")))
    dealt = dealt.join(ends.select("sources", "steps"), "sources").withColumn("step", F.get(later, F.lit(0))).drop("steps")
    fits = F.coalesce(can & (F.col("size") <= F.col("step.up_to")), F.lit(False))
    here = F.coalesce(F.col("step.bucket") == F.col("bucket"), F.lit(False))
    columns = ["doc_id", "sources", "size", "passes", "order"]
    clear = dealt.where(~(fits & here)).select(*columns, fits.cast("long").alias("extra"))
    last = (
        dealt.where(fits & here)
        .select(*columns, "bucket", F.col("step.need").alias("need"))
        .groupBy("sources", "bucket")
        .applyInPandas(
            _fill, f"doc_id {dict(rows.dtypes)['doc_id']}, sources array<string>, size long, passes long, order long, extra long"
        )
    )
    taken = clear.unionByName(last)
    over = [(list(p), n) for p, n in left.items() if n]
    if over:
        over = _beside(spark.createDataFrame(over, "sources array<string>, left long"), len(over))
        over = (
            taken.where(can & (F.col("extra") == 0))
            .join(over, "sources")
            .where("size < 2 * left")
            .groupBy("sources", "size", "order", "left")
            .agg(F.count(F.lit(1)).alias("n"))
            .where("size * n < 2 * left")
            .groupBy("sources")
            .agg(F.min(F.struct(F.col("size") * F.col("n"), "size", "order")).alias("least"))
            .select("sources", "least.size", "least.order")
            .collect()
        )
    if over:
        one = spark.createDataFrame(
            [(r["sources"], r["size"], r["order"], 1) for r in over], "sources array<string>, size long, order long, one long"
        )
        taken = taken.join(_beside(one, len(over)), ["sources", "size", "order"], "left").withColumn(
            "extra", F.when(can, F.greatest("extra", F.coalesce("one", F.lit(0)))).otherwise(F.col("extra"))
        )
    return (
        taken.join(ends.select("sources", "source_size", "target"), "sources")
        .select(
            "doc_id",
            F.transform("sources", lambda s: F.when(s != "~", F.substr(s, F.lit(2)))).alias("sources"),
            "size",
            "source_size",
            "target",
            F.when(F.col("size") > 0, F.least(F.col("passes") + F.col("extra"), F.lit(most))).otherwise(0).cast("long").alias("passes"),
        )
    )
