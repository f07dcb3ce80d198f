"""Secret scans with an incremental ledger of blobs.

Every version of a text is addressed by its content. The ledger says which blob was scanned by which
rule at which version; only unseen pairs are scanned, each blob once however many paths hold it, and
findings are joined back to all paths. The patterns run as SQL functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jsonstrata.llm.frames import col, keep


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost non-overlapping matches are findings if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1


#: Fixed patterns. A run of one class either has enough characters or holds no match that has.
RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
        r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)

FINDINGS = "blob binary, kind string, version int, start long, end long"


def _matches(text: Column, rule: Rule) -> Column:
    """Each match as its length, that of its tested group, and of the text since the match before."""
    pieces = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    zipped = F.arrays_zip(pieces.alias("gap"), whole.alias("whole"), tested.alias("tested"))
    lengths = F.transform(
        F.slice(zipped, 1, F.size(whole)),
        lambda x: F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            F.length(x["gap"]).cast("long").alias("gap"),
            F.length(x["whole"]).cast("long").alias("len"),
            (F.length(x["tested"]) >= rule.least).alias("holds"),
        ),
    )
    return F.when(text.rlike(rule.pattern), lengths)


def find_spans(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of (blob, text, kinds): each rule named in ``kinds`` over the whole text.

    Start and end are code points, the end exclusive.
    """
    found = None
    none = F.array().cast("array<struct<kind:string,version:int,gap:bigint,len:bigint,holds:boolean>>")
    every = [
        F.coalesce(F.when(F.array_contains("kinds", r.kind), _matches(F.col("text"), r)), none) for r in rules
    ]
    found = blobs.select("blob", F.posexplode(F.concat(*every)).alias("i", "m")).select("blob", "i", "m.*")
    to_here = Window.partitionBy("blob", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(to_here)
    return (
        found.withColumn("end", end)
        .where("holds")
        .select("blob", "kind", "version", (F.col("end") - F.col("len")).alias("start"), "end")
    )


def manifest(docs: DataFrame, path_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every path with the address of its content. A null text is an empty one."""
    text = F.coalesce(col(text_column), F.lit(""))
    return docs.select(col(path_column).alias("path"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"))


def scan(
    docs: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    path_column: str = "doc_id",
    text_column: str = "text",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One increment: (paths with their blob, new ledger rows, findings of the new pairs).

    ``ledger`` holds (blob, kind, version) of earlier increments; the caller adds the new rows and
    keeps the findings with them. A path may be null or repeated and a blob may have any number of
    paths: the text of one of them is scanned. Empty tables give empty results.
    """
    paths = keep(manifest(docs, path_column, text_column))
    versions = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
    pairs = blobs.select("blob", "path", F.inline(versions))
    if ledger is not None:
        pairs = pairs.join(ledger.select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
    todo = pairs.groupBy("blob", "path").agg(F.collect_set("kind").alias("kinds"))
    todo = todo.withColumnsRenamed({"blob": "todo_blob", "path": "todo_path"})
    text = F.coalesce(col(text_column), F.lit(""))
    texts = docs.select(col(path_column).alias("path"), text.alias("text"))
    texts = texts.withColumn("blob", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    texts = texts.join(todo, F.col("path").eqNullSafe(F.col("todo_path")) & (F.col("blob") == F.col("todo_blob")))
    # A repeated row would be scanned once more: its findings are the same.
    found = keep(find_spans(texts, rules).dropDuplicates(["blob", "kind", "start"]))
    return paths, pairs.select("blob", "kind", "version"), found


@dataclass(frozen=True)
class Ledger:
    """What increments so far have scanned, and found, as written tables."""

    pairs: DataFrame
    found: DataFrame

    def current(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Findings of the rules at their present versions; those of older versions are retired."""
        present = F.lit(False)
        for rule in rules:
            present = present | ((F.col("kind") == rule.kind) & (F.col("version") == rule.version))
        return self.found.where(present)


def update(
    docs: DataFrame,
    ledger: Ledger | None = None,
    rules: tuple[Rule, ...] = RULES,
    path_column: str = "doc_id",
    text_column: str = "text",
) -> tuple[DataFrame, Ledger]:
    """The paths of ``docs`` with their blobs, and the ledger after an increment.

    Only pairs of blob and rule version that the ledger lacks are scanned. Findings stay with the
    blobs, so paths that come later, or come back, meet what was found before.
    """
    paths, new, found = scan(docs, None if ledger is None else ledger.pairs, rules, path_column, text_column)
    new = keep(new)
    if ledger is None:
        return paths, Ledger(new, found)
    return paths, Ledger(ledger.pairs.unionByName(new), ledger.found.unionByName(found))


def per_path(paths: DataFrame, found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every path with its findings as an ordered array of (start, rule number, kind, end)."""
    order = F.array_position(F.array(*(F.lit(r.kind) for r in rules)), F.col("kind"))
    spans = found.groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", order.alias("rule"), "kind", "end"))).alias("spans")
    )
    return paths.join(spans, "blob", "left").select("path", "blob", "spans")
