"""Claim-check envelopes: a message carries its payload or the path of a file that holds it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonstrata.operators.membership import packed_filter
from jsonstrata.operators.skew import DEFAULT_LIMITS, JoinLimits, fits_broadcast, salted_join
from jsonstrata.sources.dropdir import few_tasks

REFERENCE_FIELD = "payload_ref"
#: Bound of the filter of file names, in bitmaps of 4 KB for about 3,000 names each.
MOST_CELLS = 320


def path_key(path: Column) -> Column:
    """A path without scheme and host, so that both spellings of a location compare equal."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def store_of(path: str) -> str:
    """Scheme and host of a path, or nothing."""
    return re.match(r"([A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?)?", path)[0]


def open_envelopes(
    messages: DataFrame, reference_field: str = REFERENCE_FIELD, root: str | None = None
) -> DataFrame:
    """Add ``payload_ref`` to messages. A message without the reference field is its own payload;
    one with it has no ``json`` until the reference is resolved.

    A reference loses its scheme and host where they name the store of ``root``, the default store
    or local files; one to another store keeps them, so it can't be taken for a file under the root.
    """
    given = F.get_json_object("json", f"$.{reference_field}")
    if root is None:
        reference = path_key(given)
    else:
        default = messages.sparkSession._jsc.hadoopConfiguration().get("fs.defaultFS") or ""
        own = {store_of(root), store_of(default) if not store_of(root) else "", "file:", "file://"} - {""}
        stores = "|".join(re.escape(s) for s in sorted(own, key=len, reverse=True))
        reference = F.regexp_replace(given, f"^({stores})(?=/)", "")
    return messages.withColumn("payload_ref", reference).withColumn(
        "json", F.when(F.col("payload_ref").isNull(), F.col("json"))
    )


def read_payloads(spark: SparkSession, root: str, envelopes: DataFrame | None = None) -> DataFrame:
    """``(payload_ref, payload)``: path and whole text of the files under ``root``, at any depth.

    With ``envelopes``, a file is opened only if its name may be one that a reference ends in: the
    names make a filter of bitmaps, which is applied to the listing. About one other file in a hundred
    is opened for nothing, more of them beyond a million names, as the filter does not grow
    further. The join with the envelopes decides.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    if envelopes is not None:
        name = F.substring_index("payload_ref", "/", -1)
        wanted = envelopes.where(F.col("payload_ref").isNotNull()).select(name.alias("name"))
        known = packed_filter(wanted.distinct(), "name", MOST_CELLS)
        # Spark's file metadata has names as in a URL, but for plus signs.
        listed = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
        files = files.where(known(listed))
    return few_tasks(
        files.select(path_key(F.col("path")).alias("payload_ref"), F.col("content").cast("string").alias("payload"))
    )


def resolve_claim_checks(
    envelopes: DataFrame, payloads: DataFrame, limits: JoinLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Fill ``json`` of the envelopes that refer to a payload; it stays null where none is found.

    Inline messages pass by the join. While the referring envelopes, which have no text, are few
    enough they are broadcast to the payloads, so that no payload is shuffled; the unresolved are
    those whose reference no payload has, found without the texts. Beyond that both sides are
    shuffled, and a reference that many envelopes share is divided over several tasks.
    ``payloads`` has one row per path.
    """
    columns = envelopes.columns
    inline = envelopes.where(F.col("payload_ref").isNull() | F.col("json").isNotNull())
    referring = envelopes.where(F.col("payload_ref").isNotNull() & F.col("json").isNull())
    spread = [c for c in columns if c not in ("json", "payload_ref")]
    narrow = referring.drop("json")
    if fits_broadcast(narrow, limits):
        text = payloads.select("payload_ref", F.col("payload").alias("json"))
        found = text.join(F.broadcast(narrow), "payload_ref")
        # A subset of the references just measured.
        known = payloads.select("payload_ref").join(F.broadcast(narrow.select("payload_ref").distinct()), "payload_ref", "left_semi")
        missing = narrow.join(F.broadcast(known), "payload_ref", "left_anti")
        missing = missing.withColumn("json", F.lit(None).cast("string"))
        return inline.unionByName(found.select(*columns)).unionByName(missing.select(*columns))
    found = salted_join(
        referring.drop("json"),
        payloads.select("payload_ref", F.col("payload").alias("json")),
        "payload_ref",
        "left",
        spread,
        limits,
    )
    return inline.unionByName(found).select(*columns)


def resolved(envelopes: DataFrame) -> DataFrame:
    """Messages with a payload."""
    return envelopes.where(F.col("json").isNotNull()).drop("payload_ref")


def unresolved(envelopes: DataFrame, reason: str = "payload not found") -> DataFrame:
    """Quarantine rows of envelopes without a payload; ``json`` holds the dangling reference."""
    return envelopes.where(F.col("json").isNull()).select(
        "source", "partition", "offset", F.col("payload_ref").alias("json"), F.lit(reason).alias("reason")
    )
