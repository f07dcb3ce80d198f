"""Drop directory: one file is one message."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonstrata.functions.scalars import message_id

# Defaults of the intake.
SUFFIX = ".json"
MAX_FILES = 10
STABLE_MILLIS = 5_000
MAX_FILE_BYTES = 100 * 1024 * 1024
#: Files up to which they are opened by name.
NAMED_FILES = 1_000
#: Scan partitions that a task reads at most, and tasks for each core up to which none are joined up.
SCANS_PER_TASK = 16
TASKS_PER_CORE = 4
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# Fixed value: the columns of Spark's file source for whole files.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def file_identity(path: Column, modified: Column) -> dict[str, Column]:
    """Identity of a file message. It depends on path and time only, so a replay repeats it. The
    offset is a hash that tells the messages of a batch apart; no progress is kept for files."""
    key = F.concat_ws("|", path, F.unix_micros(modified).cast("string"))
    return {
        "partition": F.lit(0),
        "offset": F.xxhash64(path, modified).bitwiseAND(F.lit(2**63 - 1)),
        "message_id": message_id(path, modified),
        "file_key": F.sha2(key, 256),
    }


# Column of a file message that can't be loaded: the reason, else null.
REJECTED_COLUMN = "rejected"


def _file_messages(files: DataFrame, max_file_bytes: int) -> DataFrame:
    """Messages of files listed with ``(path, modificationTime, length, content)``."""
    path, modified = F.col("path"), F.col("modificationTime")
    identity = [c.alias(name) for name, c in file_identity(path, modified).items()]
    # A test on the length is pushed into the scan, so larger files are never opened.
    return files.where(F.col("length").between(1, max_file_bytes)).select(
        *identity,
        F.col("content").cast("string").alias("json"),
        path.alias("source"),
        modified.alias("modified"),
        F.col("length").alias("bytes"),
    )


def _rejected_messages(files: DataFrame, max_file_bytes: int) -> DataFrame:
    """A row for each file that is too large. Its content isn't asked for, so not opened."""
    path, modified, size = F.col("path"), F.col("modificationTime"), F.col("length")
    identity = [c.alias(name) for name, c in file_identity(path, modified).items()]
    about = F.to_json(F.struct(path.alias("path"), size.alias("bytes"), modified.alias("modified")))
    reason = F.when(size == 0, "file is empty").otherwise(f"file has more than {max_file_bytes} bytes")
    return files.where(~size.between(1, max_file_bytes)).select(
        *identity,
        about.alias("json"),
        path.alias("source"),
        modified.alias("modified"),
        size.alias("bytes"),
        reason.alias(REJECTED_COLUMN),
    )


def accepted(messages: DataFrame) -> DataFrame:
    """Messages that can be loaded."""
    if REJECTED_COLUMN not in messages.columns:
        return messages
    return messages.where(F.col(REJECTED_COLUMN).isNull()).drop(REJECTED_COLUMN)


def rejected(messages: DataFrame) -> DataFrame | None:
    """Quarantine rows of files that can't be loaded: ``json`` holds path, size and time."""
    if REJECTED_COLUMN not in messages.columns:
        return None
    rows = messages.where(F.col(REJECTED_COLUMN).isNotNull())
    return rows.select("source", "partition", "offset", "json", F.col(REJECTED_COLUMN).alias("reason"))


def read_drop_stream(
    spark: SparkSession,
    directory: str,
    *,
    suffix: str = SUFFIX,
    max_files: int = MAX_FILES,
    max_bytes: int | None = None,
    max_file_bytes: int = MAX_FILE_BYTES,
    archive_dir: str | None = None,
) -> DataFrame:
    """Streaming messages of a directory, oldest files first.

    The checkpoint remembers which files were read, so there are no markers and no claims. Files
    must be complete when they appear: write them elsewhere and rename them in. ``max_bytes``
    bounds a batch by volume instead of by number. With ``archive_dir``,
    files of finished batches are moved there.

    An oversized file is a row as well, with the reason in ``rejected`` and without its content; the
    load sends it to the quarantine. Empty files hold no message, and Spark passes over them.
    """
    # By default the files of a batch are looked up by a task each, up to 10,000. The source asks its session.
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set(LISTING_TASKS, min(int(spark.conf.get(LISTING_TASKS)), tasks))
    options = {"pathGlobFilter": f"*{suffix}"}
    if max_bytes is None:
        options["maxFilesPerTrigger"] = str(max_files)
    else:
        options["maxBytesPerTrigger"] = str(max_bytes)
    if archive_dir is not None:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).options(**options).load(directory)
    good = _file_messages(files, max_file_bytes).withColumn(REJECTED_COLUMN, F.lit(None).cast("string"))
    return good.unionByName(_rejected_messages(files, max_file_bytes))


def list_files(spark: SparkSession, directory: str, since: int | None = None) -> DataFrame:
    """``(path, modified, bytes)`` of the files in a directory; their content is not read.

    With ``since``, in seconds since 1970, older ones are left out of the listing itself.
    """
    reader = spark.read.format("binaryFile")
    if since is not None:
        # The option leaves out files of exactly this second too.
        after = datetime.fromtimestamp(since - 1, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        reader = reader.option("modifiedAfter", after).option("timeZone", "UTC")
    return listing_of(reader.load(directory))


def listing_of(files: DataFrame) -> DataFrame:
    """``(path, modified, bytes)`` of files of the file source, which opens none of them for that."""
    listed = files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    return few_tasks(listed)


def few_tasks(files: DataFrame) -> DataFrame:
    """Scan partitions of files joined up, where there are more than a few for each core.

    Spark counts 4 MB for each file, so about 30 small ones make a partition, and as many tasks as these
    cost more than the files. It stays at ``SCANS_PER_TASK`` partitions a task, so at 2 GB of large files.
    """
    scans = files.rdd.getNumPartitions()
    return files.coalesce(max(TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism, -(-scans // SCANS_PER_TASK)))


def eligible(
    listing: DataFrame,
    now: Column | None = None,
    *,
    suffix: str = SUFFIX,
    stable_millis: int = STABLE_MILLIS,
    max_file_bytes: int = MAX_FILE_BYTES,
) -> DataFrame:
    """Files to take in: right suffix, unchanged for a while, neither empty nor too large."""
    now = F.current_timestamp() if now is None else now
    age = F.unix_millis(now) - F.unix_millis("modified")
    return listing.where(
        F.col("path").endswith(suffix)
        & F.col("bytes").between(1, max_file_bytes)
        & (age >= stable_millis)
    )


def oldest_first(listing: DataFrame, n: int = MAX_FILES) -> DataFrame:
    """The ``n`` oldest entries; ties are settled by path. Only the narrow listing is sorted."""
    return listing.orderBy("modified", "path").limit(n)


def read_drop_batch(
    spark: SparkSession,
    directory: str,
    *,
    suffix: str = SUFFIX,
    max_files: int | None = None,
    stable_millis: int = STABLE_MILLIS,
    max_file_bytes: int = MAX_FILE_BYTES,
    taken: DataFrame | None = None,
    with_rejected: bool = False,
) -> DataFrame:
    """Messages of the eligible files, for a run without a stream.

    All of them, or with ``max_files`` the oldest so many. ``taken`` holds the ``file_key`` of files
    of earlier runs, such as the messages these returned; they are left out, so runs of
    ``max_files`` go on through the directory. The driver sees the chosen paths if they
    are few; executors read the files.

    With ``with_rejected`` oversized files are rows as well, as in the stream form, for a load that
    sends them to the quarantine; ``max_files`` does not count them.
    """
    # Both the listing and the contents come from one look at the directory.
    found = spark.read.format("binaryFile").load(directory)
    every = listing_of(found)
    if taken is not None:
        identity = file_identity(F.col("path"), F.col("modified"))
        every = every.withColumn("file_key", identity["file_key"])
        every = every.join(taken.select("file_key").distinct(), "file_key", "left_anti")
    listing = eligible(every, suffix=suffix, stable_millis=stable_millis, max_file_bytes=max_file_bytes)
    good = _chosen(spark, found, listing, max_files, max_file_bytes)
    if not with_rejected:
        return good
    age = F.unix_millis(F.current_timestamp()) - F.unix_millis("modified")
    left = every.where(F.col("path").endswith(suffix) & (age >= stable_millis))
    listed = left.select("path", F.col("modified").alias("modificationTime"), F.col("bytes").alias("length"))
    good = good.withColumn(REJECTED_COLUMN, F.lit(None).cast("string"))
    return good.unionByName(_rejected_messages(listed, max_file_bytes))


def _chosen(
    spark: SparkSession, found: DataFrame, listing: DataFrame, max_files: int | None, max_file_bytes: int
) -> DataFrame:
    """Messages of the listed files, or of the oldest so many of them."""
    if max_files is None:
        # Lengths prune the scan; a file that isn't chosen costs its own reading at most.
        # A path is listed once; a semi join would be moved below the joining up of the scan.
        return _file_messages(few_tasks(found).join(listing.select("path"), "path"), max_file_bytes)
    return _file_messages(_files_of(spark, found, oldest_first(listing, max_files), max_files), max_file_bytes)


def _files_of(spark: SparkSession, found: DataFrame, chosen: DataFrame, number: int) -> DataFrame:
    """The chosen files, at most ``number``. A few are opened by name. More names would make a listing
    each and a plan that holds them all: then the directory is scanned between the times of the oldest
    and the newest, others are not opened, and the join decides."""
    if number <= NAMED_FILES:
        paths = [row["path"] for row in chosen.select("path").collect()]
        return spark.read.format("binaryFile").load(_literal(paths)) if paths else found.where(F.lit(False))
    # As microseconds: a time of Python would depend on its own zone.
    first, last = chosen.agg(*(F.unix_micros(f("modified")) for f in (F.min, F.max))).first()
    if first is None:
        return found.where(F.lit(False))
    between = F.col("modificationTime").between(*(F.timestamp_micros(F.lit(t)) for t in (first, last)))
    return few_tasks(found.where(between)).join(chosen.select("path"), "path")


def _literal(paths: list[str]) -> list[str]:
    """Paths that are not read as patterns: their special characters are escaped."""
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", path) for path in paths]


def messages_of(spark: SparkSession, directory: str, chosen: DataFrame, max_file_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Messages of the chosen files, with a row for each one that is too large, as in the stream form."""
    found = spark.read.format("binaryFile").load(directory)
    files = _files_of(spark, found, chosen, chosen.count())
    good = _file_messages(files, max_file_bytes).withColumn(REJECTED_COLUMN, F.lit(None).cast("string"))
    return good.unionByName(_rejected_messages(files, max_file_bytes))
