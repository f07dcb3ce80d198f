"""Small DataFrame helpers of the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jsonstrata.session import shared_folder


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Whether Spark deletes the shuffle files of a statement at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame) -> DataFrame:
    """The rows as a table written below ``spark.checkpoint.dir``.

    Cuts the lineage: later steps read the files, which outlive every executor, and a frame used
    more than once is computed once. The shuffle files of the write are no longer needed then; Spark
    is told to delete them with it, so that they don't lie beside those of the next step.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, True)
    try:
        df.write.parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


PACKAGE = Path(__file__).resolve().parent.parent


#: Rows that a Python worker gets at once; at some kilobytes of text each, a few megabytes.
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ready(spark: SparkSession) -> None:
    """Set the session up for operators that work on Arrow batches of whole texts.

    Batches are made smaller, since an executor holds several of them twice, and the package is sent
    to the Python workers unless their import path has it: they share the driver's working folder and
    ``PYTHONPATH`` only on some clusters.
    """
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    root = str(PACKAGE.parent)
    sent = f"{PACKAGE.name}.zip"
    if root in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)):
        return
    if any(f.endswith(sent) for f in spark.sparkContext.listFiles):
        return
    archive = Path(tempfile.mkdtemp()) / sent
    with zipfile.ZipFile(archive, "w") as package:
        for file in sorted(PACKAGE.rglob("*.py")):
            package.write(file, file.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranked(df: DataFrame, keys: list[str], order: list[str], out: str, rows_per_bucket: int = 2_000) -> DataFrame:
    """``df`` with ``out``: the gapless rank from 0 of each row within its ``keys``.

    A key may hold any share of the rows: rows are numbered within hash buckets of ``order``, and a
    bucket starts where the earlier buckets of its key end. Rows that agree in ``order`` get
    neighbouring ranks in any order. ``df`` is read twice, so it should be a written table.
    """
    buckets = max(1, -(-df.count() // rows_per_bucket))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*map(col, order)), F.lit(buckets)))
    keyed = [*keys, "_bucket"]
    before = Window.partitionBy(*map(col, keys)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*map(col, keyed))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(*(col(k).alias(f"_{i}_key") for i, k in enumerate(keyed)), "_start")
    )
    same = [col(k).eqNullSafe(F.col(f"_{i}_key")) for i, k in enumerate(keyed)]
    within = Window.partitionBy(*map(col, keyed)).orderBy(*map(col, order))
    return (
        dealt.join(starts, same)
        .withColumn(out, (F.col("_start") + F.row_number().over(within) - 1).cast("long"))
        .select(*map(col, df.columns), out)
    )
