"""Session helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder for checkpoints and written tables, below ``spark.checkpoint.dir``.

    Without that setting, as in a local test, a temporary folder is used.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        # local-cluster[...] has executors of their own, so it needs a shared folder too.
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="jsonstrata-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def run_all(spark: SparkSession, jobs: list[Callable[[], object]], threads: int) -> None:
    """Run independent loads; each thread only submits Spark jobs, so the cluster stays busy."""
    if threads <= 1 or len(jobs) <= 1:
        for job in jobs:
            job()
        return
    with ThreadPoolExecutor(threads) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()
