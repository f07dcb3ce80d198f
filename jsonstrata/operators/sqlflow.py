"""User SQL over named frames: one statement, or stages that build on each other."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_views = threading.Lock()


@dataclass(frozen=True)
class Stage:
    """A named step. ``keep`` persists it, for a stage that several later ones read."""

    name: str
    sql: str
    keep: bool = False


@dataclass(frozen=True)
class StagedFlow:
    """Ordered stages and the statement that puts the result together."""

    final: str
    stages: tuple[Stage, ...] = field(default_factory=tuple)


def run_sql(sql: str, frames: Mapping[str, DataFrame], args: dict | None = None) -> DataFrame:
    """Run ``sql`` over named frames.

    A statement that writes its frames as ``{name}`` gets them bound directly; nothing is
    registered, and literal braces are written twice. A statement that uses plain names finds the
    frames as temporary views of these names. They exist only while the statement is analysed, one
    statement at a time, so tags that run side by side can use the same names.
    """
    spark = next(iter(frames.values())).sparkSession
    bound = {name: df for name, df in frames.items() if "{" + name + "}" in sql}
    if bound:
        return spark.sql(sql, args or None, **bound)
    with _views:
        for name, df in frames.items():
            # Dropping a view also drops cached data of the same plan. The filter, which the
            # optimizer removes, makes it another plan.
            df.where(F.lit(True)).createOrReplaceTempView(name)
        try:
            return spark.sql(sql, args or None)
        finally:
            for name in frames:
                spark.catalog.dropTempView(name)


def run_staged(flow: StagedFlow, frames: Mapping[str, DataFrame]) -> tuple[DataFrame, list[DataFrame]]:
    """The flow's result and the frames it persisted. Each stage sees the sources and all stages
    before it; a stage that is not kept is simply part of the plan."""
    known = dict(frames)
    kept = []
    for stage in flow.stages:
        if stage.name in known:
            raise ValueError(f"stage {stage.name!r} hides a frame of the same name")
        frame = run_sql(stage.sql, known)
        if stage.keep:
            frame = frame.persist()
            kept.append(frame)
        known[stage.name] = frame
    return run_sql(flow.final, known), kept


@contextmanager
def transformed(sql: str | StagedFlow | None, frames: Mapping[str, DataFrame]) -> Iterator[DataFrame]:
    """Result of one statement or of a staged flow; persisted stages are released on exit.

    Without SQL the first frame passes through.
    """
    if sql is None:
        yield next(iter(frames.values()))
    elif isinstance(sql, str):
        yield run_sql(sql, frames)
    else:
        result, kept = run_staged(sql, frames)
        try:
            yield result
        finally:
            for frame in kept:
                frame.unpersist()
