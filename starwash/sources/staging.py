"""Intermediate results written once and read by several consumers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from starwash.sources.files import delete


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's checkpoint folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return root


#: Open scopes of the running block. A thread has its own; ``stage_all`` hands them to the threads it starts.
_scopes: ContextVar[tuple[str, ...]] = ContextVar("starwash_staging_scopes", default=())


def _folder(spark: SparkSession) -> str:
    return f"{staging_root(spark).rstrip('/')}/starwash-{spark.sparkContext.applicationId}"


def staged_path(spark: SparkSession) -> str:
    return "/".join([_folder(spark), *_scopes.get(), uuid.uuid4().hex])


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block what was staged inside it, by it and by the threads of ``stage_all``.

    Results that still read staged tables must be written or collected before the block ends. Scopes nest.
    """
    name = f"scope-{uuid.uuid4().hex}"
    folder = "/".join([_folder(spark), *_scopes.get(), name])
    outer = _scopes.set((*_scopes.get(), name))
    try:
        yield
    finally:
        _scopes.reset(outer)
        discard(spark, folder)


#: Whether Spark deletes the shuffle files of a query as soon as that has run.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Blocks of each session that have set it, by all threads.
_removing: dict[SparkSession, int] = {}
_removing_lock = Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside the block go as soon as each has run.

    Otherwise they stay until the driver happens to collect its garbage, and a job of many queries holds the shuffles of
    most of them at once. For queries that are not run again; one that is makes its shuffles anew. A session that has a
    setting of its own keeps it. Blocks nest, also across threads.
    """
    with _removing_lock:
        ours = spark in _removing or spark.conf.get(REMOVE_SHUFFLES, None) is None
        if ours:
            spark.conf.set(REMOVE_SHUFFLES, "true")
            _removing[spark] = _removing.get(spark, 0) + 1
    try:
        yield
    finally:
        with _removing_lock:
            if ours:
                _removing[spark] -= 1
                if not _removing[spark]:
                    del _removing[spark]
                    spark.conf.unset(REMOVE_SHUFFLES)


def stage(df: DataFrame, row_group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    ``row_group_bytes`` bounds what a writing task holds in memory, for tables of long texts.

    Consumers start from columnar files, so a lost executor costs no recomputation of what led here,
    column pruning applies again, and the planner knows the true size: a later join broadcasts a
    staged side only when it is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return _written(df, staged_path(df.sparkSession), row_group_bytes)


def _written(df: DataFrame, path: str, row_group_bytes: int | None = None) -> DataFrame:
    (df.write.option("parquet.block.size", row_group_bytes) if row_group_bytes else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_alone(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """:func:`stage` of what ``build`` returns; what ``build`` stages and shuffles on the way goes as soon as it has been
    used."""
    path = staged_path(spark)
    with shuffles_removed(spark), staging_scope(spark):
        return _written(build(), path)


def stage_all(builders: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Stage several independent tables at the same time, so that none leaves cores idle at its end."""
    inherit = inheritable_thread_target(SparkSession.active())  # the caller's job group and scheduler pool
    with ThreadPoolExecutor(len(builders)) as pool:
        tasks = [
            pool.submit(copy_context().run, inherit(lambda b=build: stage(b()))) for build in builders.values()
        ]
        return {name: task.result() for name, task in zip(builders, tasks)}


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    delete(spark, path)
