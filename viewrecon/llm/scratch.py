"""Intermediate tables on storage that the driver and every executor share.

A stage boundary is a Parquet table under ``spark.checkpoint.dir``: it cuts the lineage, survives the
loss of any executor, and is computed once however often it is read afterwards.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_paths: dict[str, list[str]] = {}
_recorders: list[list[str]] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Where none is set, a temporary folder if all runs in this process, else an error: executors don't share the driver's folders."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="viewrecon-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/viewrecon/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _paths.setdefault(spark.sparkContext.applicationId, []).append(path)
    for made in _recorders:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def record() -> Iterator[list[str]]:
    """Collects the paths of the tables that are staged meanwhile."""
    made: list[str] = []
    _recorders.append(made)
    try:
        yield made
    finally:
        _recorders[:] = [m for m in _recorders if m is not made]


@contextmanager
def short_batches(spark: SparkSession, most: int = 1000) -> Iterator[None]:
    """Batches of whole texts that bound a worker's memory; the session's setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def trimmed(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` of a task, after which the worker, which is kept for other tasks, returns the memory that it no longer uses."""

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return run


def drop(spark: SparkSession, path: str) -> None:
    """Delete one staged table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Delete every table staged so far in this application.

    Results are lazy and read staged tables, so call this only when the results wanted have been written.
    """
    for path in _paths.pop(spark.sparkContext.applicationId, []):
        drop(spark, path)
