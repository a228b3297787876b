"""Reading tables, and the optional limits on how fast rows are read or written."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrecon.plans.schema import TableSpec


def read_table(spark: SparkSession, where: str, source: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """``where`` is a table's name, or a path (with a slash) to read with ``source``, Parquet by default."""
    if "/" in where or source:
        reader = spark.read.format(source or "parquet").options(**(options or {}))
        return reader.load(where)
    if not spark.catalog.tableExists(where):
        raise ValueError(f"no table {where}")
    return spark.read.options(**(options or {})).table(where)


def write_table(df: DataFrame, where: str, options: dict[str, str] | None = None) -> None:
    """``where`` is a table's name, or a path (with a slash) for Parquet; what was there is replaced."""
    writer = df.write.mode("overwrite").options(**(options or {}))
    writer.parquet(where) if "/" in where else writer.saveAsTable(where)


def scan(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Key, cells, and beside each cell that has them its write time and time to live; nothing else is read."""
    columns = [F.col(f"`{k}`") for k in spec.key_names]
    for c in spec.cells:
        columns.append(F.col(f"`{c.name}`"))
        if c.write_time:
            columns.append(F.col(f"`{c.write_time}`").cast("long").alias(f"writetime({c.name})"))
        if c.ttl:
            columns.append(F.col(f"`{c.ttl}`").cast("int").alias(f"ttl({c.name})"))
    return df.select(*columns)


def throttled(df: DataFrame, rows_per_second: int) -> DataFrame:
    """``df`` at no more than so many rows a second in each task; 0 means no limit. It costs a pass through Python."""
    if rows_per_second <= 0:
        return df

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = time.monotonic()
        for batch in batches:
            for at in range(0, batch.num_rows, rows_per_second):
                part = batch.slice(at, rows_per_second)
                time.sleep(max(0.0, free - time.monotonic()))
                free = max(free, time.monotonic()) + part.num_rows / rows_per_second
                yield part

    return df.mapInArrow(run, df.schema)


def key_of(keys: Sequence[str]) -> Column:
    """The key as one struct; structs are equal where all of their fields are, nulls included."""
    return F.struct(*(F.col(f"`{k}`").alias(k) for k in keys))


def present_in(rows: DataFrame, table: DataFrame, keys: tuple[str, ...], absent: bool = False) -> DataFrame:
    """The rows whose key, nulls included, is in ``table``, or is not."""
    other = table.select(key_of(keys).alias("key__"))
    return rows.join(other, key_of(keys) == F.col("key__"), "left_anti" if absent else "left_semi")
