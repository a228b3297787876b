"""Sums over all rows before a row, in an order over the whole table, without a window that holds the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewrecon.llm.scratch import stage


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with each of ``sums`` over the rows before, in an order without ties.

    Rows are range-partitioned; a window runs inside each range, and one over the ranges' totals, of which there
    are as many as partitions.
    """
    dealt = stage(df.repartitionByRange(*order).withColumn("range__", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("range__").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("range__").agg(*(F.sum(c).alias(f"{name}__") for name, c in sums.items()))
    before = totals.select("range__", *(F.coalesce(F.sum(f"{name}__").over(earlier), F.lit(0)).alias(f"{name}__") for name in sums))
    inside = Window.partitionBy("range__").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = dealt.join(F.broadcast(before), "range__")
    return found.select(*df.columns, *((F.col(f"{name}__") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(name) for name, c in sums.items()))
