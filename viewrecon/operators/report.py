"""Findings as text, and the folders that a run writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrecon.functions.kinds import rendered
from viewrecon.operators.reconcile import Reconciler
from viewrecon.operators.stats import job_stats, stats_line
from viewrecon.plans.schema import TableSpec

#: What ends a block, and the folders of writes that failed.
RULE = "=" * 30
DELETE_ERRORS, UPSERT_ERRORS = "ERR_DELETING", "ERR_UPSERTING"

Sink = Callable[[DataFrame, str], None]


def text_sink(rows: DataFrame, path: str) -> None:
    """(category, block) as text files, one folder for each category; replaces what an earlier run left."""
    rows.write.mode("overwrite").partitionBy("category").option("lineSep", "\n").text(path)


def console_sink(rows: DataFrame, path: str) -> None:
    """Prints every block, as it is."""
    for row in rows.toLocalIterator():
        print(row.block)


def row_text(side: str, spec: TableSpec) -> Column:
    """``{name: value, ...}`` of a joined row's side in name order, or ``null``."""
    fields = {c.name: rendered(F.col(f"{side}.`{c.name}`"), c.data_type, c.kind) for c in (*spec.keys, *spec.cells)}
    for c in spec.cells:
        for there, meta in ((c.write_time, "writetime"), (c.ttl, "ttl")):
            if there:
                fields[f"{meta}({c.name})"] = F.coalesce(F.col(f"{side}.`{meta}({c.name})`").cast("string"), F.lit("null"))
    text = F.concat(F.lit("{"), F.concat_ws(", ", *(F.concat(F.lit(f"{n}: "), v) for n, v in sorted(fields.items()))), F.lit("}"))
    return F.when(F.col(side).isNull(), "null").otherwise(text)


def cell_text(mismatch: str, value: str) -> Column:
    """``name:KIND:value``; without the value where it is null."""
    return F.when(F.col(mismatch).isNotNull(), F.concat_ws(":", f"{mismatch}.name", f"{mismatch}.kind", f"{mismatch}.{value}"))


def blocks(findings: DataFrame, r: Reconciler) -> DataFrame:
    """(key, category, block) of findings."""
    block = F.concat_ws(
        "\n",
        F.concat(F.lit("Problem: "), "state"),
        F.concat(F.lit("RowKey: "), r.key_text()),
        F.concat(F.lit("MainTableEntry: "), row_text("base", r.base)),
        F.concat(F.lit("MVTableEntry: "), row_text("view", r.view)),
        F.concat(F.lit("BaseColumn: "), cell_text("mismatch", "base_value")),
        F.concat(F.lit("MvColumn: "), cell_text("mismatch", "view_value")),
    )
    return findings.select("key", F.col("state").alias("category"), block.alias("block"))


def routed(blocks_: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(category, block): every finding under its label, and again with its error under that of a failed write."""
    errors = outcomes.filter(F.col("outcome").isin("DELETE_ERROR", "UPSERT_ERROR"))
    errors = errors.select("key", F.when(F.col("outcome") == "DELETE_ERROR", DELETE_ERRORS).otherwise(UPSERT_ERRORS).alias("failed"), "error")
    failed = blocks_.join(errors, "key").select(F.col("failed").alias("category"), F.concat_ws("\n", "block", "error", F.lit(RULE)).alias("block"))
    return blocks_.select("category", F.concat_ws("\n", "block", F.lit(RULE)).alias("block")).unionByName(failed)


def write_stats(outcomes: DataFrame, path: str) -> str:
    """The statistics as JSON and as a line of text, in two folders under ``path``."""
    counted = job_stats(outcomes).first()
    line, spark = stats_line(counted), outcomes.sparkSession
    counts = spark.range(1).select(*(F.lit(n).alias(name) for name, n in counted.asDict().items()))
    counts.coalesce(1).write.mode("overwrite").json(f"{path}/stats-json")
    spark.range(1).select(F.lit(line).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/stats")
    return line
