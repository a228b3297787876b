"""Reconciling again whenever a stream of changed keys arrives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from viewrecon.operators.reconcile import Reconciler
from viewrecon.sources.tables import present_in


def reconcile_changes(changes: DataFrame, r: Reconciler, read_base: Callable[[], DataFrame], read_view: Callable[[], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """changes: a stream with the view's key columns. Each batch labels its keys against fresh reads and hands ``sink`` (labels, batch)."""

    def batch(keys: DataFrame, number: int) -> None:
        keys = keys.select(*r.keys).distinct()
        base, view = (present_in(read(), keys, r.keys) for read in (read_base, read_view))
        sink(r.labels(base, view), number)

    return changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
