"""Hands planned mutations to a writer of the user's, at a limited rate, and keeps what it refused.

A task that is retried hands its rows over again, so the writer must be idempotent: a cell written twice with
its timestamp, or a record deleted twice, is the same.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from viewrecon.operators.reconcile import Reconciler
from viewrecon.operators.repair import statements
from viewrecon.sources.staging import staged

Writer = Callable[[str, dict], None]


def mutated(plan: DataFrame, r: Reconciler, write: Writer, namespace: str = "", mutations_per_second: int = 0) -> DataFrame:
    """(key, error): the rows of an upsert or delete plan that ``write(statement, row)`` raised on.

    Rows that the recheck of a delete plan found ``present`` are not handed over. The limit holds in each task;
    0 means none. All is written, once, before this returns; the result is a table and may be read again.
    """
    columns = plan.columns
    keys = columns[: len(r.keys)]
    names = [f"key_{k}" if k.lower() == "error" else k for k in keys]
    texts = statements(namespace, r.base.name, r.view.name, r.view)
    delete = columns[-1] == "present"
    schema = T.StructType([*(T.StructField(n, plan.schema[k].dataType) for n, k in zip(names, keys, strict=True)), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = time.monotonic()
        for batch in batches:
            refused = []
            for row in batch.to_pylist():
                if delete and row["present"]:
                    continue
                statement = texts["DELETE"] if delete else texts[f"{row['column']}_{row['flavor']}"]
                if mutations_per_second > 0:
                    time.sleep(max(0.0, free - time.monotonic()))
                    free = max(free, time.monotonic()) + 1 / mutations_per_second
                try:
                    write(statement, row)
                except Exception as e:
                    refused.append([*(row[k] for k in keys), f"Error {'deleting' if delete else 'upserting'} data: {e}\nquery: {statement}"])
            columns = [pa.array([x[i] for x in refused], batch.column(batch.schema.names.index(k)).type) for i, k in enumerate(keys)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[-1] for x in refused], pa.string())], [*names, "error"])

    return staged(plan.mapInArrow(run, schema), "refused")
