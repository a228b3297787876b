"""Connected components of a distributed edge list, by alternating large and small stars.

No vertex's neighbours are ever gathered: a step needs each vertex's smallest neighbour, an aggregate with
map-side combining, and a join back to the edges, to which the few vertices that have very many are broadcast. A graph
of up to ONE_TASK edges, counted first, is solved whole by one task instead: the steps' shuffles would cost
more than its few megabytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewrecon.llm.hot import join_counted
from viewrecon.llm.scratch import stage

ONE_TASK = 1_000_000


def _roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices in order, and the smallest of each one's component."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            return ids, ids[root]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        kind = held[0].column(0).type
        u, v = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in (0, 1))
        ids, roots = _roots(u, v)
        other = ids != roots
        for i in range(0, int(other.sum()), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[other][i : i + 10_000], kind) for x in (ids, roots)], ["u", "v"])


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """edges: (u, v), any order and repeats. Returns (u, v) with ``v`` the smallest vertex of u's component, for every other vertex u."""
    big, small = F.greatest("u", "v"), F.least("u", "v")
    e = stage(edges.filter("u <> v").select(big.alias("u"), small.alias("v")), "edges")
    if e.count() <= one_task:
        return stage(e.coalesce(1).mapInArrow(_solve, e.schema), "edges")
    return by_stars(e)


def by_stars(e: DataFrame) -> DataFrame:
    """The same for (u, v) with u above v, in steps over the whole cluster."""
    e = stage(e.distinct(), "edges")
    seen = _mark(e)
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")), "least")
        large = join_counted(both, least, ["u"], "n").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.distinct(), "edges")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        rest = join_counted(large, least, ["u"], "n").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(rest.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _mark(e)
        if now == seen:
            return e
        seen = now
