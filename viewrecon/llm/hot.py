"""A join that no key can pile up in one task, however many rows hold it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that are broadcast at most; those of more than a ``PARTS``th of the rows are fewer.
PARTS = 4096


def join_counted(rows: DataFrame, keyed: DataFrame, on: list[str], count: str, parts: int = PARTS) -> DataFrame:
    """``rows`` with the columns of ``keyed``, which holds each key once and in ``count`` how many rows have it; nulls meet nulls.

    Up to ``parts`` keys are broadcast. Of more keys those that hold more than a ``parts``th of all rows are, which
    are fewer than ``parts``; the rest meet by a shuffle, where no key has more rows than that. Both are read
    twice then, so they should be tables.
    """
    n, total = keyed.agg(F.count("*"), F.sum(F.col(count))).first()
    side = keyed.select(*(F.col(c).alias(f"{c}__key") if c in on else F.col(c) for c in keyed.columns))
    same = [F.col(c).eqNullSafe(F.col(f"{c}__key")) for c in on]
    drop = [f"{c}__key" for c in on]
    if n <= parts:
        return rows.join(F.broadcast(side), same).drop(*drop)
    often: Column = F.col(count) * parts > F.lit(total)
    hot, cold = side.filter(often), side.filter(~often)
    rest = rows.join(F.broadcast(hot.select(*drop)), same, "left_anti")
    return rows.join(F.broadcast(hot), same).drop(*drop).unionByName(rest.join(cold, same).drop(*drop))
