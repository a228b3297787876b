"""Names of columns: working columns never meet those of the input, and results take the place of their namesakes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spare(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column, whatever its case, has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(columns: Iterable[str], results: Iterable[str]) -> list[str]:
    """The columns that no result replaces, whatever their case."""
    gone = {r.lower() for r in results}
    return [c for c in columns if c.lower() not in gone]


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns named ``in_0``, ``in_1`` and so on, and the new name of each. Nothing else is called so."""
    names = {c: f"in_{i}" for i, c in enumerate(df.columns)}
    return df.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), names


def restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns that ``numbered`` renamed, under their own names and in their order."""
    return df.select(*(F.col(n).alias(c) for c, n in names.items()))
