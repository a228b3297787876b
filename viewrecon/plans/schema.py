"""What is known of a table: its key, its cells, and where a cell's write time and time to live are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from viewrecon.functions.kinds import COLLECTIONS, REPAIRABLE, kind_of


@dataclass(frozen=True)
class Cell:
    name: str
    data_type: T.DataType
    kind: str
    write_time: str | None = None
    ttl: str | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[Cell, ...]
    cells: tuple[Cell, ...]

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], name: str = "table", kinds: Mapping[str, str] | None = None, write_time: str | Mapping[str, str] | None = None, ttl: str | Mapping[str, str] | None = None) -> TableSpec:
        """Splits the columns of ``df`` into key and cells. ``write_time`` (microseconds) and ``ttl`` (seconds) name
        columns: one for all cells, or one for each. Collections have neither."""
        kinds, meta = kinds or {}, set()
        for given in (write_time, ttl):
            meta |= {given} if isinstance(given, str) else set((given or {}).values())
        missing = [c for c in (*keys, *meta) if c not in df.columns]
        if missing:
            raise ValueError(f"{name} has no column {', '.join(missing)}")

        def cell(f: T.StructField, key: bool) -> Cell:
            kind = kind_of(f.dataType, kinds.get(f.name))
            if key or kind in COLLECTIONS:
                return Cell(f.name, f.dataType, kind)
            at = [given if isinstance(given, str) else (given or {}).get(f.name) for given in (write_time, ttl)]
            return Cell(f.name, f.dataType, kind, *at)

        own = {f.name: f for f in df.schema.fields if f.name not in meta}
        return cls(name, tuple(cell(own[k], True) for k in keys), tuple(cell(own[c], False) for c in sorted(own) if c not in keys))

    @property
    def key_names(self) -> tuple[str, ...]:
        return tuple(k.name for k in self.keys)

    def cell(self, name: str) -> Cell:
        return next(c for c in (*self.cells, *self.keys) if c.name == name)


def common_cells(base: TableSpec, view: TableSpec) -> tuple[str, ...]:
    """Names, in order, of the cells that both have with equal type and kind."""
    known = {(c.name, c.data_type.simpleString(), c.kind) for c in base.cells}
    return tuple(c.name for c in view.cells if (c.name, c.data_type.simpleString(), c.kind) in known)


def check_repairable(view: TableSpec, fix_missing: bool, fix_inconsistent: bool) -> None:
    """Repair that writes cells needs kinds that can be written; deleting orphans doesn't."""
    bad = [f"{c.name} ({c.kind})" for c in view.cells if c.kind not in REPAIRABLE]
    if bad and (fix_missing or fix_inconsistent):
        raise ValueError(f"repair can't write {', '.join(bad)} of {view.name}")
