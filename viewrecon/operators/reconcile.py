"""Labels every key of a base table and its view, and lists the cells that differ.

One null-safe full outer join on the view's key. Whether a side is out of scope is decided before the join,
from its own write times, and applied after it: a key with either side out of scope is skipped, which no
filter below the join can express. Everything but the join is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewrecon.functions.kinds import comparable, differs, rendered
from viewrecon.plans.schema import Cell, TableSpec, common_cells
from viewrecon.sources.tables import key_of, scan

#: The labels of a key.
SKIPPED, ORPHAN, MISSING, INCONSISTENT, CONSISTENT = "SKIPPED", "MISSING_IN_BASE_TABLE", "MISSING_IN_MV_TABLE", "INCONSISTENT", "CONSISTENT"


def write_time_bounds(spec: TableSpec, names: tuple[str, ...], strict: bool = False) -> tuple[Column, Column]:
    """Smallest and largest write time of the named cells that are not null; null where none has one.

    ``strict``: a cell with a value but no write time is an error.
    """
    times = []
    for c in (spec.cell(n) for n in names):
        if c.write_time:
            at = F.col(f"`writetime({c.name})`")
            if strict:
                at = F.when(F.col(f"`{c.name}`").isNotNull() & at.isNull(), F.raise_error(F.lit(f"{c.name} has no write time")).cast("long")).otherwise(at)
            times.append(F.when(F.col(f"`{c.name}`").isNotNull(), at))
    if not times:
        none = F.lit(None).cast("long")
        return none, none
    return (times[0], times[0]) if len(times) == 1 else (F.least(*times), F.greatest(*times))


def out_of_scope(least: Column, most: Column, start_seconds: int, end_seconds: int) -> Column:
    """Bounds are inclusive and compare whole seconds; without a write time a row is in scope."""
    seconds = lambda micros: F.call_function("div", micros, F.lit(1_000_000))
    return F.coalesce((F.lit(start_seconds) > seconds(least)) | (seconds(most) > F.lit(end_seconds)), F.lit(False))


def first_rows(df: DataFrame, keys: tuple[str, ...], order: list[Column]) -> DataFrame:
    """One row for each key, the first in the given order."""
    nth = "nth"
    while nth in df.columns:
        nth += "_"
    window = Window.partitionBy(*(F.col(f"`{k}`") for k in keys)).orderBy(*order)
    return df.withColumn(nth, F.row_number().over(window)).filter(F.col(nth) == 1).drop(nth)


@dataclass(frozen=True)
class Reconciler:
    """base, view: specs of the tables; the key is the view's. ``unique``: both are known to have a key once."""

    base: TableSpec
    view: TableSpec
    start_seconds: int
    end_seconds: int
    unique: bool = True
    strict: bool = False
    exclude_null_keys: bool = False

    @property
    def keys(self) -> tuple[str, ...]:
        return self.view.key_names

    @property
    def common(self) -> tuple[str, ...]:
        return common_cells(self.base, self.view)

    def _side(self, df: DataFrame, spec: TableSpec, name: str) -> DataFrame:
        names = {*spec.key_names, *(c.name for c in spec.cells)}
        if lacking := [k for k in self.keys if k not in names]:
            raise ValueError(f"{spec.name} lacks {', '.join(lacking)} of the view's key")
        rows = scan(df, spec)
        if self.exclude_null_keys and name == "base":
            rows = rows.dropna(subset=list(self.keys))
        order = [comparable(F.col(f"`{f.name}`"), f.dataType).alias(f"by_{i}") for i, f in enumerate(rows.schema.fields) if f.name not in self.keys]
        out = out_of_scope(*write_time_bounds(spec, self.common, self.strict), self.start_seconds, self.end_seconds)
        record = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
        side = [key_of(self.keys).alias(f"{name}_key"), record.alias(name), out.alias(f"{name}_out")]
        if self.unique:
            return rows.select(*side)
        # The window runs on the very column that is joined, so that one exchange and one sort serve both.
        some = rows.select(*side, F.struct(F.lit(1).alias("one"), *order).alias("by"))
        return first_rows(some, (f"{name}_key",), [F.col("by").asc_nulls_last()]).drop("by")

    def joined(self, base: DataFrame, view: DataFrame) -> DataFrame:
        """``key`` (a struct, whose fields may have any names), ``base`` and ``view`` (structs, null where absent), and ``state``."""
        b, v = self._side(base, self.base, "base"), self._side(view, self.view, "view")
        both = b.join(v, F.col("base_key") == F.col("view_key"), "full_outer")
        skipped = F.coalesce("base_out", F.lit(False)) | F.coalesce("view_out", F.lit(False))
        unequal = F.lit(False)
        for c in self._common_cells():
            unequal = unequal | self._differs(c)
        state = F.when(skipped, SKIPPED).when(F.col("base").isNull(), ORPHAN).when(F.col("view").isNull(), MISSING).when(unequal, INCONSISTENT).otherwise(CONSISTENT)
        return both.select(F.coalesce("base_key", "view_key").alias("key"), "base", "view", state.alias("state"))

    def flat(self, df: DataFrame) -> DataFrame:
        """``df`` with the fields of ``key`` as columns; one whose name another column has is called ``key_`` and its name."""
        rest = [c for c in df.columns if c != "key"]
        names = {k: f"key_{k}" if k.lower() in {c.lower() for c in rest} else k for k in self.keys}
        return df.select(*(F.col("key").getField(k).alias(n) for k, n in names.items()), *rest)

    def keyed(self, df: DataFrame) -> DataFrame:
        """What ``flat`` made, or a table with the key's columns, with ``key`` again."""
        names = {k: f"key_{k}" if f"key_{k}" in df.columns else k for k in self.keys}
        rest = [c for c in df.columns if c not in names.values()]
        return df.select(F.struct(*(F.col(f"`{n}`").alias(k) for k, n in names.items())).alias("key"), *(F.col(f"`{c}`") for c in rest))

    def _common_cells(self) -> list[Cell]:
        return [self.view.cell(n) for n in self.common]

    def _differs(self, c: Cell) -> Column:
        return differs(F.col(f"base.`{c.name}`"), F.col(f"view.`{c.name}`"), c.data_type, c.kind)

    def labels(self, base: DataFrame, view: DataFrame) -> DataFrame:
        return self.flat(self.joined(base, view).select("key", "state"))

    def mismatches(self) -> Column:
        """Of a joined row: name, kind and both values, as text or null, of each common cell that differs, by name."""
        found = []
        for c in self._common_cells():
            text = lambda side, c=c: F.when(F.col(f"{side}.`{c.name}`").isNotNull(), rendered(F.col(f"{side}.`{c.name}`"), c.data_type, c.kind))
            cell = F.struct(F.lit(c.name).alias("name"), F.lit(c.kind).alias("kind"), text("base").alias("base_value"), text("view").alias("view_value"))
            found.append(F.when((F.col("state") == INCONSISTENT) & self._differs(c), cell))
        if not found:
            return F.expr("cast(array() as array<struct<name:string,kind:string,base_value:string,view_value:string>>)")
        return F.filter(F.array(*found), lambda x: x.isNotNull())

    def findings(self, base: DataFrame, view: DataFrame) -> DataFrame:
        """Joined rows that need attention, with ``mismatches``, the first of which is ``mismatch``."""
        return self.flat(self.found(self.joined(base, view)))

    def found(self, joined: DataFrame) -> DataFrame:
        """``findings`` of rows that are joined already."""
        rows = joined.filter(F.col("state").isin(ORPHAN, MISSING, INCONSISTENT))
        return rows.withColumn("mismatches", self.mismatches()).withColumn("mismatch", F.get("mismatches", F.lit(0)))

    def key_text(self, key: Column | None = None) -> Column:
        """``name:KIND:value`` of each key column, by name. key: a struct, the column ``key`` by default."""
        key = F.col("key") if key is None else key
        parts = [F.concat(F.lit(f"{k.name}:{k.kind}:"), rendered(key.getField(k.name), k.data_type, k.kind)) for k in sorted(self.view.keys, key=lambda k: k.name)]
        return F.concat_ws(",", *parts)
