"""Plans repairs of a view as rows, and applies them to a copy of it.

A plan has one row for each cell to write, as INSERT statements of one cell would, or one row for each orphan
to delete. Orphans are looked up again in a fresh read of the base table before they go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewrecon.functions.kinds import differs, rendered
from viewrecon.operators.reconcile import CONSISTENT, INCONSISTENT, MISSING, ORPHAN, SKIPPED, Reconciler
from viewrecon.plans.schema import TableSpec, check_repairable
from viewrecon.plans.settings import Settings
from viewrecon.sources.staging import staged
from viewrecon.sources.tables import key_of

DELETE, UPSERT, NONE, PLANNED = "DELETE", "UPSERT", "NONE", "PLANNED"
#: The ways to write a cell, by whether a timestamp and a time to live are given.
FLAVORS = ("NO_TIMESTAMP_TTL", "TIMESTAMP", "TTL", "TIMESTAMP_TTL")


def action(settings: Settings) -> Column:
    """What is done about a joined row in a given ``state``."""
    upsert = F.when((F.col("state") == MISSING) & F.lit(settings.fix_missing), UPSERT).when((F.col("state") == INCONSISTENT) & F.lit(settings.fix_inconsistent), UPSERT)
    return F.when((F.col("state") == ORPHAN) & F.lit(settings.fix_orphans), DELETE).otherwise(F.coalesce(upsert, F.lit(NONE)))


def flavor(timestamp: Column, ttl: Column) -> Column:
    return F.when(timestamp.isNotNull() & ttl.isNotNull(), FLAVORS[3]).when(timestamp.isNotNull(), FLAVORS[1]).when(ttl.isNotNull(), FLAVORS[2]).otherwise(FLAVORS[0])


class Repairer:
    def __init__(self, reconciler: Reconciler, settings: Settings):
        check_repairable(reconciler.view, settings.fix_missing, settings.fix_inconsistent)
        self.r, self.settings = reconciler, settings

    def actions(self, joined: DataFrame) -> DataFrame:
        """``joined`` with ``action`` and ``error``, which says why an upsert can't be done: a null in the key."""
        fields = {k: F.col("key").getField(k) for k in self.r.keys}
        null_key = [F.when(field.isNull(), F.lit(k)) for k, field in fields.items()]
        error = F.when((F.col("action") == UPSERT) & F.greatest(*(field.isNull() for field in fields.values()), F.lit(False), F.lit(False)), F.concat(F.lit("key value is null: "), F.concat_ws(",", *null_key)))
        return joined.withColumn("action", action(self.settings)).withColumn("error", error)

    def upsert_plan(self, joined: DataFrame) -> DataFrame:
        """(key, column, kind, value as text, timestamp, ttl, flavor): the cells to write. Cells that only the view has are left alone."""
        cells = []
        for name in self.r.common:
            c, b = self.r.view.cell(name), self.r.base.cell(name)
            value = F.col(f"base.`{name}`")
            timestamp = F.col(f"base.`writetime({name})`") if b.write_time and not self.settings.use_latest_timestamp else F.lit(None).cast("long")
            ttl = F.col(f"base.`ttl({name})`") if b.ttl else F.lit(None).cast("int")
            write = F.col("view").isNull() | differs(value, F.col(f"view.`{name}`"), c.data_type, c.kind)
            cells.append(F.when(write, F.struct(F.lit(name).alias("column"), F.lit(c.kind).alias("kind"), F.when(value.isNotNull(), rendered(value, c.data_type, c.kind)).alias("value"), timestamp.alias("timestamp"), ttl.alias("ttl"), flavor(timestamp, ttl).alias("flavor"))))
        rows = self.actions(joined).filter(F.col("action") == UPSERT).filter(F.col("error").isNull())
        if not cells:
            return self.r.flat(rows.select("key", F.lit(None).cast("string").alias("column")).limit(0))
        planned = rows.select("key", F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("cell"))
        return self.r.flat(planned.select("key", "cell.*"))

    def delete_plan(self, joined: DataFrame, fresh_base: DataFrame) -> DataFrame:
        """(key, present): orphans to delete, with ``present`` where the fresh base holds the key after all.

        Orphans are staged, so that the fresh base is met by a table of known size and shuffled only if that is large.
        """
        orphans = staged(self.actions(joined).filter(F.col("action") == DELETE).select("key"), "orphans")
        there = fresh_base.select(key_of(self.r.keys).alias("key")).join(orphans, "key", "left_semi").distinct().withColumn("present", F.lit(True))
        return self.r.flat(orphans.join(there, "key", "left").select("key", F.coalesce("present", F.lit(False)).alias("present")))

    def outcomes(self, joined: DataFrame, deletes: DataFrame, failed: DataFrame | None = None, applied: bool = True) -> DataFrame:
        """(key, state, action, outcome, error) of every key.

        Outcomes: DELETED, KEPT, DELETE_ERROR, UPSERTED, UPSERT_ERROR, or none; PLANNED in place of the first and
        fourth where the plans aren't ``applied``. deletes: the delete plan. failed: (key, error) of writes that were
        refused. Only keys with an action meet the two; ``joined`` is read twice and should be a table.
        """
        rows = self.actions(joined).select("key", "state", "action", "error")
        acted = rows.filter(F.col("action") != NONE).join(self.r.keyed(deletes), "key", "left")
        if failed is not None:
            refused = self.r.keyed(failed).withColumnRenamed("error", "refused")
            written = (F.col("action") == UPSERT) | (F.col("action") == DELETE) & ~F.col("present")
            acted = acted.join(refused, "key", "left").withColumn("error", F.coalesce("error", F.when(written, F.col("refused"))))
        done = lambda name: F.lit(name if applied else PLANNED)
        upsert = F.when(F.col("error").isNull(), done("UPSERTED")).otherwise("UPSERT_ERROR")
        delete = F.when(F.col("present"), "KEPT").when(F.col("error").isNotNull(), "DELETE_ERROR").otherwise(done("DELETED"))
        outcome = F.when(F.col("action") == UPSERT, upsert).otherwise(delete)
        quiet = rows.filter(F.col("action") == NONE).select("key", "state", "action", F.lit(None).cast("string").alias("outcome"), "error")
        return acted.select("key", "state", "action", outcome.alias("outcome"), "error").unionByName(quiet)

    def repaired(self, joined: DataFrame, deletes: DataFrame) -> DataFrame:
        """The view after the repair, with the columns of its scan: planned cells taken over with their write time
        and time to live, planned orphans gone, everything else as it was. A key-only view gains the missing rows.
        deletes: the delete plan. ``joined`` is read twice and should be a table."""
        rows = self.actions(joined)
        gone = self.r.keyed(deletes).filter(~F.col("present")).select("key")
        left = rows.filter(F.col("action") == DELETE).join(gone, "key", "left_anti")
        rows = rows.filter(F.col("action") != DELETE).unionByName(left)
        fixed = (F.col("action") == UPSERT) & F.col("error").isNull()
        rows = rows.filter(F.col("view").isNotNull() | fixed)
        out = [F.col("key").getField(k).alias(k) for k in self.r.keys]
        for c in self.r.view.cells:
            has_view, names = F.col("view").isNotNull(), [c.name]
            names += [f"writetime({c.name})"] * bool(c.write_time) + [f"ttl({c.name})"] * bool(c.ttl)
            if c.name not in self.r.common:
                out += [F.col(f"view.`{n}`").alias(n) for n in names]
                continue
            b = self.r.base.cell(c.name)
            taken = fixed & (~has_view | differs(F.col(f"base.`{c.name}`"), F.col(f"view.`{c.name}`"), c.data_type, c.kind))
            given = {c.name: F.col(f"base.`{c.name}`")}
            if b.write_time:
                given[f"writetime({c.name})"] = F.unix_micros(F.current_timestamp()) if self.settings.use_latest_timestamp else F.col(f"base.`writetime({c.name})`")
            if b.ttl:
                given[f"ttl({c.name})"] = F.col(f"base.`ttl({c.name})`")
            out += [F.when(taken, given.get(n, F.lit(None))).otherwise(F.col(f"view.`{n}`")).alias(n) for n in names]
        return rows.select(*out)


def after_repair(spec: TableSpec) -> dict[str, dict[str, str]]:
    """Arguments of ``TableSpec.of`` for the columns that a repaired view has."""
    return {"write_time": {c.name: f"writetime({c.name})" for c in spec.cells if c.write_time}, "ttl": {c.name: f"ttl({c.name})" for c in spec.cells if c.ttl}}


def statements(namespace: str, base: str, view: str, spec: TableSpec) -> dict[str, str]:
    """Statement texts for a dry run: ``<cell>_<FLAVOR>`` to write a cell, ``SELECT`` to look a key up, ``DELETE``. Columns are in name order."""
    keys = sorted(spec.key_names)
    where = " AND ".join(f"{k}=?" for k in keys)
    found = {"SELECT": f"SELECT * FROM {namespace}.{base} WHERE {where} ALLOW FILTERING", "DELETE": f"DELETE FROM {namespace}.{view} WHERE {where}"}
    using = dict(zip(FLAVORS, ("", " USING TIMESTAMP ?", " USING TTL ?", " USING TIMESTAMP ? AND TTL ?"), strict=True))
    for c in spec.cells:
        columns = [*keys, c.name]
        insert = f"INSERT INTO {namespace}.{view} ({','.join(columns)}) VALUES ({','.join('?' * len(columns))})"
        found |= {f"{c.name}_{f}": insert + suffix for f, suffix in using.items()}
    return found


STATES = (SKIPPED, CONSISTENT, INCONSISTENT, ORPHAN, MISSING)
