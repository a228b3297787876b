"""A whole run: read, reconcile, report, count, and plan or apply the repair."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrecon.operators import report
from viewrecon.operators.mutate import Writer, mutated
from viewrecon.operators.reconcile import Reconciler
from viewrecon.operators.repair import Repairer
from viewrecon.plans.schema import TableSpec
from viewrecon.plans.settings import Settings
from viewrecon.sources.staging import staged
from viewrecon.sources.tables import read_table, throttled, write_table


#: Makes a writer, which tasks receive a copy of, from ``write_options``.
Connect = Callable[[dict[str, str]], Writer]


@dataclass(frozen=True)
class Run:
    """base_args, view_args: arguments of ``TableSpec.of`` beside the frame and the name."""

    settings: Settings
    view_keys: Sequence[str]
    base_args: Mapping[str, object]
    view_args: Mapping[str, object]

    def _where(self, name: str) -> str:
        return name if "/" in name or not self.settings.namespace else f"{self.settings.namespace}.{name}"

    def _read(self, spark: SparkSession, name: str) -> DataFrame:
        return read_table(spark, self._where(name), options=Settings.options(self.settings.read_options))

    def repairer(self, base: DataFrame, view: DataFrame) -> Repairer:
        s = self.settings
        names = ((t or "").rsplit("/", 1)[-1] for t in (s.base_table, s.view_table))  # as statements have them
        specs = TableSpec.of(base, name=next(names) or "base", **self.base_args), TableSpec.of(view, self.view_keys, name=next(names) or "view", **self.view_args)
        return Repairer(Reconciler(*specs, s.start_seconds, s.end_seconds, unique=False), s)

    def _apply(self, fix: Repairer, joined: DataFrame, deletes: DataFrame, connect: Connect) -> DataFrame:
        """(key, error): hands the plans to the writer, once, at the rate of the settings; one row for each key that it refused."""
        s, r = self.settings, fix.r
        write = connect(Settings.options(s.write_options))
        upserts, gone = (r.keyed(mutated(p, r, write, s.namespace or "", s.mutations_per_second)) for p in (fix.upsert_plan(joined), deletes))
        rows = upserts.unionByName(gone)
        return staged(r.flat(rows.groupBy("key").agg(F.array_join(F.sort_array(F.collect_list("error")), "\n").alias("error"))), "refused_keys")

    def __call__(self, spark: SparkSession, sink: report.Sink = report.text_sink, connect: Connect | None = None) -> tuple[str, DataFrame]:
        """Writes the report and the statistics under ``output_dir``. Returns the statistics line and the repaired view.

        Both tables are read and joined once; all steps read that result, so that none sees a view that is half
        repaired. With ``connect`` the plans are handed to a writer, and what it refused is in the report and the
        statistics; with ``repaired_table`` in the settings the repaired view is written there. With neither the run
        plans only, and its repairs count as neither attempted nor done. What was staged stays until
        ``viewrecon.sources.staging.release``, because the view returned reads it.
        """
        s = self.settings
        base, view = (throttled(self._read(spark, t), s.scan_rows_per_second) for t in (s.base_table, s.view_table))
        fix = self.repairer(base, view)
        joined = staged(fix.r.joined(base, view), "joined", by="state")
        deletes = staged(fix.delete_plan(joined, self._read(spark, s.base_table)), "deletes")
        failed = self._apply(fix, joined, deletes, connect) if connect else None
        repaired = fix.repaired(joined, deletes)
        if s.repaired_table:
            write_table(repaired, self._where(s.repaired_table))
        outcomes = staged(fix.outcomes(joined, deletes, failed, bool(connect or s.repaired_table)), "outcomes")
        sink(report.routed(report.blocks(fix.r.found(joined), fix.r), outcomes), f"{s.output_dir}/findings")
        return report.write_stats(outcomes, s.output_dir), repaired
