"""Counts of a run, as one aggregate; a retried task can't count twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from viewrecon.operators.reconcile import CONSISTENT, INCONSISTENT, MISSING, ORPHAN, SKIPPED
from viewrecon.operators.repair import DELETE, NONE, PLANNED, UPSERT

#: Names and order in the statistics line.
COUNTERS = {
    "totRecords": "true",
    "skippedRecords": f"state = '{SKIPPED}'",
    "consistentRecords": f"state = '{CONSISTENT}'",
    "inConsistentRecords": f"state = '{INCONSISTENT}'",
    "missingBaseTableRecords": f"state = '{ORPHAN}'",
    "missingMvRecords": f"state = '{MISSING}'",
    "repairRecords": f"action <> '{NONE}'",
    "notRepairRecords": f"action = '{NONE}' AND state NOT IN ('{SKIPPED}', '{CONSISTENT}')",
    "delAttemptedRecords": f"action = '{DELETE}' AND outcome <> '{PLANNED}'",
    "delErrRecords": "outcome = 'DELETE_ERROR'",
    "delSuccessRecords": "outcome = 'DELETED'",
    "notDelRecords": "outcome = 'KEPT'",
    "upsertAttemptedRecords": f"action = '{UPSERT}' AND outcome <> '{PLANNED}'",
    "upsertErrRecords": "outcome = 'UPSERT_ERROR'",
    "upsertSuccessRecords": "outcome = 'UPSERTED'",
}


def job_stats(outcomes: DataFrame) -> DataFrame:
    """One row with a long for each counter. outcomes: (state, action, outcome) of every key."""
    return outcomes.agg(*(F.count_if(F.expr(condition)).alias(name) for name, condition in COUNTERS.items()))


def identities_hold(s: Row, planned: int = 0) -> bool:
    """planned: repairs of a run that only plans, which are not attempted."""
    found = s.inConsistentRecords + s.missingBaseTableRecords + s.missingMvRecords
    return (
        s.totRecords == s.skippedRecords + s.consistentRecords + found
        and found == s.repairRecords + s.notRepairRecords
        and s.repairRecords == s.delAttemptedRecords + s.upsertAttemptedRecords + planned
        and s.delAttemptedRecords == s.delErrRecords + s.delSuccessRecords + s.notDelRecords
        and s.upsertAttemptedRecords == s.upsertErrRecords + s.upsertSuccessRecords
    )


def stats_line(s: Row) -> str:
    return ", ".join(f"{name}: {s[name]}" for name in COUNTERS)
