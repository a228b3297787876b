"""Reconciling and repairing small tables, in the cases that the registered queries don't reach."""

import datetime
import decimal
import time

import pytest
from pyspark.sql import functions as F

from viewrecon.functions.kinds import differs, kind_of, rendered
from viewrecon.operators import report
from viewrecon.operators.mutate import mutated
from viewrecon.operators.reconcile import Reconciler
from viewrecon.operators.repair import Repairer, after_repair, statements
from viewrecon.operators.stats import identities_hold, job_stats, stats_line
from viewrecon.plans.job import Run
from viewrecon.plans.schema import TableSpec, common_cells
from viewrecon.plans.settings import Settings
from viewrecon.sources.staging import release, shared_folder, staged, staged_path
from viewrecon.sources.tables import read_table

T1, T2 = 1704067200000000, 1704153600000000
BASE = "pk string, ck1 string, ck2 int, c1 int, c2 int, c3 int, c4 int, wt long, ttl int"
ROWS = [("Driver1", "SF", 2020, 10, 20, 30, 40, T1, None), ("Driver2", "NY", 2021, 11, 22, 33, 44, T2, None)]
KEYS = ("c1", "pk", "ck1", "ck2")
ALL = Settings(0, 4_000_000_000, fix_missing=True, fix_orphans=True, fix_inconsistent=True)


def tables(spark, base=ROWS, view=ROWS, without=()):
    b = spark.createDataFrame(base, BASE)
    return b, spark.createDataFrame(view, BASE).drop(*without)


def reconciler(b, v, start=0, end=4_000_000_000, **more):
    return Reconciler(TableSpec.of(b, ("pk", "ck1", "ck2"), "base", write_time="wt", ttl="ttl"), TableSpec.of(v, KEYS, "view", write_time="wt", ttl="ttl"), start, end, **more)


def states(r, b, v):
    return {row.pk: row.state for row in r.labels(b, v).collect()}


def test_variants(spark):
    b, v = tables(spark)
    assert states(reconciler(b, v), b, v) == {"Driver1": "CONSISTENT", "Driver2": "CONSISTENT"}
    b, v = tables(spark, view=ROWS[:1])
    assert states(reconciler(b, v), b, v)["Driver2"] == "MISSING_IN_MV_TABLE"
    b, v = tables(spark, base=ROWS[:1])
    assert states(reconciler(b, v), b, v)["Driver2"] == "MISSING_IN_BASE_TABLE"
    b, v = tables(spark, base=ROWS[:1], without=("c4",))
    r = reconciler(b, v)
    assert r.common == ("c2", "c3") and states(r, b, v) == {"Driver1": "CONSISTENT", "Driver2": "MISSING_IN_BASE_TABLE"}
    changed = [ROWS[0], (*ROWS[1][:6], 441, T2, None)]
    b, v = tables(spark, view=changed)
    found = reconciler(b, v).findings(b, v).collect()
    assert [(f.state, f.mismatch.name, f.mismatch.base_value, f.mismatch.view_value) for f in found] == [("INCONSISTENT", "c4", "44", "441")]


def test_scope_is_inclusive_by_second_and_either_side_skips(spark):
    b, v = tables(spark)
    s1, s2 = T1 // 10**6, T2 // 10**6
    assert states(reconciler(b, v, s1, s2), b, v) == {"Driver1": "CONSISTENT", "Driver2": "CONSISTENT"}
    assert states(reconciler(b, v, s1 + 1, s2), b, v)["Driver1"] == "SKIPPED"
    assert states(reconciler(b, v, s1, s2 - 1), b, v)["Driver2"] == "SKIPPED"
    assert set(states(reconciler(b, v, -1, -1), b, v).values()) == {"SKIPPED"}
    late = [(*ROWS[0][:7], T2, None), ROWS[1]]
    for base, view in ((late, ROWS), (ROWS, late)):
        b, v = tables(spark, base=base, view=view)
        assert states(reconciler(b, v, s1, s1), b, v)["Driver1"] == "SKIPPED"


def test_fraction_of_a_second_counts_to_its_second(spark):
    b, v = tables(spark, base=[(*ROWS[0][:7], T1 + 999_999, None)], view=[(*ROWS[0][:7], T1 + 999_999, None)])
    assert states(reconciler(b, v, 0, T1 // 10**6), b, v) == {"Driver1": "CONSISTENT"}


def test_null_keys_duplicates_and_no_write_time(spark):
    odd = [("a", "x", 1, None, 1, 1, 1, None, None), ("a", "x", 1, None, 1, 1, 1, None, None)]
    b, v = tables(spark, base=odd, view=odd[:1])
    r = reconciler(b, v, unique=False)
    assert [row.state for row in r.labels(b, v).collect()] == ["CONSISTENT"]
    assert reconciler(b, v, unique=False, exclude_null_keys=True).labels(b, v).first().state == "MISSING_IN_BASE_TABLE"
    with pytest.raises(Exception, match="no write time"):
        reconciler(b, v, strict=True).labels(b, v).collect()


def test_two_mismatches_in_name_order(spark):
    b, v = tables(spark, view=[(*ROWS[0][:4], 21, 30, None, T1, None), ROWS[1]])
    found = reconciler(b, v).findings(b, v).first()
    assert [(m.name, m.base_value, m.view_value) for m in found.mismatches] == [("c2", "20", "21"), ("c4", "40", None)]


CASES = [
    ("string", "hello world!", "hi world!"), ("bigint", 5000, 5001), ("int", 10, 11), ("smallint", 3, 4), ("tinyint", 1, 2), ("float", 10.5, 10.51), ("double", 12.36, 12.37),
    ("decimal(10,2)", decimal.Decimal("100.05"), decimal.Decimal("100.06")), ("boolean", True, False), ("binary", b"Hello", b"Hi"), ("date", datetime.date(2022, 12, 1), datetime.date(2022, 12, 2)),
    ("timestamp", datetime.datetime(2024, 2, 18), datetime.datetime(2024, 2, 19)), ("array<int>", [100, 200, 300], [101, 201, 301]), ("map<int,int>", {1: 10, 2: 20}, {1: 11, 2: 20}), ("struct<a:int>", (1,), (2,)), ("array<map<int,int>>", [{1: 2}], [{1: 3}]),
]


@pytest.mark.parametrize("kind,a,b", CASES, ids=[c[0] for c in CASES])
def test_cells_by_type(spark, kind, a, b):
    df = spark.createDataFrame([(a, b), (a, a), (a, None), (None, None)], f"a {kind}, b {kind}")
    t = df.schema["a"].dataType
    assert [r[0] for r in df.select(differs(F.col("a"), F.col("b"), t)).collect()] == [True, False, True, False]


def test_order_of_sets_and_maps_is_no_difference(spark):
    df = spark.sql("SELECT array(3,1,2,2) AS s, array(1,2,3) AS t, map('b',1,'a',2) AS m, map('a',2,'b',1) AS n, double('nan') AS x, 0.0D AS y, -0.0D AS z")
    t = {f.name: f.dataType for f in df.schema.fields}
    got = df.select(differs(F.col("s"), F.col("t"), t["s"], "SET"), differs(F.col("s"), F.col("t"), t["s"], "LIST"), differs(F.col("m"), F.col("n"), t["m"]), differs(F.col("x"), F.col("x"), t["x"]), differs(F.col("y"), F.col("z"), t["y"])).first()
    assert tuple(got) == (False, True, False, False, False)


def test_rendering(spark):
    df = spark.sql("SELECT date'2022-12-01' AS d, timestamp_ntz'2024-02-18 04:36:37.005' AS t, cast('Zürich' AS binary) AS b, array(2,1) AS l, map('k',1) AS m, cast(null AS int) AS n, timestamp_ntz'1969-12-31 23:59:59.9995' AS e")
    got = df.select(*(rendered(F.col(f.name), f.dataType) for f in df.schema.fields)).first()
    assert tuple(got) == ("1669852800000", "1708230997005", "Zürich", "[2, 1]", "{k=1}", "null", "-1")


def test_kinds_and_guard(spark):
    df = spark.createDataFrame([], "id string, a int, t struct<x:int>, v decimal(38,0)")
    spec = TableSpec.of(df, ["id"], kinds={"id": "UUID", "v": "VARINT"})
    assert [(c.name, c.kind) for c in (*spec.keys, *spec.cells)] == [("id", "UUID"), ("a", "INT"), ("t", "TUPLE"), ("v", "VARINT")]
    r = Reconciler(spec, spec, 0, 1)
    Repairer(r, Settings(fix_orphans=True))
    with pytest.raises(ValueError, match="TUPLE"):
        Repairer(r, Settings(fix_missing=True))
    with pytest.raises(ValueError):
        kind_of(df.schema["a"].dataType, "TEXT")
    with pytest.raises(ValueError, match="no column"):
        TableSpec.of(df, ["nope"])
    other = TableSpec.of(spark.createDataFrame([], "id string, a long, v decimal(38,0)"), ["id"])
    assert common_cells(spec, other) == ()


def drifted(spark):
    base = [*ROWS, ("Driver3", "LA", 2022, 12, 1, 2, 3, T1, 3600), ("Driver5", "LA", 2022, None, 1, 2, 3, T1, None)]
    view = [ROWS[0], (*ROWS[1][:6], 441, T2, None), ("Driver4", "SF", 2020, 1, 1, 1, 1, T1, None)]
    return tables(spark, base, view)


def test_repair_and_identities(spark):
    b, v = drifted(spark)
    r = reconciler(b, v)
    fix = Repairer(r, ALL)
    joined = r.joined(b, v)
    plan = {(p.pk, p.column): (p.value, p.timestamp, p.ttl, p.flavor) for p in fix.upsert_plan(joined).collect()}
    assert plan == {("Driver2", "c4"): ("44", T2, None, "TIMESTAMP"), **{("Driver3", c): (x, T1, 3600, "TIMESTAMP_TTL") for c, x in (("c2", "1"), ("c3", "2"), ("c4", "3"))}}
    outcomes = {o.pk: (o.outcome, o.error) for o in r.flat(fix.outcomes(joined, fix.delete_plan(joined, b))).collect()}
    assert outcomes == {"Driver1": (None, None), "Driver2": ("UPSERTED", None), "Driver3": ("UPSERTED", None), "Driver4": ("DELETED", None), "Driver5": ("UPSERT_ERROR", "key value is null: c1")}
    failed = spark.createDataFrame([(1, "Driver4", "SF", 2020, "refused"), (11, "Driver2", "NY", 2021, "down")], "c1 int, pk string, ck1 string, ck2 int, error string")
    s = job_stats(fix.outcomes(joined, fix.delete_plan(joined, b), failed)).first()
    assert identities_hold(s) and (s.delErrRecords, s.upsertErrRecords, s.upsertSuccessRecords) == (1, 2, 1)
    fresh = b.unionByName(v.filter("pk = 'Driver4'"))
    s = job_stats(fix.outcomes(joined, fix.delete_plan(joined, fresh))).first()
    assert identities_hold(s) and s.notDelRecords == 1
    assert stats_line(s).startswith("totRecords: 5, skippedRecords: 0, consistentRecords: 1, inConsistentRecords: 1, missingBaseTableRecords: 1, missingMvRecords: 2,")
    idle = Repairer(r, Settings())
    none = job_stats(idle.outcomes(joined, idle.delete_plan(joined, b))).first()
    assert identities_hold(none) and none.notRepairRecords == 4
    after = fix.repaired(joined, fix.delete_plan(joined, b))
    spec = TableSpec.of(after, KEYS, **after_repair(r.view))
    assert {x.pk: x.state for x in Reconciler(r.base, spec, 0, 4_000_000_000).labels(b, after).collect()} == {"Driver1": "CONSISTENT", "Driver2": "CONSISTENT", "Driver3": "CONSISTENT", "Driver5": "MISSING_IN_MV_TABLE"}


def test_refused_writes_and_throttle(spark):
    def write(statement, row):
        if row["pk"] == "Driver3" and row["column"] != "c2":
            raise OSError(f"no {row['column']}")

    def never(statement, row):
        raise OSError("no")

    b, v = drifted(spark)
    r = reconciler(b, v)
    fix = Repairer(r, ALL)
    joined = r.joined(b, v)
    began = time.monotonic()
    errors = mutated(fix.upsert_plan(joined).coalesce(1), r, write, "ks", 10).collect()
    assert time.monotonic() - began > 0.25 and len(errors) == 2
    assert sorted(e.error for e in errors)[0] == "Error upserting data: no c3\nquery: INSERT INTO ks.view (c1,ck1,ck2,pk,c3) VALUES (?,?,?,?,?) USING TIMESTAMP ? AND TTL ?"
    present = fix.delete_plan(joined, v)
    assert mutated(present, r, never).count() == 0 and mutated(fix.delete_plan(joined, b), r, never).count() == 1


def test_latest_timestamp_and_key_only_view(spark):
    b, v = tables(spark, view=ROWS[:1])
    r = reconciler(b, v)
    plan = Repairer(r, Settings(fix_missing=True, use_latest_timestamp=True)).upsert_plan(r.joined(b, v)).collect()
    assert {(p.timestamp, p.flavor) for p in plan} == {(None, "NO_TIMESTAMP_TTL")}
    v = v.select(*KEYS)
    r = Reconciler(TableSpec.of(b, ("pk", "ck1", "ck2")), TableSpec.of(v, KEYS), 0, 1)
    fix = Repairer(r, ALL)
    joined = r.joined(b, v)
    assert fix.upsert_plan(joined).count() == 0 and fix.repaired(joined, fix.delete_plan(joined, b)).count() == 2


def test_statements(spark):
    _, v = tables(spark)
    found = statements("ks", "base", "mv", TableSpec.of(v.drop("wt", "ttl"), KEYS))
    assert len(found) == 2 + 4 * 3
    assert found["DELETE"] == "DELETE FROM ks.mv WHERE c1=? AND ck1=? AND ck2=? AND pk=?"
    assert found["SELECT"] == "SELECT * FROM ks.base WHERE c1=? AND ck1=? AND ck2=? AND pk=? ALLOW FILTERING"
    assert found["c3_TIMESTAMP_TTL"] == "INSERT INTO ks.mv (c1,ck1,ck2,pk,c3) VALUES (?,?,?,?,?) USING TIMESTAMP ? AND TTL ?"


def test_report_and_job(spark, tmp_path):
    b, v = drifted(spark)
    b.write.parquet(f"{tmp_path}/b")
    v.write.parquet(f"{tmp_path}/v")
    s = Settings(0, 4_000_000_000, base_table=f"{tmp_path}/b", view_table=f"{tmp_path}/v", fix_missing=True, fix_orphans=True, fix_inconsistent=True, output_dir=f"{tmp_path}/out", scan_rows_per_second=1000)
    run = Run(s, KEYS, {"keys": ("pk", "ck1", "ck2"), "write_time": "wt", "ttl": "ttl"}, {"write_time": "wt", "ttl": "ttl"})
    line, repaired = run(spark)
    assert "upsertErrRecords: 1, upsertSuccessRecords: 0" in line and "delAttemptedRecords: 0" in line and repaired.count() == 3
    text = spark.read.text(f"{tmp_path}/out/findings", wholetext=True).collect()
    assert {t.category for t in text} == {"INCONSISTENT", "MISSING_IN_BASE_TABLE", "MISSING_IN_MV_TABLE", "ERR_UPSERTING"}
    one = next(t.value for t in text if t.category == "INCONSISTENT")
    assert one.startswith("Problem: INCONSISTENT\nRowKey: c1:INT:11,ck1:TEXT:NY,ck2:INT:2021,pk:TEXT:Driver2\nMainTableEntry: {c1: 11, c2: 22,") and one.rstrip().endswith("BaseColumn: c4:INT:44\nMvColumn: c4:INT:441\n" + "=" * 30)
    report.console_sink(spark.createDataFrame([("a", "b")], "category string, block string"), "")
    with pytest.raises(ValueError, match="no table"):
        read_table(spark, "nowhere")


def test_job_applies_the_repair(spark, tmp_path):
    def connect(options):
        folder = options["to"]

        def write(statement, row):
            if row["pk"] == "Driver4" or row["pk"] == "Driver3" and row["column"] != "c2":
                raise OSError(f"no {row.get('column')}")
            with open(f"{folder}/written", "a") as f:
                f.write(f"{time.monotonic()} {statement}\n")

        return write

    b, v = drifted(spark)
    b.coalesce(1).write.parquet(f"{tmp_path}/b")
    v.coalesce(1).write.parquet(f"{tmp_path}/v")
    given = {"start_seconds": "0", "end_seconds": "4000000000", "base_table": f"{tmp_path}/b", "view_table": f"{tmp_path}/v", "namespace": "ks", "fix_missing": "true", "fix_orphans": "true", "fix_inconsistent": "true", "mutations_per_second": "5", "write_options": f"to={tmp_path}", "output_dir": f"{tmp_path}/out"}
    s = Settings.from_mapping({f"viewrecon.{k}": x for k, x in given.items()})
    run = Run(s, KEYS, {"keys": ("pk", "ck1", "ck2"), "write_time": "wt", "ttl": "ttl"}, {"write_time": "wt", "ttl": "ttl"})
    line, repaired = run(spark, connect=connect)
    written = [x.split(" ", 1)[1] for x in (tmp_path / "written").read_text().splitlines()]
    assert sorted(x.split("pk,")[1][:2] for x in written) == ["c2", "c4"] and all(x.startswith("INSERT INTO ks.v (") for x in written)
    assert "upsertErrRecords: 2" in line and "delErrRecords: 1" in line and "totRecords: 5" in line and repaired.count() == 3
    text = {t.category: t.value for t in spark.read.text(f"{tmp_path}/out/findings", wholetext=True).collect() if t.category.startswith("ERR_")}
    assert set(text) == {"ERR_DELETING", "ERR_UPSERTING"} and "Error deleting data: no None" in text["ERR_DELETING"]


def test_console_sink_prints_every_block(spark, capsys):
    want = [f"Problem: {i}\n{'x' * 200}\n{report.RULE}" for i in range(50)]
    report.console_sink(spark.createDataFrame([("a", b) for b in want], "category string, block string"), "")
    assert capsys.readouterr().out == "".join(f"{b}\n" for b in want)


@pytest.mark.parametrize("names", [("state", "base", "view"), ("action", "error", "present"), ("column", "kind", "value"), ("key", "by", "outcome")])
def test_keys_of_any_name(spark, tmp_path, names):
    """Key columns that are called like the engine's own keep their values, under ``key_`` and their name where a result has that name."""
    b = spark.createDataFrame([(1, "x", None, 5), (2, "y", 2, 6), (3, "z", 3, 7)], f"`{names[0]}` int, `{names[1]}` string, `{names[2]}` int, cell int")
    v = spark.createDataFrame([(1, "x", None, 5), (2, "y", 2, 60), (4, "w", 4, 8)], b.schema)
    for unique in (True, False):
        r = Reconciler(TableSpec.of(b, names[:1], "base"), TableSpec.of(v, names, "view"), 0, 1, unique=unique)
        fix = Repairer(r, ALL)
        joined = r.joined(b, v)
        got = sorted(tuple(x) for x in r.labels(b, v).collect())
        assert got == [(1, "x", None, "CONSISTENT"), (2, "y", 2, "INCONSISTENT"), (3, "z", 3, "MISSING_IN_MV_TABLE"), (4, "w", 4, "MISSING_IN_BASE_TABLE")]
        deletes = fix.delete_plan(joined, b)
        assert [tuple(x) for x in deletes.collect()] == [(4, "w", 4, False)]
        assert sorted(tuple(x)[:4] for x in fix.upsert_plan(joined).collect()) == [(2, "y", 2, "cell"), (3, "z", 3, "cell")]

        def never(statement, row):
            raise OSError("no")

        refused = mutated(deletes, r, never)
        assert [tuple(x)[:3] for x in refused.collect()] == [(4, "w", 4)]
        outcomes = fix.outcomes(joined, deletes, refused)
        assert sorted((x.key[0], x.outcome) for x in outcomes.collect()) == [(1, None), (2, "UPSERTED"), (3, "UPSERTED"), (4, "DELETE_ERROR")]
        assert {x.category for x in report.routed(report.blocks(r.found(joined), r), outcomes).collect()} == {"INCONSISTENT", "MISSING_IN_MV_TABLE", "MISSING_IN_BASE_TABLE", "ERR_DELETING"}
        after = fix.repaired(joined, deletes)
        assert after.columns == [*names, "cell"] and sorted(x[0] for x in after.collect()) == [1, 2, 3]


def test_a_folder_that_all_share(spark, monkeypatch):
    class Elsewhere:
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("Context", (), {"master": "yarn", "getConf": staticmethod(lambda: type("C", (), {"get": staticmethod(lambda n: None)}))})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere)
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def full_joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter")


def test_one_join_and_one_exchange_a_side(spark):
    """What a run derives from the staged join has none of its own, and duplicate keys cost no further exchange."""
    b, v = drifted(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    for unique in (True, False):
        joined = reconciler(b, v, unique=unique).joined(b, v)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert full_joins(joined) == 1 and plan.count("Exchange hashpartitioning") == 2
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    r = reconciler(b, v)
    fix, held = Repairer(r, ALL), staged(r.joined(b, v), "joined", by="state")
    deletes = staged(fix.delete_plan(held, b), "deletes")
    outcomes = fix.outcomes(held, deletes)
    for df in (fix.upsert_plan(held), deletes, outcomes, job_stats(outcomes), report.routed(report.blocks(r.found(held), r), outcomes), fix.repaired(held, deletes)):
        assert full_joins(df) == 0
    scan = r.found(held)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [state" in scan


def test_settings():
    s = Settings.from_mapping({"viewrecon.start_seconds": "5", "spark.viewrecon.start_seconds": "6", "spark.viewrecon.fix_missing": "TRUE", "viewrecon.output_dir": ""})
    assert s == Settings(start_seconds=5, fix_missing=True)
    assert Settings.options("host=a;port=1;x") == {"host": "a", "port": "1"}


def test_no_rows(spark):
    b, v = tables(spark)
    b, v = b.limit(0), v.limit(0)
    r = reconciler(b, v)
    assert r.findings(b, v).count() == 0
    fix, joined = Repairer(r, ALL), r.joined(b, v)
    s = job_stats(fix.outcomes(joined, fix.delete_plan(joined, b))).first()
    assert identities_hold(s) and s.totRecords == 0


def test_stream_of_changed_keys(spark, tmp_path):
    from viewrecon.streaming.batches import reconcile_changes

    b, v = drifted(spark)
    b.write.parquet(f"{tmp_path}/b")
    v.write.parquet(f"{tmp_path}/v")
    v.filter("pk = 'Driver2'").select(*KEYS).write.parquet(f"{tmp_path}/changes")
    changes = spark.readStream.schema(v.select(*KEYS).schema).parquet(f"{tmp_path}/changes")
    got = []
    reconcile_changes(changes, reconciler(b, v), lambda: spark.read.parquet(f"{tmp_path}/b"), lambda: spark.read.parquet(f"{tmp_path}/v"), lambda labels, _: got.extend((x.pk, x.state) for x in labels.collect()), f"{tmp_path}/cp").awaitTermination(60)
    assert got == [("Driver2", "INCONSISTENT")]


def test_plan_is_one_join_without_python(spark):
    b, v = tables(spark)
    plan = reconciler(b, v).labels(b, v)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and "Python" not in plan


def test_release_deletes_what_was_staged(spark):
    path = staged_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    release(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()
