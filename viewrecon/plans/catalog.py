"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrecon.functions.kinds import differs, rendered
from viewrecon.operators import report
from viewrecon.operators.mutate import mutated
from viewrecon.operators.reconcile import first_rows, out_of_scope, write_time_bounds
from viewrecon.operators.repair import Repairer, after_repair, statements
from viewrecon.operators.stats import COUNTERS, job_stats
from viewrecon.plans.fixtures import END, KEYS, START, ctes, drift, reconciler, repair_settings
from viewrecon.plans.job import Run
from viewrecon.plans.schema import TableSpec, check_repairable, common_cells
from viewrecon.plans.settings import Settings
from viewrecon.sources.staging import staged, staged_path
from viewrecon.sources.tables import key_of, present_in, scan, throttled

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_JOINED = f"""WITH {ctes("duckdb")},
b AS (SELECT *, true AS here, {START} > wt // 1000000 OR wt // 1000000 > {END} AS out FROM base),
v AS (SELECT *, true AS here, {START} > wt // 1000000 OR wt // 1000000 > {END} AS out FROM mv),
j AS (
  SELECT coalesce(b.o_custkey, v.o_custkey) AS o_custkey, coalesce(b.o_orderkey, v.o_orderkey) AS o_orderkey,
         b.o_orderstatus AS b_status, v.o_orderstatus AS v_status, b.o_totalprice AS b_price, v.o_totalprice AS v_price,
         b.o_orderpriority AS b_priority, v.o_orderpriority AS v_priority, b.o_tags AS b_tags, v.o_tags AS v_tags,
         b.wt AS b_wt, v.wt AS v_wt, b.price_ttl AS b_ttl, v.price_ttl AS v_ttl, b.here IS NOT NULL AS in_base, v.here IS NOT NULL AS in_view,
         CASE WHEN coalesce(b.out, false) OR coalesce(v.out, false) THEN 'SKIPPED'
              WHEN b.here IS NULL THEN 'MISSING_IN_BASE_TABLE' WHEN v.here IS NULL THEN 'MISSING_IN_MV_TABLE'
              WHEN b.o_orderstatus IS DISTINCT FROM v.o_orderstatus OR b.o_totalprice IS DISTINCT FROM v.o_totalprice
                OR b.o_orderpriority IS DISTINCT FROM v.o_orderpriority OR b.o_tags IS DISTINCT FROM v.o_tags THEN 'INCONSISTENT'
              ELSE 'CONSISTENT' END AS state
  FROM b FULL JOIN v ON b.o_custkey IS NOT DISTINCT FROM v.o_custkey AND b.o_orderkey IS NOT DISTINCT FROM v.o_orderkey),
p AS (SELECT *, CASE WHEN state = 'MISSING_IN_BASE_TABLE' THEN 'DELETE' WHEN state IN ('MISSING_IN_MV_TABLE', 'INCONSISTENT') THEN 'UPSERT' ELSE 'NONE' END AS action FROM j)
"""
_PRICE = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"


def _query(oracle: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _joined(spark: SparkSession, sf_dir: str):
    base, view = drift(spark, sf_dir)
    r = reconciler(base, view)
    return r, base, view, r.joined(base, view)


def _repair(spark: SparkSession, sf_dir: str):
    r, base, _, joined = _joined(spark, sf_dir)
    return Repairer(r, repair_settings()), base, staged(joined, "joined", by="state")


def _cents(df: DataFrame) -> DataFrame:
    """Prices as decimals: engines write doubles differently."""
    return df.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


# Scans and derived columns


@_query(f"""WITH {ctes("duckdb")} SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, wt AS price_written, coalesce(price_ttl, -1) AS price_ttl FROM base""")
def scan_cell_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, view = drift(spark, sf_dir)
    rows = scan(base, reconciler(base, view).base)
    return rows.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice", F.col("`writetime(o_totalprice)`").alias("price_written"), F.coalesce(F.col("`ttl(o_totalprice)`"), F.lit(-1)).alias("price_ttl"))


@_query(f"""WITH {ctes("duckdb")} SELECT 'o_custkey:BIGINT:' || o_custkey || ',o_orderkey:BIGINT:' || o_orderkey AS key_text FROM mv""")
def record_key_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, view = drift(spark, sf_dir)
    return view.select(reconciler(base, view).key_text(key_of(KEYS)).alias("key_text"))


_TIMES = f"""t AS (SELECT o_orderkey, wt AS a, CASE WHEN o_orderkey % 83 <> 0 THEN wt + o_orderkey END AS b, CASE WHEN o_orderkey % 5 <> 0 THEN wt - 7 END AS c FROM base)"""


def _three_times(spark: SparkSession, sf_dir: str):
    """Cells with write times of their own, some null."""
    base, _ = drift(spark, sf_dir)
    df = base.selectExpr("o_orderkey", "1 AS x", "CASE WHEN o_orderkey % 83 <> 0 THEN 2 END AS y", "CASE WHEN o_orderkey % 5 <> 0 THEN 3 END AS z", "wt AS x_at", "wt + o_orderkey AS y_at", "wt - 7 AS z_at")
    spec = TableSpec.of(df, ("o_orderkey",), write_time={"x": "x_at", "y": "y_at", "z": "z_at"})
    return scan(df, spec), write_time_bounds(spec, ("x", "y", "z"), strict=True)


@_query(f"""WITH {ctes("duckdb")}, {_TIMES} SELECT o_orderkey, least(a, b, c) AS least_wt, greatest(a, b, c) AS most_wt FROM t""")
def write_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, (least, most) = _three_times(spark, sf_dir)
    return rows.select("o_orderkey", least.alias("least_wt"), most.alias("most_wt"))


@_query(f"""WITH {ctes("duckdb")}, {_TIMES} SELECT o_orderkey, {START} > least(a, b, c) // 1000000 OR greatest(a, b, c) // 1000000 > {END} AS out FROM t""")
def scope_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, bounds = _three_times(spark, sf_dir)
    return rows.select("o_orderkey", out_of_scope(*bounds, START, END).alias("out"))


# Reconciling


@_query(_JOINED + "SELECT o_custkey, o_orderkey, state FROM j")
def reconcile_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, view = drift(spark, sf_dir)
    return reconciler(base, view).labels(base, view)


@_query(_JOINED + "SELECT state, count(*) AS records FROM j GROUP BY state")
def reconcile_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_labels(spark, sf_dir).groupBy("state").agg(F.count("*").alias("records"))


@_query(f"""WITH {ctes("duckdb")} SELECT o_custkey, o_orderkey FROM base b WHERE NOT EXISTS (SELECT 1 FROM mv WHERE mv.o_custkey IS NOT DISTINCT FROM b.o_custkey AND mv.o_orderkey IS NOT DISTINCT FROM b.o_orderkey)""")
def missing_in_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, view = drift(spark, sf_dir)
    return present_in(base.select(*KEYS), view, KEYS, absent=True)


@_query(f"""WITH {ctes("duckdb")} SELECT o_custkey, o_orderkey FROM mv b WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.o_custkey IS NOT DISTINCT FROM b.o_custkey AND base.o_orderkey IS NOT DISTINCT FROM b.o_orderkey)""")
def orphans_in_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, view = drift(spark, sf_dir)
    return present_in(view.select(*KEYS), base, KEYS, absent=True)


_MISMATCHES = """, m AS (
  SELECT o_custkey, o_orderkey, 'o_orderstatus' AS name, 'TEXT' AS kind, b_status AS base_value, v_status AS view_value FROM j WHERE state = 'INCONSISTENT' AND b_status IS DISTINCT FROM v_status
  UNION ALL
  SELECT o_custkey, o_orderkey, 'o_totalprice', 'DECIMAL', CAST(CAST(b_price AS DECIMAL(18,2)) AS VARCHAR), CAST(CAST(v_price AS DECIMAL(18,2)) AS VARCHAR) FROM j WHERE state = 'INCONSISTENT' AND b_price IS DISTINCT FROM v_price)
"""


def _findings(spark: SparkSession, sf_dir: str):
    base, view = (_cents(df) for df in drift(spark, sf_dir))
    r = reconciler(base, view)
    return r, r.findings(base, view)


@_query(_JOINED + _MISMATCHES + "SELECT * FROM m")
def all_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found = _findings(spark, sf_dir)
    return found.select(*KEYS, F.explode("mismatches").alias("m")).select(*KEYS, "m.*")


@_query(_JOINED + _MISMATCHES + "SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderkey ORDER BY name) = 1")
def first_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found = _findings(spark, sf_dir)
    return found.filter(F.col("mismatch").isNotNull()).select(*KEYS, "mismatch.*")


_LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@_query(f"""SELECT {", ".join(_LINE_COLUMNS[:4])}, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_LINE_COLUMNS[2:])}) = 1""")
def duplicate_keys_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    kept = first_rows(lines, _LINE_COLUMNS[:2], [F.col(c) for c in _LINE_COLUMNS[2:]])
    return kept.select(*_LINE_COLUMNS[:4], "l_quantity")


_NULL_KEY = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END"


@_query(f"""WITH {ctes("duckdb")}, b AS (SELECT {_NULL_KEY} AS o_custkey, o_orderkey, true AS here FROM base), v AS (SELECT {_NULL_KEY} AS o_custkey, o_orderkey, true AS here FROM mv)
SELECT coalesce(b.o_custkey, v.o_custkey, -1) AS o_custkey, coalesce(b.o_orderkey, v.o_orderkey) AS o_orderkey, b.here IS NOT NULL AS in_base, v.here IS NOT NULL AS in_view
FROM b FULL JOIN v ON b.o_custkey IS NOT DISTINCT FROM v.o_custkey AND b.o_orderkey IS NOT DISTINCT FROM v.o_orderkey""")
def null_safe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, view = (df.withColumn("o_custkey", F.expr(_NULL_KEY)) for df in drift(spark, sf_dir))
    r = reconciler(base, view)
    return r.flat(r.joined(base, view)).select(F.coalesce("o_custkey", F.lit(-1)).alias("o_custkey"), "o_orderkey", F.col("base").isNotNull().alias("in_base"), F.col("view").isNotNull().alias("in_view"))


# Cells by kind: each compares two values made from an order, and says whether they differ


def _compare(name: str, spark_a: str, spark_b: str, oracle: str, kind: str | None = None) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", f"{spark_a} AS a", f"{spark_b} AS b")
        return rows.select("o_orderkey", differs(F.col("a"), F.col("b"), rows.schema["a"].dataType, kind).alias("differs"))

    query.__name__ = name
    _query(f"SELECT o_orderkey, {oracle} AS differs FROM orders")(query)


_compare("compare_list", "array(o_orderkey % 3, 1, 2)", "array(1, o_orderkey % 3, 2)", "[o_orderkey % 3, 1, 2] IS DISTINCT FROM [1, o_orderkey % 3, 2]")
_compare("compare_set", "array(o_orderkey % 4, 1, 2)", "array(2, 2, 1, o_orderkey % 3)", "list_sort(list_distinct([o_orderkey % 4, 1, 2])) IS DISTINCT FROM list_sort(list_distinct([2, 2, 1, o_orderkey % 3]))", "SET")
_compare("compare_map", "map('x', o_orderkey % 3, 'y', 1)", "map('y', 1, 'x', o_orderkey % 2)", "(o_orderkey % 3) IS DISTINCT FROM (o_orderkey % 2)")
_compare("compare_blob", "cast(o_orderstatus AS binary)", "cast(substring(o_orderpriority, 1, 1) AS binary)", "o_orderstatus IS DISTINCT FROM substring(o_orderpriority, 1, 1)")
_compare("compare_decimal", "cast(o_totalprice AS decimal(18,2))", "cast(round(o_totalprice) AS decimal(18,2))", "CAST(o_totalprice AS DECIMAL(18,2)) IS DISTINCT FROM CAST(round(o_totalprice) AS DECIMAL(18,2))")
_compare("compare_nan", "CASE WHEN o_orderkey % 2 = 0 THEN double('NaN') ELSE -0.0D END", "CASE WHEN o_orderkey % 3 = 0 THEN double('NaN') ELSE 0.0D END", "(o_orderkey % 2 = 0) <> (o_orderkey % 3 = 0)")
_compare("compare_null", "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END", "CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END", "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END IS DISTINCT FROM CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END")


@_query("""SELECT o_orderkey, CAST(epoch_ms(o_orderdate) AS VARCHAR) AS moment, CAST(epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS VARCHAR) AS day,
o_orderstatus AS bytes, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, 'null') AS missing,
'[' || (o_orderkey % 5) || ', 7]' AS list, CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS flag FROM orders""")
def value_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey", "o_orderdate AS moment", "cast(o_orderdate AS date) AS day", "cast(o_orderstatus AS binary) AS bytes", "cast(o_totalprice AS decimal(18,2)) AS price",
        "CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS missing", "array(o_orderkey % 5, 7) AS list", "o_orderkey % 2 = 0 AS flag",
    )
    return rows.select("o_orderkey", *(rendered(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema.fields[1:]))


# Reports and statistics

_BLOCK_ROW = "'{{o_custkey: ' || o_custkey || ', o_orderkey: ' || o_orderkey || ', o_orderpriority: ' || coalesce({s}_priority, 'null') || ', o_orderstatus: ' || coalesce({s}_status, 'null') || ', o_tags: [' || array_to_string({s}_tags, ', ') || '], o_totalprice: ' || coalesce(CAST(CAST({s}_price AS DECIMAL(18,2)) AS VARCHAR), 'null') || ', ttl(o_totalprice): ' || coalesce(CAST({s}_ttl AS VARCHAR), 'null') || {custkey} || ', writetime(o_orderpriority): ' || {s}_wt || ', writetime(o_orderstatus): ' || {s}_wt || ', writetime(o_totalprice): ' || {s}_wt || '}}'"


@_query(_JOINED + _MISMATCHES + f""", f AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderkey ORDER BY name) = 1)
SELECT j.o_custkey, j.o_orderkey, state AS category, concat_ws(chr(10), 'Problem: ' || state, 'RowKey: o_custkey:BIGINT:' || j.o_custkey || ',o_orderkey:BIGINT:' || j.o_orderkey,
  'MainTableEntry: ' || CASE WHEN in_base THEN {_BLOCK_ROW.format(s="b", custkey="', writetime(o_custkey): ' || b_wt").replace("o_custkey: ' || o_custkey", "o_custkey: ' || j.o_custkey").replace("o_orderkey: ' || o_orderkey", "o_orderkey: ' || j.o_orderkey")} ELSE 'null' END,
  'MVTableEntry: ' || CASE WHEN in_view THEN {_BLOCK_ROW.format(s="v", custkey="''").replace("o_custkey: ' || o_custkey", "o_custkey: ' || j.o_custkey").replace("o_orderkey: ' || o_orderkey", "o_orderkey: ' || j.o_orderkey")} ELSE 'null' END,
  'BaseColumn: ' || CASE WHEN f.name IS NOT NULL THEN concat_ws(':', f.name, f.kind, f.base_value) END, 'MvColumn: ' || CASE WHEN f.name IS NOT NULL THEN concat_ws(':', f.name, f.kind, f.view_value) END) AS block
FROM j LEFT JOIN f ON f.o_custkey = j.o_custkey AND f.o_orderkey = j.o_orderkey WHERE state NOT IN ('SKIPPED', 'CONSISTENT')""")
def finding_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, view = (_cents(df) for df in drift(spark, sf_dir))
    r = reconciler(base, view)
    return r.flat(report.blocks(r.found(r.joined(base, view)), r))


_OUTCOMES = """, o AS (SELECT *, CASE WHEN action = 'DELETE' THEN 'DELETED' WHEN action = 'UPSERT' THEN 'UPSERTED' END AS outcome FROM p)
"""
_COUNTS = "SELECT " + ", ".join(f'count(*) FILTER ({condition}) AS "{name}"' for name, condition in {
    "totRecords": "true", "skippedRecords": "state = 'SKIPPED'", "consistentRecords": "state = 'CONSISTENT'", "inConsistentRecords": "state = 'INCONSISTENT'",
    "missingBaseTableRecords": "state = 'MISSING_IN_BASE_TABLE'", "missingMvRecords": "state = 'MISSING_IN_MV_TABLE'", "repairRecords": "action <> 'NONE'",
    "notRepairRecords": "action = 'NONE' AND state IN ('INCONSISTENT', 'MISSING_IN_BASE_TABLE', 'MISSING_IN_MV_TABLE')", "delAttemptedRecords": "action = 'DELETE'",
    "delErrRecords": "outcome = 'DELETE_ERROR'", "delSuccessRecords": "outcome = 'DELETED'", "notDelRecords": "outcome = 'KEPT'", "upsertAttemptedRecords": "action = 'UPSERT'",
    "upsertErrRecords": "outcome = 'UPSERT_ERROR'", "upsertSuccessRecords": "outcome = 'UPSERTED'",
}.items()) + " FROM o"


@_query(_JOINED + _OUTCOMES + _COUNTS)
def job_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    fix, base, joined = _repair(spark, sf_dir)
    return job_stats(fix.outcomes(joined, fix.delete_plan(joined, base)))


@_query("SELECT o_orderkey, o_custkey FROM orders")
def throttled_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return throttled(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey"), 100_000)


# Repair


@_query(_JOINED + "SELECT o_custkey, o_orderkey, state, action FROM p")
def repair_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    fix, _, joined = _repair(spark, sf_dir)
    return fix.r.flat(fix.actions(joined)).select(*KEYS, "state", "action")


_UPSERTS = """, u AS (
  SELECT o_custkey, o_orderkey, 'o_orderpriority' AS "column", 'TEXT' AS kind, b_priority AS value, b_wt AS "timestamp", CAST(NULL AS INTEGER) AS ttl FROM p WHERE action = 'UPSERT' AND (NOT in_view OR b_priority IS DISTINCT FROM v_priority)
  UNION ALL SELECT o_custkey, o_orderkey, 'o_orderstatus', 'TEXT', b_status, b_wt, NULL FROM p WHERE action = 'UPSERT' AND (NOT in_view OR b_status IS DISTINCT FROM v_status)
  UNION ALL SELECT o_custkey, o_orderkey, 'o_tags', 'LIST', '[' || array_to_string(b_tags, ', ') || ']', NULL, NULL FROM p WHERE action = 'UPSERT' AND (NOT in_view OR b_tags IS DISTINCT FROM v_tags)
  UNION ALL SELECT o_custkey, o_orderkey, 'o_totalprice', 'DECIMAL', CAST(CAST(b_price AS DECIMAL(18,2)) AS VARCHAR), b_wt, b_ttl FROM p WHERE action = 'UPSERT' AND (NOT in_view OR b_price IS DISTINCT FROM v_price)),
w AS (SELECT *, CASE WHEN "timestamp" IS NOT NULL AND ttl IS NOT NULL THEN 'TIMESTAMP_TTL' WHEN "timestamp" IS NOT NULL THEN 'TIMESTAMP' WHEN ttl IS NOT NULL THEN 'TTL' ELSE 'NO_TIMESTAMP_TTL' END AS flavor FROM u)
"""


def _upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, view = (_cents(df) for df in drift(spark, sf_dir))
    r = reconciler(base, view)
    return Repairer(r, repair_settings()).upsert_plan(r.joined(base, view))


@_query(_JOINED + _UPSERTS + 'SELECT * REPLACE (coalesce("timestamp", -1) AS "timestamp", coalesce(ttl, -1) AS ttl) FROM w')
def upsert_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserts(spark, sf_dir).fillna(-1, ["timestamp", "ttl"])


@_query(_JOINED + _UPSERTS + 'SELECT "column", flavor, count(*) AS writes FROM w GROUP BY ALL')
def upsert_flavors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserts(spark, sf_dir).groupBy("column", "flavor").agg(F.count("*").alias("writes"))


@_query(_JOINED + _UPSERTS + """SELECT o_custkey, o_orderkey, 'INSERT INTO shop.orders_by_customer (o_custkey,o_orderkey,' || "column" || ') VALUES (?,?,?)' ||
CASE flavor WHEN 'TIMESTAMP' THEN ' USING TIMESTAMP ?' WHEN 'TTL' THEN ' USING TTL ?' WHEN 'TIMESTAMP_TTL' THEN ' USING TIMESTAMP ? AND TTL ?' ELSE '' END AS statement FROM w""")
def statement_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, view = drift(spark, sf_dir)
    texts = statements("shop", "orders", "orders_by_customer", reconciler(base, view).view)
    known = F.create_map(*(F.lit(x) for pair in texts.items() for x in pair))
    return _upserts(spark, sf_dir).select(*KEYS, F.element_at(known, F.concat_ws("_", "column", "flavor")).alias("statement"))


@_query(_JOINED + "SELECT o_custkey, o_orderkey, (o_orderkey % 2 = 0 AND o_orderkey > 10000000) AS present FROM p WHERE action = 'DELETE'")
def orphan_delete_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fresh base has gained the even ones of the copied orders meanwhile."""
    fix, base, joined = _repair(spark, sf_dir)
    _, view = drift(spark, sf_dir)
    gained = view.filter("o_orderkey > 10000000 AND o_orderkey % 2 = 0").select(*KEYS)
    return fix.delete_plan(joined, base.select(*KEYS).unionByName(gained))


@_query(f"""WITH {ctes("duckdb")}, b AS (SELECT {_NULL_KEY} AS o_custkey, o_orderkey, wt FROM base)
SELECT coalesce(o_custkey, -1) AS o_custkey, o_orderkey, CASE WHEN o_custkey IS NULL THEN 'UPSERT_ERROR' ELSE 'UPSERTED' END AS outcome FROM b
WHERE NOT ({START} > wt // 1000000 OR wt // 1000000 > {END}) AND NOT EXISTS (SELECT 1 FROM mv WHERE mv.o_custkey IS NOT DISTINCT FROM b.o_custkey AND mv.o_orderkey = b.o_orderkey)""")
def null_key_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, view = drift(spark, sf_dir)
    base = base.withColumn("o_custkey", F.expr(_NULL_KEY))
    r = reconciler(base, view)
    fix = Repairer(r, repair_settings())
    joined = r.joined(base, view)
    return r.flat(fix.outcomes(joined, fix.delete_plan(joined, base))).filter("state = 'MISSING_IN_MV_TABLE'").select(F.coalesce("o_custkey", F.lit(-1)).alias("o_custkey"), "o_orderkey", "outcome")


def _refuse(statement: str, row: dict) -> None:
    if row["o_orderkey"] % 10 == 0:
        raise ValueError("refused")


@_query(_JOINED + "SELECT o_custkey, o_orderkey, 'Error deleting data: refused' || chr(10) || 'query: DELETE FROM shop.orders_by_customer WHERE o_custkey=? AND o_orderkey=?' AS error FROM p WHERE action = 'DELETE' AND o_orderkey % 10 = 0")
def mutation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    fix, base, joined = _repair(spark, sf_dir)
    return mutated(fix.delete_plan(joined, base), fix.r, _refuse, "shop", 1_000_000)


_REPAIRED = """, x AS (
  SELECT o_custkey, o_orderkey, CASE WHEN action = 'UPSERT' THEN b_priority ELSE v_priority END AS o_orderpriority, CASE WHEN action = 'UPSERT' THEN b_status ELSE v_status END AS o_orderstatus,
         CASE WHEN action = 'UPSERT' THEN b_price ELSE v_price END AS o_totalprice, CASE WHEN action = 'UPSERT' AND (NOT in_view OR b_price IS DISTINCT FROM v_price) THEN b_wt ELSE v_wt END AS price_written
  FROM p WHERE action <> 'DELETE' AND (in_view OR action = 'UPSERT'))
"""


@_query(_JOINED + _REPAIRED + "SELECT * FROM x")
def repaired_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    fix, base, joined = _repair(spark, sf_dir)
    return fix.repaired(joined, fix.delete_plan(joined, base)).select(*KEYS, "o_orderpriority", "o_orderstatus", "o_totalprice", F.col("`writetime(o_totalprice)`").alias("price_written"))


@_query(_JOINED + "SELECT CASE WHEN state = 'SKIPPED' THEN 'SKIPPED' ELSE 'CONSISTENT' END AS state, count(*) AS records FROM p WHERE action <> 'DELETE' GROUP BY ALL")
def post_repair_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciling the repaired view finds nothing in scope."""
    fix, base, joined = _repair(spark, sf_dir)
    r, after = fix.r, fix.repaired(joined, fix.delete_plan(joined, base))
    spec = TableSpec.of(after, KEYS, "repaired", **after_repair(r.view))
    again = type(r)(r.base, spec, START, END)
    return again.labels(base, after).groupBy("state").agg(F.count("*").alias("records"))



# Whole runs, and what they write

#: A run that repairs no inconsistent record, meets a base that has gained some orphans, and a writer that refuses some keys.
_APPLIED = """, q AS (SELECT * REPLACE (CASE WHEN state = 'INCONSISTENT' THEN 'NONE' ELSE action END AS action), o_orderkey > 10000000 AND o_orderkey % 4 = 0 AS gained, o_orderkey % 10 = 0 AS refused FROM p),
o AS (SELECT *, CASE WHEN action = 'DELETE' THEN CASE WHEN gained THEN 'KEPT' WHEN refused THEN 'DELETE_ERROR' ELSE 'DELETED' END
                     WHEN action = 'UPSERT' THEN CASE WHEN refused THEN 'UPSERT_ERROR' ELSE 'UPSERTED' END END AS outcome FROM q)
"""


def _applied(spark: SparkSession, sf_dir: str):
    r, base, view, joined = _joined(spark, sf_dir)
    fix = Repairer(r, Settings(START, END, fix_missing=True, fix_orphans=True))
    joined = staged(joined, "joined", by="state")
    gained = view.filter("o_orderkey > 10000000 AND o_orderkey % 4 = 0").select(*KEYS)
    deletes = staged(fix.delete_plan(joined, base.select(*KEYS).unionByName(gained)), "deletes")
    refused = r.keyed(mutated(fix.upsert_plan(joined), r, _refuse, "shop")).unionByName(r.keyed(mutated(deletes, r, _refuse, "shop")))
    failed = r.flat(refused.groupBy("key").agg(F.min("error").alias("error")))
    return fix, joined, staged(fix.outcomes(joined, deletes, failed), "outcomes")


@_query(_JOINED + _APPLIED + _COUNTS)
def applied_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fifteen counters, from what a writer did and refused."""
    return job_stats(_applied(spark, sf_dir)[2])


@_query(_JOINED + _APPLIED + "SELECT o_custkey, o_orderkey, state, action, coalesce(outcome, 'none') AS outcome FROM o")
def applied_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fix, _, outcomes = _applied(spark, sf_dir)
    return fix.r.flat(outcomes).select(*KEYS, "state", "action", F.coalesce("outcome", F.lit("none")).alias("outcome"))


@_query(_JOINED + _APPLIED + """SELECT state AS category, count(*) AS blocks FROM o WHERE state NOT IN ('SKIPPED', 'CONSISTENT') GROUP BY state
UNION ALL SELECT CASE outcome WHEN 'DELETE_ERROR' THEN 'ERR_DELETING' ELSE 'ERR_UPSERTING' END, count(*) FROM o WHERE outcome IN ('DELETE_ERROR', 'UPSERT_ERROR') GROUP BY ALL""")
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings and errors as text files, a folder for each category, read back."""
    fix, joined, outcomes = _applied(spark, sf_dir)
    path = staged_path(spark, "report")
    report.text_sink(report.routed(report.blocks(fix.r.found(joined), fix.r), outcomes), path)
    return spark.read.text(path).groupBy("category").agg(F.count_if(F.col("value") == report.RULE).alias("blocks"))


def _run(spark: SparkSession, sf_dir: str, sink: report.Sink = report.text_sink) -> tuple[str, str, DataFrame]:
    """A run from settings over both tables as files, beside one that the read options leave out: its folder, line and view."""
    root = staged_path(spark, "run")
    base, view = drift(spark, sf_dir)
    for name, df in (("orders", base), ("orders_by_customer", view)):
        df.write.option("compression", "snappy").parquet(f"{root}/{name}")
        df.limit(5).write.mode("append").option("compression", "gzip").parquet(f"{root}/{name}")
    r = reconciler(base, view)
    given = {
        "start_seconds": str(START), "end_seconds": str(END), "base_table": f"{root}/orders", "view_table": f"{root}/orders_by_customer", "fix_missing": "true", "fix_orphans": "true", "fix_inconsistent": "true",
        "read_options": "pathGlobFilter=*.snappy.parquet", "repaired_table": f"{root}/repaired", "output_dir": f"{root}/out",
    }
    times = {c.name: c.write_time for c in r.base.cells if c.write_time}, {c.name: c.write_time for c in r.view.cells if c.write_time}
    ttl = {"o_totalprice": "price_ttl"}
    run = Run(Settings.from_mapping({f"viewrecon.{k}": v for k, v in given.items()}), KEYS, {"keys": ("o_orderkey",), "write_time": times[0], "ttl": ttl}, {"write_time": times[1], "ttl": ttl})
    line, _ = run(spark, sink)
    return root, line, spark.read.parquet(f"{root}/repaired")


@_query(_JOINED + _OUTCOMES + f"""SELECT concat_ws(', ', {", ".join(f"'{name}: ' || " + chr(34) + name + chr(34) for name in COUNTERS)}) AS line FROM ({_COUNTS})""")
def whole_run_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, line, _ = _run(spark, sf_dir)
    written = spark.read.text(f"{root}/out/stats")
    return written.filter(F.col("value") == line).select(F.col("value").alias("line"))


@_query(_JOINED + _OUTCOMES + _COUNTS)
def whole_run_statistics_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _, _ = _run(spark, sf_dir)
    return spark.read.schema(", ".join(f"{name} long" for name in COUNTERS)).json(f"{root}/out/stats-json")


@_query(_JOINED + _REPAIRED + "SELECT * FROM x")
def whole_run_repaired_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, repaired = _run(spark, sf_dir)
    return repaired.select(*KEYS, "o_orderpriority", "o_orderstatus", "o_totalprice", F.col("`writetime(o_totalprice)`").alias("price_written"))


@_query(_JOINED + "SELECT state AS category, count(*) AS blocks FROM p WHERE state NOT IN ('SKIPPED', 'CONSISTENT') GROUP BY state")
def custom_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink of the user's in place of the text files."""
    root, _, _ = _run(spark, sf_dir, lambda rows, path: rows.write.parquet(f"{path}-of-mine"))
    return spark.read.parquet(f"{root}/out/findings-of-mine").groupBy("category").agg(F.count("*").alias("blocks"))


@_query(_JOINED + "SELECT o_custkey, o_orderkey, state FROM j WHERE o_orderkey % 10 = 0")
def changed_key_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of changed keys, labelled batch by batch against fresh reads."""
    from viewrecon.streaming.batches import reconcile_changes

    base, view = drift(spark, sf_dir)
    r = reconciler(base, view)
    root = staged_path(spark, "changes")
    keys = base.select(*KEYS).unionByName(view.select(*KEYS)).filter("o_orderkey % 10 = 0")
    keys.write.parquet(f"{root}/in")
    changes = spark.readStream.schema(keys.schema).parquet(f"{root}/in")
    query = reconcile_changes(changes, r, lambda: base, lambda: view, lambda labels, batch: labels.write.mode("overwrite").parquet(f"{root}/out/{batch}"), f"{root}/checkpoint")
    query.awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").schema(r.labels(base, view).schema).parquet(f"{root}/out")


# Schemas


@_query("""SELECT * FROM (VALUES ('o_orderkey', 'key', 'BIGINT', 'none'), ('o_custkey', 'cell', 'BIGINT', 'wt'), ('o_orderpriority', 'cell', 'TEXT', 'wt'), ('o_orderstatus', 'cell', 'TEXT', 'wt'), ('o_tags', 'cell', 'LIST', 'none'), ('o_totalprice', 'cell', 'DOUBLE', 'wt')) AS t(name, part, kind, written)""")
def schema_of_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and cells as they are found in the table; metadata columns are neither."""
    base, view = drift(spark, sf_dir)
    spec = reconciler(base, view).base
    rows = [(c.name, part, c.kind, c.write_time or "none") for part, cells in (("key", spec.keys), ("cell", spec.cells)) for c in cells]
    return spark.createDataFrame(rows, "name string, part string, kind string, written string")


@_query("""SELECT * FROM (VALUES ('o_orderpriority'), ('o_tags'), ('o_totalprice')) AS t(name)""")
def columns_in_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with equal type and kind: a status held as bytes and a key are not."""
    base, view = drift(spark, sf_dir)
    meta = {"write_time": "wt", "ttl": "price_ttl"}
    other = TableSpec.of(view.withColumn("o_orderstatus", F.col("o_orderstatus").cast("binary")), KEYS, **meta)
    return spark.createDataFrame([(c,) for c in common_cells(TableSpec.of(base, ("o_orderkey",), **meta), other)], "name string")


@_query("""SELECT * FROM (VALUES (true, 'repair can''t write pair (TUPLE) of view'), (false, 'none')) AS t(writes, error)""")
def type_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A kind that can't be written stops a repair that writes cells, and no other."""
    _, view = drift(spark, sf_dir)
    spec = TableSpec.of(view.withColumn("pair", F.struct("o_orderkey", "o_custkey")), KEYS, "view")

    def error(writes: bool) -> str:
        try:
            check_repairable(spec, writes, writes)
        except ValueError as e:
            return str(e)
        return "none"

    return spark.createDataFrame([(w, error(w)) for w in (True, False)], "writes boolean, error string")


_compare("compare_struct", "struct(o_orderkey % 3 AS a, CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS b)", "struct(o_orderkey % 6 AS a, CASE WHEN o_orderkey % 4 = 0 THEN 1 END AS b)", "(o_orderkey % 3) IS DISTINCT FROM (o_orderkey % 6) OR (o_orderkey % 2 = 0) <> (o_orderkey % 4 = 0)")
_compare("compare_timestamp", "o_orderdate", "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + make_interval(0, 0, 0, 0, 0, 0, o_orderkey % 2) END", "o_orderkey % 5 = 0 OR o_orderkey % 2 = 1")
_compare("compare_nested", "array(map('x', array(o_orderkey % 3)), map('y', array(1)))", "array(map('x', array(o_orderkey % 2)), map('y', array(1)))", "(o_orderkey % 3) <> (o_orderkey % 2)")


@_query("""SELECT o_orderkey, '{a=' || (o_orderkey % 3) || ', b=7}' AS m, CASE o_orderkey % 3 WHEN 0 THEN '[0, 2]' WHEN 1 THEN '[1, 2]' ELSE '[2]' END AS s FROM orders""")
def collection_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps by key; sets in order and without repeats."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", "map('b', 7L, 'a', o_orderkey % 3) AS m", "array(2L, o_orderkey % 3, 2L) AS s")
    kinds = {"m": "MAP", "s": "SET"}
    return rows.select("o_orderkey", *(rendered(F.col(f.name), f.dataType, kinds[f.name]).alias(f.name) for f in rows.schema.fields[1:]))


@_query(_JOINED + _UPSERTS + """SELECT "column", CASE WHEN ttl IS NULL THEN 'NO_TIMESTAMP_TTL' ELSE 'TTL' END AS flavor, count(*) AS writes FROM w GROUP BY ALL""")
def latest_timestamp_flavors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes that take the time of the write carry no timestamp."""
    base, view = drift(spark, sf_dir)
    r = reconciler(base, view)
    fix = Repairer(r, Settings(START, END, fix_missing=True, fix_orphans=True, fix_inconsistent=True, use_latest_timestamp=True))
    return fix.upsert_plan(r.joined(base, view)).groupBy("column", "flavor").agg(F.count("*").alias("writes"))
