"""A base table and a drifted view of it, derived from ``orders``, in Spark SQL and in the oracle's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewrecon.operators.reconcile import Reconciler
from viewrecon.plans.schema import TableSpec
from viewrecon.plans.settings import Settings

START, END = 820454400, 978307200
#: A shift of write times by 365 days.
SHIFT = 31_536_000_000_000
KEYS = ("o_custkey", "o_orderkey")

_MICROS = {"spark": "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', o_orderdate)", "duckdb": "epoch_us(o_orderdate)"}
_SPLIT = {"spark": "split(o_orderpriority, '-')", "duckdb": "string_split(o_orderpriority, '-')"}


def ctes(dialect: str) -> str:
    """``base`` and ``mv``. Cells: o_orderpriority, o_orderstatus, o_tags (a list without write time), o_totalprice (with a ttl on every seventh order)."""
    return f"""
base AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, {_SPLIT[dialect]} AS o_tags,
         {_MICROS[dialect]} AS wt, CASE WHEN o_orderkey % 7 = 0 THEN 3600 END AS price_ttl
  FROM orders),
mv AS (
  SELECT o_custkey + CASE WHEN o_orderkey % 103 = 0 THEN 1 ELSE 0 END AS o_custkey, o_orderkey,
         CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice + CASE WHEN o_orderkey % 89 = 0 THEN 1 ELSE 0 END AS o_totalprice, o_orderpriority, o_tags,
         wt + CASE WHEN o_orderkey % 89 = 0 THEN {SHIFT} ELSE 0 END AS wt, price_ttl
  FROM base WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT o_custkey, o_orderkey + 10000000, o_orderstatus, o_totalprice, o_orderpriority, o_tags, wt, price_ttl
  FROM base WHERE o_orderkey % 101 = 0)"""


def drift(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return tuple(spark.sql(f"WITH {ctes('spark').replace('FROM orders', 'FROM {orders}')} SELECT * FROM {t}", orders=orders) for t in ("base", "mv"))


def reconciler(base: DataFrame, view: DataFrame, start: int = START, end: int = END, unique: bool = True) -> Reconciler:
    times = {c: "wt" for c in ("o_orderstatus", "o_totalprice", "o_orderpriority")}
    ttl = {"o_totalprice": "price_ttl"}
    b = TableSpec.of(base, ("o_orderkey",), "orders", write_time=times | {"o_custkey": "wt"}, ttl=ttl)
    return Reconciler(b, TableSpec.of(view, KEYS, "orders_by_customer", write_time=times, ttl=ttl), start, end, unique)


def repair_settings() -> Settings:
    return Settings(START, END, fix_missing=True, fix_orphans=True, fix_inconsistent=True)
