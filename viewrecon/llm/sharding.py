"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own, given by two digests of its
name. Shards take turns claiming their next free slot until the table is full, so all own nearly equally
many slots, and when a shard leaves, few slots of the others change hands. A row's slot is a digest of its
key modulo the table's size; the table, whose size is the parameter ``slots``, is broadcast.

Defined results: a null key is placed like the empty text; equal keys share a shard; an empty table gives
an empty result; other columns pass through, and columns named as the results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65537
SHARDS = tuple(f"shard-{i:05d}" for i in range(64))


def _digest(text: str, part: int) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[16 * part : 16 * part + 15], 16)


def fill_table(shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard in ``shards``, which must be distinct and no more than the slots."""
    if not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("shards must be distinct, at least one, and no more than the slots")
    if slots < 3 or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime of at least 3")
    at = [_digest(s, 0) % slots for s in shards]
    step = [_digest(s, 1) % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard): the filled table as ``slots`` rows."""
    filled = F.split(F.lit(",".join(map(str, fill_table(shards, slots)))), ",")
    names = F.array(*(F.lit(s) for s in shards))
    return spark.range(1).select(F.posexplode(filled).alias("slot", "at")).select("slot", F.element_at(names, F.col("at").cast("int") + 1).alias("shard"))


def place(df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; no row moves."""
    rest = [c for c in df.columns if c not in ("slot", "shard")]
    keyed = df.select(*rest, slot_of(F.col(key), slots).alias("slot"))
    return keyed.join(F.broadcast(table_frame(df.sparkSession, shards, slots)), "slot").select(*rest, "slot", "shard")


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> None:
    """One folder for each shard under ``path``; a shard's rows are dealt over several files by slot."""
    placed = place(df, key, shards, slots)
    placed.repartition("shard", F.col("slot") % 8).drop("slot").write.partitionBy("shard").parquet(path)


def op4_sql(shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> str:
    """The same placement in DuckDB's SQL, the filled table a list."""
    filled = ",".join(str(i) for i in fill_table(shards, slots))
    names = ",".join(f"'{s}'" for s in shards)
    digest = "substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)"
    return f"""WITH f AS (SELECT [{filled}] AS filled, [{names}] AS shards),
d AS (SELECT doc_id, CAST(CAST('0x' || {digest} AS BIGINT) % {slots} AS INTEGER) AS slot FROM documents)
SELECT doc_id, slot, shards[filled[slot + 1] + 1] AS shard FROM d, f"""


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return place(docs).select("doc_id", "slot", "shard")
