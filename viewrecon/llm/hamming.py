"""Exact top-k search among binary codes by incremental multi-index hashing.

A vector's code has one bit for each of its 64 dimensions, its sign. Codes are cut into segments so long that a
few codes share a value, about log2 of their number, and an index lists codes by segment value. Queries probe, segment by segment, all
values within a radius that grows by one each round; candidates are verified by their whole distance. After
radius r in all m segments no code nearer than m * (r + 1) is unseen, so a query is done when its kth
verified distance is below that; only the others go on, and only to as many segments as their kth distance
leaves open. Rows with equal codes are one code with its k smallest ids, so a vector that a third of all rows
share is one entry.

A group of the index, which one task holds, has the codes that share a segment's high bits, in parts of a bounded
size. A query is sent once to each group that its flips of high bits reach; flips of the low bits are looked up
there, so neither probes nor candidates are rows. A code is found in the first of its segments nearest to the
query's and nowhere else, so nothing is found twice, and a task returns a query's k nearest at most. Only the
list of groups is broadcast by a hint.

Defined results: neighbours are ordered by distance, then id; a query row is its own neighbour where it is
among the rows; rows with a null, short or long vector, or a null id, have no code and are left out; a null or
NaN component counts as not above zero and above zero; with fewer than k rows all are returned; columns
beside id and code are neither read nor returned, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewrecon.llm.scratch import stage

DIMENSIONS, K = 64, 10
#: Bits of a segment, at least.
LEAST_BITS = 7
#: Codes that share a segment's value, about: a few more of them cost less than the probes of longer segments.
LOAD = 4
#: Low bits of a segment, which are flipped inside a group, at least and at most; high bits, where neither bound holds.
LOW, HIGH = (8, 14), 8
#: Codes of a group's part, about; lookups and candidates that a task has at hand.
PART, PROBES, CANDIDATES = 1 << 17, 1 << 18, 1 << 20


def code_of(vector: Column) -> Column:
    """64 signs as a long; null unless there are 64 components."""
    bits = F.aggregate(vector, F.lit(0).cast("long"), lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")))
    return F.when(F.size(vector) == DIMENSIONS, bits)


def segments(codes: int) -> list[tuple[int, int]]:
    """(shift, bits) of the segments for so many codes."""
    bits = min(DIMENSIONS, max(LEAST_BITS, math.ceil(math.log2(max(2, codes / LOAD)))))
    m = math.ceil(DIMENSIONS / bits)
    ends = [DIMENSIONS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _cut(code: str, parts: list[tuple[int, int]]) -> Column:
    return F.explode(F.array(*(F.struct(F.lit(j).alias("j"), F.lit(bits).alias("bits"), F.shiftrightunsigned(F.col(code), shift).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1)).alias("value")) for j, (shift, bits) in enumerate(parts))))


def low_bits(parts: list[tuple[int, int]]) -> int:
    """Of each segment so many bits are flipped inside a group."""
    least = min(bits for _, bits in parts)
    return min(least, max(LOW[0], least - HIGH), LOW[1])


def flipped(own: DataFrame, radius: int) -> DataFrame:
    """own: (q, j, bits, value) and more. All but ``bits``, with every value that differs in exactly ``radius`` of the bits, once each.

    The bits to flip are counted down, one explode for each, inside the row: no table of masks, however long a segment.
    """
    rest = [c for c in own.columns if c not in ("bits", "value")]
    rows = own.select(*rest, "value", F.col("bits").alias("above"))
    for _ in range(radius):
        rows = rows.filter("above > 0").select(*rest, "value", F.explode(F.expr("sequence(0, above - 1)")).alias("above"))
        rows = rows.withColumn("value", F.expr("value ^ shiftleft(1L, above)"))
    return rows.select(*rest, "value")


def _high(code: str, parts: list[tuple[int, int]], low: int) -> Column:
    """(j, bits, value) of each segment's high bits."""
    return _cut(code, [(shift + low, bits - low) for shift, bits in parts])


@cache
def _masks(bits: int, radius: int) -> np.ndarray:
    every = np.arange(1 << bits, dtype=np.int64)
    return every[np.bitwise_count(every) == radius]


class _Group:
    """Codes of one part of a group, in the order of their smallest ids."""

    def __init__(self, codes: np.ndarray, firsts: pa.Array, n: np.ndarray, shift: int, low: int):
        self.firsts, self.n, self.shift, self.low = firsts, n, np.uint64(shift), low
        value = self.value(codes)
        self.order = np.argsort(value, kind="stable")
        self.codes = codes[self.order]
        self.begin = np.searchsorted(value[self.order], np.arange((1 << low) + 1))

    def value(self, codes: np.ndarray) -> np.ndarray:
        return ((codes >> self.shift) & np.uint64((1 << self.low) - 1)).astype(np.int64)

    def candidates(self, queries: np.ndarray, flips: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, code), as places, of all whose low bits differ in exactly ``flips``. A query's are in one piece."""
        masks = _masks(self.low, flips)
        step = max(1, PROBES // max(1, len(masks)))
        for at in range(0, len(queries), step):
            probes = self.value(queries[at : at + step])[:, None] ^ masks
            begin, end = self.begin[probes], self.begin[probes + 1]
            until = np.cumsum((end - begin).sum(axis=1))
            i = 0
            while i < len(until):
                before = until[i - 1] if i else 0
                k = max(i + 1, int(np.searchsorted(until, before + CANDIDATES, "right")))
                size = (end[i:k] - begin[i:k]).ravel()
                skipped = np.repeat(begin[i:k].ravel() - (np.cumsum(size) - size), size)
                yield np.repeat(np.arange(at + i, at + k), np.diff(until[i:k], prepend=before)), skipped + np.arange(len(skipped))
                i = k


def _nearest(group: _Group, j: int, parts: list[tuple[int, int]], radius: int, k: int, queries: np.ndarray, flips: int, bound: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(query, code, place of the code, distance): each query's k nearest that segment j is the first to find, at this radius."""
    for who, at in group.candidates(queries, flips):
        x = queries[who] ^ group.codes[at]
        distance = np.bitwise_count(x).astype(np.int64)
        keep = np.flatnonzero(distance <= bound[who])
        who, at, x, distance = who[keep], at[keep], x[keep], distance[keep]
        found = np.ones(len(x), bool)
        for i, (shift, bits) in enumerate(parts):
            if i != j:
                found &= np.bitwise_count((x >> np.uint64(shift)) & np.uint64((1 << bits) - 1)) >= radius + (i < j)
        who, at, distance = who[found], at[found], distance[found]
        place = group.order[at]
        near = np.lexsort((place, distance, who))
        who, at, place, distance = who[near], at[near], place[near], distance[near]
        keep = np.arange(len(who)) - np.searchsorted(who, who) < k
        yield queries[who[keep]], group.codes[at[keep]], place[keep], distance[keep]


def _prober(parts: list[tuple[int, int]], low: int, radius: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a part follow each other, its codes in order, then its queries."""
        key, held, group = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("j", "value", "part", "role", "flips")])
            codes, n, bound = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("code", "n", "bound"))
            codes = codes.astype(np.int64).view(np.uint64)
            edges = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                own = tuple(marks[:3, a].tolist())
                if own != key:
                    key, held, group = own, [], None
                if marks[3, a] == 0:
                    held.append((codes[a:b], batch.column("first").slice(a, b - a), n[a:b]))
                    continue
                if not held:
                    continue
                if group is None:
                    group = _Group(np.concatenate([h[0] for h in held]), pa.concat_arrays([h[1] for h in held]), np.concatenate([h[2] for h in held]), parts[own[0]][0], low)
                for q, code, place, distance in _nearest(group, own[0], parts, radius, k, codes[a:b], int(marks[4, a]), bound[a:b]):
                    yield pa.RecordBatch.from_arrays([pa.array(q.view(np.int64)), pa.array(code.view(np.int64)), pa.array(group.n[place]), group.firsts.take(pa.array(place)), pa.array(distance.astype(np.int32))], ["q", "code", "n", "first", "distance"])

    return run


def search(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """rows, queries: (id, code). Returns (id, neighbor_id, rank, distance), at most k rows for each query."""
    smallest = Window.partitionBy("code").orderBy("id")
    items = rows.filter("id IS NOT NULL AND code IS NOT NULL").withColumn("nth", F.row_number().over(smallest)).filter(F.col("nth") <= k)
    items = stage(items.select("code", "id"), "codes")
    codes = stage(items.groupBy("code").agg(F.count("*").alias("n"), F.min("id").alias("first")), "codes")
    parts = segments(codes.count())
    m, low, widest = len(parts), low_bits(parts), max(bits for _, bits in parts)
    index = codes.select("code", "n", "first", _high("code", parts, low).alias("s")).select("s.j", "s.value", "code", "n", "first")
    sizes = F.broadcast(stage(index.groupBy("j", "value").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")), "groups"))
    dealt = index.join(sizes, ["j", "value"]).withColumn("part", F.pmod(F.xxhash64("code"), F.col("parts")).cast("int"))
    index = stage(dealt.select("j", "value", "part", F.lit(0).alias("role"), F.lit(0).alias("flips"), "code", "n", "first", F.lit(0).alias("bound")), "index")
    asked = stage(queries.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct(), "asked")
    active = asked.select(F.col("code").alias("q"), F.lit(DIMENSIONS).alias("bound")).distinct()
    kind = codes.schema["first"].dataType
    found, done = None, None
    for radius in range(widest + 1):
        # Codes unseen after this radius in the first i segments are m * radius + i away at least.
        own = active.select("q", "bound", _high("q", parts, low).alias("s")).select("q", "bound", "s.j", "s.bits", "s.value").filter(F.col("j") <= F.col("bound") - m * radius)
        sent = None
        for high in range(max(0, radius - low), radius + 1):
            some = flipped(own, high).withColumn("flips", F.lit(radius - high))
            sent = some if sent is None else sent.unionByName(some)
        sent = sent.join(sizes, ["j", "value"]).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        sent = sent.select("j", "value", "part", F.lit(1).alias("role"), "flips", F.col("q").alias("code"), F.lit(0).cast("long").alias("n"), F.lit(None).cast(kind).alias("first"), "bound")
        key = ["j", "value", "part"]
        met = index.unionByName(sent).repartition(*key).sortWithinPartitions(*key, "role", "flips", "first", "code")
        seen = met.mapInArrow(_prober(parts, low, radius, k), f"q long, code long, n long, first {kind.simpleString()}, distance int")
        if found is not None:
            seen = seen.unionByName(found.join(active, "q", "left_semi"))
        # The k nearest rows belong to the k codes first by distance and smallest id.
        near = Window.partitionBy("q").orderBy("distance", "first", "code")
        found = stage(seen.withColumn("nth", F.row_number().over(near)).filter(F.col("nth") <= k).drop("nth"), "found")
        so_far = Window.partitionBy("q").orderBy("distance").rangeBetween(Window.unboundedPreceding, 0)
        reached = found.withColumn("rows", F.sum("n").over(so_far)).filter(F.col("rows") >= k).groupBy("q").agg(F.min("distance").alias("kth"))
        reached = active.join(reached, "q", "left").select("q", F.coalesce("kth", F.lit(DIMENSIONS)).alias("bound"))
        reached = stage(reached, "reached")
        covered = F.col("bound") < m * (radius + 1) if radius < widest else F.lit(True)
        closed = stage(found.join(reached.filter(covered), "q", "left_semi"), "answers")
        done = closed if done is None else done.unionByName(closed)
        active = reached.filter(~covered)
        if active.isEmpty():
            break
    hits = asked.withColumnRenamed("code", "q").join(done, "q").join(items.select("code", F.col("id").alias("neighbor_id")), "code")
    rank = Window.partitionBy("id").orderBy("distance", "neighbor_id")
    ranked = hits.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return ranked.select("id", "neighbor_id", "rank", "distance")


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), code_of(F.col("embedding")).alias("code"))
    return search(rows, rows.filter(F.col("id") % 50 == 0)).withColumnRenamed("id", "vec_id")


OP9_SQL = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings WHERE len(embedding) = {DIMENSIONS}),
p AS (SELECT q.vec_id, e.vec_id AS neighbor_id, len(list_filter(list_zip(q.bits, e.bits), lambda x: x[1] <> x[2])) AS distance
      FROM e AS q, e WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank FROM p)
SELECT vec_id, neighbor_id, CAST(rank AS INTEGER) AS rank, CAST(distance AS INTEGER) AS distance FROM r WHERE rank <= {K}
"""
