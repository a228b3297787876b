"""Mixing sources to target weights by entropy balancing.

Sizes are word counts. Targets share the corpus by weights, none above ``cap`` times its source. The rates
nearest to one in relative entropy that meet a source's token target and stay below the cap are
``min(cap, exp(lambda * size / mean))``; ``lambda`` solves the convex dual by Newton steps, kept inside a
bracket, on the counts of documents by source and size, whose sums are exact, so that reruns agree in every
bit, however the rows are dealt; a source that does not settle is an error. Rates become whole copies by carrying the words
owed from document to document, largest first, within hash blocks of a few hundred documents of a source.

Defined results: null or empty text has size 0 and keeps one copy of no words; a null source is a source,
ordered last; rows equal in doc_id, source and size are decided together and get equally many copies; an
empty table gives an empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrecon.llm.hot import PARTS, join_counted
from viewrecon.llm.names import numbered, restored
from viewrecon.llm.running import running
from viewrecon.llm.scratch import stage
from viewrecon.llm.words import word_count

WEIGHTS = (1, 2, 3)
CAP = 3
#: Documents of a source that are rounded together, about.
BLOCK = 256
ROUNDS, ROUNDS_A_JOB, CLOSE = 64, 4, 1e-7
#: Words are summed in billionths, which add up alike in any order.
EXACT = "decimal(38,9)"


def _targets(sources: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Adds ``most``, the cap, and ``target``: the level at which weight times level, cut at the cap, shares all sizes. One row a source."""
    by_name = F.asc_nulls_last("source")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("nth") % len(weights) + 1).cast("int")).cast("long")
    df = running(sources, [by_name], {"nth": F.lit(1)}).withColumn("weight", weight).withColumn("most", F.lit(cap).cast("long") * F.col("source_size"))
    df = stage(df.withColumn("reach", F.col("most") / F.col("weight")), "mix_sources")
    total, weighs = df.agg(F.sum("source_size"), F.sum("weight")).first()
    rising = running(df, [F.col("reach"), by_name], {"spent": F.col("most"), "gone": F.col("weight")})
    # If the sources before this one get their caps, the others share the rest at this level; where it is within this one's reach it is at most the right one.
    level = (F.lit(total or 0) - F.col("spent")) / (F.lit(weighs or 0) - F.col("gone"))
    found = rising.select(level.alias("level"), "reach").filter("level <= reach").agg(F.max("level")).first()[0] or 0.0
    return df.withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * F.lit(found))).drop("weight", "reach", "nth")


def _rate(size: Column, cap: int) -> Column:
    tilted = F.exp(F.least(F.col("lam") * size / F.col("mean"), F.lit(math.log(cap))))
    return F.when(F.col("full"), F.lit(float(cap))).when(F.col("target") <= 0, F.lit(0.0)).otherwise(F.least(tilted, F.lit(float(cap))))


def _with_state(df: DataFrame, state: DataFrame, small: bool) -> DataFrame:
    """df: rows counted by source and size, or one row a source, so that no source has very many."""
    side = state.withColumnRenamed("source", "_source")
    return df.join(F.broadcast(side) if small else side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _newton(hist: DataFrame, state: DataFrame, small: bool, cap: int) -> DataFrame:
    """One Newton step on log(tokens) for every source at once."""
    rate, x = _rate(F.col("size"), cap), F.col("size") / F.col("mean")
    tokens = F.col("n") * F.col("size") * rate
    open_ = F.when(F.col("lam") * x < math.log(cap), tokens * x).otherwise(0.0)
    sums = _with_state(hist, state, small).groupBy("source").agg(*(F.sum(x.cast(EXACT)).cast("double").alias(name) for x, name in ((tokens, "h"), (open_, "dh"))))
    df = _with_state(sums, state, small)
    df = df.withColumn("gap", F.when(F.col("full") | (F.col("target") <= 0), F.lit(0.0)).otherwise(F.log("h") - F.log("target")))
    df = df.withColumn("lo", F.when(F.col("gap") < 0, F.col("lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(F.col("gap") > 0, F.col("lam")).otherwise(F.col("hi")))
    step = F.col("lam") - F.try_divide(F.col("gap") * F.col("h"), F.col("dh"))
    inside = (F.col("dh") > 0) & (step >= F.col("lo")) & (step <= F.col("hi"))
    moved = F.when(F.abs("gap") <= CLOSE, F.col("lam")).when(inside, step).otherwise((F.col("lo") + F.col("hi")) / 2)
    return df.withColumn("lam", moved).select(*state.columns[:-1], "gap")


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row for each distinct (doc_id, source, size): ``n_rows`` that it stands for, ``source_size``, ``target``, ``rate``, ``copies``."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    units = stage(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n_rows")), "mix_units")
    hist = stage(units.groupBy("source", "size").agg(F.sum("n_rows").alias("n"), F.count("*").alias("units")), "mix_sizes")
    tokens = F.sum(F.col("n") * F.col("size"))
    sources = hist.groupBy("source").agg(tokens.alias("source_size"), F.sum("units").alias("units"), F.try_divide(tokens, F.sum(F.when(F.col("size") > 0, F.col("n")))).alias("mean"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least_size"))
    state = _targets(sources, weights, cap)
    ratio = F.try_divide(F.col("target"), F.col("source_size"))
    state = state.select("source", "source_size", "units", "target", F.coalesce("mean", F.lit(1.0)).alias("mean"), (F.col("target") >= F.col("most")).alias("full"), F.coalesce(F.col("least_size") / F.col("mean"), F.lit(1.0)).alias("least"), ratio.alias("ratio"))
    state = state.withColumn("lam", F.lit(0.0)).withColumn("lo", F.when(F.col("ratio") < 1, F.log("ratio") / F.col("least")).otherwise(0.0)).withColumn("hi", F.when(F.col("ratio") > 1, F.lit(math.log(cap)) / F.col("least")).otherwise(0.0))
    state = stage(state.drop("least", "ratio").withColumn("gap", F.lit(1.0)), "mix_state")
    small = state.count() <= PARTS
    for _ in range(0, ROUNDS, ROUNDS_A_JOB):
        for _ in range(ROUNDS_A_JOB):
            state = _newton(hist, state, small, cap)
        state = stage(state, "mix_state")
        if (gap := state.agg(F.max(F.abs("gap"))).first()[0] or 0.0) <= CLOSE:
            break
    else:
        raise RuntimeError(f"after {ROUNDS} Newton steps a source's words are off by a factor of exp({gap})")
    rated = join_counted(units, state, ["source"], "units").withColumn("rate", _rate(F.col("size"), cap))
    blocks = F.ceil(F.col("units") / BLOCK).cast("long")
    rated = rated.withColumn("block", F.pmod(F.xxhash64(F.lit(7), "doc_id"), blocks))
    item = F.struct((-F.col("size")).alias("minus"), F.xxhash64(F.lit(11), "doc_id").alias("draw"), "doc_id", "size", "n_rows", "rate")
    dealt = rated.groupBy("source", "block").agg(F.sort_array(F.collect_list(item)).alias("items"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))

    def carry(acc: Column, x: Column) -> Column:
        words = (x["size"] * x["n_rows"]).cast("double")
        low = F.floor(x["rate"])
        owed = acc["owed"] + (x["rate"] - low) * words
        up = (x["rate"] > low) & (owed >= words / 2)
        return F.struct((owed - F.when(up, words).otherwise(0.0)).alias("owed"), F.concat(acc["copies"], F.array((low + up.cast("long")).cast("int"))).alias("copies"))

    start = F.struct(F.lit(0.0).alias("owed"), F.expr("cast(array() as array<int>)").alias("copies"))
    dealt = dealt.withColumn("copies", F.aggregate("items", start, carry)["copies"])
    rows = dealt.select("source", "source_size", "target", F.explode(F.arrays_zip("items", "copies")).alias("x"))
    return rows.select("x.items.doc_id", "source", "x.items.size", "x.items.n_rows", "source_size", "target", "x.items.rate", F.col("x.copies").alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it, 0 to ``cap`` times."""
    plan = plan_mix(docs, weights, cap).filter("copies > 0").select("doc_id", "source", "size", "copies")
    named, names = numbered(docs)
    sized = named.withColumn("words", word_count(F.col(names["text"])))
    same = F.col(names["doc_id"]).eqNullSafe(F.col("doc_id")) & F.col(names["source"]).eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    taken = sized.join(plan, same).select(*names.values(), F.explode(F.sequence(F.lit(1), "copies")))
    return restored(taken, names)


def planned_rows(plan: DataFrame, chunk: int = 4096) -> DataFrame:
    """``plan`` with as many rows as each of its rows stands for, counted off in chunks so that no array grows with their number."""
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_rows - 1) div {chunk}")))
    dealt = plan.withColumn("chunk", chunks)
    left = F.least(F.lit(chunk).cast("long"), F.col("n_rows") - F.col("chunk") * chunk)
    return dealt.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), left))).drop("chunk", "nth")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    plan = planned_rows(plan_mix(docs))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "source", "rate", "copies")


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can express of the mix: sizes and targets, in whole words."""
    return op2_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target").cast("long").alias("target_words"))


TARGETS_SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight FROM d GROUP BY source),
r AS (SELECT *, {CAP} * source_size / weight AS reach, sum(source_size) OVER () AS total,
             coalesce(sum({CAP} * source_size) OVER (ORDER BY {CAP} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
             sum(weight) OVER (ORDER BY {CAP} * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weighs FROM s),
l AS (SELECT max((total - spent) / weighs) AS level FROM r WHERE (total - spent) / weighs <= reach)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, CAST(round(least({CAP} * source_size, weight * level)) AS BIGINT) AS target_words
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, l
"""
