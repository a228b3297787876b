"""From raw documents to token ids: quality rules, line dedup, near dedup, mixing, encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's ``docs``. A stage works on all that its predecessor
kept. All but the last return the columns of ``documents``, whatever else those are called; the last returns
ids and offsets in place of text, and the digest of what the ids decode to, which must be the text.

A stage's result is lazy and reads tables that the stage wrote to the shared folder; these go when the next
stage begins, so write a result before calling the next stage, as ``run`` does.

Defined results: an empty table passes through all stages as one. Null, empty and word-free texts fail the base
rules and go in the first stage. A null ``doc_id`` is a document of its own: rows that have one are judged, lose
lines that others share, and never count as near duplicates. Rows that repeat a ``doc_id`` lose the same lines,
and one of them is left by near dedup. A null source is a source. Texts of any length are read whole. Ties are
settled by the smallest ``doc_id`` (near dedup), the largest (line dedup) and hashes of it (mixing). Columns
beside those of ``documents`` pass through all stages, whatever they are called, but for those that the last
stage returns: ``ids``, ``offsets``, ``decoded_sha256`` and ``n_tokens``, which replace their namesakes, and
``n_chars``, which line dedup keeps up to date.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrecon.llm import bpe, line_dedup, mixing, near_dedup, quality_rules, scratch

_left: list[str] = []


def _stage(work: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            scratch.drop(spark, _left.pop())
        with scratch.record() as made:
            out = work(docs)
        _left.extend(made)
        return out

    return stage


def _encode(docs: DataFrame) -> DataFrame:
    # Executors still hold what the stages before needed: texts go to the workers in short batches, so it is done here.
    with scratch.short_batches(docs.sparkSession):
        encoded = scratch.stage(bpe.encode_checked(docs, public_tokenizers.path(bpe.VOCABULARY)), "encoded")
    return encoded.withColumn("n_tokens", F.size("ids").cast("long")).drop("text")


STAGES = [
    ("quality_rules", _stage(quality_rules.keep_good)),
    ("line_dedup", _stage(line_dedup.drop_lines)),
    ("near_dedup", _stage(near_dedup.drop_near_duplicates)),
    ("mixing", _stage(mixing.mix)),
    ("encoding", _stage(_encode)),
]

#: SQL can express neither the fitted rules nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, work in STAGES[:-1]:
        with scratch.record() as made:
            docs = scratch.stage(work(spark, docs, sf_dir), f"pipeline_{name}")
        if before:
            scratch.drop(spark, before)
        before = made[-1]
    return STAGES[-1][1](spark, docs, sf_dir)
