"""Bounded samples of labelled documents, to fit a classifier on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(modulus: int) -> Column:
    """crc32 of the document's id as text, modulo ``modulus``; a null id is fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)), F.lit(0))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, training: Column, most: int, max_bytes: int) -> list[tuple[str, int]]:
    """Up to ``most`` texts of each class, the first in a random but fixed order of ids, none above ``max_bytes``.

    ``training`` says by ``doc_id`` which rows may be learned from. The ids drawn are at most ``2 * most``, and of
    rows that repeat an id one text counts, the first in order, so their broadcast and what reaches the driver
    are bounded whatever the corpus.
    """
    drawn = None
    for value in (0, 1):
        of = labels.filter(training & (F.col(label) == value)).groupBy("doc_id").agg(F.max(label).alias("label"))
        part = of.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        drawn = part if drawn is None else drawn.unionByName(part)
    rows = docs.select("doc_id", "text").filter(F.octet_length("text") <= max_bytes).join(F.broadcast(drawn), "doc_id")
    once = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return [(r["text"], r["label"]) for r in sorted(once.collect(), key=lambda r: r["doc_id"])]
