"""Line dedup across documents: lines that many documents share stay in one of them.

Keys of lines are hashed to 128 bits. Occurrences are first counted by hash and a salt taken from the
document, so that a line held by a third of all documents is many small groups; those partial counts are
range-partitioned by hash, sorted by hash and document, and streamed once: the first row of a hash names
the document that keeps the line. Lines that very many documents hold, a bounded number, are broadcast to
their occurrences, the rest meet theirs by a shuffle. Removals go back to the documents as row numbers, and every document gets
a run-length keep bitmap; texts take part only where a caller applies the bitmaps.

Defined results: a null or empty text is one empty line; lines shorter than ``min_chars`` always stay;
repeated lines within the keeping document all stay; rows that repeat a ``doc_id`` count as one document
(they are taken to hold the same text) and lose the same lines; a null ``doc_id`` is a document of its own
that never is the keeper unless no other holds the line; an empty table gives an empty result. Columns
beside ``doc_id`` and ``text`` pass through, whatever their names; ``n_chars`` is brought up to date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewrecon.llm.hot import join_counted
from viewrecon.llm.scratch import stage
from viewrecon.llm.words import LOWER, SPACE_CHARS, UPPER, lower_ascii

#: Parts that the documents of one hash are dealt into before they meet.
SALTS = 256
MIN_CHARS, MIN_DOCS = 40, 5


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, pos, h1, h2) of every line whose key is long enough."""
    exploded = docs.select("doc_id", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = exploded.select("doc_id", "pos", F.btrim("line", F.lit(SPACE_CHARS)).alias("key")).filter(F.char_length("key") >= min_chars)
    low = keyed.withColumn("key", lower_ascii(F.col("key")))
    return low.select("doc_id", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(40961), "key").alias("h2"))


def shared_lines(occ: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, keeper, docs) of the hashes that at least ``min_docs`` documents hold."""
    salted = occ.select("h1", "h2", "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    dealt = salted.repartition("h1", "h2", "salt")
    once = dealt.groupBy("h1", "h2", "salt", "doc_id").agg(F.lit(1).alias("one"))
    part = once.groupBy("h1", "h2", "salt").agg(F.count("one").alias("docs"), F.max("doc_id").alias("top"))
    stream = part.drop("salt").repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", F.desc("top"))
    run = Window.partitionBy("h1", "h2").orderBy(F.desc("top"))
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = stream.select("h1", "h2", F.col("top").alias("keeper"), F.row_number().over(run).alias("nth"), F.sum("docs").over(whole).alias("docs"))
    return first.filter((F.col("nth") == 1) & (F.col("docs") >= min_docs)).select("h1", "h2", "keeper", "docs")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, keep_runs) once for each ``doc_id``; ``keep_runs`` lists (start, length) of kept lines."""
    occ = stage(occurrences(docs, min_chars), "line_occurrences")
    shared = stage(shared_lines(occ, min_docs), "line_keepers")
    lost = join_counted(occ, shared, ["h1", "h2"], "docs").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gaps = lost.groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("gaps"))
    counts = docs.select("doc_id", F.size(lines_of(F.col("text"))).alias("n_lines")).groupBy("doc_id").agg(F.max("n_lines").alias("n_lines"))
    both = counts.alias("c").join(gaps.alias("g"), F.col("c.doc_id").eqNullSafe(F.col("g.doc_id")), "left").select("c.doc_id", "n_lines", F.coalesce("gaps", F.expr("cast(array() as array<int>)")).alias("gaps"))
    start = lambda i: F.coalesce(F.get("gaps", i - 1) + 1, F.lit(0))
    end = lambda i: F.coalesce(F.get("gaps", i), F.col("n_lines"))
    runs = F.filter(F.transform(F.sequence(F.lit(0), F.size("gaps")), lambda i: F.struct(start(i).alias("start"), (end(i) - start(i)).alias("length"))), lambda r: r["length"] > 0)
    return both.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("gaps").cast("long").alias("n_dropped"), runs.alias("keep_runs"))


def kept_text(text: Column, n_dropped: Column, keep_runs: Column) -> Column:
    # The text is split once, as the only element of an array; the runs are cut from that element.
    cut = lambda lines: F.array_join(F.flatten(F.transform(keep_runs, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")
    kept = F.get(F.transform(F.array(lines_of(text)), cut), F.lit(0))
    return F.when(n_dropped > 0, kept).otherwise(F.coalesce(text, F.lit("")))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the lines removed from ``text``; all its columns and rows stay, a null text stays null.

    A column ``n_chars`` is brought up to date.
    """
    bitmaps = keep_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs).filter("n_dropped > 0")
    joined = docs.alias("d").join(bitmaps.alias("b"), F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")), "left")
    text = F.when(F.col("b.n_dropped") > 0, kept_text(F.col("d.text"), F.col("b.n_dropped"), F.col("b.keep_runs"))).otherwise(F.col("d.text"))
    out = joined.select(*(text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bitmaps = keep_bitmaps(docs)
    joined = docs.alias("d").join(bitmaps.alias("b"), F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")))
    text = kept_text(F.col("d.text"), F.col("n_dropped"), F.col("keep_runs"))
    return joined.select("d.doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


OP5_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
m AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.keeper AS lost FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
