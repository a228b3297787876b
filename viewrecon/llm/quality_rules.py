"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Every rule looks at counts of one document and says good (+1), bad (-1) or nothing (0). The votes of all
documents are counted by pattern, at most ``3 ** len(RULES)`` patterns whatever the corpus, and
expectation-maximisation over those counts estimates how often each rule is right about good and about bad
documents. A document's posterior probability of being good is then a closed expression of its votes.

Defined results: null or empty text has no words and fails the base rules; repeated rows are judged one by
one and alike; an empty table gives an empty result; other columns pass through untouched, whatever their
names, except that ``judge`` puts its results in place of columns named like them, whatever their case.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrecon.llm.names import numbered, restored, without
from viewrecon.llm.scratch import stage
from viewrecon.llm.words import words

#: (name, expression, good below or at, bad above): votes good, abstains between, votes bad.
RULES = (
    ("symbols", "n_symbols / n_words", 0.02, 0.10),
    ("repeats", "n_repeat_words / n_words", 0.10, 0.30),
    ("dup_lines", "n_dup_lines / n_lines", 0.0, 0.20),
    ("upper", "n_upper / word_chars", 0.10, 0.40),
    ("letters", "1 - n_letters / word_chars", 0.10, 0.25),
    ("bangs", "n_bangs / n_words", 0.05, 0.30),
    ("word_length", "abs(word_chars / n_words - 6)", 2.5, 5.0),
    ("length", "100 / n_words", 1.0, 2.0),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_letters", "n_bangs")
RESULTS = (*BASE, *EXTRA, "base_failed", "posterior", "kept")


def _vote(name: str) -> str:
    return f"_vote_{name}"


def count_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts in BASE and EXTRA (all long), which replace columns of their names. Work is done inside the row: no shuffle."""
    named, names = numbered(docs)
    counted = _counted(named, names[text])
    return counted.select(*(F.col(names[c]).alias(c) for c in without(docs.columns, [*BASE, *EXTRA])), *BASE, *EXTRA)


def _counted(docs: DataFrame, text: str) -> DataFrame:
    """docs: columns as ``numbered`` names them."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_w", words(t)).withColumn("_l", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("_n", F.size("_w")).withColumn("_joined", F.array_join("_w", ""))
    kept = lambda pattern: F.char_length(F.regexp_replace("_joined", pattern, ""))
    word = lambda i: F.get("_w", i)
    tri = F.when(F.col("_n") >= 3, F.transform(F.sequence(F.lit(0), F.col("_n") - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))))
    df = df.select(
        *docs.columns,
        F.col("_n").cast("long").alias("n_words"),
        F.char_length("_joined").cast("long").alias("word_chars"),
        kept(r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_lines"),
        kept(r"\P{Lu}+").cast("long").alias("n_upper"),
        kept(r"\P{L}+").cast("long").alias("n_letters"),
        kept(r"[^!]+").cast("long").alias("n_bangs"),
        tri.alias("_tri"),
    )
    # Most texts repeat no window; the others sort (window, position) and measure what the repeated windows cover.
    df = df.withColumn("_s", F.when(F.size(F.array_distinct("_tri")) < F.size("_tri"), F.sort_array(F.transform("_tri", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, j: F.coalesce(F.get("_s", j)["h"] == x["h"], F.lit(False))
    df = df.withColumn("_p", F.sort_array(F.transform(F.filter("_s", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])))
    covered = F.aggregate(F.transform("_p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_p", j + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_tri", "_s", "_p")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def votes() -> list[Column]:
    return [F.expr(f"CASE WHEN n_words = 0 THEN 0 WHEN {e} <= {good} THEN 1 WHEN {e} > {bad} THEN -1 ELSE 0 END").cast("tinyint").alias(_vote(name)) for name, e, good, bad in RULES]


def fit(patterns: Iterable[tuple[tuple[int, ...], int]], rules: int = len(RULES), rounds: int = 200) -> dict:
    """EM over counted vote patterns: the share of good documents, and per rule how often a vote is 'bad' in either class.

    Beta priors say that rules seldom condemn good documents and often overlook bad ones; they fix which
    class is which and keep rules that never vote at their prior.
    """
    rows = [(tuple(v), n) for v, n in patterns]
    prior, wrong, right = 0.8, [0.02] * rules, [0.35] * rules
    before = None
    for _ in range(rounds):
        good = bad = 0.0
        voted = [[0.0, 0.0, 0.0, 0.0] for _ in range(rules)]  # bad votes and votes in good documents, then in bad ones
        total = 0.0
        for v, n in rows:
            odds = math.log(prior / (1 - prior)) + sum(_weight(x, wrong[r], right[r]) for r, x in enumerate(v))
            q = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            good, bad = good + n * q, bad + n * (1 - q)
            total += n * odds
            for r, x in enumerate(v):
                if x:
                    c = voted[r]
                    c[1] += n * q
                    c[3] += n * (1 - q)
                    if x < 0:
                        c[0] += n * q
                        c[2] += n * (1 - q)
        prior = (good + 8) / (good + bad + 10)
        wrong = [(c[0] + 1) / (c[1] + 50) for c in voted]
        right = [(c[2] + 7) / (c[3] + 20) for c in voted]
        if before is not None and abs(total - before) <= 1e-9 * (1 + abs(before)):
            break
        before = total
    return {"prior": prior, "bad_if_good": wrong, "bad_if_bad": right}


def _weight(vote: int, wrong: float, right: float) -> float:
    if not vote:
        return 0.0
    return math.log(wrong / right) if vote < 0 else math.log((1 - wrong) / (1 - right))


def posterior(model: dict) -> Column:
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for (name, *_), wrong, right in zip(RULES, model["bad_if_good"], model["bad_if_bad"], strict=True):
        c = F.col(_vote(name))
        odds = odds + F.when(c < 0, _weight(-1, wrong, right)).when(c > 0, _weight(1, wrong, right)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, text: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (its columns ``carry``, all by default) with the counts, ``base_failed``, ``posterior`` and ``kept``.

    One pass counts and votes and is written once; the pattern counts and the result both read that table.
    """
    carried = without(docs.columns if carry is None else carry, RESULTS)
    judged, names = _judged(docs, text, carried)
    return judged.select(*(F.col(names[c]).alias(c) for c in carried), *RESULTS)


def _judged(docs: DataFrame, text: str, carry: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """The columns ``carry`` as ``numbered`` names them, and RESULTS; the names."""
    named, names = numbered(docs)
    table = stage(_counted(named, names[text]).select(*(names[c] for c in carry), *BASE, *EXTRA, *votes()), "quality_rules")
    voted = [_vote(r[0]) for r in RULES]
    counts = table.filter(~base_failed()).groupBy(*voted).count().collect()  # 3 ** len(RULES) rows at most
    model = fit((tuple(r[n] for n in voted), r["count"]) for r in counts)
    judged = table.withColumn("base_failed", base_failed()).withColumn("posterior", posterior(model))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)).drop(*voted), names


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all its columns, whatever their names."""
    judged, names = _judged(docs, text, docs.columns)
    return restored(judged.filter("kept"), names)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs, carry=("doc_id",)).select("doc_id", *BASE, "base_failed", "kept", "posterior")


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can express of the rules: the base counts and the base verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_features(docs).select("doc_id", *BASE, base_failed().alias("base_failed"))


COUNTS_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
e AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) > 2),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM e),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY doc_id),
x AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls, coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM x
"""
