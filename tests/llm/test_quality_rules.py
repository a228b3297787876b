import pytest
from helpers import ODD, WORD, odd_docs

from viewrecon.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows, covered = {}, set()
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in windows.values():
        if len(at) > 1:
            covered.update(j for i in at for j in (i, i + 1, i + 2))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


TEXTS = ["a b c a b c", "a a a a", "a b a b a b", "x\ny\nx\n\n \nx", "a b c d a b c e f a b", "#* $ <p> | & %", *(t for _, t in ODD if t is None or len(t) < 200)]


def test_counts_against_brute_force(spark, sf_dir):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in q.count_features(docs).select("doc_id", *q.BASE).collect():
        assert tuple(r)[1:] == brute(texts[r.doc_id]), repr(texts[r.doc_id])[:200]


def test_verdicts_follow_labels(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = q.op10_quality_rules(spark, sf).collect()
    assert len(rows) == 1000
    right = [r.kept == bool(labels[r.doc_id]) for r in rows if r.doc_id in labels and not r.base_failed]
    assert sum(right) / len(right) > 0.97
    assert all(not r.kept for r in rows if r.base_failed)


def test_odd_rows_and_other_columns(spark):
    docs = odd_docs(spark).selectExpr("*", "'x' AS n_words", "doc_id AS posterior", "1 AS other")
    out = q.judge(docs)
    assert out.count() == len(ODD) and set(out.columns) >= {"other", "n_words", "kept"}
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns and {r.n_words for r in kept.collect()} <= {"x"}
    assert q.keep_good(docs.limit(0)).count() == 0


def test_expectation_maximisation_recovers_accuracies():
    patterns = []
    for vote in (1, -1):  # three rules; good documents are seldom condemned, bad ones by one rule each
        patterns.append(((vote, 1, 1), 900 if vote == 1 else 40))
    patterns += [((1, -1, 1), 40), ((1, 1, -1), 40), ((-1, -1, -1), 60), ((0, 0, 0), 10)]
    model = q.fit(patterns, 3)
    assert 0.75 < model["prior"] < 0.99
    assert all(a < b for a, b in zip(model["bad_if_good"], model["bad_if_bad"], strict=True))
    assert q.fit([], 3)["prior"] == pytest.approx(0.8)


def test_native(spark, sf_dir):
    plan = q.op10_quality_rules(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
