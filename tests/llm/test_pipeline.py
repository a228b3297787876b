import hashlib
import random

import corpus_pipeline
import public_tokenizers
import pytest
from helpers import ODD, linked, shingles

from viewrecon.llm import bpe
from viewrecon.llm.queries import ORACLES, QUERIES


def test_registered():
    import __spark_entry__

    known = __spark_entry__.queries()
    assert "pipeline" in known and [sum(q.startswith(f"op{n}_") for q in known) for n in range(1, 11)] == [1] * 10
    assert set(ORACLES) <= set(QUERIES)


def test_stages_on_a_small_corpus(spark, tmp_path):
    rng = random.Random(6)
    prose = lambda k: " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(k)) + "."
    shared = "This line is the same in a good many of these documents."
    rows = [(i, f"{prose(60)}\n{shared}\n{prose(60)}", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[0][1].replace("a", "b", i), "s1") for i in range(4)] + [(200 + i, "### $$$ " * 60, "s2") for i in range(6)]
    rows += [(300 + (i or 0), t, None) for i, t in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("doc_id", "text", "'en' AS lang", "source", "cast(length(text) as long) AS n_chars", "1 AS extra")
    seen = []
    for k, (name, work) in enumerate(corpus_pipeline.STAGES):
        work(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        assert out.columns == docs.columns or k == 4, name
        seen.append(out.collect())
        docs = out
    assert {r.doc_id for r in seen[0]} == {*range(60), *range(100, 104)}
    assert sum(shared in r.text for r in seen[1]) == 1 and len(seen[1]) == 64
    texts = [shingles(r.text) for r in seen[2]]
    kept = {r.doc_id for r in seen[2]}
    assert set(range(60)) <= kept and 100 not in kept and not any(linked(a, b) for i, a in enumerate(texts) for b in texts[:i])
    assert {r.doc_id for r in seen[3]} <= kept and all(len(r.ids) == r.n_tokens and "text" not in r for r in seen[4])
    assert len(seen[4]) == len(seen[3])


def test_last_stage_decodes(spark, tmp_path):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    name, work = corpus_pipeline.STAGES[-1]
    got = sorted(((r.doc_id or 0, r.decoded_sha256) for r in work(spark, docs, str(tmp_path)).collect()))
    assert name == "encoding" and got == sorted((i or 0, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD)
    codec = bpe.codec(public_tokenizers.path(bpe.VOCABULARY))
    texts = ["Größe 漢字 it's".encode(), b"cut \xf0\x9f off \xff"]
    for text, (ids, _) in zip(texts, codec.encode(texts), strict=True):
        assert codec.decode_checked(text, ids) == text.decode("utf-8", "replace").encode()
        with pytest.raises(ValueError, match="decode to other"):
            codec.decode_checked(text, ids[:-1])


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_encoding_gets_short_batches(spark, sf_dir, monkeypatch):
    """Workers of the last stage hold 1,000 texts at most, and the session keeps its setting."""
    import corpus_pipeline as p

    name, seen, plain = "spark.sql.execution.arrow.maxRecordsPerBatch", [], p.scratch.stage

    def stage(df, label):
        seen.append((label, int(spark.conf.get(name))))
        return plain(df, label)

    monkeypatch.setattr(p.scratch, "stage", stage)
    before = spark.conf.get(name)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert p.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
    assert seen == [("encoded", 1000)] and spark.conf.get(name) == before
