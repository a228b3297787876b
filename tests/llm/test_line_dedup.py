import hashlib
import time

from helpers import SPACE, lower, odd_docs
from pyspark.sql import functions as F

from viewrecon.llm import line_dedup as d
from viewrecon.llm.hot import join_counted

LONG = "A line that is long enough to be a key, surely."


def brute(rows, min_chars=40, min_docs=5):
    key = lambda x: lower(x.strip(SPACE))
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(holders.get(key(x), ())) < min_docs or i == max(holders[key(x)], key=lambda v: (v is not None, v))]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=str)


def mine(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in d.op5_line_dedup(spark, str(tmp_path)).collect()), key=str)


def test_oracle(spark, duck, sf_dir):
    got = sorted(map(tuple, d.op5_line_dedup(spark, sf_dir).collect()))
    assert got == sorted(duck.sql(d.OP5_SQL).fetchall())


def test_against_brute_force(spark, tmp_path):
    rows = [(i, f"own {i}\n \t{LONG.upper() if i % 2 else LONG}\r\n{LONG}\nshort") for i in range(1, 8)]
    rows += [(i, f"É{LONG}\nx") for i in range(8, 12)] + [(12, f"é{LONG}"), (13, LONG), (13, LONG), (14, None), (15, ""), (16, "\n")]
    rows += [(20 + i, "z" * 39 + "\n" + "y" * 40) for i in range(6)]
    assert mine(spark, rows, tmp_path) == brute(rows)
    assert [r[2] for r in mine(spark, rows, tmp_path) if r[0] == 1] == [2]


def test_null_ids_lose_shared_lines(spark, tmp_path):
    rows = [(i, LONG) for i in (1, 2, 3, 4, 5)] + [(None, LONG)]
    assert {r[0]: r[2] for r in mine(spark, rows, tmp_path)} == {None: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 0}


def test_keep_bitmaps_are_runs(spark):
    rows = [(i, f"{LONG}\na\nb\n{LONG}\nc") for i in range(5)]
    got = {r.doc_id: [tuple(x) for x in r.keep_runs] for r in d.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == [(1, 2), (4, 1)] and got[4] == [(0, 5)]


def test_drop_lines_keeps_rows_and_columns(spark):
    docs = odd_docs(spark).selectExpr("text", "doc_id", "cast(length(text) as long) AS n_chars", "1 AS n_lines", "2 AS key", "3 AS h1", "4 AS gaps")
    out = d.drop_lines(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))
    assert d.drop_lines(docs.limit(0)).count() == 0


def test_very_many_lines(spark):
    """The text is split once, however many runs of lines stay."""
    text = "\n".join(f"{LONG} {i // 2}" if i % 2 else f"own {i}" for i in range(40_000))
    docs = spark.createDataFrame([(i, text) for i in range(5)], "doc_id long, text string")
    began = time.monotonic()
    out = {r.doc_id: r.text for r in d.drop_lines(docs).collect()}
    assert time.monotonic() - began < 20
    assert out[4] == text and all(out[i] == "\n".join(f"own {k}" for k in range(0, 40_000, 2)) for i in range(4))


def test_hot_keys_and_others_meet_alike(spark):
    rows = spark.createDataFrame([(k if k else None, i) for k in range(12) for i in range(k * k + 1)], "k long, i long")
    keyed = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("m"))
    plain = sorted(map(str, join_counted(rows, keyed, ["k"], "n").collect()))
    assert len(plain) == rows.count() and sorted(map(str, join_counted(rows, keyed, ["k"], "n", parts=4).select("k", "i", "n", "m").collect())) == sorted(map(str, join_counted(rows, keyed, ["k"], "n").select("k", "i", "n", "m").collect()))
    assert join_counted(rows.limit(0), keyed.limit(0), ["k"], "n").count() == 0


def test_native(spark, sf_dir):
    plan = d.op5_line_dedup(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
