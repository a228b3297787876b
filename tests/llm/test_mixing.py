import math
from collections import defaultdict

import numpy as np
import pytest
from helpers import ODD, WORD, odd_docs

from viewrecon.llm import mixing as m
from viewrecon.llm.hot import join_counted


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Shares by weight; what exceeds the cap is shared again among the rest until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        weight = sum(w[s] for s in names if s not in full)
        got = {s: cap * sizes[s] if s in full else left * w[s] / weight for s in names}
        above = {s for s in names if s not in full and got[s] > cap * sizes[s]}
        if not above:
            return got
        full |= above


def write(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def check(rows, near=0.02):
    size, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        size[r.source] += r.size
        target[r.source] = r.target
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
    assert all(r.source_size == size[r.source] for r in rows)
    want = targets(dict(size))
    for s in size:
        assert target[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9)
        assert taken[s] == pytest.approx(want[s], rel=near, abs=3)


def test_real_sources(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    rows = m.op2_mixing(spark, sf).collect()
    assert len(rows) == 1000
    check(rows)
    words = {r.doc_id: len(WORD.findall(r.text or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(r["size"] == words[r.doc_id] for r in rows)
    again = m.op2_mixing(spark, sf).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_caps_null_source_and_equal_rows(spark, tmp_path):
    rows = [(i, "big", "w " * (i % 40 + 1)) for i in range(3000)]
    rows += [(10_000 + i, "tiny", "w w w") for i in range(20)] + [(20_000 + i, None, "w " * (5 + i % 7)) for i in range(300)]
    rows += [(5, "same", "a b c")] * 40 + [(30_000, "empty", ""), (30_001, "empty", None)]
    got = m.op2_mixing(spark, write(spark, rows, tmp_path)).collect()
    assert len(got) == len(rows)
    check(got, near=0.05)
    assert {r.taken for r in got if r.source == "tiny"} == {9}
    assert len({r.taken for r in got if r.source == "same"}) == 1


@pytest.mark.parametrize("parts", [4096, 2])
def test_reruns_agree_however_rows_are_dealt(spark, sf_dir, monkeypatch, parts):
    """Every column in every bit; with few sources broadcast and with most of them met by a shuffle."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    monkeypatch.setattr(m, "PARTS", parts)
    monkeypatch.setattr(m, "join_counted", lambda *a: join_counted(*a, parts=parts))
    seen = []
    for partitions, adaptive in ((4, "true"), (13, "false")):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        seen.append(sorted(map(repr, m.plan_mix(docs.repartition(partitions)).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert seen[0] == seen[1] and len(seen[0]) == docs.count()


def test_rates_solve_the_dual(spark, sf_dir):
    """Each rate is min(cap, exp(lambda * size / mean)) with one lambda a source, found here by bisection, that meets the target."""
    rows = m.plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        size = np.array([r["size"] for r in own], float)
        n = np.array([r.n_rows for r in own], float)
        mean = (size * n).sum() / n[size > 0].sum()
        rate = lambda lam: np.minimum(3.0, np.exp(np.minimum(lam * size / mean, math.log(3))))
        low, high = -1e4, 1e4
        for _ in range(200):
            lam = (low + high) / 2
            low, high = (lam, high) if (rate(lam) * size * n).sum() < own[0].target else (low, lam)
        got = np.array([r.rate for r in own])
        assert (got * size * n).sum() == pytest.approx(own[0].target, rel=1e-6)
        if own[0].target < 3 * own[0].source_size:
            assert got[size > 0] == pytest.approx(rate(lam)[size > 0], rel=1e-5, abs=1e-9)


def test_counted_off_in_chunks(spark):
    plan = spark.createDataFrame([(1, 1), (2, 10), (3, 11), (4, 21)], "doc_id long, n_rows long")
    assert {r.doc_id: r["count"] for r in m.planned_rows(plan, 10).groupBy("doc_id").count().collect()} == {1: 1, 2: 10, 3: 11, 4: 21}


def test_no_settling_is_an_error(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(m, "ROUNDS", 4)
    monkeypatch.setattr(m, "CLOSE", -1.0)
    with pytest.raises(RuntimeError, match="off by"):
        m.plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_water_filling_by_hand(spark):
    df = spark.createDataFrame([("a", 100), ("b", 1), (None, 50)], "source string, source_size long")
    got = {r.source: r.target for r in m._targets(df, (1, 2, 3), 3).collect()}
    assert got == pytest.approx(targets({"a": 100, "b": 1, None: 50}))


def test_mix_repeats_rows_and_keeps_columns(spark):
    docs = odd_docs(spark).selectExpr("*", "case when doc_id % 2 = 0 then 'a' when doc_id < 5 then 'b' end AS source", "0 AS size", "1 AS copies", "2 AS n", "3 AS target")
    out = m.mix(docs)
    assert out.columns == docs.columns
    plan = {(r.doc_id, r.source): (r.copies, r.n_rows) for r in m.plan_mix(docs).collect()}
    assert out.count() == sum(c * n for c, n in plan.values()) and sum(n for _, n in plan.values()) == len(ODD)
    assert m.mix(docs.limit(0)).count() == 0


def test_native(spark, sf_dir):
    plan = m.op2_mixing(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
