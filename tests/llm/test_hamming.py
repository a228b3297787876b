import random

from pyspark.sql import functions as F

from viewrecon.llm import hamming as h


def write(spark, rows, tmp_path):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def brute(rows, k=10):
    codes = [(i, [x is not None and (x != x or x > 0) for x in e]) for i, e, _ in rows if i is not None and e is not None and len(e) == 64]
    out = []
    for q, c in dict((i, c) for i, c in codes if i % 50 == 0).items():
        near = sorted((sum(a != b for a, b in zip(c, d, strict=True)), i) for i, d in codes)[:k]
        out += [(q, i, r + 1, dist) for r, (dist, i) in enumerate(near)]
    return sorted(out)


def test_oracle(spark, duck, sf_dir):
    mine = h.op9_topk_search(spark, sf_dir)
    names = sorted(mine.columns)
    got = sorted(tuple(r[c] for c in names) for r in mine.collect())
    assert got == sorted(duck.sql(f"SELECT {', '.join(names)} FROM ({h.OP9_SQL})").fetchall())


def test_hot_vector_ties_and_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    hot = [rng.uniform(-1, 1) for _ in range(64)]
    rows = [(i, hot, 0) for i in range(120)]
    for i in range(120, 260):
        e = list(hot)
        for _ in range(rng.randint(0, 20)):
            k = rng.randrange(64)
            e[k] = -e[k]
        rows.append((i, e, 1))
    rows += [(300, None, 0), (350, [1.0], 0), (None, hot, 0), (400, [float("nan")] * 64, 0), (401, [0.0] * 64, 0), (402, [None] * 64, 0)]
    got = sorted(map(tuple, h.op9_topk_search(spark, write(spark, rows, tmp_path)).collect()))
    assert got == brute(rows)


def test_fewer_rows_than_k_and_none(spark, tmp_path):
    rows = [(0, [1.0] * 64, 0), (1, [-1.0] * 64, 0)]
    assert sorted(map(tuple, h.op9_topk_search(spark, write(spark, rows, tmp_path)).collect())) == brute(rows)
    assert h.op9_topk_search(spark, write(spark, [], tmp_path)).count() == 0


def test_segments_cover_the_code():
    for n in (0, 1, 500, 60_000, 10**9):
        parts = h.segments(n)
        assert sum(b for _, b in parts) == 64 and [a for a, _ in parts] == [sum(b for _, b in parts[:i]) for i in range(len(parts))]
    assert [max(b for _, b in h.segments(4 << k)) for k in (20, 24, 30, 31, 32, 40)] == [16, 22, 22, 22, 32, 32]


def test_flips_are_all_and_once(spark):
    for bits, value in ((7, 93), (11, 0)):
        own = spark.createDataFrame([(5, 0, bits, value)], "q long, j int, bits int, value long")
        for radius in range(bits + 2):
            got = [r.value for r in h.flipped(own, radius).collect()]
            assert sorted(got) == [v for v in range(1 << bits) if (v ^ value).bit_count() == radius]


def test_no_nested_loop_and_other_columns(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("vec_id AS id", "1 AS q", "2 AS j", "3 AS distance", "embedding").withColumn("code", h.code_of(F.col("embedding")))
    plain = sorted(map(tuple, h.search(rows, rows.filter("id % 50 = 0")).collect()))
    assert plain == sorted(map(tuple, h.op9_topk_search(spark, sf_dir).collect()))
    own = rows.selectExpr("id AS q", "0 AS j", "64 AS bits", "code AS value")
    assert "NestedLoop" not in h.flipped(own, 3)._jdf.queryExecution().toString()


def test_probes_are_neither_rows_nor_broadcast(spark, tmp_path, monkeypatch):
    """Random codes need far probes, of which there are many more than codes; none of them becomes a row of a plan."""
    rng = random.Random(7)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)], 0) for i in range(3000)]
    written, plain = [], h.stage

    def stage(df, name):
        out = plain(df, name)
        if name == "found":
            written.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(h, "stage", stage)
    got = sorted(map(tuple, h.op9_topk_search(spark, write(spark, rows, tmp_path)).collect()))
    assert got == brute(rows)
    assert written and all("MapInArrow" in p and "Exchange" in p for p in written)


def test_parts_of_a_group_and_few_lookups(spark, tmp_path, monkeypatch):
    for name, value in (("PART", 20), ("PROBES", 64), ("CANDIDATES", 16), ("LOW", (2, 3))):
        monkeypatch.setattr(h, name, value)
    rng = random.Random(8)
    near = [rng.uniform(-1, 1) for _ in range(64)]
    rows = [(i, [x if rng.random() > 0.04 else -x for x in near], 0) for i in range(400)]
    rows += [(i, [rng.uniform(-1, 1) for _ in range(64)], 0) for i in range(400, 700)]
    assert sorted(map(tuple, h.op9_topk_search(spark, write(spark, rows, tmp_path)).collect())) == brute(rows)
