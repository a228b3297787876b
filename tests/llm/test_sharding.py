import hashlib
from collections import Counter

import pytest
from helpers import ODD, odd_docs

from viewrecon.llm import sharding as s


def brute(names, slots):
    """Turn by turn, each shard takes the first free slot of its whole preference list."""
    lists = []
    for n in names:
        h = hashlib.md5(n.encode()).hexdigest()
        offset, skip = int(h[:15], 16) % slots, int(h[16:31], 16) % (slots - 1) + 1
        lists.append([(offset + j * skip) % slots for j in range(slots)])
    table = {}
    while len(table) < slots:
        for i, order in enumerate(lists):
            if len(table) < slots:
                table[next(x for x in order if x not in table)] = i
    return [table[i] for i in range(slots)]


def test_table_against_brute_force():
    names = [f"n{i}" for i in range(7)]
    assert s.fill_table(names, 101) == brute(names, 101)


def test_balance_and_small_change():
    names = [f"n{i}" for i in range(20)]
    before, after = s.fill_table(names, 10_007), s.fill_table(names[:-1], 10_007)
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 19)
    assert moved < 0.15 * 10_007


def test_bad_parameters():
    for names, slots in ((["a", "a"], 7), ([], 7), (["a"], 10)):
        with pytest.raises(ValueError):
            s.fill_table(names, slots)


def test_placement(spark, sf_dir):
    rows = s.op4_sharding(spark, sf_dir).collect()
    table = s.fill_table()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % s.SLOTS
        assert (r.slot, r.shard) == (slot, s.SHARDS[table[slot]])


def test_odd_rows_native_and_files(spark, tmp_path):
    docs = odd_docs(spark).selectExpr("*", "'x' AS slot", "0 AS at")
    out = s.place(docs)
    assert out.count() == len(ODD) and out.columns == ["doc_id", "text", "at", "slot", "shard"]
    docs.write.parquet(f"{tmp_path}/docs")
    plan = s.place(spark.read.parquet(f"{tmp_path}/docs"))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "ExistingRDD" not in plan
    assert s.place(docs.limit(0)).count() == 0
    s.write_shards(docs, f"{tmp_path}/shards", shards=("a", "b"), slots=101)
    assert spark.read.parquet(f"{tmp_path}/shards").count() == len(ODD)
