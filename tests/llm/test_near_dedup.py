import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD, linked, odd_docs, shingles
from pyspark.sql import functions as F

from viewrecon.llm import near_dedup as n
from viewrecon.llm.components import components
from viewrecon.llm.shingles import shingle_sets


def brute(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if find(a) != find(b) and linked(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def compare(spark, rows, **how):
    got = n.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id), r.doc_id


def words(rng, k):
    return ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(k)]


def test_groups_of_all_kinds(spark):
    """Copies, a crowd of copies edited more and less, a shared passage, pairs near the threshold, and chains."""
    rng = random.Random(5)
    rows, base, passage = [], words(rng, 150), words(rng, 90)
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = "".join(words(rng, 2))
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(words(rng, 120) + passage)) for i in range(60)]
    rows += [(200 + i, " ".join(base[:40])) for i in range(30)]
    for i in range(60):
        w = words(rng, 104)
        rows += [(300 + 2 * i, " ".join(w)), (301 + 2 * i, " ".join(w[: 104 - i % 30]))]
    w = words(rng, 200)
    rows += [(500 + i, " ".join(w[i * 10 : i * 10 + 100])) for i in range(10)]
    compare(spark, rows)


def crowd(rng, pairs):
    """Pairs of 0.75 to 0.80 similarity, all of which hold one passage, so that nodes are large and branch on."""
    passage, rows = words(rng, 70), []
    for i in range(pairs):
        w = passage + words(rng, 134)
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[: 204 - (39 + i % 12)]))]
    return rows


@pytest.mark.parametrize("how", [{}, {"levels": 1}, {"sift": 0}], ids=str)
def test_recall_near_the_threshold(spark, how):
    rows = crowd(random.Random(9), 150)
    want = brute(rows)
    got = {r.doc_id: r.component_id for r in n.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect()}
    linked_pairs = [i for i in range(150) if want[2 * i + 1][1] == 2 * i]
    assert len(linked_pairs) > 100 and all(got[i] in (i, want[i][1]) for i in got)
    assert sum(got[2 * i + 1] == 2 * i for i in linked_pairs) >= 0.99 * len(linked_pairs)


def test_first_choices_differ(spark):
    chosen = [j for t in range(1, n.TREES + 1) for j in spark.range(1).select(n._children(F.lit(t).cast("long"), 0)).first()[0]]
    assert len(chosen) == len(set(chosen)) == n.TREES + n.TREES // 3
    below = {level: {j for r in spark.range(200).select(n._children(F.xxhash64("id"), level).alias("c")).collect() for j in r.c} for level in range(1, 7)}
    assert all(len(below[a]) == n.CHOICE and not below[a] & (below[b] | set(chosen)) for a in below for b in below if a != b)


def test_the_session_keeps_its_setting(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "4321")
    n.near_duplicates(odd_docs(spark).limit(0)).count()
    assert spark.conf.get(name) == "4321"
    spark.conf.unset(name)


def test_real_table(spark, sf_dir):
    compare(spark, [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])


def test_odd_rows(spark):
    rows = [*(r for r in ODD if r[0] != 6), (20, "ONE two three four"), (21, "x y z"), (22, "X Y\nz"), (23, "word " * 29_000)]
    compare(spark, rows)
    docs = odd_docs(spark).selectExpr("*", "1 AS id", "2 AS n", "3 AS kept", "4 AS f1")
    out = n.drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert n.near_duplicates(docs.limit(0)).count() == 0 and n.drop_near_duplicates(docs.limit(0)).count() == 0


def test_shingles_against_brute_force():
    rng = random.Random(1)
    texts = [t for _, t in ODD] + [" ".join(rng.choice(["a", "B", "b", "ab", "é"]) for _ in range(rng.randint(0, 60))) + rng.choice(["", " ", "\n"]) for _ in range(300)]
    for t, s in zip(texts, shingle_sets(pa.array(texts)), strict=True):
        assert len(s) == len(shingles(t)) and (np.diff(s.astype(object)) > 0).all()
    same, other = list(shingle_sets(pa.array(["A b c d e", "a B\tc\nd  e"]))), list(shingle_sets(pa.array(["a b c d", "a b c", "ab c d e", "a bc d e"])))
    assert (same[0] == same[1]).all() and len({int(x[0]) for x in other}) == 4


def test_blocks_count_like_sets():
    rng = random.Random(3)
    pool = [np.unique(np.array(rng.sample(range(60), rng.randint(1, 40)), np.uint64)) for _ in range(40)]
    held = [(0, i, i, s) for i, s in enumerate(pool[:20])] + [(1, i, i, s) for i, s in enumerate(pool)]
    got = set(n._crossed(held))
    want = {(i, j) for i in range(20) for j in range(40) if i != j and linked(set(pool[i].tolist()), set(pool[j].tolist()))}
    assert got == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r.u: r.v for r in components(frame).collect()}
    assert got == {r.u: r.v for r in components(frame, one_task=10).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, **{x: 100 for x in range(101, 130)}, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_expected_recall():
    assert n.recall_at_leaf(0.75) > 0.999999


def near_copies(rng, crowds, size):
    """Crowds of edited copies, most of which are linked with some others and few with all."""
    rows = []
    for c in range(crowds):
        base = words(rng, 150)
        for i in range(size):
            w = list(base)
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = "".join(words(rng, 2))
            rows.append((c * size + i, " ".join(w)))
    return rows


def test_a_block_returns_a_forest():
    """Links of a dense block number fewer than its components, and join as much as all links do."""
    rows = near_copies(random.Random(4), 2, 60)
    sets = list(shingle_sets(pa.array([t for _, t in rows])))
    held = [(role, i, i, s) for role in (0, 1) for i, s in enumerate(sets)]
    every, kept = list(n._crossed(held)), []
    both = [(1, 0, 0, role, i, i, rows[i][1]) for role in (0, 1) for i in range(len(rows))]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*both, strict=True)], ["path", "ob", "mb", "role", "id", "root", "text"])
    for made in n._cross(iter([batch])):
        kept += zip(made.column(0).to_pylist(), made.column(1).to_pylist(), strict=True)
    assert len(every) > 1000 and len(kept) < len(rows)

    def roots(edges):
        root = list(range(len(rows)))
        for _ in rows:
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert roots(every) == roots(kept)


def test_turns_move_less_and_link_as_much(spark, monkeypatch):
    rows = near_copies(random.Random(6), 3, 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = spark.createDataFrame([(c + 3 * t, c * 80 + i) for t in range(16) for c in range(3) for i in range(80)], "path long, id long")
    none, moved, plain = spark.createDataFrame([], "u long, v long"), [], n._in_blocks

    def in_blocks(texts, turn):
        nodes = turn.groupBy("path").agg(F.first("size").alias("size"), F.first("n_out").alias("n_out"))
        moved.append(nodes.agg(F.sum(n._moved())).first()[0] or 0)
        return plain(texts, turn)

    monkeypatch.setattr(n, "_in_blocks", in_blocks)
    known, nodes = n._unsettled(classes, none)
    open_ = known.join(nodes, "path")
    found = []
    for most in (10**9, 1):
        links = n._block_links(docs, open_, none, most)
        found.append((sum(moved), sorted(map(tuple, links.collect()))))
        moved.clear()
    assert found[0][1] == found[1][1] and len(found[0][1]) > 100
    assert 3 * found[1][0] < found[0][0]


def test_bitmaps_rule_out_no_link(spark):
    """Of sets of all sizes and similarities every linked pair passes, most that share a passage don't, and neither does one component."""
    rng, rows = random.Random(8), []
    for size in (1, 3, 9, 40, 70, 130, 260, 1100):
        passage = words(rng, size // 2)
        for i in range(8):
            w = words(rng, size + 4)
            rows += [w, [*w[: 3 + len(w) - i * size // 25], *words(rng, i % 3)], passage + words(rng, size + 4 - len(passage))]
    sets = list(shingle_sets(pa.array([" ".join(w) for w in rows])))
    held = [(role, i, i, -1, len(s), n._parity(s)) for role in (0, 1) for i, s in enumerate(sets)]
    ends = {i for a, x in enumerate(sets) for b, y in enumerate(sets[:a]) if linked(set(x.tolist()), set(y.tolist())) for i in (a, b)}
    found = {i for i, _, _ in n._maybe(held)}
    assert len(ends) > 50 and ends <= found and len(found) < len(ends) + 0.3 * (len(rows) - len(ends))
    assert not list(n._maybe([(role, i, 7, -1, size, odd) for role, i, _, _, size, odd in held]))


def test_texts_that_bitmaps_rule_out_stay(spark, monkeypatch):
    """All of a crowd share a passage and meet in blocks; texts move of those only that may be linked."""
    rows, moved, plain = crowd(random.Random(12), 150), [], n._in_blocks
    rows = [r for r in rows if r[0] % 2 == 0 or r[0] < 40]

    def in_blocks(texts, turn):
        moved.append((turn.select("id").distinct().count(), texts.count()))
        return plain(texts, turn)

    monkeypatch.setattr(n, "_in_blocks", in_blocks)
    monkeypatch.setattr(n, "_open", lambda large, links, most, last: {"block": n._unsettled(large, links)[0].join(n._unsettled(large, links)[1], "path")})
    compare(spark, rows)
    assert all(ids <= 40 and texts <= 40 for ids, texts in moved)


def test_bitmaps_of_a_large_node_move_few_times(spark):
    """3,000 classes, a third of them outside the largest component, meet as two rows a class and not as a dozen."""
    open_ = spark.range(3000).selectExpr("1L AS path", "id", "if(id < 2000, 0L, id) AS root", "0L AS most", "3000L AS size", "1000L AS n_out")
    rng = random.Random(2)
    sets = list(shingle_sets(pa.array([" ".join(words(rng, 20)) for _ in range(2999)])))
    sets.append(sets[0])
    bitmaps = spark.createDataFrame([(i, len(s), n._parity(s)) for i, s in enumerate(sets)], "id long, n long, odd binary")
    assert n._dealt(open_, bitmaps, n.WIDE).count() <= 2 * 3000
    found = [r.id for r in n._sieved(bitmaps, open_).collect()]
    assert {0, 2999} <= set(found) and len(found) < 100
