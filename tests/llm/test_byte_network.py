import numpy as np
from helpers import ODD, odd_docs

from viewrecon.llm import byte_network as b


def as_bytes(texts):
    return [np.frombuffer(x.encode(), np.uint8) for x in texts]


def test_convolution_covers_whole_texts():
    network = b.Network(1)
    rng = np.random.default_rng(0)
    for n in (1, 5, 127, 128, 129, 400):
        x = rng.integers(0, 256, n).astype(np.uint8)
        padded, starts = network._lay([x])
        best, _ = network._blocks(padded, False)
        at = lambda p, x=x: sum(network.p["table"][k][x[p + k - b.WIDTH] if 0 <= p + k - b.WIDTH < len(x) else b.PAD] for k in range(b.WIDTH))
        want = np.array([[max(at(p)[f] for p in range(s * b.BLOCK, (s + 1) * b.BLOCK)) for f in range(b.FILTERS)] for s in range(starts[-1])])
        assert np.allclose(best, want, atol=1e-5)


def test_gradients_against_differences():
    network = b.Network(3)
    network.p["table"] = network.p["table"].astype(np.float64)
    texts, y = as_bytes(["hello world " * 30, "!!! ### $$$", "x"]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = network.scores(texts)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    g = network._gradients(texts, y)
    for name, at in (("w2", (3,)), ("b1", (2,)), ("w1", (4, 5)), ("bias", (1,)), ("table", (2, ord("o"), 7))):
        network.p[name] = network.p[name].astype(np.float64)
        old, eps = network.p[name][at], 1e-3
        network.p[name][at] = old + eps
        up = loss()
        network.p[name][at] = old - eps
        down = loss()
        network.p[name][at] = old
        assert np.isclose((up - down) / (2 * eps), g[name][at], atol=2e-3), name


def test_scores_do_not_depend_on_company():
    network = b.Network(5)
    texts = as_bytes(["", "short", "long text " * 40_000, "é" * 999, "short"])
    together = network.scores(texts)
    alone = np.array([network.scores([t])[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-5) and together[1] == together[4]


def test_held_out_and_whole_table(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    rows = b.op7_quality_classifier(spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.92


def test_few_labels_and_odd_rows(spark):
    assert b.Network().fit([], np.zeros(0)).scores(as_bytes(["a"]))[0] == 0.5
    assert b.Network().fit(as_bytes(["a"]), np.ones(1)).scores(as_bytes(["a", ""])).tolist() == [1, 1]
    docs = odd_docs(spark)
    assert b.score(docs, b.Network()).count() == len(ODD) and b.score(docs.limit(0), b.Network()).count() == 0


def test_odd_rows_score_as_stated(spark):
    """Null scores like empty, repeated rows alike, a very long text whole; columns beside are not read."""
    docs = odd_docs(spark).selectExpr("*", "1 AS score", "2 AS held_out", "'x' AS predicted", "3 AS label")
    out = b.score(docs, b.Network(5))
    assert out.columns == ["doc_id", "score"]
    found = {}
    for r in out.collect():
        found.setdefault(r.doc_id, set()).add(r.score)
    assert len(found) == len({i for i, _ in ODD}) and all(len(s) == 1 for s in found.values())
    assert found[1] == found[2] and all(0 <= min(s) <= 1 for s in found.values())
