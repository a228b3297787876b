"""Quality classifier: a convolutional network over the bytes of whole texts, trained and run in numpy.

Filters of WIDTH bytes slide over the text; each is one table of weights by offset and byte, so that a
convolution is a sum of look-ups. Texts are covered by overlapping chunks of two blocks of BLOCK bytes. A
filter's largest value in a chunk is kept; the means and maxima of these over all chunks go through a
small dense layer to one probability. Memory is bounded by SPAN positions, however long a text.

Training takes at most ``SAMPLE`` labelled texts of each class, none above ``MAX_BYTES``, from the training
folds only, in a fixed order from fixed seeds.

Defined results: a null or empty text has no chunks and gets the score of zero features; repeated rows
score alike; without labelled rows of both classes the score is the share of class 1 (0.5 without any); a
text of any length is scored whole, chunk by chunk; columns other than ``doc_id`` and ``text`` are neither
read nor returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrecon.llm.samples import fold, labelled_texts
from viewrecon.llm.shingles import text_bytes

WIDTH, FILTERS, HIDDEN, BLOCK = 6, 24, 16, 128
#: Positions that are convolved at once.
SPAN = 1 << 16
#: Texts of each class in the training sample, and the bytes of the longest.
SAMPLE, MAX_BYTES = 1500, 1 << 15
EPOCHS, BATCH, RATE = 6, 32, 0.004
PAD = 256


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {
            "table": rng.normal(0, 0.25, (WIDTH, 257, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "w1": rng.normal(0, 0.2, (2 * FILTERS, HIDDEN)).astype(np.float32),
            "b1": np.zeros(HIDDEN, np.float32),
            "w2": rng.normal(0, 0.3, HIDDEN).astype(np.float32),
            "b2": np.zeros(1, np.float32),
        }
        self.p["table"][:, PAD] = 0
        self.constant: float | None = None

    def _blocks(self, padded: np.ndarray, where: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """padded: bytes, a multiple of BLOCK, and WIDTH more. Each block's largest values, and their positions."""
        n = len(padded) - WIDTH
        best = np.empty((n // BLOCK, FILTERS), np.float32)
        at = np.empty((n // BLOCK, FILTERS), np.int64) if where else None
        for a in range(0, n, SPAN):
            b = min(n, a + SPAN)
            total = self.p["table"][0][padded[a:b]]
            for k in range(1, WIDTH):
                total += self.p["table"][k][padded[a + k : b + k]]
            cube = total.reshape(-1, BLOCK, FILTERS)
            if where:
                i = cube.argmax(axis=1)
                at[a // BLOCK : b // BLOCK] = i + np.arange(a, b, BLOCK)[:, None]
                best[a // BLOCK : b // BLOCK] = np.take_along_axis(cube, i[:, None], 1)[:, 0]
            else:
                best[a // BLOCK : b // BLOCK] = cube.max(axis=1)
        return best, at

    @staticmethod
    def _lay(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All texts, each in whole blocks of its own that begin with padding as wide as a filter; the offsets of their blocks."""
        counts = np.array([0 if not len(t) else -(-(len(t) + WIDTH) // BLOCK) for t in texts])
        starts = np.concatenate([[0], np.cumsum(counts)])
        out = np.full(starts[-1] * BLOCK + WIDTH, PAD, np.int16)
        for t, s in zip(texts, starts, strict=False):
            out[s * BLOCK + WIDTH : s * BLOCK + WIDTH + len(t)] = t
        return out, starts

    def _pool(self, best: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Chunks of two neighbouring blocks of a text: their values after the rectifier, which block won, their text and the texts' chunk counts."""
        blocks = np.diff(starts)
        chunks = np.where(blocks > 1, blocks - 1, blocks)
        text = np.repeat(np.arange(len(blocks)), chunks)
        first = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks) + starts[text]
        second = np.where(blocks[text] > 1, first + 1, first)
        won = np.where(best[second] > best[first], second[:, None], first[:, None])
        value = np.maximum(best[second], best[first]) + self.p["bias"]
        return np.maximum(value, 0), won, text, chunks

    def _features(self, pooled: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        out = np.zeros((len(chunks), 2 * FILTERS), np.float32)
        full = np.flatnonzero(chunks)
        if len(full):
            at = (np.cumsum(chunks) - chunks)[full]
            out[full, :FILTERS] = np.add.reduceat(pooled.astype(np.float64), at, axis=0) / chunks[full, None]
            out[full, FILTERS:] = np.maximum.reduceat(pooled, at, axis=0)
        return out

    def _head(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(x @ self.p["w1"] + self.p["b1"], 0)
        z = (hidden @ self.p["w2"] + self.p["b2"]).astype(np.float64)
        return hidden, 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        out = np.empty(len(texts))
        i = 0
        while i < len(texts):
            j, size = i + 1, len(texts[i])
            while j < len(texts) and size + len(texts[j]) <= 4 * SPAN:
                size += len(texts[j])
                j += 1
            padded, starts = self._lay(texts[i:j])
            pooled, _, _, chunks = self._pool(self._blocks(padded, False)[0], starts)
            out[i:j] = self._head(self._features(pooled, chunks))[1]
            i = j
        return out

    def _gradients(self, texts: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        padded, starts = self._lay(texts)
        best, at = self._blocks(padded, True)
        pooled, won, text, chunks = self._pool(best, starts)
        x = self._features(pooled, chunks)
        hidden, p = self._head(x)
        dz = ((p - y) / len(y)).astype(np.float32)
        dh = np.outer(dz, self.p["w2"]) * (hidden > 0)
        dx = dh @ self.p["w1"].T
        largest = pooled == x[text, FILTERS:]
        share = dx[text, :FILTERS] / chunks[text, None] + dx[text, FILTERS:] * largest
        share *= pooled > 0
        g = {"w2": hidden.T @ dz, "b2": dz.sum(keepdims=True), "w1": x.T @ dh, "b1": dh.sum(0), "bias": share.sum(0)}
        table = np.zeros(WIDTH * 257 * FILTERS)
        f = np.broadcast_to(np.arange(FILTERS), share.shape)
        pos = at[won, f]
        for k in range(WIDTH):
            table += np.bincount(((k * 257 + padded[pos + k].astype(np.int64)) * FILTERS + f).ravel(), share.ravel(), len(table))
        g["table"] = table.reshape(WIDTH, 257, FILTERS).astype(np.float32)
        g["table"][:, PAD] = 0
        return g

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> Network:
        if len(set(labels.tolist())) < 2:
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return self
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        steps = max(EPOCHS, -(-400 // max(1, len(texts) // BATCH)))  # a small sample is gone through more often
        for epoch in range(min(steps, 40)):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), BATCH):
                pick = order[a : a + BATCH]
                step += 1
                for k, g in self._gradients([texts[i] for i in pick], labels[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] -= (RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return self


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, max_bytes: int = MAX_BYTES) -> Network:
    """docs: (doc_id, text); labels: (doc_id, ``label``), only rows that may be learned from."""
    rows = labelled_texts(docs, labels, label, F.lit(True), sample, max_bytes)
    texts, y = [np.frombuffer(t.encode(), np.uint8) for t, _ in rows], np.array([y for _, y in rows], np.float64)
    network = Network().fit(texts, y)
    counts = {r[label]: r["count"] for r in labels.filter(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    if network.constant is None:  # the sample holds the classes more evenly than the labels do
        network.p["b2"] += np.float32(np.log(counts[1] / counts[0] * (y == 0).sum() / (y == 1).sum()))
    return network


def score(docs: DataFrame, network: Network) -> DataFrame:
    """(doc_id, score) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            texts = [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(network.scores(texts), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").filter(fold(4) != 2)
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
