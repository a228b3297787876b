"""Toxicity by a lexicon that survives misspelling, and the words around each hit.

The lexicon is learned from labelled rows: words that toxic texts hold and clean texts, almost, do not. Its
words form a trie; Levenshtein automata of up to two edits, a swap of neighbours being one, run over that trie
together, as one automaton that is made deterministic as words ask for it: a state is a set of (trie node,
edits), with the letter that is due where a swap has begun, and a word that strays from all terms dies within a
few letters. A hit is weighed by its term and its edits and, by the words around it, as abuse or as quotation:
quoted hits and direct hits are separate features of a logistic score.

Training takes at most ``SAMPLE`` texts of each class, none above ``MAX_BYTES``, from the training folds only;
terms found in one half of them are tried on the other half, so that the weights are those of unseen texts.

Defined results: a null or empty text has no hits and gets the score of none; repeated rows score alike;
without labelled rows of both classes there is no lexicon and the score is the share of class 1 (0 without any);
a text of any length is scored whole, in memory that grows with its length alone; columns other than ``doc_id``
and ``text`` are neither read nor returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrecon.llm.samples import fold, labelled_texts

#: Texts of each class in the training sample, and the bytes of the longest; these alone bound the lexicon.
SAMPLE, MAX_BYTES = 3000, 1 << 15
#: States and words that are remembered before the memory starts afresh.
STATES, WORDS = 100_000, 200_000

_EDGES = re.compile(r"^[^\w]+|[^\w]+$")
#: Marks that open a quotation, each with those that close it.
CLOSED_BY = {'"': '"', "'": "'’", "“": '”"', "”": "”", "„": '“”"', "‟": "”", "«": "»", "»": "«»", "‹": "›", "›": "‹›", "‘": "’'", "’": "’", "‚": "‘’", "`": "`'"}
_QUOTES = re.compile(f"[{''.join(CLOSED_BY)}]")
_PARAGRAPH = re.compile(r"\n\s*\n")
_BEFORE, _AFTER = re.compile(r"^[^\w]+"), re.compile(r"[^\w]+$")
_REPEATS = re.compile(r"(.)\1{2,}")


def bare(word: str) -> str:
    """The word without marks at its ends, lower-cased, with letters repeated three times or more reduced to one."""
    return _REPEATS.sub(r"\1", _EDGES.sub("", word).casefold())


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


class Automaton:
    """Levenshtein automata of all terms, intersected with the terms' trie and made deterministic on demand.

    swaps: whether two neighbouring letters that changed places count as one edit (each letter edited once at most).
    """

    def __init__(self, terms: Iterable[str], swaps: bool = False):
        self.terms, self.swaps = sorted(set(terms)), swaps
        self.next: list[dict[str, int]] = [{}]
        self.final: list[int] = [-1]
        self.most: list[int] = [-1]  # of the terms below a node, the most edits that any allows
        for t, term in enumerate(self.terms):
            node, allowed = 0, edits_allowed(term)
            self.most[0] = max(self.most[0], allowed)
            for c in term:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.final.append(-1)
                    self.most.append(-1)
                node = self.next[node][c]
                self.most[node] = max(self.most[node], allowed)
            self.final[node] = t
        self._start_afresh()

    def _start_afresh(self) -> None:
        self.index: dict[tuple[frozenset, frozenset], int] = {}
        self.sets: list[frozenset] = []
        self.due: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.hits: list[tuple[int, int] | None] = []
        self.dead = self._state({})
        self.start = self._state(self._close({0: 0}))

    def _close(self, nodes: dict[int, int]) -> dict[int, int]:
        """Adds what leaving out letters of terms reaches; keeps the fewest edits for each node that its terms allow."""
        todo = list(nodes.items())
        nodes = {n: e for n, e in nodes.items() if e <= self.most[n]}
        while todo:
            n, e = todo.pop()
            if nodes.get(n) != e:
                continue
            for m in self.next[n].values():
                if e + 1 <= self.most[m] and e + 1 < nodes.get(m, 9):
                    nodes[m] = e + 1
                    todo.append((m, e + 1))
        return nodes

    def _state(self, nodes: dict[int, int], due: dict[tuple[int, str], int] | None = None) -> int:
        """due: the edits at which a node is reached if the next letter is the one that completes a swap."""
        swaps = frozenset((due or {}).items())
        key = (frozenset(nodes.items()), swaps)
        if key not in self.index:
            self.index[key] = len(self.sets)
            self.sets.append(key[0])
            self.due.append(swaps)
            self.moves.append({})
            ends = [(e, self.final[n]) for n, e in key[0] if self.final[n] >= 0 and e <= edits_allowed(self.terms[self.final[n]])]
            self.hits.append(min(ends) if ends else None)
        return self.index[key]

    def _move(self, state: int, c: str) -> int:
        after: dict[int, int] = {}
        due: dict[tuple[int, str], int] = {}

        def reach(n: int, e: int) -> None:
            if e < after.get(n, 9):
                after[n] = e

        for n, e in self.sets[state]:
            reach(n, e + 1)  # a letter too many
            for d, m in self.next[n].items():
                reach(m, e + (d != c))
                if self.swaps and d != c and (k := self.next[m].get(c)) is not None and e + 1 <= self.most[k] and e + 1 < due.get((k, d), 9):
                    due[k, d] = e + 1
        for (k, d), e in self.due[state]:
            if d == c:
                reach(k, e)
        return self._state(self._close(after), due)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, index of the term) of the nearest term within its edits, the first of equals."""
        if len(self.sets) > STATES:
            self._start_afresh()
        s = self.start
        for c in word:
            t = self.moves[s].get(c)
            if t is None:
                t = self.moves[s][c] = self._move(s, c)
            s = t
            if s == self.dead:
                return None
        return self.hits[s]


def quoted(text: str) -> np.ndarray | None:
    """For each word of ``text.split()`` whether it stands in a quotation, however long; None without any.

    A quotation opens with a mark before a word and ends with a mark of its kind after that word or a later one of
    the paragraph. A mark that is never closed quotes nothing; of two straight ones that open, the later counts.
    """
    if not _QUOTES.search(text):
        return None
    ends, at = [], 0
    for paragraph in _PARAGRAPH.split(text):
        words, opened = paragraph.split(), []  # opened: (mark, index of its word), in order

        def opens(mark: str, i: int) -> None:
            if mark in CLOSED_BY[mark]:
                opened[:] = [x for x in opened if x[0] != mark]
            opened.append((mark, i))

        def closes(mark: str, i: int) -> bool:
            for k in range(len(opened) - 1, -1, -1):
                if mark in CLOSED_BY[opened[k][0]]:
                    ends.append((opened[k][1], i + 1))
                    del opened[k:]
                    return True
            return False

        for i, w in enumerate(words, at):
            if not _QUOTES.search(w):
                continue
            before, after = _BEFORE.match(w), _AFTER.search(w)
            if before and before.end() == len(w):  # a mark that stands alone
                for mark in _QUOTES.findall(w):
                    if not closes(mark, i):
                        opens(mark, i)
                continue
            for mark in _QUOTES.findall(before[0]) if before else ():
                opens(mark, i)
            for mark in _QUOTES.findall(after[0]) if after else ():
                closes(mark, i)
        at += len(words)
    depth = np.zeros(at + 1, int)
    for a, b in ends:
        depth[a] += 1
        depth[b] -= 1
    return np.cumsum(depth) > 0


class Lexicon:
    """Terms with weights, clean words that are never taken for misspelt terms, and features of a text."""

    #: Features: direct hits exact, by one edit, by two edits; quoted hits; the strongest direct hit; direct hits a hundred words.
    FEATURES = 6

    def __init__(self, weights: dict[str, float], clean: frozenset[str]):
        self.weights, self.clean = weights, clean
        self.automaton = Automaton(weights, swaps=True)
        self.known: dict[str, tuple[float, int] | None] = {}

    def look_up(self, word: str) -> tuple[float, int] | None:
        """(weight, edits) of a word as it stands in a text."""
        if word in self.known:
            return self.known[word]
        if len(self.known) >= WORDS:
            self.known.clear()
        base, found = bare(word), None
        if base and base not in self.clean:
            found = self.automaton.match(base)
        hit = self.known[word] = (self.weights[self.automaton.terms[found[1]]], found[0]) if found else None
        return hit

    def features(self, text: str) -> np.ndarray:
        out = np.zeros(self.FEATURES)
        words = text.split()
        distinct = set(words)
        hits = {w: h for w in distinct if (h := self.look_up(w)) is not None}
        if not hits:
            return out
        total, inside = 0, quoted(text)
        for i, w in enumerate(words):
            if w not in hits:
                continue
            weight, edits = hits[w]
            if inside is not None and inside[i]:
                out[3] += weight
            else:
                total += 1
                out[edits] += weight
                out[4] = max(out[4], weight / (1 + edits))
        out[:4] = np.log1p(out[:4])
        out[5] = math.log1p(100 * total / len(words))
        return out


def without_copies(texts: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Without texts that share half of their eight smallest word hashes with an earlier one: the words of copies don't count twice."""
    seen: dict[int, list[int]] = {}
    out = []
    for k, (text, label) in enumerate(texts):
        least = sorted({zlib.crc32(w.encode()) for w in set(text.split())})[:8]
        met = Counter(j for h in least for j in seen.get(h, ()))
        if least and met and 2 * max(met.values()) >= len(least):
            continue
        for h in least:
            seen.setdefault(h, []).append(k)
        out.append((text, label))
    return out


def find_terms(texts: list[tuple[str, int]]) -> tuple[dict[str, float], frozenset[str]]:
    """Terms with the log odds of toxic texts to clean ones, and the words of clean texts, which are never taken for misspelt terms."""
    counts = (Counter(), Counter())
    sizes = [0, 0]
    for text, label in texts:
        counts[label].update({b for w in set(text.split()) if (b := bare(w))})
        sizes[label] += 1
    clean, toxic = counts
    if not sizes[0] or not sizes[1]:
        return {}, frozenset()
    share = sizes[1] / (sizes[0] + sizes[1])
    sure = math.log(len(toxic) + 1) + 3  # as many words as are tried come out by chance below this
    scored = []
    for word, n in toxic.items():
        c = clean[word]
        if len(word) < 3 or n <= share * (n + c):
            continue
        surprise = n * math.log(n / (n + c) / share) + (c * math.log(c / (n + c) / (1 - share)) if c else 0.0)
        odds = math.log((n + 0.1) / (sizes[1] + 0.2)) - math.log((c + 0.1) / (sizes[0] + 0.2))
        if surprise > sure and odds > 2.5:
            scored.append((word, odds))
    weights = {word: odds for word, odds in sorted(scored)}
    return weights, frozenset(w for w in clean if w not in weights)


class Scorer:
    def __init__(self, texts: list[tuple[str, int]], share: float | None = None):
        """texts: (text, label); share: of class 1 among the labelled rows, if the sample does not show it."""
        texts = without_copies(texts)
        y = np.array([label for _, label in texts], float)
        self.coefficients, self.lexicon = np.zeros(Lexicon.FEATURES), Lexicon(*find_terms(texts))
        if len(set(y.tolist())) < 2:
            mean = float(y.mean()) if len(y) else 0.0
            self.bias = math.log(max(mean, 1e-6) / max(1 - mean, 1e-6))
            return
        x = np.zeros((len(texts), Lexicon.FEATURES))
        for half in (0, 1):
            other = Lexicon(*find_terms(texts[1 - half :: 2]))
            x[half::2] = [other.features(t) for t, _ in texts[half::2]]
        self.coefficients, self.bias = _logistic(x, y)
        if share is not None and 0 < share < 1:
            self.bias += math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))

    def score(self, text: str) -> float:
        z = self.bias + float(self.coefficients @ self.lexicon.features(text))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> tuple[np.ndarray, float]:
    """Newton's method with a ridge on scaled features; evidence of toxicity never lowers a score."""
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    free = x.std(axis=0) > 0
    while True:
        xs = np.hstack([x[:, free] / scale[free], np.ones((len(x), 1))])
        penalty = np.r_[np.full(xs.shape[1] - 1, ridge), 1e-6]
        w = np.zeros(xs.shape[1])
        w[-1] = math.log(y.mean() / (1 - y.mean()))
        loss = lambda w: np.logaddexp(0, np.where(y > 0, -1, 1) * (xs @ w)).sum() + (penalty * w * w).sum() / 2
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(xs @ w, -30, 30)))
            step = np.linalg.solve((xs * (p * (1 - p))[:, None]).T @ xs + np.diag(penalty + 1e-9), xs.T @ (y - p) - penalty * w)
            size = 1.0
            while loss(w + size * step) > loss(w) and size > 1e-6:
                size /= 2
            w = w + size * step
            if np.abs(step).max() < 1e-8:
                break
        if len(w) == 1 or (w[:-1] >= 0).all():
            out = np.zeros(x.shape[1])
            out[free] = w[:-1] / scale[free]
            return out, float(w[-1])
        free[np.flatnonzero(free)[w[:-1].argmin()]] = False


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, max_bytes: int = MAX_BYTES) -> Scorer:
    """docs: (doc_id, text); labels: (doc_id, ``label``), only rows that may be learned from."""
    counts = {r[label]: r["count"] for r in labels.filter(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return Scorer(labelled_texts(docs, labels, label, F.lit(True), sample, max_bytes), share)


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, score) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    model = (scorer.lexicon.weights, scorer.lexicon.clean, scorer.coefficients, scorer.bias)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, clean, coefficients, bias = sent.value
        own = Scorer.__new__(Scorer)
        own.lexicon, own.coefficients, own.bias = Lexicon(weights, clean), coefficients, bias
        for batch in batches:
            found = [own.score(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").filter(fold(5) != 0)
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
