"""Byte-level BPE: encoding and decoding with a given rank file, never trained here.

Texts are split without a regular expression. Code points map to eleven classes; each class is a transition
function of a small automaton that follows the split pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Composition of such functions is associative, and only a few hundred distinct ones arise, so a scan by
doubling composes ids of functions through one table until every prefix is a constant: the state before
each code point. State and class say whether a piece begins there or one code point earlier. The pieces,
as slices of the text's bytes, are merged by rank with a bounded cache; their offsets stay with the ids.

Defined results: a null text encodes to no ids and decodes to the empty text; special tokens' strings are
ordinary text; bytes that aren't UTF-8 count as U+FFFD; rows repeat and other columns pass as they are;
columns named as results, whatever their case, are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewrecon.llm.names import spare, without
from viewrecon.llm.scratch import trimmed

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# Classes of code points. The letters that contractions use have classes of their own.
LETTER, ONE, R, V, L, E, NUMBER, OTHER, QUOTE, BLANK, WHITE, RESET = range(12)
#: Fixed values of the split pattern: letters after which a contraction is complete, and white space.
_ONE = "stmd"
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_LETTERS = (LETTER, ONE, R, V, L, E)
#: Fixed values of Unicode 16.0, the version that the tiktoken library splits by: letters and numbers that 15.1 lacks, first and last of each run.
_NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
_NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))

# States: what the piece that is open consists of.
START, WORD, DIGITS, MARKS, BLANK1, WHITE1, BLANK2, WHITE2, QUOTED, QR, QV, QL, DONE = range(13)
_STATES = 13
#: Whether the state's piece ends with a blank, which joins what follows it.
_ENDS_BLANK = (BLANK1, BLANK2)


def _step(state: int, kind: int) -> tuple[int, bool, bool]:
    """Next state; whether a piece begins here; whether one begins at the code point before."""
    if kind == RESET:
        return START, True, False
    if kind in (BLANK, WHITE):
        if state in (BLANK1, WHITE1, BLANK2, WHITE2):
            return (BLANK2 if kind == BLANK else WHITE2), False, False
        return (BLANK1 if kind == BLANK else WHITE1), True, False
    # A run of white space before this leaves its last code point: a blank to this piece, another to itself.
    before = state in (BLANK2, WHITE2)
    joined = state in _ENDS_BLANK
    if kind in _LETTERS:
        if state == QUOTED and kind == ONE:
            return DONE, False, False
        if state == QUOTED and kind in (R, V, L):
            return {R: QR, V: QV, L: QL}[kind], False, False
        if state in (QR, QV) and kind == E or state == QL and kind == L:
            return DONE, False, False
        if state in (QR, QV, QL):
            return WORD, False, True
        return WORD, not joined and state != WORD, before
    if kind == NUMBER:
        return DIGITS, not joined and state != DIGITS, before or state in (QR, QV, QL)
    if state in (MARKS, QUOTED):
        return MARKS, False, False
    return (MARKS if kind == OTHER or joined else QUOTED), not joined, before or state in (QR, QV, QL)


@lru_cache(1)
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the classes' functions, composition table, state where constant (else -1), begins-here and begins-before tables."""
    steps = [[_step(s, k) for s in range(_STATES)] for k in range(12)]
    functions = [tuple(x[0] for x in row) for row in steps]
    ids = {f: i for i, f in enumerate(dict.fromkeys(functions))}
    todo = list(ids)
    while todo:
        f = todo.pop()
        for g in list(ids):
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in ids:
                    ids[h] = len(ids)
                    todo.append(h)
    table = np.array(list(ids), np.int16)
    then = np.empty((len(ids), len(ids)), np.int16)  # then[f, g]: first f, then g
    for i, f in enumerate(table):
        for j, g in enumerate(table):
            then[i, j] = ids[tuple(g[f].tolist())]
    constant = np.where((table == table[:, :1]).all(axis=1), table[:, 0], -1).astype(np.int8)
    here = np.array([[x[1] for x in row] for row in steps])
    before = np.array([[x[2] for x in row] for row in steps])
    return np.array([ids[f] for f in functions], np.int16), then, constant, here, before


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every code point; the one past the last separates texts."""
    out = np.full(0x110001, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    for kind, runs in ((LETTER, _NEW_LETTERS), (NUMBER, _NEW_NUMBERS)):
        for first, last in runs:
            out[first : last + 1] = kind
    out[_WHITE] = WHITE
    for text, kind in ((_ONE, ONE), ("r", R), ("v", V), ("l", L), ("e", E), ("'", QUOTE), (" ", BLANK)):
        out[[ord(x) for x in text]] = kind
    out[0x110000] = RESET
    return out


def boundaries(points: np.ndarray) -> np.ndarray:
    """points: code points of texts, each text after a separator 0x110000. The indices where pieces begin, separators included."""
    of_class, then, constant, here, before = _automaton()
    kinds = _classes()[points]
    f = of_class[kinds]
    gap = 1
    while gap < len(f) and (constant[f] < 0).any():
        f[gap:] = then[f[:-gap], f[gap:]]
        gap *= 2
    state = np.empty(len(f), np.int8)
    state[0], state[1:] = START, constant[f[:-1]]
    begins = here[kinds, state]
    begins[:-1] |= before[kinds, state][1:]
    return np.flatnonzero(begins)


class Codec:
    """Encodes and decodes with one rank file."""

    #: Pieces kept in the cache, and the longest piece that is.
    CACHE, LONGEST = 400_000, 48

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            self.bytes_of[rank] = piece
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece: the whole if it has a rank, else neighbours joined, lowest rank first, leftmost first."""
        if (whole := self.ranks.get(piece)) is not None:
            return (whole,)
        if len(piece) <= self.LONGEST:
            return self._merge_short(piece)
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))  # of the part that begins at an index
        prior = list(range(-1, n - 1))
        alive = [True] * n
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and end[i] < n and (r := ranks.get(piece[i : end[end[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[end[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j], end[i] = False, stop
            if stop < n:
                prior[stop] = i
            offer(prior[i])
            offer(i)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def _merge_short(self, piece: bytes) -> tuple[int, ...]:
        get, none = self.ranks.get, len(self.bytes_of)
        part = [piece[i : i + 1] for i in range(len(piece))]
        pair = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pair and (least := min(pair)) < none:
            i = pair.index(least)
            part[i] += part.pop(i + 1)
            del pair[i]
            if i < len(pair):
                pair[i] = get(part[i] + part[i + 1], none)
            if i:
                pair[i - 1] = get(part[i - 1] + part[i], none)
        return tuple(self.ranks[x] for x in part)

    def pieces(self, texts: list[bytes]) -> Iterator[list[int]]:
        """For each text the byte offsets of its pieces and its end."""
        clean = [t.decode("utf-8", "replace") for t in texts]
        joined = "\U0010ffff".join(["", *clean])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        lengths = np.array([len(t) for t in clean])
        seps = np.concatenate([[0], np.cumsum(lengths + 1)])
        points[seps[:-1]] = 0x110000
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        width[seps[:-1]] = 0
        at = np.cumsum(width) - width
        begins = boundaries(points)
        cut = np.searchsorted(begins, seps)
        for k in range(len(texts)):
            base = at[seps[k]]
            total = (at[seps[k + 1]] if k + 1 < len(texts) else at[-1] + width[-1]) - base
            first = begins[cut[k] + 1 : cut[k + 1]]
            yield [*(at[first] - base).tolist(), int(total)]

    def encode(self, texts: list[bytes]) -> Iterator[tuple[list[int], list[int]]]:
        """For each text its ids and the byte offsets of its pieces."""
        cache, merge = self.cache, self.merge
        for text, offsets in zip(texts, self.pieces(texts), strict=True):
            if offsets[-1] != len(text):
                text = text.decode("utf-8", "replace").encode()
            ids: list[int] = []
            add, a = ids.extend, 0
            for b in offsets[1:]:
                piece = text[a:b]
                a = b
                found = cache.get(piece)
                if found is None:
                    found = merge(piece)
                    if len(piece) <= self.LONGEST:
                        if len(cache) >= self.CACHE:
                            cache.clear()
                        cache[piece] = found
                add(found)
            yield ids, offsets

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_checked(self, text: bytes, ids: Iterable[int]) -> bytes:
        """The decoded ids; raises unless they give the text back, with U+FFFD for what isn't UTF-8."""
        found = self.decode(ids)
        if found != text and found != text.decode("utf-8", "replace").encode():
            raise ValueError(f"ids of a text of {len(text)} bytes decode to other {len(found)} bytes")
        return found


@lru_cache(4)
def codec(path: str) -> Codec:
    return Codec(path)


def _blocks(column: pa.Array, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """Texts as bytes, null as empty, about ``most`` bytes at a time."""
    held, size = [], 0
    for text in column.cast(pa.large_binary()):
        held.append(text.as_py() or b"")
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _local(path: str) -> str:
    """A vocabulary is a file on every machine (installed with a package) or one sent with ``addFile``, named ``files:NAME``."""
    return SparkFiles.get(path[6:]) if path.startswith("files:") else path


def _encoded(docs: DataFrame, vocabulary: str, text: str, checked: bool) -> DataFrame:
    results = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("offsets", T.ArrayType(T.IntegerType())), *([T.StructField("decoded_sha256", T.StringType())] if checked else [])]
    rest = without(docs.columns, [f.name for f in results])
    src = docs.select(*(F.col(f"`{c}`") for c in rest), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(spare(rest, "whole")))
    names = [*rest, *(f.name for f in results)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(_local(vocabulary))
        for batch in batches:
            at = 0
            for block in _blocks(batch.column(len(rest))):
                ids, offsets = zip(*c.encode(block), strict=True)
                made = [pa.array(ids, pa.list_(pa.int32())), pa.array(offsets, pa.list_(pa.int32()))]
                if checked:
                    made.append(pa.array([hashlib.sha256(c.decode_checked(t, i)).hexdigest() for t, i in zip(block, ids, strict=True)], pa.string()))
                part = batch.slice(at, len(block))
                at += len(block)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names)

    return src.mapInArrow(trimmed(run), T.StructType([*src.schema.fields[:-1], *results]))


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``offsets``: byte offsets of the pieces and, last, the length."""
    return _encoded(docs, vocabulary, text, False)


def encode_checked(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """As ``encode``, with ``decoded_sha256`` of the bytes that the ids decode to; fails where these aren't the text's."""
    return _encoded(docs, vocabulary, text, True)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary), from ``ids`` alone; null ids decode to nothing."""
    rest = without(encoded.columns, ["decoded"])
    src = encoded.select(*(F.col(f"`{c}`") for c in rest))
    where = rest.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(_local(vocabulary))
        for batch in batches:
            out = pa.array([c.decode(ids.as_py() or ()) for ids in batch.column(where)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*rest, "decoded"])

    return src.mapInArrow(trimmed(run), T.StructType([*src.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes, decodes the ids and digests both where the ids are made, so that they never travel."""
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(_local(vocabulary))
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for block in _blocks(batch.column(1)):
                for ids, _ in c.encode(block):
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                    of_text.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return src.mapInArrow(trimmed(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs, public_tokenizers.path(VOCABULARY))
