"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of five-word shingles; two are linked where 100 * intersection >= 75 * union. Documents
with equal sets form one class, and only classes are joined. Independent trees branch: at a node, about
1 / 0.75 minwise coordinates are chosen, other ones in each tree and on each level, and a class goes to the
child named by its value there, so that a linked pair stays together in about one child on average. Nodes of up
to LEAF classes are compared exhaustively; a larger node compares its classes with a pivot. Signatures sift the
pairs, whole texts confirm them: first at most one pair for each class, which settles dense groups in linear
work, then all sifted pairs whose ends are still in different components. A large node whose classes are then
one component is closed; where up to LEAF classes are outside its largest component, those are compared with
all. A node that is mostly one component would hardly shrink: up to FEW classes outside it meet all classes of
the node exactly, in blocks where intersections are counted for all pairs at once and only links come out; nodes
of a level that have the component's pivot in common, one for each chosen coordinate at most, are one such
group. A block returns the links of a forest that joins its components, not every pair. Before texts move, parity bitmaps
of the sets, of one to two bits a shingle, meet in the same blocks: bits that differ number no more than shingles that
differ, so a class none of whose pairs is within the bound on those is linked with nothing there, and its text stays
where it is. Where blocks would move more than each text once, they are done in turns: nodes of other trees hold much
the same classes, and what a turn has linked need not meet again in the next one. Any other node branches on, as long as there is one; what unlinked classes share shrinks it at every
level. As soon as all nodes that are open can be compared in blocks at the cost of moving each text four times, on
average, that is done and ends the matter; so is what is left after LEVELS levels.

Rows that have a key in common meet in one task only in bounded numbers: keys of many rows are broadcast to
them, and a node of more than NODE classes is dealt into parts with a pivot each.

Defined results: null, empty or word-free text is linked with nothing; rows that share a ``doc_id`` are taken
to hold the same text; rows with a null ``doc_id`` take no part and stay; an empty table gives an empty
result; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrecon.llm.components import components
from viewrecon.llm.hot import join_counted
from viewrecon.llm.scratch import short_batches, stage, trimmed
from viewrecon.llm.shingles import _mix, shingle_sets

PERCENT = 75
#: Minwise coordinates; trees; levels before what is left is compared in blocks; classes of a node that are compared exhaustively.
COORDINATES, TREES, LEVELS, LEAF = 64, 16, 40, 12
#: Coordinates that the trees choose from on one of the levels below the first.
CHOICE = 7
#: Classes of a node's part, at most about; classes outside its largest component that a node compares in blocks, at most.
NODE, FEW = 4096, 1024
#: Equal coordinates that a pair needs to be confirmed: at 75 % similarity fewer have a chance of about 1e-6.
SIFT = 31
#: Equal coordinates from which any partner is as good as another for the first confirmation.
SURE = 56
#: Texts that are compared with one copy of their partner.
SLICE = 128
#: Classes of a node on either side of a block.
BLOCK = 256
#: The same of blocks where bitmaps meet, which are small: the larger, the fewer copies of a large node's rows move.
WIDE = 2048
#: Shares of the nodes, in eighths, that the turns of comparing in blocks end at.
TURNS = (1, 3, 8)
#: Ids of documents up to which they are broadcast to find their texts; beyond it both sides are shuffled.
BROADCAST_IDS = 500_000

_rng = np.random.Generator(np.random.PCG64(8))
_FACTORS = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signature(shingles: np.ndarray) -> np.ndarray:
    out = np.full(COORDINATES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(shingles), 2048):
        part = (np.multiply.outer(_FACTORS, shingles[i : i + 2048]) >> np.uint64(32)).min(axis=1)
        out = np.minimum(out, part.astype(np.uint32))
    return out


def _parity(shingles: np.ndarray) -> bytes:
    """For each of one to two buckets a shingle, a power of two and 64 at least, whether it holds an odd number of them."""
    n = 1 << max(6, (len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, f1, f2, sig, low, odd = [], [], [], [], [], []
        with np.errstate(over="ignore"):
            for s in shingle_sets(batch.column(1)):
                v = _signature(s)
                n.append(len(s))
                f1.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                f2.append(int(_mix(s ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64).view(np.int64)))
                sig.append(v.tobytes())
                low.append(v.astype(np.uint8).tobytes())
                odd.append(_parity(s))
        numbers, bytes_ = ([pa.array(x, kind) for x in columns] for columns, kind in (((n, f1, f2), pa.int64()), ((sig, low, odd), pa.binary())))
        yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, *bytes_], ["doc_id", "n", "f1", "f2", "sig", "low", "odd"])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n, f1, f2, sig, low, odd) of every row: set size, fingerprint of the set, signature and its low bytes, parity bitmap."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(trimmed(_sign), f"doc_id {kind}, n long, f1 long, f2 long, sig binary, low binary, odd binary")


def _children(path: Column, level: int) -> Column:
    """The coordinates chosen at a node: one, or two at a third of the nodes.

    On the first level ``path`` is the tree's number, and all coordinates chosen are different ones. Each of the next
    levels draws by the path from a few that the levels just above it don't use.
    """
    if level == 0:
        own = path.cast("int") - 1
        return F.when(path % 3 == 0, F.array(own, (F.lit(TREES) + path / 3 - 1).cast("int"))).otherwise(F.array(own))
    first = TREES + TREES // 3
    begin = first + CHOICE * ((level - 1) % ((COORDINATES - first) // CHOICE))
    pick = lambda k: (F.pmod(F.xxhash64(path, F.lit(k)), F.lit(CHOICE)) + begin).cast("int")
    return F.when(F.pmod(F.xxhash64(path, F.lit(2)), F.lit(3)) == 0, F.array_distinct(F.array(pick(0), pick(1)))).otherwise(F.array(pick(0)))


def _branch(rows: DataFrame, level: int) -> DataFrame:
    """rows: (path, id, root, sig). Returns (path, id, root) of the children."""
    chosen = rows.select("path", "id", "root", "sig", F.explode(_children(F.col("path"), level)).alias("j"))
    return chosen.select(F.xxhash64("path", "j", F.expr("substring(sig, 4 * j + 1, 4)")).alias("path"), "id", "root")


def _signed(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` with sig, fetched once for all paths of a class, of which a level has a few dozen at most."""
    paths = rows.groupBy("id").agg(F.first("root").alias("root"), F.collect_list("path").alias("paths"))
    return paths.join(classes.select("id", "sig"), "id").select(F.explode("paths").alias("path"), "id", "root", "sig")


def _pairs_and_rest(rows: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) of one level's comparisons, and the (path, id) of nodes above LEAF. rows: (path, id, root); a pair's roots differ.

    a comes before b in a random order of the level.
    """
    me = F.struct(F.xxhash64(F.lit(level), "id").alias("o"), F.col("id").alias("id"), F.col("root").alias("root"))
    nodes = stage(rows.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1"), "nodes")
    held = stage(join_counted(rows, nodes, ["path"], "size").select("path", "id", "root", "size"), "paths")
    leaf = held.filter(F.col("size") <= LEAF).groupBy("path").agg(F.sort_array(F.collect_list(me)).alias("m"))
    left = leaf.select("m", F.posexplode("m").alias("i", "x"))
    pairs = left.select("x", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("y"))
    parts = F.when(F.col("size") > NODE, F.pow(F.lit(2), F.ceil(F.log2(F.col("size") / NODE)))).otherwise(1).cast("long")
    large = held.filter(F.col("size") > LEAF).withColumn("part", F.pmod(F.xxhash64(F.lit(-1), "id"), parts))
    pivots = stage(large.groupBy("path", "part").agg(F.count("*").alias("n"), F.min(me).alias("x")), "pivots")
    star = join_counted(large, pivots, ["path", "part"], "n").select("x", me.alias("y"))
    tops = pivots.groupBy("path").agg(F.min("x").alias("top"), F.count("*").alias("n")).filter("n > 1")
    star = star.union(pivots.join(tops.select("path", "top"), "path").select(F.col("top").alias("x"), F.col("x").alias("y")))
    found = pairs.union(star).filter("x.id <> y.id AND x.root <> y.root").select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    return found, large.select("path", "id")


def _moved() -> Column:
    """Texts that a node moves to be compared in blocks."""
    return F.col("size") * F.ceil(F.col("n_out") / BLOCK) + F.col("n_out") * F.ceil(F.col("size") / BLOCK)


def _unsettled(rows: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows: (path, id). Those with their root, and (path, size, most, n_out) of the nodes that aren't one component yet."""
    known = stage(_rooted(rows, links), "known")
    of_root = known.groupBy("path", "root").agg(F.count("*").alias("n"))
    nodes = of_root.groupBy("path").agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots")).filter("roots > 1")
    nodes = stage(nodes.select("path", "size", F.col("most.root").alias("most"), (F.col("size") - F.col("most.n")).alias("n_out")), "open_nodes")
    return known, nodes


def _open(large: DataFrame, links: DataFrame, most_texts: int, last: bool) -> dict[str, DataFrame]:
    """large: (path, id) of large nodes. Those that aren't one component yet, by what is done with them, as (path, id, root, most,
    size, n_out): the root of the node's largest component, its classes and how many are outside that.

    All are compared in blocks if that moves no more than four times ``most_texts`` and compares each of as many with FEW others at most.
    """
    known, nodes = _unsettled(large, links)
    dense = (F.col("n_out") <= FEW) & (2 * F.col("n_out") <= F.col("size"))
    way = F.when(F.col("n_out") <= LEAF, "few").when(dense, "dense").otherwise("block" if last else "branch")
    sums = nodes.agg(F.sum(_moved()).alias("texts"), F.sum(F.col("size").cast("double") * F.col("n_out")).alias("pairs"), F.collect_set(way).alias("ways")).first()
    if not sums.ways:
        return {}
    if sums.texts <= 4 * most_texts and sums.pairs <= FEW * most_texts:
        return {"block": join_counted(known, nodes, ["path"], "size")}
    open_ = stage(join_counted(known, nodes, ["path"], "size").withColumn("way", way), "open")
    return {w: open_.filter(F.col("way") == w).drop("way") for w in sums.ways}


def _few(few: DataFrame) -> DataFrame:
    """(a, b) across roots of nodes with up to LEAF classes outside their largest component: those and all others."""
    outside = few.filter("root <> most").groupBy("path").agg(F.collect_list(F.struct("id", "root")).alias("outside"), F.first("size").alias("n"))
    met = join_counted(few, stage(outside, "outside"), ["path"], "n").select("id", "root", F.explode("outside").alias("x"))
    return met.filter("root <> x.root").select(F.least("id", "x.id").alias("a"), F.greatest("id", "x.id").alias("b"))


def _dense(some: DataFrame) -> DataFrame:
    """Groups of nodes of which one component is half at least, with the pivot's id in place of the path."""
    pivots = some.filter("root = most").groupBy("path").agg(F.min(F.struct(F.xxhash64("id"), "id"))["id"].alias("pivot"), F.first("size").alias("n"))
    met = join_counted(some.select("path", "id", "root", "most"), stage(pivots, "pivots"), ["path"], "n")
    groups = stage(met.select("pivot", "id", "root", "most").distinct(), "groups")
    sizes = groups.groupBy("pivot").agg(F.count("*").alias("size"), F.count_if(F.col("root") != F.col("most")).alias("n_out"))
    return join_counted(groups, stage(sizes, "groups"), ["pivot"], "size").withColumnRenamed("pivot", "path")


def _sift(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, COORDINATES) for k in (2, 3))
        same = (a == b).sum(axis=1)
        keep = pa.array(same >= least)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(same.astype(np.int32)).filter(keep)], ["a", "b", "same"])


def _sifted(pairs: DataFrame, classes: DataFrame, sift: int) -> DataFrame:
    """(a, b, same) of the pairs that may be similar enough, by set sizes and signatures."""
    side = lambda k: classes.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("low").alias(f"low{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    kind = classes.schema["id"].dataType.simpleString()
    return both.select("a", "b", "lowa", "lowb").mapInArrow(lambda batches: _sift(batches, sift), f"a {kind}, b {kind}, same int")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a group follow its first row, whose text they are compared with."""
    group, whole = None, None
    for batch in batches:
        a, b = [], []
        heads, ids = batch.column(0).to_pylist(), batch.column(3).to_pylist()
        for head, part, first, me, s in zip(heads, batch.column(1).to_pylist(), batch.column(2).to_pylist(), ids, shingle_sets(batch.column(4)), strict=True):
            if first == 0:
                group, whole = (head, part), s
            elif group == (head, part):
                at = np.searchsorted(whole, s)
                at[at == len(whole)] = 0
                common = int((whole[at] == s).sum()) if len(whole) else 0
                if common and 100 * common >= PERCENT * (len(whole) + len(s) - common):
                    a.append(head)
                    b.append(me)
        kind = batch.column(0).type
        yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["u", "v"])


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The linked ones of ``pairs`` (a, b), as (u, v). Each text meets its partner's in slices of a group, sorted so that one pass compares them."""
    slices = pairs.groupBy("a").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
    dealt = pairs.join(slices, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("slices")).cast("int").alias("part"))
    heads = dealt.select("a", "part").distinct().select("a", "part", F.lit(0).alias("first"), F.col("a").alias("id"))
    rows = heads.union(dealt.select("a", "part", F.lit(1).alias("first"), F.col("b").alias("id"))).join(texts, "id").select("a", "part", "first", "id", "text")
    kind = texts.schema["id"].dataType.simpleString()
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "first", "id").mapInArrow(trimmed(_confirm), f"u {kind}, v {kind}")


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` of some ids. Few ids are broadcast, so that all other rows stay where they are."""
    ids = stage(ids.distinct(), "ids")
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id")


def _texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, text) of the documents in some pairs."""
    return _only(docs.select(F.col("doc_id").alias("id"), "text"), pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))))


def _rooted(rows: DataFrame, links: DataFrame, name: str = "id", root: str = "root") -> DataFrame:
    """``rows`` with the root of the component that the class ``name`` is in."""
    return rows.join(links.select(F.col("u").alias(name), F.col("v").alias(root)), name, "left").withColumn(root, F.coalesce(root, name))


def _across(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The (a, b) whose ends are in different components."""
    return _rooted(_rooted(pairs, links, "a", "root_a"), links, "b", "root_b").filter("root_a <> root_b").select("a", "b")


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, links: DataFrame, sift: int, first_level: bool = False) -> DataFrame:
    """``links`` and those among ``pairs`` that are similar enough: (u, v) with v the first class of u's component.

    On the first level, where whole groups meet, at most one pair for each class is confirmed before the others.
    """
    sifted = stage(_sifted(pairs.distinct(), classes, sift), "pairs")
    if sifted.isEmpty():
        return links
    if not first_level:
        return components(_confirmed(sifted.select("a", "b"), _texts_of(docs, sifted)).union(links))
    texts = stage(_texts_of(docs, sifted), "texts")
    best = F.min(F.struct((-F.least("same", F.lit(SURE))).alias("k"), F.xxhash64("a").alias("o"), F.col("a").alias("a")))
    first = stage(sifted.groupBy("b").agg(best["a"].alias("a")).select("a", "b"), "first_pairs")
    links = components(_confirmed(first, texts).union(links))
    later = stage(_across(sifted.select("a", "b").join(first, ["a", "b"], "left_anti"), links), "open_pairs")
    return links if later.isEmpty() else components(_confirmed(later, texts).union(links))


def _crossed(held: list[tuple[int, object, object, np.ndarray]]) -> Iterator[tuple[object, object]]:
    """held: (role, id, root, shingles), outsiders with role 0. For each outsider one link to each other component met here.

    Intersections are counted for all pairs at once, over the shingles that both sides hold.
    """
    left, right = ([h for h in held if h[0] == role] for role in (0, 1))
    if not left or not right:
        return
    sides = [np.concatenate([h[3] for h in side]) for side in (left, right)]
    shared = np.intersect1d(*sides)
    counts = np.zeros((len(left), len(right)), np.float32)
    wide = [np.searchsorted(shared, x) for x in sides]
    hit = [(w < len(shared)) & (shared[np.minimum(w, len(shared) - 1)] == x) if len(shared) else np.zeros(len(x), bool) for w, x in zip(wide, sides, strict=True)]
    row = [np.repeat(np.arange(len(side)), [len(h[3]) for h in side]) for side in (left, right)]
    at = [(w[h], r[h]) for w, h, r in zip(wide, hit, row, strict=True)]
    for begin in range(0, len(shared), 4096):
        part = []
        for (w, r), side in zip(at, (left, right), strict=True):
            some = (w >= begin) & (w < begin + 4096)
            m = np.zeros((len(side), min(4096, len(shared) - begin)), np.float32)
            m[r[some], w[some] - begin] = 1
            part.append(m)
        counts += part[0] @ part[1].T
    n = [np.array([len(h[3]) for h in side]) for side in (left, right)]
    linked = (counts > 0) & (100 * counts >= PERCENT * (n[0][:, None] + n[1][None, :] - counts))
    for i, j_all in ((i, np.flatnonzero(linked[i])) for i in range(len(left))):
        seen = {left[i][2]}
        for j in j_all:
            if right[j][2] not in seen:
                seen.add(right[j][2])
                yield left[i][1], right[j][1]


def _forest(held: list[tuple[int, object, object, np.ndarray]]) -> Iterator[tuple[object, object]]:
    """Of the links that ``_crossed`` finds those that join components which the ones before don't: fewer than there are components."""
    up = {h[2]: h[2] for h in held}
    root_of = {h[1]: h[2] for h in held}

    def find(x: object) -> object:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in _crossed(held):
        x, y = find(root_of[a]), find(root_of[b])
        if x != y:
            up[x] = y
            yield a, b


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a group follow each other; a group has about 2 * BLOCK rows at most."""
    group, held, kind = None, [], None
    u: list = []
    v: list = []

    def close() -> None:
        for x, y in _forest(held):
            u.append(x)
            v.append(y)

    for batch in batches:
        kind = batch.column(4).type
        keys = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
        for key, role, me, root, s in zip(keys, batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist(), shingle_sets(batch.column(6)), strict=True):
            if key != group:
                close()
                group, held = key, []
            held.append((role, me, root, s))
        yield pa.RecordBatch.from_arrays([pa.array(u, kind), pa.array(v, kind)], ["u", "v"])
        u.clear()
        v.clear()
    close()
    if u:
        yield pa.RecordBatch.from_arrays([pa.array(u, kind), pa.array(v, kind)], ["u", "v"])


def _folded(odd: np.ndarray, words: int) -> np.ndarray:
    """odd: bitmaps, one a row, as 64-bit words. The bitmaps of the same sets with fewer buckets."""
    while odd.shape[1] > words:
        half = odd.shape[1] // 2
        odd = odd[:, :half] ^ odd[:, half:]
    return odd


def _maybe(held: list[tuple[int, object, object, object, int, bytes]]) -> Iterator[tuple[object, object, object]]:
    """held: (role, id, root, most, n, odd), outsiders with role 0. (id, root, most) of those with a partner in another component
    that the sizes and bitmaps don't rule out.

    At 75 % similarity at most a seventh of na + nb shingles differ, and each of these changes one bit of a bitmap.
    """
    sides = [[h for h in held if h[0] == role] for role in (0, 1)]
    code = {root: i for i, root in enumerate({h[2] for h in held})}
    hit = [np.zeros(len(side), bool) for side in sides]
    sizes, roots, words = ([np.array([f(h) for h in side], np.int64) for side in sides] for f in (lambda h: h[4], lambda h: code[h[2]], lambda h: len(h[5]) // 8))
    for few in {*words[0].tolist(), *words[1].tolist()}:
        for x, y in ((few, few), (few, 2 * few), (2 * few, few)):
            left, right = (np.flatnonzero(w == k) for w, k in zip(words, (x, y), strict=True))
            if not len(left) or not len(right):
                continue
            odd = [_folded(np.frombuffer(b"".join(side[i][5] for i in at), np.uint64).reshape(len(at), -1), few) for side, at in zip(sides, (left, right), strict=True)]
            step = max(1, (1 << 20) // (len(right) * few))
            for begin in range(0, len(left), step):
                i = left[begin : begin + step]
                differ = np.bitwise_count(odd[0][begin : begin + step, None, :] ^ odd[1][None, :, :]).sum(axis=2, dtype=np.int64)
                na, nb = sizes[0][i][:, None], sizes[1][right][None, :]
                may = ((100 + PERCENT) * differ <= (100 - PERCENT) * (na + nb)) & (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)) & (roots[0][i][:, None] != roots[1][right][None, :])
                hit[0][i] |= may.any(axis=1)
                hit[1][right] |= may.any(axis=0)
    for side, some in zip(sides, hit, strict=True):
        yield from (side[i][1:4] for i in np.flatnonzero(some))


def _sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a group follow each other; a group has about 2 * WIDE rows at most."""
    group, held, out, kinds = None, [], [], []

    def close() -> None:
        out.extend((group[0], *found) for found in _maybe(held))

    def made() -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [()] * 4
        batch = pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["path", "id", "root", "most"])
        out.clear()
        return batch

    for batch in batches:
        kinds = [batch.column(k).type for k in (0, 4, 5, 6)]
        for path, ob, mb, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (path, ob, mb) != group:
                close()
                group, held = (path, ob, mb), []
            held.append(tuple(row))
        yield made()
    close()
    if out:
        yield made()


def _dealt(open_: DataFrame, held: DataFrame, block: int) -> DataFrame:
    """The classes outside the largest component of each node beside all of its classes, in blocks that each are one group of
    rows, as (path, ob, mb, role, id, root, most) and the columns of ``held``, which has a row for each id."""
    blocks = lambda n: F.ceil(F.col(n) / block).cast("int")
    sized = open_.withColumn("blocks", blocks("size")).withColumn("out_blocks", blocks("n_out"))
    place = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "id"), F.col(n)).cast("int")
    out = sized.filter("root <> most").select("path", place(1, "out_blocks").alias("ob"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("mb"), F.lit(0).alias("role"), "id", "root", "most")
    all_ = sized.select("path", F.explode(F.expr("sequence(0, out_blocks - 1)")).alias("ob"), place(2, "blocks").alias("mb"), F.lit(1).alias("role"), "id", "root", "most")
    rows = out.union(all_).join(held, "id").select(*out.columns, *(c for c in held.columns if c != "id"))
    return rows.repartition("path", "ob", "mb").sortWithinPartitions("path", "ob", "mb", "role", "id")


def _in_blocks(texts: DataFrame, open_: DataFrame) -> DataFrame:
    """Links (u, v) that join the components inside each node, exactly: the classes outside its largest component meet
    all of its classes. Texts move, pairs don't."""
    kind = open_.schema["id"].dataType.simpleString()
    return _dealt(open_, texts, BLOCK).drop("most").mapInArrow(trimmed(_cross), f"u {kind}, v {kind}")


def _sieved(bitmaps: DataFrame, open_: DataFrame) -> DataFrame:
    """``open_`` without the classes that can't be linked with another component in their node; bitmaps: (id, n, odd)."""
    path, kind = (open_.schema[c].dataType.simpleString() for c in ("path", "id"))
    found = _dealt(open_, bitmaps, WIDE).mapInArrow(trimmed(_sieve), f"path {path}, id {kind}, root {kind}, most {kind}")
    rows = stage(found.distinct(), "possible")
    sizes = rows.groupBy("path").agg(F.count("*").alias("size"), F.count_if(F.col("root") != F.col("most")).alias("n_out"))
    return join_counted(rows, stage(sizes, "possible"), ["path"], "size")


def _block_links(docs: DataFrame, open_: DataFrame, links: DataFrame, most_texts: int, classes: DataFrame | None = None) -> DataFrame:
    """``links`` and those that join the components inside each node of ``open_``, in turns if more than ``most_texts`` would move.

    With the bitmaps of ``classes`` only the texts move that these don't rule out.
    """
    open_ = stage(open_, "open_blocks")
    if classes is not None:
        bitmaps = stage(_only(classes.select("id", "n", "odd"), open_.select("id")), "bitmaps")
        open_ = stage(_sieved(bitmaps, open_), "open_blocks")
    moved = open_.groupBy("path").agg(F.first("size").alias("size"), F.first("n_out").alias("n_out")).agg(F.sum(_moved())).first()[0]
    if not moved:
        return links
    texts = stage(_texts_of(docs, open_.select(F.col("id").alias("a"), F.col("id").alias("b"))), "texts")
    begin, ends = 0, TURNS if moved > most_texts else TURNS[-1:]
    for end in ends:
        turn = open_.filter(F.pmod(F.xxhash64(F.lit(3), "path"), F.lit(8)).between(begin, end - 1))
        if begin:
            known, nodes = _unsettled(turn.select("path", "id"), links)
            turn = join_counted(known, nodes, ["path"], "size")
            turn = turn if classes is None else _sieved(bitmaps, turn)
        links = components(stage(_in_blocks(texts, turn), "block_links").union(links))
        begin = end
    return links


def link_classes(docs: DataFrame, sift: int = SIFT, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """The staged signatures of ``docs``, and (n, f1, f2, docs, root) of every class: how many rows it has and the first class of its component."""
    signed = stage(signatures(docs), "signatures")
    usable = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stage(usable.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("id"), F.count("*").alias("docs"), F.first("sig").alias("sig"), F.first("low").alias("low"), F.first("odd").alias("odd")), "classes")
    kind, n_classes = classes.schema["id"].dataType.simpleString(), classes.count()
    links = docs.sparkSession.createDataFrame([], f"u {kind}, v {kind}")
    trees = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(TREES).cast("long")))
    rows, more = _branch(classes.select(trees.alias("path"), "id", F.col("id").alias("root"), "sig"), 0), None
    for level in range(levels):
        pairs, large = _pairs_and_rest(rows, level)
        links = _linked(pairs if more is None else pairs.union(more), docs, classes, links, sift, level == 0)
        ways = _open(large, links, n_classes, level == levels - 1)
        for way, group in (("dense", _dense), ("block", lambda nodes: nodes)):
            if way in ways:
                links = _block_links(docs, group(ways[way]), links, n_classes, classes)
        more = _few(ways["few"]) if "few" in ways else None
        if "branch" not in ways:
            links = links if more is None else _linked(more, docs, classes, links, sift)
            break
        rows = _branch(_signed(ways["branch"].select("path", "id", "root"), classes), level + 1)
    return signed, _rooted(classes.select("n", "f1", "f2", "docs", "id"), links).select("n", "f1", "f2", "docs", "root")


def near_duplicates(docs: DataFrame, sift: int = SIFT, levels: int = LEVELS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    sift: equal coordinates that a candidate pair needs to be confirmed; with 0 every candidate is.
    """
    with short_batches(docs.sparkSession):
        signed, roots = link_classes(docs, sift, levels)
        roots = stage(roots, "roots")
    usable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    signed = signed.select("doc_id", "n", "f1", "f2")
    joined = join_counted(signed.filter(usable), roots, ["n", "f1", "f2"], "docs").select("doc_id", "n", "root")
    rows = joined.unionByName(signed.filter(~usable).select("doc_id", "n", F.col("doc_id").alias("root")))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.col("root").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component: that of its smallest ``doc_id``. Of rows that repeat it one stays; rows with a null ``doc_id`` stay."""
    verdicts = stage(near_duplicates(docs.select("doc_id", "text")), "verdicts")
    rest = docs.join(verdicts.filter(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    repeated = verdicts.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return rest
    single = rest.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    return single.unionByName(rest.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"]))


def recall_at_leaf(similarity: float, coordinates: int = TREES + TREES // 3) -> float:
    """Chance that a pair of the given similarity shares at least one first-level node."""
    return 1 - (1 - similarity) ** coordinates


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)
