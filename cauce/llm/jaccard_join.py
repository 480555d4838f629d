"""N-gram Jaccard join: count vectors of hashed shingle groups in a packed R-tree, overlap bounded by summed minima.

A document's set is its distinct word shingles, held as 64-bit hashes. Two sets link when
``100 * intersection >= threshold * union``. The work goes in four steps.

1. Blocks. A linked pair differs in at most ``d`` shingles, and ``d`` follows from the sizes. Shingles are hashed
   into more than ``d`` groups, so a linked pair has a group with equal content. Documents that share a group's
   content meet; sizes fall into classes, and a set enters its own class and the next. No linked pair is missed.
   The same holds for sets less any fixed shingles, since these take no difference to a pair that it did not have. So
   shingles that are frequent in a sample of ``SAMPLE`` texts are left out before grouping: a passage that many documents
   share does not tie them. A set with too few other shingles is keyed both ways, with and without them.
   Inside each task, members of a block are tied to the block's smallest id before the shuffle, so a family of
   copies sends one entry for each key and piece, and no block is ever listed as pairs.
2. Families. The ties are closed to components; every link lies inside one family. Families beyond ``PAGE_SHINGLES``
   are keyed once more, less what is frequent in a sample of their own sets, and so fall apart if they can.
3. Search. Within a family the sets become points of ``GROUPS`` counts, packed into a tree of bounding boxes.
   ``sum(min(count, box maximum))`` bounds the overlap of a set with everything in a box; what survives is
   compared exactly, in bit sets over the shingles that two sets of the family share. A family larger than ``PAGE_SHINGLES`` is
   cut into pages of like sizes; each page is compared within itself and with every page whose sizes allow a link. So every
   linked pair of sets is found, once.
4. Classes. The links that tie unconnected sets are closed to components, named by their smallest document id. A
   document's number of links counts the other documents whose sets link with its own, each copy as one. It is added up
   where the links are found; the links themselves are listed only if asked for (``every="list"``).

Where only the classes are asked for (``every=""``), pairs that links already connect are not compared again, and
a family beyond ``PAGE_SHINGLES`` is first compared with one central member: the members that link to it need no
comparison among themselves.

Defined results: null, empty and wordless texts have no shingles and link with nothing; fewer words than
``width`` make one shingle of the whole sequence; equal texts are one class; a null doc_id takes part, and a class
of null ids only has a null component; repeated rows are documents of their own, each with the class and the number of links;
a very long text is one set like any other; an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.common import components, discard, partitions_for, slices, stored, table, text_batches

GROUPS = 32
LEAF = 16
MEMO = 100_000
FLUSH_ENTRIES = 500_000
PAGE_SHINGLES = 4_000_000
SAMPLE = 5_000
SHARE = 0.05
FREQUENT = 100_000
SEEN = 4
BITS = 64 << 20
U = np.uint64
NO_ID = -(1 << 63)


class WordHashes(dict):
    """64-bit hash of a word; remembers as many words as MEMO, none of them long."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < MEMO and len(word) <= 64:
            self[word] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_set(text: str | None, width: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, U)
    h = np.fromiter(map(memo.__getitem__, words), U, len(words))
    with np.errstate(over="ignore"):
        n = max(1, len(words) - width + 1)
        total = np.full(n, min(width, len(words)), U)
        for k in range(min(width, len(words))):
            total = mix(total * U(0x9E3779B97F4A7C15) + h[k:k + n])
    total.sort()
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


class Blocks:
    """Size classes and the number of groups in each, for a threshold in percent."""

    def __init__(self, threshold: int) -> None:
        self.threshold = threshold
        self.tops = [1]

    def top(self, size_class: int) -> int:
        while len(self.tops) <= size_class:
            self.tops.append(max(100 * (self.tops[-1] + 1) // self.threshold, self.tops[-1] + 1))
        return self.tops[size_class]

    def class_of(self, n: int) -> int:
        while self.tops[-1] < n:
            self.top(len(self.tops))
        return int(np.searchsorted(self.tops, n))

    def most_apart(self, n: int, other: int) -> int:
        return (100 - self.threshold) * (n + other) // (100 + self.threshold)

    def keys(self, s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
        """Block keys of a set: for its class and the next, one for the content of each group.

        Empty groups are no keys as long as the others outnumber the shingles that a linked set may differ in. If that
        holds without the frequent shingles, they are left out; if not, the set is keyed both ways.
        """
        n, found = len(s), []
        rare = s[~_among(s, frequent)]
        own = self.class_of(n)
        for c in (own, own + 1):
            top = self.top(c)
            d = self.most_apart(top, top)
            groups = d + 1 + -(-d // 25)
            apart = self.most_apart(n, min(top, 100 * n // self.threshold))
            keys, full = self._contents(rare, c, groups)
            if full.sum() > apart:
                found.append(keys[full])
                continue
            if len(rare) < n:
                found.append(keys[full])
                keys, full = self._contents(s, c, groups)
            found.append(keys[full] if full.sum() > apart else keys)
        return np.concatenate(found)

    def _contents(self, s: np.ndarray, c: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the contents of all groups, and which groups hold anything."""
        content = np.zeros(groups, U)
        if groups > 1:
            mixed = mix(s + U(2 * c + 1))
            g = (mixed % U(groups)).astype(np.int64)
            np.add.at(content, g, mix(mixed))
        else:
            g, content[0] = np.zeros(len(s), np.int64), mix(s).sum(dtype=U)
        return mix(content + mix(np.arange(groups, dtype=U) + U(c << 32))), np.bincount(g, minlength=groups) > 0


def _among(s: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which values of s are among the sorted ``some``."""
    if not len(some):
        return np.zeros(len(s), bool)
    return some[np.minimum(np.searchsorted(some, s), len(some) - 1)] == s


def _ties(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of entries (key, id): the first id of each key, and ties (id, first id) of the others, each once."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    lead = ids[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
    apart = ids != lead
    pairs = np.unique(np.stack([ids[apart], lead[apart]], 1), axis=0)
    return keys[first], ids[first], pairs[:, 0], pairs[:, 1]


ENTRY = "part int, kind int, a binary, b binary, c binary, d binary"


def _entries(threshold: int, parts: int, frequent: np.ndarray, width: int | None):
    """Documents and block entries out of texts, or, without a width, block entries out of sets (id, shingles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, blocks, seen = WordHashes(), Blocks(threshold), set()
        keys, ids, docs, held = [], [], [], 0
        turn = TaskContext.get().partitionId()  # tasks of one batch each deal their rows over all parts, too

        def rows():
            nonlocal turn
            out = []
            if docs:
                turn += 1
                cols = list(zip(*docs))
                out.append((turn % parts, 0, np.array(cols[0], np.int64).tobytes(), np.array(cols[1], np.int64).tobytes(),
                            np.array(cols[2], U).tobytes(), np.array(cols[3], np.int64).tobytes()))
            if keys:
                k, i, x, y = _ties(np.concatenate(keys), np.concatenate(ids))
                if len(x):
                    out.append((turn % parts, 1, x.tobytes(), y.tobytes(), b"", b""))
                p = (k % U(parts)).astype(np.int64)
                order = np.argsort(p, kind="stable")
                ends = np.searchsorted(p[order], np.arange(parts + 1))
                k, i = k[order], i[order]
                out += [(q, 2, k[ends[q]:ends[q + 1]].tobytes(), i[ends[q]:ends[q + 1]].tobytes(), b"", b"")
                        for q in range(parts) if ends[q] < ends[q + 1]]
            docs.clear(), keys.clear(), ids.clear()
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int32()] * 2 + [pa.binary()] * 4)],
                ["part", "kind", "a", "b", "c", "d"])

        def sets(piece: pa.RecordBatch):
            if width is None:
                for own, shingles in zip(piece.column("id").to_pylist(), piece.column("shingles").to_pylist()):
                    yield own & (1 << 64) - 1, np.frombuffer(shingles, U)
                return
            for doc_id, text, th in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "th"))):
                s = shingle_set(text, width, memo)
                own = int(mix(s).sum(dtype=U) ^ U(len(s))) if len(s) else 0
                docs.append((NO_ID if doc_id is None else doc_id, th, own, len(s)))
                yield own, s

        for piece in slices(batches):
            for own, s in sets(piece):
                if len(s) and own not in seen:
                    if len(seen) < MEMO:
                        seen.add(own)
                    keys.append(blocks.keys(s, frequent))
                    ids.append(np.full(len(keys[-1]), own, U))
                    held += len(keys[-1])
                if held >= FLUSH_ENTRIES or len(docs) >= 10_000:
                    yield rows()
                    held = 0
        if docs or keys:
            yield rows()
    return run


def _counted(width: int | None):
    """(s, n): in how many sets of a piece a shingle stands, out of texts or, without a width, out of sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for piece in slices(batches, 128):
            made = [np.frombuffer(x, U) for x in piece.column("shingles").to_pylist()] if width is None else [
                shingle_set(t, width, memo) for t in piece.column("text").to_pylist()]
            values, times = np.unique(np.concatenate(made), return_counts=True) if made else (np.empty(0, U), np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(times)], ["s", "n"])
    return run


def _frequent(rows: DataFrame, by: str, width: int | None) -> np.ndarray:
    """Sorted shingles that at least SEEN rows of a sample hold, at most the FREQUENT most frequent.

    Whatever the sample holds, no link is lost; it decides only how many sets meet in vain. It grows with the rows, so that
    a passage is found from a number of documents on that does not grow: below it, the documents of one passage rarely have
    a group of their own in common, above it, they tie families of many passages together, whose pages meet in pairs.
    """
    share = min(1.0, max(SHARE, SAMPLE / max(rows.count(), 1)))
    some = rows.where(F.pmod(F.xxhash64(F.lit("sample"), by), F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates([by])
    found = some.mapInArrow(_counted(width), "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= SEEN).orderBy(
        F.desc("n"), "s").limit(FREQUENT).select("s").toPandas()
    return np.sort(found.s.to_numpy(np.int64).view(U))


def _gathered(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    out = []
    for kind, types in ((0, "a b c d"), (1, "a b")):
        part = frame[frame.kind == kind]
        if len(part):
            cols = [np.frombuffer(b"".join(part[c]), np.int64) for c in types.split()]
            zero = np.zeros(len(cols[0]), np.int64)
            out.append(pd.DataFrame({"kind": kind, "x": cols[0], "y": cols[1], "id": cols[2] if kind == 0 else zero,
                                     "n": cols[3] if kind == 0 else zero}))
    part = frame[frame.kind == 2]
    if len(part):
        _, _, x, y = _ties(np.frombuffer(b"".join(part.a), U), np.frombuffer(b"".join(part.b), U))
        out.append(pd.DataFrame({"kind": 1, "x": x.view(np.int64), "y": y.view(np.int64), "id": 0, "n": 0}))
    return pd.concat(out)


class CountTree:
    """Packed R-tree over count vectors: boxes of LEAF entries, level upon level."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, threshold: int) -> None:
        self.threshold = threshold
        self.levels = [(counts, sizes, sizes)]
        while len(self.levels[-1][0]) > LEAF:
            tops, low, high = self.levels[-1]
            at = np.arange(0, len(tops), LEAF)
            self.levels.append((np.maximum.reduceat(tops, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def search(self, point: np.ndarray, size: int, after: int) -> np.ndarray:
        """Entries beyond position ``after`` whose bound on the overlap still allows a link."""
        at = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            tops, low, high = self.levels[level]
            at = at[(at + 1) * LEAF ** level - 1 > after]
            bound = np.minimum(tops[at], point).sum(1)
            t = self.threshold
            at = at[(100 * high[at] >= t * size) & (100 * size >= t * low[at])
                    & ((100 + t) * bound >= t * (size + np.maximum(low[at], -(-t * size // 100))))]
            if level:
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < len(self.levels[level - 1][0])]
        return at


class Overlaps:
    """Sizes of intersections with one of the sets: over bit sets if they are shorter than the lists, else over the lists.

    Only shingles that two sets of the family share count.
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        sizes = np.array([len(s) for s in sets])
        values, ranks, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times > 1
        new, wide = np.cumsum(shared) - 1, int(shared.sum())
        self.ranks = [new[r[shared[r]]].astype(np.int32) for r in np.split(ranks, np.cumsum(sizes)[:-1])]
        self.sizes = np.array([len(r) for r in self.ranks])
        words = -(-wide // 64)
        self.bits = None
        if words * len(sets) * 8 <= BITS and words <= max(self.sizes.mean(), 1):
            self.bits = np.zeros((len(sets), words), U)
            row = np.zeros(64 * words, np.uint8)
            for k, r in enumerate(self.ranks):
                row[r] = 1
                self.bits[k] = np.packbits(row).view(U)
                row[r] = 0
        else:
            self.own = np.zeros(wide + 1, np.uint8)

    def with_one(self, q: int, near: np.ndarray) -> np.ndarray:
        out = np.zeros(len(near), np.int64)
        if self.bits is not None:
            step = max(1, (1 << 20) // max(self.bits.shape[1], 1))
            for at in range(0, len(near), step):
                out[at:at + step] = np.bitwise_count(self.bits[near[at:at + step]] & self.bits[q]).sum(1, dtype=np.int64)
            return out
        self.own[self.ranks[q]] = 1
        some = near[self.sizes[near] > 0]
        if len(some):
            starts = np.concatenate(([0], np.cumsum(self.sizes[some])[:-1]))
            out[self.sizes[near] > 0] = np.add.reduceat(self.own[np.concatenate([self.ranks[c] for c in some])], starts, dtype=np.int64)
        self.own[self.ranks[q]] = 0
        return out


def family_links(sets: list[np.ndarray], threshold: int, side: np.ndarray, every: bool) -> Iterator[tuple]:
    """Links among the sets: (position, positions that link with it, which of these links tie what was not connected).

    Sets of an equal ``side`` that is not negative are not compared. All links once, or if not ``every`` as many as
    have the same closure.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    counts = np.stack([np.bincount((mix(s) & U(GROUPS - 1)).astype(np.int64), minlength=GROUPS) for s in sets])
    overlaps = Overlaps(sets)
    order = np.lexsort((*counts.T[:2], sizes))
    tree = CountTree(counts[order], sizes[order], threshold)
    root = np.arange(m)
    for k in range(m):
        q = order[k]
        near = order[tree.search(counts[q], sizes[q], k)]
        near = near[(side[near] != side[q]) | (side[near] < 0)]
        if not every:
            near = near[root[near] != root[q]]
        if not len(near):
            continue
        both = overlaps.with_one(q, near)
        found = near[100 * both >= threshold * (sizes[q] + sizes[near] - both)]
        tie = np.zeros(len(found), bool)
        for i in np.flatnonzero(root[found] != root[q]):
            if root[found[i]] != root[q]:
                root[root == root[found[i]]] = root[q]
                tie[i] = True
        if len(found):
            yield q, found, tie


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for piece in slices(batches, 128):
            made = [shingle_set(t, width, memo).tobytes() for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("family", "id", "n", "copies", "total")), pa.array(made, pa.binary())],
                                             ["family", "id", "n", "copies", "total", "shingles"])
    return run


LINK = "a long, b long, others long, tie boolean"  # others: documents that link with a; 0 for rows that list a link


def _family_task(threshold: int, every: str):
    """Listed links (of ``every="list"`` all, else those that tie), and the number of links of each set if asked for (``"count"``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame, out, held = pd.concat(list(batches)).drop_duplicates(["family", "id"]), [], 0
        for _, own in frame.groupby("family"):
            ids, copies, others = own.id.to_numpy(), own.copies.to_numpy(), np.zeros(len(own), np.int64)
            for q, found, tie in family_links([np.frombuffer(x, U) for x in own.shingles], threshold, own.side.to_numpy(), bool(every)):
                others[q] += copies[found].sum()
                others[found] += copies[q]
                some = slice(None) if every == "list" else tie
                if len(found[some]):
                    out.append(pd.DataFrame({"a": ids[q], "b": ids[found[some]], "others": 0, "tie": tie[some]}))
                    held += len(found[some])
            if every == "count" and others.any():
                out.append(pd.DataFrame({"a": ids, "b": ids, "others": others, "tie": False})[others > 0])
                held += len(ids)
            if held >= FLUSH_ENTRIES:
                yield pd.concat(out)
                out, held = [], 0
        if out:
            yield pd.concat(out)
    return run


def _with_pivot(threshold: int):
    def run(members: pd.DataFrame, pivot: pd.DataFrame) -> pd.DataFrame:
        members = members[["family", "id", "n", "copies", "shingles"]]
        if not len(members):
            return members.assign(pivot=0, pivot_copies=0, linked=False)
        b, hit = np.frombuffer(pivot.shingles.iloc[0], U), []
        for x in members.shingles:
            a = np.frombuffer(x, U)
            both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            hit.append(100 * both >= threshold * (len(a) + len(b) - both))
        return members.assign(pivot=pivot.id.iloc[0], pivot_copies=pivot.copies.iloc[0], linked=hit)
    return run


def _met(rows: DataFrame, threshold: int, parts: int, frequent: np.ndarray, width: int | None) -> DataFrame:
    """Documents (kind 0: x = doc_id, y = hash of the text, id, n) and ties (kind 1: x, y) out of texts or sets."""
    entries = rows.mapInArrow(_entries(threshold, parts, frequent, width), ENTRY)
    return stored(entries.repartition(parts, "part").groupBy("part").applyInPandas(
        _gathered, "kind int, x long, y long, id long, n long").coalesce(-(-parts // 4)), "jaccard-blocks")


def _families(met: DataFrame) -> DataFrame:
    return components(met.where("kind = 1").select(F.col("x").alias("a"), F.col("y").alias("b")), "jaccard-families")


SET = "family long, id long, n long, copies long, total long, shingles binary"


def _smaller(large: DataFrame, threshold: int, parts: int) -> DataFrame:
    """Sets of large families with the families that are left of them without what is frequent in their own sample."""
    named = _families(_met(large.select("id", "shingles"), threshold, parts, _frequent(large.select("id", "shingles"), "id", None), None))
    again = large.drop("family", "total").join(named.select("id", F.col("component").alias("family")), "id")
    totals = again.groupBy("family").agg(F.sum("n").alias("total"))
    return stored(again.join(totals, "family").select("family", "id", "n", "copies", "total", "shingles"), "jaccard-sets")


def ngram_links(docs: DataFrame, width: int = 4, threshold: int = 85, every: str = "list") -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, th, id, n), (links a, b between ids of different sets). ``id`` names a distinct set.

    With ``every="list"`` each linked pair is listed once; the links with ``tie`` have the closure of all. With ``"count"`` only these are
    listed, and rows of a set with itself say how many documents link with it (``others``; several rows of a set add
    up). With ``""`` pairs already connected are left out, and nothing is counted.
    """
    parts = 4 * partitions_for(text_batches(docs))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    met = _met(texts, threshold, parts, _frequent(texts.select("th", "text"), "th", width), width)
    known = met.where("kind = 0").select(F.col("x").alias("doc_id"), F.col("y").alias("th"), "id", "n")
    family = _families(met)
    one = known.where("n > 0").groupBy("id").agg(F.min(F.struct("doc_id", "th")).alias("one"), F.first("n").alias("n"), F.count("*").alias("copies"))
    members = one.join(family, "id").select(F.col("component").alias("family"), "id", "n", "copies", "one.*")
    sizes = members.groupBy("family").agg(F.sum("n").alias("total"))
    members = stored(members.join(sizes, "family"), "jaccard-members")
    # what repeats doc_id and text is one set; a join of one kind at every size
    chosen = texts.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))).dropDuplicates(["doc_id", "th"]).join(
        members.hint("merge"), ["doc_id", "th"])
    sets = stored(chosen.select("family", "id", "n", "copies", "total", "text").mapInArrow(_sets(width), SET), "jaccard-sets")
    discard(members, family)
    large = sets.where(F.col("total") > PAGE_SHINGLES)
    small, paged = sets.where(F.col("total") <= PAGE_SHINGLES), None
    if not large.isEmpty():
        large = _smaller(large, threshold, parts)
        small = small.unionByName(large.where(F.col("total") <= PAGE_SHINGLES))
        paged = large.where(F.col("total") > PAGE_SHINGLES)
    bins = max(1, int((small.agg(F.sum("n")).first()[0] or 0) // PAGE_SHINGLES), parts)
    links = small.select("family", "id", "copies", "shingles", F.lit(-1).alias("side"),
                         F.pmod(F.xxhash64("family"), F.lit(bins)).alias("bin")).groupBy(
        "bin").applyInPandas(_family_task(threshold, every), LINK)
    if paged is not None and not paged.isEmpty():
        links = links.unionByName(_large_links(paged, threshold, every))
    links = stored(links, "jaccard-links")
    discard(sets, large)
    return known, links


def _central_links(large: DataFrame, threshold: int) -> DataFrame:
    """The members of each family with its central one, and whether they link with it."""
    middle = large.groupBy("family").agg(F.avg("n").alias("mean"))
    pivots = large.join(middle, "family").groupBy("family", "total").agg(
        F.min_by(F.struct("id", "copies", "shingles"), F.struct(F.abs(F.col("n") - F.col("mean")), "id")).alias("p"))
    salts = F.ceil(F.col("total") / F.lit(PAGE_SHINGLES)).cast("long")
    dealt = large.withColumn("salt", F.pmod(F.xxhash64("id"), salts))
    sent = stored(pivots, "jaccard-central").select("family", "p.*", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"))
    return stored(dealt.groupBy("family", "salt").cogroup(sent.groupBy("family", "salt")).applyInPandas(
        _with_pivot(threshold), "family long, id long, n long, copies long, shingles binary, pivot long, pivot_copies long, linked boolean"),
        "jaccard-pivots")


def _large_links(large: DataFrame, threshold: int, every: str) -> DataFrame:
    """Links of families beyond one page: page by page, if not ``every`` after all members against a central one."""
    tried = large.withColumn("linked", F.lit(False)) if every else _central_links(large, threshold)
    ratio = float(np.log(100 / threshold)) * (1 + 1e-9)  # sizes just in reach of each other are never two bands apart
    banded = tried.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(ratio)))
    counts = stored(banded.groupBy("family", "band", "linked").agg(
        F.ceil(F.sum("n") / F.lit(PAGE_SHINGLES / 2)).alias("pages")), "jaccard-pages")
    paged = banded.join(counts, ["family", "band", "linked"]).withColumn("page", F.pmod(F.xxhash64("id"), F.col("pages")))
    pages = counts.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages") - 1)))
    p, q = pages.alias("p"), pages.alias("q")
    order = lambda x: F.struct(f"{x}.linked", f"{x}.band", f"{x}.page")
    sided = lambda x, side: F.struct(f"{x}.linked", f"{x}.band", f"{x}.page", F.lit(side).alias("side"))
    pairs = p.join(q, (F.col("p.family") == F.col("q.family")) & ~(F.col("p.linked") & F.col("q.linked"))
                   & (F.abs(F.col("p.band") - F.col("q.band")) <= 1) & (order("p") <= order("q"))).select(
        F.col("p.family").alias("family"), F.xxhash64("p.family", order("p"), order("q")).alias("task"),
        F.when(order("p") == order("q"), F.array(sided("p", -1))).otherwise(F.array(sided("p", 0), sided("q", 1))).alias("of"))
    placed = stored(pairs.select("family", "task", F.explode("of").alias("o")).select("family", "task", "o.*"), "jaccard-tasks").join(
        paged, ["family", "linked", "band", "page"]).select("family", "task", "id", "copies", "side", "shingles")
    links = placed.groupBy("task").applyInPandas(_family_task(threshold, every), LINK)
    if every:
        return links
    return links.unionByName(tried.where("linked and id != pivot").select(
        F.col("pivot").alias("a"), F.col("id").alias("b"), F.lit(0).cast("long").alias("others"), F.lit(True).alias("tie")))


def _classed(known: DataFrame, links: DataFrame) -> DataFrame:
    """Adds cls, the class of a document's set, to doc_id (NO_ID for null), th (hash of the text), id and n."""
    classes = components(links.where("tie"), "jaccard-classes")
    return known.join(classes, "id", "left").withColumn("cls", F.coalesce("component", "id")).drop("component")


def ngram_classes(docs: DataFrame, width: int = 4, threshold: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, n_links (other documents that link with it), component_id (smallest
    doc_id of its class)."""
    known, links = ngram_links(docs, width, threshold, "count")
    real = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    ids = known.where("n > 0").groupBy("id").agg(F.count("*").alias("copies"), F.min(real).alias("least"))
    classes = components(links.where("tie"), "jaccard-classes")
    sets = stored(ids.join(classes, "id", "left").withColumn("cls", F.coalesce("component", "id")).drop("component"), "jaccard-named")
    least = stored(sets.groupBy("cls").agg(F.min("least").alias("component_id")), "jaccard-least")
    others = links.where("others > 0").groupBy(F.col("a").alias("id")).agg(F.sum("others").alias("others"))
    found = stored(sets.join(least, "cls").join(others, "id", "left").select(
        "id", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "jaccard-found")
    discard(classes, sets, least)
    out = [real.alias("doc_id"), F.col("n").alias("n_shingles"), "n_links", "component_id"]
    return known.where("n > 0").join(found, "id").select(*out).unionByName(
        known.where("n = 0").withColumn("component_id", real).withColumn("n_links", F.lit(0).cast("long")).select(*out))


def first_of_each(docs: DataFrame, width: int = 4, threshold: int = 85) -> DataFrame:
    """One document of each class: that of the smallest doc_id, null ids last, then of the smallest text hash.

    A row is known by doc_id and text: rows that repeat both go, different texts under one doc_id (or under none)
    are different documents. Documents without shingles link with nothing and stay.
    """
    named = stored(_classed(*ngram_links(docs, width, threshold, every="")), "jaccard-named")
    one = named.where("n > 0").groupBy("cls").agg(
        F.min(F.struct((F.col("doc_id") == NO_ID).alias("unnamed"), "doc_id", "th")).alias("one")).select("one.doc_id", "one.th")
    kept = one.unionByName(named.where("n = 0").select("doc_id", "th").distinct()).toDF("_id", "_th")
    rows = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("_row"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_th"))
    return rows.join(kept, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"]).select("_row.*")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS g FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t(r, m) AS (SELECT r, doc_id FROM d UNION SELECT e.b, t.m FROM t JOIN e ON e.a = t.r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT count(*) FROM e WHERE e.a = d.r) AS n_links,
  (SELECT min(m) FROM t WHERE t.r = d.r) AS component_id FROM d LEFT JOIN n ON n.r = d.r
"""
