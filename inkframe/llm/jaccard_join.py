"""Exact set-similarity self-join of documents on word shingles, in the Jaccard metric.

A document is the set of its distinct k-word shingles; two documents link when their Jaccard similarity
is at least t, that is when their distance is at most r = 1 - t. The join goes from coarse to fine:

1. Regions find who may link at all. All documents order the shingles alike, commonest last, and a document
   enters the regions of its first n - ceil(t n) + 1 shingles; linked documents meet in at least one.
2. In a region a table of parity bits bounds distances from below: the universe is split by hash into parts, and
   of each part the last bit of a document's count is kept. Documents that the bounds connect there are joined
   by a spanning forest, so a region of g documents emits less than g rows.
3. Documents that forests connect are a cluster; links do not leave it. Clusters are dealt into blocks of about the
   square root of their size, and each document's set is sent to the blocks once: first each block by itself with the
   cluster's pivot, then, where the cluster is still in pieces, all pairs of blocks.
4. A block is joined in the metric space: pivots are chosen among its documents, far from each other; exact distances
   to them make Voronoi cells, each document's home being its nearest pivot. A document is copied to the cells whose
   pivot is at most 2 r farther than its home's: by the triangle inequality all links across a border meet there.
   Cells are divided again with pivots of their own, until that no longer helps.
5. What is left is swept by windows: documents whose distances to some pivot differ by more than r cannot link, two that
   are together at most r away from a pivot do; all others are decided by exact intersection. What leaves a block are
   the links that join components, and if asked for the number of links of each document: never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .components import components
from .hashing import U, chunks, folded, mix, text_buffers, trimmed, word_hashes
from .scratch import Scratch

#: Least bits of a row of the parity table; larger sets have as many bits as shingles, or up to twice as many.
PARTS = 256
#: Part of the documents whose shingles tell which are common, and the count there that makes one so.
#: This only sets the order of the shingles and whose regions are counted before they meet; the links are the same in any case.
ORDER_PART, COMMON, COMMON_KEPT = 8, 5, 1 << 19
#: A region of more documents is divided into pairs of blocks of so many.
REGION_BLOCK = 4096
#: Least documents of a block of a cluster, and shingles that a block holds at most if it has several documents.
BLOCK, BLOCK_SHINGLES = 48, 1 << 19
#: Pivots of a block or cell, and the size from which it is swept without being divided.
PIVOTS, LEAF = 8, 24
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLDED = folded()
_FACTORS = mix(np.arange(1, 65, dtype=U)) | U(1)


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than k words are one shingle, none is the empty set."""
    words, first = word_hashes(data, at, _SPACE, _FOLDED)
    if len(words) >= k:
        run = sum(words[j : len(words) - k + 1 + j] * _FACTORS[j] for j in range(k))
        run = mix(run + U(k))
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            s = np.sort(run[a : b - k + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
        elif b > a:
            yield mix(np.array([(words[a:b] * _FACTORS[: b - a]).sum() + U(int(b - a) << 32)], U))
        else:
            yield np.zeros(0, U)


def class_of(s: np.ndarray) -> int:
    """The same for equal sets."""
    return int(mix(np.array([mix(s ^ U(0x5851F42D4C957F2D)).sum() + U(len(s))], U)).view(np.int64)[0])


def _sampled_counts(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = [s for batch in batches for part in chunks(batch, "text") for s in shingle_sets(*text_buffers(part.column("text")), k)]
        if sets:
            s, n = np.unique(np.concatenate(sets), return_counts=True)
            s, n = s[n > 1], n[n > 1]
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(n.astype(np.int64))], ["shingle", "n"])

    return trimmed(run)


def common_pivots(docs: DataFrame, k: int) -> np.ndarray:
    """Shingles that recur in a fixed part of the corpus, rarest first; at most COMMON_KEPT (4 MB), as the order is free."""
    part = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ORDER_PART)) == 0).select("text")
    counts = part.mapInArrow(_sampled_counts(k), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    rows = counts.orderBy(F.desc("n"), "shingle").limit(COMMON_KEPT).toArrow()
    return rows.column("shingle").to_numpy().view(U)[::-1].copy()


def _window(s: np.ndarray, keys: np.ndarray, ranks: np.ndarray, num: int, den: int) -> np.ndarray:
    """The regions of a document with shingle set s (see 1 above)."""
    n = len(s)
    if not n or 2 * n * (den - num) // (den + num) == 0 and (2 * n + 1) * (den - num) // (den + num) == 0:
        return np.zeros(0, U)  # no other set can be so near
    reach = n - -(-n * num // den) + 1
    if not len(keys):
        return s[:reach]
    found = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
    common = keys[found] == s
    rare = s[~common]
    if len(rare) >= reach:
        return rare[:reach]
    hot = s[common][np.argsort(ranks[found[common]], kind="stable")]
    return np.concatenate([rare, hot[: reach - len(rare)]])


def _bits(s: np.ndarray) -> bytes:
    """The row of the pivot table; the number of bits is a power of 2, and halves of it fold into a shorter row."""
    size = max(PARTS, 1 << (len(s) - 1).bit_length())
    odd = np.bincount((s & U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class _Rows:
    """Rows of a table of whole regions, with a fast test of which may link."""

    def __init__(self, table: pa.Table, num: int, den: int):
        self.region, self.cls, self.n = (table.column(c).to_numpy() for c in ("region", "cls", "n"))
        self.num, self.den = num, den
        raw = table.column("bits").to_pylist()
        self.size = np.array([len(b) for b in raw])
        self.place = np.empty(len(raw), np.int64)
        self.bits = {}
        for size in np.unique(self.size).tolist():
            at = np.flatnonzero(self.size == size)
            self.place[at] = np.arange(len(at))
            self.bits[size] = np.frombuffer(b"".join(raw[i] for i in at), np.uint64).reshape(len(at), -1)

    def near(self, i: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of rows that may link to i, by size and by the pivot table, and their distances in it."""
        n, own = self.n[rows], self.n[i]
        fits = np.minimum(n, own) * self.den >= np.maximum(n, own) * self.num
        rows = rows[fits]
        limit = (self.n[rows] + own) * (self.den - self.num) // (self.den + self.num)
        apart = np.empty(len(rows), np.int64)
        mine = self.bits[int(self.size[i])][self.place[i]]
        for size in np.unique(self.size[rows]).tolist():
            at = np.flatnonzero(self.size[rows] == size)
            a, b = mine, self.bits[size][self.place[rows[at]]]
            while len(a) > b.shape[1]:
                a = a[: len(a) // 2] ^ a[len(a) // 2 :]
            while b.shape[1] > len(a):
                b = b[:, : b.shape[1] // 2] ^ b[:, b.shape[1] // 2 :]
            apart[at] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
        good = apart <= limit
        return rows[good], apart[good]


def _described(k: int, num: int, den: int, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = hot.value
        by = np.argsort(order)
        keys, ranks = order[by], by
        told: set[int] = set()
        for batch in batches:
            for part in chunks(batch, "text"):
                n, cls, table, regions, common = [], [], [], [], []
                named = part.column("doc_id").is_valid().to_pylist()
                for s, has_id in zip(shingle_sets(*text_buffers(part.column("text")), k), named, strict=True):
                    n.append(len(s))
                    c = class_of(s)
                    cls.append(c)
                    if c in told or not len(s) or not has_id:
                        table.append(None)
                        regions.append(None)
                        common.append(None)
                        continue
                    if len(told) < 1 << 17:
                        told.add(c)
                    table.append(_bits(s))
                    own = _window(s, keys, ranks, num, den)
                    often = keys[np.minimum(np.searchsorted(keys, own), len(keys) - 1)] == own if len(keys) else np.zeros(len(own), bool)
                    regions.append(own[~often].view(np.int64))
                    common.append(own[often].view(np.int64))
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (regions, common)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(table, pa.binary()), *lists], ["doc_id", "n", "cls", "bits", "regions", "common"])

    return trimmed(run)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by key."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(group, group[-1]))
        if cut and rest:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        elif rest and rest[-1].column(key)[-1].as_py() != group[0]:
            yield pa.Table.from_batches(rest)
            rest = [batch]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)


def _forest(num: int, den: int):
    """Edges that connect, region by region, what the parity bits do not keep apart: a spanning forest of each region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        out: list[tuple[int, int]] = []
        for table in _groups(batches, "region"):
            t = _Rows(table, num, den)
            edges = np.flatnonzero(np.r_[True, t.region[1:] != t.region[:-1], True])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                apart = np.arange(a, b)
                while len(apart) > 1:
                    reached, apart = [int(apart[0])], apart[1:]
                    while reached and len(apart):
                        i = reached.pop()
                        near, _ = t.near(i, apart)
                        if len(near):
                            out += [(t.cls[i], t.cls[x]) for x in near]
                            reached += near.tolist()
                            apart = np.setdiff1d(apart, near, assume_unique=True)
                if len(out) > 50_000:
                    yield from _told(out, seen)
                    out = []
        yield from _told(out, seen)

    return trimmed(run)


def _told(pairs: list[tuple[int, int]], seen: set[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    fresh = {(int(min(p)), int(max(p))) for p in pairs} - seen
    if len(seen) < 1 << 16:
        seen |= fresh
    if fresh:
        a, b = zip(*fresh, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


class MetricJoin:
    """The exact join of a block of sets (steps 4 and 5 above).

    comp: component of each set so far. side: sets with the same value from 0 on are not compared, with -1 all are; 2 marks the
    pivot of a cluster, whose links join components but do not count. Links found between components are in `links` (indices);
    with counting, n_links has the links of each set, weighted by the other's weight.
    """

    def __init__(self, sets: list[np.ndarray], comp: np.ndarray, side: np.ndarray, weight: np.ndarray, num: int, den: int, counting: bool):
        self.num, self.den, self.counting, self.side, self.weight = num, den, counting, side, weight
        self.size = np.array([len(s) for s in sets])
        self.at = np.r_[0, np.cumsum(self.size)]
        vocabulary, ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.ids, self.mark = ids.astype(np.int32), np.zeros(len(vocabulary), bool)
        self.root = np.unique(comp, return_inverse=True)[1]
        self.links: list[tuple[int, int]] = []
        self.n_links = np.zeros(len(sets), np.int64)
        rows = np.arange(len(sets))
        self.divide(rows, np.ones(len(sets), bool), self.gathered(rows))

    def gathered(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of sets one after the other, and where each begins."""
        if len(rows) == len(self.size):
            return self.ids, self.at[:-1]
        return np.concatenate([self.ids[self.at[i] : self.at[i + 1]] for i in rows]), np.cumsum(self.size[rows]) - self.size[rows]

    def common(self, p: int, held: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Sizes of the intersections of set p with the gathered ones."""
        own = self.ids[self.at[p] : self.at[p + 1]]
        self.mark[own] = True
        out = np.add.reduceat(self.mark[held[0]], held[1], dtype=np.int64)
        self.mark[own] = False
        return out

    def link(self, p: int, rows: np.ndarray) -> None:
        """p links to rows."""
        if self.counting:
            told = rows[(self.side[rows] != 2) & (self.side[p] != 2)]
            self.n_links[told] += self.weight[p]
            self.n_links[p] += self.weight[told].sum()
        for i in rows.tolist():
            if self.root[i] != self.root[p]:
                self.links.append((p, i))
                self.root[self.root == self.root[i]] = self.root[p]

    def open(self, p: int, rows: np.ndarray) -> np.ndarray:
        """Which rows are to be compared with p."""
        out = (self.side[rows] != self.side[p]) | (self.side[rows] < 0)
        if not self.counting:
            out &= self.root[rows] != self.root[p]
        return out

    def divide(self, rows: np.ndarray, own: np.ndarray, held: tuple[np.ndarray, np.ndarray]) -> None:
        """All links of rows a before b where own[b]."""
        if not self.counting and (self.root[rows] == self.root[rows[0]]).all():
            return
        reach = 1 - self.num / self.den
        far = np.full(len(rows), np.inf)
        d = np.empty((min(PIVOTS, len(rows)) if len(rows) > LEAF else min(1, len(rows) - 1), len(rows)))
        for k in range(len(d)):
            p = int(rows[np.argmax(far)])
            same = self.common(p, held)
            d[k] = 1 - same / (self.size[rows] + self.size[p] - same)
            far = np.minimum(far, d[k])
        if len(rows) > LEAF:
            home = np.argmin(d, axis=0)
            cells = [np.flatnonzero((home == c) | (d[c] <= d.min(axis=0) + 2 * reach + 1e-9)) for c in range(len(d))]
            if max(map(len, cells)) <= 0.75 * len(rows):
                for c, cell in enumerate(cells):
                    if len(cell) > 1 and (mine := own[cell] & (home[cell] == c)).any():
                        self.divide(rows[cell], mine, self.gathered(rows[cell]))
                return
        for k in range(len(rows) - 1):
            p, later = int(rows[k]), slice(k + 1, None)
            fits = own[later] & self.open(p, rows[later]) & (np.minimum(self.size[rows[later]], self.size[p]) * self.den >= np.maximum(self.size[rows[later]], self.size[p]) * self.num)
            if len(d):
                fits &= (np.abs(d[:, later] - d[:, k : k + 1]) <= reach + 1e-9).all(axis=0)
            if not fits.any():
                continue
            other = rows[later][fits]
            sure = (d[:, later][:, fits] + d[:, k : k + 1] <= reach - 1e-9).any(axis=0) if len(d) else np.zeros(len(other), bool)
            doubtful = other[~sure]
            if len(doubtful):
                same = self.common(p, (held[0], held[1]) if 2 * len(doubtful) > len(rows) else self.gathered(doubtful))
                same = same[later][fits][~sure] if 2 * len(doubtful) > len(rows) else same
                doubtful = doubtful[self.den * same >= self.num * (self.size[doubtful] + self.size[p] - same)]
            self.link(p, np.concatenate([other[sure], doubtful]))


def _solved(num: int, den: int, counting: bool):
    """Each block's links between components, as (a, b, 0, 0), and link counts, as (a, null, part, 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "block"):
            block, cls, comp, side, weight = (table.column(c).to_numpy() for c in ("block", "cls", "comp", "side", "weight"))
            raw = [x for c in table.column("shingles").chunks for x in c]
            edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                rows = a + np.unique(cls[a:b], return_index=True)[1]  # a repeated row brings its set twice
                if len(rows) < 2:
                    continue
                join = MetricJoin([np.frombuffer(raw[i].as_buffer(), U) for i in rows], comp[rows], side[rows], weight[rows], num, den, counting)
                own = cls[rows]
                out = [(int(own[x]), int(own[y]), 0) for x, y in join.links]
                out += [(int(own[i]), None, int(join.n_links[i])) for i in np.flatnonzero(join.n_links).tolist()]
                if out:
                    x, y, n = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"])

    return trimmed(run)


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                # where a doc_id has several texts, each class takes its own
                found = [(c, s) for c, s in zip(part.column("cls").to_pylist(), shingle_sets(*text_buffers(part.column("text")), k), strict=True) if class_of(s) == c]
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([s.tobytes() for _, s in found], pa.binary())], ["cls", "shingles"])

    return trimmed(run)


def _near_in_size(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Rows (region, cls, n) of regions of at most REGION_BLOCK rows, without those that no other class of the region is near to in size, as these have
    no link there; with the number of classes of the region."""
    over = Window.partitionBy("region")
    met = rows.select("*", F.min("cls").over(over).alias("low"), F.max("cls").over(over).alias("high"))
    met = met.where("low < high").select("region", "cls", "n").distinct()
    by_size = over.orderBy("n", "cls")
    met = met.select("*", F.lag("n").over(by_size).alias("less"), F.lead("n").over(by_size).alias("more"), F.count("*").over(over).alias("size"))
    return met.where(_near("less", "n", num, den) | _near("n", "more", num, den)).select("region", "cls", "n", "size")


def _near(small: str, large: str, num: int, den: int) -> Column:
    return F.coalesce(F.col(small) * den >= F.col(large) * num, F.lit(False))


def _near_in_hot(rows: DataFrame, num: int, den: int) -> DataFrame:
    """The same of larger regions. Windows see the different sizes of a region only, counted before they meet; a row is joined with what is known
    of its region and size, which many tasks can do for one region."""
    met = rows.distinct()
    over = Window.partitionBy("region")
    by_size = over.orderBy("n")
    sizes = met.groupBy("region", "n").agg(F.count("*").alias("equal"))
    sizes = sizes.select("*", F.lag("n").over(by_size).alias("less"), F.lead("n").over(by_size).alias("more"), F.sum("equal").over(over).alias("size"))
    sizes = sizes.where((F.col("equal") > 1) | _near("less", "n", num, den) | _near("n", "more", num, den)).select("region", "n", "size")
    return met.join(sizes, ["region", "n"]).select("region", "cls", "n", "size")


def _described_regions(docs: DataFrame, words: int, num: int, den: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their class, classes, and the regions in which classes meet.

    A region of many documents is one of a common shingle, as these recur in a part of the corpus too: only such regions are counted, and the few
    that are large (at most COMMON_KEPT) are broadcast, so that rows of regions are exchanged once. A large region of another shingle, should the part
    have missed it or COMMON_KEPT cut it off, meets in one task like a small one, with the same result.
    """
    spark = docs.sparkSession
    hot = spark.sparkContext.broadcast(common_pivots(docs, words))
    told = scratch.write(docs.mapInArrow(_described(words, num, den, hot), "doc_id long, n long, cls long, bits binary, regions array<long>, common array<long>"), "told")
    classes = told.where("n > 0 and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count("*").alias("weight"), F.max("n").alias("n"), F.max("bits").alias("bits"))
    classes = scratch.write(classes, "classes")
    named = told.where("doc_id is not null")
    hot_ones = named.select(F.explode("common").alias("region")).groupBy("region").count().where(F.col("count") > REGION_BLOCK).select("region")
    hot_ones = F.broadcast(scratch.write(hot_ones, "hot"))
    rows = named.select(F.explode(F.concat("regions", "common")).alias("region"), "cls", "n").join(hot_ones, "region", "left_anti")
    hot_rows = named.select(F.explode("common").alias("region"), "cls", "n").join(hot_ones, "region", "left_semi")
    met = _near_in_size(rows, num, den).unionByName(_near_in_hot(hot_rows, num, den))
    blocks = F.ceil(F.col("size") / REGION_BLOCK)
    own = F.pmod(F.xxhash64("cls", "region"), blocks)
    parts = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: F.xxhash64("region", F.least(own, j), F.greatest(own, j)))
    met = met.select(F.explode(F.when(F.col("size") > REGION_BLOCK, parts).otherwise(F.array("region"))).alias("region"), "cls")
    met = scratch.write(met, "met")
    told = scratch.write(told.select("doc_id", "n", "cls"), "documents")
    scratch.drop("told", "hot")
    scratch.release()
    return told, classes, met


def _dealt(members: DataFrame, sets: DataFrame, num: int, den: int, counting: bool) -> DataFrame:
    """members (cls, block, comp, side, weight) joined with their sets and solved block by block."""
    rows = members.join(sets, "cls").repartition("block").sortWithinPartitions("block", "cls")
    return rows.select("block", "cls", "comp", "side", "weight", "shingles").mapInArrow(_solved(num, den, counting), "a long, b long, n long")


def jaccard_groups(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (80, 100), count_links: bool = False) -> DataFrame:
    """Groups of documents that links of the given Jaccard similarity connect.

    docs needs doc_id (long) and text; other columns are ignored, whatever their names. Returns a row per
    input row: doc_id, n_shingles, component_id (least doc_id reachable, itself included), class_id (equal for
    equal shingle sets; null for empty ones), and with count_links n_links, the number of other rows
    that it links to, rows with an equal set included.

    Null or blank text gives n_shingles 0, no link and component_id = doc_id. Repeated rows come back as often
    as they are given. Rows with a null doc_id take part in no group: component_id is null, n_links 0. An empty table
    gives an empty result. Words are runs of non-white-space with A-Z lower-cased; a text of fewer than
    `words` words is one shingle. Texts of any length are taken whole; a task holds the sets of a block of documents, and
    two of the largest at least. Shingles and sets are compared by 64-bit hashes without algebraic structure.

    Rows that leave a region or a block are linear in their sizes. Sets sent to blocks are about one for each document in
    a cluster of up to BLOCK documents; in a larger one, of g documents, about the square root of g if links to its pivot
    do not connect it at once, or if links are counted.
    """
    num, den = similarity
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    told, classes, met = _described_regions(docs, words, num, den, scratch)
    dealt = met.join(classes.select("cls", "n", "bits"), "cls").select("region", "cls", "n", "bits").repartition("region").sortWithinPartitions("region", "cls")
    edges = scratch.write(dealt.mapInArrow(_forest(num, den), "a long, b long").distinct(), "edges")
    scratch.release()
    clusters = scratch.write(components(edges, scratch, "clusters"), "in-clusters")
    scratch.drop("met", "edges")

    # each class in a cluster once, with what its cluster's size asks for
    placed = clusters.join(classes.select("cls", "rep", "weight", "n"), F.col("node") == F.col("cls")).select("cls", "rep", "weight", "n", F.col("root").alias("cluster"))
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("g"), F.sum("n").alias("total"))
    sizes = sizes.select("cluster", F.greatest(F.when(F.col("g") > 2 * BLOCK, F.ceil(F.col("g") / F.greatest(F.lit(BLOCK), F.ceil(F.sqrt("g"))))).otherwise(1), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("long").alias("blocks"))
    placed = placed.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("cls", "cluster"), F.col("blocks")))
    placed = scratch.write(placed.select("cls", "rep", "weight", "cluster", "blocks", "own"), "placed")
    wanted = placed.select("cls", F.col("rep").alias("doc_id"))
    texts = docs.join(wanted.hint("shuffle_hash"), "doc_id")
    sets = scratch.write(texts.select("cls", "text").mapInArrow(_sets(words), "cls long, shingles binary"), "sets")
    scratch.release()

    pivot = F.col("cls") == F.col("cluster")  # the root is the least class
    first = placed.select("cls", F.col("cls").alias("comp"), "weight", F.xxhash64("cluster", "own").alias("block"), F.lit(-1).alias("side"))
    guests = placed.where(pivot & (F.col("blocks") > 1)).select("cls", F.col("cls").alias("comp"), "weight", "cluster", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("to"))
    guests = guests.where("own <> to").select("cls", "comp", "weight", F.xxhash64("cluster", "to").alias("block"), F.lit(2).alias("side"))
    solved = scratch.write(_dealt(first.unionByName(guests), sets, num, den, count_links), "solved-0")
    roots = scratch.write(components(solved.where("b is not null"), scratch, "roots-0"), "found-roots-0")

    # clusters of several blocks: pairs of blocks, if something is left to be joined or all links are counted
    open_ = placed.where("blocks > 1").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("comp", F.coalesce("root", "cls"))
    open_ = scratch.write(open_.select("cls", "comp", "weight", "cluster", "blocks", "own"), "several")
    if not count_links:
        left = open_.groupBy("cluster").agg((F.min("comp") < F.max("comp")).alias("more")).where("more").select("cluster")
        open_ = open_.join(left, "cluster", "left_semi")
    pairs = open_.select("cls", "comp", "weight", "cluster", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("to")).where("own <> to")
    pairs = pairs.select("cls", "comp", "weight", F.xxhash64("cluster", F.least("own", "to"), F.greatest("own", "to")).alias("block"), F.when(F.col("own") < F.col("to"), 0).otherwise(1).alias("side"))
    if open_.limit(1).count():
        more = scratch.write(_dealt(pairs, sets, num, den, count_links), "solved-1")
        stars = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = scratch.write(components(stars.unionByName(more.where("b is not null").select("a", "b")), scratch, "roots-1"), "found-roots-1")
        solved = solved.unionByName(more)

    named = classes.select("cls", "rep", "weight").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select("cls", "component_id", "weight")
    if count_links:
        counts = solved.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))
        named = named.join(counts, "cls", "left").withColumn("links", F.coalesce("others", F.lit(0)) + F.col("weight") - 1)
    out = told.select("doc_id", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls")).join(named, "cls", "left")
    known = F.col("doc_id").isNotNull()
    cols = ["doc_id", F.col("n").alias("n_shingles"), F.when(known, F.coalesce("component_id", "doc_id")).alias("component_id"), F.col("cls").alias("class_id")]
    if count_links:
        cols.append(F.when(known, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"))
    scratch.drop("placed", "several", "sets")
    return out.select(*cols)


def jaccard_links(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """All links between different texts: a, b, the least doc_id of two classes of equal shingle sets, a < b, each pair once.

    Arguments are those of jaccard_groups. A group of g mutually linked texts has g (g - 1) / 2 links, so the result and the
    work can grow with the square of a group's size; links between equal sets are not listed.
    """
    num, den = similarity
    scratch = Scratch(docs.sparkSession, "jaccard-links")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    _, classes, met = _described_regions(docs, words, num, den, scratch)
    dealt = met.join(classes.select("cls", "n", "bits"), "cls").select("region", "cls", "n", "bits").repartition("region").sortWithinPartitions("region", "cls")
    pairs = scratch.write(dealt.mapInArrow(_all_pairs(num, den), "a long, b long").distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = classes.join(wanted, "cls", "left_semi").select("cls", F.col("rep").alias("doc_id"))
    texts = docs.join(wanted.hint("shuffle_hash"), "doc_id")
    sets = scratch.write(texts.select("cls", "text").mapInArrow(_set_arrays(words), "cls long, shingles array<long>").dropDuplicates(["cls"]), "sets")
    reps = [classes.select(F.col("cls").alias(c), F.col("rep").alias(f"{c}_id")) for c in "ab"]
    links = _confirmed(pairs, sets, num, den).join(reps[0], "a").join(reps[1], "b")
    return links.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"))


def _all_pairs(num: int, den: int):
    """Every pair that the parity bits do not keep apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for table in _groups(batches, "region"):
            t = _Rows(table, num, den)
            edges = np.flatnonzero(np.r_[True, t.region[1:] != t.region[:-1], True])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                for k in range(a, b - 1):
                    yield from _told([(t.cls[k], t.cls[x]) for x in t.near(k, np.arange(k + 1, b))[0]], seen)

    return trimmed(run)


def _set_arrays(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found = [(c, s) for c, s in zip(part.column("cls").to_pylist(), shingle_sets(*text_buffers(part.column("text")), k), strict=True) if class_of(s) == c]
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([s.view(np.int64) for _, s in found], pa.list_(pa.int64()))], ["cls", "shingles"])

    return trimmed(run)


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sets have den * intersection >= num * union."""
    one = pairs.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b")
    two = one.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a")
    both = two.select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("same"), (F.size("x") + F.size("y")).cast("long").alias("total"))
    return both.where(f"{den} * same >= {num} * (total - same)").select("a", "b")
