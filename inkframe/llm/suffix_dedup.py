"""Removal of long repeated strings by a logarithmic family of suffix arrays.

Wanted is all that a string of LENGTH elements covers which also starts somewhere else. Elements are bytes, or words.

Sampled suffixes. A window is a string of LENGTH elements. Among the suffixes that start in it and have GRAM
elements left, each window picks the one whose next GRAM elements hash lowest, its anchor. Equal windows pick alike,
so an anchor that starts only one suffix of the corpus rules out all windows that picked it. The suffix
array of a batch of texts is made of the suffixes at anchors, about one in (LENGTH - GRAM) / 2 elements. It is ordered
by their first two bytes (by part of the hash of the first word) and then by the hash of GRAM elements, and has a row for each of these: n, how often it starts,
and the least and greatest span, the hash of all that the windows of an anchor cover.

The family. Level i is empty or indexes 2**i batches. A new batch's array is scanned against the levels: what starts
in both, or more than once in the batch, is a match and is noted, with whether all its spans are one. Then it is merged
with level 0, the result with level 1, and so on to the first empty level, so that each entry is rewritten once for each
doubling. The arrays themselves are not read again for the result.

Marking. If all occurrences of a match have one span, all its windows recur. Otherwise those of spans that
recur do, and one occurrence of each remaining kind is compared with the others window by window.
Texts that occur twice are repeated as a whole, and only their first occurrence in a task is indexed.

Hashes are nonlinear: the hash of 2 k elements mixes those of its halves. A match needs equal keys of GRAM elements (48 bits of
a hash) and a 64-bit hash of a span, or 95 bits of two hashes of a window; texts are equal if their MD5 is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .hashing import U, chunks, lanes, mix, text_buffers, trimmed, word_hashes
from .scratch import Scratch

LENGTH, GRAM = 400, 256
#: A passage has more than 50 words.
PASSAGE, PASSAGE_GRAM = 51, 16
BATCHES = 4
_LOW = U((1 << 24) - 1)
_SEGMENT = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Elements:
    """What a string is made of: its elements as 64-bit words, each of which covers `unit` elements, and where texts begin."""

    def __init__(self, data: np.ndarray, at: np.ndarray, words: bool):
        if words:
            self.base, self.at = word_hashes(data, at, _SPACE)
            self.unit = 1
        else:
            self.base, self.at, self.unit = lanes(data)[: max(0, len(data) - 7)], at, 8

    def segments(self, length: int) -> Iterator[tuple[int, int, int]]:
        """(text, first element, end) of parts that hold every window of `length` elements once."""
        for k, (a, b) in enumerate(zip(self.at[:-1].tolist(), self.at[1:].tolist(), strict=True)):
            while b - a >= length:
                end = min(b, a + max(_SEGMENT, 2 * length))
                yield k, a, end
                a = end - length + 1

    def grams(self, low: int, high: int, gram: int) -> np.ndarray:
        """The hash of `gram` elements from each element on, from low to the last that fits before high."""
        have = min(self.unit, gram)
        h = mix(self.base[low : high - self.unit + 1] ^ U(0x243F6A8885A308D3))
        while 2 * have <= gram:
            h = joined(h[: len(h) - have], h[have:])
            have *= 2
        return joined(h[: len(h) - (gram - have)], h[gram - have :]) if have < gram else h


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a string from those of two parts that cover it."""
    x = a * U(0x9FB21C651E98DF25) + b
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    return x


def covering(g: np.ndarray, first: np.ndarray, size: np.ndarray, gram: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the strings of `size` elements from `first` on, of at most `most`, from the grams that cover them."""
    one, two = g[first], mix(g[first] ^ U(0x13198A2E03707344))
    for j in range(1, -(-most // gram)):
        more = g[first + np.minimum(j * gram, size - gram)]
        one, two = joined(one, more), joined(more, two)
    return one, two


def anchors(e: Elements, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """text, position in the text, first and last window start before it (as distances), gram hash, span hash, first bytes."""
    parts: list[tuple[np.ndarray, ...]] = []
    width = length - gram + 1
    group: list[tuple[int, int, int]] = []

    def flush() -> None:
        if not group:
            return
        low, high = group[0][1], group[-1][2]
        g = e.grams(low, high, gram)
        n = len(g)
        m = (g & ~_LOW) | np.arange(n, dtype=U)
        size = 1
        while 2 * size <= width:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < width:
            m = np.minimum(m[: len(m) - (width - size)], m[width - size :])
        pick = (m & _LOW).astype(np.int64)  # of the window that starts at each element
        for k, a, b in group:
            own = pick[a - low : b - low - length + 1]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            last = np.r_[first[1:], len(own)] - 1
            where = own[first]
            i0, i1 = first + (a - low), last + (a - low)
            span = covering(g, i0, i1 - i0 + length, gram, 2 * length - gram)[1]
            span = joined(span, ((where - i0) * 4096 + (where - i1)).astype(U))
            head = e.base[where + low] if e.unit == 1 else e.base[where + low].byteswap()
            parts.append((np.full(len(first), k), where + low - e.at[k], where - i0, where - i1, g[where], span, head))
        group.clear()

    for s in e.segments(length):
        if group and s[2] - group[0][1] > _SEGMENT:
            flush()
        group.append(s)
    flush()
    if not parts:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.int64, U, U, U))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _indexed(length: int, gram: int, words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in chunks(batch, "text"):
                th = part.column("th").to_numpy()
                fresh = []
                for i, x in enumerate(th.tolist()):
                    if x not in seen:
                        fresh.append(i)
                        if len(seen) < 1 << 17:
                            seen.add(x)
                if not fresh:
                    continue
                if len(fresh) < len(th):
                    part, th = part.take(pa.array(fresh)), th[fresh]
                k, pos, l0, l1, g, span, head = anchors(Elements(*text_buffers(part.column("text")), words), length, gram)
                # the first two bytes, in the order of a signed number, and 48 bits of the hash: what these confuse, spans tell apart
                key = ((head >> U(48)) << U(48) | g >> U(16)) ^ U(1 << 63)
                cols = [th[k], pos, l0.astype(np.int16), l1.astype(np.int16), key.view(np.int64), span.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["th", "pos", "l0", "l1", "gram", "span"])

    return trimmed(run)


class SuffixIndexFamily:
    """Levels of sampled suffix arrays, and the matches that scans have found; see the module's docstring.

    A text is in one batch only. With across, what starts more than once in one text alone is no match.
    """

    def __init__(self, scratch: Scratch, tag: str, across: bool = False):
        self.scratch, self.tag, self.count, self.across = scratch, tag, 0, across
        self.levels: list[DataFrame | None] = []
        self.matches: list[DataFrame] = []
        self.tables: list[str] = []

    @staticmethod
    def array(entries: DataFrame) -> DataFrame:
        """The array of one batch of anchors."""
        return entries.groupBy("gram").agg(F.count("*").alias("n"), F.min("span").alias("low"), F.max("span").alias("high"), (F.min("th") < F.max("th")).alias("texts"))

    @staticmethod
    def merged(*arrays: DataFrame) -> DataFrame:
        out = arrays[0]
        for a in arrays[1:]:
            out = out.unionByName(a)
        return out.groupBy("gram").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), (F.max("texts") | (F.count("*") > 1)).alias("texts"))

    def _written(self, array: DataFrame, name: str) -> DataFrame:
        self.tables.append(f"{self.tag}-{name}")
        return self.scratch.write(array.sortWithinPartitions("gram"), self.tables[-1])

    def add(self, entries: DataFrame, last: bool = False) -> None:
        """Scan a batch against the levels, then index it: levels of its size are merged into it, from the smallest on.

        The last batch of a run whose index is not kept need only be scanned.
        """
        kept = [level for level in self.levels if level is not None]
        new = self._written(self.array(entries), f"array-{self.count}")
        found = new.where("texts" if self.across else "n > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed"))
        for level in kept:
            old = level.select("gram", F.col("low").alias("l"), F.col("high").alias("h"))
            both = new.join(old, "gram")
            found = found.unionByName(both.select("gram", (F.least("low", "l") != F.greatest("high", "h")).alias("mixed")))
        self.matches.append(found)
        self.count += 1
        if last:
            return
        gone, level = [new], 0
        while level < len(self.levels) and self.levels[level] is not None:
            gone.append(self.levels[level])
            self.levels[level] = None
            level += 1
        if level == len(self.levels):
            self.levels.append(None)
        self.levels[level] = new if len(gone) == 1 else self._written(self.merged(*gone), f"level-{level}-{self.count}")

    def repeated(self) -> DataFrame:
        """gram and mixed (occurrences have different spans) of the anchors that start more than once."""
        run = self.matches[0]
        for m in self.matches[1:]:
            run = run.unionByName(m)
        return run.groupBy("gram").agg(F.max("mixed").alias("mixed"))

    def drop(self) -> None:
        """Delete the arrays, also those that merged ones stand for, as matches read them until then."""
        self.scratch.drop(*self.tables)


def _windows(length: int, gram: int, words: bool):
    """Hashes of each window of the anchors (p, l0, l1) of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                e = Elements(*text_buffers(part.column("text")), words)
                th, spots = part.column("th").to_numpy(), part.column("spots").to_pylist()
                wanted = []
                for s in spots:
                    i0, i1 = (np.array([x["pos"] - x[c] for x in s]) for c in ("l0", "l1"))
                    i = np.repeat(i0, i1 - i0 + 1) + np.concatenate([np.arange(n) for n in i1 - i0 + 1])
                    order = np.argsort(i, kind="stable")
                    wanted.append((i[order], np.repeat([x["n"] == 1 for x in s], i1 - i0 + 1)[order]))
                for k, a, b in e.segments(length):
                    i, open_ = wanted[k]
                    begin = a - int(e.at[k])
                    some = slice(*np.searchsorted(i, [begin, begin + (b - a) - length + 1]))
                    if not len(i[some]):
                        continue
                    h, h2 = covering(e.grams(a, b, gram), i[some] - begin, np.full(len(i[some]), length), gram, length)
                    for c in range(0, len(h), 65536):
                        s = slice(c, c + 65536)
                        yield pa.RecordBatch.from_arrays([pa.array(h[s].view(np.int64)), pa.array((h2[s] >> U(33)).astype(np.int32)), pa.array(np.full(len(h[s]), th[k])), pa.array(i[some][s]), pa.array(open_[some][s])], ["h", "h2", "th", "i", "open"])

    return trimmed(run)


def _listed(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of the marks of each row of a column of lists; null is none."""
    at, known = col.offsets.to_numpy(), col.is_valid().to_pylist()
    a, b = (col.values.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
    return [(a[i:j], b[i:j]) if k else (a[:0], b[:0]) for i, j, k in zip(at[:-1].tolist(), at[1:].tolist(), known, strict=True)]


def _united(a: np.ndarray, b: np.ndarray) -> list[list[int]]:
    """The maximal stretches that marks cover."""
    if not len(a):
        return []
    order = np.argsort(a, kind="stable")
    a, end = a[order], np.maximum.accumulate(b[order])
    first = np.flatnonzero(np.r_[True, a[1:] > end[:-1]])
    return [[x, y] for x, y in zip(a[first].tolist(), end[np.r_[first[1:] - 1, len(a) - 1]].tolist(), strict=True)]


_OUT = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "spans": pa.list_(pa.int64()), "passage_words": pa.int64()}


def _removed(length: int, passage: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                data, at = text_buffers(part.column("text"))
                copies, marks, passages = part.column("copies").to_pylist(), _listed(part.column("marks")), _listed(part.column("passages"))
                out = []
                for k in range(part.num_rows):
                    own = data[at[k] : at[k + 1]]
                    copied = (copies[k] or 1) > 1
                    spans = [[0, len(own)]] if copied and len(own) >= length else _united(*marks[k])
                    if copied:
                        gap = np.r_[True, _SPACE[own]]
                        n = int(np.count_nonzero(gap[:-1] & ~gap[1:]))
                        told = n if n >= passage else 0
                    else:
                        told = sum(b - a for a, b in _united(*passages[k]))
                    digest, end = hashlib.sha256(), 0
                    for a, b in spans:
                        digest.update(own[end:a])
                        end = b
                    digest.update(own[end:])
                    out.append((len(own), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), [x for s in spans for x in s], told))
                cols = [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), list(_OUT.values())[1:], strict=True))]
                yield pa.RecordBatch.from_arrays(cols, list(_OUT))

    return trimmed(run)


def _keyed(rows: DataFrame, scratch: Scratch) -> tuple[Column, DataFrame]:
    """A 64-bit key of texts that no two different texts of rows share, and how many rows each text has."""
    salt = 0
    while True:
        key = F.xxhash64("text") if not salt else F.xxhash64(F.lit(salt), "text")
        told = rows.groupBy(key.alias("th")).agg(F.count("*").alias("copies"), F.min(F.md5("text")).alias("low"), F.max(F.md5("text")).alias("high"))
        told = scratch.write(told.where("copies > 1"), f"copies-{salt}")
        if not told.where("low <> high").limit(1).count():
            return key, told.select("th", "copies")
        salt += 1


def marks_of(texts: DataFrame, length: int, gram: int, words: bool, across: bool, batches: int, scratch: Scratch) -> DataFrame:
    """th, marks: stretches of texts (th, text), equal texts once, that strings of `length` elements cover which also start
    elsewhere, with across in another text."""
    tag = "words" if words else "bytes"
    kind = "th long, pos long, l0 short, l1 short, gram long, span long"
    entries = scratch.write(texts.mapInArrow(_indexed(length, gram, words), kind), f"{tag}-entries")
    # the same text may have been indexed by several tasks
    family = SuffixIndexFamily(scratch, tag, across)
    for b in range(batches):
        family.add(entries.where(F.pmod("th", F.lit(batches)) == b), last=b == batches - 1)
    found = scratch.write(entries.join(family.repeated(), "gram"), f"{tag}-found")
    scratch.drop(f"{tag}-entries")
    family.drop()
    del entries, family
    scratch.release()

    spot = F.struct("th", "pos", "l0", "l1")
    kinds = found.where("mixed").groupBy("gram", "span").agg(F.count("*").alias("n"), F.min(spot).alias("spot"), F.max(spot).alias("last"))
    kinds = scratch.write(kinds.withColumn("recurs", F.col("spot.th") < F.col("last.th") if across else F.col("n") > 1), f"{tag}-kinds")
    whole = found.where("not mixed").select("th", "pos", "l0", "l1").unionByName(found.where("mixed").join(kinds.where("recurs").select("gram", "span"), ["gram", "span"], "left_semi").select("th", "pos", "l0", "l1"))
    sure = whole.select("th", (F.col("pos") - F.col("l0")).alias("a"), (F.col("pos") - F.col("l1") + length).alias("b"))

    if across:
        # kinds of one text at all their places, the others in two texts
        alone = found.where("mixed").join(kinds.where("not recurs").select("gram", "span"), ["gram", "span"], "left_semi").select("th", "pos", "l0", "l1", F.lit(1).alias("n"))
        spots = alone.unionByName(kinds.where("recurs").select(F.explode(F.array("spot", "last")).alias("s")).select("s.*", F.lit(2).alias("n")))
    else:
        spots = kinds.select("spot.*", F.least("n", F.lit(2)).cast("int").alias("n"))
    spots = spots.groupBy("th").agg(F.collect_list(F.struct("pos", "l0", "l1", "n")).alias("spots"))
    windows = texts.join(spots.hint("shuffle_hash"), "th").mapInArrow(_windows(length, gram, words), "h long, h2 int, th long, i long, open boolean")
    place = F.col("th") if across else F.xxhash64("th", "i")
    # one exchange of windows, which are not written otherwise
    equal = Window.partitionBy("h", "h2")
    some = windows.withColumns({"x": F.min(place).over(equal), "y": F.max(place).over(equal)}).where("open and x <> y").select("th", F.col("i").alias("a"), (F.col("i") + length).alias("b"))
    marks = scratch.write(sure.unionByName(some).groupBy("th").agg(F.collect_list(F.struct("a", "b")).alias("marks")), f"{tag}-marks")
    scratch.drop(*(f"{tag}-{n}" for n in ("found", "kinds")))
    return marks


def repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, passage: int = PASSAGE, passage_gram: int = PASSAGE_GRAM) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end, flat), passage_words.

    Removed are the bytes that a string of `length` bytes covers which also starts elsewhere in this or another
    text; strings do not cross texts. Null texts are empty. Texts shorter than `length` lose nothing. passage_words
    counts the words (runs of non-white-space) that a string of `passage` words covers which also is in another row; it removes nothing.
    Null and repeated doc_ids pass through, a row each; rows with equal texts are copies of each other. An empty table gives an
    empty result. Other columns are ignored. Spans are offsets into UTF-8 bytes. Texts of any length are taken whole, in segments
    of bounded size. See the module's docstring for what rests on hashes.
    """
    if gram < 8 or length < gram or passage < passage_gram:
        raise ValueError("a gram has at least 8 bytes, and no more elements than a string")
    scratch = Scratch(docs.sparkSession, "suffix")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    least = min(length, 2 * passage - 1)  # bytes
    long_rows = rows.where(F.octet_length("text") >= least)
    key, copies = _keyed(long_rows, scratch)
    long_rows = long_rows.withColumn("th", key)
    texts = long_rows.select("th", "text")
    marks = marks_of(texts, length, gram, False, False, batches, scratch)
    scratch.release()
    passages = marks_of(texts, passage, passage_gram, True, True, batches, scratch).withColumnRenamed("marks", "passages")
    scratch.release()
    told = scratch.write(marks.join(passages, "th", "full_outer").join(copies, "th", "full_outer"), "told")
    scratch.drop("bytes-marks", "words-marks")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, passage_words long"
    none = F.lit(0).cast("long")
    short = rows.where(F.octet_length("text") < least).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), F.array().cast("array<long>").alias("spans"), none.alias("passage_words"))
    return long_rows.join(told, "th", "left").select("doc_id", "text", "copies", "marks", "passages").mapInArrow(_removed(length, passage), out).unionByName(short)
