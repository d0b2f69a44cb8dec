"""Benchmark decontamination by Wu-Manber multi-pattern search.

Benchmark texts become windows of successive words, each a byte string " w1 w2 ... wn ". Document texts
are brought into the same form. For a set of patterns of at least m bytes a shift table has, for each
hashed block of B bytes, how far a search may move on without skipping an occurrence; where it is 0,
the block ends the first m bytes of some pattern, its bucket gives the patterns to try, and a direct
comparison of the bytes confirms. Patterns are kept in classes by length, so that a short one does not
shorten the shifts of the others. A slice of the text is searched in many lanes at once: the cursors of
all lanes are one array, and each numpy step moves all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import U, chunks, text_buffers, trimmed
from .scratch import Scratch

LANES = 4096
TABLE_BITS = 20
#: Bytes of windows that the driver makes and one search holds. A larger benchmark is searched in several passes.
PASS_BYTES = 160 << 20
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[65:91] = _WORD[128:] = True
#: Separators become spaces, A-Z lower case.
_FORM = np.where(_WORD, np.arange(256), 32).astype(np.uint8)
_FORM[65:91] += 32


def canonical(text: str) -> list[bytes]:
    """The lower-cased words of a text."""
    return text.encode("utf-8", "surrogatepass").translate(_FORM.tobytes()).split()


def windows(text: str | None, size: int) -> set[bytes]:
    words = canonical(text or "")
    if not words:
        return set()
    size = min(size, len(words))
    return {b" " + b" ".join(words[i : i + size]) + b" " for i in range(len(words) - size + 1)}


class _Class:
    """Shift table and buckets of patterns of similar length."""

    def __init__(self, patterns: list[int], texts: list[bytes]):
        self.m = min(len(texts[p]) for p in patterns)
        self.block = 8 if self.m >= 16 else 4 if self.m >= 8 else 3
        self.mask = U((1 << 8 * self.block) - 1)
        width = self.m - self.block + 1
        head = np.frombuffer(b"".join(texts[p][: self.m] for p in patterns), np.uint8).reshape(-1, self.m)
        shifts = np.full(1 << TABLE_BITS, width, np.int32)
        for end in range(self.block, self.m + 1):
            value = np.zeros(len(head), U)
            for k in range(self.block):
                value |= head[:, end - self.block + k].astype(U) << U(8 * k)
            np.minimum.at(shifts, self.slot(value), self.m - end)
        self.shifts = shifts
        order = np.argsort(value, kind="stable")
        self.ends, self.patterns = value[order], np.array(patterns)[order]

    @staticmethod
    def slot(value: np.ndarray) -> np.ndarray:
        return ((value * U(0x9E3779B97F4A7C15)) >> U(64 - TABLE_BITS)).astype(np.int64)

    def candidates(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts in the text and patterns that may occur there; words[i] are the 8 bytes from i on."""
        found = []
        step = max(1, -(-(n - self.m + 1) // LANES))
        at = np.arange(self.m - 1, n, step)
        stop = np.minimum(at + step, n)
        back = self.block - 1
        while len(at):
            shift = self.shifts[self.slot(words[at - back] & self.mask)]
            still = shift == 0
            if still.any():
                found.append(at[still])
            at = at + np.maximum(shift, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        at = np.concatenate(found) if found else np.zeros(0, np.int64)
        value = words[at - back] & self.mask
        low, high = np.searchsorted(self.ends, value), np.searchsorted(self.ends, value, "right")
        many = high - low
        at, low, many = at[many > 0], low[many > 0], many[many > 0]
        which = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
        return np.repeat(at, many) - self.m + 1, self.patterns[which]


class PatternSearch:
    """items: (item_id, text); all windows of all items, searched together."""

    def __init__(self, items: list[tuple[int, str | None]], size: int):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for w in windows(text, size):
                owners.setdefault(w, set()).add(str(item))
        self.texts = sorted(owners)
        self.owners = [sorted(owners[t]) for t in self.texts]
        self.words = [t.count(b" ") - 1 for t in self.texts]
        kinds: dict[int, list[int]] = {}
        for i, t in enumerate(self.texts):
            kinds.setdefault(min(len(t).bit_length(), 6), []).append(i)
        self.classes = [_Class(p, self.texts) for p in kinds.values()]

    def scan(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, dict[int, list[tuple[int, int]]], dict[int, set[str]]]:
        """Words of each text; by text, the word spans of all occurrences and the items they belong to."""
        formed = _FORM[data].tobytes()
        # one text after the other: "\n w1 w2 \n w3 \n"; a newline is in no pattern
        line = np.frombuffer(b"\n " + b" \n ".join(formed[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)) + b" \n" + bytes(8), np.uint8)
        space = line == 32
        line = np.ascontiguousarray(line[~(space & np.r_[False, space[:-1]])])
        spaces, bounds = np.flatnonzero(line == 32), np.flatnonzero(line == 10)
        before = np.searchsorted(spaces, bounds)
        n_words = np.diff(before) - 1
        n = len(line) - 8
        words = np.lib.stride_tricks.as_strided(np.frombuffer(line, U, 1), (n + 1,), (1,))
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        raw = line.tobytes()
        for c in self.classes:
            for start, p in zip(*(x.tolist() for x in c.candidates(words, n)), strict=True):
                if raw.startswith(self.texts[p], start):
                    doc = int(np.searchsorted(bounds, start)) - 1
                    word = int(np.searchsorted(spaces, start) - before[doc])
                    spans.setdefault(doc, []).append((word, word + self.words[p]))
                    items.setdefault(doc, set()).update(self.owners[p])
        return n_words, spans, items


def covered(spans: list[tuple[int, int]]) -> int:
    """Words in the union of spans."""
    total, end = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def _scanned(search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                n_words, spans, items = search.value.scan(*text_buffers(part.column("text")))
                k = range(part.num_rows)
                flat = pa.array([[x for s in spans[i] for x in s] if i in spans else [] for i in k], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), pa.array(n_words, pa.int64()), flat, pa.array([sorted(items[i]) if i in items else [] for i in k], pa.list_(pa.string()))], ["doc_id", "key", "n_words", "spans", "items"])

    return trimmed(run)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
        hit = [covered(list(zip(s[::2], s[1::2], strict=True))) if s else 0 for s in spans]
        names = [sorted(set(x)) for x in items]
        sums = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), batch.column("n_words"), pa.array(hit, pa.int64()), pa.array([len(x) for x in names], pa.int64()), pa.array(sums, pa.string()), batch.column("spans"), pa.array(names, pa.list_(pa.string()))], ["doc_id", "key", "n_words", "n_hit", "n_items", "items_sha256", "spans", "items"])


def _passes(benchmark: DataFrame, size: int) -> Iterator[list[tuple[int, str | None]]]:
    """The benchmark in parts with a bounded size of windows, read one after the other; an item is not divided."""
    part, held = [], 0
    for row in benchmark.toLocalIterator():
        part.append((row[0], row[1]))
        held += len(row[1]) * size
        if held > PASS_BYTES:
            yield part
            part, held = [], 0
    yield part


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Which words of docs (doc_id, text) lie in a window of `size` words of benchmark (item_id, text).

    Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and spans (start, end of each
    occurrence in words, flat) and items. An item with fewer words is one window; an item without words, with null
    text or with null item_id has none. Null document texts have no words; null and repeated doc_ids pass through.
    Other columns are ignored. An empty benchmark marks nothing; empty docs give an empty result.

    One pass over docs without a shuffle, as long as the benchmark has less than PASS_BYTES / size of text. Beyond that,
    each part of the benchmark takes a pass, and a row's results of all passes meet by doc_id and text hash.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    items = benchmark.select("item_id", F.col("text").cast("string")).where("item_id is not null and text is not null")
    kind = "doc_id long, key long, n_words long, spans array<long>, items array<string>"
    done = []
    for k, part in enumerate(_passes(items, size)):
        search = docs.sparkSession.sparkContext.broadcast(PatternSearch(part, size))
        one = rows.mapInArrow(_scanned(search), kind)
        done.append(one if k == 0 else scratch.write(one.where("size(spans) > 0").distinct(), f"pass-{k}"))
    found = done[0]
    if len(done) > 1:
        found = scratch.write(found, "pass-0")
        later = done[1]
        for more in done[2:]:
            later = later.unionByName(more)
        later = later.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items"))  # a row per pass
        both = found.alias("f").join(later.alias("l"), F.col("f.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("f.key") == F.col("l.key")), "left")
        found = both.select("f.doc_id", "f.key", "n_words", F.concat("spans", F.coalesce("more_spans", F.array().cast("array<long>"))).alias("spans"), F.concat("items", F.coalesce("more_items", F.array().cast("array<string>"))).alias("items"))
    out = found.mapInArrow(_summed, "doc_id long, key long, n_words long, n_hit long, n_items long, items_sha256 string, spans array<long>, items array<string>")
    return out.drop("key").withColumn("contaminated", F.col("n_hit") > 0)
