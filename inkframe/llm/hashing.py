"""Vectorised hashing of words and byte ranges over Arrow text buffers.

A range goes through a mixing function eight bytes at a time, so that hashes have no algebraic structure; words longer than LONG_WORD are
hashed one by one with BLAKE2. All steps but these are numpy array operations.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE = 1 << 18


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker lives on after its task, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def trimmed(run: Callable) -> Callable:
    """A function for mapInArrow that releases memory before its first and after its last batch."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, one text after the other, and the n+1 offsets; null counts as empty."""
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.dtype(np.int64 if pa.types.is_large_string(col.type) else np.int32)
    _, where, data = col.buffers()
    at = np.frombuffer(where, kind, len(col) + 1, col.offset * kind.itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(batch: pa.RecordBatch, text: str, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `most` bytes of text each; a longer text is a slice of its own."""
    _, at = text_buffers(batch.column(text))
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def lanes(data: np.ndarray) -> np.ndarray:
    """A view of data, padded, that holds the eight bytes from every byte on as one little-endian word."""
    wide = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", wide, strides=(1,))


#: Longer words are hashed one by one.
LONG_WORD = 256
MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], U)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of byte ranges. Eight bytes at a time go through a mixing function, which leaves no algebraic structure.

    at: what lanes(data) returned. Ranges of up to eight bytes of one length never collide.
    """
    at = lanes(data) if at is None else at
    size = ends - starts
    out = mix(at[starts] & MASKS[np.minimum(size, 8)] ^ size.astype(U) * U(0x9E3779B97F4A7C15))
    left = np.flatnonzero((size > 8) & (size <= LONG_WORD))
    k = 8
    while len(left):
        rest = size[left] - k
        out[left] = mix((out[left] ^ at[starts[left] + k] & MASKS[np.minimum(rest, 8)]) * U(0xD6E8FEB86659FD93) + U(k))
        left, k = left[rest > 8], k + 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def word_hashes(data: np.ndarray, at: np.ndarray, separator: np.ndarray, fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text the index of its first word (n+1 entries).

    separator[b] tells whether byte b stands between words; fold[b] is the byte that stands for b.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, U), np.zeros(len(at), np.int64)
    gap = separator[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = True, gap[:-1]
    after[-1], after[:-1] = True, gap[1:]
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return range_hashes(data if fold is None else fold[data], starts, ends), np.searchsorted(starts, at)


def folded() -> np.ndarray:
    """The byte that stands for each byte: A-Z as a-z."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out
