"""Token ids in bit-plane-shuffled shard files.

A shard file holds the ids of consecutive documents:

    magic | block planes ... | index | index length (8 bytes, little-endian) | magic

Ids are cut into blocks of a fixed number of 32-bit little-endian words. A block is transposed into its
four byte planes (all first bytes, all second bytes, ...), and each plane is compressed with zstandard on
its own; the high planes are nearly constant and all but vanish. The index is zstandard-compressed JSON:
for each block the offset and the lengths of its planes, then the documents' ids and token counts. Any
block can be read alone.

Writers open their files through pyarrow.fs, so that the folder may be in any store it knows. File names
hold the task attempt. Only files that the manifest lists count: an attempt that is lost leaves an orphan
and nothing else.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from .hashing import MASKS, U, chunks, lanes, mix, text_buffers, trimmed
from .scratch import Scratch

MAGIC = b"INKPLN01"
BLOCK = 1 << 16
#: Places of an encoder's table, the bytes of the longest pre-token there, and the ids that all its pre-tokens have at most.
SLOTS, WIDEST, POOL = 1 << 20, 24, 1 << 22
#: Classes of bytes: 0 white space, 1 letter (every byte of a letter beyond ASCII counts), 2 digit, 3 other.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_CLASS[48:58] = 2
#: Bytes that only texts have which go to the library whole: U+001C to U+001F, U+0080 to U+00BF, U+0250 and above.
_ODD = np.zeros(256, bool)
_ODD[28:32] = _ODD[0xC2] = _ODD[0xCA:] = True
#: Endings that split off after an apostrophe, by their first letter.
_ENDS_ALONE, _ENDS_PAIRED = b"stmd", (b"re", b"ve", b"ll")


def split_tokens(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First bytes of the pre-tokens of texts without odd bytes.

    These are runs of one class. Of the white space before another run the last character stands apart: a space
    belongs to that run, another character is a pre-token. An apostrophe without such a space takes its ending.
    """
    n = len(data)
    kind = _CLASS[data]
    edge = np.zeros(n + 4, bool)
    edge[at[:-1][at[:-1] < n]] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    after = np.flatnonzero(start[1:] & ~edge[1:n] & (kind[1:] != 0) & (kind[:-1] == 0)) + 1
    start[after - 1] = True
    start[after[data[after - 1] == 32]] = False
    q = np.flatnonzero((data == 39) & start)
    q = q[q + 1 < n]
    q = q[(kind[q + 1] == 1) & ~edge[q + 1]]
    if len(q):
        wide = np.concatenate([data, np.zeros(4, np.uint8)])
        letter = np.concatenate([kind, np.zeros(4, np.uint8)]) == 1
        one = np.isin(wide[q + 1], np.frombuffer(_ENDS_ALONE, np.uint8))
        two = np.zeros(len(q), bool)
        for a, b in _ENDS_PAIRED:
            two |= (wide[q + 1] == a) & (wide[q + 2] == b)
        two &= ~edge[q + 2]
        for some, size in ((q[one], 1), (q[two], 2)):
            start[some + 1] = False
            rest = some + 1 + size
            rest = rest[letter[rest] & ~edge[rest]]
            start[rest] = True
    return np.flatnonzero(start)


def _ranges(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of each range, `many` of them, one range after the other."""
    ends = np.cumsum(many)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + many, many)


class Encoder:
    """Ids of texts by a tokenizers file. The library encodes pre-tokens that a table of recent ones does not hold.

    Byte-level BPE treats pre-tokens on their own, so a text's ids are those of its pre-tokens in turn. Pre-tokens
    are found and looked up as arrays. The table has one place for each hash, which the last comer takes, and holds the
    bytes of its pre-tokens, which are compared; those longer than WIDEST bytes have a dictionary. Texts with special
    strings, or with characters on which pattern libraries may differ, go to the library whole.
    """

    def __init__(self, text: str):
        """text: what a tokenizers file holds."""
        # its threads would keep memory of their own, and the executor has given this task one core
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(text)
        spec = json.loads(text)
        self.by_parts = spec.get("normalizer") is None and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        vocab = spec["model"]["vocab"]
        self.widths = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each id: one symbol stands for one byte
        self.widths[list(vocab.values())] = [len(t) for t in vocab]
        kind = np.uint16 if len(self.widths) <= 1 << 16 else np.uint32
        self.held = np.zeros((WIDEST // 8, SLOTS), U)  # the bytes
        self.width, self.many, self.at = np.zeros(SLOTS, np.uint8), np.zeros(SLOTS, np.uint8), np.zeros(SLOTS, np.int32)
        self.pool, self.used = np.zeros(POOL, kind), 0
        self.long: dict[bytes, tuple[int, int]] = {}

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, one after the other, and how many each has. Runs of letters after a space are encoded many at a
        time: joined, they split where they were joined."""
        joined, apart = [], []
        for i, w in enumerate(words):
            (joined if w[0] == 32 and _CLASS[w[-1]] == 1 and len(w) > 1 and _CLASS[w[1]] == 1 else apart).append(i)
        ids, many = [], np.zeros(len(words), np.int64)
        groups = [joined[i : i + 2000] for i in range(0, len(joined), 2000)]
        found = self.library.encode_batch_fast([b"".join([words[i] for i in g]).decode() for g in groups], add_special_tokens=False)
        for group, e in zip(groups, found, strict=True):
            own = np.array(e.ids, self.pool.dtype)
            ids.append(own)
            cuts = np.searchsorted(np.cumsum(self.widths[own]), np.cumsum([len(words[i]) for i in group])) + 1
            many[group] = np.diff(cuts, prepend=0)
        for k in range(0, len(apart), 2000):
            some = apart[k : k + 2000]
            for i, e in zip(some, self.library.encode_batch_fast([words[i].decode() for i in some], add_special_tokens=False), strict=True):
                ids.append(np.array(e.ids, self.pool.dtype))
                many[i] = len(e.ids)
        # from the order of encoding to the order of words
        order = np.array(joined + apart, np.int64)
        begin = np.empty(len(words), np.int64)
        begin[order] = np.cumsum(many[order]) - many[order]
        flat = np.concatenate(ids) if ids else np.zeros(0, self.pool.dtype)
        return flat[_ranges(begin, many)], many

    def keep(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of words now are in the pool, and how many."""
        flat, many = self.learn(words)
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(len(flat) + POOL // 4, self.pool.dtype)])
        self.pool[self.used : self.used + len(flat)] = flat
        begin = self.used + np.cumsum(many) - many
        self.used += len(flat)
        return begin, many

    def _by_parts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and where each text's begin."""
        if self.used > POOL * 3 // 4:
            self.pool, self.used = self.pool[:POOL].copy(), 0
            self.many[:] = 0
            self.long.clear()
        starts = split_tokens(data, at)
        size = np.diff(starts, append=len(data))
        words = lanes(data)
        own = np.zeros((WIDEST // 8, len(starts)), U)
        own[0] = words[starts] & MASKS[np.minimum(size, 8)]
        h = mix(own[0] ^ size.astype(U) * U(0x9E3779B97F4A7C15))
        for k in range(1, WIDEST // 8):
            more = np.flatnonzero(size > 8 * k)
            own[k, more] = words[starts[more] + 8 * k] & MASKS[np.minimum(size[more] - 8 * k, 8)]
            h[more] = mix((h[more] ^ own[k, more]) * U(0xD6E8FEB86659FD93))
        slot = (h & U(SLOTS - 1)).astype(np.int64)
        many = self.many[slot].astype(np.int64)
        same = (many > 0) & (self.width[slot] == size)
        for k in range(WIDEST // 8):
            same &= self.held[k][slot] == own[k]
        begin = self.at[slot].astype(np.int64)
        short = size <= WIDEST
        missing = np.flatnonzero(~same & short)
        if len(missing):
            _, first, where = np.unique(h[missing], return_index=True, return_inverse=True)
            new = missing[first]
            # words of one hash that are not one word take turns on their own
            alike = (own[:, missing] == own[:, new[where]]).all(axis=0) & (size[missing] == size[new[where]])
            odd = missing[~alike]
            found = np.concatenate([new, odd])
            spot, n = self.keep([data[a : a + w].tobytes() for a, w in zip(starts[found].tolist(), size[found].tolist(), strict=True)])
            begin[missing[alike]], many[missing[alike]] = spot[where[alike]], n[where[alike]]
            begin[odd], many[odd] = spot[len(new) :], n[len(new) :]
            place, one = np.unique(slot[new], return_index=True)
            place, one = place[n[one] < 256], one[n[one] < 256]
            self.many[place], self.at[place], self.width[place] = n[one], spot[one], size[new[one]]
            self.held[:, place] = own[:, new[one]]
        wide = np.flatnonzero(~short)
        if len(wide):
            raw = [data[a : a + w].tobytes() for a, w in zip(starts[wide].tolist(), size[wide].tolist(), strict=True)]
            fresh = list(dict.fromkeys(w for w in raw if w not in self.long))
            if fresh:
                spot, n = self.keep(fresh)
                self.long.update(zip(fresh, zip(spot.tolist(), n.tolist(), strict=True), strict=True))
            begin[wide], many[wide] = np.array([self.long[w] for w in raw]).T
        out = self.pool[_ranges(begin, many)].astype("<u4")
        return out, np.append(np.cumsum(many) - many, len(out))[np.searchsorted(starts, at)]

    def encode(self, col: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        data, at = text_buffers(col)
        odd = np.zeros(len(at) - 1, bool)
        if self.by_parts:
            raw = data.tobytes()
            spots = [np.flatnonzero(_ODD[data])]
            c3 = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
            spots.append(c3[(data[c3 + 1] == 0x97) | (data[c3 + 1] == 0xB7)])
            for s in self.special:
                spots.append(np.array([m.start() for m in re.finditer(re.escape(s), raw)], np.int64))
            odd[np.searchsorted(at, np.concatenate(spots), "right") - 1] = True
        else:
            odd[:] = True
        out: list[bytes] = [b""] * len(odd)
        plain = np.flatnonzero(~odd & (np.diff(at) > 0))
        if len(plain):
            size = np.diff(at)[plain]
            ends = np.cumsum(size)
            joined = data if len(plain) == len(odd) else np.concatenate([data[at[i] : at[i + 1]] for i in plain])
            ids, place = self._by_parts(joined, np.append(0, ends))
            for k, i in enumerate(plain.tolist()):
                out[i] = ids[place[k] : place[k + 1]].tobytes()
        whole = np.flatnonzero(odd).tolist()
        if whole:
            found = self.library.encode_batch_fast([data[at[i] : at[i + 1]].tobytes().decode() for i in whole], add_special_tokens=False)
            for i, e in zip(whole, found, strict=True):
                out[i] = np.array(e.ids, "<u4").tobytes()
        return out


class ShardWriter:
    def __init__(self, sink):
        self.sink, self.rest, self.waiting, self.at = sink, [], 0, len(MAGIC)
        self.blocks: list[list[int]] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.press = zstandard.ZstdCompressor(level=3)
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(ids) // 4)
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 4 * BLOCK:
            whole = b"".join(self.rest)
            cut = len(whole) - len(whole) % (4 * BLOCK)
            for i in range(0, cut, 4 * BLOCK):
                self._block(whole[i : i + 4 * BLOCK])
            self.rest, self.waiting = [whole[cut:]], len(whole) - cut

    def _block(self, ids: bytes) -> None:
        planes = np.frombuffer(ids, np.uint8).reshape(-1, 4).T
        packed = [self.press.compress(p.tobytes()) for p in planes]
        self.blocks.append([self.at, len(ids) // 4, *map(len, packed)])
        for p in packed:
            self.sink.write(p)
            self.at += len(p)

    def close(self) -> tuple[int, int]:
        if self.waiting:
            self._block(b"".join(self.rest))
        index = self.press.compress(json.dumps({"blocks": self.blocks, "docs": self.docs, "sizes": self.sizes}).encode())
        self.sink.write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.sink.close()
        return len(self.docs), sum(self.sizes)


class ShardReader:
    """Random access to the blocks of a shard, and its documents one by one."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - 16)
        tail = source.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a shard file, or cut short")
        n = int.from_bytes(tail[:8], "little")
        source.seek(size - 16 - n)
        self.open = zstandard.ZstdDecompressor()
        index = json.loads(self.open.decompress(source.read(n)))
        self.blocks, self.docs, self.sizes = index["blocks"], index["docs"], index["sizes"]

    def block(self, i: int) -> bytes:
        at, n, *sizes = self.blocks[i]
        self.source.seek(at)
        planes = np.empty((4, n), np.uint8)
        for k, size in enumerate(sizes):
            planes[k] = np.frombuffer(self.open.decompress(self.source.read(size)), np.uint8)
        return planes.T.tobytes()

    def documents(self) -> Iterator[tuple[int | None, list[bytes]]]:
        """Each document's id and its ids, as pieces that lie in successive blocks."""
        k, have, at = 0, b"", 0
        for doc, size in zip(self.docs, self.sizes, strict=True):
            need, pieces = 4 * size, []
            while need:
                if at == len(have):
                    have, at, k = self.block(k), 0, k + 1
                take = min(need, len(have) - at)
                pieces.append(have[at : at + take])
                at, need = at + take, need - take
            yield doc, pieces


_ENCODERS: dict[str, Encoder] = {}


def _written(folder: str, tokenizer, name_of: str, end_id: int):
    """tokenizer: the broadcast text of a file, which executors need not see; name_of: its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if name_of not in _ENCODERS:
            _ENCODERS[name_of] = Encoder(tokenizer.value)
        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        writer, name, end = None, f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.ink", end_id.to_bytes(4, "little")
        for batch in batches:
            for part in chunks(batch, "text"):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    writer = ShardWriter(store.open_output_stream(f"{root}/{name}", compression=None))
                ids = _ENCODERS[name_of].encode(part.column("text"))
                for doc, own in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    writer.add(doc, own + end)
        if writer is not None:
            docs, size = writer.close()
            yield pa.RecordBatch.from_pydict({"shard": [task.partitionId()], "file": [f"{folder}/{name}"], "n_docs": [docs], "n_ids": [size]})

    return trimmed(run)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "file"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        for row in batch.to_pylist():
            store, path = fs.FileSystem.from_uri(row["file"])
            start, rows = row["before"], []
            with store.open_input_file(path) as source:
                for doc, pieces in ShardReader(source).documents():
                    crc = 0
                    for p in pieces:
                        crc = zlib.crc32(p, crc)
                    size = sum(map(len, pieces)) // 4
                    rows.append((doc, start, size, crc, row["file"]))
                    start += size
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, scratch: Scratch) -> DataFrame:
    """Encode docs (doc_id, text) into shard files in ascending order of doc_id; returns the manifest, a row per shard.

    Each text is followed by end_id. Null texts are empty, null doc_ids come first, and rows with the same doc_id
    stand in the order of their texts. The manifest has shard, file, n_docs, n_ids. tokenizer is a path that the driver reads.
    """
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    shared, name = docs.sparkSession.sparkContext.broadcast(text), hashlib.sha256(text.encode()).hexdigest()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return scratch.write(dealt.mapInArrow(_written(folder, shared, name, end_id), "shard long, file string, n_docs long, n_ids long"), "manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, file of every document, from the files that the manifest lists."""
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("shard", "file", before.alias("before"))  # a row per shard, not per document
    dealt = files.repartitionByRange(max(1, manifest.count()), "shard")
    return dealt.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string")


def token_store(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write docs as token shards (to folder, a URI all executors reach, or the shared scratch folder) and read them back.

    See write_tokens for nulls, ties and repeated rows. start counts the ids of all documents before it. An
    empty table writes no file and gives an empty result. Other columns of docs are ignored.
    """
    scratch = Scratch(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder or scratch.path("shards"), tokenizer, end_id, scratch))
