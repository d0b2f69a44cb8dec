"""Token counts of a byte-level BPE with word ends, by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a batch lie one after the other in one array of symbol ids. A round looks up
the rank of every neighbouring pair that changed, takes the lowest rank of each sequence, and applies it
in all sequences at once; sequences without a mergeable pair leave. The surviving symbols are counted.
A pre-token's count is kept for later batches in a bounded cache.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from ..ship import ensure_shipped
from .hashing import chunks, trimmed
from .scratch import small_batches

#: The parts of the tokenizer's split pattern, and the white space of Unicode.
SUFFIXES = r"'s|'t|'re|'ve|'m|'ll|'d"
WHITE = "\\t-\\r \x85\xa0  -     　"
ANY_SCRIPT = regex.compile(rf"{SUFFIXES}|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
#: The same for texts below U+0250, with the letters and numbers there listed.
LATIN = re.compile(rf"{SUFFIXES}|[a-zA-Zªµº\xc0-\xd6\xd8-\xf6\xf8-ɏ]+|[0-9²³¹¼½¾]|[^{WHITE}a-zA-Zªµº\xc0-\xd6\xd8-\xf6\xf8-ɏ0-9²³¹¼½¾]+")
BEYOND_LATIN = re.compile("[^\x00-ɏ]")
NONE = np.iinfo(np.int32).max
CACHED = 300_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


def check_rules(spec: dict) -> None:
    steps = spec.get("normalizer") or {}
    forms = [s.get("type") for s in steps.get("normalizers", [steps])]
    first = spec.get("pre_tokenizer") or {}
    parts = [s.get("type") for s in first.get("pretokenizers", [first])]
    if spec["model"].get("type", "BPE") != "BPE" or "NFC" not in forms or "Lowercase" not in forms or set(forms) - {"NFC", "Lowercase", "Replace"} or parts != ["Split", "ByteLevel"]:
        raise ValueError(f"not a tokenizer of this kind: normalisers {forms}, pre-tokenisers {parts}")


class RankMerger:
    """Counts the symbols that byte sequences have after all merges."""

    def __init__(self, text: str):
        """text: what a tokenizers file holds. Raises ValueError for a file with other rules than those built in here."""
        spec = json.loads(text)
        check_rules(spec)
        model = spec["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.special = [t["content"] for t in spec["added_tokens"]]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[m[i]] for m in merges], np.int64) for i in (0, 1))
        made = np.array([vocab[m[0] + m[1]] for m in merges], np.int64)
        self.width = len(vocab) + 1
        key = left * self.width + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int32)
        self.made = made
        # a merge may be applied to all its places at once unless its result takes part in an earlier merge
        first = np.full(self.width, NONE, np.int64)
        np.minimum.at(first, left, np.arange(len(merges)))
        np.minimum.at(first, right, np.arange(len(merges)))
        self.at_once = first[made] > np.arange(len(merges))
        symbols = byte_symbols()
        self.inner = np.array([vocab[c] for c in symbols], np.int64)
        self.final = np.array([vocab[c + end] for c in symbols], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Symbols of each word (none is empty) when no merge is left."""
        size = np.array([len(w) for w in words], np.int64)
        out = size.copy()
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids = self.inner[raw]
        ends = np.cumsum(size)
        ids[ends - 1] = self.final[raw[ends - 1]]
        who = np.arange(len(words))
        rank = np.full(len(ids), NONE, np.int32)
        rank[:-1] = self.rank(ids[:-1], ids[1:])
        rank[ends - 1] = NONE
        while len(who):
            starts = np.r_[0, np.cumsum(size)[:-1]]
            least = np.minimum.reduceat(rank, starts)
            over = least == NONE
            if over.any():
                out[who[over]] = size[over]
                stay = np.repeat(~over, size)
                ids, rank, who, size, least = ids[stay], rank[stay], who[~over], size[~over], least[~over]
                if not len(who):
                    break
                starts = np.r_[0, np.cumsum(size)[:-1]]
            seq = np.repeat(np.arange(len(who)), size)
            hit = np.flatnonzero(rank == least[seq])
            owner = seq[hit]
            # places that touch form a run; every second place of a run merges
            fresh = np.r_[True, (hit[1:] != hit[:-1] + 1) | (owner[1:] != owner[:-1])]
            nth = np.arange(len(hit)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            lead = np.r_[True, owner[1:] != owner[:-1]]
            hit, owner = (x[(nth % 2 == 0) & (lead | self.at_once[least[owner]])] for x in (hit, owner))
            ids[hit] = self.made[least[owner]]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            rank[hit] = rank[hit + 1]
            to = np.cumsum(keep) - 1
            ids, rank, seq = ids[keep], rank[keep], seq[keep]
            size = size - np.bincount(owner, minlength=len(size))
            at = to[hit]
            for i in (at, at[at > 0] - 1):
                i = i[i + 1 < len(ids)]
                i = i[seq[i] == seq[i + 1]]
                rank[i] = self.rank(ids[i], ids[i + 1])
            last = np.cumsum(size) - 1
            rank[last] = NONE
        return out


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text without special strings: NFC, lower case, white space dropped."""
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    return (ANY_SCRIPT if BEYOND_LATIN.search(text) else LATIN).findall(text)


class TokenCounter:
    def __init__(self, text: str):
        self.merger = RankMerger(text)
        self.special = re.compile("|".join(map(re.escape, self.merger.special)) or r"(?!)")
        self.cache: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        words, extra = [], []
        for text in texts:
            if "<|" in text:
                parts = self.special.split(text)
                words.append([w for p in parts for w in pre_tokens(p)])
                extra.append(len(parts) - 1)
            else:
                words.append(pre_tokens(text))
                extra.append(0)
        new = list(set().union(*words) - self.cache.keys())
        if new:
            if len(self.cache) + len(new) > CACHED:
                self.cache.clear()
                new = list(set().union(*words))
            found = self.merger.count([w.encode("utf-8", "surrogatepass") for w in new])
            self.cache.update(zip(new, found.tolist(), strict=True))
        known = self.cache.__getitem__
        return [sum(map(known, w)) + e for w, e in zip(words, extra, strict=True)]


_COUNTERS: dict[str, TokenCounter] = {}


def _counted(tokenizer, name: str):
    """tokenizer: the broadcast text of a file, which executors need not see; name: its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _COUNTERS:
            _COUNTERS[name] = TokenCounter(tokenizer.value)
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = part.column("text").fill_null("").to_pylist()
                size = pa.array([len(t.encode()) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), size, pa.array(_COUNTERS[name].counts(texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return trimmed(run)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs (doc_id, text; other columns are ignored).

    tokenizer is the path, as the driver reads it, of a tokenizers JSON file with a BPE model, NFC and lower-case normalisation and
    byte-level symbols; another kind of file is refused. Its special strings in a text count as one token each. Null texts are empty: 0 bytes,
    0 tokens. Null or repeated doc_ids pass through, one output row per input row. No shuffle; memory is
    bounded by one slice of a batch and the cache.
    """
    ensure_shipped(docs.sparkSession)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    shared, name = docs.sparkSession.sparkContext.broadcast(text), hashlib.sha256(text.encode()).hexdigest()
    counted = rows.mapInArrow(_counted(shared, name), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
