"""Language identification by a byte convolutional network, trained and applied in numpy.

The input is a window of bytes. Filters of widths 2, 3 and 4 slide over it; a filter has a weight for every
byte value at each of its places, so that a convolution is a sum of table rows. Each filter's maximum over
the window passes a ReLU, and a softmax layer gives the languages' probabilities. Training backpropagates
through the places of the maxima with Adam. A text is cut into windows from its first byte to its last, and
its probabilities are the means over its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import chunks, text_buffers, trimmed
from .scratch import Scratch

WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 12
_PAD = max(WIDTHS) - 1
_STEP = 1 << 15


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class ByteConvNet:
    """tables[k] are the (256, filters) weights at place k; filters of width w have zeros at places w and above."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.filters = FILTERS * len(WIDTHS)
        used = np.repeat(WIDTHS, FILTERS)[None, :] > np.arange(max(WIDTHS))[:, None]
        self.used = used.astype(np.float32)
        self.params = {
            "tables": (rng.normal(0, 0.3, (max(WIDTHS), 256, self.filters)) * used[:, None, :]).astype(np.float32),
            "bias": np.zeros(self.filters, np.float32),
            "out": rng.normal(0, 0.2, (self.filters, len(languages))).astype(np.float32),
            "out_bias": np.zeros(len(languages), np.float32),
        }

    def _softmax(self, hidden: np.ndarray) -> np.ndarray:
        z = hidden @ self.params["out"] + self.params["out_bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        """windows: (n, WINDOW + pad) bytes, zeros after the end of a text."""
        rng = np.random.default_rng(seed)
        p = self.params
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
        t, steps = 0, epochs * max(1, len(windows) // batch)
        f = np.arange(self.filters)
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for i in range(0, len(order), batch):
                x, y = windows[order[i : i + batch]], labels[order[i : i + batch]]
                conv = sum(p["tables"][k][x[:, k : k + WINDOW]] for k in range(max(WIDTHS)))
                place = conv.argmax(axis=1)
                top = np.take_along_axis(conv, place[:, None, :], 1)[:, 0] + p["bias"]
                hidden = np.maximum(top, 0)
                prob = self._softmax(hidden)
                prob[np.arange(len(y)), y] -= 1
                d = prob / len(y)
                dh = (d @ p["out"].T) * (top > 0)
                grad = {"out": hidden.T @ d, "out_bias": d.sum(0), "bias": dh.sum(0), "tables": np.zeros_like(p["tables"])}
                rows = np.arange(len(y))[:, None]
                for k in range(max(WIDTHS)):
                    np.add.at(grad["tables"][k], (x[rows, place + k], np.broadcast_to(f, place.shape)), dh * self.used[k])
                t += 1
                now = rate * (1 - 0.9 * t / max(steps, t))
                for name, g in grad.items():
                    m, v = moment[name]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p[name] -= now * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    def pack(self) -> None:
        """Join the places in pairs, so that two table rows make a convolution."""
        t, a, b = self.params["tables"], np.repeat(np.arange(256), 256), np.tile(np.arange(256), 256)
        self.front = np.ascontiguousarray(t[0][a] + t[1][b] + self.params["bias"])
        self.rear = np.ascontiguousarray((t[2][a] + t[3][b])[:, FILTERS:])

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Mean probabilities over the windows of each text, (texts, languages)."""
        size = np.diff(at)
        # texts one after the other, each followed by zeros enough that no window sees the next text
        flat = np.zeros(len(data) + 2 * _PAD * (len(size) + 1), np.uint8)
        shift = 2 * _PAD * np.arange(len(size))
        flat[np.arange(len(data)) + np.repeat(shift, size)] = data
        begin = at[:-1] + shift
        many = -(-size // WINDOW)
        first = np.cumsum(many) - many
        starts = np.repeat(begin, many) + WINDOW * (np.arange(many.sum()) - np.repeat(first, many))
        ends = np.minimum(starts + WINDOW, np.repeat(begin + size + _PAD, many))
        pair = flat[:-1].astype(np.uint16) * np.uint16(256) + flat[1:]
        hidden = np.empty((len(starts), self.filters), np.float32)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + _STEP)))
            low = starts[i]
            high = ends[j - 1] + 1
            conv = np.take(self.front, pair[low:high], axis=0)
            conv[:, FILTERS:] += np.take(self.rear, pair[low + 2 : high + 2], axis=0)
            hidden[i:j] = np.maximum.reduceat(conv, np.column_stack([starts[i:j], ends[i:j]]).ravel() - low, axis=0)[::2]
            i = j
        prob = self._softmax(np.maximum(hidden, 0))
        out = np.zeros((len(size), len(self.languages)))
        full = many > 0
        out[full] = np.add.reduceat(prob, first[full], axis=0) / many[full, None]
        return out


def training_windows(raw: np.ndarray, per_text: int, seed: int) -> np.ndarray:
    """Random windows of a text's bytes, of random lengths, some short."""
    rng = np.random.default_rng(seed & ((1 << 64) - 1))
    rows = np.zeros((per_text, WINDOW + _PAD), np.uint8)
    for row in rows:
        size = WINDOW if rng.random() < 0.6 else int(rng.integers(12, WINDOW))
        low = int(rng.integers(0, max(1, len(raw) - size + 1)))
        part = raw[low : low + size]
        row[: len(part)] = part
    return rows


def _cut(per_text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                data, at = text_buffers(part.column("text"))
                h, known = part.column("h").to_pylist(), [has_letter(t) for t in part.column("text").to_pylist()]
                cut = [training_windows(data[at[i] : at[i + 1]], per_text, h[i]).tobytes() if known[i] else None for i in range(len(h))]
                yield pa.RecordBatch.from_arrays([part.column("h"), part.column("lang"), pa.array(cut, pa.binary())], ["h", "lang", "windows"])

    return trimmed(run)


def train_language_model(labelled: DataFrame, most: int = 4000, per_text: int = 3) -> ByteConvNet | None:
    """Fit on at most `most` rows of (doc_id, text, lang), those whose hashed doc_ids are least, and `per_text` windows of
    each, which are cut on the executors. None without labels."""
    Scratch(labelled.sparkSession, "language")  # executors need the package from here on
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang", F.xxhash64("doc_id").alias("h"))
    rank = rows.select("h").orderBy("h").limit(most).agg(F.max("h")).first()[0]
    if rank is None:
        return None
    cut = rows.where(F.col("h") <= rank).select("text", "lang", "h").mapInArrow(_cut(per_text), "h long, lang string, windows binary")
    sample = cut.where("windows is not null").orderBy("h", "lang", "windows").limit(most).collect()
    if not sample:
        return None
    languages = sorted({r["lang"] for r in sample})
    x = np.frombuffer(b"".join(r["windows"] for r in sample), np.uint8).reshape(-1, WINDOW + _PAD)
    net = ByteConvNet(languages)
    net.train(x, np.repeat([languages.index(r["lang"]) for r in sample], per_text))
    net.pack()
    return net


def _predicted(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        for batch in batches:
            for part in chunks(batch, "text"):
                known = [has_letter(t) for t in part.column("text").to_pylist()]
                if net is None:
                    lang, score = ["und"] * len(known), [0.0] * len(known)
                else:
                    prob = net.scores(*text_buffers(part.column("text")))
                    best = prob.argmax(axis=1)
                    lang = [net.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
                    score = [float(min(1.0, p[b])) if k else 0.0 for p, b, k in zip(prob, best, known, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.drop_columns(["text"]).columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*part.drop_columns(["text"]).schema.names, "lang_pred", "score"])

    return trimmed(run)


def predict_language(docs: DataFrame, model: ByteConvNet | None) -> DataFrame:
    """doc_id, lang_pred, score for each row of docs (doc_id, text; other columns are ignored).

    lang_pred is `und` with score 0 for null texts and texts without letters, and for all rows without a model.
    Null and repeated doc_ids pass through. No shuffle; the broadcast model has a fixed size (about 16 MB).
    """
    Scratch(docs.sparkSession, "language")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predicted(shared), "doc_id long, lang_pred string, score double")


def held_out(column: str, parts: int, rest: int):
    """crc32 of the id as text, modulo parts, is rest; false for null."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts)) == rest, F.lit(False))


def language_id(docs: DataFrame, most: int = 4000) -> DataFrame:
    """Train on the rows of docs (doc_id, text, lang) with crc32(doc_id) mod 4 other than 2; predict for all rows."""
    named = docs.select("doc_id", "text", "lang")
    model = train_language_model(named.where(~held_out("doc_id", 4, 2) & F.col("doc_id").isNotNull()), most)
    return predict_language(docs, model).withColumn("held_out", held_out("doc_id", 4, 2))
