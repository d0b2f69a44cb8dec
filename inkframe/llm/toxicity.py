"""Toxicity by a support vector machine over a subsequence string kernel with Nystroem landmarks.

The kernel compares words by the three-letter subsequences that they share, gaps included: a subsequence
that spans g letters weighs DECAY**g, and spans of more than SPAN letters weigh nothing. Words are bounded
by marks, folded to plain letters, and stripped of what is not a letter; single letters that stand apart
are one word. So `id-iot`, `i d i o t`, `idxiot` and an insult with a new ending stay close to the insult.

Labelled are texts, not words, so the machine is trained with a multiple-instance loss: a text is a bag of words and its
margin that of its worst word. A toxic text asks for one word on the toxic side, a clean one for none. Training goes in turns:
each toxic text's witness is the word of greatest margin, unless none comes near (labels have errors); the words of clean texts
are the other side, with the hardest added; then the machine is fitted anew. The first witnesses are the words that set toxic
texts apart. Each word becomes its kernel values with the landmarks, whitened by the landmarks' own kernel matrix (Nystroem); a
linear SVM on these is the kernel SVM. As kernel values are dot products of explicit subsequence vectors, the trained machine
folds into one weight per subsequence. The margin decides: the score is a logistic function of it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .hashing import chunks, trimmed
from .language_id import held_out
from .scratch import Scratch

DECAY, SPAN, LETTERS = 0.6, 6, 29
LANDMARKS, CACHED, TURNS = 128, 200_000, 4
_STANDS_FOR = str.maketrans("013457@$", "oieastas")
_APART = re.compile(r"(?<!\S)(?:[^\W\d_][\s.\-_*]+){2,}[^\W\d_](?!\S)")


def codes(word: str) -> list[int]:
    """Letters of a word as 0 to 25, any other letter as 26, between the marks 27 and 28; empty without letters."""
    word = word.lower()
    if not word.isascii():
        word = unicodedata.normalize("NFKD", word)
    letters = [min(ord(c) - 97, 26) if c >= "a" else 26 for c in word.translate(_STANDS_FOR) if c.isalpha()]
    return [27, *letters, 28] if letters else []


def subsequences(words: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of the kernel's feature vectors, each of length 1, sorted by word."""
    size = np.array([len(w) for w in words], np.int64)
    flat = np.array([c for w in words for c in w], np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(flat))  # letters from here to the end of the word
    keys, weights = [], []
    for j in range(1, SPAN - 1):
        for k in range(j + 1, SPAN):
            i = np.flatnonzero(left > k)
            keys.append(owner[i] * LETTERS**3 + (flat[i] * LETTERS + flat[i + j]) * LETTERS + flat[i + k])
            weights.append(np.full(len(i), DECAY ** (k + 1)))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    if not len(key):
        return key, key, weight
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    key, weight = key[first], np.add.reduceat(weight, first)
    word = key // LETTERS**3
    norm = np.sqrt(np.bincount(word, weight**2, minlength=len(words)))
    return word, key % LETTERS**3, weight / norm[word]


def vectors(words: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(words), LETTERS**3), np.float32)
    word, sub, weight = subsequences(words)
    out[word, sub] = weight
    return out


def kernel(words: list[list[int]], landmarks: np.ndarray) -> np.ndarray:
    """Kernel values of words with landmark vectors."""
    word, sub, weight = subsequences(words)
    out = np.zeros((len(words), len(landmarks)))
    if len(word):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out[word[first]] = np.add.reduceat(landmarks.T[sub] * weight[:, None], first, axis=0)
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 60, seed: int = 3) -> np.ndarray:
    """Weights (the last is the bias) of a linear SVM with squared hinge loss, by dual coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1))])
    rng, w, a = np.random.default_rng(seed), np.zeros(x.shape[1]), np.zeros(len(x))
    q = (x * x).sum(1) + 0.5 / cost
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + a[i] * 0.5 / cost
            new = max(0.0, a[i] - g / q[i])
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                a[i] = new
    return w


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + ridge * w)
    return w


def words_of(text: str) -> list[str]:
    """White-space words of a text, and the words that letters standing apart make."""
    return text.split() + [m.group() for m in _APART.finditer(text)]


def plain_words(words: list[str]) -> list[str]:
    """The different words in lower case, without what is not a letter at their ends."""
    return list(dict.fromkeys(w for w in (re.sub(r"[\W\d_]+$|^[\W\d_]+", "", x.lower()) for x in words) if w))


class ToxicityModel:
    def __init__(self, words: list[str], clean_texts: np.ndarray, toxic_texts: np.ndarray, sizes: tuple[int, int], toxic_bags: list[list[str]]):
        """words: all plain words, each once, with how many clean and toxic texts hold it; sizes: how many clean and toxic texts there are;
        toxic_bags: the plain words of each toxic text. To be calibrated before it scores."""
        held = {w: (int(c), int(t)) for w, c, t in zip(words, clean_texts, toxic_texts, strict=True) if t}
        n = sizes
        odds = {w: np.log((t + 0.1) / (n[1] + 0.2)) - np.log((c + 0.1) / (n[0] + 0.2)) for w, (c, t) in held.items()}
        strength = {w: odds[w] * np.sqrt(held[w][1]) for w in odds}
        order = sorted((i for i in range(len(words)) if clean_texts[i]), key=lambda i: (-clean_texts[i], words[i]))
        clean = [words[i] for i in order]
        rng = np.random.default_rng(1)
        ranked = sorted((w for w in odds if odds[w] > 1 and held[w][1] > 1), key=lambda w: (-strength[w], w))
        plain = clean[: LANDMARKS // 4] + [clean[i] for i in rng.permutation(len(clean))[: LANDMARKS // 4]]
        marks = [m for m in map(codes, dict.fromkeys(ranked[: LANDMARKS // 2] + plain)) if m]
        self.landmarks = vectors(marks)
        values, basis = np.linalg.eigh(self.landmarks @ self.landmarks.T)
        keep = values > 1e-6
        self.whiten = basis[:, keep] / np.sqrt(values[keep])
        # a toxic text's witnesses are its strongest words, and those alike strong
        witness: set[str] = set()
        for bag in toxic_bags:
            known = [w for w in bag if odds[w] > 1 and codes(w)]
            top = max((strength[w] for w in known), default=0)
            witness.update(w for w in known if top > 0 and strength[w] >= 0.5 * top)
        good = [w for w in clean if codes(w) and w not in witness]
        negatives = set(good[:3000]) | {good[i] for i in rng.permutation(len(good))[:3000]}
        listed = sorted(w for w in held if codes(w))
        place = {w: i for i, w in enumerate(listed)}
        toxic = [np.array(sorted(place[w] for w in bag if w in place), np.int32) for bag in toxic_bags]
        toxic = [bag for bag in toxic if len(bag)]
        for _ in range(TURNS):
            # with a letter put in, so that the machine meets such words
            longer = [w[: i] + "abcdefghijklmnopqrstuvwxyz"[c] + w[i:] for w in sorted(witness) if len(w) > 3 for i, c in [(int(rng.integers(2, len(w))), int(rng.integers(0, 26)))]]
            positives, against = sorted(witness) + longer, sorted(negatives - witness)
            x = self._features([codes(w) for w in positives + against])
            self._fold(linear_svm(x, np.r_[np.ones(len(positives)), -np.ones(len(against))], rounds=25))
            margin = self.margins(good)
            negatives |= {good[i] for i in np.argsort(-margin, kind="stable")[:1000] if margin[i] > -1}
            told = self.margins(listed)
            best = np.array([bag[told[bag].argmax()] for bag in toxic], np.int64)
            # a word that is as usual in clean texts is no witness, whatever it looks like
            found = {listed[i] for i in best[told[best] > -0.5].tolist() if odds[listed[i]] > 0}
            witness = found or witness
        del self.landmarks, self.whiten  # the weights hold all that scores need

    def calibrate(self, worst: np.ndarray, labels: np.ndarray) -> None:
        """worst: the highest margin of each text."""
        self.calibration = logistic(worst[:, None], labels)

    def _features(self, words: list[list[int]]) -> np.ndarray:
        # 100 words have some 8000 subsequences, of which each meets all landmarks
        return np.vstack([kernel(words[i : i + 100], self.landmarks) for i in range(0, len(words), 100)]) @ self.whiten

    def _fold(self, w: np.ndarray) -> None:
        self.weights, self.bias = self.landmarks.T.astype(np.float64) @ (self.whiten @ w[:-1]), w[-1]
        self.cache, self.older = {}, {}

    def margins(self, words: list[str]) -> np.ndarray:
        """SVM margin of each word; -2 without letters."""
        out = np.full(len(words), -2.0)
        for i in range(0, len(words), 1_000):
            coded = [codes(w) for w in words[i : i + 1_000]]
            word, sub, weight = subsequences(coded)
            some = np.array([bool(c) for c in coded])
            out[i : i + 1_000][some] = (np.bincount(word, weight * self.weights[sub], minlength=len(coded)) + self.bias)[some]
        return out

    def worst(self, words: list[list[str]]) -> np.ndarray:
        """The highest margin of the words of each text."""
        new = set().union(*words)
        if len(self.cache) + len(new) > CACHED:
            self.older, self.cache = self.cache, {}
        new -= self.cache.keys()
        again = new & self.older.keys()
        self.cache.update((w, self.older[w]) for w in again)
        new = list(new - again)
        self.cache.update(zip(new, self.margins(new).tolist(), strict=True))
        known = self.cache.__getitem__
        return np.array([max(-2.0, max(map(known, w), default=-2.0)) for w in words])

    def scores(self, texts: list[str]) -> np.ndarray:
        z = self.worst([words_of(t) for t in texts]) * self.calibration[0] + self.calibration[1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _bags(most_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = [list(dict.fromkeys(words_of(t)))[:most_words] for t in part.column("text").to_pylist()]
                listed = [pa.array(x, pa.list_(pa.string())) for x in (words, map(plain_words, words))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), *listed], ["doc_id", "toxic", "words", "bag"])

    return trimmed(run)


def _worst(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            worst = model.worst(batch.column("words").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(worst, pa.float64())], ["doc_id", "toxic", "worst"])

    return trimmed(run)


def train_toxicity(labelled: DataFrame, docs: DataFrame, most: int = 6000, most_words: int = 4000) -> ToxicityModel | None:
    """Fit on at most `most` labelled rows, those whose hashed doc_ids are least. None unless both labels occur.

    labelled has doc_id and toxic (0 or 1), docs has doc_id and text. The sample is bounded by `most` rows, and `most_words` different
    words of each; it stays on the executors. The driver gets its different words with their counts, the words of toxic texts, and
    a margin of each text. Of texts that share a doc_id the one that sorts first is learned from.
    """
    scratch = Scratch(docs.sparkSession, "toxicity-sample")
    ids = labelled.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    sample = ids.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(most).collect()
    chosen = docs.sparkSession.createDataFrame(sample, ids.schema) if sample else ids.limit(0)
    rows = docs.where("text is not null").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    bags = scratch.write(rows.mapInArrow(_bags(most_words), "doc_id long, toxic int, words array<string>, bag array<string>"), "bags")
    sizes = {r["toxic"]: r["n"] for r in bags.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        scratch.drop("bags")
        return None
    held = bags.select("toxic", F.explode("bag").alias("word")).groupBy("word").agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic")).toArrow()
    toxic = bags.where("toxic = 1").select("bag").toArrow().column("bag")
    model = ToxicityModel(held.column("word").to_pylist(), held.column("clean").to_numpy(), held.column("toxic").to_numpy(), (sizes[0], sizes[1]), toxic.to_pylist())
    shared = docs.sparkSession.sparkContext.broadcast(model)
    worst = bags.mapInArrow(_worst(shared), "doc_id long, toxic int, worst double").toArrow().sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
    model.calibrate(worst.column("worst").to_numpy(), worst.column("toxic").to_numpy())
    shared.unpersist()
    scratch.drop("bags")
    return model


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = part.column("text").fill_null("").to_pylist()
                score = model.scores(texts) if model is not None else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    return trimmed(run)


def toxicity(docs: DataFrame, labels: DataFrame, most: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs (doc_id, text); labels has doc_id and toxic.

    Rows with crc32(doc_id) mod 5 = 0 are held out of training. Null and empty texts get the score of a text
    without a toxic word; without usable labels all scores are 0. Null and repeated doc_ids pass through. Other
    columns are ignored. The model is some 0.2 MB whatever the input.
    """
    Scratch(docs.sparkSession, "toxicity")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train_toxicity(labels.where(~held_out("doc_id", 5, 0)), rows, most))
    scored = rows.mapInArrow(_scored(model), "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
