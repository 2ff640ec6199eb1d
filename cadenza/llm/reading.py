"""Reading level of whole documents, 1 (easiest) to 5, from sentences.

Every sentence's level is classified by a regularised linear model over its words and their character n-grams; the
sentences' distributions, weighted by words and by sentences, are the features of a second, equally small model that
is calibrated on held-out folds of the labelled documents. Both are trained here, the folds side by side, from a bounded
number of labelled documents; scoring is one pass in Arrow batches without a shuffle.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEVELS = 5
MIN_WORDS = 70
TRAINING_DOCUMENTS = 1_000  # labelled documents the models are fitted on, the smallest hashes of their ids
FOLDS = 3  # held out in turn for the calibration
SUPPORT = 2  # labelled documents in which a feature must stand
HASHED = 1 << 16
CACHED_WORDS = 400_000
AT_ONCE_CHARS = 4_000_000  # texts scored at once hold about so many characters

_SENTENCE = re.compile(r"(?<=[.!?…])[\"»”’)\]]*\s+|[\r\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_COUNTED = re.compile(r"[^\W_]+")


def sentences(text: str) -> list[list[str]]:
    """The lower-cased words of each sentence, and its shape as words of its own; a line break ends a sentence too."""
    return [[*w, *_shape(w), *_shape(w)] for s in _SENTENCE.split(text) if (w := _WORD.findall(s.lower()))]


def _shape(words: list[str]) -> tuple[str, str]:
    """Its length and its words' mean length, in steps: few labelled documents know few words."""
    return f"#l{min(9, int(2 * math.log2(len(words))))}", f"#w{min(9, sum(map(len, words)) // len(words))}"


def word_features(word: str) -> list[str]:
    if word[0] == "#":
        return [f"w{word}"]
    marked = f"<{word}>"
    return [f"w{word}", *(marked[i : i + n] for n in (2, 3, 4, 5) for i in range(len(marked) - n + 1))]


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode()) % HASHED


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _fit(x: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float, steps: int) -> np.ndarray:
    """Dense softmax regression by gradient descent with momentum (Adam); the last column of x is the constant."""
    theta = np.zeros((x.shape[1], target.shape[1]))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        g = x.T @ ((_softmax(x @ theta) - target) * weight[:, None]) / weight.sum() + penalty * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta


@dataclass
class SentenceModel:
    """theta[h] has the weights of hashed feature h; a word's score is the mean over its known features."""

    theta: np.ndarray
    known: np.ndarray
    constant: np.ndarray
    cache: dict[str, int] = field(default_factory=dict)
    rows: list[np.ndarray] = field(default_factory=list)

    def __getstate__(self) -> dict:
        at = np.flatnonzero(self.known)
        return {"at": at, "theta": self.theta[at].astype(np.float32), "constant": self.constant}

    def __setstate__(self, s: dict) -> None:
        self.theta, self.known = np.zeros((HASHED, LEVELS)), np.zeros(HASHED, bool)
        self.theta[s["at"]], self.known[s["at"]] = s["theta"], True
        self.constant, self.cache, self.rows = s["constant"], {}, []

    def _row(self, word: str) -> int:
        if len(self.cache) >= CACHED_WORDS:
            self.cache, self.rows = {}, []
        at = [h for f in word_features(word) if self.known[h := _hash(f)]]
        self.rows.append(self.theta[at].sum(0) / np.sqrt(len(at)) if at else np.zeros(LEVELS))
        self.cache[word] = len(self.rows) - 1
        return self.cache[word]

    def distributions(self, docs: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """Of all sentences of docs, one after another: the distribution over levels, and the number of words."""
        words = [w for d in docs for s in d for w in s]
        sizes = np.array([len(s) for d in docs for s in d])
        if len(self.cache) + len(set(words)) > CACHED_WORDS:
            self.cache, self.rows = {}, []
        for w in set(words):
            if w not in self.cache:
                self._row(w)
        table = np.array(self.rows)
        sums = np.add.reduceat(table[[self.cache[w] for w in words]], np.concatenate(([0], np.cumsum(sizes)[:-1])))
        return _softmax(sums / np.sqrt(sizes)[:, None] + self.constant), sizes


def fit_sentences(docs: list[list[list[str]]], targets: np.ndarray, penalty: float = 2e-6, steps: int = 120) -> SentenceModel:
    """Every sentence has its document's target and its share of the document's words as weight."""
    index: dict[str, int] = {}
    word_at, sizes, weight, owner = [], [], [], []
    seen: dict[int, set[int]] = defaultdict(set)
    features: list[list[int]] = []
    for d, doc in enumerate(docs):
        total = sum(map(len, doc))
        for s in doc:
            for w in s:
                if w not in index:
                    index[w] = len(index)
                    features.append([_hash(f) for f in word_features(w)])
                word_at.append(index[w])
            sizes.append(len(s))
            weight.append(len(s) / total)
            owner.append(d)
        for w in {w for s in doc for w in s}:
            for h in features[index[w]]:
                seen[h].add(d)
    known = np.zeros(HASHED, bool)
    known[[h for h, ds in seen.items() if len(ds) >= SUPPORT]] = True
    used = np.flatnonzero(known)  # the model is fitted over these alone
    place = np.full(HASHED, -1)
    place[used] = np.arange(len(used))
    kept = [[place[h] for h in f if known[h]] for f in features]
    counts = np.array([len(f) for f in kept])
    flat = np.array([h for f in kept for h in f], np.int64)
    of_word = np.repeat(np.arange(len(kept)), counts)
    scale = 1 / np.sqrt(np.maximum(counts, 1))
    word_at, sizes_, weight_ = np.array(word_at), np.array(sizes), np.array(weight)
    of_sentence = np.repeat(np.arange(len(sizes_)), sizes_)
    target = targets[np.array(owner)]
    theta, constant = np.zeros((len(used), LEVELS)), np.zeros(LEVELS)
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def gather(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(at, values[:, k], n) for k in range(LEVELS)], 1)

    for t in range(1, steps + 1):
        words = gather(theta[flat], of_word, len(kept)) * scale[:, None]
        z = gather(words[word_at], of_sentence, len(sizes_)) / np.sqrt(sizes_)[:, None] + constant
        error = (_softmax(z) - target) * (weight_ / weight_.sum())[:, None]
        constant -= 0.5 * error.sum(0)
        back = gather((error / np.sqrt(sizes_)[:, None])[of_sentence], word_at, len(kept)) * scale[:, None]
        g = gather(back[of_word], flat, len(used)) + penalty * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    whole = np.zeros((HASHED, LEVELS))
    whole[used] = theta
    return SentenceModel(whole, known, constant)


def document_features(model: SentenceModel, docs: list[list[list[str]]]) -> np.ndarray:
    """Mean distribution by words and by sentences, and the share of words whose most likely level is each."""
    p, sizes = model.distributions(docs)
    counts = np.array([len(d) for d in docs])
    start = np.concatenate(([0], np.cumsum(counts)[:-1]))
    words = np.add.reduceat(sizes, start)[:, None]
    by_words = np.add.reduceat(p * sizes[:, None], start) / words
    by_sentences = np.add.reduceat(p, start) / counts[:, None]
    modes = np.add.reduceat(np.eye(LEVELS)[p.argmax(1)] * sizes[:, None], start) / words
    return np.hstack([by_words, by_sentences, modes, np.ones((len(docs), 1))])


@dataclass
class ReadingModel:
    sentence: SentenceModel
    theta: np.ndarray

    def probabilities(self, docs: list[list[list[str]]]) -> np.ndarray:
        return _softmax(document_features(self.sentence, docs) @ self.theta)


def _parts(texts: list[str], targets: np.ndarray, folds: int) -> tuple[list[list[list[str]]], np.ndarray, list[list[int]]]:
    """Documents with words, their targets, and the places held out by each fold; the first fold holds out none."""
    docs = [sentences(t) for t in texts]
    kept = [i for i, d in enumerate(docs) if d]
    n = min(folds, len(kept))
    return [docs[i] for i in kept], targets[kept], [[], *([i for i in range(len(kept)) if i % n == f] for f in range(n))]


def _fit_part(docs: list[list[list[str]]], targets: np.ndarray, part: list[int]) -> tuple[SentenceModel, np.ndarray]:
    """The sentence model of the documents outside ``part``, and the features it gives those inside."""
    out = set(part)
    rest = [i for i in range(len(docs)) if i not in out] or [0]
    model = fit_sentences([docs[i] for i in rest], targets[rest])
    return model, document_features(model, [docs[i] for i in part]) if part else np.zeros((0, 3 * LEVELS + 1))


def _calibrated(targets: np.ndarray, parts: list[list[int]], fitted: list[tuple[SentenceModel, np.ndarray]]) -> ReadingModel:
    held = np.zeros((len(targets), 3 * LEVELS + 1))
    for part, (_, features) in zip(parts[1:], fitted[1:], strict=True):
        held[part] = features
    return ReadingModel(fitted[0][0], _fit(held, targets, np.ones(len(targets)), 1e-3, 1000))


def fit(texts: list[str], targets: np.ndarray, folds: int = FOLDS) -> ReadingModel:
    """targets: a distribution over levels for each text. Always calibrated on held-out folds, as many as there are texts
    where these are fewer; a single text leaves none to hold out."""
    docs, targets, parts = _parts(texts, targets, folds)
    return _calibrated(targets, parts, [_fit_part(docs, targets, p) for p in parts])


def fit_on_cluster(spark: SparkSession, texts: list[str], targets: np.ndarray, folds: int = FOLDS) -> ReadingModel:
    """As ``fit``; the whole model and those of the folds are fitted by a task each, which get the bounded sample by
    broadcast and send back their models (no more than the known features' weights)."""
    held = spark.sparkContext.broadcast((texts, targets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for f in b.column(0).to_pylist():
                docs, wanted, parts = _parts(*held.value, folds)
                if f < len(parts):
                    yield pa.RecordBatch.from_arrays([pa.array([f]), pa.array([pickle.dumps(_fit_part(docs, wanted, parts[f]))], pa.binary())], names=["part", "fitted"])

    rows = spark.range(0, folds + 1, 1, folds + 1).mapInArrow(run, "part bigint, fitted binary").collect()
    docs, wanted, parts = _parts(texts, targets, folds)
    fitted = [pickle.loads(r.fitted) for r in sorted(rows, key=lambda r: r.part)]  # noqa: S301 - made by the tasks above
    return _calibrated(wanted, parts, fitted)


def label_targets(labels: DataFrame) -> DataFrame:
    """(doc_id, target): by document, each rater's opinions as a distribution over the levels, averaged over the raters; a
    null rater is a rater. Levels outside 1..5 are left out."""
    shares = [F.avg((F.col("reading_level") == k).cast("double")).alias(f"t{k}") for k in range(1, LEVELS + 1)]
    by_rater = labels.where(F.col("reading_level").between(1, LEVELS)).groupBy("doc_id", "rater").agg(*shares)
    means = by_rater.groupBy("doc_id").agg(*[F.avg(f"t{k}").alias(f"t{k}") for k in range(1, LEVELS + 1)])
    return means.select("doc_id", F.array(*[f"t{k}" for k in range(1, LEVELS + 1)]).alias("target"))


def train(documents: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCUMENTS) -> ReadingModel | None:
    """Fitted on at most ``limit`` labelled documents, those with the smallest hashes of their ids,
    each of them whole. None where no labelled document has words."""
    chosen = label_targets(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = documents.where(F.col("text").isNotNull()).select("doc_id", "text")
    rows = texts.join(F.broadcast(chosen), "doc_id").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id))
    if not any(sentences(r.text) for r in rows):
        return None
    return fit_on_cluster(documents.sparkSession, [r.text for r in rows], np.array([r.target for r in rows]))


def levels(documents: DataFrame, key: str, text: str, model: ReadingModel | None, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, reading_level, difficulty, p1..p5) of each document of ``min_words`` words (runs of letters and digits)
    or more; difficulty is the expected level. Null, empty and shorter texts have no row, and without a model there is
    none at all."""
    schema = "doc_id bigint, reading_level int, difficulty double, " + ", ".join(f"p{i + 1} double" for i in range(LEVELS))
    if model is None:
        return documents.sparkSession.createDataFrame([], schema)
    held = documents.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "reading_level", "difficulty", *[f"p{i + 1}" for i in range(LEVELS)]]
    types = [pa.int64(), pa.int32(), *[pa.float64()] * (LEVELS + 1)]

    def scored(keys: list[int], docs: list[list[list[str]]]) -> pa.RecordBatch:
        p = held.value.probabilities(docs) if docs else np.zeros((0, LEVELS))
        columns = [keys, p.argmax(1) + 1, p @ np.arange(1, LEVELS + 1), *p.T]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, docs, chars = [], [], 0
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if t and len(_COUNTED.findall(t)) >= min_words and (d := sentences(t)):
                    keys.append(k)
                    docs.append(d)
                    chars += len(t)
                    if chars > AT_ONCE_CHARS:
                        yield scored(keys, docs)
                        keys, docs, chars = [], [], 0
            yield scored(keys, docs)

    return documents.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint"), F.col(text)).mapInArrow(run, schema)
