"""Document quality: random-indexing word vectors pooled per document, then a two-layer network.

Every word has a fixed sparse ternary index vector drawn from its hash. A word's vector is the
sum of the index vectors of the words around it in the sample; words outside the vocabulary
count as their shape alone. A document is the mean of its words' vectors and of its shapes',
with the share of repeated words and the lengths of both means. Probabilities are calibrated
by a temperature fitted on rows that the network did not learn from.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmarts.llm import common

#: Labelled documents taken per label to fit on, at most about as many.
SAMPLE_PER_LABEL = 1500
DIM = 48
NONZERO = 6
#: A word needs as many places in the sample to have a vector of its own.
LEAST_COUNT = 4
WINDOW = 2
HIDDEN = 24
EPOCHS = 250
_LONG = 24  # letters of a shape

_RUNS = re.compile(rb"(.)\1+")


def _index_vectors(words: list[bytes], seed: int) -> np.ndarray:
    """Sparse ternary vectors drawn from each word's hash."""
    out = np.zeros((len(words), DIM), np.float32)
    for i, word in enumerate(words):
        draw = np.random.Generator(np.random.PCG64(xxhash.xxh64_intdigest(word, seed)))
        out[i, draw.choice(DIM, NONZERO, replace=False)] = draw.choice([-1.0, 1.0], NONZERO)
    return out


_SHAPES = bytes(
    ord("x") if 97 <= c <= 122 or c >= 128 else ord("X") if 65 <= c <= 90 else ord("9") if 48 <= c <= 57 else c
    for c in range(256)
)


def shape(word: bytes) -> bytes:
    """Letters by case and digits as classes, stretches of a class as two, other signs as they are."""
    return _RUNS.sub(rb"\1\1", word.translate(_SHAPES))[:_LONG]


def plain(word: bytes) -> bytes:
    """The word without case and signs around it."""
    return word.lower().strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


@dataclass
class Model:
    words: dict[bytes, int]  # row of vectors; 0 for others
    vectors: np.ndarray
    shapes: dict[bytes, int]
    shape_vectors: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float


class Pooler:
    """A document's pooled vector; the rows of a word are looked up once."""

    def __init__(self, model: Model):
        self.model = model
        rows = len(model.shape_vectors)
        self.memo = common.Memo(
            lambda w: model.words.get(plain(w), 0) * rows + model.shapes.get(shape(w), 0)
        )

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        m, rows = self.model, len(self.model.shape_vectors)
        out = np.zeros((len(texts), 2 * DIM + 4), np.float32)
        for i, text in enumerate(texts):
            found = text.split()
            n = len(found)
            if not n:
                continue
            both = np.fromiter(map(self.memo.__getitem__, found), np.int64, n)
            words = m.vectors[both // rows].mean(axis=0)
            shapes = np.bincount(both % rows, minlength=rows) @ m.shape_vectors / n
            hashes = np.fromiter(map(hash, found), np.int64, n)
            out[i, :DIM], out[i, DIM : 2 * DIM] = words, shapes
            out[i, 2 * DIM :] = (
                (hashes[1:] == hashes[:-1]).mean() if n > 1 else 0.0,
                len(np.unique(hashes)) / n,
                np.linalg.norm(words),
                np.log1p(n) / 10,
            )
        self.memo.trim()
        return out


def _word_vectors(texts: list[bytes]) -> tuple[dict[bytes, int], np.ndarray]:
    """Row 0 stands for all other words, and for the end of a text among the neighbours."""
    ids: dict[bytes, int] = {}
    docs = [np.array([ids.setdefault(plain(w), len(ids)) for w in t.split()], np.int64) for t in texts]
    counts = np.bincount(np.concatenate([*docs, np.zeros(0, np.int64)]), minlength=len(ids))
    kept = np.flatnonzero(counts >= LEAST_COUNT)
    row = np.zeros(len(ids) + 1, np.int64)
    row[kept] = np.arange(1, len(kept) + 1)
    names = list(ids)
    kept_words = [names[i] for i in kept]
    index = np.vstack([np.zeros((1, DIM), np.float32), _index_vectors(kept_words, 1)])
    ends = np.full(WINDOW, len(ids))
    flow = row[np.concatenate([x for d in docs for x in (d, ends)] or [ends])]
    vectors = np.zeros((len(kept) + 1, DIM))
    for offset in range(1, WINDOW + 1):
        for word, around in ((flow[offset:], flow[:-offset]), (flow[:-offset], flow[offset:])):
            for k in range(DIM):
                vectors[:, k] += np.bincount(word, index[around, k], len(vectors))
    vectors += index  # a word is also its own neighbour
    vectors[0] = 0
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return {w: i + 1 for i, w in enumerate(kept_words)}, (vectors / np.maximum(norms, 1e-9)).astype(np.float32)


def _shape_vectors(texts: list[bytes]) -> tuple[dict[bytes, int], np.ndarray]:
    counts: dict[bytes, int] = {}
    for text in texts:
        for s in {shape(w) for w in text.split()}:
            counts[s] = counts.get(s, 0) + 1
    kept = sorted(s for s, n in counts.items() if n >= LEAST_COUNT)
    vectors = np.vstack([np.zeros((1, DIM), np.float32), _index_vectors(kept, 2)])
    return {s: i + 1 for i, s in enumerate(kept)}, vectors


def _train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Two layers by Adam on the whole sample, weight decay on both."""
    draw = np.random.default_rng(3)
    params = [
        draw.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1),
    ]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, EPOCHS + 1):
        hidden = np.tanh(x @ params[0] + params[1])
        error = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -30, 30))) - y) / len(y)
        back = np.outer(error, params[2]) * (1 - hidden**2)
        grads = [x.T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ error + 1e-4 * params[2], error.sum(keepdims=True)]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] -= 0.02 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return params[0], params[1], params[2], float(params[3][0])


def _logits(layers, x: np.ndarray) -> np.ndarray:
    return np.tanh(x @ layers[0] + layers[1]) @ layers[2] + layers[3]


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, over a grid of factors."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 80))
    loss = [np.logaddexp(0, -np.where(y == 1, logits, -logits) / t).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(sample: list[tuple[bytes, int]]) -> Model:
    """A model of (text, label 0 or 1); with one label only, or none, its scores are constant."""
    texts, y = [t for t, _ in sample], np.array([v for _, v in sample], float)
    words, vectors = _word_vectors(texts)
    shapes, shape_vectors = _shape_vectors(texts)
    model = Model(words, vectors, shapes, shape_vectors, np.zeros(2 * DIM + 4), np.ones(2 * DIM + 4), (), 1.0)
    if len(set(y)) < 2:
        even = 0.0 if not len(y) else 4.0 if y[0] else -4.0
        model.layers = (np.zeros((2 * DIM + 4, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), even)
        return model
    x = Pooler(model).pooled(texts)
    model.center, model.scale = x.mean(0), x.std(0) + 1e-3
    x = (x - model.center) / model.scale
    aside = np.array([xxhash.xxh64_intdigest(t, 9) % 5 == 0 for t in texts])
    if len(set(y[~aside])) < 2 or not aside.any():
        aside = np.zeros(len(y), bool)
    model.layers = _train(x[~aside], y[~aside])
    if aside.any():
        model.temperature = _temperature(_logits(model.layers, x[aside]), y[aside])
    return model


_POOLERS: dict[int, Pooler] = {}


def _scorer(rows: DataFrame, labels: DataFrame, sample_per_label: int):
    """A function from UTF-8 texts to scores, fitted on a bounded sample, for use in tasks."""
    held = common.held_out(F.col("doc_id"), 3, 1)
    model = fit(common.marked_sample(rows, labels, "quality", held, sample_per_label))
    sent = rows.sparkSession.sparkContext.broadcast(model)
    key = sent._jbroadcast.id()

    def scores(texts: list[bytes]) -> np.ndarray:
        if key not in _POOLERS:
            _POOLERS.clear()
            _POOLERS[key] = Pooler(sent.value)
        m = sent.value
        x = (_POOLERS[key].pooled(texts) - m.center) / m.scale
        return 1 / (1 + np.exp(-np.clip(_logits(m.layers, x) / m.temperature, -30, 30)))

    return scores


def quality_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample_per_label: int = SAMPLE_PER_LABEL,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    ``labels`` has doc_id and quality (0 or 1; null is no label). The model is fitted on a
    bounded sample of labelled rows that are not held out, ``sample_per_label`` per label; all
    rows are scored from their text alone. Null and empty texts get the score of a document
    without words; a null id counts as an empty text when held_out is found; without labels
    every score is 0.5. Repeated rows get equal scores; other columns are not read.
    """
    rows = common.texts_of(docs, id_col, text_col)
    scores = _scorer(rows, labels, sample_per_label)

    def scored(block: pa.RecordBatch) -> list:
        score = scores(common.utf8(block.column(1)))
        return [block.column(0), block.column(2), score, (score >= threshold).astype(np.int32)]

    held = common.held_out(F.col("doc_id"), 3, 1)
    return common.per_text(
        rows.withColumn("held_out", held), scored, "doc_id bigint, held_out boolean, score double, predicted int"
    )


def of_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample_per_label: int = SAMPLE_PER_LABEL,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` without the rows whose score is below ``threshold``, all columns unchanged."""
    scores = _scorer(common.texts_of(docs, id_col, text_col), labels, sample_per_label)
    at = docs.columns.index(text_col)

    def kept(batches):
        for block in common.blocks(batches, text_at=at):
            yield block.filter(pa.array(scores(common.utf8(block.column(at))) >= threshold))

    # Under plain names meanwhile: the columns' own may hold dots.
    plain_names = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return common.importable(plain_names).mapInArrow(kept, plain_names.schema).toDF(*docs.columns)
