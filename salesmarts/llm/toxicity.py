"""Toxicity by weak supervision.

Terms and word beginnings that tell the labels of a bounded sample apart become voters; each
abstains or votes on a document. A generative label model, in which a document's label is
hidden, is fitted by expectation maximisation: it estimates how often each voter fires in
either class and which voters copy one another. The voters' strongest dependencies form a tree,
as in a tree-augmented naive Bayes model; the rates in the labelled sample serve as a prior, so
that the hidden class stays the labelled one. Its posteriors are the labels on which a linear
classifier over many more such features is trained; only that classifier scores the documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmarts.llm import common
from salesmarts.llm.near_dedup import fingerprint, forest

#: Labelled documents taken per label to fit on, at most about as many.
SAMPLE_PER_LABEL = 2000
VOTERS = 160
#: A voter fires at least as many times as often in its class as in the other.
LEAST_ODDS = 6.0
#: Weight of a document's given label against its posterior in the label model.
PRIOR_WEIGHT = 20.0
#: Parts of the lexicon whose absence is a vote for a clean text.
ABSENCES = 1
FEATURES = 1500
LEAST_DOCS = 6
#: Likelihood-ratio statistic that a feature must reach: beyond chance among some 10^5 features.
LEAST_EVIDENCE = 25.0
BEGINNINGS = (4, 5, 6)  # letters of a word's beginning taken as a pattern
#: A feature is dense in a text if so many of its different chunks have it, and such a part of them.
DENSE_CHUNKS, DENSE_PART = 2, 0.01
EM_ROUNDS = 25
STEPS = 1000

_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> tuple[str, ...]:
    """The terms in a chunk of text and their beginnings, the latter marked by a hyphen."""
    out = []
    for term in _WORD.findall(word):
        out.append(term)
        out.extend(term[:k] + "-" for k in BEGINNINGS if len(term) > k)
    return tuple(out)


def chunks(text: str) -> set[str]:
    return set(text.lower().split())


def features_in(text: str, memo: dict[str, tuple]) -> set:
    """A text's features; (feature, True) stands for a dense one."""
    found = chunks(text)
    counts: dict = {}
    for features in map(memo.__getitem__, found):
        for f in features:
            counts[f] = counts.get(f, 0) + 1
    least = max(DENSE_CHUNKS, DENSE_PART * len(found))
    return counts.keys() | {(f, True) for f, n in counts.items() if n >= least}


def without_near_copies(sample: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    """One text of each group of near copies, so that a text copied often counts once."""
    fps = np.array([fingerprint(text) for text, _ in sample], np.uint64)
    joined, _ = forest(fps, np.ones(len(fps), bool), 4)
    dropped = set(joined.tolist())
    return [row for i, row in enumerate(sample) if i not in dropped]


def _rows(docs: list[set], names: list) -> np.ndarray:
    """Which of the named features each document has."""
    at = {f: k for k, f in enumerate(names)}
    out = np.zeros((len(docs), len(names)), bool)
    for i, doc in enumerate(docs):
        out[i, [at[f] for f in doc if f in at]] = True
    return out


def telling(docs: list[set], y: np.ndarray) -> tuple[list, np.ndarray]:
    """Features by how well their presence tells the labels apart, with their log odds."""
    counts: dict = {}
    for doc, label in zip(docs, y.astype(int), strict=True):
        for f in doc:
            counts.setdefault(f, [0, 0])[label] += 1
    kept = sorted((f for f, n in counts.items() if sum(n) >= LEAST_DOCS), key=str)
    n = np.array([counts[f] for f in kept], float).reshape(-1, 2)
    size = np.array([(y == 0).sum(), (y == 1).sum()], float)
    rate = (n + 0.5) / (size + 1)
    pooled = ((n.sum(1) + 1) / (size.sum() + 2))[:, None]
    parts = rate * np.log(rate / pooled) + (1 - rate) * np.log((1 - rate) / (1 - pooled))
    evidence = 2 * (parts * size).sum(1)
    order = np.argsort(-evidence, kind="stable")
    order = order[evidence[order] >= LEAST_EVIDENCE]
    return [kept[i] for i in order], np.log(rate[order, 1] / rate[order, 0])


# The generative label model


def _tree(votes: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """Each voter's parent in the tree of largest mutual information given the class; -1 for roots."""
    v = votes.astype(float)
    info = np.zeros((v.shape[1], v.shape[1]))
    for weight in (posterior, 1 - posterior):
        total = weight.sum() + 1e-9
        both = (v * weight[:, None]).T @ v / total
        one = (v * weight[:, None]).sum(0) / total
        for x, y, joint in (
            (one[:, None], one[None, :], both),
            (one[:, None], 1 - one[None, :], one[:, None] - both),
            (1 - one[:, None], one[None, :], one[None, :] - both),
            (1 - one[:, None], 1 - one[None, :], 1 - one[:, None] - one[None, :] + both),
        ):
            joint = np.clip(joint, 1e-12, None)
            info += total * joint * np.log(joint / np.clip(x * y, 1e-12, None))
    parent = np.full(v.shape[1], -1)
    best, source = np.zeros(v.shape[1]), np.full(v.shape[1], -1)
    left = set(range(v.shape[1]))
    least = 0.005 * len(v)  # weaker dependencies are taken as none
    while left:
        k = max(left, key=lambda j: (best[j], -j))
        left.discard(k)
        parent[k] = source[k] if best[k] > least else -1
        closer = info[k] > best
        best[closer], source[closer] = info[k][closer], k
    return parent


def label_model(votes: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Posterior of label 1 per document from binary votes (fired or abstained).

    Every document counts once by its posterior and ``PRIOR_WEIGHT`` times by its given label
    ``y``, which keeps the hidden class the labelled one without fixing any document's label.
    """
    posterior = y.astype(float)
    for step in range(EM_ROUNDS):
        ones, zeros = posterior + PRIOR_WEIGHT * y, 1 - posterior + PRIOR_WEIGHT * (1 - y)
        if step in (0, 5):
            parent = _tree(votes, ones / (1 + PRIOR_WEIGHT))
            above = np.where(parent >= 0, votes[:, np.maximum(parent, 0)], False)
        log_odds = np.full(len(votes), np.log(ones.sum() / zeros.sum()))
        for state in (False, True):
            here = above == state
            common_rate = ((here & votes).sum(0) + 0.1) / (here.sum(0) + 0.2)
            sides = []
            for weight in (ones, zeros):
                # Where a class has hardly a document, a voter says as much as in the other.
                w = weight[:, None] * here
                sides.append(((w * votes).sum(0) + common_rate) / (w.sum(0) + 1))
            fired, silent = np.log(sides[0] / sides[1]), np.log((1 - sides[0]) / (1 - sides[1]))
            log_odds += (here * np.where(votes, fired, silent)).sum(1)
        posterior = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return posterior


# The linear classifier


@dataclass
class Model:
    features: dict  # feature, or (feature, True) where dense, to its weight's place
    weights: np.ndarray
    bias: float


def _linear(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Adam, with weight decay."""
    x = x.astype(np.float32)
    w, b = np.zeros(x.shape[1] + 1), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    w[-1] = b
    m, s = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        error = (p - y) / len(y)
        g = np.append(x.T @ error + 1e-4 * w[:-1], error.sum())
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(sample: list[tuple[bytes, int]]) -> Model:
    """A model of (text, label 0 or 1); with one label only, or none, its scores are constant."""
    sample = without_near_copies(sample)
    y = np.array([v for _, v in sample], float)
    if len(set(y)) < 2:
        return Model({}, np.zeros(0), 0.0 if not len(y) else 4.0 if y[0] else -4.0)
    memo = common.Memo(features_of)
    docs = [features_in(t.decode(), memo) for t, _ in sample]
    names, log_odds = telling(docs, y)
    strong = np.flatnonzero(np.abs(log_odds) >= np.log(LEAST_ODDS))[:VOTERS]
    fired = _rows(docs, [names[k] for k in strong])
    signs = np.flatnonzero(log_odds[strong] > 0)
    absent = [~fired[:, signs[g::ABSENCES]].any(1) for g in range(ABSENCES) if len(signs[g::ABSENCES])]
    votes = np.column_stack([fired, *absent])
    posterior = label_model(votes, y)
    wide = names[:FEATURES]
    weights, bias = _linear(_rows(docs, wide), posterior)
    kept = np.flatnonzero(np.abs(weights) > 1e-3)
    return Model({wide[k]: i for i, k in enumerate(kept)}, weights[kept], bias)


class Scorer:
    """Scores texts; which features a chunk of text has is looked up once."""

    def __init__(self, model: Model):
        self.weights = {f: model.weights[k] for f, k in model.features.items()}
        self.bias = model.bias
        known = {f[0] if isinstance(f, tuple) else f for f in model.features}
        self.memo = common.Memo(lambda w: tuple(f for f in features_of(w) if f in known))

    def scores(self, texts: list[str]) -> np.ndarray:
        weight = self.weights.get
        odds = [self.bias + sum(weight(f, 0.0) for f in features_in(t, self.memo)) for t in texts]
        self.memo.trim()
        return 1 / (1 + np.exp(-np.clip(np.array(odds), -30, 30)))


_SCORERS: dict[int, Scorer] = {}


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_per_label: int = SAMPLE_PER_LABEL,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    ``labels`` has doc_id and toxic (0 or 1; null is no label). Voters and classifier come from a
    bounded sample of labelled rows that are not held out, ``sample_per_label`` per label; all
    rows are scored from their text alone. Null and empty texts get the score of a text without
    any feature; without labels every score is 0.5. Repeated rows get equal scores; a null id
    stays null; other columns are not read.
    """
    rows = common.texts_of(docs, id_col, text_col)
    held = common.held_out(F.col("doc_id"), 3, 1)
    model = fit(common.marked_sample(rows, labels, "toxic", held, sample_per_label))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = sent._jbroadcast.id()

    def scored(block: pa.RecordBatch) -> list:
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(sent.value)
        score = _SCORERS[key].scores(common.strings(block.column(1)))
        return [block.column(0), block.column(2), score, (score >= threshold).astype(np.int32)]

    return common.per_text(
        rows.withColumn("held_out", held), scored, "doc_id bigint, held_out boolean, score double, predicted int"
    )
