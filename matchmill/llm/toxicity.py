"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its n-grams. Each n-gram is scaled by the logarithm of how much more often it occurs in toxic texts of the
sample than in others, and a logistic regression is fitted on the scaled features. Scale and weight are then one
number per bucket, so that a text's score is a sum over its n-grams.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill.llm.ngrams import GramSets
from matchmill.llm.text import add_columns, flat_map
from matchmill.llm.training import labelled_sample, prior_shift

SIZES, BITS = (3, 5, 7), 19


@dataclass
class LinearModel:
    weights: np.ndarray
    bias: float

    def score(self, grams: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.weights[grams].sum(dtype=np.float64) + self.bias, -60, 60))))


def log_count_ratios(sets: Sequence[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """The ratio of each bucket and in how many texts it occurs."""
    counts = np.zeros((2, 1 << BITS))
    for grams, label in zip(sets, labels, strict=True):
        counts[int(label), grams] += 1
    share = (counts + smooth) / (np.array([[np.sum(labels == 0)], [np.sum(labels == 1)]]) + 2 * smooth)
    return np.log(share[1] / share[0]), counts.sum(axis=0)


def fit(sets: Sequence[np.ndarray], labels: Sequence[float], shift: float = 0.0, least: int = 3, ratio: float = 1.5, decay: float = 1e-4, rounds: int = 100) -> LinearModel:
    """A model from sets of n-grams and labels. N-grams of fewer than ``least`` texts or a smaller log ratio get no weight."""
    labels = np.asarray(labels, np.float64)
    if not len(labels) or labels.min() == labels.max():
        return LinearModel(np.zeros(1 << BITS, np.float32), 4.0 if len(labels) and labels[0] else -4.0)
    ratios, texts = log_count_ratios(sets, labels)
    ratios[(texts < least) | (np.abs(ratios) < ratio)] = 0.0
    kept = [s[ratios[s] != 0] for s in sets]
    owner = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
    used, place = np.unique(np.concatenate(kept), return_inverse=True)
    value = ratios[used][place]

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        odds = np.bincount(owner, value * x[place], len(kept)) + x[-1]
        error = 1.0 / (1.0 + np.exp(-np.clip(odds, -60, 60))) - labels
        slope = np.append(np.bincount(place, value * error[owner], len(used)), error.sum()) / len(labels)
        slope[:-1] += decay * x[:-1]
        return float((np.logaddexp(0.0, odds) - labels * odds).mean() + decay / 2 * (x[:-1] @ x[:-1])), slope

    found = minimise(loss, np.zeros(len(used) + 1), rounds)
    out = np.zeros(1 << BITS, np.float32)
    out[used] = found[:-1] * ratios[used]
    return LinearModel(out, float(found[-1]) + shift)


def minimise(loss, x: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """A minimum of a smooth convex function by limited-memory BFGS steps, each halved until it goes down enough."""
    value, slope = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        way, sizes = -slope, []
        for step, change, scale in reversed(moves):
            sizes.append(scale * (step @ way))
            way = way - sizes[-1] * change
        if moves:
            step, change, scale = moves[-1]
            way = way / (scale * (change @ change))
        for (step, change, scale), size in zip(moves, reversed(sizes), strict=True):
            way = way + (size - scale * (change @ way)) * step
        fall, length = slope @ way, 1.0 if moves else 1.0 / max(1.0, float(np.abs(slope).sum()))
        while True:
            after, new = loss(x + length * way)
            if after <= value + 1e-4 * length * fall or length < 1e-10:
                break
            length /= 2
        if length < 1e-10 or value - after < 1e-9:
            return x
        step, change = length * way, new - slope
        if step @ change > 1e-12:
            moves = [*moves[1 - memory :], (step, change, 1.0 / (step @ change))]
        x, value, slope = x + step, after, new
    return x


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic", per_class: int = 1500, text: str = "text") -> LinearModel:
    """A model from about ``per_class`` labelled texts of each class, of those that ``allowed`` lets in.

    Without rows of both classes the model gives every text the same score.
    """
    few, sizes = labelled_sample(docs, labels, label, allowed, per_class, text)

    def make():
        grams = GramSets(SIZES, BITS)

        def score(texts, marks):
            return {"grams": [grams.of(t).tobytes() for t in texts], "label": marks}

        return score

    sample = flat_map(few.select(F.col("text").cast("binary").alias("text"), "label"), make, "grams binary, label double").collect()
    sample = sorted((r["label"], bytes(r["grams"])) for r in sample)
    marks = [m for m, _ in sample]
    return fit([np.frombuffer(g, np.int32) for _, g in sample], marks, prior_shift(sizes, marks))


def score_toxicity(docs: DataFrame, model: LinearModel, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` of every document with score (0 to 1), from its whole text; nothing is shuffled.

    Null and empty texts have no n-grams and get the score of the bias alone. Repeated texts score alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known, grams = sent.value, GramSets(SIZES, BITS)
        return lambda texts: {"score": [known.score(grams.of(t)) for t in texts]}

    return add_columns(docs, make, "score double", keep, text)
