"""Quality: histogram gradient-boosted trees over statistics of whole documents.

Statistics are cut into histogram bins at quantiles of the training sample. Trees are complete, of one depth, and lie in arrays by
level, so that many texts walk through all trees at once by index arithmetic.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill.llm.text import SPACED, add_columns, flat_map, word_hashes
from matchmill.llm.training import labelled_sample, prior_shift

STATISTICS = (
    "bytes", "words", "word_mean", "word_deviation", "word_longest", "upper", "digit", "punctuation", "space", "line_feed", "wide",
    "exclamation", "symbol", "bar", "stop", "comma", "entropy", "distinct", "top_word", "repeats_next", "lines", "line_mean",
    "line_copies", "capital", "ends_punctuated", "ends_symbol", "letter_run", "pairs_distinct",
)

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_PUNCTUATION = (_BYTES > 32) & (_BYTES < 127) & ~_UPPER & ~_DIGIT & ~_LOWER
_SYMBOL = np.isin(_BYTES, np.frombuffer(b"#$%&*+<=>@^_`{}~\\", np.uint8))
_STOP = np.isin(_BYTES, np.frombuffer(b".,;:!?", np.uint8))


def statistics(text: bytes | None) -> list[float]:
    """The statistics of a text, all 0 for a null text or one without words."""
    hashes, starts, ends = word_hashes(text, SPACED)
    n = len(hashes)
    if not n:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text, np.uint8)
    counts = np.bincount(raw, minlength=256)
    total = float(len(raw))
    share = counts[counts > 0] / total
    sizes = ends - starts
    _, times = np.unique(hashes, return_counts=True)
    lines = text.split(b"\n")
    last, first = raw[ends - 1], raw[starts]
    return [
        math.log1p(total), math.log1p(n), sizes.mean(), sizes.std(), math.log1p(sizes.max()), counts[_UPPER].sum() / total,
        counts[_DIGIT].sum() / total, counts[_PUNCTUATION].sum() / total, counts[32] / total, counts[10] / total,
        counts[128:].sum() / total, counts[33] / n, counts[_SYMBOL].sum() / n, counts[124] / n, counts[46] / n, counts[44] / n,
        float(-(share * np.log2(share)).sum()), len(times) / n, times.max() / n, float((hashes[1:] == hashes[:-1]).sum()) / n,
        math.log1p(len(lines)), total / len(lines), 1.0 - len(set(lines)) / len(lines), _UPPER[first].sum() / n, _STOP[last].sum() / n,
        _SYMBOL[last].sum() / n, float(sizes.max()) / total, len(np.unique(hashes[1:] * np.uint64(3) + hashes[:-1])) / n,
    ]


@dataclass
class Trees:
    edges: list[np.ndarray]  # cut points of each statistic's bins
    feature: np.ndarray  # tree by inner node
    threshold: np.ndarray  # bins up to this one go left
    value: np.ndarray  # tree by leaf
    bias: float
    depth: int

    def bins(self, values: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, values[:, k], side="left") for k, e in enumerate(self.edges)])

    def score(self, values: np.ndarray) -> np.ndarray:
        """Scores of many texts: all walk down all trees together, a level at a time."""
        binned, rows, trees = self.bins(values), np.arange(len(values))[:, None], np.arange(len(self.feature))
        node = np.zeros((len(values), len(self.feature)), np.int64)
        for _ in range(self.depth):
            right = binned[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        odds = self.value[trees, node - (2**self.depth - 1)].sum(axis=1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -60, 60)))


def fit(
    values: np.ndarray, labels: np.ndarray, shift: float = 0.0, rounds: int = 120, depth: int = 4, rate: float = 0.12, bins: int = 48,
    ridge: float = 2.0, least: float = 2.0,
) -> Trees:
    """Boosted trees on the logistic loss. A node whose best split has less than ``least`` curvature on a side passes all rows on to the left."""
    width, inner = values.shape[1], 2**depth - 1
    edges = [np.unique(np.quantile(values[:, k], np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else np.empty(0) for k in range(width)]
    out = Trees(edges, np.zeros((rounds, inner), np.int64), np.full((rounds, inner), bins), np.zeros((rounds, 2**depth)), 0.0, depth)
    if not len(labels) or labels.min() == labels.max():
        out.bias = (4.0 if labels[0] else -4.0) if len(labels) else 0.0
        return out
    binned = out.bins(values) + np.arange(width) * bins
    start = math.log(labels.mean() / (1 - labels.mean()))
    odds = np.full(len(labels), start)
    for t in range(rounds):
        p = 1.0 / (1.0 + np.exp(-odds))
        slope, bend = labels - p, p * (1 - p)
        node = np.zeros(len(labels), np.int64)
        for level in range(depth):
            base, count = 2**level - 1, 2**level
            place = ((node - base) * width * bins)[:, None] + binned
            shape = (count, width, bins)
            sums = [np.bincount(place.ravel(), np.repeat(x, width), count * width * bins).reshape(shape).cumsum(axis=2) for x in (slope, bend)]
            left_s, left_b = sums
            all_s, all_b = left_s[:, :, -1:], left_b[:, :, -1:]
            gain = left_s**2 / (left_b + ridge) + (all_s - left_s) ** 2 / (all_b - left_b + ridge) - all_s**2 / (all_b + ridge)
            gain[(left_b < least) | (all_b - left_b < least)] = 0.0
            best = gain.reshape(count, -1).argmax(axis=1)
            useful = gain.reshape(count, -1)[np.arange(count), best] > 1e-6
            out.feature[t, base : base + count] = np.where(useful, best // bins, 0)
            out.threshold[t, base : base + count] = np.where(useful, best % bins, bins)
            own = out.feature[t, node]
            node = 2 * node + 1 + (binned[np.arange(len(node)), own] - own * bins > out.threshold[t, node])
        leaf = node - inner
        sums = [np.bincount(leaf, x, 2**depth) for x in (slope, bend)]
        out.value[t] = rate * sums[0] / (sums[1] + ridge)
        odds += out.value[t, leaf]
    out.bias = start + shift
    return out


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality", per_class: int = 4000, text: str = "text") -> Trees:
    """Trees from about ``per_class`` labelled texts of each class, of those that ``allowed`` lets in.

    Only the statistics of the sample reach the driver. Without rows of both classes every text gets the same score.
    """
    few, sizes = labelled_sample(docs, labels, label, allowed, per_class, text)

    def make():
        return lambda texts, marks: {"values": [statistics(t) for t in texts], "label": marks}

    sample = flat_map(few.select(F.col("text").cast("binary").alias("text"), "label"), make, "values array<double>, label double").collect()
    sample = sorted((r["label"], r["values"]) for r in sample)
    marks = np.array([m for m, _ in sample])
    values = np.array([v for _, v in sample]).reshape(-1, len(STATISTICS))
    return fit(values, marks, prior_shift(sizes, marks))


def score_quality(docs: DataFrame, model: Trees, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` of every document with score (0 to 1), from its whole text; nothing is shuffled.

    Null texts and texts without words have statistics of 0 and so share one score.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known = sent.value
        return lambda texts: {"score": known.score(np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS)))}

    return add_columns(docs, make, "score double", keep, text)
