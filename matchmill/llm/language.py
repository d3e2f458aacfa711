"""Language identification with string kernels.

Two texts are as alike as the share of n-grams they have in common: k(x, y) = |X and Y| / sqrt(|X| |Y|) for their sets of
n-grams of all sizes (a blended spectrum). Kernel values with a few landmark texts, whitened by the landmarks' own kernel
matrix (Nystroem), are the features of ridge regressions, one for each language against the rest. A batch of texts is scored by
three matrix products: presence by landmark presence, kernel values by whitening, features by weights.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmill.llm.ngrams import GramSets
from matchmill.llm.text import add_columns, flat_map
from matchmill.llm.training import distinct_sample

SIZES, BITS = (1, 2, 3), 17
FAMILIAR, STRANGE = 0.65, 0.005
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass
class LanguageModel:
    languages: list[str]
    columns: np.ndarray  # column of each bucket among those of the landmarks, -1 if none has it
    landmarks: np.ndarray  # presence, bucket by landmark
    sizes: np.ndarray  # square roots of the landmarks' set sizes
    whitening: np.ndarray
    weights: np.ndarray
    #: Which buckets are at home in each language: those of several of its landmarks.
    home: np.ndarray
    #: Texts with a smaller share of n-grams at home in their language are in none of the learnt ones.
    least_familiar: float = 0.0

    def familiar(self, sets: Sequence[np.ndarray]) -> np.ndarray:
        """The share of each text's n-grams that are at home in each language, whatever the length of the text."""
        out = np.zeros((len(sets), len(self.languages)))
        for row, found in zip(out, sets, strict=True):
            columns = self.columns[found]
            row[:] = self.home[columns[columns >= 0]].sum(axis=0) / max(1, len(found))
        return out

    def kernel(self, sets: Sequence[np.ndarray]) -> np.ndarray:
        """Kernel values of texts with the landmarks."""
        present = np.zeros((len(sets), self.landmarks.shape[0]), np.float32)
        for row, found in zip(present, sets, strict=True):
            columns = self.columns[found]
            row[columns[columns >= 0]] = 1.0
        norms = np.sqrt(np.maximum(1, [len(s) for s in sets]))
        return (present @ self.landmarks) / norms[:, None] / self.sizes

    def scores(self, sets: Sequence[np.ndarray]) -> np.ndarray:
        features = self.kernel(sets) @ self.whitening
        return np.column_stack([features, np.ones(len(sets))]) @ self.weights


def fit(sets: Sequence[np.ndarray], languages: Sequence[str], landmarks: int = 192, ridge: float = 1e-2) -> LanguageModel:
    """A model from sets of n-grams and their languages; every k-th row of each language is a landmark.

    The least familiar share follows from the texts that are no landmarks: ``FAMILIAR`` of what all but ``STRANGE`` of them reach.
    """
    names = sorted(set(languages))
    index = np.array([names.index(x) for x in languages], np.int64)
    chosen = []
    for k in range(len(names)):
        rows = np.flatnonzero(index == k)
        share = max(1, landmarks // len(names))
        chosen += rows[:: max(1, -(-len(rows) // share))].tolist()
    buckets = np.unique(np.concatenate([sets[i] for i in chosen])) if chosen else np.empty(0, np.int64)
    columns = np.full(1 << BITS, -1, np.int32)
    columns[buckets] = np.arange(len(buckets))
    present = np.zeros((len(buckets), len(chosen)), np.float32)
    for k, i in enumerate(chosen):
        present[columns[sets[i]], k] = 1.0
    sizes = np.sqrt(np.maximum(1, [len(sets[i]) for i in chosen])).astype(np.float64)
    model = LanguageModel(names, columns, present, sizes, np.empty((len(chosen), 0)), np.empty((1, len(names))), np.empty((0, len(names))))
    if not chosen:
        return model
    spoken = index[chosen]
    model.home = np.column_stack([present[:, spoken == k].sum(axis=1) >= min(2, (spoken == k).sum()) for k in range(len(names))]).astype(np.float32)
    others = np.setdiff1d(np.arange(len(sets)), chosen)
    others = others if len(others) else np.array(chosen)
    shares = model.familiar([sets[i] for i in others])[np.arange(len(others)), index[others]]
    model.least_familiar = FAMILIAR * float(np.quantile(shares, STRANGE))
    own = (present.T @ present) / sizes[:, None] / sizes
    values, vectors = np.linalg.eigh(own.astype(np.float64))
    good = values > 1e-6 * values.max()
    model.whitening = vectors[:, good] / np.sqrt(values[good])
    features = np.concatenate([model.kernel(sets[i : i + 64]) @ model.whitening for i in range(0, len(sets), 64)])
    features = np.column_stack([features, np.ones(len(sets))])
    targets = np.where(index[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Every language weighs the same, however many rows it has.
    weight = (len(sets) / len(names) / np.bincount(index, minlength=len(names)))[index][:, None]
    gram = features.T @ (features * weight) + ridge * len(sets) / 100 * np.eye(features.shape[1])
    model.weights = np.linalg.solve(gram, features.T @ (targets * weight))
    return model


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 600, landmarks: int = 192) -> LanguageModel:
    """A model from a bounded sample of rows: at most ``per_language`` different texts of each language, as sets of n-grams.

    Rows with a null text, language or no word teach nothing. Without rows the model knows no language.
    """
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).filter("text is not null and lang is not null")
    few = distinct_sample(rows, "lang", "text", per_language).withColumnRenamed("label", "lang")

    def make():
        grams = GramSets(SIZES, BITS)

        def score(texts, langs):
            return {"grams": [grams.of(t).tobytes() for t in texts], "lang": langs}

        return score

    sample = flat_map(few.select(F.col("text").cast("binary").alias("text"), "lang"), make, "grams binary, lang string").collect()
    sample = sorted((r["lang"], bytes(r["grams"])) for r in sample if r["grams"])
    return fit([np.frombuffer(g, np.int32) for _, g in sample], [x for x, _ in sample], landmarks)


def identify(docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` of every document with lang_pred, score (0 to 1) and familiar, from its whole text; nothing is shuffled.

    ``familiar`` is the share of the text's n-grams that are at home in the language; below the model's ``least_familiar`` the text is in
    none of the learnt languages. ``und`` with score 0 stands for a null text, one without a letter, and all texts if the model knows no language. Equal
    scores go to the language that comes first by name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known, grams = sent.value, GramSets(SIZES, BITS)

        def score(texts):
            lettered = [k for k, t in enumerate(texts) if t and _LETTER.search(t.decode("utf-8", "replace"))]
            names, sure, share = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            for first in range(0, len(lettered) if known.languages else 0, 64):
                part = lettered[first : first + 64]
                sets = [grams.of(texts[k]) for k in part]
                for k, row, familiar in zip(part, known.scores(sets), known.familiar(sets), strict=True):
                    best = int(np.argmax(row))
                    share[k] = float(familiar[best])
                    names[k], sure[k] = known.languages[best], float(min(1.0, max(0.0, (row[best] + 1.0) / 2.0)))
            return {"lang_pred": names, "score": sure, "familiar": share}

        return score

    return add_columns(docs, make, "lang_pred string, score double, familiar double", keep, text)
