"""Importance resampling towards a target: hashed word n-grams of a corpus and of target texts, gains, and a Gumbel top-k draw.

Buckets come from an Aho-Corasick automaton. The distinct words of a bounded group of texts, with a space on both sides, are its
dictionary, and each carries the CRC and the length of the word. A scan emits the payloads of a text's words in order; the CRC of a run
of words is composed of those of its words, so that no n-gram is ever put together as text.
"""

from __future__ import annotations

import math
import zlib
from functools import cache

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmill.llm.text import ALNUM, PIECE, add_columns, fold_tasks, pieces, words
from matchmill.operators.scan import global_row_number
from matchmill.session import stage

#: Buckets of features, words of a feature at most, words of a text that can be drawn at least, share drawn in percent.
BUCKETS, LONGEST, LEAST_WORDS, PERCENT = 10_000, 1, 20, 10
SEED = "2024"
#: Longer words stand under a short name in the dictionary, so that its size follows the number of words.
LONG = 64
_POLYNOMIAL = 0xEDB88320


@cache
def _shift(size: int) -> np.ndarray:
    """What ``size`` zero bytes after a message make of each bit of its CRC: 32 columns of a matrix over GF(2)."""
    if size == 1:
        columns = []
        for bit in range(32):
            value = 1 << bit
            for _ in range(8):
                value = value >> 1 ^ (_POLYNOMIAL if value & 1 else 0)
            columns.append(value)
        return np.array(columns, np.uint32)
    half = _shift(size // 2)
    twice = _apply(half, half)
    return _apply(_shift(1), twice) if size % 2 else twice


def _apply(columns: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = np.zeros(len(crc), np.uint32)
    for bit in range(32):
        out ^= np.where(crc >> np.uint32(bit) & np.uint32(1), columns[bit], np.uint32(0))
    return out


def compose(left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRCs of pairs of messages one after the other, from the CRC of each and the length of the right one."""
    out = right.copy()
    for size in np.unique(sizes).tolist():
        at = sizes == size
        out[at] ^= _apply(_shift(size), left[at]) if size else left[at]
    return out


class Payloads:
    """CRC and length of the words of texts, in order, by automata over the distinct words of groups of pieces."""

    def of(self, texts: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(crc, length) arrays per text; a null text has no words."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        group, size = [], 0
        for k, text in enumerate(texts):
            for piece in pieces(text, ALNUM):
                group.append((k, words(piece, ALNUM)))
                size += len(piece)
                if size >= PIECE:
                    self._scan(group, found)
                    group, size = [], 0
        self._scan(group, found)
        out = []
        for parts in found:
            both = np.concatenate(parts) if parts else np.empty(0, np.int64)
            out.append(((both & 0xFFFFFFFF).astype(np.uint32), both >> 32))
        return out

    @staticmethod
    def _scan(group: list[tuple[int, list[bytes]]], found: list[list[np.ndarray]]) -> None:
        distinct = set().union(*[w for _, w in group])
        if not distinct:
            return
        # No word holds a control character, so that these names are no words.
        names = {w: b"\x01%d" % k for k, w in enumerate(distinct) if len(w) > LONG}
        # An automaton keeps whole numbers of 32 bits only, so that a word keeps the place of its payload.
        payloads = np.array([zlib.crc32(w) | len(w) << 32 for w in distinct], np.int64)
        dictionary = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, w in enumerate(distinct):
            dictionary.add_word((b" " + names.get(w, w) + b" ").decode("latin-1"), k)
        dictionary.make_automaton()
        for k, own in group:
            if own:
                flat = b" ".join(map(names.get, own, own) if names else own)
                scan = dictionary.iter((b" " + flat + b" ").decode("latin-1"))
                found[k].append(payloads[np.fromiter((at for _, at in scan), np.int64, len(own))])


def feature_buckets(crc: np.ndarray, sizes: np.ndarray, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all runs of 1 to ``longest`` consecutive words, joined by a space: unsigned CRC modulo ``buckets``."""
    out, run = [crc % np.uint32(buckets)], crc
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    for n in range(2, longest + 1):
        if len(crc) < n:
            break
        left = compose(run[: len(crc) - n + 1], space[n - 1 :], np.ones(len(crc) - n + 1, np.int64))
        run = compose(left, crc[n - 1 :], sizes[n - 1 :])
        out.append(run % np.uint32(buckets))
    return np.concatenate(out)


def _features(longest: int, buckets: int):
    def make():
        payloads = Payloads()

        def features(texts):
            out = {"n_words": [], "buckets": []}
            for crc, sizes in payloads.of(texts):
                out["n_words"].append(len(crc))
                out["buckets"].append(feature_buckets(crc, sizes, longest, buckets).astype("<u4").tobytes())
            return out

        return features

    return make


def _tally(buckets: int):
    def make():
        sums = np.zeros(buckets, np.int64)

        def add(rows):
            sums[:] += np.bincount(np.frombuffer(b"".join(rows), "<u4"), minlength=buckets)

        def rest():
            at = np.flatnonzero(sums)
            return {"bucket": at.astype(np.int32), "n": sums[at]}

        return add, rest

    return make


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of a table in each bucket. A task adds up its own; at most ``buckets`` rows per task are shuffled and as many collected."""
    tallied = fold_tasks(features.select("buckets"), _tally(buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in tallied.collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of target share over source share), with one added to every bucket."""
    s, t, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def _weigh(gains: np.ndarray):
    def make():
        def weigh(rows):
            out = {"n_features": [], "weight": []}
            for row in rows:
                own = gains[np.frombuffer(row, "<u4")]
                out["n_features"].append(len(own))
                out["weight"].append(int(own.sum()) // len(own) if len(own) else 0)
            return out

        return weigh

    return make


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = LONGEST,
    buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; ``rank`` is null for those that are not drawn.

    The weight is the floored mean gain of a document's features, 0 without any; the score adds Gumbel noise that the id and ``seed``
    determine. Of the documents with ``least_words`` words, the ``percent`` percent with the highest scores are drawn, ties to the
    smaller id. A null text has no words. Rows with a null id count as part of the corpus; they have a null score and are not drawn.
    Rows that repeat an id are drawn one by one.
    """
    body = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # Texts are scanned once: counts and weights are read from the buckets.
    seen = stage(add_columns(body, _features(longest, buckets), "n_words long, buckets binary", ["doc_id"]), "features")
    aim = add_columns(target.select(F.col(f"`{target_text}`").alias("text")), _features(longest, buckets), "n_words long, buckets binary", [])
    gains = bucket_gains(bucket_counts(seen, buckets), bucket_counts(aim, buckets))
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    weighed = add_columns(seen, _weigh(gains), "n_features long, weight long", ["doc_id", "n_words"], "buckets")
    scored = stage(weighed.withColumn("score", F.col("weight") + noise), "scored")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    drawn = scored.filter(able).count() * percent // 100
    ranked = global_row_number(scored.filter(able), [F.col("score").desc(), "doc_id", "n_words", "weight"], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select("doc_id", "n_features", "weight", "score", "rank")
