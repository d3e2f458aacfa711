"""MinHash near-deduplication with sequential Bayesian verification.

1. Every document gets the hash of its whole set of word shingles, a MinHash signature, and band keys of it. Documents of one
   set are one class from here on, so that thousands of exact copies weigh as one.
2. In each bucket of a band, all classes are compared with one centre: the class with the most copies. What links
   to a centre forms first components, without pairing the members of a large group with each other.
3. Buckets in which several components are left are cut into blocks, and blocks are compared with blocks, only across
   components, and a pair only in the first band that it shares.
4. A comparison looks at the signatures batch by batch. It stops when, given the matches so far, the posterior probability
   that the similarity reaches the limit is below ``MISS``. Survivors are confirmed on the full sets.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmill.llm.components import components
from matchmill.llm.text import SPACED, as_bytes, flat_map, mix, shingle_hashes, word_hashes
from matchmill.session import stage

SHINGLE, PERCENT = 5, 85
#: Bands, and rows of a band unless others are asked for: a pair at the limit of 0.85 meets in some band with a probability of 0.99994.
BANDS, ROWS = 64, 12
HASHES = BANDS * ROWS
#: Signatures are compared in batches up to these numbers of hashes, by the last four bits of each.
BATCHES = (64, 128, 256, 512, HASHES)
MISS = 1e-7
BLOCK = 128
#: Up to so many ids (some 32 MB) are broadcast to pick texts; more are joined.
BROADCAST_IDS = 2_000_000

_RANDOM = np.random.default_rng(77003)
_FACTORS = _RANDOM.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_BAND = _RANDOM.integers(0, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    return np.unique(shingle_hashes(word_hashes(text, SPACED)[0], size))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of each of ``HASHES`` random orders over a set."""
    out = np.full(HASHES, 2**32 - 1, np.uint32)
    part = (shingles >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(part), 256):
        np.minimum(out, (part[k : k + 256, None] * _FACTORS).min(axis=0), out=out)
    return out


def band_keys(sign: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A key for each band of so many rows, different for different bands."""
    return mix(sign[: BANDS * rows].reshape(BANDS, rows).astype(np.uint64) @ _BAND[:rows] + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def packed(sign: np.ndarray) -> bytes:
    """The last four bits of each hash, two to a byte."""
    low = (sign & np.uint32(15)).astype(np.uint8)
    return (low[::2] | (low[1::2] << 4)).tobytes()


def unpacked(raw: list[bytes]) -> np.ndarray:
    """Signatures of ``packed`` as rows, in an order of their own."""
    both = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
    return np.concatenate([both & 15, both >> 4], axis=1)


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """For each batch end, how many hashes must match for a pair to go on.

    With an even prior the matching rate p has a Beta posterior after m of n matches, and P(p >= limit) is the
    probability that a Binomial(n + 1, limit) is at most m. Four bits match by chance in one case of 16.
    """
    limit = percent / 100 + (1 - percent / 100) / 16
    out = []
    for n in BATCHES:
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.exp(
                math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(limit) + (n + 1 - m) * math.log1p(-limit)
            )
        out.append(m)
    return out


def plausible(one: np.ndarray, two: np.ndarray, least: list[int]) -> np.ndarray:
    """Which pairs of signature rows survive all batches."""
    alive = np.arange(len(one))
    matches = np.zeros(len(one), np.int64)
    start = 0
    for end, needed in zip(BATCHES, least, strict=True):
        matches = matches + (one[alive, start:end] == two[alive, start:end]).sum(axis=1)
        good = matches >= needed
        alive, matches, start = alive[good], matches[good], end
    return alive


def similar(one: np.ndarray, two: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether the similarity of two sets reaches the limit, in whole numbers."""
    if not len(one) or not len(two):
        return False
    common = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * common >= percent * (len(one) + len(two) - common)


def _describe(rows: int):
    def make():
        def describe(ids, texts):
            out = {"id": ids, "n": [], "k1": [], "k2": [], "sign": [], "keys": []}
            for text in texts:
                shingles = shingle_set(text)
                out["n"].append(len(shingles))
                out["k1"].append(int(mix(shingles).sum(dtype=np.uint64).astype(np.int64)) if len(shingles) else 0)
                out["k2"].append(int(mix(shingles ^ np.uint64(0x5DEECE66D1234567)).sum(dtype=np.uint64).astype(np.int64)) if len(shingles) else 0)
                if len(shingles):
                    sign = signature(shingles)
                    out["sign"].append(packed(sign))
                    out["keys"].append(band_keys(sign, rows).astype(np.int64))
                else:
                    out["sign"].append(None)
                    out["keys"].append(None)
            return out

        return describe

    return make


def _judge(percent: int):
    def make():
        least = least_matches(percent)

        def judge(a, b, sign_a, sign_b):
            good = plausible(unpacked(sign_a), unpacked(sign_b), least) if a else []
            return {"a": [a[k] for k in good], "b": [b[k] for k in good]}

        return judge

    return make


def _across(percent: int):
    def make():
        least = least_matches(percent)

        def across(bands, ones, twos):
            found_a, found_b = [], []
            for band, one, two in zip(bands, ones, twos, strict=True):
                same_block = one[0]["id"] == two[0]["id"]
                signs = unpacked([m["sign"] for m in one]), unpacked([m["sign"] for m in two])
                keys = [np.array([m["keys"] for m in side], np.int64) for side in (one, two)]
                labels = [np.array([m["label"] for m in side], np.int64) for side in (one, two)]
                for i in range(len(one)):
                    # A pair is left to the first band that both share.
                    go = (labels[1] != labels[0][i]) & ~(keys[1][:, :band] == keys[0][i, :band]).any(axis=1)
                    if same_block:
                        go[: i + 1] = False
                    rows = np.flatnonzero(go)
                    if len(rows):
                        good = rows[plausible(np.broadcast_to(signs[0][i], (len(rows), HASHES)), signs[1][rows], least)]
                        found_a += [one[i]["id"]] * len(good)
                        found_b += [two[j]["id"] for j in good.tolist()]
            return {"a": found_a, "b": found_b}

        return across

    return make


def _confirm(percent: int):
    def make():
        def confirm(a, b, text_a, text_b):
            good, last, known = [], None, None
            for k, (one, two) in enumerate(zip(text_a, text_b, strict=True)):
                if one != last:
                    last, known = one, shingle_set(one)
                if similar(known, shingle_set(two), percent):
                    good.append(k)
            return {"a": [a[k] for k in good], "b": [b[k] for k in good]}

        return confirm

    return make


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose full sets are similar, among plausible ones.

    Only texts that occur in a pair are moved: their ids are broadcast if there are few, and joined otherwise.
    """
    pairs = stage(pairs.distinct(), "plausible")
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    few = stage(texts.join(ids, "id", "left_semi"), "texts")
    both = pairs.join(few.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
        few.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return flat_map(both.select("a", "b", "text_a", "text_b"), _confirm(percent), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    ``rows`` (at most ``ROWS``) are the hashes of a band: fewer find more pairs at a lower ``percent``, and more to refuse. A pair at a
    similarity of s has a common band with a probability of 1 - (1 - s ** rows) ** BANDS.

    Documents link if 100 * shingles in common >= ``percent`` * shingles of either; component_id is the smallest id a document
    reaches and kept whether that is its own. A null text or one without words has no shingles and links with nothing; with fewer
    than five words, all of them are one shingle. Rows that repeat an id are one document that links as each of its texts
    does. Rows with a null id take no part in links; they are kept. An empty table gives an empty one.
    """
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), as_bytes(text).alias("text"))
    seen = stage(flat_map(texts, _describe(rows), "id long, n long, k1 long, k2 long, sign binary, keys array<long>"), "signatures")
    classes = stage(
        seen.filter("n > 0 and id is not null").groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count("*").alias("copies")), "classes"
    )
    firsts = seen.filter("n > 0").join(classes.select(F.col("first").alias("id"), "k1", "k2", "copies"), ["id", "k1", "k2"])
    firsts = stage(firsts.dropDuplicates(["id", "k1", "k2"]).select("id", "copies", "sign", "keys"), "firsts")

    exploded = firsts.select("id", "copies", F.posexplode("keys").alias("band", "key"))
    buckets = exploded.groupBy("key").agg(
        F.count("*").alias("members"), F.max(F.struct("copies", (-F.col("id")).alias("minus"))).alias("centre")
    ).filter("members > 1").select("key", "members", (-F.col("centre.minus")).alias("centre"))
    members = stage(exploded.select("id", "band", "key").join(stage(buckets, "buckets"), "key"), "members")

    stars = members.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    signs = firsts.select("id", "sign")
    tested = stars.join(signs.select(F.col("id").alias("a"), F.col("sign").alias("sign_a")), "a").join(
        signs.select(F.col("id").alias("b"), F.col("sign").alias("sign_b")), "b")
    near = flat_map(tested.select("a", "b", "sign_a", "sign_b"), _judge(percent), "a long, b long")
    links = stage(confirmed(near, texts, percent), "star-links")
    labels = stage(components(links), "labels")

    labelled = stage(
        members.join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select("key", "band", "id", "members", F.coalesce("component", "id").alias("label")), "labelled",
    )
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    blocks = F.pmod(F.xxhash64("id"), F.ceil(F.col("members") / BLOCK))
    parts = labelled.join(mixed, "key").select("key", "band", blocks.alias("block"), "id", "label", F.ceil(F.col("members") / BLOCK).alias("n"))
    parts = parts.join(firsts.select("id", "sign", "keys"), "id")
    grouped = stage(
        parts.groupBy("key", "band", "block", "n").agg(F.collect_list(F.struct("id", "label", "sign", "keys")).alias("rows")), "blocks"
    )
    one = grouped.select("key", "band", F.col("block").alias("i"), F.col("rows").alias("one"), F.explode(F.sequence("block", F.col("n") - 1)).alias("j"))
    two = grouped.select("key", F.col("block").alias("j"), F.col("rows").alias("two"))
    near = flat_map(one.join(two, ["key", "j"]).select("band", "one", "two"), _across(percent), "a long, b long")
    more = stage(confirmed(near, texts, percent), "links")
    reached = stage(components(links.unionAll(more)), "components")

    known = stage(
        classes.join(reached.withColumnRenamed("node", "first"), "first", "left")
        .select("k1", "k2", F.coalesce("component", "first").alias("component")), "known",
    )
    # A hundredth of all documents may be copies of one class: the classes are a table of their own, so that Spark can split such a key.
    own = seen.select("id", "n", "k1", "k2").join(known, ["k1", "k2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return own.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
