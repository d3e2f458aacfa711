"""Filter audit, importance resampling: parts against brute force, and odd tables."""

import itertools
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchmill.llm import importance
from matchmill.llm.filter_audit import audit_filters, failed_filters, shapley_values, text_mask, with_labels
from matchmill.llm.importance import Payloads, compose, feature_buckets, resample
from matchmill.llm.text import ALNUM, SPACED, pieces, words


def brute_shapley(values, n):
    out = [Fraction(0)] * n
    for order in itertools.permutations(range(n)):
        before = 0
        for f in order:
            out[f] += values[before | 1 << f] - values[before]
            before |= 1 << f
    return [v / math.factorial(n) for v in out]


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_least_squares_give_shapley_values(n):
    rng = random.Random(n)
    games = [[0, *(rng.randint(0, 1000) for _ in range(2**n - 1))] for _ in range(3)]
    assert shapley_values(games, n) == [brute_shapley(g, n) for g in games]


def test_text_mask_of_long_texts_follows_the_definitions():
    rng = random.Random(5)
    for _ in range(40):
        text = "".join(rng.choice(["ab ", "Zé ", "c\x0bd ", " ", "# ", "\x1c", "word" * 9 + "\n"]) for _ in range(rng.randint(0, 400)))
        found = [w for w in text.translate({c: " " for c in b"\t\n\x0b\x0c\r"}).split(" ") if w]
        fails = [len(found) < 200, 100 * len(set(found)) < 50 * len(found), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), bool(set(text) & set("#$%&*|"))]
        assert text_mask(text.encode()) == sum(1 << k for k, f in enumerate(fails) if f)


def test_pieces_cut_between_words():
    rng = random.Random(6)
    for _ in range(50):
        raw = "".join(rng.choice("aB .\n9é") for _ in range(rng.randint(0, 300))).encode()
        for table in (ALNUM, SPACED):
            got = list(pieces(raw, table, rng.randint(1, 20)))
            assert b"".join(got) == raw and all(got)
            assert [w for p in got for w in words(p, table)] == words(raw, table)


def test_audit_of_odd_tables(spark, rows):
    docs = spark.createDataFrame(
        [(1, "same", "en"), (2, "same", "en"), (2, "same", None), (None, "same", "en"), (4, None, None), (5, "", ""), (6, "A#", "en")],
        "doc_id long, text string, lang string").withColumns({c: F.lit("old") for c in ("mask", "part", "digest", "first", "n", "m0", "good")})
    masks = rows(failed_filters(docs), "doc_id", "mask")
    assert masks == sorted([(1, 1), (2, 17), (2, 17), (None, 1), (4, 1), (5, 17), (6, 13)], key=repr)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 0)], "doc_id long, quality int")
    got = audit_filters(with_labels(failed_filters(docs), labels, {"good": "quality"}), "ABCDE", {"good": "good_lost"})
    assert got.count() == 2 * 600
    first = {r["part"]: r for r in got.filter("filter_order = 'EABCD' and step = 1").collect()}
    assert (first["en"]["removed"], first["en"]["kept"], first["en"]["good_lost"]) == (1, 3, 0)
    assert (first[""]["removed"], first[""]["kept"]) == (2, 1)
    assert first[""]["shapley"] == 2 * 60  # A and E share two documents
    empty = audit_filters(with_labels(failed_filters(docs.limit(0)), labels.limit(0), {"good": "quality"}), "ABCDE", {"good": "good_lost"})
    assert empty.count() == 0 and empty.columns == got.columns


def test_composed_sums_are_those_of_the_joined_words():
    rng = random.Random(7)
    for _ in range(30):
        a, b = (bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 7, 300]))) for _ in range(2))
        got = compose(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))
        assert got[0] == zlib.crc32(a + b)


@pytest.mark.parametrize("longest", [1, 3])
def test_buckets_of_features(longest, monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 40)
    rng = random.Random(8)
    texts = [None, b"", b" . ", b"One", ("x" * 500 + " two").encode()]
    texts += [" ".join(rng.choice(["a", "bb", "É", "long" * 30, "1-2"]) for _ in range(rng.randint(0, 60))).encode() for _ in range(20)]
    for text, (crc, sizes) in zip(texts, Payloads().of(texts), strict=True):
        own = words(text, ALNUM)
        assert sizes.tolist() == [len(w) for w in own]
        want = [zlib.crc32(b" ".join(own[k : k + n])) % 997 for n in range(1, longest + 1) for k in range(len(own) - n + 1)]
        assert feature_buckets(crc, sizes, longest, 997).tolist() == want


def test_resampling_of_odd_tables(spark):
    long = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(k, long) for k in range(20)] + [(5, long), (None, long), (30, None), (31, ""), (32, "few words")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("old") for c in ("n_words", "buckets", "weight", "score", "rank")})
    target = spark.createDataFrame([("w1 w2 w3",), (None,)], "text string")
    got = resample(docs, target).collect()
    assert len(got) == 25
    drawn = sorted((r["rank"], r["score"]) for r in got if r["rank"])
    assert [rank for rank, _ in drawn] == [1, 2]  # a tenth of 21
    assert [s for _, s in drawn] == sorted((r["score"] for r in got if r["n_features"] == 30 and r["doc_id"] is not None), reverse=True)[:2]
    assert {(r["n_features"], r["weight"]) for r in got if r["doc_id"] in (30, 31)} == {(0, 0)}
    assert [r["score"] for r in got if r["doc_id"] is None] == [None]
    assert resample(docs.limit(0), target.limit(0)).count() == 0


