"""The operators' parts against plain versions of themselves."""

import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex

from matchmill.llm import bpe, decontaminate, language, licenses, near_dedup, ngrams, passages, quality, text, toxicity, vector_search

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = ["", " ", "\n\n", "É", "a", "Ünïcode  WORDS\tand\x0bmore\x1c\x1d.", "\x00a\x7fb\x85c", "日本 語🙂", "x" * 5000, "a\xa0b c"]


@pytest.mark.parametrize("body", ODD)
def test_words(body):
    raw = body.encode()
    assert text.words(raw, text.ALNUM) == [w.encode() for w in ALNUM.findall(body.translate(LOWER))]
    assert text.words(raw, text.SPACED) == [w.encode() for w in SPACED.findall(body.translate(LOWER))]


def test_word_hashes_tell_words_apart():
    rng = random.Random(3)
    words = {"".join(rng.choices("abcé1", k=rng.randint(1, 6))) for _ in range(3000)}
    body = "  ".join(sorted(words)).encode()
    hashes, starts, ends = text.word_hashes(body, text.SPACED)
    assert [body[a:b].decode() for a, b in zip(starts, ends, strict=True)] == sorted(words)
    assert len(set(hashes.tolist())) == len(words)
    again = text.word_hashes(b"x " + body[starts[7] : ends[9]].upper(), text.SPACED)[0]
    assert again[1:].tolist() == [h for h in hashes[7:10].tolist()] or "é" in body[starts[7] : ends[9]].decode()
    assert [len(x) for x in text.word_hashes(None, text.SPACED)] == [0, 0, 0]


def test_shingles():
    hashes = np.arange(1, 8, dtype=np.uint64)
    assert len(text.shingle_hashes(hashes)) == 3 and len(text.shingle_hashes(hashes[:3])) == 1 and len(text.shingle_hashes(hashes[:0])) == 0
    assert text.shingle_hashes(hashes)[2] == text.shingle_hashes(hashes[2:])[0]


PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


@pytest.fixture(scope="module")
def codec():
    import public_tokenizers

    return bpe.codec(bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json")))


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def random_texts(n):
    rng = random.Random(11)
    letters = list("aabcdetr'  \n\t.'sStmdlrve é٣!日🙂\x1c\x85 ") + ["<|endoftext|>"]
    return ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(n)]


def test_pieces_follow_the_pattern():
    classes = bpe.character_classes()
    for body in random_texts(20_000):
        assert bpe.pieces(body, classes) == PATTERN.findall(body)


def test_encoder_agrees_with_the_library(codec, library):
    bodies = random_texts(3000) + ODD + ["a" * 3000, "ab" * 999, " " * 500 + "x", "<|endoftext|>" * 3, "=-" * 700]
    for body, coded in zip(bodies, library.encode_batch(bodies, add_special_tokens=False), strict=True):
        ids = codec.encode(body)
        assert np.frombuffer(ids, "<u4").tolist() == coded.ids
        assert codec.decode(ids).decode() == body == library.decode(coded.ids, skip_special_tokens=False)


def test_encoder_keeps_a_bounded_memory(codec, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    few = bpe._Recent(lambda k: k * 2)
    assert [few[k] for k in (1, 2, 3, 4, 5, 6, 1, 7)] == [2, 4, 6, 8, 10, 12, 2, 14] and len(few) <= 5 and len(few.old) <= 5


def plain_windows(doc, items, size):
    found = ALNUM.findall((doc or "").translate(LOWER))
    hit, names = set(), set()
    for name, body in items:
        item = ALNUM.findall((body or "").translate(LOWER))
        n = min(size, len(item))
        wins = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if item else set()
        for k in range(len(found) - n + 1):
            if tuple(found[k : k + n]) in wins:
                hit |= set(range(k, k + n))
                names.add(name)
    return len(found), hit, names


@pytest.mark.parametrize("size", [1, 2, 4, 10])
def test_window_search(size):
    rng = random.Random(size)
    make = lambda n: " ".join(rng.choice(["a", "B", "ab", "c,", "été", "zz-y", "longer", "x1"]) for _ in range(n))
    items = [(str(k), make(rng.randint(0, 14))) for k in range(9)] + [("n", None), ("0", "a a"), (None, "zz y longer")]
    docs = [make(rng.randint(0, 60)) for _ in range(60)] + ["", None, "--", " ".join(b for _, b in items if b), make(3000)]
    search = decontaminate.WindowSearch([(i, b.encode() if b is not None else None) for i, b in items], size)
    counts, spans, named = search.search([d.encode() if d is not None else None for d in docs])
    for doc, n, ranges, names in zip(docs, counts, spans, named, strict=True):
        want_n, want_hit, want_names = plain_windows(doc, items, size)
        assert n == want_n and {w for a, b in ranges for w in range(a, b)} == want_hit and names == want_names - {None}


def test_licenses():
    scan = licenses.LicenseScan().scan
    found = scan("x The MIT License, mit-license\nApache License Version 2.0 MIT licensed".encode())
    assert (found["n_words"], found["n_base"], found["first_word"], found["last_word"]) == (13, 3, 2, 6)
    assert found["base_labels"] == "apache,mit"
    for empty in (None, b"", b" -- "):
        found = scan(empty)
        assert found["n_words"] == 0 and found["first_word"] is None and found["labels"] == "" and found["score"] == 0.5
    found = scan(b"// SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0 OR MIT) AND BSD-3-Clause\n and more")
    assert found["labels"] == "bsd-3-clause,gpl-2.0-only,mit" and found["score"] == 1.0
    assert scan(b"SPDX-License-Identifier: MIT AND GPL-3.0")["score"] == 0.4
    assert scan(b"SPDX-License-Identifier: (MIT")["expressions"] == []
    assert scan(b"spdx-license-identifier:")["labels"] == ""


@pytest.mark.parametrize("expression,labels,score", [
    ("a or mit and gpl", {"a", "mit", "gpl"}, 0.5), ("(mit or gpl) and gpl", {"mit", "gpl"}, 0.4), ("mit with x", {"mit"}, 1.0),
    ("mit or gpl with x and proprietary", {"mit", "gpl", "proprietary"}, 1.0),
])
def test_expressions(expression, labels, score):
    assert licenses.evaluate(licenses.tokens_after(expression, 0)) == (labels, score)


def test_gram_sets():
    grams = ngrams.GramSets((2, 3), 16)
    assert len(grams.of(None)) == 0 and len(grams.of(b"..")) == 0
    assert set(grams.of(b"ab").tolist()) <= set(grams.of(b"x AB y").tolist())
    assert len(grams.of(b"ab")) == 5  # " a", "ab", "b ", " ab", "ab "


def test_kernel_regression_learns_and_batches_agree():
    rng = random.Random(1)
    grams = ngrams.GramSets(language.SIZES, language.BITS)
    words = {"aa": ["tion", "the", "with"], "bb": ["über", "sch", "ung"], "cc": ["que", "eau", "oui"]}
    sample = [(name, grams.of(" ".join(rng.choices(w, k=20)).encode())) for name, w in words.items() for _ in range(30)]
    model = language.fit([g for _, g in sample], [n for n, _ in sample], landmarks=12)
    tests = [grams.of(b"the with the tion"), grams.of("sch ung über".encode()), grams.of(b"oui que eau")]
    assert [model.languages[k] for k in model.scores(tests).argmax(axis=1)] == ["aa", "bb", "cc"]
    one = model.kernel(tests)[1]
    chosen = [len(set(tests[1].tolist()) & set(np.flatnonzero(model.columns >= 0)[model.landmarks[:, k] > 0].tolist())) for k in range(len(model.sizes))]
    assert np.allclose(one, np.array(chosen) / math.sqrt(len(tests[1])) / model.sizes)
    assert language.fit([], []).languages == []


def test_toxicity_learns_and_constant_labels_are_safe():
    grams = ngrams.GramSets(toxicity.SIZES, toxicity.BITS)
    bad, good = [grams.of(f"you {w} fool{k}".encode()) for k in range(9) for w in "abc"], [grams.of(f"you {w} friend{k}".encode()) for k in range(9) for w in "abc"]
    model = toxicity.fit(bad + good, [1.0] * len(bad) + [0.0] * len(good))
    assert model.score(grams.of(b"such fools")) > 0.5 > model.score(grams.of(b"my friends"))
    assert toxicity.fit([], []).score(bad[0]) < 0.5 and toxicity.fit(bad, [1.0] * len(bad)).score(good[0]) > 0.5


def test_minimise():
    target = np.array([3.0, -2.0, 0.5])
    found = toxicity.minimise(lambda x: (float(((x - target) ** 2 * [1, 10, 100]).sum()), 2 * (x - target) * [1, 10, 100]), np.zeros(3), 100)
    assert np.allclose(found, target, atol=1e-3)


def test_trees_walk_as_a_plain_loop_does():
    rng = np.random.default_rng(0)
    values = rng.normal(size=(500, 4)).round(1)
    labels = ((values[:, 0] > 0.2) & (values[:, 2] < 1)).astype(float)
    model = quality.fit(values, labels, rounds=20)
    assert ((model.score(values) > 0.5) == labels).mean() > 0.97
    binned = model.bins(values)
    for row in range(0, 500, 50):
        odds = model.bias
        for t in range(20):
            node = 0
            for _ in range(model.depth):
                node = 2 * node + (2 if binned[row, model.feature[t, node]] > model.threshold[t, node] else 1)
            odds += model.value[t, node - (2**model.depth - 1)]
        assert math.isclose(1 / (1 + math.exp(-odds)), model.score(values[row : row + 1])[0])
    assert quality.fit(np.empty((0, 4)), np.empty(0)).score(values[:2]).tolist() == [0.5, 0.5]
    assert len(quality.statistics(None)) == len(quality.statistics(b"a b\nc.")) == len(quality.STATISTICS)


@pytest.mark.parametrize("width", [1, 3, 8, 37])
def test_segment_bounds_hold(width):
    rng = np.random.default_rng(width)
    a, b = np.floor(rng.normal(size=(20, width)) * 50), np.floor(rng.normal(size=(30, width)) * 50)
    exact = a @ b.T
    for segments in vector_search.resolutions(width):
        one, two = vector_search.segment_features(a, segments), vector_search.segment_features(b, segments)
        assert (one @ two.T >= exact - 1e-6).all()


def test_bayes_bounds_and_signatures():
    least = near_dedup.least_matches()
    assert least == sorted(least) and all(0 < m < n * 0.87 for m, n in zip(least, near_dedup.BATCHES, strict=True))
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    kept = 0
    for _ in range(60):
        other = base.copy()
        other[rng.choice(400, 30, replace=False)] = rng.integers(0, 2**63, 30, dtype=np.uint64)
        one, two = near_dedup.signature(np.unique(base)), near_dedup.signature(np.unique(other))
        pair = near_dedup.unpacked([near_dedup.packed(one)]), near_dedup.unpacked([near_dedup.packed(two)])
        kept += len(near_dedup.plausible(*pair, least))
        assert (near_dedup.band_keys(one) == near_dedup.band_keys(two)).any()
    assert kept == 60
    far = near_dedup.signature(rng.integers(0, 2**63, 400, dtype=np.uint64))
    assert not len(near_dedup.plausible(near_dedup.unpacked([near_dedup.packed(one)]), near_dedup.unpacked([near_dedup.packed(far)]), least))


def test_passages_of_equal_words_collide_anywhere():
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefg", k=5))
    for _ in range(40):
        shared = [word() for _ in range(51)]
        one = [word() for _ in range(rng.randint(0, 90))] + shared + [word() for _ in range(rng.randint(0, 90))]
        two = [word() for _ in range(rng.randint(0, 90))] + shared + [word() for _ in range(rng.randint(0, 90))]
        a, b = (passages.band_rows(" ".join(x).encode()) for x in (one, two))
        assert set(a[0].tolist()) & set(b[0].tolist())
        ha, hb = (text.word_hashes(" ".join(x).encode(), text.SPACED)[0] for x in (one, two))
        key = next(k for k in a[0].tolist() if k in set(b[0].tolist()))
        at, other = int(a[1][a[0].tolist().index(key)]), int(b[1][b[0].tolist().index(key)])
        back, ahead = passages.stretch(ha, hb, at, other)
        assert one[at - back : at + ahead] == shared


def test_cut_words():
    assert passages.cut_words(b"a b  c d", [(1, 3)]) == b"a d" and passages.cut_words(b"a b", [(0, 2)]) == b"" and passages.cut_words(b"a b", [(5, 9)]) == b"a b"
    assert passages.passages_within(np.arange(60, dtype=np.uint64), np.arange(60, dtype=np.uint64)) == [(0, 60)]


def test_short_pieces_merged_side_by_side_are_those_of_the_backtracking_encoder(monkeypatch):
    code = bpe.Codec(bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    rng = random.Random(9)
    alphabets = ["a", "ab", "the aei", "éñü' ", "0123 \n", "abcdefghij", "\U0001f600️‍ a"]
    parts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))).encode()[: bpe.SHORT] for letters in alphabets for _ in range(60)]
    assert [t.tolist() for t in code.merge_side_by_side(parts)] == [code.ranks(p) for p in parts]
    assert code.merge_side_by_side([]) == []
    alone = []
    monkeypatch.setattr(code, "ranks", lambda piece, ranks=code.ranks: alone.append(piece) or ranks(piece))
    texts = ["one two one", "", "x<|endoftext|>two", "a" * 500 + " two", "<|endoftext|>"]
    assert [code.decode(i).decode() for i in code.encode_all(texts)] == texts
    # Only pieces longer than others are encoded one by one.
    assert alone == [b"a" * 500]
    monkeypatch.setattr(bpe, "TOGETHER", 5)
    assert code.encode_all(texts) == [code.encode(t) for t in texts]
