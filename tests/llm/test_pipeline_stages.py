"""The pipeline's stages on planted cases: languages never learnt, near copies between 0.80 and 0.85."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from matchmill.llm import bpe, near_dedup, text
from matchmill.llm.language import SIZES, identify, train
from matchmill.llm.ngrams import GramSets
from matchmill.llm.training import distinct_sample

SF = "/root/testdata/sf0.01"
STRANGERS = [
    "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και τρέχει", "Быстрая коричневая лиса прыгает через ленивую собаку и бежит домой",
    "敏捷的棕色狐狸跳过懒狗", "Hızlı kahverengi tilki tembel köpeğin üzerinden atlar ve ormana doğru koşar çünkü yağmur yağıyor",
    "a gyors barna róka átugrik a lusta kutya fölött és az erdőbe fut mert esik az eső", "xkcd qwrtz pqlmn zzxv bkrt wqpl mnbv gfdr tklp",
]


def test_languages_that_were_not_learnt_go_and_short_clean_texts_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = docs.filter("lang is not null and length(text) > 200")
    short = known.select("doc_id", F.substring_index("text", " ", 6).alias("text"), "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 10**6)
    strange = spark.createDataFrame([(10**7 + k, t, None, None, len(t)) for k, t in enumerate(STRANGERS)], docs.schema)
    kept = corpus_pipeline.language_id(spark, docs.unionByName(short).unionByName(strange), SF)
    ids = {r[0] for r in kept.select("doc_id").collect()}
    assert not ids & {10**7 + k for k in range(len(STRANGERS))}
    clean = {r[0] for r in known.select("doc_id").collect()}
    assert len(clean & ids) >= 0.995 * len(clean)
    brief = {r[0] for r in short.filter("length(text) > 20").select("doc_id").collect()}
    assert len(brief & ids) >= 0.98 * len(brief)


def test_familiar_share_against_plain_sets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang is not null")
    model = train(docs, per_language=60, landmarks=40)
    grams = GramSets(SIZES, 17)
    got = identify(docs.limit(30), model, keep=["text"]).collect()
    column = {b: c for b, c in enumerate(model.columns) if c >= 0}
    for r in got:
        if r["lang_pred"] != "und":
            own = set(grams.of((r["text"] or "").encode()).tolist())
            home = sum(1 for b in own if b in column and model.home[column[b], model.languages.index(r["lang_pred"])])
            assert r["familiar"] == pytest.approx(home / len(own), abs=1e-6)


def plain_set(text):
    w = text.split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def test_near_copies_at_the_limit_of_the_stage_go(spark):
    rng = random.Random(8)
    docs, pairs = [], []
    for k in range(300):
        words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        other = list(words)
        for at in rng.sample(range(5, 295), 6):
            other[at] = f"x{rng.randrange(10**6)}"
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        a, b = plain_set(docs[-2][1]), plain_set(docs[-1][1])
        pairs.append(len(a & b) / len(a | b))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    kept = {r[0] for r in corpus_pipeline.near_dedup(spark, frame, SF).select("doc_id").collect()}
    close = [k for k, s in enumerate(pairs) if s >= 0.8]
    assert sum(0.8 <= s < 0.85 for s in pairs) > 100
    assert not kept & {2 * k + 1 for k in close}
    assert {2 * k for k in range(300)} <= kept and {2 * k + 1 for k, s in enumerate(pairs) if s < 0.8} <= kept


def test_bands_of_fewer_rows_are_those_of_the_first_hashes():
    sign = near_dedup.signature(near_dedup.shingle_set(b"a b c d e f g h i j"))
    assert near_dedup.band_keys(sign).tolist() == near_dedup.band_keys(sign, near_dedup.ROWS).tolist()
    changed = sign.copy()
    changed[near_dedup.BANDS * 9 :] = 0
    assert near_dedup.band_keys(sign, 9).tolist() == near_dedup.band_keys(changed, 9).tolist()


def test_a_sample_holds_different_texts_and_no_more_than_asked_for(spark):
    rows = spark.createDataFrame([("copy", "en")] * 5000 + [(f"t{k}", "en") for k in range(30)] + [(f"d{k}", "de") for k in range(400)], "text string, lang string")
    got = distinct_sample(rows, "lang", "text", 25).groupBy("label").agg(F.count("*").alias("n"), F.countDistinct("text").alias("d")).collect()
    assert {r["label"] for r in got} == {"en", "de"} and all(10 <= r["n"] == r["d"] <= 25 for r in got)


def test_n_grams_of_long_texts_are_those_of_the_whole(monkeypatch):
    rng = random.Random(2)
    raw = "".join(rng.choice(["ab", "É1", " ", "\n", ".", "longer words", "x" * 50]) for _ in range(3000)).encode()
    grams = GramSets((1, 2, 5), 17)
    whole = grams.of(raw)
    monkeypatch.setattr("matchmill.llm.ngrams.PIECE", 50)
    monkeypatch.setattr("matchmill.llm.ngrams.pieces", lambda t, table: __import__("matchmill.llm.text", fromlist=["pieces"]).pieces(t, table, 60))
    assert np.array_equal(grams.of(raw), whole)


def test_results_of_the_encoder_go_when_a_task_ends():
    code = bpe.codec(bpe.Vocabulary(corpus_pipeline.VOCABULARY))
    run = text.give_back(lambda batches: ((b, code.encode("some words, some more")) for b in batches))
    assert [b for b, _ in run(iter([1, 2]))] == [1, 2]
    assert not (code.pieces or code.pieces.old or code.compatible or code.compatible.old)
