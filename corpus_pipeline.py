"""A corpus pipeline: language, near-duplicates, repeated passages, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. ``run`` applies
them to the documents of ``sf_dir``, writing and rereading what each of them keeps.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.llm.bpe import Vocabulary, encode_documents
from matchmill.llm.decontaminate import find_windows
from matchmill.llm.language import UNKNOWN, identify, train
from matchmill.llm.near_dedup import BROADCAST_IDS, near_duplicates
from matchmill.llm.passages import remove_repeated
from matchmill.llm.training import fold
from matchmill.session import stage

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Near-duplicates have this share of shingles in common (percent); with bands of so many rows, a pair at it has a common band with 0.9999.
NEAR_PERCENT, NEAR_ROWS = 80, 9


def _plain(docs: DataFrame) -> DataFrame:
    """The columns under names that no operator uses: ``c0``, ``c1``, ... but for doc_id and text."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"c{k}" for k, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that ``lang`` names; texts without letters and of other languages go.

    The languages are learnt from rows with a lang whose crc32(doc_id) modulo 3 is not 1. A text is of another language if too few of
    its n-grams are at home in the best one; the limit follows from learnt texts. If no row has a lang, those texts that have letters stay.
    """
    model = train(docs.filter(F.coalesce(fold("doc_id", 3) != 1, F.lit(False))))
    plain = _plain(docs)
    found = identify(plain, model, keep=plain.columns)
    if model.languages:
        found = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("familiar") >= model.least_familiar))
    else:
        found = found.filter(F.col("text").rlike(r"\p{L}"))
    return found.select(*plain.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id. Ids to remove are broadcast if they are few."""
    gone = stage(near_duplicates(docs, percent=NEAR_PERCENT, rows=NEAR_ROWS).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of fifty words that a document with a smaller doc_id has; n_chars follows. Texts that consist of nothing else go."""
    cut = remove_repeated(docs).filter((F.col("_cut") == 0) | (F.trim(F.col("text")) != ""))
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "n_chars"]
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("_cut") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        cut = cut.select(*columns, n_chars.alias("n_chars"))
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark's words."""
    plain = _plain(docs)
    found = find_windows(plain, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=plain.columns)
    return found.filter("n_hit = 0").select(*plain.columns).toDF(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): token ids (little-endian unsigned 32-bit) and a digest of the text decoded from them."""
    coded = encode_documents(docs, Vocabulary(VOCABULARY))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL expresses neither a trained model nor the ids of a vocabulary.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
