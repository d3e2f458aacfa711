"""The query of the quality classifier over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchmill.llm.quality import score_quality, train
from matchmill.llm.registry import load, query
from matchmill.llm.training import fold


@query("op5_quality")
def op5_quality(spark, sf_dir):
    """Every document's quality; labels of documents of remainder 0 are never learnt from."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, load(spark, sf_dir, "labels", "doc_id", "quality"), fold("doc_id", 5) != 0)
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )
