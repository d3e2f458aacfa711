"""The query of the toxicity classifier over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchmill.llm.registry import load, query
from matchmill.llm.toxicity import score_toxicity, train
from matchmill.llm.training import fold


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    """Every document's toxicity; labels of documents of remainder 2 are never learnt from."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, load(spark, sf_dir, "labels", "doc_id", "toxic"), fold("doc_id", 4) != 2)
    return score_toxicity(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )
