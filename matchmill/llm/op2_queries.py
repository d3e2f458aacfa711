"""The query of language identification over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchmill.llm.language import identify, train
from matchmill.llm.registry import load, query
from matchmill.llm.training import fold


@query("op2_language_id")
def op2_language_id(spark, sf_dir):
    """Every document's language; documents of remainder 1 are never learnt from."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = train(docs.filter(fold("doc_id", 3) != 1))
    found = identify(docs, model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
