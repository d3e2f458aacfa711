"""The query of BPE encoding and decoding over all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from matchmill.llm.bpe import Vocabulary, encode_documents
from matchmill.llm.registry import load, query

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@query("op4_bpe")
def op4_bpe(spark, sf_dir):
    """Every document's number of ids, and digests of its ids and of the text decoded from them."""
    coded = encode_documents(load(spark, sf_dir, "documents", "doc_id", "text"), Vocabulary(VOCABULARY))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
