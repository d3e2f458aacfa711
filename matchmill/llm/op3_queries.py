"""The query of the license scan over all documents."""

from __future__ import annotations

from matchmill.llm.licenses import scan_licenses
from matchmill.llm.registry import load, query


@query("op3_license_scan")
def op3_license_scan(spark, sf_dir):
    """Every document's words, license phrases and labels."""
    found = scan_licenses(load(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
