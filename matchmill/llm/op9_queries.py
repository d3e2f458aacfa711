"""The query of benchmark decontamination over all documents, and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchmill.llm.decontaminate import find_windows
from matchmill.llm.registry import load, query

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, array_to_string(w[k : k + 9], ' ') AS win, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT rid, k, size, array_to_string(w[k : k + size - 1], ' ') AS win
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT rid, k, dw.size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
words AS (SELECT rid, count(DISTINCT k + j) AS n_hit FROM (SELECT rid, k, unnest(range(0, size)) AS j FROM hit) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS listed FROM hit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


@query("op9_decontamination", SQL)
def op9_decontamination(spark, sf_dir):
    """Every document's words that lie in a window of the benchmark."""
    found = find_windows(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
