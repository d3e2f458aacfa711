"""The query of the filter interaction audit over all documents, and its SQL."""

from __future__ import annotations

from matchmill.llm.filter_audit import TEXT_FILTERS, audit_filters, failed_filters, with_labels
from matchmill.llm.registry import load, query

FILTERS = (*TEXT_FILTERS, "E")

SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
f AS (SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS f FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
g AS (SELECT part, f, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM f LEFT JOIN l USING (doc_id)),
letter AS (SELECT unnest(range(1, 6)) AS i),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
counts AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM g GROUP BY part, f),
steps AS (SELECT o, i AS step FROM orders, letter),
told AS (SELECT part, o, step, n, good, toxic, f[o[step]] AS fails, len(list_filter(o[: step - 1], lambda x: f[x])) > 0 AS gone,
    len(list_filter(f, lambda x: x)) AS failing FROM counts, steps),
rows AS (SELECT part, o, step, o[step] AS letter,
  sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails AND failing = 1 THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM told GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM rows
"""


@query("op11_filter_audit", SQL)
def op11_filter_audit(spark, sf_dir):
    """Five filters of all documents in every order, per language."""
    failed = failed_filters(load(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    marked = with_labels(failed, load(spark, sf_dir, "labels", "doc_id", "quality", "toxic"), {"good": "quality", "bad": "toxic"})
    return audit_filters(marked, FILTERS, {"good": "good_lost", "bad": "toxic_lost"})
