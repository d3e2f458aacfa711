"""The query of importance resampling over all documents, and its SQL."""

from __future__ import annotations

from matchmill.llm.importance import resample
from matchmill.llm.registry import load, query

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: DuckDB has no crc32: the byte table follows from the polynomial, and a word's bytes from its hex digits.
SQL = f"""
WITH RECURSIVE bits(i, k, v) AS (SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
byte_table AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT rid, unnest(w) AS w FROM d),
bw AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
dn AS (SELECT w, count(*) AS n FROM dw GROUP BY w),
bn AS (SELECT w, count(*) AS n FROM bw GROUP BY w),
hexed AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dn UNION SELECT w FROM bn)),
crc AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h) // 2), lambda j: ('0x' || h[2 * j + 1 : 2 * j + 2])::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket FROM hexed, byte_table),
s AS (SELECT bucket, sum(n) AS n FROM dn JOIN crc USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM bn JOIN crc USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE AS s, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE AS t),
gain AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (totals.s + 10000) / ((s.n + 1)::DOUBLE * (totals.t + 10000)))) AS g
  FROM s LEFT JOIN t ON t.bucket = s.bucket, totals),
weight AS (SELECT rid, floor(sum(g) / count(*)) AS weight FROM dw JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY rid),
scored AS (SELECT rid, doc_id, len(w) AS n, coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT
    + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weight USING (rid)),
able AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS many FROM scored WHERE n >= 20 AND score IS NOT NULL)
SELECT doc_id, n AS n_features, weight, score, CASE WHEN rank <= 10 * many // 100 THEN rank END AS rank FROM scored LEFT JOIN able USING (rid)
"""


@query("op12_importance", SQL)
def op12_importance(spark, sf_dir):
    """A tenth of the longer documents, drawn towards the benchmark's words."""
    return resample(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark", "text"))
