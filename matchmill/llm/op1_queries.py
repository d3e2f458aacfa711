"""The query of the URL filter over all pages, and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchmill.llm.registry import load, query
from matchmill.llm.url_filter import TWO_LABEL_SUFFIXES, Rule, judge_urls

#: The rules of the query.
RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)

_RULE_ROWS = ", ".join(f"('{r.text}', '{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
_WIDE = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)


def _level(name: str, table: str) -> str:
    return f"""m_{name} AS (SELECT count(*)::DOUBLE AS g, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS b,
  coalesce(sum(n::HUGEINT * n), 0)::DOUBLE AS sq, coalesce(sum(floor((bad * bad)::DOUBLE / n::DOUBLE * 1e6)::BIGINT), 0)::DOUBLE AS btw
  FROM {table} WHERE n > 0),
k_{name} AS (SELECT CASE WHEN g < 2 OR b <= 0 OR b >= n THEN 9.0::DOUBLE ELSE 1.0::DOUBLE / least(greatest(
  CASE WHEN n - sq / n - (g - 1) > 0
    THEN ((btw / 1e6 - (b / n) * b) / ((b / n) * (1.0::DOUBLE - b / n)) - (g - 1)) / (n - sq / n - (g - 1)) ELSE 0.1::DOUBLE END,
  0.001::DOUBLE), 0.5::DOUBLE) - 1.0::DOUBLE END AS k, (b + 0.5::DOUBLE) / (n + 1.0::DOUBLE) AS overall FROM m_{name})"""


SQL = f"""
WITH rules(rule, rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
split AS (SELECT row_number() OVER () AS rid, page_id,
  translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fit AS (SELECT rid, rule, rule_verdict, row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC) AS place
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
judged AS (SELECT s.*, rule, rule_verdict FROM split s LEFT JOIN (SELECT * FROM fit WHERE place = 1) USING (rid)),
counted AS (SELECT host, count(rule) AS n, (count(*) FILTER (WHERE rule_verdict = 'block')) AS bad,
  regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM judged GROUP BY host),
cut AS (SELECT *, regexp_matches(bare, '^[0-9]+(\\.[0-9]+){{3}}$') AS num, regexp_extract(bare, '[^.]*$') AS one,
  regexp_extract(bare, '([^.]*\\.)?[^.]*$') AS two, regexp_extract(bare, '([^.]*\\.)?([^.]*\\.)?[^.]*$') AS three FROM counted),
hosts AS (SELECT host, n, bad, CASE WHEN num THEN bare WHEN two IN ({_WIDE}) THEN three ELSE two END AS domain,
  CASE WHEN num THEN bare WHEN two IN ({_WIDE}) THEN two ELSE one END AS suffix FROM cut),
domains AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM hosts GROUP BY ALL),
ends AS (SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM hosts GROUP BY ALL),
{_level("h", "hosts")}, {_level("d", "domains")}, {_level("s", "ends")},
s_mean AS (SELECT suffix, (h.overall * s.k + bad) / (n + s.k) AS m FROM ends, k_s s, k_h h),
d_mean AS (SELECT domain, suffix, (m * d.k + bad) / (n + d.k) AS m FROM domains JOIN s_mean USING (suffix), k_d d),
h_mean AS (SELECT host, (m * h.k + bad) / (n + h.k) AS p, n, h.k AS k FROM hosts JOIN d_mean USING (domain, suffix), k_h h),
bounds AS (SELECT host, p, p - 1.645::DOUBLE * sqrt(p * (1.0::DOUBLE - p) / (n + k + 1.0::DOUBLE)) AS bound FROM h_mean)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  round(p, 9) AS posterior, round(bound, 9) AS bound
FROM judged JOIN bounds USING (host)
"""


@query("op1_url_filter", SQL)
def op1_url_filter(spark, sf_dir):
    """Every page's host, path, rule and verdict; the pages that rules judge are the labelled outcomes of the reputation."""
    judged = judge_urls(load(spark, sf_dir, "pages", "page_id", "url"), RULES)
    return judged.select(
        "page_id", "host", "path", "rule", "verdict", F.round("posterior", 9).alias("posterior"), F.round("bound", 9).alias("bound")
    )
