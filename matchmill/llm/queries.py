"""All queries of this subpackage; importing the query modules registers them."""

from __future__ import annotations

import corpus_pipeline
from matchmill.llm import (  # noqa: F401
    op1_queries, op2_queries, op3_queries, op4_queries, op5_queries, op6_queries, op7_queries, op8_queries, op9_queries, op10_queries, op11_queries,
    op12_queries, op13_queries,
)
from matchmill.llm.registry import QUERIES, SQL, Query, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
