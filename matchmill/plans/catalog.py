"""All named queries; importing the query modules registers them."""

from __future__ import annotations

from matchmill.plans import (  # noqa: F401
    event_queries, feed_queries, fixture_queries, landing_queries, publication_queries, quality_queries, snapshot_queries,
    suite_queries, tree_queries,
)
from matchmill.plans.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
