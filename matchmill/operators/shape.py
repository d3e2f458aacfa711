"""Small reshaping operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metrics to (metric, value) rows."""
    wide = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(ids), list(metrics), "metric", "value")


def unified_facts(branches: Sequence[DataFrame]) -> DataFrame:
    """Stack branches with different columns; a column a branch lacks is a typed NULL there."""
    out = branches[0]
    for branch in branches[1:]:
        out = out.unionByName(branch, allowMissingColumns=True)
    return out


def stage_ordinal(stage: Column, order: Sequence[str]) -> Column:
    """1 for the first stage of ``order``, NULL for an unknown one."""
    return F.nullif(F.array_position(F.array(*[F.lit(s) for s in order]), stage), F.lit(0).cast("long"))
