"""Latest row per key, key filters and top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid_keys(df: DataFrame, key: str, min_length: int = 6, bad: Sequence[str] = ("null",)) -> DataFrame:
    """Keep rows whose key is present, not blank, no sentinel text and at least ``min_length`` long."""
    text = F.trim(F.col(key).cast("string"))
    return df.filter(
        F.col(key).isNotNull() & (text != "") & ~F.col(key).cast("string").isin(*bad) & (F.length(text) >= min_length)
    )


def top_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark turns a row number with such a filter into a group limit before the shuffle, so a hot group
    sends at most ``k`` rows per map task.
    """
    name = rank or "_rn"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    out = ranked.filter(F.col(name) <= k)
    return out.withColumn(name, F.col(name).cast("long")) if rank else out.drop(name)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``; give a total order so that the survivor is always the same."""
    return top_rows(df, keys, order)


def build_dimension(
    df: DataFrame, key: str, columns: dict[str, Column], order: Sequence[Column], min_length: int = 6
) -> DataFrame:
    """A current-state dimension: valid keys, latest row per key, renamed and cast columns."""
    return dedup_latest(valid_keys(df, key, min_length), [key], order).select(
        *[column.alias(name) for name, column in columns.items()]
    )
