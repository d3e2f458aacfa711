"""Multi-column clustering of a table before it is written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a text column that its cut points are taken from.
SAMPLE = 20_000


def _bucket_of(column: Column, cuts: Sequence) -> Column:
    """How many cut points are at most the value, as a balanced tree of comparisons (NULL counts as lowest)."""

    def branch(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column >= F.lit(cuts[middle]), branch(middle + 1, high)).otherwise(branch(low, middle))

    return branch(0, len(cuts))


def _text_cuts(df: DataFrame, name: str, parts: int) -> list[str]:
    """Cut points of whole texts, from a sample of about ``SAMPLE`` rows. Texts are compared as Spark orders them."""
    texts = df.select(name).filter(F.col(name).isNotNull())
    total = texts.count()
    few = texts.sample(SAMPLE / total, seed=17) if total > SAMPLE else texts
    found = sorted(r[0] for r in few.collect())
    return sorted({found[len(found) * i // parts] for i in range(1, parts)}) if found else []


def _as_number(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(name).cast("double")
    return F.col(name).cast("double")


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = 5) -> Column:
    """The interleaved bits of each column's quantile bucket.

    The cut points are at most 2**bits - 1 values per column: of numbers and times from one ``percentile_approx`` pass, of texts
    from a bounded sample of whole texts.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    kinds = dict(df.dtypes)
    numbers = [c for c in columns if kinds[c] != "string"]
    row = df.agg(*[F.percentile_approx(_as_number(df, c), shares, 1000).alias(c) for c in numbers]).first() if numbers else {}
    key = F.lit(0).cast("long")
    for i, name in enumerate(columns):
        if kinds[name] == "string":
            bucket = _bucket_of(F.col(name), _text_cuts(df, name, 2**bits)).cast("long")
        else:
            bucket = _bucket_of(_as_number(df, name), sorted(set(row[name] or []))).cast("long")
        for bit in range(bits):
            place = bit * len(columns) + i
            key = key + F.shiftleft(F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("long")), place)
    return key


def cluster_layout(df: DataFrame, columns: Sequence[str], bits: int = 5, files: int | None = None) -> DataFrame:
    """All rows, range partitioned and sorted along the z-order curve of ``columns``; write the result.

    Equal rows are told apart by the partition they come from, so one value with most of the rows still
    spreads over several files.
    """
    keyed = df.withColumns({"_z": zorder_key(df, columns, bits), "_from": F.spark_partition_id()})
    order = ["_z", *columns, "_from"]
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop("_z", "_from")
