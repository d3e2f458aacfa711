"""Ordered scans (running totals, row numbers, previous and next row) that no hot group can stall.

A plain window puts a whole group into one task. Here every group is first cut into parts that rise
with the order. A window numbers and sums inside each (group, part); one small row per (group, part)
carries the totals of the parts before it, and an equi-join adds them up. Only those small rows are
ever windowed per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill.session import stage

PART = "_part"


def _typed_default(data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    if isinstance(data_type, T.NumericType):
        return F.lit(0).cast(data_type)
    if isinstance(data_type, T.DateType):
        return F.lit("1970-01-01").cast(data_type)
    return F.lit("1970-01-01 00:00:00").cast(data_type)


def null_safe_keys(df: DataFrame, keys: Sequence[str], prefix: str = "_k") -> tuple[DataFrame, list[str]]:
    """Add join-ready copies of ``keys`` in which NULL is an ordinary value.

    The copies are non-null, so a plain equi-join on them keeps NULL groups, and windows and joins on
    them share one hash partitioning.
    """
    names = [f"{prefix}{i}" for i in range(len(keys))]
    fields = {f.name: f.dataType for f in df.schema.fields}
    nulls = F.lit(0)
    for i, key in enumerate(keys):
        nulls = nulls + F.when(F.col(key).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    added = {name: F.coalesce(F.col(key), _typed_default(fields[key])) for name, key in zip(names, keys)}
    if keys:
        added[f"{prefix}n"] = nulls
        names = [*names, f"{prefix}n"]
    return df.withColumns(added), names


def ordered_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    *,
    row_number: str | None = None,
    sums: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Add running columns over ``group`` in ascending ``order`` (column names, a total order).

    ``sums`` maps new column -> column to sum up to and including the row; ``previous`` and
    ``following`` map new column -> column to take from the row before or after.

    ``bucket`` is an expression that rises with ``order`` (a date or an hour of a timestamp order): no
    shuffle is needed to cut the groups, and the plan stays lazy. Without it the rows are range
    partitioned by (group, order) and staged once, so any order works.

    The input is read twice, for the rows and for the totals per part; give a stored or staged table, not
    the end of a long pipeline.
    """
    sums, previous, following = dict(sums or {}), dict(previous or {}), dict(following or {})
    columns = df.columns
    if bucket is None:
        ranged = df.repartitionByRange(*group, *order).withColumn(PART, F.spark_partition_id())
        parts = stage(ranged, "ordered-scan")
    else:
        parts = df.withColumn(PART, bucket)
    parts, keys = null_safe_keys(parts, group)
    inner = Window.partitionBy(*keys, PART).orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    local: dict[str, Column] = {}
    totals: list[Column] = []
    if row_number:
        local["_rn"] = F.row_number().over(inner).cast("long")
        totals.append(F.count(F.lit(1)).alias("_rows"))
    for i, source in enumerate(sums.values()):
        local[f"_s{i}"] = F.sum(source).over(upto)
        totals.append(F.sum(source).alias(f"_t{i}"))
    # A struct tells "no row here" (NULL struct) from "a row whose value is NULL".
    if previous:
        value = F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(previous.values())])
        local["_before"] = F.lag(value).over(inner)
        totals.append(F.max_by(value, F.struct(*order)).alias("_last"))
    if following:
        value = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(following.values())])
        local["_after"] = F.lead(value).over(inner)
        totals.append(F.min_by(value, F.struct(*order)).alias("_first"))

    per_part = parts.groupBy(*keys, PART).agg(*totals)
    along = Window.partitionBy(*keys).orderBy(PART)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried: dict[str, Column] = {}
    if row_number:
        carried["_rn0"] = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    for i in range(len(sums)):
        carried[f"_s0{i}"] = F.sum(f"_t{i}").over(earlier)
    if previous:
        carried["_before0"] = F.lag("_last").over(along)
    if following:
        carried["_after0"] = F.lead("_first").over(along)
    offsets = per_part.select(*keys, PART, *[c.alias(n) for n, c in carried.items()])

    out = parts.withColumns(local).join(offsets, [*keys, PART])
    added: list[Column] = []
    if row_number:
        added.append((F.col("_rn") + F.col("_rn0")).alias(row_number))
    for i, name in enumerate(sums):
        total = F.coalesce(F.col(f"_s{i}") + F.col(f"_s0{i}"), F.col(f"_s{i}"), F.col(f"_s0{i}"))
        added.append(total.alias(name))
    if previous:
        before = F.coalesce("_before", "_before0")
        added += [before[f"p{i}"].alias(name) for i, name in enumerate(previous)]
    if following:
        after = F.coalesce("_after", "_after0")
        added += [after[f"f{i}"].alias(name) for i, name in enumerate(following)]
    return out.select(*columns, *added)


def global_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "row_rank") -> DataFrame:
    """Number all rows 1..n by ``order`` (any mix of ascending and descending, a total order).

    One range shuffle sorts the rows into partitions; the row's place inside its partition plus the
    sizes of the partitions before it is its number. The sizes are one row per partition, so that
    table may be broadcast.
    """
    columns = df.columns
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *columns, F.monotonically_increasing_id().alias("_mid")
    )
    placed = stage(placed, "global-rank")
    # monotonically_increasing_id: partition number in the upper 31 bits, row in the lower 33.
    placed = placed.withColumn(PART, F.shiftright("_mid", 33))
    sizes = placed.groupBy(PART).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(PART, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rn0"))
    place = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(offsets), PART).select(*columns, (place + F.col("_rn0")).alias(name))
