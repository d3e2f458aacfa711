"""Lookup joins.

Plain joins carry no broadcast hint: Spark broadcasts a side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, at run time where adaptive execution
is on. Hints are given only to tables whose row count is bounded by construction.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.operators.scan import null_safe_keys

# A key is hot when it holds more than a quarter of an even share of a shuffle partition, or a thousandth of all rows.
HOT_SHARE = 1000


def hot_share(spark: SparkSession) -> int:
    """A key is hot above 1/share of all rows, so there are fewer hot keys than that."""
    return max(HOT_SHARE, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A table of fixed values written in the code; its size is bounded by that, so it may be broadcast."""
    cells = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*cells))))


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str], how: str = "left"
) -> DataFrame:
    """Attach ``take`` (new column -> dimension column) where fact columns equal dimension columns (``on``)."""
    right = dim.select(
        *[F.col(d).alias(f"_on{i}") for i, d in enumerate(on.values())],
        *[F.col(source).alias(name) for name, source in take.items()],
    )
    condition = None
    for i, key in enumerate(on):
        part = F.col(key) == F.col(f"_on{i}")
        condition = part if condition is None else condition & part
    return fact.join(right, condition, how).drop(*[f"_on{i}" for i in range(len(on))])


def role_join(
    fact: DataFrame, dim: DataFrame, roles: Sequence[str], dim_key: str, take: Mapping[str, str], key_suffix: str = "_id"
) -> DataFrame:
    """Join one dimension once per role: role ``home`` uses ``home_id`` and adds ``home_<name>``."""
    for role in roles:
        fact = lookup_join(fact, dim, {f"{role}{key_suffix}": dim_key}, {f"{role}_{n}": c for n, c in take.items()})
    return fact


def counted_join(fact: DataFrame, table: DataFrame, on: Sequence[str], count: str, take: Sequence[str]) -> DataFrame:
    """Left-join ``table`` (one row per key, with the number of fact rows in ``count``), safe for hot keys.

    Hot keys (``hot_share``) are answered from a broadcast of fewer rows than that share; their fact rows then get a spread-out join key instead of all meeting in one task. NULL keys match NULL.
    """
    columns = fact.columns
    fact, keys = null_safe_keys(fact, on, "_f")
    table, table_keys = null_safe_keys(table, on, "_f")
    table = table.select(*table_keys, F.col(count).alias("_cnt"), F.struct(*take).alias("_row"))
    total = table.agg(F.sum("_cnt")).scalar()
    hot = table.filter(F.col("_cnt") * hot_share(fact.sparkSession) > total).select(*table_keys, F.col("_row").alias("_hot"))
    fact = fact.join(F.broadcast(hot), keys, "left")
    fact = fact.withColumn(
        "_spread", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(F.spark_partition_id() + 1)
    )
    cold = table.drop("_cnt").withColumn("_spread", F.lit(0))
    joined = fact.join(cold, [*keys, "_spread"], "left")
    found = F.coalesce("_hot", "_row")
    return joined.select(*columns, *[found[name].alias(name) for name in take])


def any_of(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out
