"""Bounded samples of labelled rows for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``."""
    return F.crc32(F.col(f"`{doc_id}`").cast("string")) % parts


def share_per_class(labelled: DataFrame, label: str, key: list[str], per_class: int) -> tuple[DataFrame, dict]:
    """Rows of each class, chosen by a hash of ``key``, ``per_class`` of them in expectation, and the size of each class.

    Nothing but the class sizes reaches the driver, no row is shuffled and a repeated run picks the same rows. Rows
    that agree in the whole key are picked together, so the key should tell different rows apart.
    """
    sizes = {r["label"]: r["count"] for r in labelled.groupBy(F.col(label).alias("label")).count().collect() if r["label"] is not None}
    place = F.pmod(F.xxhash64(F.lit("sample"), *[F.col(k) for k in key]), F.lit(1_000_000_007)) / 1_000_000_007.0
    chosen = F.lit(False)
    for value, size in sizes.items():
        chosen = chosen | ((F.col(label) == F.lit(value)) & (place < per_class / size))
    return labelled.filter(chosen), sizes


def distinct_sample(rows: DataFrame, label: str, text: str, per_class: int) -> DataFrame:
    """(text, label) of at most ``per_class`` different texts of each class, chosen by a hash of the text.

    How many different texts a class has is estimated, so that a class made of copies gives its texts like any other. Copies of a chosen
    text are combined before they move, and no more than the limit is left of a class.
    """
    key = F.xxhash64(F.lit("sample"), F.col(text))
    sizes = rows.groupBy(F.col(label).alias("label")).agg(F.approx_count_distinct(key).alias("n")).collect()
    place = F.pmod(key, F.lit(1_000_000_007)) / 1_000_000_007.0
    chosen = F.lit(False)
    for row in sizes:
        # A fifth more than wanted, as the number is an estimate.
        chosen = chosen | ((F.col(label) == F.lit(row["label"])) & (place < 1.2 * per_class / max(1, row["n"])))
    few = rows.filter(chosen).select(F.col(text).alias("text"), F.col(label).alias("label")).distinct()
    ranked = Window.partitionBy("label").orderBy(F.xxhash64(F.lit("sample"), F.col("text")), "text")
    return few.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= per_class).drop("_rank")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int, text: str = "text", doc_id: str = "doc_id"
) -> tuple[DataFrame, dict]:
    """(text, label) of about ``per_class`` labelled documents of each class, and the class sizes.

    Labels are sampled first: the few ids kept are bounded by ``per_class`` and so may be broadcast to the documents. A
    document with several labels counts with the largest; null ids and labels are left out.
    """
    ids = labels.filter(allowed & F.col(f"`{label}`").isin(0, 1)).groupBy(F.col(f"`{doc_id}`").alias("_id"))
    ids = ids.agg(F.max(f"`{label}`").alias("_label")).filter("_id is not null")
    few, sizes = share_per_class(ids, "_label", ["_id"], per_class)
    body = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("text"))
    return body.join(F.broadcast(few), "_id").select("text", F.col("_label").cast("double").alias("label")), sizes


def prior_shift(sizes: dict, labels) -> float:
    """What to add to the log odds that a sample with its share of ones gives, for the share of the whole."""
    import math

    ones = max(1.0, float(sum(labels)))
    zeros = max(1.0, len(labels) - ones)
    return math.log(max(1, sizes.get(1, 0)) / max(1, sizes.get(0, 0))) - math.log(ones / zeros)
