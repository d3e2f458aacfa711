"""Feeds whose damaged parts are kept aside: a payload or an element that cannot be read is a row with a reason, not a row of nulls."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.session import stage

#: Reasons, in the order in which they are looked for.
UNREADABLE_PAYLOAD, NO_LIST, UNREADABLE_ELEMENT, NO_KEY = "unreadable payload", "list missing", "unreadable element", "key missing"


@dataclass(frozen=True)
class Level:
    """A list in a payload, or in the elements of the level above: its name, and the fields of its elements as DDL."""

    name: str
    fields: str


def landed_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(source, payload): the files of a folder as whole texts, with their paths."""
    return spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("payload"))


def _read(text: Column, fields: str) -> Column:
    return F.from_json(text, f"{fields}, _damage string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damage"})


def judged_elements(payloads: DataFrame, levels: Sequence[Level], keys: Sequence[str], payload: str = "payload", keep: Sequence[str] = ("source",)) -> DataFrame:
    """A row per element of the innermost list, or per part that could not be read: ``keep``, place, item, reason, text.

    ``place`` is the path of positions, such as 0/3. A part that fails is judged alone: the elements beside it are read. ``reason`` is
    NULL for good elements; ``text`` holds the part that failed. An element with a NULL or blank key fails. A list that is missing or
    NULL fails; an empty one has no elements.
    """
    rows = payloads.select(*keep, F.col(payload).alias("_text"), F.lit("").alias("place"))
    outer, failed = [], None
    for depth, level in enumerate(levels):
        own = f"{levels[depth - 1].fields}, " if depth else ""
        read = rows.withColumn("_p", _read(F.col("_text"), f"{own}`{level.name}` array<string>"))
        broken = F.col("_p").isNull() | F.col("_p._damage").isNotNull()
        reason = F.when(broken, UNREADABLE_ELEMENT if depth else UNREADABLE_PAYLOAD).when(F.col(f"_p.`{level.name}`").isNull(), NO_LIST)
        read = read.withColumn("_reason", reason)
        bad = read.filter(F.col("_reason").isNotNull()).select(*keep, "place", F.col("_reason").alias("reason"), F.col("_text").alias("text"))
        failed = bad if failed is None else failed.unionByName(bad)
        above = [F.col(f"_p.`{f}`").alias(f) for f in _names(levels[depth - 1].fields)] if depth else []
        good = read.filter(F.col("_reason").isNull())
        rows = good.select(*keep, "place", *outer, *above, F.posexplode(f"_p.`{level.name}`").alias("_at", "_text"))
        outer += _names(levels[depth - 1].fields) if depth else []
        sep = "/" if depth else ""
        rows = rows.withColumn("place", F.concat("place", F.lit(sep), F.col("_at").cast("string"))).drop("_at")
    last = levels[-1]
    read = rows.withColumn("_p", _read(F.col("_text"), last.fields))
    blank = F.lit(False)
    for key in keys:
        value = F.col(f"_p.`{key}`").cast("string")
        blank = blank | value.isNull() | (F.trim(value) == "")
    reason = F.when(F.col("_p").isNull() | F.col("_p._damage").isNotNull(), UNREADABLE_ELEMENT).when(blank, NO_KEY)
    item = F.struct(*outer, *[F.col(f"_p.`{f}`").alias(f) for f in _names(last.fields)])
    judged = read.select(*keep, "place", reason.alias("reason"), F.col("_text").alias("text"), item.alias("item"))
    none = F.lit(None).cast(judged.schema["item"].dataType)
    judged = judged.withColumn("text", F.when(F.col("reason").isNotNull(), F.col("text"))).withColumn("item", F.when(F.col("reason").isNull(), F.col("item")))
    return judged.unionByName(failed.withColumn("item", none))


def _names(fields: str) -> list[str]:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(fields).fieldNames()


def split_feed(
    payloads: DataFrame, levels: Sequence[Level], keys: Sequence[str], payload: str = "payload", keep: Sequence[str] = ("source",)
) -> tuple[DataFrame, DataFrame]:
    """The good elements as rows, and the quarantine (``keep``, place, reason, text). Payloads are read once, into a staged table."""
    judged = stage(judged_elements(payloads, levels, keys, payload, keep), "judged")
    good = judged.filter("reason IS NULL").select(*keep, "item.*")
    return good, judged.filter("reason IS NOT NULL").select(*keep, "place", "reason", "text")


def damage_report(quarantine: DataFrame, source: str = "source") -> DataFrame:
    """How many parts of each source failed, by reason."""
    return quarantine.groupBy(source, "reason").agg(F.count(F.lit(1)).alias("parts"))
