"""Writes: full overwrite, all-or-nothing load, history table, JSON records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.operators.history import current_versions, first_load, fold_snapshots
from matchmill.session import stage
from matchmill.sources.feeds import row_gate


class RowGateError(Exception):
    """A table had too few rows; nothing was written."""


def overwrite_table(df: DataFrame, path: str, reads_target: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``; its schema may change.

    A frame that reads the target itself is staged first, since a path cannot be read and replaced at once.
    """
    if reads_target:
        df = stage(df, "overwrite")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def save_all_or_nothing(tables: Mapping[str, tuple[DataFrame, int]], folder: str) -> DataFrame:
    """Write every table under ``folder`` only if each has its minimum number of rows.

    Each frame is computed once, into a staged copy; the counts and the final writes read that copy. A
    table given as ``None`` (its feed was skipped) keeps what it has.
    """
    staged = {name: (stage(df, f"load-{name}"), minimum) for name, (df, minimum) in tables.items() if df is not None}
    report = row_gate(staged)
    short = [f"{r.table_name}: {r.rows} < {r.minimum}" for r in report.filter(~F.col("ok")).collect()]  # one row per table
    if short:
        raise RowGateError("; ".join(short))
    for name, (df, _) in staged.items():
        overwrite_table(df, f"{folder}/{name}")
    return report


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per row, written by the executors; NULL fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def json_records(df: DataFrame, name: str = "record") -> DataFrame:
    """Rows as JSON texts."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


def load_history(
    spark: SparkSession, path: str, snapshot: DataFrame, keys: Sequence[str], track: Sequence[str], monotone: Sequence[str],
    load_id: str, valid_from: str = "valid_from", exists: bool = True,
) -> None:
    """Apply one snapshot to the history table at ``path``.

    The table is partitioned by (is_current, load_id). Only the open versions are read and rewritten; the
    versions this load closes go to the load's own partition, so repeating a load replaces its partition
    and never touches what earlier loads closed. They are written before the open ones: a load that broke
    off in between finds the old open versions again and closes the same rows.
    """
    if exists:
        table = read_history(spark, path).filter("is_current")
        rows = current_versions(table, snapshot, keys, track, monotone, valid_from)
    else:
        rows = first_load(snapshot, keys, track, valid_from)
    _write_versions(rows, path, load_id)


def load_many(
    spark: SparkSession, path: str, snapshots: DataFrame, keys: Sequence[str], track: Sequence[str], monotone: Sequence[str],
    load_id: str, valid_from: str = "valid_from", exists: bool = True,
) -> bool:
    """Apply any number of snapshots per key to the history table at ``path`` in one load; returns whether the table exists now."""
    rows = snapshots.select(*keys, *track, F.col(valid_from).alias("valid_from"))
    none = F.lit(None).cast(rows.schema["valid_from"].dataType)
    start = rows.limit(0).withColumns({"valid_to": none, "is_current": F.lit(True)})
    table = read_history(spark, path).filter("is_current") if exists else start
    versions = stage(fold_snapshots(table, rows, keys, track, monotone), "versions")
    if versions.isEmpty():
        return exists
    same = table.join(versions.select(*keys).distinct(), list(keys), "left_anti")
    _write_versions(versions.unionByName(same), path, load_id)
    return True


def _write_versions(rows: DataFrame, path: str, load_id: str) -> None:
    rows = rows.withColumn("load_id", F.when(F.col("is_current"), F.lit("open")).otherwise(F.lit(load_id)))
    staged = stage(rows, "history")
    for part in ("NOT is_current", "is_current"):
        writer = staged.filter(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("is_current", "load_id").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The whole history; a filter on ``is_current`` prunes to the folders that hold such versions."""
    return spark.read.parquet(path).withColumn("is_current", F.col("is_current").cast("boolean")).drop("load_id")
