"""Compaction of a published table: few files of about one size whose ranges of a column do not overlap.

Files are planned by their sizes and ranges, a row of numbers each. Those that overlap others, and neighbours that are small, are sorted
and written anew; all others stay as they are. The result is a load like any other: it counts once it is published.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmill.sources.publication import Load

#: A file is small below this part of the size wanted.
SMALL = 0.25


@dataclass(frozen=True)
class FileRange:
    path: str
    size: int
    low: object
    high: object


@dataclass(frozen=True)
class Compaction:
    """What a run did: files before and after, files written anew, and how many others a file overlaps on average."""

    files_before: int
    files_after: int
    rewritten: int
    overlap_before: float
    overlap_after: float


def file_ranges(df: DataFrame, column: str) -> list[FileRange]:
    """Path, size and range of ``column`` of each file behind a table, in order of their ranges. A row per file reaches the driver."""
    rows = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col(column).alias("v"))
    stats = rows.groupBy("path", "size").agg(F.min("v").alias("low"), F.max("v").alias("high")).collect()
    found = [FileRange(r["path"], r["size"], r["low"], r["high"]) for r in stats]
    # Files of NULLs alone come first and overlap nothing.
    return sorted(found, key=lambda f: (f.low is not None, f.low, f.high) if f.low is not None else (False,))


def overlap(files: Sequence[FileRange]) -> float:
    """How many other files a file's range meets on average; ranges that only touch do not meet."""
    from bisect import bisect_left, bisect_right

    known = [f for f in files if f.low is not None]
    lows, highs = sorted(f.low for f in known), sorted(f.high for f in known)
    # All but those that end before a file begins or begin after it ends, and itself.
    met = sum(len(known) - bisect_right(highs, f.low) - (len(known) - bisect_left(lows, f.high)) - 1 for f in known if f.low < f.high)
    return met / len(files) if files else 0.0


def plan_bins(files: Sequence[FileRange], target: int) -> list[list[FileRange]]:
    """Files in groups that are written together: chains of overlapping files, and small ones with their neighbours. Single files stay."""
    chains: list[list[FileRange]] = []
    top = None
    for f in files:
        if chains and top is not None and f.low is not None and f.low < top:
            chains[-1].append(f)
        else:
            chains.append([f])
        top = f.high if top is None or f.high is None or f.high > top else top
    bins: list[list[FileRange]] = []
    for chain in chains:
        small = sum(f.size for f in chain) < SMALL * target
        if bins and (small or sum(f.size for f in bins[-1]) < SMALL * target):
            bins[-1] += chain
        else:
            bins.append(list(chain))
    return [b for b in bins if len(b) > 1]


def compact(load: Load, name: str, order: Sequence[str], target: int) -> Compaction:
    """Write the files of a table anew that are small or unsorted by ``order``, towards ``target`` bytes each.

    Ranges are those of the first column of ``order``. Equal rows may be spread over several files. Publish the load to make it count.
    """
    table = load.table(name)
    files = file_ranges(table, order[0])
    bins = plan_bins(files, target)
    if not bins:
        return Compaction(len(files), len(files), 0, overlap(files), overlap(files))
    spark = load.spark
    place = spark.createDataFrame([(f.path, k) for k, b in enumerate(bins) for f in b], "_path string, _bin int")
    moved = {f.path for b in bins for f in b}
    rows = spark.read.schema(table.schema).parquet(*sorted(moved)).withColumn("_path", F.col("_metadata.file_path"))
    rows = rows.join(F.broadcast(place), "_path").drop("_path")  # a row per file
    parts = sum(max(1, sum(f.size for f in b) // target) for b in bins)
    keys = ["_bin", *order]
    folder = load._folder(name)
    rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).write.partitionBy("_bin").parquet(folder)
    new = spark.read.schema(table.schema).parquet(folder).inputFiles()
    kept = [f.path for f in files if f.path not in moved]
    load.tables[name] = {**load.tables[name], "folders": [*kept, *new], "load": load.load_id}
    after = file_ranges(load.table(name), order[0])
    return Compaction(len(files), len(after), len(moved), overlap(files), overlap(after))
