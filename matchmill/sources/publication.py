"""Loads that replace a set of tables at one moment.

A load writes every table into a folder of its own, and readers never see it: they resolve a table's folders through a manifest, a
small file with a number. Publishing writes the next manifest, last and as a whole, so that a reader finds the tables of the load
before or those of this one, never a mixture. What a load skips keeps the folders that the manifest before names.

While a table is written its rows are counted and judged by row rules, without a scan of its own. A rule or a check that fails as an
error keeps the whole load from being published.

A history keeps its open versions in hash buckets of the key, a folder per bucket. A load writes the buckets that hold a change and a
folder of versions that it closed; all others stay as they are, files included.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchmill.operators.history import fold_snapshots
from matchmill.session import stage

ERROR, WARNING = "error", "warning"
#: Folders of open versions of a history.
BUCKETS = 64


class GateError(Exception):
    """A load failed its checks; nothing was published. ``report`` holds all results."""

    def __init__(self, report: list[CheckResult]):
        self.report = report
        super().__init__("; ".join(f"{r.table} {r.rule}: {r.failing} (allowed {r.allowed})" for r in report if not r.ok and r.severity == ERROR))


@dataclass(frozen=True)
class Rule:
    """A rule about single rows: which fail, how many may, and whether more keep the load back."""

    failing: Column
    severity: str = ERROR
    allowed: int = 0


@dataclass(frozen=True)
class CheckResult:
    table: str
    rule: str
    severity: str
    failing: int
    allowed: int

    @property
    def ok(self) -> bool:
        return self.failing <= self.allowed


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, place = _file_system(spark, f"{root}/manifests")
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def read_manifest(spark: SparkSession, root: str, number: int | None = None) -> dict:
    """The manifest with a number, or the last; without any, one of no tables."""
    numbers = _numbers(spark, root)
    if not numbers:
        return {"number": 0, "load": None, "tables": {}}
    name = f"{root}/manifests/{numbers[-1] if number is None else number:012d}.json"
    return json.loads(spark.read.text(name, wholetext=True).first()[0])


def _write_manifest(spark: SparkSession, root: str, manifest: dict) -> None:
    """Written under another name and renamed: a manifest is there as a whole or not at all. A number that is taken is an error."""
    fs, target = _file_system(spark, f"{root}/manifests/{manifest['number']:012d}.json")
    _, draft = _file_system(spark, f"{root}/manifests/.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"manifest {manifest['number']} exists: another load was published first")


def _folders(entry: dict) -> list[str]:
    return [*entry["folders"], *entry.get("buckets", {}).values()]


def _read(spark: SparkSession, entry: dict, folders: Sequence[str]) -> DataFrame:
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(entry["schema"])
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_published(spark: SparkSession, root: str, *names: str, number: int | None = None) -> dict[str, DataFrame]:
    """Tables (all, or those named) as one manifest has them, the last or that with ``number``."""
    tables = read_manifest(spark, root, number)["tables"]
    return {name: _read(spark, tables[name], _folders(tables[name])) for name in names or tables}


class Load:
    """One load of tables under ``root``: write, skip, check, then publish."""

    def __init__(self, spark: SparkSession, root: str, load_id: str):
        self.spark, self.root, self.load_id = spark, root.rstrip("/"), load_id
        self.before = read_manifest(spark, self.root)
        self.tables: dict[str, dict] = dict(self.before["tables"])
        self.report: list[CheckResult] = []

    def _folder(self, name: str) -> str:
        return f"{self.root}/data/{name}/{self.load_id}-{uuid.uuid4().hex[:12]}"

    def write(self, name: str, df: DataFrame, minimum: int = 0, rules: Mapping[str, Rule] | None = None) -> DataFrame:
        """Write a table once and return it; it counts only once the load is published.

        Fewer rows than ``minimum`` fail as an error. The rules are judged on the rows as they are written.
        """
        rules, folder = dict(rules or {}), self._folder(name)
        seen = Observation()
        counts = [F.count_if(F.coalesce(rule.failing, F.lit(False))).alias(f"r{k}") for k, rule in enumerate(rules.values())]
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(folder)
        got = seen.get
        self.report.append(CheckResult(name, "missing_rows", ERROR, max(0, minimum - got["rows"]), 0))
        self.report += [CheckResult(name, rule, r.severity, got[f"r{k}"], r.allowed) for k, (rule, r) in enumerate(rules.items())]
        self.tables[name] = {"folders": [folder], "schema": json.loads(df.schema.json()), "rows": got["rows"], "load": self.load_id}
        return self.table(name)

    def skip(self, name: str) -> DataFrame:
        """Keep what is published of a table whose feed was skipped; there must be something."""
        if name not in self.tables:
            raise ValueError(f"{name} was never published")
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        """A table as this load has it."""
        return _read(self.spark, self.tables[name], _folders(self.tables[name]))

    def check(self, table: str, rule: str, failing: DataFrame, severity: str = ERROR, allowed: int = 0) -> CheckResult:
        """Count the rows of a check over whole tables (duplicates, orphans, a suite's report)."""
        result = CheckResult(table, rule, severity, failing.count(), allowed)
        self.report.append(result)
        return result

    def stop_on_errors(self) -> None:
        """Raise if a check failed as an error so far, before more is built on these tables."""
        if any(not r.ok and r.severity == ERROR for r in self.report):
            raise GateError(self.report)

    def history(
        self, name: str, snapshots: DataFrame, keys: Sequence[str], track: Sequence[str], monotone: Sequence[str],
        valid_from: str = "valid_from", buckets: int = BUCKETS,
    ) -> DataFrame:
        """Bring a history up to date with any number of snapshots per key and return it.

        Open versions are read in the buckets of the snapshots' keys alone, and written in the buckets with a change alone.
        """
        entry = self.tables.get(name, {"folders": [], "buckets": {}, "parts": buckets})
        bucket = F.pmod(F.xxhash64(*keys), F.lit(entry["parts"])).cast("int")
        snapshots = stage(snapshots.select(*keys, *track, F.col(valid_from).alias("valid_from")), "snapshots")
        moment = snapshots.schema["valid_from"].dataType
        schema = snapshots.select(
            *keys, *track, "valid_from", F.lit(None).cast(moment).alias("valid_to"), F.lit(True).alias("is_current")).schema
        entry = {**entry, "schema": json.loads(schema.json()), "load": self.load_id}

        def open_in(parts: Sequence[int]) -> DataFrame:
            return _read(self.spark, entry, [entry["buckets"][str(b)] for b in parts if str(b) in entry["buckets"]])

        present = [r[0] for r in snapshots.select(bucket).distinct().collect()]  # at most one per bucket
        versions = stage(fold_snapshots(open_in(present), snapshots, keys, track, monotone).withColumn("_bucket", bucket), "versions")
        touched = sorted(r[0] for r in versions.select("_bucket").distinct().collect())
        if touched:
            same = open_in(touched).join(versions.select(*keys).distinct(), list(keys), "left_anti").withColumn("_bucket", bucket)
            now = versions.filter("is_current").unionByName(same)
            folder = self._folder(name)
            now.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{folder}/open")
            versions.filter("NOT is_current").drop("_bucket").write.parquet(f"{folder}/closed")
            entry["buckets"] = {**entry["buckets"], **{str(b): f"{folder}/open/_bucket={b}" for b in touched}}
            entry["folders"] = [*entry["folders"], f"{folder}/closed"]
        self.tables[name] = entry
        return self.table(name)

    def publish(self) -> int:
        """Make this load the one that readers find, unless a check failed as an error; returns the manifest's number."""
        self.stop_on_errors()
        number = self.before["number"] + 1
        _write_manifest(self.spark, self.root, {"number": number, "load": self.load_id, "tables": self.tables})
        return number


def report_rows(spark: SparkSession, results: Sequence[CheckResult]) -> DataFrame:
    """(table_name, rule, severity, failing, ok) of a load's results: a row per rule."""
    rows = [(r.table, r.rule, r.severity, r.failing, r.ok) for r in results]
    return spark.createDataFrame(rows, "table_name string, rule string, severity string, failing bigint, ok boolean")


def expire_manifests(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all manifests but the last ``keep``, and the folders that none of these names; returns the folders removed.

    Run it while no load is being written: what is not published yet is named by no manifest.
    """
    numbers = _numbers(spark, root)
    live = {f for n in numbers[-keep:] for e in read_manifest(spark, root, n)["tables"].values() for f in _folders(e)}
    for number in numbers[:-keep]:
        fs, place = _file_system(spark, f"{root}/manifests/{number:012d}.json")
        fs.delete(place, False)
    gone = []
    fs, data = _file_system(spark, f"{root}/data")
    leaves = [data] if fs.exists(data) else []
    while leaves:
        place = leaves.pop()
        path = place.toString().removeprefix("file:")
        if any(f == path or f.startswith(f"{path}/") for f in live):
            if path not in live:
                leaves += [s.getPath() for s in fs.listStatus(place) if s.isDirectory()]
        else:
            fs.delete(place, True)
            gone.append(path)
    return gone
