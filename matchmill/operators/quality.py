"""Data-quality checks. A check returns the failing rows as (failure_detail, failure_count); none means pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill.operators.joins import any_of
from matchmill.operators.scan import ordered_scan


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of the columns, with the first such column."""
    first = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return df.withColumn("null_column", first).filter(F.col("null_column").isNotNull())


def blank_keys(df: DataFrame, key: str, bad: Sequence[str] = ("null",)) -> DataFrame:
    text = F.col(key).cast("string")
    return df.filter(text.isNull() | (F.trim(text) == "") | text.isin(*bad))


def outside_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Rows whose value is known but not accepted."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))


def orphans(df: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows with a known key that the parent lacks."""
    right = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(on.values())])
    known = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on]))
    return known.join(right, [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(on)], "left_anti")


def ratio_above(df: DataFrame, top: str, bottom: str, limit: float) -> DataFrame:
    """Rows where top / bottom is over the limit; rows with bottom 0 have no ratio."""
    return df.withColumn("ratio", F.try_divide(F.col(top).cast("double"), F.col(bottom))).filter(F.col("ratio") > limit)


def formula_off(df: DataFrame, stored: Column, expected: Column, tolerance: float = 0.0) -> DataFrame:
    return df.filter(F.abs(stored - expected) > tolerance)


def formulas_off(df: DataFrame, formulas: Mapping[str, tuple[Column, Column]], tolerance: float = 0.0) -> DataFrame:
    """One row per row and formula (name -> stored, expected) that is off, from one scan."""
    wrong = [F.when(F.abs(stored - expected) > tolerance, F.lit(name)) for name, (stored, expected) in formulas.items()]
    return df.withColumn("formula", F.explode(F.array_compact(F.array(*wrong))))


def differing(df: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys present in both whose columns disagree (NULL-safe)."""
    right = source.select(F.col(key).alias("_key"), *[F.col(c).alias(f"source_{c}") for c in columns])
    both = df.join(right, F.col(key) == F.col("_key")).drop("_key")
    return both.filter(any_of([~F.col(c).eqNullSafe(F.col(f"source_{c}")) for c in columns]))


def falling(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], bucket: Column | None = None) -> DataFrame:
    """Rows in which a cumulative column is below the key's row before."""
    rows = ordered_scan(df, [key], order, previous={f"prev_{c}": c for c in columns}, bucket=bucket)
    return rows.filter(any_of([F.coalesce(F.col(c) < F.col(f"prev_{c}"), F.lit(False)) for c in columns]))


def over_budget(df: DataFrame, failing: Column, budget: int) -> DataFrame:
    """One row with the number of failing rows, only if there are more than ``budget``."""
    return df.agg(F.count_if(failing).alias("failing")).filter(F.col("failing") > budget)


def over_budgets(df: DataFrame, budgets: Mapping[str, tuple[Column | None, int, int]]) -> DataFrame:
    """Several budgets in one scan: name -> (failing? or None for all rows, least, most); (budget, n) if outside."""
    counts = df.agg(*[(F.count(F.lit(1)) if c is None else F.count_if(c)).alias(f"n{i}") for i, (c, _, _) in enumerate(budgets.values())])
    found = [
        F.when(~F.col(f"n{i}").between(low, high), F.struct(F.lit(name).alias("budget"), F.col(f"n{i}").alias("n")))
        for i, (name, (_, low, high)) in enumerate(budgets.items())
    ]
    return counts.select(F.explode(F.array_compact(F.array(*found))).alias("b")).select("b.*")


def row_count_outside(df: DataFrame, low: int, high: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).filter(~F.col("rows").between(low, high))


@dataclass(frozen=True)
class Check:
    """A named check over a frame of failing rows; ``detail`` says what failed."""

    name: str
    failing: Callable[[], DataFrame]
    detail: Column | str = ""
    count: str | None = None

    def rows(self) -> DataFrame:
        detail = F.lit(self.detail) if isinstance(self.detail, str) else self.detail
        weight = F.col(self.count).cast("long") if self.count else F.lit(1).cast("long")
        return self.failing().select(
            F.lit(self.name).alias("failure_type"), detail.cast("string").alias("failure_detail"), weight.alias("_weight")
        )


@dataclass(frozen=True)
class RowRules:
    """Rules about single rows of one table, all judged in one scan: name -> (failing?, detail)."""

    df: DataFrame
    rules: Mapping[str, tuple[Column, Column | str]]

    def rows(self) -> DataFrame:
        found = []
        for name, (failing, detail) in self.rules.items():
            text = F.lit(detail) if isinstance(detail, str) else detail
            failure = F.struct(F.lit(name).alias("failure_type"), text.cast("string").alias("failure_detail"))
            found.append(F.when(failing, failure))
        rows = self.df.select(F.explode(F.array_compact(F.array(*found))).alias("f"))
        return rows.select("f.failure_type", "f.failure_detail", F.lit(1).cast("long").alias("_weight"))


def run_checks(checks: Sequence[Check | RowRules]) -> DataFrame:
    """One report (failure_type, failure_detail, failure_count) over all checks; empty means all pass."""
    rows = reduce(DataFrame.unionByName, [check.rows() for check in checks])
    return rows.groupBy("failure_type", "failure_detail").agg(F.sum("_weight").alias("failure_count"))
