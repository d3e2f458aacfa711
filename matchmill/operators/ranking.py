"""Ranks with multi-key tie-breaks, top-k with ties, percent ranks and distance to the leader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchmill.operators.dedup import top_rows
from matchmill.operators.joins import counted_join, lookup_join
from matchmill.operators.scan import ordered_scan
from matchmill.session import stage


def _ascending(df: DataFrame, order: Sequence[tuple[str, bool]]) -> tuple[DataFrame, list[str]]:
    """Sort columns as ascending names: descending numbers are negated, NULLs go last."""
    names, added = [], {}
    for i, (column, descending) in enumerate(order):
        added[f"_nul{i}"] = F.col(column).isNull()
        added[f"_ord{i}"] = -F.col(column) if descending else F.col(column)
        names += [f"_nul{i}", f"_ord{i}"]
    return df.withColumns(added), names


def rank_rows(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    group: Sequence[str] = (),
    rank: str | None = None,
    dense: str | None = None,
    percent: str | None = None,
) -> DataFrame:
    """Rank rows in each group by ``order``: pairs (numeric column, descending?).

    Equal rows share a rank, so ranks are computed on the distinct key tuples (pre-aggregated before
    the shuffle) and joined back. A group or a value with most of the rows costs no more than others.
    """
    keys = [*group, *[c for c, _ in order]]
    tuples = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    tuples, names = _ascending(tuples, order)
    ranked = ordered_scan(tuples, group, names, row_number="_dense", sums={"_upto": "_n"})
    ranked = ranked.withColumn("_rank", F.col("_upto") - F.col("_n") + 1)
    take = {"_rank": rank, "_dense": dense}
    if percent:
        share = (F.col("_rank") - 1).cast("double")
        if group:
            sizes = ranked.groupBy(*group).agg(F.sum("_n").alias("_size"))
            same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
            sizes = sizes.toDF(*[f"_g{i}" for i in range(len(group))], "_size")
            ranked = ranked.join(sizes, same, "left")
            size = F.col("_size")
        else:
            size = ranked.agg(F.sum("_n")).scalar()
        ranked = ranked.withColumn("_percent", F.when(size > 1, share / (size - 1)).otherwise(F.lit(0.0)))
        take["_percent"] = percent
    wanted = {source: name for source, name in take.items() if name}
    table = stage(ranked.select(*keys, "_n", *[F.col(s).alias(n) for s, n in wanted.items()]), "ranks")
    return counted_join(df, table, keys, "_n", list(wanted.values()))


def top_with_ties(
    df: DataFrame, order: Sequence[tuple[str, bool]], k: int, group: Sequence[str] = (), rank: str = "dense_rank"
) -> DataFrame:
    """Rows whose dense rank is at most ``k``: the ``k`` best distinct tuples, with all their rows."""
    keys = [c for c, _ in order]
    sort = [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last() for c, d in order]
    tuples = df.select(*group, *keys).distinct()
    if group:
        best = top_rows(tuples, group, sort, k, rank)
        small = best
    else:
        best = tuples.orderBy(*sort).limit(k)
        best = best.withColumn(rank, F.row_number().over(Window.orderBy(*sort)).cast("long"))
        small = F.broadcast(best)  # k rows
    on = [*group, *keys]
    right = small.toDF(*[f"_b{i}" for i in range(len(on))], rank)
    return df.join(right, [F.col(c).eqNullSafe(F.col(f"_b{i}")) for i, c in enumerate(on)]).drop(
        *[f"_b{i}" for i in range(len(on))]
    )


def percent_ranks(df: DataFrame, measures: dict[str, str], scale: float = 100.0) -> DataFrame:
    """Add ``percent_rank * scale`` (new column -> measure) over all rows, NULLs first as in SQL."""
    ranked = percent_rank_table(df, list(measures.values()), scale)
    for name, measure in measures.items():
        table = ranked.filter(F.col("metric") == measure).select(
            F.col("value").alias("_value"), "_n", F.col("_pct").alias(name)
        )
        fact = df.withColumn("_value", F.col(measure).cast("double"))
        df = counted_join(fact, table, ["_value"], "_n", [name]).drop("_value")
    return df


def percent_rank_table(df: DataFrame, measures: Sequence[str], scale: float = 100.0) -> DataFrame:
    """(metric, value, _n, _pct): how many rows have each value of a measure, and its percent rank times ``scale``.

    All measures are melted into (metric, value) counts, so one ordered scan serves them all.
    """
    melted = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in measures])
        ).alias("s")
    )
    counts = melted.groupBy("s.metric", "s.value").agg(F.count(F.lit(1)).alias("_n"))
    # NULL values sort first: the flag is 0 for them.
    counts = counts.withColumn("_known", F.col("value").isNotNull())
    ranked = ordered_scan(counts, ["metric"], ["_known", "value"], sums={"_upto": "_n"})
    total = df.agg(F.count(F.lit(1))).scalar()
    position = (F.col("_upto") - F.col("_n")).cast("double")
    ranked = ranked.withColumn("_pct", F.when(total > 1, position / (total - 1) * scale).otherwise(F.lit(0.0)))
    return stage(ranked.select("metric", "value", "_n", "_pct"), "percent-ranks")


def gap_to_leader(df: DataFrame, measure: str, name: str = "behind_leader", group: Sequence[str] = ()) -> DataFrame:
    """Distance of each row to the largest value, over all rows or per group."""
    if not group:
        return df.withColumn(name, df.agg(F.max(measure)).scalar() - F.col(measure))
    best = df.groupBy(*group).agg(F.max(measure).alias("_best"))
    joined = lookup_join(df, best, {g: g for g in group}, {"_best": "_best"})
    return joined.withColumn(name, F.col("_best") - F.col(measure)).drop("_best")


def top_listing(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """A sorted listing of ``k`` rows (Spark keeps ``k`` rows per task)."""
    return df.orderBy(*order).limit(k)
