"""As-of joins of cumulative snapshots with a time axis, races and forward fills.

No row is compared with more than its own stretch of time: axis intervals are cut into buckets, each
snapshot meets only the intervals of its bucket, is reduced to one row per (entity, axis step), and
gaps are filled by repeating that row up to the next one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchmill.fixed_values import MEDALS
from matchmill.functions.text import lookup
from matchmill.operators.dedup import dedup_latest
from matchmill.operators.ranking import rank_rows, top_with_ties
from matchmill.operators.scan import ordered_scan
from matchmill.session import stage


def hour_of(column: str) -> Column:
    return F.date_trunc("HOUR", F.col(column))


def build_axis(checkpoints: DataFrame, ts: str, fallback_hours: int = 24) -> DataFrame:
    """Distinct checkpoint times, numbered, each with the boundary up to which snapshots count for it.

    The boundary is the next distinct time, or ``fallback_hours`` after the last one.
    """
    times = checkpoints.select(F.col(ts).alias("axis_ts")).filter(F.col("axis_ts").isNotNull()).distinct()
    axis = ordered_scan(
        times, [], ["axis_ts"], row_number="step", previous={"_prev": "axis_ts"}, following={"_next": "axis_ts"},
        bucket=hour_of("axis_ts"),
    )
    last = F.col("axis_ts") + F.make_dt_interval(F.lit(0), F.lit(fallback_hours), F.lit(0), F.lit(0))
    # A step takes the snapshots after the boundary before it, which is its own time.
    axis = axis.select(
        "axis_ts", "step", F.when(F.col("_prev").isNotNull(), F.col("axis_ts")).alias("after"),
        F.coalesce("_next", last).alias("boundary"),
    )
    return stage(axis, "axis")  # small, and read several times


def step_of_snapshot(
    snapshots: DataFrame, axis: DataFrame, snap_ts: str, earliest: Column | None = None, grain: str = "HOUR"
) -> DataFrame:
    """Add ``step``: the first axis step whose boundary is not before the snapshot.

    Snapshots past the last boundary belong to no step and drop out. ``earliest`` may give a time no
    snapshot is before; otherwise it is looked up. ``grain`` is the bucket in which snapshots meet axis
    steps: take MINUTE or SECOND for an axis with many steps an hour.
    """
    if earliest is None:
        earliest = snapshots.agg(F.min(snap_ts)).scalar()
    start = F.least(F.coalesce("after", earliest), F.col("boundary"))
    buckets = F.sequence(F.date_trunc(grain, start), F.date_trunc(grain, "boundary"), F.expr(f"INTERVAL 1 {grain}"))
    stretches = axis.select("step", "after", "boundary", F.explode(buckets).alias("_bucket"))
    inside = (F.col(snap_ts) <= F.col("boundary")) & (F.col("after").isNull() | (F.col(snap_ts) > F.col("after")))
    return (
        snapshots.withColumn("_bucket", F.date_trunc(grain, F.col(snap_ts))).join(stretches, "_bucket").filter(inside)
        .drop("_bucket", "after", "boundary")
    )


def repeat_to_next(states: DataFrame, entity: str, last_step: Column, values: Sequence[str], baseline: int | None = None) -> DataFrame:
    """Dense steps from sparse (entity, step) rows: each row is repeated until the entity's next row.

    With ``baseline`` the steps before an entity's first row appear too, holding that number. A window
    group has at most as many rows as the axis has steps.
    """
    along = Window.partitionBy(entity).orderBy("step")
    rows = states.withColumns({"_to": F.coalesce(F.lead("step").over(along) - 1, last_step), "_from": F.col("step")})
    if baseline is not None:
        rows = rows.withColumn("_from", F.when(F.lag("step").over(along).isNull(), F.lit(1)).otherwise(F.col("step")))
    dense = rows.select(
        entity, F.col("step").alias("_own"), *values, F.explode(F.sequence("_from", "_to")).alias("step")
    )
    if baseline is not None:
        early = F.col("step") < F.col("_own")
        dense = dense.withColumns({v: F.when(early, F.lit(baseline)).otherwise(F.col(v)) for v in values})
    return dense.select(entity, "step", *values)


def asof_snapshot(
    checkpoints: DataFrame, snapshots: DataFrame, entity: str, cp_id: str, cp_ts: str, snap_ts: str,
    values: Sequence[str], tie_break: Sequence[Column] = (), fallback_hours: int = 24, earliest: Column | None = None,
) -> DataFrame:
    """For every checkpoint and entity the latest snapshot that is not after the checkpoint's boundary."""
    axis = build_axis(checkpoints, cp_ts, fallback_hours)
    placed = step_of_snapshot(snapshots.select(entity, snap_ts, *values), axis, snap_ts, earliest)
    states = dedup_latest(placed, [entity, "step"], [F.col(snap_ts).desc(), *tie_break])
    dense = repeat_to_next(states, entity, axis.agg(F.max("step")).scalar(), values)
    named = checkpoints.select(cp_id, F.col(cp_ts).alias("axis_ts")).join(axis.select("axis_ts", "step"), "axis_ts")
    return dense.join(named, "step").select(cp_id, "step", F.col("axis_ts").alias(cp_ts), entity, *values)


def race_leaders(current: DataFrame, entity: str, order: Sequence[tuple[str, bool]], k: int = 3) -> DataFrame:
    """The ``k`` best entities right now, ties included."""
    return top_with_ties(current, order, k).select(entity)


def race(
    checkpoints: DataFrame, leader_snapshots: DataFrame, entity: str, cp_id: str, cp_ts: str, snap_ts: str,
    order: Sequence[tuple[str, bool]], fallback_hours: int = 24, earliest: Column | None = None,
) -> DataFrame:
    """The leaders' path over all checkpoints, with rank and medal at each.

    Checkpoints at one time are told apart by id. ``is_latest`` marks the last checkpoint time.
    """
    values = [c for c, _ in order]
    rows = asof_snapshot(
        checkpoints, leader_snapshots, entity, cp_id, cp_ts, snap_ts, values, fallback_hours=fallback_hours, earliest=earliest
    )
    # Any number of leaders may share a place, so a checkpoint's rows are ranked by distinct results.
    rows = rank_rows(stage(rows, "race"), order, [cp_id], dense="rank_at_step")
    last = checkpoints.agg(F.max(cp_ts)).scalar()
    medal = lookup(F.col("rank_at_step").cast("int"), MEDALS)
    return rows.withColumns({"medal": medal, "is_latest": F.col(cp_ts) == last})


def forward_fill(df: DataFrame, entity: str, axis_ts: str, values: Sequence[str], baseline: int = 0) -> DataFrame:
    """Every entity at every axis step, holding its last known values, ``baseline`` before the first."""
    times = df.select(axis_ts).distinct()
    axis = stage(ordered_scan(times, [], [axis_ts], row_number="step", bucket=hour_of(axis_ts)), "axis")
    states = df.select(entity, axis_ts, *values).join(axis, axis_ts)
    return repeat_to_next(states, entity, axis.agg(F.max("step")).scalar(), values, baseline).join(axis, "step")


def path_signature(df: DataFrame, entity: str, step: str, value: str, baseline: int = 0) -> DataFrame:
    """Entities whose values agree at every step share a signature; they are numbered within it.

    Only the steps at which the value changes matter, so a path is described by its change points (at
    most one per axis step).
    """
    along = Window.partitionBy(entity).orderBy(step)
    before = F.coalesce(F.lag(value).over(along), F.lit(baseline))
    points = df.withColumn("_turn", F.when(F.col(value) != before, F.concat_ws(":", step, value)))
    # collect_list skips the NULLs of steps without a change, so an unchanged path gives an empty list.
    turns = F.array_sort(F.collect_list(F.when(F.col("_turn").isNotNull(), F.struct(F.col(step), F.col("_turn")))))
    paths = points.groupBy(entity).agg(F.array_join(F.transform(turns, lambda t: t["_turn"]), "|").alias("signature"))
    return ordered_scan(paths, ["signature"], [entity], row_number="position")


def current_leaders(rows: DataFrame, flag: str, step: str, order: Sequence[Column]) -> DataFrame:
    """The flagged rows, or those of the last step where none is flagged, in reading order."""
    any_flag = F.coalesce(rows.agg(F.bool_or(flag)).scalar(), F.lit(False))
    last = rows.agg(F.max(step)).scalar()
    return rows.filter(F.when(any_flag, F.col(flag)).otherwise(F.col(step) == last)).orderBy(*order)


def _runs(states: DataFrame, entity: str, values: Sequence[str], part: int = 1024) -> DataFrame:
    """(entity, from_step, to_step, values) of (entity, step, values) rows: a run up to the step before the next change of a value.

    ``to_step`` is NULL where the state still holds. Both passes cut an entity's rows into parts of ``part`` steps.
    """
    bucket = F.floor(F.col("step") / part)
    own = F.struct(*values)
    seen = ordered_scan(stage(states.withColumn("_now", own), "states"), [entity], ["step"], previous={"_was": "_now"}, bucket=bucket)
    turns = stage(seen.filter(~F.col("_now").eqNullSafe(F.col("_was"))).drop("_now", "_was"), "turns")
    runs = ordered_scan(turns, [entity], ["step"], following={"_next": "step"}, bucket=bucket)
    return runs.select(entity, F.col("step").alias("from_step"), (F.col("_next") - 1).alias("to_step"), *values)


def asof_intervals(
    checkpoints: DataFrame, snapshots: DataFrame, entity: str, cp_ts: str, snap_ts: str, values: Sequence[str],
    tie_break: Sequence[Column] = (), fallback_hours: int = 24,
) -> DataFrame:
    """(entity, from_step, to_step, values): each entity's state over the axis, a row per change instead of one per step.

    Boundaries of the axis and snapshots are put on one line and cut by range; the boundaries passed so far, carried from part to part,
    tell the step of a snapshot. No step, entity or span of time is ever spelt out. ``to_step`` is the last step for a state that still
    holds. Snapshots without a time, or after the last boundary, belong to no step; an entity has no row for the steps before its first
    snapshot. Of snapshots in one step the last counts, ties by ``tie_break``.
    """
    axis = build_axis(checkpoints, cp_ts, fallback_hours)
    shape = snapshots.filter(F.col(snap_ts).isNotNull()).select(
        F.col(snap_ts).alias("_at"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_passed_one"), F.struct(entity, snap_ts, *values).alias("_snap"))
    ends = axis.select(
        F.col("boundary").alias("_at"), F.lit(1).alias("_kind"), F.lit(1).cast("long").alias("_passed_one"), F.lit(None).cast(shape.schema["_snap"].dataType).alias("_snap"))
    # A snapshot at a boundary counts before it.
    line = ordered_scan(shape.unionByName(ends), [], ["_at", "_kind"], sums={"_passed": "_passed_one"})
    placed = line.filter("_kind = 0").select("_snap.*", (F.col("_passed") + 1).alias("step"))
    last = axis.agg(F.max("step")).scalar()
    placed = placed.filter(F.col("step") <= last)
    states = dedup_latest(placed, [entity, "step"], [F.col(snap_ts).desc(), *tie_break]).select(entity, "step", *values)
    runs = _runs(states, entity, values)
    return runs.withColumn("to_step", F.coalesce("to_step", last))


def fill_intervals(df: DataFrame, entity: str, axis_ts: str, values: Sequence[str], baseline: int = 0) -> DataFrame:
    """``forward_fill`` as (entity, from_step, to_step, values) runs of equal values, ``baseline`` before an entity's first row."""
    times = df.select(axis_ts).filter(F.col(axis_ts).isNotNull()).distinct()
    axis = stage(ordered_scan(times, [], [axis_ts], row_number="step", bucket=hour_of(axis_ts)), "axis")
    last = axis.agg(F.max("step")).scalar()
    states = stage(df.select(entity, axis_ts, *values).join(axis, axis_ts).select(entity, "step", *values), "filled")
    first = states.groupBy(entity).agg(F.min("step").alias("_first")).filter("_first > 1")
    before = first.select(entity, F.lit(1).cast("long").alias("step"), *[F.lit(baseline).cast(states.schema[v].dataType).alias(v) for v in values])
    runs = _runs(states.unionByName(before), entity, values)
    return runs.withColumn("to_step", F.coalesce("to_step", last))


def expand_runs(runs: DataFrame, entities: DataFrame, entity: str) -> DataFrame:
    """A row per step for the entities asked for, from runs."""
    asked = runs.join(entities.select(entity).distinct(), entity, "left_semi")
    kept = [c for c in runs.columns if c not in ("from_step", "to_step")]
    return asked.select(*kept, F.explode(F.sequence("from_step", "to_step")).alias("step"))
