"""Versioned history (SCD-2) of cumulative snapshots with guarded change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill.operators.joins import any_of
from matchmill.operators.scan import ordered_scan
from matchmill.session import stage

#: Snapshots of a key that are folded at once; more are folded page by page.
PAGE = 1024


def changed(track: Sequence[str], old: str, new: str) -> Column:
    """Any tracked value differs; NULL against a value is a change."""
    return any_of([~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in track])


def regressed(monotone: Sequence[str], old: str, new: str) -> Column:
    """A cumulative value fell or vanished."""
    falls = [
        F.col(f"{old}.{c}").isNotNull() & (F.col(f"{new}.{c}").isNull() | (F.col(f"{new}.{c}") < F.col(f"{old}.{c}")))
        for c in monotone
    ]
    return any_of(falls) if falls else F.lit(False)


def _paired(
    history: DataFrame, snapshot: DataFrame, keys: Sequence[str], track: Sequence[str], monotone: Sequence[str],
    valid_from: str,
) -> DataFrame:
    """Current version and new snapshot side by side, one row per key, with what happened to it.

    Both sides hold one row per key, so the join has no skew.
    """
    current = history.filter("is_current").select(*keys, F.struct(*[c for c in history.columns]).alias("old"))
    fresh = snapshot.select(*keys, F.struct(*snapshot.columns).alias("new"))
    both = current.join(fresh, list(keys), "full_outer")
    newer = F.col(f"new.{valid_from}") > F.col("old.valid_from")
    event = (
        F.when(F.col("new").isNull(), "absent")
        .when(F.col("old").isNull(), "new")
        .when(~changed(track, "old", "new"), "same")
        .when(~newer, "late")
        .when(regressed(monotone, "old", "new"), "regressed")
        .otherwise("changed")
    )
    return both.withColumn("event", event)


def first_load(snapshot: DataFrame, keys: Sequence[str], track: Sequence[str], valid_from: str) -> DataFrame:
    return snapshot.select(
        *keys, *track, F.col(valid_from).alias("valid_from"), F.lit(None).cast(snapshot.schema[valid_from].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def detect_changes(
    history: DataFrame, snapshot: DataFrame, keys: Sequence[str], track: Sequence[str], monotone: Sequence[str],
    valid_from: str,
) -> DataFrame:
    """Snapshot rows with their event: new, changed, same, regressed or late."""
    pairs = _paired(history, snapshot, keys, track, monotone, valid_from)
    return pairs.filter(F.col("new").isNotNull()).select("new.*", "event")


def scd2_apply(
    history: DataFrame | None, snapshot: DataFrame, keys: Sequence[str], track: Sequence[str], monotone: Sequence[str],
    valid_from: str = "valid_from",
) -> DataFrame:
    """The history after one snapshot (one row per key).

    A changed, not regressed key closes its current version at the snapshot's time and opens a new one;
    new keys open one; everything else stays. Closed versions are passed through without a shuffle.
    """
    if history is None:
        return first_load(snapshot, keys, track, valid_from)
    closed = history.filter("NOT is_current")
    return closed.unionByName(current_versions(history, snapshot, keys, track, monotone, valid_from))


def current_versions(
    history: DataFrame, snapshot: DataFrame, keys: Sequence[str], track: Sequence[str], monotone: Sequence[str],
    valid_from: str = "valid_from",
) -> DataFrame:
    """What one snapshot makes of the current versions: those still open and those closed just now."""
    pairs = _paired(history, snapshot, keys, track, monotone, valid_from)
    columns = [*keys, *track]
    turned = F.col("event") == "changed"
    none = F.lit(None).cast(history.schema["valid_to"].dataType)
    old = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in columns],
        F.col("old.valid_from").alias("valid_from"),
        F.when(turned, F.col(f"new.{valid_from}")).otherwise(none).alias("valid_to"),
        (~turned).alias("is_current"),
    )
    new = F.struct(
        *[F.col(f"new.{c}").alias(c) for c in columns],
        F.col(f"new.{valid_from}").alias("valid_from"),
        none.alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    rows = F.array_compact(
        F.array(F.when(F.col("old").isNotNull(), old), F.when(F.col("event").isin("new", "changed"), new))
    )
    return pairs.select(F.explode(rows).alias("v")).select("v.*")


def close_current(history: DataFrame, keys: Sequence[str], changes: DataFrame, at: str) -> DataFrame:
    """Close the current version of every key in ``changes`` (one row per key) at its time ``at``."""
    marks = changes.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col(at).alias("_at"))
    match = F.col("is_current")
    for k in keys:
        match = match & (F.col(k) == F.col(f"_c_{k}"))
    joined = history.join(marks, match, "left")
    hit = F.col("_at").isNotNull()
    return joined.withColumns(
        {
            "valid_to": F.when(hit, F.col("_at")).otherwise(F.col("valid_to")),
            "is_current": F.when(hit, F.lit(False)).otherwise(F.col("is_current")),
        }
    ).select(*history.columns)


def scd2_asof(history: DataFrame, moment: Column) -> DataFrame:
    """The versions valid at ``moment``."""
    return history.filter((F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (F.col("valid_to") > moment)))


def retention_prune(history: DataFrame, as_of: Column, hours: int = 168) -> DataFrame:
    """Drop closed versions that ended more than ``hours`` before ``as_of``."""
    limit = as_of - F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0))
    return history.filter(F.col("valid_to").isNull() | (F.col("valid_to") >= limit))


def order_snapshots(snapshots: DataFrame, keys: Sequence[str], track: Sequence[str], valid_from: str = "valid_from") -> DataFrame:
    """(keys, track, valid_from, _rn): snapshots numbered within their key by time, without those that repeat the one before.

    At one time of a key the row with the largest values comes first. A row with the tracked values of the row before it is never a
    version: that row either became the version it equals or was refused for the same reason.
    """
    timed = snapshots.filter(F.col(valid_from).isNotNull()).groupBy(*keys, valid_from).agg(F.array_sort(F.collect_set(F.struct(*track))).alias("_all"))
    ranked = timed.select(*keys, F.col(valid_from).alias("valid_from"), F.posexplode(F.reverse("_all")).alias("_tie", "_row"))
    ranked = stage(ranked.select(*keys, "valid_from", "_tie", "_row"), "ranked")
    before = ordered_scan(ranked, list(keys), ["valid_from", "_tie"], previous={"_before": "_row"})
    fresh = stage(before.filter(~F.col("_row").eqNullSafe(F.col("_before"))).drop("_before"), "fresh")
    numbered = ordered_scan(fresh, list(keys), ["valid_from", "_tie"], row_number="_rn")
    return numbered.select(*keys, "_row.*", "valid_from", "_rn")


def _fold(rows: Column, open_: Column, track: Sequence[str], monotone: Sequence[str], types: dict) -> Column:
    """The open version after a page of snapshots in order, and the places of those that became versions."""
    columns = ["valid_from", *track]
    start = F.struct(
        open_.isNotNull().alias("has"), *[open_[c].cast(types[c]).alias(c) for c in columns], F.array().cast("array<int>").alias("picked"),
        F.lit(0).alias("n"),
    )

    def step(state: Column, row: Column) -> Column:
        differs = any_of([~state[c].eqNullSafe(row[c]) for c in track])
        falls = any_of([state[c].isNotNull() & (row[c].isNull() | (row[c] < state[c])) for c in monotone]) if monotone else F.lit(False)
        take = ~state["has"] | (differs & (row["valid_from"] > state["valid_from"]) & ~falls)
        return F.struct(
            (state["has"] | take).alias("has"), *[F.when(take, row[c]).otherwise(state[c]).alias(c) for c in columns],
            F.when(take, F.concat(state["picked"], F.array(state["n"]))).otherwise(state["picked"]).alias("picked"), (state["n"] + 1).alias("n"),
        )

    return F.aggregate(rows, start, step)


def fold_snapshots(
    open_versions: DataFrame, snapshots: DataFrame, keys: Sequence[str], track: Sequence[str], monotone: Sequence[str],
    valid_from: str = "valid_from", page: int = PAGE,
) -> DataFrame:
    """All versions of the keys that any number of snapshots change: those closed by them, and those open now.

    The same as applying the snapshots one after the other in order of time, each to the versions that the ones before it left: a
    snapshot becomes a version if it is later than the open one, differs from it and does not fall in a guarded column. The open
    versions are read once. Snapshots of a key are folded in pages of at most ``page``; a key with more pages hands its open version on
    from page to page, and only such keys go into the next round. Keys without a change give no rows, nor do snapshots without a time.
    """
    numbered = order_snapshots(snapshots, keys, track, valid_from)
    types = {f.name: f.dataType for f in numbered.schema.fields}
    columns = ["valid_from", *track]
    pages = numbered.withColumn("_page", F.floor((F.col("_rn") - 1) / page).cast("int")).groupBy(*keys, "_page").agg(
        F.array_sort(F.collect_list(F.struct("_rn", *columns))).alias("rows"))
    pages = stage(pages, "pages")
    rounds = pages.agg(F.max("_page")).first()[0]
    none = F.lit(None).cast(types["valid_from"])
    state = open_versions.filter("is_current").select(*keys, F.struct(*columns).alias("open"))
    # Only keys with snapshots go on; null keys are keys like any other.
    found = []
    for number in range((-1 if rounds is None else rounds) + 1):
        here = pages.filter(F.col("_page") == number)
        left, right = here.alias("p"), state.alias("s")
        same = [F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
        folded = left.join(right, same, "left").select(*[F.col(f"p.{k}").alias(k) for k in keys], "p.rows", "s.open")
        folded = folded.withColumn("end", _fold(F.col("rows"), F.col("open"), track, monotone, types))
        folded = folded.select(
            *keys, "open", F.struct(*[F.col(f"end.{c}").alias(c) for c in columns]).alias("last"),
            F.transform("end.picked", lambda k: F.struct(*[F.get("rows", k)[c].alias(c) for c in columns])).alias("taken"),
        )
        folded = stage(folded, f"fold-{number}")
        # What was open, and every version but the last, ends where the next begins; the last goes on as the open one.
        chain = F.when(F.col("open").isNotNull(), F.concat(F.array("open"), "taken")).otherwise(F.col("taken"))
        ended = folded.filter(F.size("taken") > 0).select(*keys, chain.alias("chain"))
        ended = ended.select(*keys, F.explode(F.expr("transform(sequence(1, greatest(1, size(chain) - 1)), i -> CASE WHEN size(chain) > i THEN struct(chain[i - 1] AS v, chain[i].valid_from AS until) END)")).alias("e"))
        found.append(ended.filter("e IS NOT NULL").select(*keys, "e.v.*", F.col("e.until").alias("valid_to"), F.lit(False).alias("is_current")))
        turned = folded.select(*keys, F.col("last").alias("open"), (F.size("taken") > 0).alias("turned"))
        state, rest = turned.select(*keys, "open"), turned.select(*keys, "turned", F.lit(number).alias("_round"), "open")
        found.append(rest.select(*keys, "open.*", none.alias("valid_to"), F.lit(True).alias("is_current"), "turned", "_round"))
    return _last_open(found, keys, track, open_versions)


def _last_open(found: Sequence[DataFrame], keys: Sequence[str], track: Sequence[str], empty: DataFrame) -> DataFrame:
    """Closed versions of all rounds, and the open version after each key's last round if any round changed it."""
    columns = [*keys, *track, "valid_from", "valid_to", "is_current"]
    if not found:
        return empty.select(*columns).limit(0)
    closed, opened = found[0], found[1]
    for more in found[2::2]:
        closed = closed.unionByName(more)
    for more in found[3::2]:
        opened = opened.unionByName(more)
    body = F.struct("_round", *[c for c in columns if c not in keys])
    last = opened.groupBy(*keys).agg(F.bool_or("turned").alias("turned"), F.max_by(body, "_round").alias("v"))
    last = last.filter("turned").select(*keys, "v.*").drop("_round")
    return closed.select(*columns).unionByName(last.select(*columns))
