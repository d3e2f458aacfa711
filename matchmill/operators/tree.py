"""Feeder trees (brackets): positions, edges from labels, names of still open places, podium."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill.functions.text import label_source, suffix_number
from matchmill.operators.dedup import top_rows
from matchmill.operators.joins import lookup_join


def label_edges(nodes: DataFrame, labels: Sequence[str] = ("home_label", "away_label")) -> DataFrame:
    """(source match, target position) from labels such as ``Winner Match 74``; a source's first mention wins."""
    mentions = nodes.select(
        "match_id", "position",
        F.posexplode(F.array(*[label_source(F.col(c)) for c in labels])).alias("_slot", "source_id"),
    ).filter(F.col("source_id").isNotNull())
    first = [F.col("match_id").try_cast("long").asc_nulls_last(), F.col("match_id").asc(), F.col("_slot").asc()]
    return top_rows(mentions, ["source_id"], first).select("source_id", F.col("position").alias("feeds_into"))


def feeder_pair_positions(matches: DataFrame, pairs: DataFrame) -> DataFrame:
    """Position of each match whose two labelled feeders are, in any order, a known pair.

    ``pairs`` holds (feeder_a, feeder_b, position). Comparing the sorted pair makes it an equi-join.
    """
    known = pairs.select(
        F.least("feeder_a", "feeder_b").alias("low"), F.greatest("feeder_a", "feeder_b").alias("high"),
        F.col("position").alias("pair_position"),
    )
    home, away = label_source(F.col("home_label")), label_source(F.col("away_label"))
    fed = matches.select("match_id", F.least(home, away).alias("low"), F.greatest(home, away).alias("high")).filter(
        home.isNotNull() & away.isNotNull()
    )
    return fed.join(known, ["low", "high"]).select("match_id", "pair_position")


def bracket_side(position: Column, top_half: Column) -> Column:
    """Top up to the round's threshold, Bottom beyond it, Neutral in rounds without halves."""
    return F.when(top_half == 0, "Neutral").when(suffix_number(position) <= top_half, "Top").otherwise("Bottom")


def half_by_suffix(position: Column) -> Column:
    """The half by last digit alone: 1 or 3 is Top, 2 or 4 is Bottom, anything else NULL."""
    last = F.right(position, F.lit(1))
    return F.when(last.isin("1", "3"), "Top").when(last.isin("2", "4"), "Bottom")


def build_tree(
    matches: DataFrame, rounds: DataFrame, fixed_positions: DataFrame | None = None, pairs: DataFrame | None = None,
    overrides: DataFrame | None = None,
) -> DataFrame:
    """Positions, halves and feeds-into pointers.

    ``matches``: match_id, round_code, home_label, away_label, ... ``rounds``: round_code, prefix,
    top_half, id_offset. A position is the fixed one, else the one of the feeder pair, else
    prefix and match id less the offset. ``overrides`` (match_id, feeds_into) win over labels.
    """
    nodes = matches.join(rounds, "round_code")
    position = F.concat_ws("-", "prefix", (F.col("match_id").try_cast("long") - F.col("id_offset")).cast("string"))
    position = F.when(F.col("round_code") == "third", "3rd-Place").when(F.col("round_code") == "final", "Final").otherwise(position)
    known: list[Column] = []
    if fixed_positions is not None:
        nodes = lookup_join(nodes, fixed_positions, {"match_id": "match_id"}, {"_fixed": "position"})
        known.append(F.col("_fixed"))
    if pairs is not None:
        nodes = lookup_join(nodes, feeder_pair_positions(matches, pairs), {"match_id": "match_id"}, {"_pair": "pair_position"})
        known.append(F.col("_pair"))
    nodes = nodes.withColumn("position", F.coalesce(*known, position))
    nodes = nodes.withColumn("side", bracket_side(F.col("position"), F.col("top_half")))
    nodes = lookup_join(nodes, label_edges(nodes), {"match_id": "source_id"}, {"_label": "feeds_into"})
    target = F.col("_label")
    if overrides is not None:
        nodes = lookup_join(nodes, overrides, {"match_id": "match_id"}, {"_override": "feeds_into"})
        target = F.coalesce("_override", target)
    columns = [c for c in matches.columns]
    return nodes.withColumn("feeds_into", target).select(*columns, "prefix", "position", "side", "feeds_into")


def ordered_feeders(nodes: DataFrame, half: str | None = None) -> DataFrame:
    """Per target position its first two feeders, in a fixed order, as (parent, first, second).

    Top comes before Bottom where a half is given, then the position's number, then its text. Only two
    places exist per target, so at most two rows per target leave a task.
    """
    number = [suffix_number(F.col("position")).asc(), F.col("position").asc()]
    order = [F.when(F.col(half) == "Bottom", 1).otherwise(0).asc(), *number] if half else number
    ready = F.col("is_finished") & F.col("winner").isNotNull()
    children = nodes.filter(F.col("feeds_into").isNotNull()).select(
        F.col("feeds_into").alias("parent"), "position", "is_finished", *([half] if half else []),
        F.when(ready, F.col("winner")).alias("winner"), F.coalesce(ready, F.lit(False)).alias("ready"),
    )
    slots = top_rows(children, ["parent"], order, 2, "slot")
    child = F.struct("position", "winner", "ready")
    return slots.groupBy("parent").agg(
        F.max(F.when(F.col("slot") == 1, child)).alias("first"), F.max(F.when(F.col("slot") == 2, child)).alias("second")
    )


def surplus_feeders(nodes: DataFrame) -> DataFrame:
    """(parent, feeders) of targets with more than two feeders: a check, as only two have a place."""
    fed = nodes.filter(F.col("feeds_into").isNotNull()).groupBy(F.col("feeds_into").alias("parent"))
    return fed.agg(F.count(F.lit(1)).alias("feeders")).filter("feeders > 2")


def resolve_tree(nodes: DataFrame) -> DataFrame:
    """Add ``home_display`` and ``away_display``: known name, feeder's winner, ``Winner of X`` or ``TBD``.

    The first feeder fills the home place, the second the away place.
    """
    feeders = ordered_feeders(nodes).withColumnRenamed("parent", "position")
    joined = nodes.join(feeders, "position", "left")
    shown = {}
    for side, slot in (("home", "first"), ("away", "second")):
        waiting = F.when(F.col(slot).isNotNull(), F.concat(F.lit("Winner of "), F.col(f"{slot}.position")))
        shown[f"{side}_derived"] = F.coalesce(F.col(f"{side}_team"), F.col(f"{slot}.winner"))
        shown[f"{side}_display"] = F.coalesce(F.col(f"{side}_team"), F.col(f"{slot}.winner"), waiting, F.lit("TBD"))
    return joined.withColumns(shown).drop("first", "second")


def resolve_tree_sorted(nodes: DataFrame, half: str = "side") -> DataFrame:
    """The display variant: a finished fixture shows its own names; otherwise feeders decide.

    Adds ``<side>_name`` and ``<side>_open`` (the name is only a placeholder).
    """
    feeders = ordered_feeders(nodes, half).withColumnRenamed("parent", "position")
    joined = nodes.join(feeders, "position", "left")
    for side, slot in (("home", "first"), ("away", "second")):
        own = F.col(f"{side}_team")
        placeholder = F.coalesce(own.startswith("Winner of"), F.lit(False))
        usable = F.coalesce(own != "TBD", F.lit(False))
        settled = F.col("is_finished") & usable & ~placeholder
        fed, winner = F.col(slot).isNotNull(), F.col(f"{slot}.winner")
        waiting = fed & winner.isNull()
        name = (
            F.when(settled, own).when(winner.isNotNull(), winner)
            .when(waiting, F.concat(F.lit("Winner of "), F.col(f"{slot}.position")))
            .when(usable, own).otherwise(F.lit("TBD"))
        )
        is_open = F.when(settled | winner.isNotNull(), False).when(waiting, True).when(usable, placeholder).otherwise(True)
        joined = joined.withColumns({f"{side}_name": name, f"{side}_open": is_open})
    return joined.drop("first", "second")


def podium(nodes: DataFrame, final: Column, third: Column) -> DataFrame:
    """(place, participant): winner and other side of finished finals, winner of finished third-place fixtures."""
    done = F.col("is_finished") & F.col("winner").isNotNull()
    runner_up = F.when(F.col("winner") == F.col("home_team"), F.col("away_team")).otherwise(F.col("home_team"))

    def place(number: int, name: Column) -> Column:
        return F.struct(F.lit(number).alias("place"), name.alias("participant"))

    none = F.array().cast("array<struct<place:int,participant:string>>")
    places = (
        F.when(final & done, F.array(place(1, F.col("winner")), place(2, runner_up)))
        .when(third & done, F.array(place(3, F.col("winner")))).otherwise(none)
    )
    return nodes.filter(done & (final | third)).select("position", F.explode(places).alias("p")).select(
        "position", "p.place", "p.participant"
    ).filter(F.col("participant").isNotNull())


def open_items_or_podium(open_items: DataFrame, medals: DataFrame) -> DataFrame:
    """Open items if there are any, else the podium, as (kind, label) rows; decided inside the plan."""
    any_open = open_items.agg(F.count(F.lit(1)) > 0).scalar()
    first = open_items.select(F.lit("open").alias("kind"), F.col("label"))
    second = medals.select(F.lit("podium").alias("kind"), F.col("participant").alias("label")).filter(~any_open)
    return first.unionByName(second)
