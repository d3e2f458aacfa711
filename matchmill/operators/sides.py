"""Two-sided fixtures seen from each participant: one scan, one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmill.operators.dedup import top_rows


def unpivot_sides(fixtures: DataFrame, keep: Sequence[str] = ("match_id",)) -> DataFrame:
    """Two rows per fixture, one per participant, from a single scan."""

    def side(me: str, other: str) -> F.Column:
        return F.struct(
            F.col(f"{me}_team").alias("participant"),
            F.col(f"{other}_team").alias("opponent"),
            F.lit(me == "home").alias("is_home"),
            F.col(f"{me}_score").alias("scored"),
            F.col(f"{other}_score").alias("conceded"),
        )

    both = F.explode(F.array(side("home", "away"), side("away", "home"))).alias("side")
    return fixtures.select(*keep, both).select(*keep, "side.*")


def participant_totals(fixtures: DataFrame, win: int = 3, draw: int = 1, latest: Mapping[str, str] | None = None) -> DataFrame:
    """Played, won, drawn, lost, goals, points, shut-outs and rates per participant over finished fixtures.

    ``latest`` adds columns of each participant's last fixture by kickoff and id (new column -> fixture column), in the same pass.
    """
    latest = dict(latest or {})
    keep = list(dict.fromkeys(["match_id", "kickoff", *latest.values()])) if latest else []
    sides = unpivot_sides(fixtures.filter("is_finished"), keep=keep)
    won, drawn = F.col("scored") > F.col("conceded"), F.col("scored") == F.col("conceded")
    totals = sides.groupBy("participant").agg(
        F.count(F.lit(1)).alias("played"),
        F.count_if(won).alias("wins"),
        F.count_if(drawn).alias("draws"),
        F.count_if(F.col("scored") < F.col("conceded")).alias("losses"),
        F.sum("scored").cast("long").alias("goals_for"),
        F.sum("conceded").cast("long").alias("goals_against"),
        F.count_if(F.col("conceded") == 0).alias("clean_sheets"),
        *[F.max_by(c, F.struct("kickoff", "match_id")).alias(name) for name, c in latest.items()],
    )
    return totals.withColumns(
        {
            "goal_difference": F.col("goals_for") - F.col("goals_against"),
            "points": F.col("wins") * win + F.col("draws") * draw,
            "win_percentage": round_half_up(F.col("wins") * F.lit(100.0) / F.col("played"), 1),
            "goals_per_match": round_half_up(F.col("goals_for") / F.col("played"), 2),
        }
    )


def round_half_up(value: F.Column, digits: int) -> F.Column:
    """Rounding that gives the same double on every engine."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5) / F.lit(scale)


def latest_state(sides: DataFrame, key: str, order: Sequence[F.Column], columns: Sequence[str]) -> DataFrame:
    """The columns of each participant's latest row."""
    return top_rows(sides.select(key, *columns), [key], order)


def participant_history(fixtures: DataFrame, participant: str | None = None) -> DataFrame:
    """Finished fixtures of one participant (or of all), seen from that side, with the shoot-out flag."""
    rows = fixtures.filter("is_finished")
    if participant is not None:
        rows = rows.filter((F.col("home_team") == participant) | (F.col("away_team") == participant))
    sides = unpivot_sides(rows, keep=["match_id", "kickoff", "stage", "winner", "is_knockout"])
    if participant is not None:
        sides = sides.filter(F.col("participant") == participant)
    level = F.col("scored") == F.col("conceded")
    return sides.withColumns(
        {
            "letter": F.when(F.col("winner") == F.col("participant"), "W").when(F.col("winner").isNull(), "D").otherwise("L"),
            "is_shootout": F.col("is_knockout") & level & F.col("winner").isNotNull(),
        }
    )
