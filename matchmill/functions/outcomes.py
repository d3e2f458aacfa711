"""Who won a two-sided fixture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def winning_side(home: Column, away: Column, home_pens: Column | None = None, away_pens: Column | None = None) -> Column:
    """``home``, ``away`` or NULL, by score and then by penalties."""
    side = F.when(home > away, F.lit("home")).when(away > home, F.lit("away"))
    if home_pens is not None and away_pens is not None:
        side = side.when(home_pens > away_pens, F.lit("home")).when(away_pens > home_pens, F.lit("away"))
    return side


def two_party_outcome(df: DataFrame) -> DataFrame:
    """Add winner and loser (name and id) and the status of a knockout fixture.

    Needs home/away ``_team``, ``_id``, ``_score``, ``_pens`` and ``is_finished``. Nothing is decided
    while a name is missing or the fixture is open.
    """
    home, away = F.col("home_score"), F.col("away_score")
    home_pens, away_pens = F.col("home_pens"), F.col("away_pens")
    named = F.col("home_team").isNotNull() & F.col("away_team").isNotNull()
    decided = named & F.col("is_finished")
    side = F.when(decided, winning_side(home, away, home_pens, away_pens))
    shootout = home_pens.isNotNull() & away_pens.isNotNull()
    status = (
        F.when(~named, "Not Started")
        .when(~F.col("is_finished"), "Scheduled")
        .when(home != away, "Finished")
        .when(~shootout, "Draw (Pending Penalties)")
        .when(home_pens == away_pens, "Draw (Tied Penalties)")
        .otherwise("Finished (Penalties)")
    )
    df = df.withColumn("_side", side)
    picks = {"status": status}
    for what in ("team", "id"):
        h, a = F.col(f"home_{what}"), F.col(f"away_{what}")
        name = "" if what == "team" else "_id"
        picks[f"winner{name}"] = F.when(F.col("_side") == "home", h).when(F.col("_side") == "away", a)
        picks[f"loser{name}"] = F.when(F.col("_side") == "home", a).when(F.col("_side") == "away", h)
    return df.withColumns(picks).drop("_side")


def result_for(mine: Column, theirs: Column) -> Column:
    return F.when(mine > theirs, "Win").when(mine < theirs, "Loss").otherwise("Draw")


def is_shootout(knockout: Column, home: Column, away: Column, winner: Column) -> Column:
    """A knockout fixture that ended level and still has a winner."""
    return knockout & (home == away) & winner.isNotNull()
