"""From landed feeds to published marts: JSON payloads to bronze tables with ids and a bracket, then the layers.

Feeds lie in folders of JSON files: scorers and assists (ranked players), standings, fixtures, stadiums. What cannot be read is kept in
the table ``bronze/quarantine``. A feed that did not run keeps the tables that come from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.fixed_values import MINIMUM_ROWS, R32_ORDER, ROUNDS
from matchmill.functions.outcomes import winning_side
from matchmill.functions.text import is_true
from matchmill.operators.joins import literal_table
from matchmill.operators.tree import build_tree
from matchmill.plans.layers import build_layers, run_moment
from matchmill.session import stage
from matchmill.sources.feeds import (
    FIXTURES_FEED, RANKED_FEED, STANDINGS_FEED, VENUES_FEED, attach_key, distinct_teams, fixture_rows, merge_feeds, ranked_rows,
    standing_rows, surrogate_keys, venue_rows,
)
from matchmill.sources.publication import WARNING, CheckResult, Load
from matchmill.sources.quarantine import Level, landed_texts, split_feed


def _element(feed: str, *lists: str) -> str:
    """The fields of a feed's innermost elements as DDL."""
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(feed)
    for name in lists:
        kind = kind[name].dataType.elementType
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields)


def feed_levels() -> dict[str, tuple[list[Level], list[str]]]:
    """The lists of each feed's payload, and the fields that an element must have."""
    ranked = [Level("scorers", _element(RANKED_FEED, "scorers"))]
    return {
        "scorers": (ranked, ["player_slug"]),
        "assists": (ranked, ["player_slug"]),
        "standings": ([Level("tables", "`group` string"), Level("rows", _element(STANDINGS_FEED, "tables", "rows"))], ["team"]),
        "fixtures": ([Level("games", _element(FIXTURES_FEED, "games"))], ["id"]),
        "stadiums": ([Level("stadiums", _element(VENUES_FEED, "stadiums"))], ["id"]),
    }


def team_ids(names: DataFrame, known: DataFrame | None, seen: Sequence[str]) -> DataFrame:
    """(team_name, team_id): ids of names seen before stay, others get the next numbers in the order of their first mention."""
    if known is None:
        return surrogate_keys(names, "team_name", seen).withColumnRenamed("surrogate_id", "team_id")
    old = known.select("team_name", "team_id").filter("team_name is not null").distinct()
    new = surrogate_keys(names.join(old, "team_name", "left_anti"), "team_name", seen, "")
    last = old.agg(F.coalesce(F.max(F.regexp_extract("team_id", r"(\d+)$", 1).try_cast("long")), F.lit(0).cast("long"))).scalar()
    return old.unionByName(new.select("team_name", F.concat(F.lit("team_"), (F.col("surrogate_id").cast("long") + last).cast("string")).alias("team_id")))


def players(scorers: DataFrame, assists: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per player of both ranked feeds, with the id of the team by name."""
    rows = merge_feeds(ranked_rows(scorers), ranked_rows(assists), "player_slug", zero=["goals"])
    rows = rows.withColumnsRenamed({
        "player_slug": "player_id", "player": "player_name", "team": "team_name", "goals": "goals_scored", "matches": "matches_played", "minutes": "minutes_played"})
    return attach_key(rows, ids, "team_name", "team_id")


def bracket(spark: SparkSession, fixtures: DataFrame) -> DataFrame:
    """Knockout fixtures with their position, the position that they feed, and who won; names of open places stay NULL."""
    rounds = literal_table(spark, ["round_code", "prefix", "top_half", "id_offset"], [(code, *v) for code, v in ROUNDS.items()])
    fixed = literal_table(spark, ["match_id", "position"], [(m, f"R32-{k}") for k, m in enumerate(R32_ORDER, 1)])
    pairs = [(R32_ORDER[2 * k], R32_ORDER[2 * k + 1], f"R16-{k + 1}") for k in range(len(R32_ORDER) // 2)]
    feeders = literal_table(spark, ["feeder_a", "feeder_b", "position"], pairs)
    targets = literal_table(spark, ["match_id", "feeds_into"], [(m, p) for a, b, p in pairs for m in (a, b)])
    cup = fixtures.filter("match_type <> 'group'").withColumns({
        "round_code": F.col("match_type"), "home_label": F.col("home_team_label"), "away_label": F.col("away_team_label"), "is_finished": is_true(F.col("finished")),
    })
    tree = build_tree(cup, rounds, fixed, feeders, targets)
    decided = F.col("is_finished") & F.col("home_team_name").isNotNull() & F.col("away_team_name").isNotNull()
    side = F.when(decided, winning_side(*[F.col(c) for c in ("home_score", "away_score", "home_penalty_score", "away_penalty_score")]))

    def pick(what: str, won: bool) -> Column:
        first, second = ("home", "away") if won else ("away", "home")
        return F.when(side == "home", F.col(f"{first}_team_{what}")).when(side == "away", F.col(f"{second}_team_{what}"))

    return tree.select(
        "match_id", F.col("round_code").alias("round"), F.col("position").alias("bracket_position"), F.col("feeds_into").alias("feeds_into_position"),
        F.col("home_team_name").alias("home_team"), F.col("away_team_name").alias("away_team"), "home_team_id", "away_team_id", "home_score", "away_score",
        "home_scorers", "away_scorers", pick("name", True).alias("winner_team"), pick("id", True).alias("winner_team_id"), pick("name", False).alias("loser_team"),
        F.col("local_date").alias("match_date_local"), "stadium_id", "is_finished",
    )


def run_feeds(
    spark: SparkSession, feeds_dir: str, out_dir: str, as_of: Column, load_id: str, minimum: Mapping[str, int] = MINIMUM_ROWS, skipped: Sequence[str] = (),
) -> list[CheckResult]:
    """Read the landed feeds, build all three layers and publish them at one moment; returns the report.

    Too few good rows of a table fail the load; damaged parts are a warning with their number. All rows of a run bear one moment of
    ingestion. ``skipped`` names feeds that did not run: their tables stay as published, and team ids stay for names seen before.
    """
    load, moment = Load(spark, out_dir, load_id), run_moment()
    good: dict[str, DataFrame] = {}
    damaged: list[DataFrame] = []
    for feed, (levels, keys) in feed_levels().items():
        if feed not in skipped:
            texts = landed_texts(spark, f"{feeds_dir}/{feed}")
            rows, aside = split_feed(texts, levels, keys, keep=["source"])
            good[feed] = rows
            damaged.append(aside.select(F.lit(feed).alias("feed"), "source", "place", "reason", "text"))
    tables: dict[str, DataFrame] = {}
    known = load.table("bronze/teams") if "bronze/teams" in load.tables else None
    if "standings" in good:
        # The place of a name in its feed is its order of mention.
        rows = stage(standing_rows(good["standings"]).withColumn("_seen", F.monotonically_increasing_id()), "standings")
        ids = stage(team_ids(rows.select("team_name", "source", "group_name", "_seen"), known, ["source", "_seen"]), "team-ids")
        teams = distinct_teams(rows, [F.col("source").asc(), F.col("_seen").asc()])
        tables["teams"] = teams.join(ids, "team_name").select("team_id", "team_name", "group_name", "team_logo")
        tables["group_standings"] = rows.drop("source", "_seen", "team_logo").join(ids, "team_name")
    else:
        ids = load.skip("bronze/teams").select("team_name", "team_id").distinct()
    if "scorers" in good and "assists" in good:
        tables["players"] = players(good["scorers"].drop("source"), good["assists"].drop("source"), ids)
    if "fixtures" in good:
        fixtures = stage(fixture_rows(good["fixtures"]).drop("source"), "fixtures")
        tables["matches"], tables["knockout_bracket"] = fixtures, bracket(spark, fixtures)
    if "stadiums" in good:
        tables["stadiums"] = venue_rows(good["stadiums"]).drop("source")
    bronze = {}
    for name in MINIMUM_ROWS:
        if name in tables:
            bronze[name] = load.write(f"bronze/{name}", tables[name].withColumn("ingested_at", moment), minimum.get(name, 0))
        else:
            bronze[name] = load.skip(f"bronze/{name}")
    if damaged:
        aside = damaged[0]
        for more in damaged[1:]:
            aside = aside.unionByName(more)
        load.check("bronze/quarantine", "damaged_parts", load.write("bronze/quarantine", aside), WARNING)
    load.stop_on_errors()
    return build_layers(load, bronze, as_of)
