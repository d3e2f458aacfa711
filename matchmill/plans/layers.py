"""The three layers end to end: landed (bronze) tables to cleaned (silver) tables to marts (gold).

Each table is a function of tables before it. ``run_layers`` stores every layer before the next one reads
it, so nothing upstream is computed twice, checks it, and publishes all layers together.

Landed tables: players, teams, matches, group_standings, stadiums, knockout_bracket. Times come in as
``match_date_local`` texts; ``as_of`` is the moment the marts describe.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.fixed_values import MINIMUM_ROWS, NAME_ALIASES, STAGES
from matchmill.functions.outcomes import winning_side
from matchmill.functions.text import canonical_name, is_true, lookup
from matchmill.functions.times import parse_local, to_utc
from matchmill.operators import quality
from matchmill.operators.asof import race, race_leaders
from matchmill.operators.dedup import dedup_latest, valid_keys
from matchmill.operators.events import parse_packed_events
from matchmill.operators.joins import lookup_join, role_join
from matchmill.operators.ranking import rank_rows
from matchmill.operators.scan import global_row_number
from matchmill.operators.shape import unified_facts
from matchmill.operators.sides import round_half_up
from matchmill.plans import marts, suites
from matchmill.plans.views import venue_zones
from matchmill.session import stage
from matchmill.sources.publication import WARNING, CheckResult, Load, Rule

PLAYER_MEASURES = ["goals_scored", "assists", "matches_played", "minutes_played"]
STANDING_MEASURES = ["matches_played", "wins", "draws", "losses", "goals_for", "goals_against", "goal_difference", "points"]
STANDING_GUARDS = ["matches_played", "wins", "draws", "losses", "goals_for", "goals_against", "points"]
BOARD_ORDER = [("goals_scored", True), ("assists", True), ("minutes_played", False)]
GROUP_ORDER = [("points", True), ("goal_difference", True), ("goals_for", True)]


def _latest(df: DataFrame, key: str) -> DataFrame:
    """Latest load per key; equal load times are told apart by the other columns."""
    others = [F.col(c).desc_nulls_last() for c in df.columns if c not in (key, "ingested_at")]
    return dedup_latest(df, [key], [F.col("ingested_at").desc_nulls_last(), *others])


def _names(df: DataFrame, columns: Mapping[str, str]) -> dict[str, Column]:
    return {new: canonical_name(F.col(old), NAME_ALIASES) for new, old in columns.items()}


def players(bronze: DataFrame) -> DataFrame:
    rows = _latest(valid_keys(bronze, "player_id"), "player_id")
    return rows.select("player_id", "player_name", "player_logo", "team_id", "team_name")


def teams(bronze: DataFrame) -> DataFrame:
    return _latest(bronze, "team_id").select("team_id", "team_name", "group_name", "team_logo")


def stadiums(bronze: DataFrame) -> DataFrame:
    return _latest(bronze, "stadium_id").select("stadium_id", F.col("fifa_name").alias("name"), F.col("city_en").alias("city"))


def standings(bronze: DataFrame) -> DataFrame:
    """Latest standings per team with the dense rank in the group."""
    typed = [F.col(c).cast("int").alias(c) for c in STANDING_MEASURES]
    rows = stage(_latest(bronze, "team_id").select("team_id", "team_name", "group_name", *typed), "standings")
    return rank_rows(rows, GROUP_ORDER, ["group_name"], dense="rank")


def matches(group_rows: DataFrame, bracket: DataFrame) -> DataFrame:
    """Group and knockout fixtures in one table; a draw has no winner and says so in ``result``."""
    group = group_rows.filter("match_type = 'group'").withColumn("is_finished", is_true(F.col("finished")))
    side = F.when(F.col("is_finished"), winning_side(F.col("home_score"), F.col("away_score")))
    group = group.withColumns(_names(group, {"home_team": "home_team_name", "away_team": "away_team_name"})).withColumn("_side", side)

    def pick(home: str, away: str, won: bool) -> Column:
        first, second = (home, away) if won else (away, home)
        return F.when(F.col("_side") == "home", F.col(first)).when(F.col("_side") == "away", F.col(second))

    shared = ["match_id", "home_team_id", "away_team_id", "home_team", "away_team", "home_score", "away_score", "home_scorers", "away_scorers"]
    tail = ["match_date_local", "stadium_id", "is_finished"]
    group = group.select(
        *shared, F.col("group").alias("group_name"), F.lit(STAGES["group"]).alias("stage"), F.col("local_date").alias("match_date_local"),
        *tail[1:], pick("home_team", "away_team", True).alias("winner"), pick("home_team_id", "away_team_id", True).alias("winner_id"),
        pick("home_team", "away_team", False).alias("loser"),
    )
    names = _names(bracket, {"home_team": "home_team", "away_team": "away_team", "winner": "winner_team", "loser": "loser_team"})
    codes = {code if code != "third" else "3rd": name for code, name in STAGES.items()}
    cup = bracket.withColumns(names).select(
        *shared, lookup(F.lower("round"), codes, F.col("round")).alias("stage"), *tail, "winner", F.col("winner_team_id").alias("winner_id"),
        "loser", "bracket_position", "feeds_into_position",
    )
    rows = unified_facts([group, cup])
    result = F.when(F.col("is_finished"), F.when(F.col("winner").isNull(), "Draw").otherwise("Decided"))
    return rows.withColumns({"is_knockout": F.col("stage") != STAGES["group"], "result": result})


def goal_events(fixtures: DataFrame, team_rows: DataFrame) -> DataFrame:
    """Events of both sides with the team's id, found by canonical name whatever ids the feed uses."""
    rows = parse_packed_events(fixtures, aliases=NAME_ALIASES, home="home_scorers", away="away_scorers")
    keyed = rows.withColumn("_name", F.upper("team"))
    ids = team_rows.select(F.upper(canonical_name(F.col("team_name"), NAME_ALIASES)).alias("_upper"), "team_id")
    one = dedup_latest(ids, ["_upper"], [F.col("team_id").asc()])
    return lookup_join(keyed, one, {"_name": "_upper"}, {"team_id": "team_id"}).drop("_name")


def player_snapshot(bronze: DataFrame) -> DataFrame:
    """Latest totals per player with the rating on a scale of 10."""
    rows = _latest(valid_keys(bronze, "player_id"), "player_id")
    per_match = F.col("rating") / F.nullif(F.col("matches_played"), F.lit(0).cast("long"))
    return rows.select(
        "player_id", *[F.col(c).cast("int").alias(c) for c in PLAYER_MEASURES], F.col("rating").cast("long").alias("rating_cumulative"),
        round_half_up(per_match / 100.0, 2).alias("rating_0_to_10"), F.col("ingested_at").alias("valid_from"),
    )


def standings_snapshot(bronze: DataFrame) -> DataFrame:
    rows = _latest(bronze, "team_id")
    return rows.select(
        "team_id", "team_name", "group_name", *[F.col(c).cast("int").alias(c) for c in STANDING_MEASURES], F.col("ingested_at").alias("valid_from")
    )


@dataclass(frozen=True)
class History:
    """A versioned table: where its snapshots come from and which columns are tracked and guarded."""

    source: str
    snapshot: Callable[[DataFrame], DataFrame]
    keys: list[str]
    track: list[str]
    guarded: list[str]


HISTORIES = {
    "player_stats_history": History(
        "players", player_snapshot, ["player_id"], [*PLAYER_MEASURES, "rating_cumulative", "rating_0_to_10"], PLAYER_MEASURES
    ),
    "group_standings_history": History(
        "group_standings", standings_snapshot, ["team_id"], ["team_name", "group_name", *STANDING_MEASURES], STANDING_GUARDS
    ),
}


def build_silver(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The silver tables that are replaced as a whole; the histories are loaded version by version."""
    team_rows = teams(bronze["teams"])
    fixtures = matches(bronze["matches"], bronze["knockout_bracket"])
    return {
        "players": players(bronze["players"]),
        "teams": team_rows,
        "stadiums": stadiums(bronze["stadiums"]),
        "group_standings": standings(bronze["group_standings"]),
        "matches": fixtures,
        "goal_events": goal_events(fixtures, team_rows),
    }


def _fixtures(silver: Mapping[str, DataFrame], venues: DataFrame) -> DataFrame:
    """Silver fixtures under the names the marts use, with the start in UTC as ``kickoff``."""
    rows = lookup_join(
        silver["matches"].withColumnRenamed("stadium_id", "venue_id"), venues, {"venue_id": "venue_id"}, {"_west": "hours_west"}
    )
    kickoff = to_utc(parse_local(F.col("match_date_local")), F.col("_west"))
    return rows.withColumns({"kickoff": kickoff, "local_text": F.col("match_date_local")}).drop("_west")


def schedule(silver: Mapping[str, DataFrame], fixtures: DataFrame, venues: DataFrame, as_of: Column) -> DataFrame:
    nodes = fixtures.filter("is_knockout").select(
        "match_id", F.col("bracket_position").alias("position"), F.col("feeds_into_position").alias("feeds_into"), "home_team", "away_team",
        "winner", "is_finished",
    )
    rows = marts.schedule_fact(fixtures, venues, as_of, silver["goal_events"], nodes)
    shown = {f"{s}_display": F.coalesce(f"{s}_display", f"{s}_team") for s in ("home", "away")}
    rows = rows.withColumns({**shown, "winner_display": F.col("winner")})
    rows = role_join(rows, silver["teams"], ["home", "away", "winner"], "team_name", {"logo": "team_logo"}, "_display")
    return lookup_join(rows, silver["stadiums"], {"venue_id": "stadium_id"}, {"stadium_name": "name"}).drop("winner_display", "home_scorers", "away_scorers")


def performance(silver: Mapping[str, DataFrame], fixtures: DataFrame) -> DataFrame:
    members = silver["teams"].select(F.col("team_name").alias("participant"), "group_name", F.col("team_logo").alias("logo"))
    group = silver["group_standings"].select(
        F.col("team_name").alias("participant"), F.col("rank").alias("rank_in_group"), F.col("matches_played").alias("group_played"),
        *[F.col(c).alias(f"group_{c}") for c in ("points", "wins", "draws", "losses", "goals_for", "goals_against")],
    )
    current = silver["player_stats_history"].filter("is_current").select("player_id", "assists")
    named = lookup_join(current, silver["players"], {"player_id": "player_id"}, {"provider": "player_name", "participant": "team_name"}, "inner")
    rows = stage(marts.participant_profile(members, fixtures, group, silver["goal_events"], named), "performance")
    order = [
        F.coalesce("group_points", F.lit(0)).desc(), F.col("goal_difference").desc(), F.col("goals_for").desc(), F.col("participant").asc(),
    ]
    return global_row_number(rows, order, "rank_overall")


def leaderboard(silver: Mapping[str, DataFrame], fixtures: DataFrame) -> DataFrame:
    current = silver["player_stats_history"].filter("is_current AND goals_scored > 0").drop("valid_from", "valid_to", "is_current")
    columns = {c: c for c in ("player_name", "player_logo", "team_id", "team_name")}
    named = lookup_join(current, silver["players"], {"player_id": "player_id"}, columns, "inner")
    favourites = marts.favourite_opponents(silver["goal_events"], fixtures)
    board = marts.leaderboard(named, BOARD_ORDER, PLAYER_MEASURES, "player_id", favourites=favourites, name="player_name", team="team_name")
    return lookup_join(board, silver["teams"], {"team_id": "team_id"}, {"team_logo": "team_logo"})


def leader_race(silver: Mapping[str, DataFrame], fixtures: DataFrame) -> DataFrame:
    history = silver["player_stats_history"]
    leaders = race_leaders(history.filter("is_current AND goals_scored > 0"), "player_id", BOARD_ORDER)
    points = fixtures.filter("is_finished").select("match_id", "kickoff").filter(F.col("kickoff").isNotNull())
    rows = race(points, history.join(leaders, "player_id", "left_semi"), "player_id", "match_id", "kickoff", "valid_from", BOARD_ORDER)
    columns = {c: c for c in ("player_name", "player_logo", "team_id", "team_name")}
    return lookup_join(rows, silver["players"], {"player_id": "player_id"}, columns)


def summary(silver: Mapping[str, DataFrame], fixtures: DataFrame) -> DataFrame:
    current = silver["player_stats_history"].filter("is_current")
    named = lookup_join(current, silver["players"], {"player_id": "player_id"}, {"player_name": "player_name"}, "inner")
    return marts.kpi_summary(fixtures, silver["goal_events"], named, BOARD_ORDER, "player_name", list(STAGES.values()))


def build_gold(silver: Mapping[str, DataFrame], as_of: Column) -> dict[str, DataFrame]:
    venues = venue_zones(silver["matches"].sparkSession)
    fixtures = stage(_fixtures(silver, venues), "fixtures")
    return {
        "schedule": schedule(silver, fixtures, venues, as_of),
        "performance": performance(silver, fixtures),
        "leaderboard": leaderboard(silver, fixtures),
        "race": leader_race(silver, fixtures),
        "team_events": marts.event_detail(silver["goal_events"], fixtures, venues),
        "summary": summary(silver, fixtures),
    }


def silver_rules() -> dict[str, dict[str, Rule]]:
    """Row rules of the silver tables, judged while they are written."""
    negative = (F.col("home_score") < 0) | (F.col("away_score") < 0)
    return {
        "players": {"missing_key": Rule(F.col("player_id").isNull())},
        "teams": {"missing_key": Rule(F.col("team_id").isNull()), "missing_name": Rule(F.col("team_name").isNull(), WARNING)},
        "matches": {"missing_key": Rule(F.col("match_id").isNull()), "negative_score": Rule(negative)},
        "goal_events": {"missing_actor": Rule(F.col("actor").isNull(), WARNING), "unknown_team": Rule(F.col("team_id").isNull(), WARNING)},
    }


def check_silver(load: Load, silver: Mapping[str, DataFrame], venues: DataFrame) -> None:
    """Checks over whole silver tables: keys occur once, and every venue has its hours."""
    for name, key in (("players", "player_id"), ("teams", "team_id"), ("matches", "match_id")):
        load.check(f"silver/{name}", "duplicate_key", quality.duplicates(silver[name], [key]))
    load.check("silver/matches", "unmapped_zone", quality.orphans(silver["matches"], venues, {"stadium_id": "venue_id"}), WARNING)


def check_gold(load: Load, gold: Mapping[str, DataFrame]) -> None:
    """The suites of the marts; their findings are warnings."""
    load.check("gold/schedule", "schedule_suite", suites.schedule_suite(gold["schedule"]), WARNING)
    load.check("gold/performance", "bracket_suite", suites.bracket_suite(gold["schedule"], gold["performance"]), WARNING)


def run_layers(
    spark: SparkSession, bronze_dir: str, out_dir: str, as_of: Column, load_id: str, minimum: Mapping[str, int] = MINIMUM_ROWS,
    skipped: Sequence[str] = (), ingested_at: Column | None = None,
) -> list[CheckResult]:
    """Read the landed tables, check them, build the silver and the gold tables, and publish all of them at one moment.

    Nothing that readers see changes before the end, and nothing at all if a check fails as an error; ``GateError`` then holds the
    report, which is returned otherwise. ``skipped`` names landed tables whose feed did not run: the last load's rows count. Landed rows
    without ``ingested_at`` get one moment for the whole run. ``load_id`` names the load. Of the histories only buckets with a change
    are written. Read the tables with ``read_published``, as ``gold/schedule`` for instance.
    """
    load, moment = Load(spark, out_dir, load_id), run_moment()
    bronze = {}
    for name in MINIMUM_ROWS:
        if name in skipped:
            bronze[name] = load.skip(f"bronze/{name}")
            continue
        rows = spark.read.parquet(f"{bronze_dir}/{name}")
        if "ingested_at" not in rows.columns:
            rows = rows.withColumn("ingested_at", moment if ingested_at is None else ingested_at)
        bronze[name] = load.write(f"bronze/{name}", rows, minimum.get(name, 0))
    return build_layers(load, bronze, as_of)


def run_moment() -> Column:
    """The moment of ingestion, one for all rows of a run."""
    return F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")


def build_layers(load: Load, bronze: Mapping[str, DataFrame], as_of: Column) -> list[CheckResult]:
    """Silver and gold from the bronze tables that a load has written, checked and published with them; returns the report."""
    spark = load.spark
    load.stop_on_errors()
    rules = silver_rules()
    silver = {name: load.write(f"silver/{name}", df, rules=rules.get(name)) for name, df in build_silver(bronze).items()}
    check_silver(load, silver, venue_zones(spark))
    load.stop_on_errors()
    for name, h in HISTORIES.items():
        silver[name] = load.history(f"silver/{name}", h.snapshot(bronze[h.source]), h.keys, h.track, h.guarded)
    gold = {name: load.write(f"gold/{name}", df) for name, df in build_gold(silver, as_of).items()}
    check_gold(load, gold)
    load.publish()
    return load.report
