"""The three layers on a small invented tournament, two loads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchmill.plans import layers
from matchmill.sources.publication import GateError, read_published

LOAD1, LOAD2 = dt.datetime(2026, 7, 1, 23), dt.datetime(2026, 7, 5, 23)
NOW = dt.datetime(2026, 7, 6, 20)


def land(spark, folder, load, extra):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}")

    put("teams", [("t1", "Turkiye", "A", "l1", load), ("t2", "Peru", "A", "l2", load), ("t3", "Chad", "B", None, load), ("t3", "Old", "B", None, LOAD1 - dt.timedelta(days=1))],
        "team_id string, team_name string, group_name string, team_logo string, ingested_at timestamp_ntz")
    put("stadiums", [("16", "x", "y", "West Ground", "LA", "US", 5, load), ("1", "x", "y", "South Ground", "MX", "MX", 5, load)],
        "stadium_id string, name_en string, name_fa string, fifa_name string, city_en string, country_en string, capacity long, ingested_at timestamp_ntz")
    goals = 3 if extra else 2
    put("players", [("player-a", "Ana", "p", "t1", "Turkiye", goals, 1, 2, 180, 1400, load), ("player-b", "Bo", None, "t2", "Peru", 1, 4 if not extra else 2, 2, 90, 900, load), ("null", "no", None, None, None, 1, 1, 1, 1, 1, load)],
        "player_id string, player_name string, player_logo string, team_id string, team_name string, goals_scored long, assists long, matches_played long, minutes_played long, rating long, ingested_at timestamp_ntz")
    put("group_standings", [("t1", "Turkiye", "A", 1, 1, 0, 0, 2, 1, 1, 3, load), ("t2", "Peru", "A", 1, 0, 0, 1, 1, 2, -1, 0, load), ("t3", "Chad", "B", 0, 0, 0, 0, 0, 0, 0, 0, load)],
        "team_id string, team_name string, group_name string, matches_played long, wins long, draws long, losses long, goals_for long, goals_against long, goal_difference long, points long, ingested_at timestamp_ntz")
    put("matches", [("1", "13", "14", "Turkey", "Peru", 2, 1, """{"Ana 9'","Ana 90+1'(p)"}""", """{"Bo 110'"}""", "A", "group", "07/01/2026 12:00", "16", "TRUE"),
                    ("2", "13", "15", "Turkey", "Chad", 0, 0, "null", None, "A", "group", "07/06/2026 12:00", "16", "FALSE"),
                    ("9", "1", "2", "X", "Y", 0, 0, None, None, None, "r16", "07/07/2026 12:00", "1", "FALSE")],
        "match_id string, home_team_id string, away_team_id string, home_team_name string, away_team_name string, home_score long, away_score long, home_scorers string, away_scorers string, `group` string, match_type string, local_date string, stadium_id string, finished string")
    done = extra
    put("knockout_bracket", [
        ("101", "SF", "SF-1", "Final", "Turkey", "Peru", "13", "14", 1, 1, """{"Ana 5'"}""", """{"Bo 6'"}""", "Turkey" if done else None, "13" if done else None, "Peru" if done else None, "07/04/2026 18:00 CST", "1", done),
        ("102", "SF", "SF-2", "Final", "Chad", None, "15", None, None, None, None, None, None, None, None, "07/08/2026 18:00 CST", "1", False),
        ("104", "Final", "Final", None, None, None, None, None, None, None, None, None, None, None, None, "07/12/2026 18:00 CST", "1", False)],
        "match_id string, round string, bracket_position string, feeds_into_position string, home_team string, away_team string, home_team_id string, away_team_id string, home_score long, away_score long, home_scorers string, away_scorers string, winner_team string, winner_team_id string, loser_team string, match_date_local string, stadium_id string, is_finished boolean")


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("lake"))
    as_of = F.lit(NOW).cast("timestamp_ntz")
    for n, load in enumerate((LOAD1, LOAD2)):
        landed = str(tmp_path_factory.mktemp("landed"))
        land(spark, landed, load, n > 0)
        layers.run_layers(spark, landed, out, as_of, f"load-{n}", {})

    def table(name):
        return read_published(spark, out, name)[name]

    return table


def test_history_over_two_loads(gold):
    got = {(r.player_id, r.goals_scored, r.assists, r.valid_from, r.valid_to, r.is_current) for r in gold("silver/player_stats_history").collect()}
    assert got == {
        ("player-a", 2, 1, LOAD1, LOAD2, False), ("player-a", 3, 1, LOAD2, None, True), ("player-b", 1, 4, LOAD1, None, True),
    }


def test_silver_names_ids_and_ranks(gold):
    events = {(r.match_id, r.team, r.team_id, r.actor, r.minute_base, r.stoppage) for r in gold("silver/goal_events").collect()}
    assert events == {
        ("1", "Turkiye", "t1", "Ana", 9, None), ("1", "Turkiye", "t1", "Ana", 90, 1), ("1", "Peru", "t2", "Bo", 110, None),
        ("101", "Turkiye", "t1", "Ana", 5, None), ("101", "Peru", "t2", "Bo", 6, None),
    }
    assert {(r.team_name, r.rank) for r in gold("silver/group_standings").collect()} == {("Turkiye", 1), ("Peru", 2), ("Chad", 1)}
    assert {(r.match_id, r.stage, r.winner, r.is_knockout) for r in gold("silver/matches").collect()} == {
        ("1", "Group Stage", "Turkiye", False), ("2", "Group Stage", None, False), ("101", "Semi Final", "Turkiye", True),
        ("102", "Semi Final", None, True), ("104", "Final", None, True),
    }


def test_schedule(gold):
    got = {r.match_id: r for r in gold("gold/schedule").collect()}
    assert got["1"].starts_utc == dt.datetime(2026, 7, 1, 19) and got["1"].match_status == "Finished"
    assert (got["2"].match_status, got["2"].is_live, got["2"].minutes_elapsed) == ("Live", True, 60.0)
    assert (got["104"].home_display, got["104"].away_display, got["104"].home_logo) == ("Turkiye", "Winner of SF-2", "l1")
    assert (got["1"].home_top_actor, got["1"].home_top_events, got["1"].away_top_actor) == ("Ana", 2, "Bo")
    assert got["101"].half == "Top" and got["101"].stadium_name == "South Ground" and got["101"].winner_logo == "l1"


def test_performance(gold):
    got = {r.participant: r for r in gold("gold/performance").collect()}
    t = got["Turkiye"]
    assert (t.played, t.wins, t.draws, t.goals_for, t.rank_overall, t.current_stage, t.top_scorer, t.top_scorer_events) == (2, 1, 1, 3, 1, "Semi Final", "Ana", 3)
    assert (got["Peru"].top_assister, got["Peru"].top_assists) == ("Bo", 4) and got["Chad"].qualification == "Qualified" and got["Chad"].played == 0


def test_leaderboard_race_and_summary(gold):
    board = {r.player_name: r for r in gold("gold/leaderboard").collect()}
    assert (board["Ana"].row_rank, board["Ana"].opponent, board["Ana"].against, board["Ana"].goals_scored_percentile) == (1, "Peru", 3, 100.0)
    assert (board["Bo"].behind_leader, board["Bo"].is_top, board["Bo"].team_logo) == (2, True, "l2")
    race = {(r.match_id, r.player_name): (r.goals_scored, r.rank_at_step, r.medal, r.is_latest) for r in gold("gold/race").collect()}
    assert race == {
        ("1", "Ana"): (2, 1, "🥇", False), ("1", "Bo"): (1, 2, "🥈", False), ("101", "Ana"): (3, 1, "🥇", True), ("101", "Bo"): (1, 2, "🥈", True),
    }
    s = gold("gold/summary").first()
    assert (s.total_matches, s.completed_matches, s.total_events, s.penalties, s.current_stage, s.leader) == (5, 2, 5, 1, "Final", "Ana")


def test_small_load_changes_nothing(spark, tmp_path):
    land(spark, str(tmp_path / "in"), LOAD1, False)
    with pytest.raises(GateError, match="bronze/players missing_rows: 47"):
        layers.run_layers(spark, str(tmp_path / "in"), str(tmp_path / "out"), F.lit(NOW), "load-0")
    assert read_published(spark, str(tmp_path / "out")) == {}


def test_an_error_after_silver_keeps_the_gold_tables_and_a_skipped_feed_keeps_its_rows(spark, tmp_path, rows):
    out, as_of = str(tmp_path / "out"), F.lit(NOW).cast("timestamp_ntz")
    land(spark, str(tmp_path / "one"), LOAD1, False)
    report = layers.run_layers(spark, str(tmp_path / "one"), out, as_of, "one", {})
    assert {r.rule for r in report} >= {"missing_key", "duplicate_key", "unmapped_zone", "schedule_suite"} and all(r.ok for r in report if r.severity == "error")
    before = rows(read_published(spark, out, "gold/schedule")["gold/schedule"], "match_id", "match_status")
    land(spark, str(tmp_path / "two"), LOAD2, True)
    wrong = spark.read.parquet(str(tmp_path / "two" / "matches")).withColumn("home_score", F.lit(-1).cast("long"))
    wrong.write.parquet(str(tmp_path / "wrong"))
    spark.read.parquet(str(tmp_path / "wrong")).write.mode("overwrite").parquet(str(tmp_path / "two" / "matches"))
    with pytest.raises(GateError, match="negative_score"):
        layers.run_layers(spark, str(tmp_path / "two"), out, as_of, "two", {})
    assert rows(read_published(spark, out, "gold/schedule")["gold/schedule"], "match_id", "match_status") == before
    assert read_published(spark, out, "silver/player_stats_history")["silver/player_stats_history"].count() == 2
    layers.run_layers(spark, str(tmp_path / "two"), out, as_of, "three", {}, skipped=["matches"])
    got = read_published(spark, out)
    assert got["bronze/matches"].count() == 3 and got["silver/player_stats_history"].count() == 3
    assert rows(read_published(spark, out, "gold/schedule", number=1)["gold/schedule"], "match_id", "match_status") == before
    # The landed fixtures name no time of their ingestion: the run's is one for all rows.
    assert got["bronze/matches"].select("ingested_at").distinct().count() == 1
