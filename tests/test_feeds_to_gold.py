"""Landed JSON feeds to published marts in one run."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from matchmill.plans.landing import run_feeds, team_ids
from matchmill.sources.publication import GateError, read_published

NOW = dt.datetime(2026, 7, 6, 20)


def land(folder, goals, extra_team=False):
    def put(feed, name, payload):
        (folder / feed).mkdir(parents=True, exist_ok=True)
        (folder / feed / name).write_text(payload if isinstance(payload, str) else json.dumps(payload))

    def player(slug, team, g, a):
        return {"player_slug": slug, "player": slug.title(), "player_logo": None, "team": team, "goals": g, "assists": a, "matches": 2, "minutes": 180, "rating": 1400}

    put("scorers", "a.json", {"scorers": [player("player-ana", "Peru", goals, 0), player("player-bo", "Chad", 1, 2), {"player_slug": None, "goals": 1}]})
    put("scorers", "cut.json", json.dumps({"scorers": [player("player-x", "Peru", 1, 1)]})[:-9])
    put("assists", "a.json", {"scorers": [player("player-ana", "Peru", 0, 3), player("player-cy", "Peru", 5, 1)]})
    rows = [{"team": t, "team_logo": t.lower(), "p": 1, "w": 1, "d": 0, "l": 0, "gf": 2, "ga": 1, "gd": 1, "pts": p} for t, p in (("Peru", 3), ("Chad", 0))]
    put("standings", "a.json", {"tables": [{"group": "A", "rows": rows}, {"group": "B", "rows": [{**rows[0], "team": "Zaire"}, *([{**rows[0], "team": "Andorra"}] if extra_team else [])]}]})

    def game(i, kind, home, away, hs, as_, finished, label=None, pens=(None, None)):
        return {"id": i, "home_team_id": "1" if home else "0", "away_team_id": "2" if away else "null", "home_team_name_en": home, "away_team_name_en": away, "home_score": hs, "away_score": as_,
                "home_scorers": "{\"Ana 9'\"}" if hs == "1" else "null", "away_scorers": "null", "home_penalty_score": pens[0], "away_penalty_score": pens[1], "home_penalty_scorers": "", "away_penalty_scorers": "",
                "home_penalty_misses": "", "away_penalty_misses": "", "group": "A", "matchday": "1", "type": kind, "local_date": "07/01/2026 12:00", "stadium_id": "16", "finished": finished,
                "time_elapsed": "", "home_team_label": label and label[0], "away_team_label": label and label[1]}

    put("fixtures", "a.json", {"games": [
        game("1", "group", "Peru", "Chad", "1", "0", "TRUE"), game("74", "r32", "Peru", "Chad", "1", "1", "TRUE", pens=("4", "3")), game("77", "r32", "Zaire", "Chad", "0", "2", "TRUE"),
        game("89", "r16", None, None, "x", "", "FALSE", ("Winner Match 77", "Winner Match 74"))]})
    put("stadiums", "a.json", {"stadiums": [{"id": "16", "name_en": "West", "fifa_name": "West Ground", "city_en": "LA", "capacity": "unknown"}]})


def test_feeds_to_gold(spark, tmp_path, rows):
    out, as_of = str(tmp_path / "lake"), F.lit(NOW).cast("timestamp_ntz")
    land(tmp_path / "one", 2)
    with pytest.raises(GateError, match="bronze/players missing_rows: 47"):
        run_feeds(spark, str(tmp_path / "one"), out, as_of, "none")
    assert read_published(spark, out) == {}
    report = {(r.table, r.rule): r.failing for r in run_feeds(spark, str(tmp_path / "one"), out, as_of, "one", {})}
    assert report[("bronze/quarantine", "damaged_parts")] == 2
    got = read_published(spark, out)
    assert rows(got["bronze/teams"], "team_name", "team_id") == [("Chad", "team_2"), ("Peru", "team_1"), ("Zaire", "team_3")]
    assert rows(got["bronze/players"], "player_id", "team_id", "goals_scored", "assists") == [
        ("player-ana", "team_1", 2, 3), ("player-bo", "team_2", 1, 2), ("player-cy", "team_1", 0, 1)]
    cup = {r.match_id: r for r in got["bronze/knockout_bracket"].collect()}
    assert (cup["74"].bracket_position, cup["74"].feeds_into_position, cup["74"].winner_team, cup["74"].loser_team) == ("R32-3", "R16-2", "Peru", "Chad")
    assert (cup["77"].bracket_position, cup["77"].winner_team, cup["89"].bracket_position, cup["89"].winner_team) == ("R32-4", "Chad", "R16-2", None)
    schedule = {r.match_id: r for r in got["gold/schedule"].collect()}
    assert {schedule["89"].home_display, schedule["89"].away_display} == {"Peru", "Chad"} and schedule["1"].match_status == "Finished"
    assert {(r.player_name, r.goals_scored) for r in got["gold/leaderboard"].collect()} == {("Player-Ana", 2), ("Player-Bo", 1)}
    assert rows(got["bronze/quarantine"], "feed", "place", "reason") == [("scorers", "", "unreadable payload"), ("scorers", "2", "key missing")]
    moments = {t: got[f"bronze/{t}"].select("ingested_at").distinct().count() for t in ("teams", "matches", "players")}
    assert set(moments.values()) == {1}

    # A second run without fixtures: their tables stay, known teams keep their ids, a new one gets the next.
    land(tmp_path / "two", 3, extra_team=True)
    run_feeds(spark, str(tmp_path / "two"), out, as_of, "two", {}, skipped=["fixtures"])
    got = read_published(spark, out)
    assert rows(got["bronze/teams"], "team_name", "team_id") == [("Andorra", "team_4"), ("Chad", "team_2"), ("Peru", "team_1"), ("Zaire", "team_3")]
    history = rows(got["silver/player_stats_history"].filter("player_id = 'player-ana'"), "goals_scored", "is_current")
    assert history == [(2, False), (3, True)] and got["bronze/matches"].count() == 4


def test_ids_of_new_names_follow_those_of_old_ones(spark, rows):
    names = spark.createDataFrame([("b", 1), ("a", 2), ("c", 0)], "team_name string, seen long")
    known = spark.createDataFrame([("a", "team_7"), (None, "team_9")], "team_name string, team_id string")
    assert rows(team_ids(names, known, ["seen"])) == [("a", "team_7"), ("b", "team_9"), ("c", "team_8")]
    assert rows(team_ids(names, None, ["seen"])) == [("a", "team_3"), ("b", "team_2"), ("c", "team_1")]
