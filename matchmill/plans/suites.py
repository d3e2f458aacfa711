"""The check suites of the marts: one report each, empty when the mart is complete.

Row rules of a mart share one scan. ``logo`` columns are optional pictures of a participant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill.fixed_values import MEDALS
from matchmill.functions.text import lookup
from matchmill.operators import quality
from matchmill.operators.quality import Check, RowRules, run_checks
from matchmill.operators.ranking import rank_rows
from matchmill.session import stage

STATUSES = ["Finished", "Live", "Upcoming"]


def known_name(column: str) -> Column:
    """A real name: not NULL, not TBD, no ``Winner of`` placeholder."""
    name = F.col(column)
    return F.coalesce((name != "TBD") & ~name.startswith("Winner of"), F.lit(False))


def _logo_missing(*sides: str) -> Column:
    missing = F.lit(False)
    for side in sides:
        missing = missing | (known_name(f"{side}_display") & F.col(f"{side}_logo").isNull())
    return missing


def bracket_suite(schedule: DataFrame, standing: DataFrame) -> DataFrame:
    """Knockout fixtures: logos, UTC time, venue, a winner once finished, and totals for every named side."""
    rows = schedule.filter("is_knockout")
    label = F.col("match_id").cast("string")
    rules = {
        "missing_logo": (_logo_missing("home", "away"), label),
        "missing_utc_time": (F.col("starts_utc").isNull(), label),
        "missing_venue": (F.col("city").isNull(), label),
        "missing_winner": (F.col("is_finished") & F.col("winner").isNull(), label),
    }

    def without_totals() -> DataFrame:
        names = rows.select(F.explode(F.array_distinct(F.array("home_display", "away_display"))).alias("participant"))
        return quality.orphans(names.filter(known_name("participant")).distinct(), standing, {"participant": "participant"})

    return run_checks([RowRules(rows, rules), Check("missing_team_stats", without_totals, F.col("participant"))])


def leaderboard_suite(board: DataFrame, entity: str, percentiles: list[str], stats: list[str], images_allowed: int = 2, most: int = 10) -> DataFrame:
    """A board of 1 to ``most`` rows, few missing pictures, percent ranks in range, full stats, ranks without gaps."""
    label = F.col(entity).cast("string")
    off = F.lit(False)
    for column in percentiles:
        off = off | F.col(column).isNull() | ~F.col(column).between(0, 100)
    empty = F.lit(False)
    for column in stats:
        empty = empty | F.col(column).isNull()

    def gaps() -> DataFrame:
        shape = board.agg(F.count(F.lit(1)).alias("n"), F.max("row_rank").alias("top"), F.countDistinct("row_rank").alias("ranks"))
        return shape.filter("top <> n OR ranks <> n")

    return run_checks(
        [
            Check("row_budget", lambda: quality.row_count_outside(board, 1, most), F.col("rows")),
            Check("images_missing", lambda: quality.over_budget(board, F.col("logo").isNull(), images_allowed), F.col("failing")),
            RowRules(board, {"percentile_off": (off, label), "stats_missing": (empty, label)}),
            Check("rank_gap", gaps, F.concat_ws("/", "top", "ranks", "n")),
        ]
    )


def schedule_suite(schedule: DataFrame) -> DataFrame:
    """Open fixtures: logos of known sides, both times, venue, flag and status in agreement, known status."""
    label = F.col("match_id").cast("string")
    status = F.col("match_status")
    is_open = status.isin("Live", "Upcoming")
    rules = {
        "missing_logo": (is_open & _logo_missing("home", "away"), label),
        "missing_utc_time": (F.col("starts_utc").isNull(), label),
        "missing_local_time": (F.col("local_text").isNull(), label),
        "missing_venue": (F.col("city").isNull(), label),
        "live_flag_off": (~F.col("is_live").eqNullSafe(status == "Live"), label),
        # Overdue fixtures count as finished although they are still being timed.
        "overdue": ((status == "Finished") & F.col("minutes_elapsed").isNotNull(), label),
        "unknown_status": (F.coalesce(~status.isin(*STATUSES), F.lit(True)), F.coalesce(status, F.lit("none"))),
    }
    return run_checks([RowRules(schedule, rules)])


def performance_suite(profile: DataFrame, detail: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Profiles with logo and totals; event details complete; no event without its fixture.

    The events are read once: both of their checks see a row per fixture and team.
    """
    who = F.col("participant")
    totals = F.lit(False)
    for column in ("played", "goals_for", "goals_against", "points"):
        totals = totals | F.col(column).isNull()
    gaps = F.col("actor").isNull() | (F.trim("actor") == "") | F.col("minute_base").isNull() | F.col("opponent").isNull()
    sides = detail.groupBy("match_id", "team").agg(F.count(F.lit(1)).alias("events"), F.count_if(gaps).alias("gaps"))
    sides = stage(sides, "events-per-side")
    return run_checks(
        [
            RowRules(profile, {"missing_logo": (F.col("logo").isNull(), who), "missing_stats": (totals, who)}),
            Check("incomplete_event", lambda: sides.filter("gaps > 0"), F.col("team"), "gaps"),
            Check("orphaned_event", lambda: quality.orphans(sides, fixtures, {"match_id": "match_id"}), F.col("match_id"), "events"),
        ]
    )


def points_suite(table: DataFrame) -> DataFrame:
    """A points table whose columns agree with each other and whose group ranks are the dense ranks they should be."""
    who = F.col("participant")
    rules = {
        "missing_group": (F.col("group_name").isNull(), who),
        "missing_logo": (F.col("logo").isNull(), who),
        "points_off": (F.col("points") != F.col("wins") * 3 + F.col("draws"), who),
        "difference_off": (F.col("goal_difference") != F.col("goals_for") - F.col("goals_against"), who),
        "played_off": (F.col("played") != F.col("wins") + F.col("draws") + F.col("losses"), who),
    }

    def ranks() -> DataFrame:
        order = [("points", True), ("goal_difference", True), ("goals_for", True)]
        expected = rank_rows(table, order, ["group_name"], dense="_expected")
        return expected.filter(~F.col("rank_in_group").eqNullSafe(F.col("_expected")))

    return run_checks([RowRules(table, rules), Check("rank_off", ranks, who)])


def race_suite(race: DataFrame, entity: str, values: list[str], k: int = 3, images_allowed: int = 3) -> DataFrame:
    """A race whose ranks, medals, flags and cumulative values hold together."""
    label = F.col(entity).cast("string")
    rank = F.col("rank_at_step")
    negative = F.lit(False)
    for column in values:
        negative = negative | (F.col(column) < 0)
    last = race.agg(F.max("step")).scalar()
    rules = {
        "rank_outside": (~rank.between(1, k), label),
        "medal_off": (~F.col("medal").eqNullSafe(lookup(rank.cast("int"), MEDALS)), label),
        "negative_value": (negative, label),
        "flag_off": (F.col("is_latest") != (F.col("step") == last), label),
    }

    def falls() -> DataFrame:
        return quality.falling(race, entity, ["step"], values[:2], F.floor(F.col("step") / 1000))

    return run_checks(
        [
            RowRules(race, rules),
            Check("images_missing", lambda: quality.over_budget(race.select(entity, "logo").distinct(), F.col("logo").isNull(), images_allowed), F.col("failing")),
            Check("no_latest", lambda: race.agg(F.count_if("is_latest").alias("flagged")).filter("flagged = 0"), "none flagged"),
            Check("value_falls", falls, label),
        ]
    )
