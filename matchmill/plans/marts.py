"""Ready-made marts built from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchmill.functions.outcomes import is_shootout, result_for
from matchmill.functions.text import canonical_name, lookup, name_key
from matchmill.functions.times import hours_until, is_live, minutes_elapsed, parse_local, status_at, to_utc
from matchmill.fixed_values import STAGES
from matchmill.operators.dedup import top_rows
from matchmill.operators.events import event_icon, event_sequences, top_actor, top_actors
from matchmill.operators.joins import lookup_join
from matchmill.operators.ranking import gap_to_leader, percent_rank_table
from matchmill.operators.shape import stage_ordinal, unified_facts
from matchmill.operators.sides import participant_totals, round_half_up, unpivot_sides
from matchmill.operators.tree import half_by_suffix, resolve_tree
from matchmill.session import stage


def unify_fixtures(branches: dict[str, DataFrame], aliases: dict[str, str]) -> DataFrame:
    """Stack fixture branches by stage code, names canonical, stage spelt out, typed NULLs where a branch has no column."""
    named = []
    for code, branch in branches.items():
        names = {c: canonical_name(F.col(c), aliases) for c in branch.columns if c in ("home_team", "away_team", "winner", "loser")}
        named.append(branch.withColumns({**names, "stage": lookup(F.lit(code), STAGES, F.lit(code))}))
    return unified_facts(named)


def favourite_opponents(events: DataFrame, fixtures: DataFrame | None = None) -> DataFrame:
    """Per actor and team the opponent most events were scored against; ties go to the first name.

    The pairs are counted before the ranking. Events that carry their fixture's sides (``keep`` of the
    parser) need no join; others meet the fixtures once.
    """
    if fixtures is None:
        joined = events
    else:
        joined = events.select("match_id", "actor", "team", "is_home").join(fixtures.select("match_id", "home_team", "away_team"), "match_id")
    return favourites_of(opponent_pairs(joined))


def opponent_pairs(events: DataFrame, **measures: Column) -> DataFrame:
    """(actor, team, opponent, against) with the events of each, and further aggregates, of events that carry their fixture's sides."""
    opponent = F.when(F.col("is_home"), F.col("away_team")).otherwise(F.col("home_team"))
    return events.groupBy("actor", "team", opponent.alias("opponent")).agg(
        F.count(F.lit(1)).alias("against"), *[column.alias(name) for name, column in measures.items()])


def favourites_of(pairs: DataFrame) -> DataFrame:
    counts = pairs.select("actor", "team", "opponent", "against")
    return top_rows(counts, ["actor", "team"], [F.col("against").desc(), F.col("opponent").asc()])


def leaderboard(
    current: DataFrame, order: Sequence[tuple[str, bool]], measures: Sequence[str], entity: str, k: int = 10, top: int = 3,
    favourites: DataFrame | None = None, name: str = "actor", team: str = "team",
) -> DataFrame:
    """The first ``k`` entities with row rank, dense rank, percent ranks over everybody and the gap to the leader.

    Percent ranks look at all rows; the ranks themselves only ever concern the ``k`` rows kept, since the
    rows before them are kept too.
    """
    lead = order[0][0]
    current = stage(current, "leaderboard")  # read by each of the ranks
    sort = [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last() for c, d in order]
    best = stage(gap_to_leader(current, lead).orderBy(*sort, F.col(entity).asc()).limit(k), "best")
    # Only the values of k rows are looked up among the percent ranks.
    ranks = percent_rank_table(current, measures)
    columns = best.columns
    for m in measures:
        percentile = F.floor(F.col("_pct") + 0.5).cast("double").alias(f"{m}_percentile")
        table = ranks.filter(F.col("metric") == m).select(F.col("value").alias("_value"), percentile)
        best = table.join(F.broadcast(best), F.col("_value").eqNullSafe(F.col(m).cast("double"))).drop("_value")
    best = best.select(*columns, *[f"{m}_percentile" for m in measures])
    # k rows in one task.
    best = best.withColumns(
        {
            "row_rank": F.row_number().over(Window.orderBy(*sort, F.col(entity).asc())).cast("long"),
            "dense_rank": F.dense_rank().over(Window.orderBy(*sort)).cast("long"),
        }
    ).withColumn("is_top", F.col("dense_rank") <= top)
    if favourites is not None:
        keyed = best.withColumn("_name", name_key(F.col(name)))
        known = favourites.select(name_key(F.col("actor")).alias("_fav"), F.col("team").alias("_fav_team"), "opponent", "against")
        best = keyed.join(known, (F.col("_name") == F.col("_fav")) & (F.col(team) == F.col("_fav_team")), "left").drop("_name", "_fav", "_fav_team")
    return best


def schedule_fact(
    fixtures: DataFrame, venues: DataFrame, as_of: Column, events: DataFrame | None = None, tree: DataFrame | None = None, packed: bool = False
) -> DataFrame:
    """One row per fixture: UTC time, status, time until or since, display names, half, top actor of each side.

    Top actors come from ``events`` or, if ``packed``, from the texts ``home_events`` and ``away_events`` of the fixtures themselves, which go.
    """
    if packed:
        # Before any join, so that no join moves the texts.
        tops = {f"_{side[0]}": top_actor(F.col(f"{side}_events")) for side in ("home", "away")}
        fixtures = fixtures.withColumns(tops).drop("home_events", "away_events")
        fixtures = fixtures.withColumns({c: F.when(F.col(c).isNotNull(), F.struct(F.col(c)["actor"].alias("actor"), (-F.col(c)["fewer"]).alias("events"))) for c in tops})
    rows = lookup_join(
        fixtures, venues, {"venue_id": "venue_id"},
        {"city": "city", "country": "country", "hours_west": "hours_west"}, how="left",
    )
    rows = rows.withColumn("starts_utc", to_utc(parse_local(F.col("local_text")), F.col("hours_west")))
    start, finished = F.col("starts_utc"), F.col("is_finished")
    rows = rows.withColumns(
        {
            "match_status": status_at(start, finished, as_of),
            "hours_until": hours_until(start, as_of),
            "minutes_elapsed": minutes_elapsed(start, finished, as_of),
            "is_live": is_live(start, finished, as_of),
        }
    )
    if tree is not None:
        shown = resolve_tree(tree)
        rows = lookup_join(
            rows, shown, {"match_id": "match_id"},
            {c: c for c in ("position", "feeds_into", "home_display", "away_display")},
        ).withColumn("half", half_by_suffix(F.col("position")))
    if not packed and events is not None:
        best = top_actors(events)
        actor = F.struct("actor", "events")
        pair = best.groupBy("match_id").agg(
            F.max(F.when(F.col("is_home"), actor)).alias("_h"), F.max(F.when(~F.col("is_home"), actor)).alias("_a")
        )
        rows = lookup_join(rows, pair, {"match_id": "match_id"}, {"_h": "_h", "_a": "_a"})
    if packed or events is not None:
        rows = rows.withColumns(
            {
                "home_top_actor": F.col("_h.actor"), "home_top_events": F.col("_h.events"),
                "away_top_actor": F.col("_a.actor"), "away_top_events": F.col("_a.events"),
            }
        ).drop("_h", "_a")
    return rows


def open_items(schedule: DataFrame) -> DataFrame:
    """Live and upcoming fixtures whose sides are both known, soonest first."""
    known = F.col("home_team").isNotNull() & F.col("away_team").isNotNull()
    return schedule.filter(F.col("match_status").isin("Live", "Upcoming") & known).orderBy("starts_utc", "match_id")


def finished_items(fixtures: DataFrame) -> DataFrame:
    """Finished fixtures, newest first, with the shoot-out flag."""
    flag = is_shootout(F.col("is_knockout"), F.col("home_score"), F.col("away_score"), F.col("winner"))
    return fixtures.filter("is_finished").withColumn("shootout", flag).orderBy(F.col("kickoff").desc(), F.col("match_id").desc())


def qualification(group_rank: Column, group_played: Column, played: Column, through: int = 2, group_games: int = 3, parity: bool = False) -> Column:
    """Qualified, Disqualified, Not Started or In Progress.

    A participant that has played beyond its group has qualified. ``parity`` asks the group rank first.
    """
    advanced = F.coalesce(played > group_games, F.lit(False))
    out = (group_rank > through) & (group_played == group_games)
    status = F.when(group_rank <= through, "Qualified")
    status = status.when(out, "Disqualified").when(advanced, "Qualified") if parity else status.when(advanced, "Qualified").when(out, "Disqualified")
    return status.when(played.isNull(), "Not Started").otherwise("In Progress")


def profile_totals(fixtures: DataFrame) -> DataFrame:
    """Totals and the latest stage of each participant, from one pass over both sides of the fixtures."""
    return participant_totals(fixtures, latest={"current_stage": "stage"})


def participant_profile(
    teams: DataFrame, fixtures: DataFrame | None, group_ranks: DataFrame, events: DataFrame, assists: DataFrame, parity: bool = False,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Everything about a participant: totals, group rank, latest stage, top scorer and top assister.

    ``teams`` has participant and group_name; ``group_ranks`` participant, rank_in_group, group_played and any more
    columns of the group stage; ``events`` team and actor; ``assists`` participant, provider and assists. ``totals`` may give what
    ``profile_totals`` makes of the fixtures.
    """
    totals = profile_totals(fixtures) if totals is None else totals
    scorers = events.groupBy("team", "actor").agg(F.count(F.lit(1)).alias("n"))
    scorers = top_rows(scorers, ["team"], [F.col("n").desc(), F.col("actor").asc()])
    helpers = top_rows(assists, ["participant"], [F.col("assists").desc(), F.col("provider").asc()])
    key = {"participant": "participant"}
    rows = lookup_join(teams, totals, key, {c: c for c in totals.columns if c != "participant"})
    rows = lookup_join(rows, group_ranks, key, {c: c for c in group_ranks.columns if c != "participant"})
    rows = lookup_join(rows, scorers, {"participant": "team"}, {"top_scorer": "actor", "top_scorer_events": "n"})
    rows = lookup_join(rows, helpers, key, {"top_assister": "provider", "top_assists": "assists"})
    status = qualification(F.col("rank_in_group"), F.col("group_played"), F.col("played"), parity=parity)
    zero = [c for c in totals.columns if c not in ("participant", "current_stage")]
    rows = rows.withColumn("qualification", status)
    return rows.withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in zero},
            "current_stage": F.coalesce("current_stage", F.lit(STAGES["group"])),
        }
    )


FIXTURE_FACTS = ["home_team", "away_team", "home_score", "away_score", "stage", "kickoff", "venue_id"]


def event_detail(events: DataFrame, fixtures: DataFrame | None, venues: DataFrame, overall: bool = True) -> DataFrame:
    """Events with opponent, result, venue, icon and both sequence numbers (the first alone without ``overall``), for finished fixtures.

    Events parsed from finished fixtures with ``keep=FIXTURE_FACTS`` carry all they need: pass no fixtures. Those of ``numbered_events`` have the
    first number already.
    """
    rows = events if fixtures is None else events.join(fixtures.filter("is_finished").select("match_id", *FIXTURE_FACTS), "match_id")
    rows = lookup_join(rows, venues, {"venue_id": "venue_id"}, {"city": "city", "country": "country"}, how="left")
    home = F.col("is_home")
    mine = F.when(home, F.col("home_score")).otherwise(F.col("away_score"))
    theirs = F.when(home, F.col("away_score")).otherwise(F.col("home_score"))
    rows = rows.withColumns(
        {
            "opponent": F.when(home, F.col("away_team")).otherwise(F.col("home_team")),
            "result": result_for(mine, theirs),
            "icon": event_icon(F.col("is_penalty")),
        }
    )
    return rows if not overall and "number_in_match" in rows.columns else event_sequences(rows, overall=overall)


def kpi_summary(
    fixtures: DataFrame, events: DataFrame, current: DataFrame, order: Sequence[tuple[str, bool]], name: str, stages: Sequence[str],
    latest: bool = True,
) -> DataFrame:
    """One row of headline numbers.

    Each part is a one-row aggregate; stacking and folding them needs no join. The current stage is the
    latest (or the earliest) one with an open fixture.
    """
    is_open = ~F.col("is_finished")
    once = F.col("is_home")
    place = F.when(is_open, stage_ordinal(F.col("stage"), stages))
    games = unpivot_sides(fixtures, keep=["stage", "is_finished"]).agg(
        F.count_if(once).alias("total_matches"),
        F.count_if(once & F.col("is_finished")).alias("completed_matches"),
        F.count_if(once & is_open).alias("remaining_matches"),
        F.countDistinct(F.when(is_open, F.col("participant"))).alias("participants_left"),
        (F.max(place) if latest else F.min(place)).alias("_place"),
    ).withColumn("current_stage", F.try_element_at(F.array(*[F.lit(s) for s in stages]), F.col("_place").cast("int"))).drop("_place")
    goals = events.agg(F.count(F.lit(1)).alias("total_events"), F.count_if("is_penalty").alias("penalties"))
    sort = [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last() for c, d in order]
    leader = current.orderBy(*sort, F.col(name).asc()).limit(1).select(
        F.col(name).alias("leader"), F.col(order[0][0]).alias("leader_value")
    )
    parts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [games, goals, leader])
    folded = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    average = F.col("total_events") / F.nullif(F.col("completed_matches"), F.lit(0).cast("long"))
    return folded.withColumn("events_per_match", round_half_up(average, 2))
