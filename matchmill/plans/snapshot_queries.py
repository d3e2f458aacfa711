"""Queries over cumulative snapshots: history, as-of states, races, percent ranks, leaderboard."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from matchmill.operators.asof import asof_snapshot, current_leaders, forward_fill, path_signature, race, race_leaders
from matchmill.operators.history import close_current, detect_changes, first_load, retention_prune, scd2_apply, scd2_asof
from matchmill.operators.joins import lookup_join
from matchmill.operators.ranking import percent_ranks, top_with_ties
from matchmill.plans import marts
from matchmill.operators.scan import ordered_scan
from matchmill.plans.registry import query
from matchmill.session import app_dir, stage
from matchmill.sources.sinks import load_history, read_history
from matchmill.plans.views import (
    CHECKPOINTS_SQL, EVENTS_SQL, MEASURES, RACE_ORDER, SNAPSHOTS_SQL, T1, T2, activity, checkpoints, load, moment,
    packed_events, running, snapshots, state_at, state_sql,
)
from matchmill.operators.events import parse_packed_events

LOADED = {"keys": ["user_id"], "track": MEASURES, "monotone": MEASURES}
VERSION = ["user_id", *MEASURES, "valid_from", "valid_to", "is_current"]


def _loads(spark, sf):
    """Two loads: totals at T1 and at T2. Every ninth user's second load has regressed, every tenth is unchanged."""
    first = state_at(spark, sf, T1).withColumn("valid_from", moment(T1)).drop("seen_at")
    second = state_at(spark, sf, T2).withColumn("valid_from", moment(T2)).drop("seen_at")
    held = lookup_join(second, first, {"user_id": "user_id"}, {f"was_{m}": m for m in MEASURES})
    user = F.col("user_id")
    second = held.select(
        "user_id",
        *[
            F.when((user % 9 == 0) & F.col(f"was_{m}").isNotNull(), F.col(f"was_{m}") - 1)
            .when((user % 10 == 0) & F.col(f"was_{m}").isNotNull(), F.col(f"was_{m}")).otherwise(F.col(m)).alias(m)
            for m in MEASURES
        ],
        "valid_from",
    )
    return first, second


def _history(spark, sf):
    first, second = _loads(spark, sf)
    return first_load(first, ["user_id"], MEASURES, "valid_from"), second


LOADS_SQL = f"""{state_sql("s1", T1)}, {state_sql("s2", T2)},
l2 AS (
  SELECT s2.user_id, {", ".join(
      f"CASE WHEN s2.user_id % 9 = 0 AND s1.{m} IS NOT NULL THEN s1.{m} - 1 "
      f"WHEN s2.user_id % 10 = 0 AND s1.{m} IS NOT NULL THEN s1.{m} ELSE s2.{m} END AS {m}" for m in MEASURES)}
  FROM s2 LEFT JOIN s1 ON s1.user_id = s2.user_id),
judged AS (
  SELECT l2.*, s1.user_id IS NULL AS fresh,
    {" OR ".join(f"l2.{m} <> s1.{m}" for m in MEASURES)} AS differs, {" OR ".join(f"l2.{m} < s1.{m}" for m in MEASURES)} AS fell
  FROM l2 LEFT JOIN s1 ON s1.user_id = l2.user_id),
hist AS (
  SELECT s1.user_id, {", ".join(f"s1.{m}" for m in MEASURES)}, TIMESTAMP '{T1}' AS valid_from,
    CASE WHEN j.differs AND NOT j.fell THEN TIMESTAMP '{T2}' END AS valid_to, NOT coalesce(j.differs AND NOT j.fell, FALSE) AS is_current
  FROM s1 LEFT JOIN judged j ON j.user_id = s1.user_id
  UNION ALL
  SELECT user_id, {", ".join(MEASURES)}, TIMESTAMP '{T2}', NULL, TRUE FROM judged WHERE fresh OR (differs AND NOT fell))"""


@query("scd2_initial", f"WITH {state_sql('s1', T1)} SELECT user_id, {', '.join(MEASURES)}, TIMESTAMP '{T1}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM s1")
def _(spark, sf):
    return scd2_apply(None, _loads(spark, sf)[0], **LOADED)


@query("change_detect", f"""WITH {LOADS_SQL} SELECT user_id, {', '.join(MEASURES)},
  CASE WHEN fresh THEN 'new' WHEN NOT differs THEN 'same' WHEN fell THEN 'regressed' ELSE 'changed' END AS event FROM judged""")
def _(spark, sf):
    history, second = _history(spark, sf)
    return detect_changes(history, second, valid_from="valid_from", **LOADED).drop("valid_from")


@query("scd2_incremental", f"WITH {LOADS_SQL} SELECT {', '.join(VERSION)} FROM hist")
def _(spark, sf):
    history, second = _history(spark, sf)
    return scd2_apply(history, second, **LOADED)


@query("scd2_table", f"WITH {LOADS_SQL} SELECT {', '.join(VERSION)} FROM hist")
def _(spark, sf):
    """The same through a stored table, whose open versions alone are rewritten."""
    path = f"{app_dir(spark)}/history-{uuid.uuid4().hex}"
    for n, snapshot in enumerate(_loads(spark, sf)):
        load_history(spark, path, snapshot, ["user_id"], MEASURES, MEASURES, f"load-{n}", exists=n > 0)
    return read_history(spark, path).select(*VERSION)


@query("scd2_close", f"WITH {LOADS_SQL} SELECT {', '.join(VERSION)} FROM hist WHERE valid_from = TIMESTAMP '{T1}'")
def _(spark, sf):
    history, second = _history(spark, sf)
    changes = detect_changes(history, second, valid_from="valid_from", **LOADED).filter("event = 'changed'")
    return close_current(history, ["user_id"], changes, "valid_from")


@query("scd2_asof", f"""WITH {LOADS_SQL} SELECT 'before' AS moment, user_id, goals FROM hist WHERE valid_from <= TIMESTAMP '2024-01-20' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-20')
  UNION ALL SELECT 'after', user_id, goals FROM hist WHERE valid_from <= TIMESTAMP '{T2}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{T2}')""")
def _(spark, sf):
    history, second = _history(spark, sf)
    versions = scd2_apply(history, second, **LOADED)
    times = {"before": "2024-01-20 00:00:00", "after": T2}
    parts = [scd2_asof(versions, moment(t)).select(F.lit(n).alias("moment"), "user_id", "goals") for n, t in times.items()]
    return parts[0].unionByName(parts[1])


@query("retention_prune", f"""WITH {LOADS_SQL} SELECT 'early' AS run, user_id, valid_from FROM hist WHERE valid_to IS NULL OR valid_to >= TIMESTAMP '2024-02-03' - INTERVAL 168 HOURS
  UNION ALL SELECT 'late', user_id, valid_from FROM hist WHERE valid_to IS NULL OR valid_to >= TIMESTAMP '2024-02-10' - INTERVAL 168 HOURS""")
def _(spark, sf):
    history, second = _history(spark, sf)
    versions = scd2_apply(history, second, **LOADED)
    runs = {"early": "2024-02-03 00:00:00", "late": "2024-02-10 00:00:00"}
    parts = [retention_prune(versions, moment(t)).select(F.lit(n).alias("run"), "user_id", "valid_from") for n, t in runs.items()]
    return parts[0].unionByName(parts[1])


@query("running_snapshots", f"WITH {SNAPSHOTS_SQL} SELECT event_id, ts, user_id, {', '.join(MEASURES)} FROM snaps")
def _(spark, sf):
    return snapshots(spark, sf)


def _earliest(spark, sf):
    return load(spark, sf, "events", "ts").agg(F.min("ts")).scalar()


ASOF_SQL = f"""{SNAPSHOTS_SQL}, {CHECKPOINTS_SQL},
placed AS (
  SELECT c.checkpoint_id, a.step, c.checkpoint_ts, s.user_id, s.goals, s.assists, s.minutes FROM cps c JOIN axis a USING (checkpoint_ts)
  JOIN snaps s ON s.ts <= a.boundary
  QUALIFY row_number() OVER (PARTITION BY c.checkpoint_id, s.user_id ORDER BY s.ts DESC, s.event_id DESC) = 1)"""


@query("asof_snapshot", f"WITH {ASOF_SQL} SELECT checkpoint_id, step, checkpoint_ts, user_id, goals, assists, minutes FROM placed")
def _(spark, sf):
    return asof_snapshot(
        checkpoints(spark, sf), snapshots(spark, sf), "user_id", "checkpoint_id", "checkpoint_ts", "ts",
        ["goals", "assists", "minutes"], earliest=_earliest(spark, sf),
    )


RACE_SQL = f"""{ASOF_SQL}, {state_sql("now")},
leaders AS (SELECT user_id FROM (SELECT user_id, dense_rank() OVER (ORDER BY goals DESC, assists DESC, minutes) AS r FROM now) WHERE r <= 3),
race AS (
  SELECT *, dense_rank() OVER (PARTITION BY checkpoint_id ORDER BY goals DESC, assists DESC, minutes) AS rank_at_step,
    checkpoint_ts = (SELECT max(checkpoint_ts) FROM cps) AS is_latest FROM placed WHERE user_id IN (SELECT user_id FROM leaders))"""


def _race(spark, sf):
    leaders = stage(race_leaders(state_at(spark, sf), "user_id", RACE_ORDER), "leaders")  # a few rows, read by every part of the race
    # Only the leaders' increments are summed up.
    theirs = running(activity(spark, sf).join(leaders, "user_id", "left_semi"))
    return race(
        checkpoints(spark, sf), theirs, "user_id", "checkpoint_id", "checkpoint_ts", "ts", RACE_ORDER, earliest=_earliest(spark, sf)
    )


@query("asof_race", f"""WITH {RACE_SQL} SELECT checkpoint_id, step, checkpoint_ts, user_id, goals, assists, minutes, rank_at_step,
  CASE rank_at_step WHEN 1 THEN '🥇' WHEN 2 THEN '🥈' WHEN 3 THEN '🥉' END AS medal, is_latest FROM race""")
def _(spark, sf):
    return _race(spark, sf)


@query("current_leaders", f"WITH {RACE_SQL} SELECT user_id, goals, assists, minutes, rank_at_step FROM race WHERE is_latest")
def _(spark, sf):
    order = [F.col("rank_at_step").asc(), F.col("goals").desc(), F.col("assists").desc(), F.col("minutes").asc(), F.col("user_id").asc()]
    return current_leaders(stage(_race(spark, sf), "race"), "is_latest", "step", order).select("user_id", "goals", "assists", "minutes", "rank_at_step")


DAILY_SQL = f"""{SNAPSHOTS_SQL},
daily AS (SELECT user_id, CAST(ts AS DATE) AS day, max(goals) AS goals, max(minutes) AS minutes FROM snaps GROUP BY ALL),
days AS (SELECT day, row_number() OVER (ORDER BY day) AS step FROM (SELECT DISTINCT day FROM daily)),
filled AS (
  SELECT d.day, d.step, u.user_id,
    coalesce(last_value(x.goals IGNORE NULLS) OVER w, 0) AS goals, coalesce(last_value(x.minutes IGNORE NULLS) OVER w, 0) AS minutes
  FROM days d CROSS JOIN (SELECT DISTINCT user_id FROM daily) u LEFT JOIN daily x ON x.user_id = u.user_id AND x.day = d.day
  WINDOW w AS (PARTITION BY u.user_id ORDER BY d.day ROWS UNBOUNDED PRECEDING))"""


def _daily(spark, sf):
    """Each user's totals at the end of each active day: day sums first, so that few rows are scanned."""
    sums = activity(spark, sf).groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.sum("d_goals").alias("d_goals"), F.sum("d_minutes").alias("d_minutes")
    )
    rows = ordered_scan(
        stage(sums, "daily"), ["user_id"], ["day"], sums={"goals": "d_goals", "minutes": "d_minutes"}, bucket=F.trunc("day", "MONTH")
    )
    return stage(rows.select("user_id", "day", "goals", "minutes"), "daily")


@query("forward_fill", f"WITH {DAILY_SQL} SELECT user_id, day, step, goals, minutes FROM filled")
def _(spark, sf):
    return forward_fill(_daily(spark, sf), "user_id", "day", ["goals", "minutes"])


@query("path_signature", f"""WITH {DAILY_SQL}, turns AS (
    SELECT user_id, step, goals, lag(goals, 1, 0) OVER (PARTITION BY user_id ORDER BY step) AS before FROM filled),
  paths AS (SELECT user_id, coalesce(string_agg(step || ':' || least(goals, 1), '|' ORDER BY step) FILTER (goals > 0 AND before = 0), '') AS signature FROM turns GROUP BY user_id)
  SELECT user_id, signature, row_number() OVER (PARTITION BY signature ORDER BY user_id) AS position FROM paths""")
def _(spark, sf):
    dense = forward_fill(_daily(spark, sf), "user_id", "day", ["goals"])
    return path_signature(dense.withColumn("scored", F.least("goals", F.lit(1))), "user_id", "step", "scored")


@query("percent_ranks", f"""WITH {state_sql("now")} SELECT user_id,
  percent_rank() OVER (ORDER BY goals) * 100 AS goals_percentile, percent_rank() OVER (ORDER BY assists) * 100 AS assists_percentile,
  percent_rank() OVER (ORDER BY matches) * 100 AS matches_percentile, percent_rank() OVER (ORDER BY minutes) * 100 AS minutes_percentile FROM now""")
def _(spark, sf):
    names = {f"{m}_percentile": m for m in MEASURES}
    return percent_ranks(stage(state_at(spark, sf), "state"), names).select("user_id", *names)


@query("top3_with_ties", f"WITH {state_sql('now')} SELECT user_id, goals, dense_rank FROM (SELECT user_id, goals, dense_rank() OVER (ORDER BY goals DESC) AS dense_rank FROM now) WHERE dense_rank <= 3")
def _(spark, sf):
    return top_with_ties(state_at(spark, sf).select("user_id", "goals"), [("goals", True)], 3)


@query("leaderboard", f"""WITH {state_sql("now")}, scored AS (SELECT * FROM now WHERE goals > 0)
  SELECT user_id, goals, assists, matches, minutes, row_number() OVER o AS row_rank, dense_rank() OVER (ORDER BY goals DESC, assists DESC, minutes) AS dense_rank,
    dense_rank() OVER (ORDER BY goals DESC, assists DESC, minutes) <= 3 AS is_top, max(goals) OVER () - goals AS behind_leader,
    floor(percent_rank() OVER (ORDER BY goals) * 100 + 0.5) AS goals_percentile, floor(percent_rank() OVER (ORDER BY minutes) * 100 + 0.5) AS minutes_percentile
  FROM scored WINDOW o AS (ORDER BY goals DESC, assists DESC, minutes, user_id) QUALIFY row_number() OVER o <= 10""")
def _(spark, sf):
    current = state_at(spark, sf).filter("goals > 0").drop("seen_at")
    return marts.leaderboard(current, RACE_ORDER, ["goals", "minutes"], "user_id")


ACTORS_SQL = f"""{EVENTS_SQL},
pairs AS (SELECT actor, team, opponent, count(*) AS against FROM ev GROUP BY ALL),
favourite AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY actor, team ORDER BY against DESC, opponent) = 1),
actors AS (SELECT actor, team, count(*) AS goals, count(*) FILTER (is_penalty) AS penalties, CAST(sum(minute_base) AS BIGINT) AS minutes FROM ev GROUP BY actor, team)"""


@query("favourite_opponent", f"WITH {ACTORS_SQL} SELECT actor, team, opponent, against FROM favourite")
def _(spark, sf):
    return marts.favourite_opponents(parse_packed_events(packed_events(spark, sf), keep=["home_team", "away_team"]))


@query("actor_leaderboard", f"""WITH {ACTORS_SQL}, keyed AS (SELECT *, actor || '@' || team AS actor_id FROM actors)
  SELECT actor_id, k.goals, k.penalties, k.minutes, row_number() OVER o AS row_rank, dense_rank() OVER (ORDER BY goals DESC, penalties DESC, minutes) AS dense_rank,
    max(goals) OVER () - goals AS behind_leader, floor(percent_rank() OVER (ORDER BY goals) * 100 + 0.5) AS goals_percentile, opponent, against
  FROM keyed k LEFT JOIN favourite f ON lower(trim(f.actor)) = lower(trim(k.actor)) AND f.team = k.team
  WINDOW o AS (ORDER BY goals DESC, penalties DESC, minutes, actor_id) QUALIFY row_number() OVER o <= 10""")
def _(spark, sf):
    events = parse_packed_events(packed_events(spark, sf), keep=["home_team", "away_team"])
    # A row per actor, team and opponent serves the board and the favourites.
    pairs = marts.opponent_pairs(events, penalties=F.count_if("is_penalty"), minutes=F.sum("minute_base"))
    pairs = stage(pairs, "pairs")
    actors = pairs.groupBy("actor", "team").agg(
        F.sum("against").alias("goals"), F.sum("penalties").alias("penalties"), F.sum("minutes").alias("minutes")
    ).withColumn("actor_id", F.concat_ws("@", "actor", "team"))
    order = [("goals", True), ("penalties", True), ("minutes", False)]
    board = marts.leaderboard(actors, order, ["goals"], "actor_id", favourites=marts.favourites_of(pairs))
    return board.select(
        "actor_id", "goals", "penalties", "minutes", "row_rank", "dense_rank", "behind_leader", "goals_percentile", "opponent", "against"
    )
