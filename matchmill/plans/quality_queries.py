"""Data-quality queries, each over data that really contains failures, and the layout job."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchmill.functions.times import parse_local
from matchmill.operators import quality
from matchmill.operators.asof import hour_of
from matchmill.operators.layout import cluster_layout
from matchmill.operators.quality import Check, RowRules, run_checks
from matchmill.operators.sides import participant_totals
from matchmill.plans.fixture_queries import _group_ranks
from matchmill.plans.registry import query
from matchmill.plans.views import FIXTURES_SQL, SNAPSHOTS_SQL, TOTALS_SQL, VENUES_SQL, fixtures, load, snapshots, state_at, state_sql, venue_zones

def _line_ids(spark, sf):
    lines = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    return lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("match_id"))


@query("dq_unique", "SELECT l_orderkey * 10 + l_linenumber AS match_id, count(*) AS copies FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    return quality.duplicates(_line_ids(spark, sf), ["match_id"])


@query("dq_duplicates", """SELECT user_id, day, count(*) AS copies FROM (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'signup') GROUP BY ALL HAVING count(*) > 1""")
def _(spark, sf):
    """More than one current row per key."""
    events = load(spark, sf, "events", "user_id", "ts", "event_type").filter("event_type = 'signup'")
    return quality.duplicates(events.select("user_id", F.to_date("ts").alias("day")), ["user_id", "day"])


@query("dq_not_null", f"WITH {FIXTURES_SQL} SELECT match_id, CASE WHEN winner IS NULL THEN 'winner' ELSE 'home_pens' END AS null_column FROM fx WHERE winner IS NULL OR home_pens IS NULL")
def _(spark, sf):
    return quality.not_null(fixtures(spark, sf), ["winner", "home_pens"]).select("match_id", "null_column")


@query("dq_blank_keys", "SELECT p_partkey FROM part WHERE p_partkey % 5 < 3")
def _(spark, sf):
    turn = F.col("p_partkey") % 5
    key = F.when(turn == 1, " ").when(turn == 2, "null").when(turn > 2, F.col("p_name"))
    return quality.blank_keys(load(spark, sf, "part", "p_partkey", "p_name").select("p_partkey", key.alias("key")), "key").select("p_partkey")


@query("dq_accepted_values", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('O', 'F')")
def _(spark, sf):
    return quality.outside_values(load(spark, sf, "orders", "o_orderkey", "o_orderstatus"), "o_orderstatus", ["O", "F"])


@query("dq_orphans", "SELECT o_orderkey FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey")
def _(spark, sf):
    lines = load(spark, sf, "lineitem", "l_orderkey")
    return quality.orphans(load(spark, sf, "orders", "o_orderkey"), lines, {"o_orderkey": "l_orderkey"})


@query("dq_ratio_bounds", f"WITH {state_sql('now')} SELECT user_id, minutes::DOUBLE / matches AS ratio FROM now WHERE minutes::DOUBLE / matches > 40")
def _(spark, sf):
    return quality.ratio_above(state_at(spark, sf), "minutes", "matches", 40.0).select("user_id", "ratio")


@query("dq_monotone", """WITH o AS (SELECT event_id, user_id, ts, floor(value)::BIGINT AS points, lag(floor(value)::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_points FROM events)
  SELECT event_id, user_id, points, prev_points FROM o WHERE points < prev_points""")
def _(spark, sf):
    events = load(spark, sf, "events", "event_id", "user_id", "ts", "value").withColumn("points", F.floor("value").cast("long"))
    rows = quality.falling(events, "user_id", ["ts", "event_id"], ["points"], hour_of("ts"))
    return rows.select("event_id", "user_id", "points", "prev_points")


@query("dq_monotone_history", f"WITH {SNAPSHOTS_SQL} SELECT event_id FROM (SELECT event_id, goals, lag(goals) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM snaps) WHERE goals < before")
def _(spark, sf):
    """Cumulative snapshots never fall, so this passes with no rows."""
    rows = quality.falling(snapshots(spark, sf), "user_id", ["ts", "event_id"], ["goals", "minutes"], hour_of("ts"))
    return rows.select("event_id")


@query("dq_formula", f"WITH {TOTALS_SQL} SELECT participant, 'points' AS formula, points FROM standing WHERE abs(points - (played * 3 - losses * 3)) > 0.01 UNION ALL SELECT participant, 'difference', points FROM standing WHERE goal_difference <> goals_for - goals_against UNION ALL SELECT participant, 'played', points FROM standing WHERE played <> wins + draws + losses")
def _(spark, sf):
    totals = participant_totals(fixtures(spark, sf))
    off = {
        "points": (F.col("points"), (F.col("played") - F.col("losses")) * 3),
        "difference": (F.col("goal_difference"), F.col("goals_for") - F.col("goals_against")),
        "played": (F.col("played"), F.col("wins") + F.col("draws") + F.col("losses")),
    }
    return quality.formulas_off(totals, off, 0.01).select("participant", "formula", "points")


@query("dq_reconcile", f"""WITH {state_sql('s1', '2024-01-15 00:00:00')}, {state_sql('now')} SELECT now.user_id, now.goals, s1.goals AS source_goals, now.minutes, s1.minutes AS source_minutes
  FROM now JOIN s1 USING (user_id) WHERE now.goals IS DISTINCT FROM s1.goals OR now.minutes IS DISTINCT FROM s1.minutes""")
def _(spark, sf):
    rows = quality.differing(state_at(spark, sf), state_at(spark, sf, "2024-01-15 00:00:00"), "user_id", ["goals", "minutes"])
    return rows.select("user_id", "goals", "source_goals", "minutes", "source_minutes")


@query("dq_parseable", "SELECT o_orderkey FROM orders WHERE o_orderkey % 4 < 2")
def _(spark, sf):
    """Half the texts lack the time or hold a month 13."""
    at = F.col("o_orderdate")
    turn = F.col("o_orderkey") % 4
    text = (
        F.when(turn == 0, F.date_format(at, "MM/dd/yyyy")).when(turn == 1, F.date_format(at, "'13'/dd/yyyy HH:mm"))
        .when(turn == 2, F.date_format(at, "MM/dd/yyyy HH:mm 'CDT'")).otherwise(F.date_format(at, "MM/dd/yyyy HH:mm"))
    )
    rows = load(spark, sf, "orders", "o_orderkey", "o_orderdate").withColumn("local_text", text)
    return rows.filter(parse_local(F.col("local_text")).isNull()).select("o_orderkey")


@query("dq_conditional_null", f"""WITH {FIXTURES_SQL} SELECT match_id, CASE WHEN home_pens IS NULL THEN 'no shoot-out' ELSE 'level shoot-out' END AS reason FROM fx
  WHERE is_finished AND is_knockout AND home_score = away_score AND winner IS NULL""")
def _(spark, sf):
    rows = fixtures(spark, sf).filter("is_finished AND is_knockout AND home_score = away_score AND winner IS NULL")
    reason = F.when(F.col("home_pens").isNull(), "no shoot-out").otherwise("level shoot-out")
    return rows.select("match_id", reason.alias("reason"))


@query("dq_complete_stats", f"""WITH {state_sql('now')} SELECT user_id, CASE WHEN assists = 0 THEN 'no assists' WHEN matches < 60 THEN 'few matches' ELSE 'few minutes' END AS reason
  FROM now WHERE goals > 0 AND (assists = 0 OR matches < 60 OR minutes < 2500)""")
def _(spark, sf):
    """Scorers whose other numbers are incomplete, with the first reason."""
    reason = (
        F.when(F.col("assists") == 0, "no assists").when(F.col("matches") < 60, "few matches").when(F.col("minutes") < 2500, "few minutes")
    )
    rows = state_at(spark, sf).filter("goals > 0").withColumn("reason", reason)
    return rows.filter(F.col("reason").isNotNull()).select("user_id", "reason")


@query("dq_row_budget", f"""WITH {FIXTURES_SQL} SELECT 'winner' AS budget, n FROM (SELECT count(*) FILTER (winner IS NULL) AS n FROM fx) WHERE n > 2
  UNION ALL SELECT 'names', n FROM (SELECT count(*) FILTER (home_team IS NULL) AS n FROM fx) WHERE n > 2 UNION ALL SELECT 'rows', n FROM (SELECT count(*) AS n FROM fx) WHERE n NOT BETWEEN 1 AND 10""")
def _(spark, sf):
    rows = fixtures(spark, sf)
    budgets = {"winner": (F.col("winner").isNull(), 0, 2), "names": (F.col("home_team").isNull(), 0, 2), "rows": (None, 1, 10)}
    return quality.over_budgets(rows, budgets)


@query("dq_rank_gaps", f"""WITH {TOTALS_SQL}, ranked AS (SELECT participant, n_regionkey, played, dense_rank() OVER (PARTITION BY n_regionkey ORDER BY points DESC, goal_difference DESC, goals_for DESC) AS expected,
    dense_rank() OVER (PARTITION BY n_regionkey ORDER BY points DESC, goal_difference DESC, goals_for DESC) + played % 2 AS stored FROM standing JOIN nation ON n_name = participant)
  SELECT participant, stored, expected FROM ranked WHERE stored <> expected""")
def _(spark, sf):
    """Stored ranks, every odd one out by one, against the dense rank they should be."""
    ranked = _group_ranks(spark, sf)
    rows = ranked.withColumnRenamed("rank_in_group", "expected").withColumn("stored", F.col("expected") + F.col("played") % 2)
    return quality.formula_off(rows, F.col("stored"), F.col("expected")).select("participant", "stored", "expected")


@query("dq_report", f"""WITH {FIXTURES_SQL},
  failures AS (
    SELECT 'duplicate_key' AS failure_type, 'match_id loaded ' || copies || ' times' AS failure_detail, copies - 1 AS w FROM (SELECT count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE copies > 1
    UNION ALL SELECT 'missing_winner', 'stage ' || stage, 1 FROM fx WHERE is_finished AND is_knockout AND winner IS NULL
    UNION ALL SELECT 'stage_domain', 'unknown stage ' || stage, 1 FROM fx WHERE stage NOT IN ('A', 'R')
    UNION ALL SELECT 'missing_name', 'home', 1 FROM fx WHERE home_team IS NULL
    UNION ALL SELECT 'order_without_lines', o_orderpriority, 1 FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey)
  SELECT failure_type, failure_detail, CAST(sum(w) AS BIGINT) AS failure_count FROM failures GROUP BY ALL""")
def _(spark, sf):
    rows = fixtures(spark, sf)
    lines = load(spark, sf, "lineitem", "l_orderkey")
    orders = load(spark, sf, "orders", "o_orderkey", "o_orderpriority")
    copies = F.concat(F.lit("match_id loaded "), F.col("copies").cast("string"), F.lit(" times"))
    knockout = F.col("is_finished") & F.col("is_knockout")
    return run_checks(
        [
            Check(
                "duplicate_key",
                lambda: quality.duplicates(_line_ids(spark, sf), ["match_id"]).withColumn("extra", F.col("copies") - 1), copies, "extra",
            ),
            RowRules(
                rows,
                {
                    "missing_winner": (knockout & F.col("winner").isNull(), F.concat(F.lit("stage "), F.col("stage"))),
                    "stage_domain": (~F.col("stage").isin("A", "R"), F.concat(F.lit("unknown stage "), F.col("stage"))),
                    "missing_name": (F.col("home_team").isNull(), "home"),
                },
            ),
            Check("order_without_lines", lambda: quality.orphans(orders, lines, {"o_orderkey": "l_orderkey"}), F.col("o_orderpriority")),
        ]
    )


@query("layout_cluster", "SELECT * FROM lineitem")
def _(spark, sf):
    return cluster_layout(load(spark, sf, "lineitem"), ["l_shipdate", "l_partkey", "l_returnflag"])


@query("layout_cluster_text", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, sf):
    """Clustered by names that share a prefix."""
    return cluster_layout(load(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal"), ["c_name", "c_acctbal"])


@query("dq_history_falls", f"""WITH {SNAPSHOTS_SQL}, told AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 11 = 0 THEN goals - 1 ELSE goals END AS goals, CASE WHEN event_id % 13 = 0 THEN NULL ELSE minutes - event_id % 7 END AS minutes FROM snaps),
  o AS (SELECT *, lag(goals) OVER w AS prev_goals, lag(minutes) OVER w AS prev_minutes FROM told WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
  SELECT event_id, goals, prev_goals, minutes, prev_minutes FROM o WHERE coalesce(goals < prev_goals, FALSE) OR coalesce(minutes < prev_minutes, FALSE)""")
def _(spark, sf):
    """Snapshots of which some have lost goals or minutes, or have none."""
    key = F.col("event_id")
    goals = F.when(key % 11 == 0, F.col("goals") - 1).otherwise(F.col("goals"))
    minutes = F.when(key % 13 != 0, F.col("minutes") - key % 7)
    told = snapshots(spark, sf).select("event_id", "user_id", "ts", goals.alias("goals"), minutes.alias("minutes"))
    rows = quality.falling(told, "user_id", ["ts", "event_id"], ["goals", "minutes"], hour_of("ts"))
    return rows.select("event_id", "goals", "prev_goals", "minutes", "prev_minutes")


@query("dq_zone_mapping", f"WITH {VENUES_SQL}, o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderkey % 19 + 1 AS VARCHAR) END AS venue_id FROM orders) SELECT venue_id, count(*) AS fixtures FROM o WHERE venue_id NOT IN (SELECT venue_id FROM venues) GROUP BY venue_id")
def _(spark, sf):
    """Venues without hours, before any time is turned into UTC, with the fixtures that they hold."""
    key = F.col("o_orderkey")
    rows = load(spark, sf, "orders", "o_orderkey").select(F.when(key % 23 != 0, (key % 19 + 1).cast("string")).alias("venue_id"))
    return quality.orphans(rows, venue_zones(spark), {"venue_id": "venue_id"}).groupBy("venue_id").agg(F.count(F.lit(1)).alias("fixtures"))
