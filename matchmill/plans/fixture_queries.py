"""Queries over fixtures: deduplication, sides, totals, outcomes, schedule."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchmill.functions.outcomes import two_party_outcome
from matchmill.functions.text import search_filter
from matchmill.functions.times import delta_label, parse_instant, parse_local, short_label, to_utc, with_zone
from matchmill.operators.dedup import build_dimension, top_rows, valid_keys
from matchmill.operators.joins import lookup_join, role_join
from matchmill.operators.ranking import gap_to_leader, rank_rows, top_listing, top_with_ties
from matchmill.operators.scan import global_row_number
from matchmill.operators.shape import melt_metrics
from matchmill.operators.sides import latest_state, participant_history, participant_totals, unpivot_sides
from matchmill.plans import marts
from matchmill.plans.registry import query
from matchmill.session import stage
from matchmill.plans.views import (
    AS_OF, FIXTURES_SQL, SIDES_SQL, TOTALS_SQL, VENUES_SQL, fixtures, fixtures_with_text, latest_lines, load, moment,
    venue_zones,
)

TOTAL_COLUMNS = (
    "participant, played, wins, draws, losses, goals_for, goals_against, clean_sheets, goal_difference, points, "
    "win_percentage, goals_per_match"
)


@query("dedup_latest", f"WITH {FIXTURES_SQL} SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM raw")
def _(spark, sf):
    return latest_lines(spark, sf).select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")


@query(
    "dim_scd1",
    """SELECT c_name AS member_id, c_nationkey AS team_id, c_mktsegment AS segment, CAST(floor(c_acctbal) AS BIGINT) AS balance
    FROM customer WHERE c_name IS NOT NULL AND trim(c_name) <> '' AND c_name <> 'null' AND length(trim(c_name)) > 5
    QUALIFY row_number() OVER (PARTITION BY c_name ORDER BY c_custkey DESC) = 1""",
)
def _(spark, sf):
    columns = {
        "member_id": F.col("c_name"), "team_id": F.col("c_nationkey"), "segment": F.col("c_mktsegment"),
        "balance": F.floor("c_acctbal").cast("long"),
    }
    return build_dimension(load(spark, sf, "customer"), "c_name", columns, [F.col("c_custkey").desc()])


@query(
    "valid_keys",
    """SELECT p_partkey, key FROM (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'null'
      WHEN 3 THEN substr(p_name, 1, 5) WHEN 4 THEN substr(p_name, 1, 6) ELSE p_name END AS key FROM part)
    WHERE key IS NOT NULL AND trim(key) <> '' AND key <> 'null' AND length(trim(key)) > 5""",
)
def _(spark, sf):
    turn = F.col("p_partkey") % 7
    key = (
        F.when(turn == 0, F.lit(None)).when(turn == 1, " ").when(turn == 2, "null")
        .when(turn == 3, F.substring("p_name", 1, 5)).when(turn == 4, F.substring("p_name", 1, 6)).otherwise(F.col("p_name"))
    )
    return valid_keys(load(spark, sf, "part", "p_partkey", "p_name").select("p_partkey", key.alias("key")), "key")


@query("unpivot_sides", f"WITH {SIDES_SQL} SELECT match_id, participant, opponent, is_home, scored, conceded FROM sides")
def _(spark, sf):
    return unpivot_sides(fixtures(spark, sf))


@query(
    "participant_totals",
    f"""WITH {TOTALS_SQL} SELECT {TOTAL_COLUMNS},
    row_number() OVER (ORDER BY points DESC, goal_difference DESC, goals_for DESC, participant) AS position FROM standing""",
)
def _(spark, sf):
    totals = participant_totals(fixtures(spark, sf))
    order = [F.col("points").desc(), F.col("goal_difference").desc(), F.col("goals_for").desc(), F.col("participant").asc()]
    return global_row_number(totals, order, "position")


@query(
    "latest_state",
    f"""WITH {SIDES_SQL} SELECT participant, stage, match_id FROM sides WHERE is_finished
    QUALIFY row_number() OVER (PARTITION BY participant ORDER BY kickoff DESC, match_id DESC) = 1""",
)
def _(spark, sf):
    sides = unpivot_sides(fixtures(spark, sf).filter("is_finished"), keep=["match_id", "stage", "kickoff"])
    order = [F.col("kickoff").desc(), F.col("match_id").desc()]
    return latest_state(sides, "participant", order, ["stage", "kickoff", "match_id"]).select("participant", "stage", "match_id")


@query(
    "participant_history",
    f"""WITH {SIDES_SQL} SELECT participant, match_id, kickoff, stage, opponent, is_home, scored, conceded,
      CASE WHEN winner = participant THEN 'W' WHEN winner IS NULL THEN 'D' ELSE 'L' END AS letter,
      is_knockout AND scored = conceded AND winner IS NOT NULL AS is_shootout
    FROM sides WHERE is_finished""",
)
def _(spark, sf):
    rows = participant_history(fixtures(spark, sf)).orderBy("participant", "kickoff", "match_id")
    return rows.select("participant", "match_id", "kickoff", "stage", "opponent", "is_home", "scored", "conceded", "letter", "is_shootout")


@query(
    "group_rank",
    f"""WITH {TOTALS_SQL} SELECT participant, r_name AS group_name, points, goal_difference, goals_for,
      dense_rank() OVER (PARTITION BY r_name ORDER BY points DESC, goal_difference DESC, goals_for DESC) AS rank_in_group
    FROM standing JOIN nation ON n_name = participant JOIN region ON r_regionkey = n_regionkey""",
)
def _(spark, sf):
    return _group_ranks(spark, sf).select("participant", "group_name", "points", "goal_difference", "goals_for", "rank_in_group")


def _groups(spark, sf):
    nation = load(spark, sf, "nation", "n_name", "n_regionkey")
    region = load(spark, sf, "region", "r_regionkey", "r_name")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("participant"), F.col("r_name").alias("group_name")
    )


def _group_ranks(spark, sf, totals=None):
    totals = participant_totals(fixtures(spark, sf)) if totals is None else totals
    totals = stage(totals.join(_groups(spark, sf), "participant"), "totals")
    order = [("points", True), ("goal_difference", True), ("goals_for", True)]
    return rank_rows(totals, order, ["group_name"], dense="rank_in_group")


@query(
    "global_rank",
    """SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS row_rank FROM customer""",
)
def _(spark, sf):
    rows = load(spark, sf, "customer", "c_custkey", "c_acctbal")
    return global_row_number(rows, [F.col("c_acctbal").desc(), F.col("c_custkey").asc()])


@query(
    "rank_with_ties",
    """SELECT p_partkey, p_size, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS place,
      dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS dense_place,
      percent_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS share FROM part""",
)
def _(spark, sf):
    rows = load(spark, sf, "part", "p_partkey", "p_brand", "p_size")
    ranked = rank_rows(rows, [("p_size", True)], ["p_brand"], rank="place", dense="dense_place", percent="share")
    return ranked.select("p_partkey", "p_size", "place", "dense_place", "share")


@query(
    "topk_with_ties",
    """SELECT p_partkey, p_size, p_brand, dense_rank FROM (
      SELECT *, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS dense_rank FROM part) WHERE dense_rank <= 3""",
)
def _(spark, sf):
    rows = load(spark, sf, "part", "p_partkey", "p_size", "p_brand")
    return top_with_ties(rows, [("p_size", True)], 3, ["p_brand"])


@query(
    "gap_to_leader",
    f"""WITH {TOTALS_SQL} SELECT participant, points, max(points) OVER () - points AS behind_leader,
      max(points) OVER (PARTITION BY n_regionkey) - points AS behind_group
    FROM standing JOIN nation ON n_name = participant""",
)
def _(spark, sf):
    totals = stage(participant_totals(fixtures(spark, sf)).join(_groups(spark, sf), "participant"), "totals")
    rows = gap_to_leader(gap_to_leader(totals, "points"), "points", "behind_group", ["group_name"])
    return rows.select("participant", "points", "behind_leader", "behind_group")


@query(
    "topn_listing",
    "SELECT c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_name LIMIT 12",
)
def _(spark, sf):
    return top_listing(load(spark, sf, "customer", "c_name", "c_acctbal"), [F.col("c_acctbal").desc(), F.col("c_name").asc()], 12)


@query("pair_counts", f"WITH {SIDES_SQL} SELECT participant, opponent, count(*) AS meetings FROM sides GROUP BY ALL")
def _(spark, sf):
    return unpivot_sides(fixtures(spark, sf)).groupBy("participant", "opponent").agg(F.count(F.lit(1)).alias("meetings"))


@query(
    "top1_attach",
    """SELECT n_name, c_name AS richest, c_acctbal AS balance FROM nation LEFT JOIN (
      SELECT * FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1)
    ON c_nationkey = n_nationkey""",
)
def _(spark, sf):
    customer = load(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    best = top_rows(customer, ["c_nationkey"], [F.col("c_acctbal").desc(), F.col("c_custkey").asc()])
    nation = load(spark, sf, "nation", "n_nationkey", "n_name")
    return lookup_join(nation, best, {"n_nationkey": "c_nationkey"}, {"richest": "c_name", "balance": "c_acctbal"}).drop("n_nationkey")


@query(
    "fact_dim_join",
    """SELECT l_orderkey, l_linenumber, p_name, s_name, o_orderpriority FROM lineitem JOIN part ON p_partkey = l_partkey
    LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN orders ON o_orderkey = l_orderkey""",
)
def _(spark, sf):
    rows = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = lookup_join(rows, load(spark, sf, "part", "p_partkey", "p_name"), {"l_partkey": "p_partkey"}, {"p_name": "p_name"}, "inner")
    rows = lookup_join(rows, load(spark, sf, "supplier", "s_suppkey", "s_name"), {"l_suppkey": "s_suppkey"}, {"s_name": "s_name"})
    orders = load(spark, sf, "orders", "o_orderkey", "o_orderpriority")
    rows = lookup_join(rows, orders, {"l_orderkey": "o_orderkey"}, {"o_orderpriority": "o_orderpriority"})
    return rows.drop("l_partkey", "l_suppkey")


@query(
    "role_playing_dim",
    f"""WITH {FIXTURES_SQL} SELECT match_id, h.n_regionkey AS home_region, a.n_regionkey AS away_region, w.n_regionkey AS winner_region
    FROM fx LEFT JOIN nation h ON h.n_name = home_team LEFT JOIN nation a ON a.n_name = away_team LEFT JOIN nation w ON w.n_name = winner""",
)
def _(spark, sf):
    rows = fixtures(spark, sf).select("match_id", "home_team", "away_team", F.col("winner").alias("winner_team"))
    nation = load(spark, sf, "nation", "n_name", "n_regionkey")
    joined = role_join(rows, nation, ["home", "away", "winner"], "n_name", {"region": "n_regionkey"}, "_team")
    return joined.select("match_id", "home_region", "away_region", "winner_region")


UNIFIED_NAMES = {"NATION_1": "Northland", "nation_2": "Southland"}


@query(
    "unified_facts",
    f"""WITH {FIXTURES_SQL}, named AS (SELECT *, CASE home_team WHEN 'NATION_1' THEN 'Northland' WHEN 'NATION_2' THEN 'Southland' ELSE home_team END AS h,
      CASE away_team WHEN 'NATION_1' THEN 'Northland' WHEN 'NATION_2' THEN 'Southland' ELSE away_team END AS a,
      CASE winner WHEN 'NATION_1' THEN 'Northland' WHEN 'NATION_2' THEN 'Southland' ELSE winner END AS w FROM fx)
    SELECT match_id, CASE WHEN is_knockout THEN 'Final' ELSE 'Group Stage' END AS stage, h AS home_team, a AS away_team, w AS winner,
      CASE WHEN is_knockout THEN home_pens END AS home_pens, CASE WHEN NOT is_knockout THEN stage END AS group_name FROM named""",
)
def _(spark, sf):
    rows = fixtures(spark, sf)
    common = ["match_id", "home_team", "away_team", "winner"]
    group = rows.filter(~F.col("is_knockout")).select(*common, F.col("stage").alias("group_name"))
    knockout = rows.filter("is_knockout").select(*common, "home_pens")
    out = marts.unify_fixtures({"group": group, "final": knockout}, UNIFIED_NAMES)
    return out.select("match_id", "stage", "home_team", "away_team", "winner", "home_pens", "group_name")


@query(
    "two_party_outcome",
    f"""WITH {FIXTURES_SQL}, named AS (SELECT *, CASE WHEN match_id % 11 = 0 THEN NULL ELSE home_team END AS home FROM fx),
    sided AS (SELECT *, CASE WHEN home IS NULL OR NOT is_finished THEN NULL WHEN home_score > away_score THEN 1 WHEN away_score > home_score THEN 2
      WHEN home_pens > away_pens THEN 1 WHEN away_pens > home_pens THEN 2 END AS side FROM named)
    SELECT match_id, CASE side WHEN 1 THEN home WHEN 2 THEN away_team END AS winner, CASE side WHEN 1 THEN away_team WHEN 2 THEN home END AS loser,
      CASE side WHEN 1 THEN home_id WHEN 2 THEN away_id END AS winner_id, CASE side WHEN 1 THEN away_id WHEN 2 THEN home_id END AS loser_id,
      CASE WHEN home IS NULL THEN 'Not Started' WHEN NOT is_finished THEN 'Scheduled' WHEN home_score <> away_score THEN 'Finished'
        WHEN home_pens IS NULL THEN 'Draw (Pending Penalties)' WHEN home_pens = away_pens THEN 'Draw (Tied Penalties)'
        ELSE 'Finished (Penalties)' END AS status FROM sided""",
)
def _(spark, sf):
    rows = fixtures(spark, sf).withColumn("home_team", F.when(F.col("match_id") % 11 != 0, F.col("home_team")))
    return two_party_outcome(rows).select("match_id", "winner", "loser", "winner_id", "loser_id", "status")


SCHEDULE_SQL = f"""{FIXTURES_SQL}, {VENUES_SQL}, timed AS (
  SELECT fx.*, city, country, kickoff + to_hours(hours_west) AS starts_utc, TIMESTAMP '{AS_OF}' AS as_of
  FROM fx JOIN venues USING (venue_id)),
schedule AS (
  SELECT *, CASE WHEN is_finished THEN 'Finished' WHEN starts_utc BETWEEN as_of - INTERVAL 3 HOURS AND as_of THEN 'Live'
      WHEN starts_utc > as_of THEN 'Upcoming' ELSE 'Finished' END AS match_status,
    NOT is_finished AND starts_utc BETWEEN as_of - INTERVAL 3 HOURS AND as_of AS is_live,
    CASE WHEN starts_utc > as_of THEN floor(date_diff('second', as_of, starts_utc)::DOUBLE / 3600.0 * 10 + 0.5) / 10 END AS hours_until,
    CASE WHEN NOT is_finished AND starts_utc <= as_of THEN floor(date_diff('second', starts_utc, as_of)::DOUBLE / 60.0 + 0.5) END AS minutes_elapsed
  FROM timed)"""


@query("zone_dim", f"WITH {SCHEDULE_SQL} SELECT match_id, city, country, starts_utc FROM schedule")
def _(spark, sf):
    rows = lookup_join(
        fixtures_with_text(spark, sf), venue_zones(spark), {"venue_id": "venue_id"},
        {"city": "city", "country": "country", "hours_west": "hours_west"},
    )
    start = to_utc(parse_local(F.col("local_text")), F.col("hours_west"))
    return rows.select("match_id", "city", "country", start.alias("starts_utc"))


@query("status_at", f"WITH {SCHEDULE_SQL} SELECT match_id, match_status, is_live, hours_until, minutes_elapsed FROM schedule")
def _(spark, sf):
    rows = _schedule(spark, sf)
    return rows.select("match_id", "match_status", "is_live", "hours_until", "minutes_elapsed")


def _schedule(spark, sf, **extra):
    return marts.schedule_fact(fixtures_with_text(spark, sf), venue_zones(spark), moment(AS_OF), **extra)


@query(
    "open_items",
    f"""WITH {SCHEDULE_SQL} SELECT match_id, home_team, away_team, match_status, starts_utc FROM schedule
    WHERE match_status IN ('Live', 'Upcoming') AND home_team IS NOT NULL AND away_team IS NOT NULL""",
)
def _(spark, sf):
    return marts.open_items(_schedule(spark, sf)).select("match_id", "home_team", "away_team", "match_status", "starts_utc")


@query(
    "finished_items",
    f"""WITH {FIXTURES_SQL} SELECT match_id, home_team, away_team, home_score, away_score, winner, kickoff,
    is_knockout AND home_score = away_score AND winner IS NOT NULL AS shootout FROM fx WHERE is_finished""",
)
def _(spark, sf):
    rows = marts.finished_items(fixtures(spark, sf))
    return rows.select("match_id", "home_team", "away_team", "home_score", "away_score", "winner", "kickoff", "shootout")


@query(
    "time_delta_label",
    f"""WITH d AS (SELECT o_orderkey, o_orderdate, CAST(floor(date_diff('second', TIMESTAMP '{AS_OF}', o_orderdate)::DOUBLE / 60.0 + 0.5) AS BIGINT) AS m FROM orders),
    p AS (SELECT *, abs(m) AS s FROM d),
    t AS (SELECT *, CASE WHEN s // 1440 > 0 THEN (s // 1440) || 'd ' ELSE '' END || CASE WHEN (s % 1440) // 60 > 0 THEN ((s % 1440) // 60) || 'h ' ELSE '' END || (s % 60) || 'm' AS parts FROM p)
    SELECT o_orderkey, CASE WHEN m >= 0 THEN 'in ' || parts ELSE parts || ' ago' END AS label, strftime(o_orderdate, '%-d %B %y %H:%M UTC') AS shown FROM t""",
)
def _(spark, sf):
    rows = load(spark, sf, "orders", "o_orderkey", "o_orderdate")
    at = F.col("o_orderdate")
    return rows.select("o_orderkey", delta_label(at, moment(AS_OF)).alias("label"), short_label(at).alias("shown"))


@query("instant_parse", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def _(spark, sf):
    """Times as texts in three encodings, read back."""
    events = load(spark, sf, "events", "event_id", "ts")
    at, turn = F.col("ts"), F.col("event_id") % 3
    plus_two = at + F.make_dt_interval(F.lit(0), F.lit(2), F.lit(0), F.lit(0))
    text = (
        F.when(turn == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss")).when(turn == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.'000Z'"))
        .otherwise(F.date_format(plus_two, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
    )
    return events.select("event_id", parse_instant(text).alias("at"))


@query("zone_suffix", """SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y %H:%M') || ' ' || CASE o_orderkey % 4 WHEN 0 THEN 'CDT' WHEN 1 THEN 'PDT' ELSE 'EDT' END AS shown FROM orders""")
def _(spark, sf):
    zone = F.element_at(F.array(*[F.lit(z) for z in ("America/Chicago", "America/Vancouver", "America/Toronto", "Elsewhere")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    rows = load(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return rows.select("o_orderkey", with_zone(F.date_format("o_orderdate", "MM/dd/yyyy HH:mm"), zone).alias("shown"))


@query(
    "search_filter",
    """SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE lower(c_name) LIKE '%mer#00000001%' OR lower(c_mktsegment) LIKE '%mer#00000001%'
    UNION SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE lower(c_name) LIKE '%mach%' OR lower(c_mktsegment) LIKE '%mach%'""",
)
def _(spark, sf):
    rows = load(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment")
    columns = ["c_name", "c_mktsegment"]
    return search_filter(rows, columns, "MER#00000001").union(search_filter(rows, columns, "Mach")).distinct()


@query(
    "melt_metrics",
    f"""WITH {TOTALS_SQL} SELECT participant, metric, value FROM (
      SELECT participant, 'wins' AS metric, wins::DOUBLE AS value FROM standing UNION ALL
      SELECT participant, 'points', points::DOUBLE FROM standing UNION ALL
      SELECT participant, 'win_percentage', win_percentage FROM standing)""",
)
def _(spark, sf):
    return melt_metrics(participant_totals(fixtures(spark, sf)), ["participant"], ["wins", "points", "win_percentage"])
