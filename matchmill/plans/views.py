"""The given tables seen as fixtures, packed events, cumulative snapshots and a feeder tree.

Each view has its SQL twin (``*_SQL``: common table expressions) for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.fixed_values import VENUE_ZONES
from matchmill.functions.outcomes import winning_side
from matchmill.operators.asof import hour_of
from matchmill.operators.dedup import dedup_latest
from matchmill.operators.joins import literal_table, lookup_join
from matchmill.operators.scan import ordered_scan

MEASURES = ["goals", "assists", "matches", "minutes"]
GUARDED = MEASURES
RACE_ORDER = [("goals", True), ("assists", True), ("minutes", False)]
AS_OF = "1998-07-01 12:00:00"
T1, T2 = "2024-01-15 00:00:00", "2024-01-31 00:00:00"


def load(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Only the named columns of a table."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


LATEST = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]


def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per (order, line number): copies of a line number are earlier loads of it.

    The lines are dealt by order, as the orders meet them next, and to a fixed number of tasks, as much is computed from each line: tasks
    merged by their bytes would be too few to fill the cores evenly.
    """
    lines = load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", *LATEST, "l_returnflag", "l_linestatus")
    lines = lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    return dedup_latest(lines, ["l_orderkey", "l_linenumber"], [F.col(c).desc() for c in LATEST])


def fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-sided fixtures: the supplier's nation at home against the customer's nation."""
    supplier = load(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    customer = load(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = load(spark, sf_dir, "nation", "n_nationkey", "n_name")
    # Orders meet their customers before the lines meet either, so that the lines move once less.
    rows = latest_lines(spark, sf_dir)
    rows = rows.join(orders.join(customer, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).filter("s_nationkey <> c_nationkey")
    for side, key in (("home", "s_nationkey"), ("away", "c_nationkey")):
        names = nation.select(F.col("n_nationkey").alias(f"{side}_id"), F.col("n_name").alias(f"{side}_team"))
        rows = rows.join(names, F.col(key) == F.col(f"{side}_id"))
    home_score = F.round(F.col("l_discount") * 100).cast("int")
    away_score = F.round(F.col("l_tax") * 100).cast("int")
    knockout = F.col("l_returnflag") == "R"
    shootout = knockout & (home_score == away_score) & (F.col("l_partkey") % 5 != 0)
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("l_partkey") % 1440).cast("int"), F.lit(0))
    kickoff = F.col("l_shipdate") + minutes
    rows = rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("match_id"),
        "home_id", "away_id", "home_team", "away_team", home_score.alias("home_score"), away_score.alias("away_score"),
        F.when(shootout, F.col("l_partkey") % 6).cast("int").alias("home_pens"),
        F.when(shootout, F.col("l_suppkey") % 6).cast("int").alias("away_pens"),
        F.col("l_returnflag").alias("stage"), knockout.alias("is_knockout"),
        (F.col("l_linestatus") == "F").alias("is_finished"), kickoff.alias("kickoff"),
        (F.col("home_id") % 16 + 1).cast("string").alias("venue_id"),
        F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("supp_key"), F.col("l_quantity").cast("int").alias("quantity"),
    )
    side = winning_side(F.col("home_score"), F.col("away_score"), F.col("home_pens"), F.col("away_pens"))
    winner = F.when(side == "home", F.col("home_team")).when(side == "away", F.col("away_team"))
    return rows.withColumn("winner", F.when(F.col("is_finished"), winner))


FIXTURES_SQL = """
raw AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC,
    l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_discount DESC, l_tax DESC) = 1),
fx0 AS (
  SELECT l_orderkey * 10 + l_linenumber AS match_id, h.n_nationkey AS home_id, a.n_nationkey AS away_id,
    h.n_name AS home_team, a.n_name AS away_team,
    CAST(round(l_discount * 100) AS INTEGER) AS home_score, CAST(round(l_tax * 100) AS INTEGER) AS away_score,
    l_returnflag AS stage, l_returnflag = 'R' AS is_knockout, l_linestatus = 'F' AS is_finished,
    l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER)) AS kickoff,
    CAST(h.n_nationkey % 16 + 1 AS VARCHAR) AS venue_id,
    l_partkey AS part_key, l_suppkey AS supp_key, CAST(l_quantity AS INTEGER) AS quantity
  FROM raw JOIN supplier ON s_suppkey = l_suppkey JOIN nation h ON h.n_nationkey = s_nationkey
    JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation a ON a.n_nationkey = c_nationkey
  WHERE h.n_nationkey <> a.n_nationkey),
fx1 AS (
  SELECT *, CASE WHEN is_knockout AND home_score = away_score AND part_key % 5 <> 0 THEN CAST(part_key % 6 AS INTEGER) END AS home_pens,
    CASE WHEN is_knockout AND home_score = away_score AND part_key % 5 <> 0 THEN CAST(supp_key % 6 AS INTEGER) END AS away_pens
  FROM fx0),
fx AS (
  SELECT *, CASE WHEN NOT is_finished THEN NULL WHEN home_score > away_score THEN home_team
    WHEN away_score > home_score THEN away_team WHEN home_pens > away_pens THEN home_team
    WHEN away_pens > home_pens THEN away_team END AS winner
  FROM fx1)"""

SIDES_SQL = FIXTURES_SQL + """,
sides AS (
  SELECT match_id, stage, kickoff, winner, is_knockout, is_finished, home_team AS participant, away_team AS opponent, TRUE AS is_home,
    home_score AS scored, away_score AS conceded FROM fx
  UNION ALL
  SELECT match_id, stage, kickoff, winner, is_knockout, is_finished, away_team, home_team, FALSE, away_score, home_score FROM fx)"""

TOTALS_SQL = SIDES_SQL + """,
totals AS (
  SELECT participant, count(*) AS played, count(*) FILTER (scored > conceded) AS wins,
    count(*) FILTER (scored = conceded) AS draws, count(*) FILTER (scored < conceded) AS losses,
    CAST(sum(scored) AS BIGINT) AS goals_for, CAST(sum(conceded) AS BIGINT) AS goals_against,
    count(*) FILTER (conceded = 0) AS clean_sheets
  FROM sides WHERE is_finished GROUP BY participant),
standing AS (
  SELECT *, goals_for - goals_against AS goal_difference, wins * 3 + draws AS points,
    floor(wins * 100.0::DOUBLE / played * 10 + 0.5) / 10 AS win_percentage,
    floor(goals_for::DOUBLE / played * 100 + 0.5) / 100 AS goals_per_match
  FROM totals)"""


def venue_zones(spark: SparkSession) -> DataFrame:
    rows = [(k, *v) for k, v in VENUE_ZONES.items()]
    return literal_table(spark, ["venue_id", "city", "country", "zone_abbr", "hours_west"], rows)


VENUES_SQL = (
    "venues(venue_id, city, country, zone_abbr, hours_west) AS (VALUES "
    + ", ".join(f"('{k}', '{c}', '{n}', '{z}', {h})" for k, (c, n, z, h) in VENUE_ZONES.items())
    + ")"
)


def fixtures_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_local_text(spark, fixtures(spark, sf_dir))


def with_local_text(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Fixtures with their local time as text, zone abbreviation at the end."""
    rows = lookup_join(rows, venue_zones(spark), {"venue_id": "venue_id"}, {"zone_abbr": "zone_abbr"}, "inner")
    text = F.concat_ws(" ", F.date_format("kickoff", "MM/dd/yyyy HH:mm"), "zone_abbr")
    return rows.withColumn("local_text", text)


#: What the packed texts of a fixture are made of, besides its scores.
SEEDS = ["part_key", "supp_key", "quantity"]
#: Events of a text that are spelt out in compiled code; a longer text is made by a function over a list, which takes several times as long.
SPELT_OUT = 10


def packed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_packed_events(spark, sf_dir, fixtures(spark, sf_dir))


def with_packed_events(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Fixtures with each side's events packed into one text, as many as the side scored."""
    part = load(spark, sf_dir, "part", "p_partkey", "p_name")
    rows = rows.join(part, F.col("part_key") == F.col("p_partkey"))

    def packed(score: str, seed: str, pace: int, step: int):
        def one(i):
            actor = F.concat(F.col("p_name"), F.lit(" "), F.char((F.col(seed) + i) % 3 + 65))
            base = (F.col("quantity") * pace + i * step) % 90 + 1
            stoppage = F.when(base % 10 == 0, F.concat(F.lit("+"), i.cast("string"))).otherwise(F.lit(""))
            mark = F.when((F.col(seed) + i) % 4 == 0, F.lit("(p)")).otherwise(F.lit(""))
            return F.concat(F.lit('"'), actor, F.lit(" "), base.cast("string"), stoppage, F.lit("'"), mark, F.lit('"'))

        listed = F.array_join(F.transform(F.sequence(F.lit(1), F.col(score)), one), ",")
        spelt = F.concat_ws(",", *[F.when(F.col(score) >= i, one(F.lit(i))) for i in range(1, SPELT_OUT + 1)])
        text = F.concat(F.lit("{"), F.when(F.col(score) <= SPELT_OUT, spelt).otherwise(listed), F.lit("}"))
        return F.when(F.col(score) > 0, text).when(F.col("part_key") % 2 == 0, F.lit("null"))

    return rows.withColumns(
        {"home_events": packed("home_score", "part_key", 7, 11), "away_events": packed("away_score", "supp_key", 5, 13)}
    )


EVENTS_SQL = FIXTURES_SQL + """,
ev0 AS (
  SELECT match_id, kickoff, home_team AS team, away_team AS opponent, TRUE AS is_home, i AS ordinal, p_name, part_key AS seed,
    (quantity * 7 + i * 11) % 90 + 1 AS base
  FROM fx JOIN part ON p_partkey = part_key, unnest(range(1, home_score + 1)) t(i)
  UNION ALL
  SELECT match_id, kickoff, away_team, home_team, FALSE, i, p_name, supp_key, (quantity * 5 + i * 13) % 90 + 1
  FROM fx JOIN part ON p_partkey = part_key, unnest(range(1, away_score + 1)) t(i)),
ev AS (
  SELECT match_id, kickoff, team, opponent, is_home, CAST(ordinal AS INTEGER) AS ordinal,
    p_name || ' ' || chr(CAST((seed + ordinal) % 3 + 65 AS INTEGER)) AS actor, CAST(base AS INTEGER) AS minute_base,
    CASE WHEN base % 10 = 0 THEN CAST(ordinal AS INTEGER) END AS stoppage,
    CAST(base AS VARCHAR) || CASE WHEN base % 10 = 0 THEN '+' || CAST(ordinal AS VARCHAR) ELSE '' END AS minute,
    (seed + ordinal) % 4 = 0 AS is_penalty
  FROM ev0)"""


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as increments of four cumulative measures per user."""
    events = load(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return events.select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_type") == "purchase", one).otherwise(none).alias("d_goals"),
        F.when(F.col("event_type") == "click", one).otherwise(none).alias("d_assists"),
        one.alias("d_matches"),
        F.floor("value").cast("long").alias("d_minutes"),
    )


def running(increments: DataFrame) -> DataFrame:
    """Cumulative snapshots: one row per event with the user's totals so far."""
    sums = {m: f"d_{m}" for m in MEASURES}
    rows = ordered_scan(increments, ["user_id"], ["ts", "event_id"], sums=sums, bucket=hour_of("ts"))
    return rows.select("event_id", "ts", "user_id", *MEASURES)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running(activity(spark, sf_dir))


SNAPSHOTS_SQL = """
act AS (
  SELECT event_id, ts, user_id, CAST(event_type = 'purchase' AS BIGINT) AS g, CAST(event_type = 'click' AS BIGINT) AS a,
    CAST(floor(value) AS BIGINT) AS m FROM events),
snaps AS (
  SELECT event_id, ts, user_id,
    CAST(sum(g) OVER w AS BIGINT) AS goals, CAST(sum(a) OVER w AS BIGINT) AS assists,
    count(*) OVER w AS matches, CAST(sum(m) OVER w AS BIGINT) AS minutes
  FROM act WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))"""


def state_at(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """Each user's totals at a moment (now, if none is given), with the time of the last change."""
    rows = activity(spark, sf_dir)
    if until:
        rows = rows.filter(F.col("ts") <= moment(until))
    return rows.groupBy("user_id").agg(*[F.sum(f"d_{m}").alias(m) for m in MEASURES], F.max("ts").alias("seen_at"))


def state_sql(name: str, until: str | None = None) -> str:
    where = f"WHERE ts <= TIMESTAMP '{until}'" if until else ""
    return f"""
{name} AS (
  SELECT user_id, CAST(sum(CAST(event_type = 'purchase' AS BIGINT)) AS BIGINT) AS goals,
    CAST(sum(CAST(event_type = 'click' AS BIGINT)) AS BIGINT) AS assists, count(*) AS matches,
    CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS minutes, max(ts) AS seen_at
  FROM events {where} GROUP BY user_id)"""


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each day is that day's checkpoint."""
    events = load(spark, sf_dir, "events", "event_id", "ts")
    first = events.groupBy(F.to_date("ts").alias("day")).agg(F.min(F.struct("ts", "event_id")).alias("c"))
    return first.select(F.col("c.event_id").alias("checkpoint_id"), F.col("c.ts").alias("checkpoint_ts"))


CHECKPOINTS_SQL = """
cps AS (
  SELECT event_id AS checkpoint_id, ts AS checkpoint_ts FROM events
  QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) = 1),
axis AS (
  SELECT checkpoint_ts, row_number() OVER (ORDER BY checkpoint_ts) AS step,
    coalesce(lead(checkpoint_ts) OVER (ORDER BY checkpoint_ts), checkpoint_ts + INTERVAL 24 HOURS) AS boundary
  FROM (SELECT DISTINCT checkpoint_ts FROM cps))"""


def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a binary feeder tree: node n is fed by nodes 2n and 2n + 1; node 0 stands alone.

    Names are known for leaves and finished nodes only.
    """
    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    last = orders.agg(F.max("o_orderkey")).scalar()
    key, leaf = F.col("o_orderkey"), F.col("o_orderkey") * 2 > last
    done = F.col("o_orderstatus") == "F"
    known = leaf | done
    home, away = F.concat(F.lit("C"), F.col("o_custkey").cast("string")), F.concat(F.lit("S"), F.col("o_custkey").cast("string"))
    return orders.select(
        key.cast("string").alias("match_id"),
        F.concat(F.lit("N-"), key.cast("string")).alias("position"),
        F.when(key > 1, F.concat(F.lit("N-"), F.floor(key / 2).cast("string"))).alias("feeds_into"),
        F.when(key % 2 == 1, "Bottom").otherwise("Top").alias("side"),
        F.when(known, home).alias("home_team"),
        F.when(known, away).alias("away_team"),
        F.when(done, F.when(key % 3 == 0, away).otherwise(home)).alias("winner"),
        done.alias("is_finished"),
        F.col("o_orderpriority").alias("priority"),
    )


TREE_SQL = """
nodes AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS match_id, 'N-' || o_orderkey AS position,
    CASE WHEN o_orderkey > 1 THEN 'N-' || (o_orderkey // 2) END AS feeds_into,
    CASE WHEN o_orderkey % 2 = 1 THEN 'Bottom' ELSE 'Top' END AS side,
    CASE WHEN o_orderkey * 2 > (SELECT max(o_orderkey) FROM orders) OR o_orderstatus = 'F' THEN 'C' || o_custkey END AS home_team,
    CASE WHEN o_orderkey * 2 > (SELECT max(o_orderkey) FROM orders) OR o_orderstatus = 'F' THEN 'S' || o_custkey END AS away_team,
    CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 3 = 0 THEN 'S' ELSE 'C' END || o_custkey END AS winner,
    o_orderstatus = 'F' AS is_finished, o_orderpriority AS priority
  FROM orders)"""
