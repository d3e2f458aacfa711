"""Queries over feeds: JSON payloads made from table rows, read back, merged, keyed, gated and exported."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from matchmill.functions.text import clean_sentinels, coerce_types, safe_int
from matchmill.fixed_values import MINIMUM_ROWS
from matchmill.plans.registry import query
from matchmill.session import app_dir
from matchmill.plans.views import FIXTURES_SQL, fixtures, load
from matchmill.sources.feeds import (
    FIXTURES_FEED, RANKED_FEED, STANDINGS_FEED, VENUES_FEED, attach_key, distinct_teams, fixtures_feed, merge_feeds, parse_payload,
    ranked_feed, read_landing, row_gate, standings_feed, surrogate_keys, table_row_counts, venues_feed,
)
from matchmill.sources.sinks import json_records, write_json


def _ranked_payloads(spark, sf):
    """One payload per customer, ranking it and its twin account; the twin has no minutes."""
    customer = load(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    key, twin = F.col("c_custkey"), F.col("c_custkey") + 1_000_000_000

    def entry(slug, minutes):
        return F.struct(
            slug.cast("string").alias("player_slug"), F.col("c_name").alias("player"), F.lit(None).cast("string").alias("player_logo"),
            F.col("c_nationkey").cast("string").alias("team"), (slug % 17).alias("goals"), (slug % 5).alias("assists"),
            (slug % 7 + 1).alias("matches"), minutes.cast("long").alias("minutes"), (slug % 1000).alias("rating"),
        )

    entries = F.array(entry(key, key % 900), entry(twin, F.lit(None)))
    return customer.select(F.to_json(F.struct(entries.alias("scorers"))).alias("payload"))


RANKED_SQL = """keys AS (SELECT c_custkey AS k, c_custkey % 900 AS minutes, c_name, c_nationkey FROM customer UNION ALL SELECT c_custkey + 1000000000, 0, c_name, c_nationkey FROM customer),
ranked AS (SELECT CAST(k AS VARCHAR) AS player_slug, c_name AS player, CAST(c_nationkey AS VARCHAR) AS team, k % 17 AS goals, k % 5 AS assists, k % 7 + 1 AS matches, minutes, k % 1000 AS rating, k FROM keys)"""


@query("ingest_ranked_feed", f"WITH {RANKED_SQL} SELECT player_slug, player, CAST(NULL AS VARCHAR) AS player_logo, team, goals, assists, matches, minutes, rating FROM ranked")
def _(spark, sf):
    return ranked_feed(parse_payload(_ranked_payloads(spark, sf), "payload", RANKED_FEED))


@query("feed_merge", f"""WITH {RANKED_SQL}, a AS (SELECT * FROM ranked WHERE goals > 3), b AS (SELECT *, assists + k % 3 - 1 AS helped FROM ranked WHERE assists > 1)
  SELECT coalesce(a.player_slug, b.player_slug) AS player_slug, coalesce(a.player, b.player) AS player, coalesce(a.goals, 0) AS goals,
    greatest(coalesce(a.assists, b.helped), coalesce(b.helped, a.assists)) AS assists, coalesce(a.minutes, b.minutes) AS minutes FROM a FULL JOIN b ON a.k = b.k""")
def _(spark, sf):
    ranked = ranked_feed(parse_payload(_ranked_payloads(spark, sf), "payload", RANKED_FEED))
    columns = ["player_slug", "player", "goals", "assists", "minutes"]
    helped = F.col("assists") + F.col("player_slug").cast("long") % 3 - 1
    first = ranked.filter("goals > 3").select(*columns)
    second = ranked.filter("assists > 1").withColumn("assists", helped).select(*columns)
    return merge_feeds(first, second, "player_slug", zero=["goals"])


def _fixture_payloads(spark, sf):
    """One payload per fixture, all texts, with sentinels where a value is missing."""
    rows = fixtures(spark, sf)
    turn = F.col("match_id") % 4
    game = {
        "id": F.col("match_id").cast("string"),
        "home_team_id": F.when(turn == 0, F.lit("null")).when(turn == 1, F.lit("0")).otherwise(F.col("home_id").cast("string")),
        "away_team_id": F.col("away_id").cast("string"),
        "home_team_name_en": F.col("home_team"), "away_team_name_en": F.col("away_team"),
        "home_score": F.when(turn == 2, F.lit("null")).otherwise(F.col("home_score").cast("string")),
        "away_score": F.when(turn == 3, F.lit("n/a")).otherwise(F.col("away_score").cast("string")),
        "home_scorers": F.lit("null"), "home_penalty_score": F.col("home_pens").cast("string"),
        "home_penalty_scorers": F.lit(""), "type": F.col("stage"), "finished": F.upper(F.col("is_finished").cast("string")),
    }
    entry = F.struct(*[c.alias(n) for n, c in game.items()])
    return rows.select(F.to_json(F.struct(F.array(entry).alias("games"))).alias("payload"))


@query("ingest_fixtures", f"""WITH {FIXTURES_SQL} SELECT CAST(match_id AS VARCHAR) AS match_id,
    CASE WHEN match_id % 4 < 2 OR home_id = 0 THEN NULL ELSE CAST(home_id AS VARCHAR) END AS home_team_id, CASE WHEN away_id = 0 THEN NULL ELSE CAST(away_id AS VARCHAR) END AS away_team_id,
    home_team AS home_team_name, CASE WHEN match_id % 4 = 2 THEN 0 ELSE home_score END AS home_score, CASE WHEN match_id % 4 = 3 THEN 0 ELSE away_score END AS away_score,
    CAST(NULL AS VARCHAR) AS home_scorers, home_pens AS home_penalty_score, CAST(NULL AS VARCHAR) AS home_penalty_scorers, stage AS match_type, upper(CAST(is_finished AS VARCHAR)) AS finished FROM fx""")
def _(spark, sf):
    rows = fixtures_feed(parse_payload(_fixture_payloads(spark, sf), "payload", FIXTURES_FEED))
    return rows.select(
        "match_id", "home_team_id", "away_team_id", "home_team_name", "home_score", "away_score", "home_scorers", "home_penalty_score",
        "home_penalty_scorers", "match_type", "finished",
    )


@query("ingest_venues", "SELECT CAST(s_suppkey AS VARCHAR) AS stadium_id, s_name AS name_en, CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE CAST(s_suppkey * 10 AS INTEGER) END AS capacity FROM supplier")
def _(spark, sf):
    supplier = load(spark, sf, "supplier", "s_suppkey", "s_name")
    size = F.when(F.col("s_suppkey") % 3 == 0, F.lit("unknown")).otherwise((F.col("s_suppkey") * 10).cast("string"))
    entry = F.struct(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name_en"), size.alias("capacity"))
    payloads = supplier.select(F.to_json(F.struct(F.array(entry).alias("stadiums"))).alias("payload"))
    return venues_feed(parse_payload(payloads, "payload", VENUES_FEED)).select("stadium_id", "name_en", "capacity")


def _standings_payloads(spark, sf):
    """One payload per fixture: a table named after the stage with a row for each side."""
    rows = fixtures(spark, sf)

    def row(me, other):
        return F.struct(
            F.col(f"{me}_team").alias("team"), F.col(f"{me}_score").cast("long").alias("gf"), F.col(f"{other}_score").cast("long").alias("ga"),
            F.when(F.col(f"{me}_score") > F.col(f"{other}_score"), F.lit(3)).otherwise(F.lit(0)).cast("long").alias("pts"),
        )

    table = F.struct(F.col("stage").alias("group"), F.array(row("home", "away"), row("away", "home")).alias("rows"))
    return rows.select("match_id", F.to_json(F.struct(F.array(table).alias("tables"))).alias("payload"))


STANDINGS_SQL = f"""{FIXTURES_SQL}, st AS (
  SELECT match_id, stage AS group_name, home_team AS team_name, home_score AS goals_for, away_score AS goals_against FROM fx
  UNION ALL SELECT match_id, stage, away_team, away_score, home_score FROM fx)"""


@query("nested_flatten", f"WITH {STANDINGS_SQL} SELECT match_id, group_name, team_name, CAST(goals_for AS BIGINT) AS goals_for, CAST(goals_against AS BIGINT) AS goals_against, CASE WHEN goals_for > goals_against THEN 3 ELSE 0 END::BIGINT AS points FROM st")
def _(spark, sf):
    rows = standings_feed(parse_payload(_standings_payloads(spark, sf), "payload", STANDINGS_FEED), ["match_id"])
    return rows.select("match_id", "group_name", "team_name", "goals_for", "goals_against", "points")


@query("distinct_teams", f"WITH {STANDINGS_SQL} SELECT team_name, group_name, CAST(NULL AS VARCHAR) AS team_logo FROM st QUALIFY row_number() OVER (PARTITION BY team_name ORDER BY match_id) = 1")
def _(spark, sf):
    rows = standings_feed(parse_payload(_standings_payloads(spark, sf), "payload", STANDINGS_FEED), ["match_id"])
    return distinct_teams(rows, [F.col("match_id").asc()])


FIRST_SEEN_SQL = "ids AS (SELECT c_mktsegment || '/' || c_nationkey AS name, 'team_' || row_number() OVER (ORDER BY min(c_custkey)) AS surrogate_id FROM customer GROUP BY 1)"


@query("surrogate_keys", f"WITH {FIRST_SEEN_SQL} SELECT name, surrogate_id FROM ids")
def _(spark, sf):
    return _named_ids(spark, sf)


def _named(spark, sf):
    customer = load(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    return customer.select("c_custkey", F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("name"))


def _named_ids(spark, sf):
    return surrogate_keys(_named(spark, sf), "name", ["c_custkey"])


@query("lookup_join", f"WITH {FIRST_SEEN_SQL} SELECT c_custkey, surrogate_id FROM customer LEFT JOIN ids ON name = c_mktsegment || '/' || (c_nationkey + c_custkey % 2)")
def _(spark, sf):
    customer = load(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    wanted = F.concat_ws("/", "c_mktsegment", (F.col("c_nationkey") + F.col("c_custkey") % 2).cast("string"))
    rows = customer.select("c_custkey", wanted.alias("wanted"))
    keys = _named_ids(spark, sf).withColumnRenamed("name", "wanted")
    return attach_key(rows, keys, "wanted", "surrogate_id").select("c_custkey", "surrogate_id")


@query("safe_int_cast", "SELECT event_id, coalesce(TRY_CAST(k AS INTEGER), 0) AS k FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'null' WHEN 2 THEN 'x1' WHEN 3 THEN NULL ELSE json_extract_string(props, '$.k') END AS k FROM events)")
def _(spark, sf):
    events = load(spark, sf, "events", "event_id", "props")
    turn = F.col("event_id") % 5
    text = F.when(turn == 0, "").when(turn == 1, "null").when(turn == 2, "x1").when(turn == 4, F.get_json_object("props", "$.k"))
    return events.select("event_id", safe_int(text).alias("k"))


@query("null_sentinels", "SELECT event_id, CASE WHEN k IN ('null', '', '0') THEN NULL ELSE k END AS team_id, CASE WHEN k = 'null' THEN NULL ELSE k END AS scorers FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'null' ELSE json_extract_string(props, '$.k') END AS k FROM events)")
def _(spark, sf):
    events = load(spark, sf, "events", "event_id", "props")
    turn = F.col("event_id") % 4
    text = F.when(turn == 0, "").when(turn == 1, "null").otherwise(F.get_json_object("props", "$.k"))
    rows = events.select("event_id", text.alias("team_id"), text.alias("scorers"))
    return clean_sentinels(rows, {"team_id": ["null", "", "0"], "scorers": ["null"]})


@query("typed_coercion", """SELECT event_id, user_id, value, event_type = 'click' AS clicked, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k FROM events""")
def _(spark, sf):
    """All columns as text first, with odd booleans and unreadable numbers."""
    events = load(spark, sf, "events", "event_id", "user_id", "value", "event_type", "props")
    turn = F.col("event_id") % 3
    flag = F.when(F.col("event_type") == "click", F.when(turn == 0, " TRUE ").otherwise("true")).otherwise(F.when(turn == 1, F.lit(None)).otherwise("no"))
    number = F.when(turn == 0, F.when(F.col("event_id") % 2 == 0, "NaN").otherwise("abc")).otherwise(F.get_json_object("props", "$.k"))
    text = events.select(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id"),
        F.col("value").cast("string").alias("value"), flag.alias("clicked"), number.alias("k"),
    )
    return coerce_types(text, {"event_id": "bigint", "user_id": "bigint", "value": "number", "clicked": "boolean", "k": "number"})


@query("json_export", """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","customers":' || count(c_custkey) || ',"note":null}' AS record
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name""")
def _(spark, sf):
    nation = load(spark, sf, "nation", "n_nationkey", "n_name")
    customers = load(spark, sf, "customer", "c_nationkey").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    rows = nation.join(customers, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        "n_nationkey", "n_name", F.coalesce("customers", F.lit(0).cast("long")).alias("customers"), F.lit(None).cast("string").alias("note")
    )
    return json_records(rows)


@query("json_landing", "SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS balance FROM supplier")
def _(spark, sf):
    """Written as JSON records by the tasks and read back with a schema."""
    supplier = load(spark, sf, "supplier", "s_suppkey", "s_name", "s_acctbal")
    path = f"{app_dir(spark)}/records-{uuid.uuid4().hex}"
    balance = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal"))
    write_json(supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), balance.alias("balance")), path)
    return read_landing(spark, path, "id bigint, name string, balance double", multi_line=False)


def _tables(spark, sf):
    roles = {"players": "customer", "teams": "nation", "matches": "lineitem", "group_standings": "part", "stadiums": "region", "knockout_bracket": "orders"}
    return {role: load(spark, sf, table) for role, table in roles.items()}


COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{role}' AS table_name, count(*) AS rows, {MINIMUM_ROWS[role]}::BIGINT AS minimum, count(*) >= {MINIMUM_ROWS[role]} AS ok FROM {table}"
    for role, table in {"players": "customer", "teams": "nation", "matches": "lineitem", "group_standings": "part", "stadiums": "region", "knockout_bracket": "orders"}.items()
)


@query("row_gate_report", COUNTS_SQL)
def _(spark, sf):
    return row_gate({role: (df, MINIMUM_ROWS[role]) for role, df in _tables(spark, sf).items()})


@query("table_row_counts", f"SELECT table_name, rows FROM ({COUNTS_SQL})")
def _(spark, sf):
    return table_row_counts(_tables(spark, sf))
