"""Queries over the feeder tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchmill.functions.text import suffix_number
from matchmill.operators.joins import lookup_join
from matchmill.operators.tree import surplus_feeders, build_tree, half_by_suffix, open_items_or_podium, podium, resolve_tree, resolve_tree_sorted
from matchmill.plans.registry import query
from matchmill.plans.views import TREE_SQL, VENUES_SQL, load, tree_nodes, venue_zones

VENUE_LIST = f"WITH {VENUES_SQL} SELECT * FROM venues"

CHILDREN_SQL = f"""{TREE_SQL},
fed AS (
  SELECT n.*, l.position AS c1, l.winner AS w1, l.is_finished AS f1, r.position AS c2, r.winner AS w2, r.is_finished AS f2
  FROM nodes n LEFT JOIN nodes l ON l.k = n.k * 2 AND n.k > 0 LEFT JOIN nodes r ON r.k = n.k * 2 + 1 AND n.k > 0)"""


@query("tree_half", f"WITH {TREE_SQL} SELECT position, CASE WHEN right(position, 1) IN ('1', '3') THEN 'Top' WHEN right(position, 1) IN ('2', '4') THEN 'Bottom' END AS half FROM nodes")
def _(spark, sf):
    return tree_nodes(spark, sf).select("position", half_by_suffix(F.col("position")).alias("half"))


@query("tree_resolve", f"""WITH {CHILDREN_SQL} SELECT position, coalesce(home_team, w1, 'Winner of ' || c1, 'TBD') AS home_display,
  coalesce(away_team, w2, 'Winner of ' || c2, 'TBD') AS away_display FROM fed""")
def _(spark, sf):
    return resolve_tree(tree_nodes(spark, sf)).select("position", "home_display", "away_display")


@query("tree_resolve_sorted", f"""WITH {CHILDREN_SQL} SELECT position,
  CASE WHEN is_finished AND home_team IS NOT NULL THEN home_team ELSE coalesce(w1, 'Winner of ' || c1, home_team, 'TBD') END AS home_name,
  CASE WHEN is_finished AND home_team IS NOT NULL THEN FALSE WHEN w1 IS NOT NULL THEN FALSE WHEN c1 IS NOT NULL THEN TRUE ELSE home_team IS NULL END AS home_open,
  CASE WHEN is_finished AND away_team IS NOT NULL THEN away_team ELSE coalesce(w2, 'Winner of ' || c2, away_team, 'TBD') END AS away_name,
  CASE WHEN is_finished AND away_team IS NOT NULL THEN FALSE WHEN w2 IS NOT NULL THEN FALSE WHEN c2 IS NOT NULL THEN TRUE ELSE away_team IS NULL END AS away_open
  FROM fed""")
def _(spark, sf):
    return resolve_tree_sorted(tree_nodes(spark, sf)).select("position", "home_name", "home_open", "away_name", "away_open")


@query("podium", f"""WITH {TREE_SQL}, done AS (SELECT * FROM nodes WHERE is_finished AND winner IS NOT NULL)
  SELECT position, 1 AS place, winner AS participant FROM done WHERE priority = '1-URGENT'
  UNION ALL SELECT position, 2, CASE WHEN winner = home_team THEN away_team ELSE home_team END FROM done WHERE priority = '1-URGENT'
  UNION ALL SELECT position, 3, winner FROM done WHERE priority = '2-HIGH'""")
def _(spark, sf):
    """Urgent nodes stand for finals, high-priority ones for third-place fixtures."""
    return podium(tree_nodes(spark, sf), F.col("priority") == "1-URGENT", F.col("priority") == "2-HIGH")


@query("open_or_podium", f"""WITH {TREE_SQL} SELECT 'open' AS kind, position AS label FROM nodes WHERE NOT is_finished AND home_team IS NOT NULL
  UNION ALL SELECT 'podium', winner FROM nodes WHERE is_finished AND priority = '1-URGENT' AND NOT EXISTS (SELECT 1 FROM nodes WHERE NOT is_finished AND home_team IS NOT NULL)""")
def _(spark, sf):
    nodes = tree_nodes(spark, sf)
    waiting = nodes.filter("NOT is_finished AND home_team IS NOT NULL").select(F.col("position").alias("label"))
    return open_items_or_podium(waiting, podium(nodes, F.col("priority") == "1-URGENT", F.lit(False)))


@query("bracket_listing", f"""WITH {TREE_SQL} SELECT priority, CASE priority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 4 ELSE 5 END AS ordinal,
  position, feeds_into, winner, city, count(*) OVER (PARTITION BY priority) AS in_round, count(winner) OVER (PARTITION BY priority) AS decided
  FROM nodes LEFT JOIN ({VENUE_LIST}) v ON v.venue_id = CAST(k % 20 AS VARCHAR)""")
def _(spark, sf):
    nodes = tree_nodes(spark, sf)
    priority = F.col("priority")
    ordinal = (
        F.when(priority == "1-URGENT", 1).when(priority == "2-HIGH", 2).when(priority == "3-MEDIUM", 3).when(priority == "5-LOW", 4).otherwise(5)
    )
    rounds = nodes.groupBy("priority").agg(F.count(F.lit(1)).alias("in_round"), F.count("winner").alias("decided"))
    listing = nodes.join(rounds, "priority").withColumns(
        {"ordinal": ordinal, "venue_id": (F.col("match_id").cast("long") % 20).cast("string")}
    )
    listing = lookup_join(listing, venue_zones(spark), {"venue_id": "venue_id"}, {"city": "city"}).orderBy("ordinal", "position")
    return listing.select("priority", "ordinal", "position", "feeds_into", "winner", "city", "in_round", "decided")


@query("bracket_status_counts", f"""WITH {TREE_SQL} SELECT CASE WHEN is_finished THEN 'Finished' WHEN home_team IS NULL THEN 'Not Started' ELSE 'Scheduled' END AS status,
  side, count(*) AS nodes, count(winner) AS winners FROM nodes GROUP BY ALL""")
def _(spark, sf):
    status = F.when(F.col("is_finished"), "Finished").when(F.col("home_team").isNull(), "Not Started").otherwise("Scheduled")
    nodes = tree_nodes(spark, sf).groupBy(status.alias("status"), "side")
    return nodes.agg(F.count(F.lit(1)).alias("nodes"), F.count("winner").alias("winners"))


@query("progression_listing", f"WITH {TREE_SQL} SELECT position, winner, feeds_into FROM nodes WHERE winner IS NOT NULL")
def _(spark, sf):
    decided = tree_nodes(spark, sf).filter("winner IS NOT NULL")
    return decided.orderBy(suffix_number(F.col("position"))).select("position", "winner", "feeds_into")


@query("tree_build", """WITH m AS (SELECT o_orderkey AS k, CAST(floor(log2(greatest(o_orderkey, 1))) AS INTEGER) AS level, (SELECT max(o_orderkey) FROM orders) AS last FROM orders),
  placed AS (SELECT *, CAST(pow(2, level) AS BIGINT) AS first FROM m),
  named AS (SELECT *, CASE WHEN level % 2 = 1 AND k * 2 + 1 <= last THEN 'P' || level || '-' || (k - first + 1) ELSE 'L' || level || '-' || (k - first + 1) END AS position FROM placed)
  SELECT CAST(n.k AS VARCHAR) AS match_id, n.position, CASE WHEN n.level = 0 THEN 'Neutral' WHEN n.k - n.first + 1 <= n.first // 2 THEN 'Top' ELSE 'Bottom' END AS side,
    CASE WHEN n.k % 100 = 7 THEN 'moved' ELSE p.position END AS feeds_into FROM named n LEFT JOIN named p ON p.k = n.k // 2 AND n.k > 1""")
def _(spark, sf):
    """A bracket from labels: level by level, odd levels placed by their feeder pair, some pointers overridden; order 0 is a node of its own."""
    orders = load(spark, sf, "orders", "o_orderkey")
    last = orders.agg(F.max("o_orderkey")).scalar()
    key = F.col("o_orderkey")
    level = F.floor(F.log2(F.greatest(key, F.lit(1)).cast("double"))).cast("int")

    def label(child):
        return F.when((key > 0) & (child <= last), F.concat(F.lit("Winner Match "), child.cast("string")))

    matches = orders.select(
        key.cast("string").alias("match_id"), level.cast("string").alias("round_code"),
        label(key * 2 + 1).alias("home_label"), label(key * 2).alias("away_label"),
    )
    first = F.pow(F.lit(2.0), level).cast("long")
    by_level = orders.select(
        level.cast("string").alias("round_code"), F.concat(F.lit("L"), level.cast("string")).alias("prefix"),
        F.when(level > 0, F.floor(first / 2)).otherwise(F.lit(0)).cast("long").alias("top_half"), (first - 1).alias("id_offset"),
    ).distinct()
    pairs = orders.filter((level % 2 == 1) & (key * 2 + 1 <= last)).select(
        (key * 2).cast("string").alias("feeder_a"), (key * 2 + 1).cast("string").alias("feeder_b"),
        F.concat(F.lit("P"), level.cast("string"), F.lit("-"), (key - first + 1).cast("string")).alias("position"),
    )
    moved = orders.filter(key % 100 == 7).select(key.cast("string").alias("match_id"), F.lit("moved").alias("feeds_into"))
    return build_tree(matches, by_level, pairs=pairs, overrides=moved).select("match_id", "position", "side", "feeds_into")


@query("tree_surplus_feeders", f"WITH {TREE_SQL} SELECT 'P' || (k % 7) AS parent, count(*) AS feeders FROM nodes WHERE k % 3 = 1 GROUP BY ALL HAVING count(*) > 2")
def _(spark, sf):
    """Targets that more than two nodes feed, in a tree bent so that there are some."""
    k = F.col("match_id").cast("long")
    bent = tree_nodes(spark, sf).withColumn("feeds_into", F.when(k % 3 == 1, F.concat(F.lit("P"), (k % 7).cast("string"))))
    return surplus_feeders(bent)
