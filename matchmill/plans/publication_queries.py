"""Queries over published loads, histories of many snapshots, and states as intervals."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from matchmill.operators.asof import asof_intervals, expand_runs, fill_intervals
from matchmill.operators.history import fold_snapshots
from matchmill.plans.registry import query
from matchmill.plans.snapshot_queries import ASOF_SQL, DAILY_SQL, LOADS_SQL, VERSION, _daily, _loads
from matchmill.plans.views import MEASURES, SNAPSHOTS_SQL, checkpoints, load, snapshots
from matchmill.session import app_dir
from matchmill.sources.compaction import compact, file_ranges
from matchmill.sources.publication import WARNING, GateError, Load, Rule, read_published, report_rows

TRACK = ["goals", "assists", "matches", "minutes"]


def _root(spark):
    return f"{app_dir(spark)}/published-{uuid.uuid4().hex}"


@query("publish_tables", """SELECT 'orders' AS table_name, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys, 'second' AS load FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT 'supplier', count(*), sum(s_suppkey)::BIGINT, 'first' FROM supplier UNION ALL SELECT 'part', count(*), sum(p_partkey)::BIGINT, 'second' FROM part WHERE p_partkey % 2 = 0""")
def _(spark, sf):
    """A load of three tables, a second that skips one of them, and a third that fails: readers see the second."""
    root = _root(spark)
    orders, supplier, part = load(spark, sf, "orders", "o_orderkey", "o_orderstatus"), load(spark, sf, "supplier", "s_suppkey"), load(spark, sf, "part", "p_partkey")
    for name, kept, rows in (("first", "true", 1), ("second", "o_orderstatus = 'O'", 1), ("third", "o_orderstatus = 'F'", 1 << 60)):
        now = Load(spark, root, name)
        now.write("orders", orders.filter(kept).withColumn("load", F.lit(name)))
        now.write("part", part.filter("p_partkey % 2 = 0" if name == "second" else "true").withColumn("load", F.lit(name)), rows)
        if name == "first":
            now.write("supplier", supplier.withColumn("load", F.lit(name)))
        else:
            now.skip("supplier")
        try:
            now.publish()
        except GateError:
            pass
    key = {"orders": "o_orderkey", "supplier": "s_suppkey", "part": "p_partkey"}
    parts = [
        df.groupBy("load").agg(F.count(F.lit(1)).alias("rows"), F.sum(key[name]).cast("long").alias("keys")).select(F.lit(name).alias("table_name"), "rows", "keys", "load")
        for name, df in read_published(spark, root).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("dq_gate", """WITH g AS (SELECT count_if(l_quantity > 49) AS big, count_if(l_discount > 0.09) AS cheap, count_if(l_returnflag = 'N' AND l_linestatus = 'F') AS torn FROM lineitem)
  SELECT 'lineitem' AS table_name, 'missing_rows' AS rule, 'error' AS severity, 0::BIGINT AS failing, TRUE AS ok, FALSE AS published
  UNION ALL SELECT 'lineitem', 'large_quantity', 'warning', big::BIGINT, big = 0, FALSE FROM g UNION ALL SELECT 'lineitem', 'high_discount', 'error', cheap::BIGINT, cheap = 0, FALSE FROM g
  UNION ALL SELECT 'lineitem', 'torn_status', 'error', torn::BIGINT, torn = 0, FALSE FROM g
  UNION ALL SELECT 'orders', 'orphaned_line', 'error', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)), TRUE, FALSE""")
def _(spark, sf):
    """Rules judged while the lines are written; an error keeps the load back."""
    root = _root(spark)
    lines = load(spark, sf, "lineitem", "l_orderkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    now = Load(spark, root, "only")
    written = now.write("lineitem", lines, 1, {
        "large_quantity": Rule(F.col("l_quantity") > 49, WARNING), "high_discount": Rule(F.col("l_discount") > 0.09),
        "torn_status": Rule((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")),
    })
    orders = load(spark, sf, "orders", F.col("o_orderkey").alias("l_orderkey"))
    now.check("orders", "orphaned_line", written.join(orders, "l_orderkey", "left_anti"))
    try:
        now.publish()
    except GateError:
        pass
    return report_rows(spark, now.report).withColumn("published", F.lit("lineitem" in read_published(spark, root)))


@query("scd2_bucketed", f"WITH {LOADS_SQL} SELECT {', '.join(VERSION)} FROM hist")
def _(spark, sf):
    """The history of two loads, of whose open versions only the buckets with a change are written."""
    root = _root(spark)
    for n, snapshot in enumerate(_loads(spark, sf)):
        now = Load(spark, root, f"load-{n}")
        now.history("history", snapshot, ["user_id"], MEASURES, MEASURES, buckets=16)
        now.publish()
    return read_published(spark, root)["history"].select(*VERSION)


def _many(spark, sf):
    """Every event's running totals as a snapshot; some have lost goals, some stand at the time of the one before."""
    rows = snapshots(spark, sf)
    fallen = F.when(F.col("event_id") % 7 == 0, F.greatest(F.col("goals") - 3, F.lit(0))).otherwise(F.col("goals"))
    at = F.date_trunc("HOUR", "ts").cast(rows.schema["ts"].dataType)
    return rows.select("user_id", fallen.alias("goals"), F.floor(F.col("assists") / 2).alias("assists"), at.alias("valid_from"))


MANY_SQL = f"""RECURSIVE {SNAPSHOTS_SQL},
many AS (SELECT DISTINCT user_id, CASE WHEN event_id % 7 = 0 THEN greatest(goals - 3, 0) ELSE goals END AS goals, assists // 2 AS assists, date_trunc('hour', ts) AS t FROM snaps),
told AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, goals DESC, assists DESC) AS rn FROM many),
fold(user_id, rn, goals, assists, t, taken) AS (
  SELECT user_id, rn, goals, assists, t, TRUE FROM told WHERE rn = 1
  UNION ALL
  SELECT n.user_id, n.rn, CASE WHEN ok THEN n.goals ELSE n.g0 END, CASE WHEN ok THEN n.assists ELSE n.a0 END, CASE WHEN ok THEN n.t ELSE n.t0 END, ok
  FROM (SELECT told.*, fold.goals AS g0, fold.assists AS a0, fold.t AS t0,
      (told.goals <> fold.goals OR told.assists <> fold.assists) AND told.t > fold.t AND told.goals >= fold.goals AS ok
    FROM fold JOIN told ON told.user_id = fold.user_id AND told.rn = fold.rn + 1) n),
versions AS (SELECT user_id, goals, assists, t AS valid_from, lead(t) OVER (PARTITION BY user_id ORDER BY rn) AS valid_to FROM fold WHERE taken)"""


@query("scd2_many_loads", f"WITH {MANY_SQL} SELECT user_id, goals, assists, valid_from, valid_to, valid_to IS NULL AS is_current FROM versions")
def _(spark, sf):
    """All snapshots of all users in one pass; goals are guarded."""
    rows = _many(spark, sf)
    none = spark.createDataFrame([], rows.schema).withColumns({"valid_to": F.lit(None).cast(rows.schema["valid_from"].dataType), "is_current": F.lit(True)})
    return fold_snapshots(none, rows, ["user_id"], ["goals", "assists"], ["goals"])


RUNS_SQL = """{source}, turns AS (
  SELECT *, lag(step) OVER (PARTITION BY user_id ORDER BY step) IS NULL OR {differs} AS turn FROM {table} WINDOW w AS (PARTITION BY user_id ORDER BY step)),
ends AS (SELECT *, coalesce(lead(step) OVER (PARTITION BY user_id ORDER BY step) - 1, (SELECT max(step) FROM {table})) AS to_step FROM turns WHERE turn)"""


def _runs_sql(source, table, values):
    differs = " OR ".join(f"{v} IS DISTINCT FROM lag({v}) OVER w" for v in values)
    return RUNS_SQL.format(source=source, table=table, differs=differs)


@query("asof_intervals", f"WITH {_runs_sql(ASOF_SQL, 'placed', ['goals', 'assists'])} SELECT user_id, step AS from_step, to_step, goals, assists FROM ends")
def _(spark, sf):
    return asof_intervals(checkpoints(spark, sf), snapshots(spark, sf), "user_id", "checkpoint_ts", "ts", ["goals", "assists"], [F.col("goals").desc(), F.col("assists").desc()])


@query("fill_intervals", f"WITH {_runs_sql(DAILY_SQL, 'filled', ['goals'])} SELECT user_id, step AS from_step, to_step, goals FROM ends")
def _(spark, sf):
    return fill_intervals(_daily(spark, sf), "user_id", "day", ["goals"])


@query("expanded_intervals", f"WITH {DAILY_SQL} SELECT user_id, goals, step FROM filled WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def _(spark, sf):
    """Steps spelt out for the users asked for."""
    asked = load(spark, sf, "events", "user_id", "event_type").filter("event_type = 'purchase'")
    return expand_runs(fill_intervals(_daily(spark, sf), "user_id", "day", ["goals"]), asked, "user_id")


@query("layout_compact", """SELECT count(*) AS rows, sum(event_id)::BIGINT AS keys, min(ts) AS first_ts, max(ts) AS last_ts, TRUE AS fewer_files, TRUE AS less_overlap, 0 AS rewritten_again
  FROM events""")
def _(spark, sf):
    """Events in many scattered files, compacted by time; a second run finds nothing to do."""
    root = _root(spark)
    events = load(spark, sf, "events", "event_id", "ts", "user_id", "value")
    now = Load(spark, root, "scattered")
    now.write("events", events.repartition(24, "event_id"))
    now.publish()
    target = sum(f.size for f in file_ranges(now.table("events"), "ts")) // 4
    now = Load(spark, root, "compacted")
    first = compact(now, "events", ["ts", "event_id"], target)
    now.publish()
    again = compact(Load(spark, root, "again"), "events", ["ts", "event_id"], target)
    table = read_published(spark, root)["events"]
    return table.agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").cast("long").alias("keys"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")).select(
        "*", F.lit(first.files_after < first.files_before).alias("fewer_files"), F.lit(first.overlap_after < first.overlap_before).alias("less_overlap"),
        F.lit(again.rewritten).alias("rewritten_again"))
