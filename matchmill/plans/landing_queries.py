"""Queries over damaged feeds, names in other spellings, and local times at clock changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchmill.functions.times import local_time_kind, zone_instant
from matchmill.operators.names import fuzzy_join
from matchmill.plans.registry import query
from matchmill.plans.views import load
from matchmill.sources.quarantine import Level, judged_elements

LEVELS = [Level("tables", "`group` string"), Level("rows", "team string, pts bigint")]

QUARANTINE_SQL = """WITH kinds AS (SELECT c_custkey AS source, c_name AS team, c_nationkey AS pts, CASE WHEN c_custkey % 11 = 0 THEN 'cut' WHEN c_custkey % 13 = 0 THEN 'bare'
    WHEN c_custkey % 17 = 0 THEN 'worded' WHEN c_custkey % 19 = 0 THEN 'keyless' WHEN c_custkey % 23 = 0 THEN 'listless' ELSE 'good' END AS kind FROM customer)
SELECT source, '' AS place, 'unreadable payload' AS reason, CAST(NULL AS VARCHAR) AS group_name, CAST(NULL AS VARCHAR) AS team, CAST(NULL AS BIGINT) AS pts FROM kinds WHERE kind = 'cut'
UNION ALL SELECT source, '', 'list missing', NULL, NULL, NULL FROM kinds WHERE kind = 'bare'
UNION ALL SELECT source, '0', 'list missing', NULL, NULL, NULL FROM kinds WHERE kind = 'listless'
UNION ALL SELECT source, '0/0', NULL, 'A', team, pts FROM kinds WHERE kind IN ('good', 'worded', 'keyless')
UNION ALL SELECT source, '0/1', CASE kind WHEN 'worded' THEN 'unreadable element' WHEN 'keyless' THEN 'key missing' END, CASE kind WHEN 'good' THEN 'A' END,
  CASE kind WHEN 'good' THEN 'twin of ' || team END, CASE kind WHEN 'good' THEN pts + 1 END FROM kinds WHERE kind IN ('good', 'worded', 'keyless')"""


@query("ingest_quarantine", QUARANTINE_SQL)
def _(spark, sf):
    """Two-level payloads, one per customer, some of them damaged; every part is a row, good or with a reason."""
    customer = load(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    key = F.col("c_custkey")

    def row(team, pts):
        return F.concat(F.lit('{"team":'), team, F.lit(',"pts":'), pts, F.lit("}"))

    pts, name = F.col("c_nationkey").cast("string"), F.concat(F.lit('"'), "c_name", F.lit('"'))
    twin, more = F.concat(F.lit('"twin of '), "c_name", F.lit('"')), (F.col("c_nationkey") + 1).cast("string")
    second = F.when(key % 17 == 0, row(twin, F.lit('"many"'))).when(key % 19 == 0, row(F.lit("null"), more)).otherwise(row(twin, more))
    rows = F.when((key % 23 == 0) & (key % 17 != 0) & (key % 19 != 0), F.lit('"notes":"none"')).otherwise(F.concat(F.lit('"rows":['), row(name, pts), F.lit(","), second, F.lit("]")))
    whole = F.concat(F.lit('{"tables":[{"group":"A",'), rows, F.lit("}]}"))
    payload = F.when(key % 11 == 0, F.substr(whole, F.lit(1), F.length(whole) - 5)).when(key % 13 == 0, F.lit('{"note":"no tables"}')).otherwise(whole)
    judged = judged_elements(customer.select(key.alias("source"), payload.alias("payload")), LEVELS, ["team"])
    return judged.select("source", "place", "reason", F.col("item.group").alias("group_name"), "item.team", "item.pts")


# Planted spellings of a nation's name: one letter with a mark, one doubled, one dropped, two that are no match, NULL.
SPELT_SQL = """SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '  ' || replace(upper(n_name), 'A', 'Á') WHEN 1 THEN n_name || right(n_name, 1) WHEN 2 THEN substr(n_name, 2)
    WHEN 3 THEN 'x' || substr(n_name, 2) || 'zz' WHEN 4 THEN NULL WHEN 5 THEN replace(n_name, 'n', 'ñ') ELSE n_name END AS spelt
  FROM customer JOIN nation ON n_nationkey = c_nationkey"""


@query("name_fuzzy_join", f"""WITH spelt AS ({SPELT_SQL}),
  folded AS (SELECT DISTINCT spelt, trim(lower(strip_accents(spelt))) AS l FROM spelt WHERE spelt IS NOT NULL),
  best AS (SELECT spelt, n_name, levenshtein(l, lower(n_name)) AS edits FROM folded, nation WHERE levenshtein(l, lower(n_name)) <= 1
    QUALIFY row_number() OVER (PARTITION BY spelt ORDER BY levenshtein(l, lower(n_name)), lower(n_name)) = 1)
  SELECT c_custkey, spelt.spelt, n_name, edits::INT AS edits FROM spelt LEFT JOIN best USING (spelt)""")
def _(spark, sf):
    """Customers' spellings of nations, each with the nearest nation within one edit."""
    customer, nation = load(spark, sf, "customer", "c_custkey", "c_nationkey"), load(spark, sf, "nation", "n_nationkey", "n_name")
    name, turn = F.col("n_name"), F.col("c_custkey") % 7
    spelt = (
        F.when(turn == 0, F.concat(F.lit("  "), F.replace(F.upper(name), F.lit("A"), F.lit("Á")))).when(turn == 1, F.concat(name, F.right(name, F.lit(1))))
        .when(turn == 2, F.substr(name, F.lit(2))).when(turn == 3, F.concat(F.lit("x"), F.substr(name, F.lit(2)), F.lit("zz"))).when(turn == 4, F.lit(None))
        .when(turn == 5, F.replace(name, F.lit("n"), F.lit("ñ"))).otherwise(name)
    )
    rows = customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", spelt.alias("spelt"))
    return fuzzy_join(rows, nation.select("n_name"), "spelt", "n_name")


#: Zones on both sides of the ocean, with and without clock changes, and local days around changes of the year.
ZONES = ["America/Chicago", "America/Mexico_City", "Europe/Berlin", "Asia/Kolkata", "America/Los_Angeles"]
ZONES_SQL = ", ".join(f"'{z}'" for z in ZONES)


@query("zone_utc", f"""WITH given AS (SELECT event_id, list_value({ZONES_SQL})[event_id % 5 + 1] AS zone,
    (CASE event_id % 4 WHEN 0 THEN TIMESTAMP '2024-03-10 00:00:00' WHEN 1 THEN TIMESTAMP '2024-11-03 00:00:00' WHEN 2 THEN TIMESTAMP '2024-03-31 00:00:00' ELSE TIMESTAMP '2024-10-27 00:00:00' END)
      + to_minutes(CAST(event_id * 7 % 300 AS INTEGER)) AS local_time FROM events),
  hours AS (SELECT *, list_sort(list_distinct(list_filter(list_transform(range(-18 * 60, 18 * 60 + 1, 30), lambda m: local_time + to_minutes(CAST(m AS INTEGER))),
    lambda u: ((u AT TIME ZONE 'UTC') AT TIME ZONE zone) = local_time))) AS found FROM given)
  SELECT event_id, zone, local_time, CASE len(found) WHEN 0 THEN 'gap' WHEN 1 THEN 'once' ELSE 'twice' END AS kind,
    CASE WHEN len(found) > 0 THEN found[1] END AS earlier, CASE WHEN len(found) > 0 THEN found[len(found)] END AS later FROM hours""")
def _(spark, sf):
    """Local times of events on days of clock changes; times that clocks skip have no UTC time of their own."""
    key = F.col("event_id")
    day = F.element_at(F.array(*[F.lit(d).cast("timestamp_ntz") for d in ("2024-03-10", "2024-11-03", "2024-03-31", "2024-10-27")]), (key % 4 + 1).cast("int"))
    local = day + F.make_dt_interval(F.lit(0), F.lit(0), (key * 7 % 300).cast("int"), F.lit(0))
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (key % 5 + 1).cast("int"))
    rows = load(spark, sf, "events", "event_id").select("event_id", zone.alias("zone"), local.alias("local_time"))
    kind = local_time_kind(F.col("local_time"), F.col("zone"))
    real = kind != "gap"
    return rows.select(
        "event_id", "zone", "local_time", kind.alias("kind"), F.when(real, zone_instant(F.col("local_time"), F.col("zone"))).alias("earlier"),
        F.when(real, zone_instant(F.col("local_time"), F.col("zone"), later=True)).alias("later"),
    )
