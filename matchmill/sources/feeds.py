"""Landed JSON feeds to flat tables: explicit schemas, two-level lists, feed merge, surrogate ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill.functions.text import null_tokens, safe_int, whole_or_null
from matchmill.operators.dedup import top_rows
from matchmill.operators.scan import global_row_number

RANKED_FEED = "scorers array<struct<player_slug:string,player:string,player_logo:string,team:string,goals:bigint,assists:bigint,matches:bigint,minutes:bigint,rating:bigint>>"
STANDINGS_FEED = (
    "tables array<struct<`group`:string,rows:array<struct<team:string,team_logo:string,p:bigint,w:bigint,d:bigint,"
    "l:bigint,gf:bigint,ga:bigint,gd:bigint,pts:bigint>>>>"
)
VENUES_FEED = "stadiums array<struct<id:string,name_en:string,name_fa:string,fifa_name:string,city_en:string,country_en:string,capacity:string>>"
FIXTURES_FEED = (
    "games array<struct<id:string,home_team_id:string,away_team_id:string,home_team_name_en:string,away_team_name_en:string,"
    "home_score:string,away_score:string,home_scorers:string,away_scorers:string,home_penalty_score:string,"
    "away_penalty_score:string,home_penalty_scorers:string,away_penalty_scorers:string,home_penalty_misses:string,"
    "away_penalty_misses:string,`group`:string,matchday:string,type:string,local_date:string,stadium_id:string,"
    "finished:string,time_elapsed:string,home_team_label:string,away_team_label:string>>"
)

# Texts that mean "nothing" in each kind of column.
NO_ID = ["null", "", "0"]
NO_EVENTS = ["null"]
NO_PENALTIES = ["null", ""]


def read_landing(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = True) -> DataFrame:
    """A folder of JSON files with an explicit schema; many files are read in parallel."""
    return spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(path)


def parse_payload(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Payload texts in a column to their struct's fields."""
    return df.withColumn("_payload", F.from_json(column, schema)).select(*[c for c in df.columns if c != column], "_payload.*")


def explode_feed(payloads: DataFrame, path: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of a nested list; each further name in ``path`` opens a list inside the row before.

    Scalar fields of the outer levels stay beside the innermost fields.
    """
    df = payloads.select(*keep, F.explode(path[0]).alias("_row"))
    kept = list(keep)
    for name in path[1:]:
        fields = [f.name for f in df.schema["_row"].dataType.fields if f.name != name]
        df = df.select(*kept, *[F.col("_row")[f].alias(f) for f in fields], F.explode(F.col("_row")[name]).alias("_row"))
        kept += fields
    return df.select(*kept, "_row.*")


def ranked_feed(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per ranked player; missing numbers are 0."""
    return ranked_rows(explode_feed(payloads, ["scorers"], keep))


def ranked_rows(rows: DataFrame) -> DataFrame:
    """Elements of a ranked list with 0 for missing numbers."""
    numbers = ["goals", "assists", "matches", "minutes", "rating"]
    return rows.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in numbers})


def fixtures_feed(payloads: DataFrame) -> DataFrame:
    """One row per fixture with safe numbers and NULL for sentinels.

    A missing penalty score stays NULL: it means "no shoot-out yet", not 0.
    """
    return fixture_rows(explode_feed(payloads, ["games"]))


def fixture_rows(rows: DataFrame) -> DataFrame:
    """Elements of a fixture list, typed and named as ``fixtures_feed`` says."""
    out = {c: safe_int(F.col(c)) for c in ("home_score", "away_score")}
    out |= {c: whole_or_null(F.col(c)) for c in ("home_penalty_score", "away_penalty_score")}
    out |= {c: null_tokens(F.col(c), NO_ID) for c in ("home_team_id", "away_team_id")}
    out |= {c: null_tokens(F.col(c), NO_EVENTS) for c in ("home_scorers", "away_scorers")}
    for part in ("scorers", "misses"):
        out |= {f"{s}_penalty_{part}": null_tokens(F.col(f"{s}_penalty_{part}"), NO_PENALTIES) for s in ("home", "away")}
    renames = {
        "id": "match_id", "home_team_name_en": "home_team_name", "away_team_name_en": "away_team_name", "type": "match_type"
    }
    return rows.withColumns(out).withColumnsRenamed(renames)


def venues_feed(payloads: DataFrame) -> DataFrame:
    return venue_rows(explode_feed(payloads, ["stadiums"]))


def venue_rows(rows: DataFrame) -> DataFrame:
    """Elements of a venue list with a safe capacity."""
    return rows.withColumn("capacity", safe_int(F.col("capacity"))).withColumnRenamed("id", "stadium_id")


def standings_feed(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Standings rows of the two-level list, short codes spelt out."""
    return standing_rows(explode_feed(payloads, ["tables", "rows"], keep))


def standing_rows(rows: DataFrame) -> DataFrame:
    """Elements of a standings list, short codes spelt out."""
    names = {
        "group": "group_name", "team": "team_name", "p": "matches_played", "w": "wins", "d": "draws", "l": "losses",
        "gf": "goals_for", "ga": "goals_against", "gd": "goal_difference", "pts": "points",
    }
    return rows.withColumnsRenamed(names)


def distinct_teams(standings: DataFrame, order: Sequence[Column]) -> DataFrame:
    """One row per team name, its first by ``order``."""
    return top_rows(standings, ["team_name"], order).select("team_name", "group_name", "team_logo")


def merge_feeds(
    first: DataFrame, second: DataFrame, key: str, greatest: Sequence[str] = ("assists",), zero: Sequence[str] = ()
) -> DataFrame:
    """One row per key of two feeds (one row per key each).

    The first feed's values win, ``greatest`` columns take the larger one, keys only the second feed has
    are added, with 0 in the ``zero`` columns.
    """
    columns = [c for c in first.columns if c != key]
    left = first.select(key, F.struct(*columns).alias("a"))
    right = second.select(key, F.struct(*[c for c in columns if c in second.columns]).alias("b"))
    both = left.join(right, key, "full_outer")
    in_first = F.col("a").isNotNull()
    out = []
    for c in columns:
        has = c in second.columns
        if c in greatest and has:
            value = F.greatest(f"a.{c}", f"b.{c}")
        elif c in zero or not has:
            value = F.when(in_first, F.col(f"a.{c}")).otherwise(F.lit(0).cast(first.schema[c].dataType))
        else:
            value = F.when(in_first, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}"))
        out.append(value.alias(c))
    return both.select(key, *out)


def surrogate_keys(df: DataFrame, name: str, seen: Sequence[str], prefix: str = "team_") -> DataFrame:
    """(name, id): ids ``<prefix>1``, ``<prefix>2``, ... by where a name first occurs (``seen``, ascending)."""
    if len(seen) == 1:
        flat = df.groupBy(name).agg(F.min(seen[0]).alias("_o0"))
    else:
        first = df.groupBy(name).agg(F.min(F.struct(*seen)).alias("_first"))
        flat = first.select(name, *[F.col(f"_first.{c}").alias(f"_o{i}") for i, c in enumerate(seen)])
    numbered = global_row_number(flat, [*[f"_o{i}" for i in range(len(seen))], name], "_n")
    return numbered.select(name, F.concat(F.lit(prefix), F.col("_n").cast("string")).alias("surrogate_id"))


def attach_key(df: DataFrame, keys: DataFrame, name: str, key: str) -> DataFrame:
    """The key of each row's name, NULL for an unknown name; a name with several keys takes the smallest."""
    one = keys.groupBy(F.col(name).alias("_name")).agg(F.min(key).alias(key))
    return df.join(one, F.col(name) == F.col("_name"), "left").drop("_name")


def row_gate(tables: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """(table_name, rows, minimum, ok) for each table."""
    reports = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(minimum).cast("long").alias("minimum"),
            (F.col("rows") >= minimum).alias("ok"),
        )
        for name, (df, minimum) in tables.items()
    ]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return row_gate({name: (df, 0) for name, df in tables.items()}).select("table_name", "rows")
