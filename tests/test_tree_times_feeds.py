import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchmill.fixed_values import R32_ORDER, ROUNDS, VENUE_ZONES
from matchmill.functions.text import canonical_name, coerce_types, label_source, safe_int, search_filter, suffix_number
from matchmill.functions.times import (
    delta_label, hours_until, is_live, minutes_elapsed, parse_instant, parse_local, short_label, status_at, to_utc, with_zone, zone_to_utc,
)
from matchmill.operators.layout import cluster_layout
from matchmill.operators.quality import Check, RowRules, differing, falling, formula_off, over_budget, ratio_above, run_checks
from matchmill.operators.tree import build_tree, half_by_suffix, open_items_or_podium, podium, resolve_tree, resolve_tree_sorted
from matchmill.sources.feeds import (
    RANKED_FEED, STANDINGS_FEED, distinct_teams, merge_feeds, ranked_feed, read_landing, standings_feed, surrogate_keys,
)

NODE = "match_id string, position string, feeds_into string, side string, home_team string, away_team string, winner string, is_finished boolean"


def nodes(spark):
    return spark.createDataFrame(
        [
            ("1", "SF-1", "Final", "Top", "a", "b", "a", True), ("2", "SF-2", "Final", "Bottom", "c", "d", None, False),
            ("3", "Final", None, "Neutral", None, None, None, False), ("4", "3rd-Place", None, "Neutral", None, None, None, False),
            ("5", "QF-10", "SF-1", "Bottom", "a", "x", "a", True), ("6", "QF-9", "SF-1", "Top", "b", "y", "b", True),
        ],
        NODE,
    )


def test_resolve_tree(spark):
    got = {r.position: (r.home_display, r.away_display) for r in resolve_tree(nodes(spark)).collect()}
    assert got["Final"] == ("a", "Winner of SF-2") and got["3rd-Place"] == ("TBD", "TBD")
    assert got["SF-1"] == ("a", "b") and got["SF-2"] == ("c", "d")


def test_feeders_sort_by_number_and_half(spark):
    open_sf = nodes(spark).withColumns(
        {c: F.when(F.col("position") != "SF-1", F.col(c)) for c in ("home_team", "away_team", "winner")}
    ).withColumn("is_finished", (F.col("position") != "SF-1") & F.col("is_finished"))
    open_sf = open_sf.withColumn("winner", F.when(F.col("position") == "QF-9", "b").when(F.col("position") == "QF-10", "a").otherwise(F.col("winner")))
    got = {r.position: (r.home_display, r.away_display) for r in resolve_tree(open_sf).collect()}
    assert got["SF-1"] == ("b", "a")  # QF-9 before QF-10, as numbers
    shown = {r.position: (r.home_name, r.home_open, r.away_name, r.away_open) for r in resolve_tree_sorted(open_sf).collect()}
    assert shown["SF-1"] == ("b", False, "a", False)
    assert shown["Final"] == ("Winner of SF-1", True, "Winner of SF-2", True)


def test_finished_node_shows_its_own_names(spark):
    shown = {r.position: (r.home_name, r.away_name) for r in resolve_tree_sorted(nodes(spark)).collect()}
    assert shown["SF-1"] == ("a", "b") and shown["3rd-Place"] == ("TBD", "TBD")


def test_one_feeder_leaves_the_other_place_open(spark):
    one = nodes(spark).filter("position IN ('SF-1', 'Final')")
    got = {r.position: (r.home_display, r.away_display) for r in resolve_tree(one).collect()}
    assert got["Final"] == ("a", "TBD")


def test_half_by_suffix(spark):
    df = spark.createDataFrame([("R32-11",), ("R32-10",), ("QF-2",), ("Final",)], "p string")
    assert [r[0] for r in df.select(half_by_suffix(F.col("p"))).collect()] == ["Top", None, "Bottom", None]


def test_build_tree_with_fixed_positions_pairs_and_overrides(spark):
    data = [(m, "r32", None, None) for m in R32_ORDER]
    data += [("89", "r16", "Winner Match 77", "Winner Match 74"), ("90", "r16", "Winner Match 75", "Winner Match 73"), ("91", "r16", None, None)]
    data += [("97", "qf", "Winner Match 89", "Winner Match 90"), ("103", "third", "Loser Match 101", None), ("104", "final", "Winner Match 97", "Winner Match 102")]
    matches = spark.createDataFrame(data, "match_id string, round_code string, home_label string, away_label string")
    rounds = spark.createDataFrame([(c, p, t, o) for c, (p, t, o) in ROUNDS.items()], "round_code string, prefix string, top_half int, id_offset int")
    fixed = spark.createDataFrame([(m, f"R32-{i + 1}") for i, m in enumerate(R32_ORDER)], "match_id string, position string")
    pairs = spark.createDataFrame(
        [(R32_ORDER[2 * i], R32_ORDER[2 * i + 1], f"R16-{i + 1}") for i in range(8)], "feeder_a string, feeder_b string, position string"
    )
    moves = spark.createDataFrame([(m, f"R16-{i // 2 + 1}") for i, m in enumerate(R32_ORDER)], "match_id string, feeds_into string")
    got = {r.match_id: (r.position, r.side, r.feeds_into) for r in build_tree(matches, rounds, fixed, pairs, moves).collect()}
    assert got["73"] == ("R32-1", "Top", "R16-1") and got["86"] == ("R32-16", "Bottom", "R16-8")
    assert got["89"] == ("R16-2", "Top", "QF-1") and got["90"] == ("R16-1", "Top", "QF-1")  # by feeder set, any order
    assert got["91"] == ("R16-3", "Top", None)  # by id
    assert got["97"] == ("QF-1", "Top", "Final") and got["103"] == ("3rd-Place", "Neutral", None) and got["104"] == ("Final", "Neutral", None)


def test_podium_and_fallback(spark, rows):
    done = nodes(spark).withColumns({"winner": F.when(F.col("position") == "Final", "c").otherwise("d"), "is_finished": F.lit(True), "home_team": F.lit("c"), "away_team": F.lit("d")})
    is_final, is_third = F.col("position") == "Final", F.col("position") == "3rd-Place"
    medals = podium(done, is_final, is_third)
    assert rows(medals, "place", "participant") == [(1, "c"), (2, "d"), (3, "d")]
    assert podium(nodes(spark), is_final, is_third).count() == 0
    waiting = spark.createDataFrame([("m1",)], "label string")
    assert rows(open_items_or_podium(waiting, medals)) == [("open", "m1")]
    assert rows(open_items_or_podium(waiting.filter("false"), medals)) == [("podium", "c"), ("podium", "d"), ("podium", "d")]


NOW = dt.datetime(2026, 7, 1, 12)


def test_local_times_and_zones(spark):
    df = spark.createDataFrame([("07/01/2026 12:00 PDT", "16"), ("07/01/2026 12:00", "1"), ("13/01/2026 12:00", "1"), ("soon", "1"), (None, "1")], "t string, v string")
    hours = F.create_map(*[F.lit(x) for k, v in VENUE_ZONES.items() for x in (k, v[3])])[F.col("v")]
    got = [r[0] for r in df.select(to_utc(parse_local(F.col("t")), hours)).collect()]
    assert got == [dt.datetime(2026, 7, 1, 19), dt.datetime(2026, 7, 1, 18), None, None, None]
    local = parse_local(F.lit("07/01/2026 12:00"))
    one = spark.range(1).select(
        zone_to_utc(local, F.lit("America/Los_Angeles")), zone_to_utc(local, F.lit("America/Mexico_City")),
        with_zone(F.lit("x"), F.lit("America/Chicago")), with_zone(F.lit("x"), F.lit("Mars")),
    ).first()
    assert tuple(one) == (dt.datetime(2026, 7, 1, 19), dt.datetime(2026, 7, 1, 18), "x CDT", "x EDT")


@pytest.mark.parametrize(
    "shift, status, live, until, since",
    [
        (dt.timedelta(hours=-3, seconds=-1), "Finished", False, None, 180.0), (dt.timedelta(hours=-3), "Live", True, None, 180.0),
        (dt.timedelta(0), "Live", True, None, 0.0), (dt.timedelta(seconds=1), "Upcoming", False, 0.0, None),
        (dt.timedelta(hours=1, minutes=33), "Upcoming", False, 1.6, None),
    ],
)
def test_status(spark, shift, status, live, until, since):
    start, done, now = F.lit(NOW + shift).cast("timestamp_ntz"), F.lit(False), F.lit(NOW).cast("timestamp_ntz")
    row = spark.range(1).select(status_at(start, done, now), is_live(start, done, now), hours_until(start, now), minutes_elapsed(start, done, now)).first()
    assert tuple(row) == (status, live, until, since)


def test_late_status_can_be_named(spark):
    start, now = F.lit(NOW - dt.timedelta(days=1)).cast("timestamp_ntz"), F.lit(NOW).cast("timestamp_ntz")
    assert spark.range(1).select(status_at(start, F.lit(False), now, late="Delayed")).first()[0] == "Delayed"


def test_labels(spark):
    df = spark.createDataFrame([("2026-07-02 14:03:00",), ("2026-07-01T11:00:00.000Z",), ("2026-07-01T14:00:00+02:00",), ("never",)], "t string")
    at = parse_instant(F.col("t"))
    got = [tuple(r) for r in df.select(delta_label(at, F.lit(NOW).cast("timestamp_ntz")), short_label(at)).collect()]
    assert got == [
        ("in 1d 2h 3m", "2 July 26 14:03 UTC"), ("1h 0m ago", "1 July 26 11:00 UTC"), ("in 0m", "1 July 26 12:00 UTC"), (None, None),
    ]


def test_texts(spark):
    df = spark.createDataFrame([(t,) for t in ("7", " 7 ", "", "null", "x", "1.5", None, "99999999999")], "t string")
    assert [r[0] for r in df.select(safe_int(F.col("t"))).collect()] == [7, 7, 0, 0, 0, 0, 0, 0]
    df = spark.createDataFrame([("Winner Match 74", "R16-3"), ("Loser Match 9", "Final"), (None, None)], "a string, b string")
    assert [tuple(r) for r in df.select(label_source(F.col("a")), suffix_number(F.col("b"))).collect()] == [("74", 3), (None, 0), (None, 0)]
    assert spark.range(1).select(canonical_name(F.lit("IRAN "), {"Iran": "IR Iran"}), canonical_name(F.lit("Peru"), {})).first()[:] == ("IR Iran", "Peru")


def test_coercion(spark):
    df = spark.createDataFrame([(t, t) for t in ("true", " TRUE ", None, "", "abc", "1.5", "NaN", "Infinity", "1e3")], "b string, n string")
    got = [tuple(r) for r in coerce_types(df, {"b": "boolean", "n": "number"}).collect()]
    assert got == [(True, None), (True, None), (False, None), (False, None), (False, None), (False, 1.5), (False, None), (False, None), (False, 1000.0)]


def test_search(spark, rows):
    df = spark.createDataFrame([("Ana", None), ("bob", "ANA x"), ("cy", "d")], "a string, b string")
    assert rows(search_filter(df, ["a", "b"], "aNa")) == [("Ana", None), ("bob", "ANA x")]


def test_feeds_from_landed_files(spark, tmp_path, rows):
    (tmp_path / "f.json").write_text('{"scorers": [\n {"player_slug": "a", "goals": 3},\n {"player_slug": "b", "assists": 2}]}')
    got = ranked_feed(read_landing(spark, str(tmp_path), RANKED_FEED))
    assert rows(got, "player_slug", "goals", "assists", "minutes") == [("a", 3, 0, 0), ("b", 0, 2, 0)]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "s.json").write_text(
        '{"tables": [{"group": "A", "rows": [{"team": "x", "p": 1, "pts": 3}, {"team": "y", "p": 1}]}, {"group": "B", "rows": [{"team": "x", "p": 2}]}]}'
    )
    table = standings_feed(read_landing(spark, str(tmp_path / "s"), STANDINGS_FEED))
    assert rows(table, "group_name", "team_name", "matches_played", "points") == [("A", "x", 1, 3), ("A", "y", 1, None), ("B", "x", 2, None)]
    assert rows(distinct_teams(table, [F.col("group_name").asc()]), "team_name", "group_name") == [("x", "A"), ("y", "A")]


def test_merge_and_surrogates(spark, rows):
    a = spark.createDataFrame([("k1", "n1", 3, 1), ("k2", "n2", 2, 5)], "k string, name string, goals int, assists int")
    b = spark.createDataFrame([("k2", "other", 9, 4), ("k3", "n3", 9, 7), ("k1", "z", 0, 2)], "k string, name string, goals int, assists int")
    assert rows(merge_feeds(a, b, "k", zero=["goals"])) == [("k1", "n1", 3, 2), ("k2", "n2", 2, 5), ("k3", "n3", 0, 7)]
    seen = spark.createDataFrame([(3, "x"), (1, "y"), (2, "x"), (0, "z")], "pos int, name string")
    assert rows(surrogate_keys(seen, "name", ["pos"])) == [("x", "team_3"), ("y", "team_2"), ("z", "team_1")]


def test_checks_pass_and_fail(spark, rows):
    df = spark.createDataFrame([(1, 10, 2, 5.0), (2, 11, 2, 5.5), (3, 4, 0, None)], "id int, top int, bottom int, stored double")
    assert rows(ratio_above(df, "top", "bottom", 5.0), "id") == [(2,)] and ratio_above(df, "top", "bottom", 5.5).count() == 0
    assert formula_off(df, F.col("stored"), F.lit(5.0), 0.5).count() == 0 and rows(formula_off(df, F.col("stored"), F.lit(5.0), 0.4), "id") == [(2,)]
    assert over_budget(df, F.col("id") > 1, 2).count() == 0 and over_budget(df, F.col("id") > 1, 1).first().failing == 2
    other = df.withColumn("stored", F.when(F.col("id") != 1, F.col("stored")))
    assert rows(differing(df, other, "id", ["top", "stored"]), "id") == [(1,)]
    steps = spark.createDataFrame([("a", 1, 1), ("a", 2, 3), ("a", 25, 2), ("b", 1, 9)], "k string, t int, v int")
    assert rows(falling(steps, "k", ["t"], ["v"], F.floor(F.col("t") / 10)), "k", "t", "prev_v") == [("a", 25, 3)]


def test_report_is_empty_when_all_pass(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    label = F.col("id").cast("string")
    good = [RowRules(df, {"negative": (F.col("id") < 0, label)}), Check("none", lambda: df.filter("false"), "x")]
    assert run_checks(good).count() == 0
    bad = [RowRules(df, {"no_name": (F.col("name").isNull(), label), "small": (F.col("id") < 2, "few")}), Check("all", lambda: df, "row")]
    assert rows(run_checks(bad)) == [("all", "row", 2), ("no_name", "2", 1), ("small", "few", 1)]


def test_layout_keeps_rows_and_clusters(spark):
    df = spark.range(4000).select((F.col("id") * 37 % 100).alias("x"), (F.col("id") * 91 % 100).alias("y"), F.lit("same").alias("s"))
    out = cluster_layout(df, ["x", "y"], bits=3, files=8)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    spans = out.groupBy(F.spark_partition_id()).agg((F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy"), F.count("*").alias("n"))
    assert max(r.n for r in spans.collect()) < 1500 and min(r.dx + r.dy for r in spans.collect()) < 160


def test_layout_spreads_one_value(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("x"), F.lit(2).alias("y"))
    sizes = [r[1] for r in cluster_layout(df, ["x", "y"], files=8).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 1500
