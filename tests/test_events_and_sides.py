import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchmill.fixed_values import NAME_ALIASES
from matchmill.functions.outcomes import is_shootout, two_party_outcome
from matchmill.operators.events import (
    detail_text, event_order, nested_rollup, packed_items, paged_rollup, parse_detail, parse_detail_list, parse_packed_events, top_actors, with_event_order,
)
from matchmill.operators.sides import participant_history, participant_totals, unpivot_sides
from matchmill.plans.marts import event_detail, participant_profile, qualification, unify_fixtures

FIXTURE = "match_id int, home_team string, away_team string, home_score int, away_score int, is_finished boolean"


def events(spark, *packed):
    data = [(i, "Turkey", "Chad", home, away) for i, (home, away) in enumerate(packed)]
    return spark.createDataFrame(data, "match_id int, home_team string, away_team string, home_events string, away_events string")


def test_parse_cases(spark):
    df = events(spark, ("""{"Ana 23'","José M. 90+2'(p)","Ana 23'"}""", None), ("{}", "null"), ("{\"broken", """{"No minute"}"""), (None, """{" ","Kim 9'"}"""))
    got = parse_packed_events(df, aliases=NAME_ALIASES).orderBy("match_id", "is_home", "ordinal").collect()
    fields = [(r.match_id, r.team, r.is_home, r.actor, r.minute, r.minute_base, r.stoppage, r.is_penalty) for r in got]
    assert fields == [
        (0, "Turkiye", True, "Ana", "23", 23, None, False),
        (0, "Turkiye", True, "José M.", "90+2", 90, 2, True),
        (0, "Turkiye", True, "Ana", "23", 23, None, False),
        (2, "Chad", False, "No minute", "", None, None, False),
        (3, "Chad", False, "Kim", "9", 9, None, False),
    ]
    assert len({r.event_id for r in got}) == 5  # equal texts keep apart


def test_short_or_sentinel_texts_hold_no_events(spark):
    df = spark.createDataFrame([("",), ("null",), (None,), ('{"a"}',), ('{"ab"}',)], "t string")
    assert [r[0] for r in df.select(packed_items(F.col("t"))).collect()] == [None, None, None, None, ["ab"]]


def test_top_actor_orders_minutes_as_numbers(spark):
    df = events(spark, ("""{"Old 9'","New 110'","Mid 85'"}""", """{"A 5'","B 1'","B 2'"}"""))
    got = {(r.is_home, r.actor, r.events) for r in top_actors(parse_packed_events(df)).collect()}
    assert got == {(True, "New", 1), (False, "B", 2)}


def rollup(spark, df, bucketed=False, **kw):
    ev = with_event_order(parse_packed_events(df))
    text = detail_text(F.col("actor"), F.col("minute"), F.col("is_penalty"))
    if bucketed:
        return paged_rollup(df.select("match_id"), ev, "match_id", "is_home", text, event_order(), F.col("minute_base"), **kw)
    return nested_rollup(df.select("match_id"), ev, "match_id", "is_home", text, event_order(), **kw)


@pytest.mark.parametrize("bucketed", [True, False])
def test_nested_rollup_order_and_filler(spark, bucketed):
    df = events(spark, ("""{"B 85'","A 9'(p)","C 90+1'"}""", None), ("null", "null"))
    got = {r.match_id: (r.home_items, r.away_items) for r in rollup(spark, df, bucketed).collect()}
    assert got == {0: (["A (9) (PEN)", "B (85)", "C (90+1)"], ["NA"]), 1: (["NA"], ["NA"])}


def test_paged_rollup_keeps_everything(spark):
    names = ",".join(f'"P{chr(97 + i % 26)} {i}\'"' for i in range(1, 90))
    df = events(spark, ("{" + names + "}", """{"X 3'"}"""))
    got = sorted(rollup(spark, df, True, page_size=10).collect(), key=lambda r: r.page)
    assert [r.page for r in got] == list(range(9))
    assert sum(len(r.home_items) for r in got) == 89 and max(len(r.home_items) for r in got) == 10
    assert [r.away_items for r in got] == [["X (3)"]] + [[]] * 8
    whole = rollup(spark, df).collect()
    assert len(whole) == 1 and len(whole[0].home_items) == 89


def test_parse_details(spark):
    texts = ["[NA]", "['NA']", "[]", "[Al B (23),Cy (77) (PEN)]", "['Al (23)', 'Cy (90+2)']", "[Al (90+2, PEN),plain]", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    items = df.select("i", F.explode(parse_detail_list(F.col("t"))).alias("e"))
    got = items.select("i", *[c.alias(n) for n, c in parse_detail(F.col("e")).items()]).orderBy("i", "name").collect()
    assert [tuple(r) for r in got] == [
        (3, "Al B", "23", False), (3, "Cy", "77", True), (4, "Al", "23", False), (4, "Cy", "90+2", False),
        (5, "Al", "90+2", True), (5, "plain", None, False),
    ]


def test_totals_both_sides_shutouts_and_absent_participants(spark):
    df = spark.createDataFrame([(1, "a", "b", 2, 0, True), (2, "b", "a", 1, 1, True), (3, "a", "c", 9, 9, False)], FIXTURE)
    got = {r.participant: r for r in participant_totals(df).collect()}
    assert set(got) == {"a", "b"}
    a = got["a"]
    assert (a.played, a.wins, a.draws, a.losses, a.goals_for, a.goals_against, a.points, a.clean_sheets) == (2, 1, 1, 0, 3, 1, 4, 1)
    assert (a.win_percentage, a.goals_per_match) == (50.0, 1.5)


def test_unpivot_reads_its_input_once(spark):
    plan = unpivot_sides(spark.createDataFrame([(1, "a", "b", 1, 0, True)], FIXTURE))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Exchange" not in plan


def test_outcomes(spark):
    schema = "n string, home_team string, home_id int, away_team string, away_id int, home_score int, away_score int, home_pens int, away_pens int, is_finished boolean"
    data = [
        ("home", "a", 1, "b", 2, 2, 1, None, None, True), ("away", "a", 1, "b", 2, 0, 1, None, None, True),
        ("pens home", "a", 1, "b", 2, 1, 1, 4, 3, True), ("pens away", "a", 1, "b", 2, 1, 1, 3, 4, True),
        ("pens tied", "a", 1, "b", 2, 1, 1, 3, 3, True), ("pending", "a", 1, "b", 2, 1, 1, None, None, True),
        ("open", "a", 1, "b", 2, 3, 0, None, None, False), ("no name", None, None, "b", 2, 3, 0, None, None, True),
    ]
    got = {r.n: (r.winner, r.winner_id, r.loser, r.loser_id, r.status) for r in two_party_outcome(spark.createDataFrame(data, schema)).collect()}
    assert got == {
        "home": ("a", 1, "b", 2, "Finished"), "away": ("b", 2, "a", 1, "Finished"),
        "pens home": ("a", 1, "b", 2, "Finished (Penalties)"), "pens away": ("b", 2, "a", 1, "Finished (Penalties)"),
        "pens tied": (None, None, None, None, "Draw (Tied Penalties)"), "pending": (None, None, None, None, "Draw (Pending Penalties)"),
        "open": (None, None, None, None, "Scheduled"), "no name": (None, None, None, None, "Not Started"),
    }


def history_frame(spark):
    schema = FIXTURE + ", kickoff timestamp_ntz, stage string, winner string, is_knockout boolean"
    return spark.createDataFrame(
        [
            (1, "a", "b", 1, 1, True, dt.datetime(2024, 1, 2), "f", "b", True), (2, "b", "a", 0, 1, True, dt.datetime(2024, 1, 1), "g", "a", False),
            (3, "c", "b", 0, 0, True, dt.datetime(2024, 1, 3), "g", None, False), (4, "a", "c", 0, 0, False, dt.datetime(2024, 1, 4), "g", None, False),
        ],
        schema,
    )


def test_history_of_one_participant(spark, rows):
    got = rows(participant_history(history_frame(spark), "a"), "match_id", "opponent", "is_home", "letter", "is_shootout")
    assert got == [(1, "b", True, "L", True), (2, "b", False, "W", False)]


def test_shootout_needs_knockout_level_and_winner(spark):
    row = spark.range(1).select(
        is_shootout(F.lit(True), F.lit(1), F.lit(1), F.lit("a")).alias("yes"), is_shootout(F.lit(False), F.lit(1), F.lit(1), F.lit("a")).alias("g"),
        is_shootout(F.lit(True), F.lit(2), F.lit(1), F.lit("a")).alias("n"),
    ).first()
    assert tuple(row) == (True, False, False)


def test_qualification_orders(spark, rows):
    df = spark.createDataFrame([(1, 3, 3), (3, 3, 3), (3, 3, 4), (3, 2, 2), (4, 0, None)], "rank int, group_played int, played int")
    status = lambda parity: qualification(F.col("rank"), F.col("group_played"), F.col("played"), parity=parity)
    got = [tuple(r) for r in df.select(status(False).alias("f"), status(True).alias("p")).collect()]
    assert got == [
        ("Qualified", "Qualified"), ("Disqualified", "Disqualified"), ("Qualified", "Disqualified"), ("In Progress", "In Progress"),
        ("Not Started", "Not Started"),
    ]


def test_unified_branches_get_typed_nulls_and_canonical_names(spark):
    group = spark.createDataFrame([(1, "Iran", "USA", "Iran", "A")], "match_id int, home_team string, away_team string, winner string, group_name string")
    cup = spark.createDataFrame([(2, "Ivory Coast", " turkey", None, "R32-1")], "match_id int, home_team string, away_team string, winner string, position string")
    out = unify_fixtures({"group": group, "r32": cup}, NAME_ALIASES)
    assert dict(out.dtypes)["position"] == "string"
    assert {tuple(r) for r in out.select("match_id", "home_team", "away_team", "winner", "stage", "group_name", "position").collect()} == {
        (1, "IR Iran", "USA", "IR Iran", "Group Stage", "A", None), (2, "Cote d'Ivoire", "Turkiye", None, "Round of 32", None, "R32-1"),
    }


def test_profile_of_a_team_without_fixtures(spark):
    teams = spark.createDataFrame([("a", "A"), ("z", "A")], "participant string, group_name string")
    ranks = spark.createDataFrame([("a", 1, 2, 4)], "participant string, rank_in_group int, group_played int, group_points int")
    ev = spark.createDataFrame([("a", "Ann")], "team string, actor string")
    assists = spark.createDataFrame([("a", "Bea", 2), ("a", "Abe", 2)], "participant string, provider string, assists int")
    got = {r.participant: r for r in participant_profile(teams, history_frame(spark), ranks, ev, assists).collect()}
    assert (got["a"].top_scorer, got["a"].top_assister, got["a"].current_stage, got["a"].qualification) == ("Ann", "Abe", "f", "Qualified")
    z = got["z"]
    assert (z.played, z.points, z.current_stage, z.qualification, z.top_scorer) == (0, 0, "Group Stage", "Not Started", None)


def test_event_detail_result_is_from_the_side_not_the_id(spark):
    df = history_frame(spark).withColumns({"venue_id": F.lit("1"), "home_events": F.lit("""{"P 1'","Q 90+1'","R 2'(p)"}"""), "away_events": F.lit("null")})
    venues = spark.createDataFrame([("1", "Town", "Land")], "venue_id string, city string, country string")
    got = event_detail(parse_packed_events(df), df, venues).orderBy("match_id", "number_in_match").collect()
    assert [(r.match_id, r.actor, r.result, r.opponent, r.number_in_match, r.icon) for r in got if r.match_id == 2] == [
        (2, "P", "Loss", "a", 1, "⚽"), (2, "R", "Loss", "a", 2, "⚽ (PEN)"), (2, "Q", "Loss", "a", 3, "⚽"),
    ]
    assert [r.number_overall for r in got if r.team == "b"] == [1, 2, 3]
    away = event_detail(parse_packed_events(df), df, venues.filter("false")).collect()
    assert len(away) == len(got) and all(r.city is None for r in away)  # an unknown venue hides no event
