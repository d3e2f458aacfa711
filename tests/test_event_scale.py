"""Event queries move and keep no more than their results need."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from matchmill.operators.events import (
    detail_text, event_fields, event_order, event_sequences, nested_lists, nested_rollup, numbered_events, packed_items, packed_sequences, parse_detail, parse_detail_list, parse_packed_events, top_actor, top_actors, with_event_order,
)
from matchmill.functions.text import canonical_name
from matchmill.plans import suites, views

SF = "/root/testdata/sf0.001"


def _never(*args, **kwargs):
    raise AssertionError("rows of single events were written")


def test_performance_suite_writes_no_single_events(spark, monkeypatch):
    monkeypatch.setattr("matchmill.operators.events.stage", _never)
    assert entry.queries()["dq_performance"](spark, SF).count() > 0


def test_performance_suite_counts_events_of_repeated_and_unknown_fixtures(spark):
    profile = spark.createDataFrame([("A", "x", 1, 1, 1, 1)], "participant string, logo string, played int, goals_for int, goals_against int, points int")
    detail = spark.createDataFrame(
        [(1, "A", "Kim", 3, "B"), (1, "A", " ", 4, "B"), (2, "A", "Kim", None, "B"), (2, "A", "Kim", 5, "B"), (None, "A", None, 5, "B")],
        "match_id int, team string, actor string, minute_base int, opponent string")
    known = spark.createDataFrame([(1,), (1,)], "match_id int")
    got = {tuple(r) for r in suites.performance_suite(profile, detail, known).collect()}
    assert got == {("incomplete_event", "A", 3), ("orphaned_event", "2", 2)}


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


ODD = [
    ("""{"Ana 23'","José M. 90+2'(p)","Ana 23'"}""", None), ("{}", "null"), ('{"broken', """{"No minute"}"""), (None, """{" ","Kim 9'"}"""),
    ('{"A, B 5\'", "C 6\'"}', '{"say \\"hi\\" 7\'","D 8\'"}'), ('{"A 5\'"}\n', '{"A 1\'","B 1\'","A 2\'",",","A"}'), ('{"A 99999999999\'","B 45+\'"}', '{A,B 12}'),
    ("{" + ",".join(f'"P{i % 7}x {i % 90}\'"' for i in range(900)) + "}", '{"A {x} 5\'","B [y] 6\'"}'),
]


def _odd(spark):
    data = [(i, "Turkey", "Chad", home, away) for i, (home, away) in enumerate(ODD)]
    return spark.createDataFrame(data, "match_id int, home_team string, away_team string, home_events string, away_events string")


def test_plain_lists_read_as_json(spark):
    texts = spark.createDataFrame([(t,) for pair in ODD for t in pair], "t string")
    usable = F.col("t").isNotNull() & (F.col("t") != "null") & (F.length("t") > 5)
    json = F.when(usable, F.from_json(F.translate("t", "{}", "[]"), "array<string>"))
    assert all(r[0] == r[1] for r in texts.select(packed_items(F.col("t")), json).collect())


def test_generators_hold_ready_lists(spark):
    """What stands in a generator is not compiled."""
    plan = parse_packed_events(_odd(spark), aliases={"Turkey": "T"})._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "Generate" in line]
    assert len(lines) == 2 and not any("from_json" in line or "RLIKE" in line or "lower" in line for line in lines)


def test_quotes_inside_lists_are_read_as_json(spark):
    odd = ['{"A",","B"}', '{"A","","B"}', '{"","B 1\'"}', '{"A" ,"B"}', '{"A\x01B"}', '{"A"}"}', '{"A","B}', '{"' + "A" * 5000 + '"}']
    texts = spark.createDataFrame([(t,) for t in odd], "t string")
    json = F.from_json(F.translate("t", "{}", "[]"), "array<string>")
    assert all(r[0] == r[1] for r in texts.select(packed_items(F.col("t")), json).collect())


def test_names_end_at_the_first_digit(spark):
    texts = ["Ana 23'", "45+2 Kim", "No digit", "A\nB 7 8", " 9", "Ü 3+", "a1b1"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    fields = event_fields(F.col("t"))
    plain = F.trim(F.regexp_extract("t", r"^([^0-9]+)", 1)), F.regexp_extract("t", r"([0-9]+(?:\+[0-9]+)?)", 1)
    assert all(r[0] == r[2] and r[1] == r[3] for r in rows.select(fields["actor"], fields["minute"], *plain).collect())


def test_aliases_of_any_length_and_case(spark):
    names = ["NATION_4", " nation_4 ", "Nation_10", "İran", "ÇAD", "", None]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in rows.select(canonical_name(F.col("n"), {"Nation_4": "E", "çad": "C", "İran": "I"})).collect()]
    assert got == ["E", "E", "Nation_10", "I", "C", "", None]


def test_texts_of_any_number_of_events(spark, monkeypatch):
    data = [(i, i, 30 - i, 7 * i, 5 * i, i + 3) for i in range(31)]
    rows = spark.createDataFrame(data, "match_id long, home_score int, away_score int, part_key long, supp_key long, quantity int")
    part = spark.createDataFrame([(7 * i, f"part {chr(97 + i % 26)}") for i in range(31)], "p_partkey long, p_name string")
    monkeypatch.setattr(views, "load", lambda *_: part)
    spelt = views.with_packed_events(spark, SF, rows)
    monkeypatch.setattr(views, "SPELT_OUT", 0)
    listed = views.with_packed_events(spark, SF, rows)
    assert spelt.count() == 31 and sorted(spelt.collect()) == sorted(listed.collect())


def test_lists_of_a_fixture_need_no_shuffle(spark):
    df = _odd(spark)
    events = with_event_order(parse_packed_events(df))
    text = detail_text(F.col("actor"), F.col("minute"), F.col("is_penalty"))
    grouped = nested_rollup(df.select("match_id"), events, "match_id", "is_home", text, event_order())
    own = nested_lists(df)
    assert _shuffles(own) == 0 < _shuffles(grouped)
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, grouped.collect()))


def _numbered(spark, df):
    events = parse_packed_events(df, keep=["kickoff"])
    return event_sequences(events).select("match_id", "team", "ordinal", "number_in_match", "number_overall")


def test_texts_number_their_own_events(spark):
    df = _odd(spark).withColumn("kickoff", F.expr("timestamp_ntz'2024-01-01 10:30:00' + make_dt_interval(0, 7 - match_id % 3)"))
    all_numbers = sorted(map(tuple, _numbered(spark, df).collect()), key=repr)
    assert sorted(map(tuple, packed_sequences(df).collect()), key=repr) == all_numbers
    own = numbered_events(df, keep=["kickoff"])
    assert _shuffles(own) == 0
    assert sorted(map(tuple, own.select("match_id", "team", "ordinal", "number_in_match").collect()), key=repr) == [r[:4] for r in all_numbers]
    plain = parse_packed_events(df, keep=["kickoff"])
    assert sorted(map(tuple, own.drop("number_in_match").collect()), key=repr) == sorted(map(tuple, plain.drop("event_id", "raw").collect()), key=repr)


def _depths(df, sign):
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return [len(line) - len(line.lstrip(" :+-")) for line in lines if sign in line]


def test_details_are_numbered_without_a_window_over_events(spark):
    detail = entry.queries()["event_detail"](spark, SF)
    assert min(_depths(detail, "Window")) > min(_depths(detail, "home_events"))


def test_sequences_write_a_row_per_side(spark, monkeypatch):
    from matchmill.operators import events

    real, written = events.stage, []
    monkeypatch.setattr(events, "stage", lambda df, label: written.append(real(df, label)) or written[-1])
    rows = entry.queries()["event_sequences"](spark, SF)
    assert len(written) == 1 and written[0].count() == rows.select("match_id", "team").distinct().count() < rows.count()


def test_schedule_joins_move_no_texts(spark):
    schedule = entry.queries()["schedule_fact"](spark, SF)
    # The joins with the venues and the tree stand above the lines that make the texts.
    assert max(_depths(schedule, "Join LeftOuter")) < min(_depths(schedule, "home_events"))


def test_top_actor_of_a_text_is_that_of_its_events(spark):
    df = _odd(spark)
    tops = df.select("match_id", F.explode(F.array(
        F.struct(F.lit(True).alias("h"), top_actor(F.col("home_events")).alias("t")), F.struct(F.lit(False).alias("h"), top_actor(F.col("away_events")).alias("t")))).alias("s"))
    own = tops.filter("s.t IS NOT NULL").selectExpr("match_id", "s.h", "s.t.actor", "-s.t.fewer")
    assert _shuffles(own) == 0
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, top_actors(parse_packed_events(df)).select("match_id", "is_home", "actor", "events").collect()))


@pytest.mark.parametrize("text, entries", [
    ("[a (1),b (2, PEN),c (3]", ["a (1)", "b (2, PEN)", "c (3"]), ("[((a),b),c]", ["((a),b)", "c"]), ("['a (1)', 'b (45+2) (PEN)']", ["a (1)", "b (45+2) (PEN)"]), ("['NA']", []),
])
def test_entries_go_on_while_brackets_are_open(spark, text, entries):
    assert spark.range(1).select(parse_detail_list(F.lit(text))).first()[0] == entries


@pytest.mark.parametrize("entry, parsed", [
    ("Ana (45+2) (PEN)", ("Ana", "45+2", True)), ("Ana (7)", ("Ana", "7", False)), ("Ana (7)\n", ("Ana (7)\n", None, False)), ("Ana (7) (pen)", ("Ana", "7", True)),
    ("A (b) (7)", ("A (b)", "7", False)), ("(7)", ("", "7", False)),
])
def test_plain_details_read_as_others(spark, entry, parsed):
    fields = parse_detail(F.col("e"))
    assert tuple(spark.createDataFrame([(entry,)], "e string").select(*[c.alias(n) for n, c in fields.items()]).first()) == parsed


@pytest.mark.parametrize("name", ["event_detail", "nested_rollup", "detail_parse", "top1_per_group", "schedule_fact"])
def test_queries_write_no_events(spark, monkeypatch, name):
    monkeypatch.setattr("matchmill.operators.events.stage", _never)
    monkeypatch.setattr("matchmill.plans.event_queries.stage", _never)
    entry.queries()[name](spark, SF)


@pytest.mark.parametrize("name, held", [("event_sequences", {"raw", "event_id", "actor"}), ("kpi_summary", {"home_events", "away_events"}), ("participant_profile", {"home_events", "away_events"})])
def test_staged_rows_are_narrow(spark, monkeypatch, name, held):
    for module in ("matchmill.operators.events", "matchmill.plans.event_queries"):
        real = __import__(module, fromlist=["stage"]).stage

        def narrow(df, label, real=real):
            assert not held & set(df.columns)
            return real(df, label)

        monkeypatch.setattr(f"{module}.stage", narrow)
    assert entry.queries()[name](spark, SF).count() > 0


def test_leaderboard_writes_pairs_not_events(spark, monkeypatch):
    from matchmill.plans import snapshot_queries

    real, rows = snapshot_queries.stage, []

    def counted(df, label):
        out = real(df, label)
        rows.append(set(out.columns))
        return out

    monkeypatch.setattr(snapshot_queries, "stage", counted)
    assert entry.queries()["actor_leaderboard"](spark, SF).count() == 10
    assert rows == [{"actor", "team", "opponent", "against", "penalties", "minutes"}]
