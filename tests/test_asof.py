import datetime as dt

from pyspark.sql import functions as F

from matchmill.operators.asof import asof_snapshot, build_axis, current_leaders, forward_fill, path_signature, race, race_leaders


def at(day, hour=0, second=0):
    return dt.datetime(2024, 1, day, hour, 0, second)


def frames(spark, snaps, cps):
    s = spark.createDataFrame(snaps, "id string, ts timestamp_ntz, goals int")
    c = spark.createDataFrame(cps, "cp int, cp_ts timestamp_ntz")
    return c, s


def brute(snaps, cps, fallback=24):
    times = sorted({t for _, t in cps})
    out = set()
    for cp, t in cps:
        later = [x for x in times if x > t]
        bound = later[0] if later else t + dt.timedelta(hours=fallback)
        for who in {s[0] for s in snaps}:
            seen = [s for s in snaps if s[0] == who and s[1] <= bound]
            if seen:
                out.add((cp, who, max(seen, key=lambda s: s[1])[2]))
    return out


SNAPS = [
    ("a", at(1), 1), ("a", at(3, 1), 2), ("a", at(9), 3), ("b", at(3), 1), ("b", at(4, 0, 1), 5), ("c", at(12), 1), ("d", at(30), 9),
    ("e", at(10, 0, 0), 4), ("e", at(10, 0, 1), 6),
]
CPS = [(1, at(2)), (2, at(3)), (3, at(3)), (4, at(4)), (5, at(9)), (6, at(10))]


def test_asof_boundaries_gaps_and_simultaneous_checkpoints(spark):
    for grain in ("HOUR", "DAY"):
        c, s = frames(spark, SNAPS, CPS)
        got = asof_snapshot(c, s, "id", "cp", "cp_ts", "ts", ["goals"]).select("cp", "id", "goals").collect()
        assert {tuple(r) for r in got} == brute(SNAPS, CPS)
        assert len(got) == len(brute(SNAPS, CPS))


def test_axis_boundary(spark):
    c, _ = frames(spark, SNAPS, CPS)
    axis = {r.step: (r.axis_ts, r.boundary) for r in build_axis(c, "cp_ts").collect()}
    assert axis[2] == (at(3), at(4)) and axis[5] == (at(10), at(11))


def test_race_ranks_ties_and_medals(spark, rows):
    snaps = [("a", at(1), 1), ("a", at(5), 4), ("b", at(2), 2), ("c", at(2), 2), ("z", at(2), 0)]
    cps = [(1, at(2)), (2, at(6))]
    c, s = frames(spark, snaps, cps)
    current = spark.createDataFrame([("a", 4), ("b", 2), ("c", 2), ("z", 0)], "id string, goals int")
    leaders = race_leaders(current, "id", [("goals", True)], 2)
    assert rows(leaders) == [("a",), ("b",), ("c",)]
    got = race(c, s.join(leaders, "id", "left_semi"), "id", "cp", "cp_ts", "ts", [("goals", True)])
    assert rows(got, "cp", "id", "goals", "rank_at_step", "medal", "is_latest") == [
        (1, "a", 4, 1, "🥇", False), (1, "b", 2, 2, "🥈", False), (1, "c", 2, 2, "🥈", False),
        (2, "a", 4, 1, "🥇", True), (2, "b", 2, 2, "🥈", True), (2, "c", 2, 2, "🥈", True),
    ]
    lead = current_leaders(got, "is_latest", "step", [F.col("rank_at_step"), F.col("id")])
    assert [r.id for r in lead.collect()] == ["a", "b", "c"]
    unflagged = current_leaders(got.withColumn("is_latest", F.lit(False)), "is_latest", "step", [F.col("id")])
    assert [r.id for r in unflagged.collect()] == ["a", "b", "c"]


def test_forward_fill_start_middle_end(spark, rows):
    df = spark.createDataFrame(
        [("a", at(2), 1), ("a", at(4), 3), ("b", at(1), 2), ("c", at(5), 7)], "id string, t timestamp_ntz, v int"
    )
    got = rows(forward_fill(df, "id", "t", ["v"]), "id", "step", "v")
    assert got == [
        ("a", 1, 0), ("a", 2, 1), ("a", 3, 3), ("a", 4, 3), ("b", 1, 2), ("b", 2, 2), ("b", 3, 2), ("b", 4, 2),
        ("c", 1, 0), ("c", 2, 0), ("c", 3, 0), ("c", 4, 7),
    ]


def test_path_signature_groups_equal_paths(spark, rows):
    data = [(w, s, v) for w, path in {"a": [0, 1, 1], "b": [0, 1, 1], "c": [0, 0, 0], "d": [1, 1, 2]}.items() for s, v in enumerate(path, 1)]
    got = rows(path_signature(spark.createDataFrame(data, "id string, step int, v int"), "id", "step", "v"))
    assert got == [("a", "2:1", 1), ("b", "2:1", 2), ("c", "", 1), ("d", "1:1|3:2", 1)]
