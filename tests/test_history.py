import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchmill.operators.history import detect_changes, retention_prune, scd2_apply, scd2_asof
from matchmill.sources.sinks import RowGateError, load_history, overwrite_table, read_history, save_all_or_nothing, write_json
from matchmill.streaming.history import stream_history

SCHEMA = "id string, goals int, rating int, valid_from timestamp_ntz"
RULE = {"keys": ["id"], "track": ["goals", "rating"], "monotone": ["goals"]}


def day(n):
    return dt.datetime(2024, 1, n)


def snap(spark, n, *values):
    return spark.createDataFrame([(k, g, r, day(n)) for k, g, r in values], SCHEMA)


def state(df):
    picked = df.select("id", "goals", "rating", "valid_from", "valid_to", "is_current")
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: (r[0], r[3]))


def test_scd2_cases(spark):
    history = scd2_apply(None, snap(spark, 1, ("same", 1, 1), ("up", 1, 1), ("down", 5, 1), ("nul", None, 1), ("rate", 2, 9), ("gone", 3, 3)), **RULE)
    second = snap(spark, 2, ("same", 1, 1), ("up", 2, 1), ("down", 4, 1), ("nul", 1, 1), ("rate", 2, 8), ("new", 1, 1))
    events = {r.id: r.event for r in detect_changes(history, second, valid_from="valid_from", **RULE).collect()}
    assert events == {"same": "same", "up": "changed", "down": "regressed", "nul": "changed", "rate": "changed", "new": "new"}
    got = state(scd2_apply(history, second, **RULE))
    assert ("up", 1, 1, day(1), day(2), False) in got and ("up", 2, 1, day(2), None, True) in got
    assert ("down", 5, 1, day(1), None, True) in got and not [r for r in got if r[0] == "down" and r[1] == 4]
    assert ("rate", 2, 9, day(1), day(2), False) in got and ("gone", 3, 3, day(1), None, True) in got
    assert len(got) == 6 + 4


def test_vanished_value_is_a_regression_and_old_snapshot_is_late(spark):
    history = scd2_apply(None, snap(spark, 5, ("a", 1, 1), ("b", 1, 1)), **RULE)
    gone = detect_changes(history, snap(spark, 6, ("a", None, 1)), valid_from="valid_from", **RULE).first().event
    late = detect_changes(history, snap(spark, 4, ("b", 7, 1)), valid_from="valid_from", **RULE).first().event
    assert (gone, late) == ("regressed", "late")


def test_one_or_many_loads_give_the_same_current_state(spark):
    loads = [snap(spark, n, ("a", n, n % 3), ("b", n // 2, 1)) for n in range(1, 6)]
    many = None
    for load in loads:
        many = scd2_apply(many, load, **RULE)
    one = scd2_apply(scd2_apply(None, loads[0], **RULE), loads[-1], **RULE)
    pick = lambda df: sorted((r.id, r.goals, r.rating) for r in scd2_asof(df, F.lit(day(9))).collect())
    assert pick(many) == pick(one)
    versions = [r for r in state(many) if r[0] == "a"]
    assert [r[4] for r in versions] == [r[3] for r in versions[1:]] + [None]  # no gaps, no overlaps


def test_repeated_load_changes_nothing(spark):
    first, second = snap(spark, 1, ("a", 1, 1)), snap(spark, 2, ("a", 2, 1))
    once = scd2_apply(scd2_apply(None, first, **RULE), second, **RULE)
    assert state(scd2_apply(once, second, **RULE)) == state(once)


def test_retention(spark):
    history = scd2_apply(scd2_apply(None, snap(spark, 1, ("a", 1, 1)), **RULE), snap(spark, 2, ("a", 2, 1)), **RULE)
    assert retention_prune(history, F.lit(dt.datetime(2024, 1, 9))).count() == 2
    assert retention_prune(history, F.lit(dt.datetime(2024, 1, 9, 0, 0, 1))).count() == 1


def test_history_table_rewrites_only_open_versions(spark, tmp_path):
    path = str(tmp_path / "history")
    loads = [snap(spark, n, ("a", n, 1), ("b", 1, 1)) for n in (1, 2, 3)]
    expected = None
    for n, load in enumerate(loads):
        load_history(spark, path, load, RULE["keys"], RULE["track"], RULE["monotone"], f"load-{n}", exists=n > 0)
        expected = scd2_apply(expected, load, **RULE)
        load_history(spark, path, load, RULE["keys"], RULE["track"], RULE["monotone"], f"load-{n}")  # a repeated load
    assert state(read_history(spark, path)) == state(expected)


def test_stream_equals_batch(spark, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "table")
    expected = None
    for n in (1, 2, 3):
        batch = snap(spark, n, ("a", n, 1), ("b", 4 - n, 1))
        batch.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(batch.schema).parquet(landing)
        run = stream_history(stream, path, str(tmp_path / "cp"), RULE["keys"], RULE["track"], RULE["monotone"], "valid_from", n > 1)
        run.awaitTermination(120)
        expected = scd2_apply(expected, batch, **RULE)
    assert state(read_history(spark, path)) == state(expected)


def test_all_or_nothing(spark, tmp_path):
    good, small = spark.range(10), spark.range(3)
    with pytest.raises(RowGateError, match="b: 3 < 5"):
        save_all_or_nothing({"a": (good, 5), "b": (small, 5)}, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    save_all_or_nothing({"a": (good, 10), "b": (small, 3), "skipped": (None, 1)}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "a")).count() == 10


def test_overwrite_may_read_its_own_target_and_change_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(4), path)
    overwrite_table(spark.read.parquet(path).withColumn("twice", F.col("id") * 2), path, reads_target=True)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(i, i * 2) for i in range(4)]


def test_json_keeps_null_fields(spark, tmp_path):
    write_json(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":1,"b":null}'


def test_stream_keeps_every_snapshot_of_a_batch(spark, tmp_path):
    """Three snapshots in one micro-batch give the versions of three batches, and rows of one time count once."""
    landing, path = str(tmp_path / "landing"), str(tmp_path / "table")
    expected, loads = None, [snap(spark, n, ("a", n, 1), ("b", 1 if n < 3 else 5, 1)) for n in (1, 2, 3)]
    for load in loads:
        load.coalesce(1).write.mode("append").parquet(landing)
        load.coalesce(1).write.mode("append").parquet(landing)
        expected = scd2_apply(expected, load, **RULE)
    stream = spark.readStream.schema(loads[0].schema).parquet(landing)
    stream_history(stream, path, str(tmp_path / "cp"), RULE["keys"], RULE["track"], RULE["monotone"], "valid_from", False).awaitTermination(180)
    assert state(read_history(spark, path)) == state(expected)


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    path, expected = str(tmp_path / "table"), None
    for n in (1, 2, 3):
        load, landing = snap(spark, n, ("a", n, 1)), str(tmp_path / f"landing-{n}")
        load.coalesce(1).write.parquet(landing)
        stream = spark.readStream.schema(load.schema).parquet(landing)
        run = stream_history(stream, path, str(tmp_path / f"cp-{n}"), RULE["keys"], RULE["track"], RULE["monotone"], "valid_from", n > 1)
        run.awaitTermination(180)
        expected = scd2_apply(expected, load, **RULE)
    assert state(read_history(spark, path)) == state(expected)
