"""Published sets of tables, bucketed histories, folds of many snapshots, and states as intervals."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from matchmill.operators.asof import asof_intervals, expand_runs, fill_intervals, forward_fill
from matchmill.operators.history import first_load, fold_snapshots, scd2_apply
from matchmill.sources.compaction import FileRange, compact, file_ranges, overlap, plan_bins
from matchmill.sources.publication import (
    WARNING, GateError, Load, Rule, expire_manifests, read_manifest, read_published, report_rows,
)

DAY = dt.datetime(2026, 1, 1)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def values(spark, root, name, number=None):
    return sorted(r.n for r in read_published(spark, root, name, number=number)[name].collect())


def test_a_broken_write_keeps_the_whole_old_set(spark, tmp_path):
    root = str(tmp_path)
    one = Load(spark, root, "one")
    one.write("a", numbers(spark, 1, 2), 2)
    one.write("b", numbers(spark, 3))
    assert read_published(spark, root) == {}  # nothing counts before it is published
    assert one.publish() == 1
    two = Load(spark, root, "two")
    two.write("a", numbers(spark, 7))
    with pytest.raises(Exception, match="broken"):
        two.write("b", numbers(spark, 8).withColumn("n", F.raise_error(F.lit("broken")).cast("long")))
    assert (values(spark, root, "a"), values(spark, root, "b")) == ([1, 2], [3])
    three = Load(spark, root, "three")
    three.write("a", numbers(spark, 9))
    assert sorted(r.n for r in three.skip("b").collect()) == [3]
    assert three.publish() == 2
    assert (values(spark, root, "a"), values(spark, root, "b"), values(spark, root, "a", 1)) == ([9], [3], [1, 2])
    with pytest.raises(ValueError):
        three.skip("c")
    with pytest.raises(RuntimeError):  # it began before the third was published
        two.publish()
    # Old folders go once no manifest kept names them; table b's folder of the first load stays.
    gone = expire_manifests(spark, root, keep=1)
    assert len(gone) == 3 and values(spark, root, "b") == [3] and values(spark, root, "a") == [9]


def test_rules_judge_rows_while_they_are_written(spark, tmp_path, rows):
    root = str(tmp_path)
    load = Load(spark, root, "one")
    rules = {"even": Rule(F.col("n") % 2 == 1, WARNING), "some": Rule(F.col("n") > 4, allowed=1), "known": Rule(F.col("n").isNull())}
    load.write("a", numbers(spark, 1, 2, 5, None), 1, rules)
    assert {(r.rule, r.failing, r.ok) for r in load.report} == {("missing_rows", 0, True), ("even", 2, False), ("some", 1, True), ("known", 1, False)}
    with pytest.raises(GateError) as error:
        load.publish()
    assert "known" in str(error.value) and "even" not in str(error.value) and read_manifest(spark, root)["number"] == 0
    assert report_rows(spark, load.report).count() == 4
    empty = Load(spark, root, "two")
    assert empty.write("a", numbers(spark).filter("n > 1"), 0, rules).count() == 0 and empty.publish() == 1


def snapshot_rows(seed, n, keys=5):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        key = None if rng.random() < 0.1 else rng.randrange(keys)
        out.append((key, rng.choice([None, *range(6)]), rng.choice(["x", "y", None]), DAY + dt.timedelta(hours=rng.randrange(40))))
    return out


SCHEMA = "k long, a long, b string, valid_from timestamp_ntz"


def one_by_one(rows, start):
    """The rule of ``scd2_apply`` on one key's sorted snapshots, in plain Python."""
    open_, out = start, []
    for key, a, b, t in rows:
        if open_ is None:
            open_ = (a, b, t)
        elif (a, b) != open_[:2] and t > open_[2] and not (open_[0] is not None and (a is None or a < open_[0])):
            out.append((key, *open_, t, False))
            open_ = (a, b, t)
    return out, open_




@pytest.mark.parametrize("page", [1024, 3])
def test_fold_equals_single_loads(spark, rows, page):
    data = snapshot_rows(1, 160)
    first, later = snapshot_rows(2, 4), data
    first = [r for r in {r[0]: (*r[:3], DAY - dt.timedelta(days=1)) for r in first}.values()]
    history = first_load(spark.createDataFrame(first, SCHEMA), ["k"], ["a", "b"], "valid_from")
    got = fold_snapshots(history, spark.createDataFrame(later, SCHEMA), ["k"], ["a", "b"], ["a"], page=page)
    low = lambda v, least: (0, least) if v is None else (1, v)
    want = []
    for key in {r[0] for r in later}:
        own = sorted({r for r in later if r[0] == key}, key=lambda r: (low(r[1], 0), low(r[2], "")), reverse=True)
        own.sort(key=lambda r: r[3])
        start = next(((a, b, t) for k, a, b, t in first if k == key), None)
        closed, open_ = one_by_one(own, start)
        if open_ != start:
            want += [*closed, (key, *open_, None, True)]
    columns = ("k", "a", "b", "valid_from", "valid_to", "is_current")
    assert rows(got, *columns) == sorted(want, key=repr) and len(want) > 10


def test_fold_of_nothing_and_of_rows_without_time(spark):
    history = first_load(spark.createDataFrame([(1, 1, "x", DAY)], SCHEMA), ["k"], ["a", "b"], "valid_from")
    for data in ([], [(2, 1, "x", None)], [(1, 1, "x", DAY + dt.timedelta(days=1))], [(1, 0, "y", DAY + dt.timedelta(days=1))]):
        assert fold_snapshots(history, spark.createDataFrame(data, SCHEMA), ["k"], ["a", "b"], ["a"]).count() == 0


def test_only_buckets_with_a_change_are_written(spark, tmp_path, rows):
    root = str(tmp_path)
    first = spark.createDataFrame([(k, 1, "x", DAY) for k in range(40)], SCHEMA)
    load = Load(spark, root, "one")
    load.history("h", first, ["k"], ["a", "b"], ["a"], buckets=8)
    load.publish()
    before = {b: (f, sorted(glob.glob(f"{f}/*.parquet"))) for b, f in read_manifest(spark, root)["tables"]["h"]["buckets"].items()}
    second = spark.createDataFrame([(k, 2 if k == 7 else 1, "x", DAY + dt.timedelta(days=1)) for k in range(40)], SCHEMA)
    load = Load(spark, root, "two")
    load.history("h", second, ["k"], ["a", "b"], ["a"])
    load.publish()
    after = read_manifest(spark, root)["tables"]["h"]["buckets"]
    changed = [b for b in after if after[b] != before[b][0]]
    assert len(before) > 4 and len(changed) == 1
    assert all(sorted(glob.glob(f"{after[b]}/*.parquet")) == before[b][1] for b in after if b not in changed)
    history = scd2_apply(first_load(first, ["k"], ["a", "b"], "valid_from"), second, ["k"], ["a", "b"], ["a"])
    columns = ("k", "a", "b", "valid_from", "valid_to", "is_current")
    assert rows(read_published(spark, root, "h")["h"], *columns) == rows(history, *columns)
    # The same load again changes nothing, and the first manifest still has the old versions.
    load = Load(spark, root, "two")
    load.history("h", second, ["k"], ["a", "b"], ["a"])
    assert load.tables["h"]["buckets"] == after
    assert read_published(spark, root, "h", number=1)["h"].count() == 40


def test_intervals_expand_to_the_grid(spark, rows):
    rng = random.Random(9)
    data = list({(rng.randrange(4), DAY + dt.timedelta(days=rng.randrange(12))): None for _ in range(25)})
    data = [(e, t, rng.randrange(3)) for e, t in data]
    frame = spark.createDataFrame(data, "e long, t timestamp_ntz, v long")
    runs = fill_intervals(frame, "e", "t", ["v"])
    grid = forward_fill(frame, "e", "t", ["v"])
    assert rows(expand_runs(runs, frame, "e"), "e", "step", "v") == rows(grid, "e", "step", "v")
    assert runs.count() < grid.count()
    assert rows(expand_runs(runs, spark.createDataFrame([(2,)], "e long"), "e"), "e") == rows(grid.filter("e = 2"), "e")


def test_asof_intervals_at_boundaries(spark, rows):
    at = lambda h: DAY + dt.timedelta(hours=h)
    points = spark.createDataFrame([(1, at(0)), (2, at(10)), (3, at(20)), (4, at(10)), (5, None)], "id long, ts timestamp_ntz")
    snaps = spark.createDataFrame(
        [("a", at(10), 1), ("a", at(11), 2), ("a", at(12), 2), ("a", at(44), 3), ("a", at(45), 9), ("b", at(21), 5), ("b", None, 6), (None, at(1), 7)],
        "e string, t timestamp_ntz, v long")
    got = asof_intervals(points, snaps, "e", "ts", "t", ["v"])
    assert rows(got, "e", "from_step", "to_step", "v") == sorted([("a", 1, 1, 1), ("a", 2, 2, 2), ("a", 3, 3, 3), ("b", 3, 3, 5), (None, 1, 3, 7)], key=repr)
    assert asof_intervals(points, snaps.limit(0), "e", "ts", "t", ["v"]).count() == 0


def brute_overlap(files):
    known = [f for f in files if f.low is not None]
    met = sum(1 for a in known for b in known if a is not b and a.low < a.high and a.low < b.high and b.low < a.high and b.low < b.high)
    met += sum(1 for a in known for b in known if a is not b and a.low < a.high and b.low == b.high and a.low < b.low < a.high)
    return met / len(files) if files else 0.0


def test_bins_hold_what_overlaps_and_what_is_small():
    f = lambda p, size, low, high: FileRange(p, size, low, high)
    files = [f("n", 100, None, None), f("a", 100, 0, 10), f("b", 100, 10, 20), f("c", 90, 12, 30), f("d", 100, 30, 40), f("e", 5, 41, 42), f("g", 100, 50, 60)]
    assert [[x.path for x in b] for b in plan_bins(files, 100)] == [["b", "c"], ["d", "e"]]
    assert plan_bins([f("a", 1, 0, 1)], 100) == [] and plan_bins([], 100) == []
    rng = random.Random(3)
    for _ in range(50):
        some = [f(str(k), 1, low := rng.randrange(20), low + rng.randrange(1, 6)) for k in range(rng.randrange(0, 9))]
        assert overlap(some) == pytest.approx(brute_overlap(some))


def test_compaction_writes_only_what_needs_it(spark, tmp_path, rows):
    root = str(tmp_path)
    load = Load(spark, root, "one")
    data = spark.range(20_000).select(F.col("id").alias("n"), F.xxhash64("id").alias("x"), F.lit(None).cast("string").alias("s"))
    load.write("a", data.filter("n >= 10000").repartition(12, "x").unionByName(data.filter("n < 10000").coalesce(1)))
    load.publish()
    sorted_file = [f.path for f in file_ranges(load.table("a"), "n") if f.high < 10_000]
    assert len(sorted_file) == 1
    target = sum(f.size for f in file_ranges(load.table("a"), "n")) // 4
    load = Load(spark, root, "two")
    done = compact(load, "a", ["n"], target)
    assert rows(read_published(spark, root, "a")["a"].agg(F.count("*"), F.bit_xor("x"))) == rows(data.agg(F.count("*"), F.bit_xor("x")))
    load.publish()
    table = read_published(spark, root, "a")["a"]
    assert rows(table) == rows(data) and table.schema.names == data.schema.names
    assert done.files_after < done.files_before and done.rewritten == 12 and done.overlap_after == 0 < done.overlap_before
    assert sorted_file[0] in {f.path for f in file_ranges(table, "n")}
    assert compact(Load(spark, root, "three"), "a", ["n"], target).rewritten == 0
