import pytest
from pyspark.sql import functions as F

from matchmill.operators.dedup import dedup_latest, top_rows, valid_keys
from matchmill.operators.joins import counted_join
from matchmill.operators.ranking import gap_to_leader, percent_ranks, rank_rows, top_with_ties
from matchmill.operators.scan import global_row_number, ordered_scan
from matchmill.session import stage


def hot_rows(spark):
    """900 rows: one key holds two thirds of them, one key is NULL."""
    key = F.when(F.col("id") % 3 < 2, F.lit("hot")).when(F.col("id") % 9 == 2, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    return spark.range(900).select(key.alias("k"), F.col("id").alias("t"), (F.col("id") * 7 % 11).alias("v"))


def brute(data):
    out, seen = {}, {}
    for k, t, v in sorted(data, key=lambda r: r[1]):
        n, total, last = seen.get(k, (0, 0, None))
        out[t] = (n + 1, total + v, last)
        seen[k] = (n + 1, total + v, v)
    return out


@pytest.fixture(params=["one task", "many tasks"], autouse=True)
def partitions_kept(request, spark):
    """Small shuffles are merged into one task; run everything with the tasks kept apart too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param == "one task")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


@pytest.mark.parametrize("bucketed", [True, False])
def test_ordered_scan_matches_brute_force(spark, bucketed):
    df = hot_rows(spark)
    bucket = F.floor(F.col("t") / 10) if bucketed else None
    got = ordered_scan(df, ["k"], ["t"], row_number="n", sums={"total": "v"}, previous={"last": "v"}, following={"nxt": "v"}, bucket=bucket)
    got = {r.t: (r.n, r.total, r.last) for r in got.collect()}
    assert got == brute([tuple(r) for r in df.collect()])


def test_following_is_previous_reversed(spark):
    df = hot_rows(spark)
    got = ordered_scan(df, ["k"], ["t"], previous={"b": "t"}, following={"a": "t"}, bucket=F.floor(F.col("t") / 10))
    links = {r.t: (r.b, r.a) for r in got.collect()}
    assert all(a is None or links[a][0] == t for t, (_, a) in links.items())


def test_ordered_scan_keeps_null_values(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 30, 7)], "k string, t int, v int")
    got = ordered_scan(df, ["k"], ["t"], sums={"s": "v"}, previous={"p": "v"}, bucket=F.floor(F.col("t") / 10))
    assert sorted(tuple(r) for r in got.select("t", "s", "p").collect()) == [(1, 5, None), (2, 5, 5), (30, 12, None)]


def test_hot_group_is_cut_into_parts(spark, monkeypatch):
    """The range partitions that a scan without buckets works on: the hot key is spread over most of them."""
    from matchmill.operators import scan

    staged = []
    monkeypatch.setattr(scan, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    ordered_scan(hot_rows(spark), ["k"], ["t"], row_number="n")
    sizes = [r["count"] for r in staged[0].groupBy("k", scan.PART).count().filter("k = 'hot'").collect()]
    assert sum(sizes) == 600 and max(sizes) < 250


def test_global_row_number(spark):
    df = hot_rows(spark)
    got = global_row_number(df, [F.col("v").desc(), F.col("t").asc()], "n")
    expected = sorted(df.collect(), key=lambda r: (-r.v, r.t))
    assert {r.t: r.n for r in got.collect()} == {r.t: i + 1 for i, r in enumerate(expected)}


@pytest.mark.parametrize("partitions", [1, 5])
def test_rank_rows_against_sql(spark, partitions):
    df = hot_rows(spark).withColumn("v", F.when(F.col("t") % 50 != 0, F.col("v"))).repartition(partitions)
    df.createOrReplaceTempView("hot")
    got = rank_rows(df, [("v", True)], ["k"], rank="r", dense="d", percent="p")
    expected = spark.sql(
        "SELECT t, rank() OVER w AS r, dense_rank() OVER w AS d, percent_rank() OVER w AS p FROM hot "
        "WINDOW w AS (PARTITION BY k ORDER BY v DESC NULLS LAST)"
    )
    assert sorted(map(tuple, got.select("t", "r", "d", "p").collect())) == sorted(map(tuple, expected.collect()))


def test_percent_rank_of_one_row_is_zero(spark):
    df = spark.createDataFrame([(1, 9)], "id int, v int")
    assert percent_ranks(df, {"p": "v"}).first().p == 0.0


def test_percent_ranks_with_nulls_and_ties(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 5)], "id int, v int")
    got = {r.id: r.p for r in percent_ranks(df, {"p": "v"}).collect()}
    assert got == {1: 0.0, 2: pytest.approx(100 / 3), 3: pytest.approx(100 / 3), 4: 100.0}


def test_top_with_ties_keeps_all_equal_rows(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 9, 8, 7, 7, 6])], "id int, v int")
    got = sorted((r.id, r.dense_rank) for r in top_with_ties(df, [("v", True)], 3).collect())
    assert got == [(0, 1), (1, 1), (2, 2), (3, 3), (4, 3)]


def test_counted_join_hot_and_null_keys(spark):
    df = hot_rows(spark)
    table = df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.coalesce("k", F.lit("none")))
    got = counted_join(df, table, ["k"], "n", ["name"])
    assert got.count() == 900
    assert got.filter(F.col("name").isNull() | (F.coalesce("k", F.lit("none")) != F.col("name"))).count() == 0


def test_gap_to_leader(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("b", 3, 4)], "g string, id int, v int")
    assert rows(gap_to_leader(df, "v"), "id", "behind_leader") == [(1, 4), (2, 0), (3, 5)]
    assert rows(gap_to_leader(df, "v", "gap", ["g"]), "id", "gap") == [(1, 4), (2, 0), (3, 0)]


def test_dedup_cases(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 5, "p"), ("b", 5, "q"), ("c", None, "n"), ("c", 1, "m"), ("d", None, "only")],
        "k string, t int, v string",
    )
    order = [F.col("t").desc_nulls_last(), F.col("v").desc()]
    expected = [("a", 2, "y"), ("b", 5, "q"), ("c", 1, "m"), ("d", None, "only")]
    for partitions in (1, 4):
        assert rows(dedup_latest(df.repartition(partitions), ["k"], order)) == expected


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = dedup_latest(hot_rows(spark), ["k"], [F.col("t").desc()])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_valid_keys(spark, rows):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("null",), ("abcde",), ("abcdef",), ("  abc  ",)], "k string")
    assert rows(valid_keys(df, "k")) == [("abcdef",)]


def test_top_rows_rank(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3)], "k string, v int")
    assert rows(top_rows(df, ["k"], [F.col("v").desc()], 2, "slot")) == [("a", 2, 2), ("a", 3, 1)]
