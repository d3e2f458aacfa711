"""What the physical plans of the named queries may and may not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from matchmill.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    """The plan with size-based broadcasts off, as it is for tables too big for them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_no_pairwise_joins_and_no_python_rows(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", ["dedup_latest", "event_parse", "running_snapshots", "unpivot_sides", "tree_resolve", "nested_rollup", "ingest_fixtures"])
def test_no_single_task_over_a_fact_table(spark, name):
    text = plan(spark, name)
    rows = text.split("Subquery")[0]  # one-row lookups stand after the plan itself
    assert "SinglePartition" not in rows


def test_scans_read_only_what_they_need(spark):
    text = plan(spark, "pair_counts")
    scans = [line for line in text.splitlines() if "lineitem" in line]
    assert scans and all("l_returnflag" not in s.split("ReadSchema")[1] for s in scans)
    assert "PushedFilters: [IsNotNull" in text


def test_one_exchange_for_totals_after_the_fixtures(spark):
    """The two sides are combined on the map side, in one aggregation."""
    assert plan(spark, "melt_metrics").count("Exchange hashpartitioning(participant") == 1


def test_texts_with_one_prefix_spread_over_clusters(spark):
    from matchmill.operators.layout import cluster_layout, zorder_key

    names = spark.range(4000).selectExpr("concat('Customer#', lpad(id, 9, '0')) AS name", "id")
    assert names.select(zorder_key(names, ["name"]).alias("z")).distinct().count() == 32
    ranges = cluster_layout(names, ["name"], files=4).groupBy(F.spark_partition_id()).agg(F.min("name"), F.max("name")).collect()
    ordered = sorted((r[1], r[2]) for r in ranges)
    assert len(ordered) == 4 and all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))
