"""Plan shape: broadcast spatial join, no Python on query paths, pruned scans."""

import re

from conftest import SF_SMALL

from skytrace.plans import queries as Q


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_zone_join_broadcasts_zones(spark):
    plan = _plan(Q.q_points_in_zone(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_no_nested_loops(spark):
    for name, fn in Q.QUERIES.items():
        if "zone" in name:
            assert "NestedLoopJoin" not in _plan(fn(spark, SF_SMALL)), name


def test_zone_membership_needs_no_shuffle_of_points(spark):
    scan = _plan(Q.q_zone_membership(spark, SF_SMALL)).split("BroadcastExchange")[0]
    assert "Exchange" not in scan


def test_no_python_on_query_paths(spark):
    for name, fn in Q.QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_scan_prunes_columns(spark):
    plan = _plan(Q.q_page_asset_links(spark, SF_SMALL))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan or "struct<page_id:bigint,html:string>" in plan


def test_window_queries_read_their_hours_only(spark):
    for name in ("window_filter", "window_points", "zone_unique_aircraft"):
        plan = Q.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        pruned = [x for x in plan.splitlines() if x.startswith("PartitionFilters:")]
        assert pruned and all("hour" in x for x in pruned), name


def test_generated_methods_are_short_enough_to_be_compiled(spark):
    """The JVM interprets methods of more than 8,000 bytes for good; those of
    the ingest run once a point."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # an adaptive plan has no generated code before it runs
    try:
        text = Q.points_fresh(spark, SF_SMALL)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set(key, before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(sizes) == 3 and max(sizes) < 8000
