"""Physical-plan checks over every registered job.

* no CartesianProduct and no BroadcastNestedLoopJoin anywhere;
* a Window without PARTITION BY only over bounded inputs (the per-partition
  offsets of a global rank, at most one row per shuffle partition);
* filters and column pruning reach the parquet scans of the driver tables.
"""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from lakeweave.plans import registry

QUERIES = {n: q for n, q in E.queries().items() if n in registry.queries()}
# global ranks: Window over (one row per range partition) offsets — bounded by the partition count
UNPARTITIONED_WINDOW_OK = {"rfm_scores", "v_rfm_segmentation", "fact_lignes", "fact_orders", "rfm_kpis",
                           "rfm_segment_stats", "rfm_category_stats", "rfm_rf_grid", "rfm_histograms",
                           "rfm_top_customers", "rfm_sample"}


def _nodes(plan):
    """The nodes of a physical plan, also those inside adaptive plans, query stages and subqueries' parents."""
    yield plan
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _nodes(plan.executedPlan())
    elif name.endswith("QueryStage"):
        yield from _nodes(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _faults(df, windows: bool = True) -> list:
    found = []
    for node in _nodes(df._jdf.queryExecution().executedPlan()):
        name = node.nodeName()
        if name in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            found.append(name)
        if windows and name == "Window" and node.partitionSpec().isEmpty():
            found.append("Window without PARTITION BY")
    return found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    assert _faults(QUERIES[name](spark, SF_SMALL), name not in UNPARTITIONED_WINDOW_OK) == []


def test_the_walk_finds_faults(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(10)
    ranked = df.withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert _faults(ranked) == ["Window without PARTITION BY"]
    ranked.collect()                                     # the plan that ran has it too
    assert _faults(ranked) == ["Window without PARTITION BY"]
    assert _faults(df.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("id")))) == []
    assert "CartesianProduct" in _faults(df.crossJoin(spark.range(5).hint("shuffle_replicate_nl")))


def test_final_plans_of_the_heavy_jobs(spark):
    for name in ("gold_fight_player_perf", "gold_damage_taken", "gold_consumables", "climate_day"):
        df = QUERIES[name](spark, SF_SMALL)
        df.collect()
        assert _faults(df) == [], name


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F
    from lakeweave.sources.tables import read
    df = read(spark, SF_SMALL, "lineitem").filter(F.col("l_shipdate") >= "1996-01-01").select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan
