"""Physical plans: no Python in the hot path, pruning and push-down reach the scan."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from salesmart.operators import reports as rep
from salesmart.plans.registry import all_queries, enriched, enriched_salted


def plan_of(df):
    return plan_text(df)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_udf_in_plans(spark, name):
    df = all_queries()[name](spark, SF_SMALL)
    plan = plan_of(df)
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                   "MapInArrow"):
        assert marker not in plan, f"{name}: {marker}"


def test_top_categories_uses_window_group_limit(spark):
    df = rep.top_categories_by_department(enriched(spark, SF_SMALL))
    df.collect()
    assert "WindowGroupLimit" in plan_text(df)


def test_reports_prune_columns(spark):
    df = rep.sales_by_province(enriched(spark, SF_SMALL))
    plan = plan_text(df)
    assert "l_extendedprice" in plan
    assert "l_discount" not in plan and "l_tax" not in plan


def test_key_lookup_pushes_filter(spark):
    plan = plan_text(all_queries()["key_lookup"](spark, SF_SMALL))
    # The equality is applied below the join, on both sides' scans.
    sales = plan[:plan.index("orders.parquet")]
    assert "l_partkey" in sales and "= 7" in sales, plan


def test_dimension_broadcast_is_size_checked(spark):
    from salesmart.operators.joins import join_dimension, size_within
    small = spark.range(10)
    assert size_within(small, 10, 80) and not size_within(small, 9, 80) and not size_within(small, 10, 79)
    fact = spark.range(100)
    assert "BroadcastHashJoin" in plan_of(join_dimension(fact, small, "id", broadcast_rows=10))
    beyond = plan_of(join_dimension(fact, small, "id", broadcast_rows=5))
    assert "SortMergeJoin" in beyond or "ShuffledHashJoin" in beyond


def test_size_check_shuffles_no_rows(spark):
    """The check's aggregate sends one partial row per task."""
    from salesmart.operators import joins
    df = spark.range(1000).withColumn("name", F.lit("x"))
    plan = plan_of(df.agg(F.count(F.lit(1)), F.sum(joins._value_bytes(df))))
    assert "LocalLimit" not in plan and "partial_count" in plan


def test_salt_splits_equal_rows_and_reads_no_column(spark):
    from salesmart.operators import joins
    fact = spark.range(0, 4000, 1, 4).select(F.lit(7).alias("k"))
    hot = joins.hot_key_tables(fact, ["k"], 100)["k"]
    assert [tuple(r) for r in hot.collect()] == [(7, 40)]
    salted = fact.withColumn(joins.ROW_ID, F.monotonically_increasing_id())
    used = salted.select(F.pmod(F.xxhash64(joins.ROW_ID), F.lit(40)).alias("s")).distinct().count()
    assert used == 40
    plan = plan_of(rep.sales_by_province(enriched_salted(spark, SF_SMALL)))
    assert "l_quantity" not in plan.split("ReadSchema")[1]


def test_enrich_counts_reads_sales_twice_only(spark):
    df = all_queries()["enrich_counts"](spark, SF_SMALL)
    df.collect()
    final = plan_text(df, "simple").split("Initial Plan")[0]
    assert final.count("lineitem.parquet") <= 2, final


def test_report_bundle_scans_sales_once(spark):
    df = rep.report_bundle(enriched(spark, SF_SMALL))
    df.collect()
    final = plan_text(df, "simple").split("Initial Plan")[0]
    assert final.count("lineitem.parquet") == 1, final
