"""Physical-plan assertions: the plans we claim are the plans Spark runs."""

import pytest

import __spark_entry__ as entry
from stratum.plans.registry import load_all
from conftest import SMALL

QUERIES = entry.queries()
OWN = load_all()
BATCH = [k for k in sorted(OWN) if not k.startswith("stream_")]


def plan_text(df) -> str:
    """The plan that ran: collecting executes this very Dataset, so AQE's final
    plan is in place (a write would plan and run a new one)."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.startswith("AdaptiveSparkPlan isFinalPlan=true") or "AdaptiveSparkPlan" not in text.split("\n")[0]
    return text


@pytest.mark.parametrize("key", BATCH)
def test_no_cartesian_no_python_udf(spark, key):
    text = plan_text(QUERIES[key](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text, f"{key}: {bad}"


def test_scan_is_pruned_and_filtered(spark):
    df = QUERIES["low_stock_alert"](spark, SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    # part is read for only the columns the query needs
    assert "p_brand" not in text and "p_size" not in text


def test_merge_uses_aggregate_not_window(spark, shop):
    from stratum.operators import silver
    df = silver.cdc_merge_latest(shop.order_changes())
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in logical and "Aggregate [" in logical


def test_top_k_per_tenant_uses_group_limit(spark, shop):
    from stratum.operators import metrics
    df = metrics.best_sellers_by_tenant(shop.orderitem, shop.order)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text


def test_bucketed_silver_join_shuffles_neither_side(spark, shop):
    """With neither side broadcastable (as at scale), C3 over Silver tables
    bucketed by order id joins items and orders without an Exchange on it."""
    from stratum.operators import gold
    from stratum.plans.io_queries import colocated_silver
    items, orders = colocated_silver(shop)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = gold.product_performance(items, orders, shop.product, shop.tenant)
        text = plan_text(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert "hashpartitioning(order_id#" not in text and "hashpartitioning(id#" not in text


@pytest.mark.parametrize("log", ["order_changes", "subscription_changes", "customer_redelivered"])
def test_change_log_scans_its_source_once(shop, log):
    """Each change log expands rows in one pass: no union of per-op scans."""
    text = plan_text(getattr(shop, log)()).split("== Initial Plan ==")[0]
    assert "Union" not in text
    table = "orders.parquet" if log == "order_changes" else "customer.parquet"
    assert text.count(table) == 1


@pytest.mark.parametrize("key,table,scans", [
    ("event_sessionize", "events.parquet", 1), ("revenue_growth_mom", "orders.parquet", 1),
    ("category_trends", "orders.parquet", 1), ("retention_cohorts", "orders.parquet", 1),
    ("subscription_churn", "customer.parquet", 1), ("revenue_by_tenant", "orders.parquet", 1)])
def test_sources_are_scanned_once(spark, key, table, scans):
    text = plan_text(QUERIES[key](spark, SMALL)).split("== Initial Plan ==")[0]
    assert text.count(f"{table}]") == scans


def test_no_shuffle_on_order_id_in_revenue_by_tenant(spark):
    text = plan_text(QUERIES["revenue_by_tenant"](spark, SMALL))
    assert "hashpartitioning(id#" not in text
