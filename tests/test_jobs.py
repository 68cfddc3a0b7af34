"""Bronze files -> Silver -> Gold through the batch jobs, checked against the
registered (oracle-verified) queries on the same fixture rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tools.check_oracle import rows_of

import __spark_entry__ as entry
from stratum import jobs
from stratum.session import scratch_path
from stratum.sources import bronze


@pytest.fixture(scope="module")
def lake(spark, shop):
    root = scratch_path(spark, f"lake-{uuid.uuid4().hex[:12]}")
    for e in jobs.ENTITIES:
        load, cdc = bronze.bronze_paths(f"{root}/bronze", e)
        if e == "order":
            log = bronze.to_bronze(shop.order_changes().drop("seq"), e)
            bronze.write_bronze_csv(log.where(F.col("col0") == "I"), load)
            bronze.write_bronze_csv(log.where(F.col("col0") != "I"), cdc)
        else:
            bronze.write_bronze_csv(bronze.to_bronze(bronze.inserts_of(shop.source(e)), e), load)
    counts = {e: jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", e, mode="insert_only")
              for e in jobs.ENTITIES}
    written = {j: jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", j) for j in jobs.GOLD_JOBS}
    return root, counts, written


def test_silver_counts_are_observed_on_the_write(shop, lake):
    _, counts, _ = lake
    log = shop.order_changes()
    assert counts["order"] == {"bronze_rows": log.count(), "silver_rows": log.where("op = 'I'").count(),
                               "quarantined_rows": 0}
    assert counts["customer"]["bronze_rows"] == counts["customer"]["silver_rows"] == shop.customer.count()


def test_fact_tables_are_partitioned_by_derived_keys(spark, lake):
    root, _, _ = lake
    order = spark.read.parquet(jobs.silver_table_path(f"{root}/silver", "order"))
    assert "order_month" in order.columns and "processed_at" in order.columns


@pytest.mark.parametrize("table", ["revenue_by_tenant_monthly", "revenue_by_tenant_total",
                                   "product_performance", "top_products_by_revenue", "low_stock_alert",
                                   "customer_ltv", "customer_acquisition", "active_subscriptions",
                                   "tenant_summary"])
def test_gold_tables_match_registered_queries(spark, lake, table):
    root, _, written = lake
    assert table in [t for ts in written.values() for t in ts]
    got = spark.read.parquet(f"{root}/gold/{table}").drop("processed_at")
    want = entry.queries()[table](spark, SMALL)
    got = got.select(*want.columns)
    gc, gr = rows_of(got.toArrow())
    wc, wr = rows_of(want.toArrow())
    assert gc == wc and gr == wr


def test_merge_mode_applies_updates_and_deletes(spark, shop, lake):
    from stratum.operators import silver
    root, _, _ = lake
    counts = jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver_merged", "order", mode="merge")
    assert counts["silver_rows"] == silver.cdc_merge_latest(shop.order_changes()).count()


def test_bucketed_silver_feeds_gold_without_shuffling_the_join(spark, lake):
    root, _, _ = lake
    db = f"stratum_{uuid.uuid4().hex[:8]}_silver"
    silver_root = f"{root}/silver_bucketed"
    for e in jobs.ENTITIES:
        jobs.bronze_to_silver(spark, f"{root}/bronze", silver_root, e, mode="insert_only", database=db, buckets=8)
    assert spark.catalog.tableExists(f"{db}.core_order") and spark.catalog.tableExists(f"{db}.core_orderitem")
    jobs.silver_to_gold(spark, silver_root, f"{root}/gold_bucketed", "product", database=db)
    got = spark.read.parquet(f"{root}/gold_bucketed/product_performance").drop("processed_at")
    want = entry.queries()["product_performance"](spark, SMALL)
    assert rows_of(got.select(*want.columns).toArrow()) == rows_of(want.toArrow())

    from stratum.operators import gold
    t = jobs.read_silver(spark, silver_root, db)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = gold.product_performance(t["orderitem"], t["order"], t["product"], t["tenant"])
        df.write.format("noop").mode("overwrite").save()
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in text and "hashpartitioning(order_id#" not in text
