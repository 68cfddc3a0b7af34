"""A2-A10: sources and sinks exercised end to end through written files.

Files go to fresh folders under the shared checkpoint root
(``spark.checkpoint.dir``); each query returns what it reads back.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators import gold
from ..session import scratch_path
from ..sources import bronze, layout, sinks
from ..streaming.sinks import fresh_dir
from .gold_queries import PRODUCT_PERFORMANCE_SQL, REVENUE_MONTHLY_SQL
from .oracle import with_fixtures
from .registry import register


def _dir(s, name: str) -> str:
    return fresh_dir(scratch_path(s.spark, "io"), name)


def _bronze_round_trip(s):
    load, cdc = bronze.bronze_paths(_dir(s, "bronze"), "order")
    log = bronze.to_bronze(s.order_changes().drop("seq"), "order")
    bronze.write_bronze_csv(log.where(F.col("col0") == "I"), load)     # full load
    bronze.write_bronze_csv(log.where(F.col("col0") != "I"), cdc)      # ongoing changes
    named = bronze.name_columns(bronze.read_bronze_csv(s.spark, [load, cdc], "order"), "order")
    return named.select("op", "id", "status", "commit_ts")


register("bronze_csv_scan", "A2", with_fixtures("""
SELECT op, id, status, commit_ts FROM t_order_log"""))(_bronze_round_trip)


def _quarantine(s):
    """The order log as CSV text with faults planted by order key: a line cut
    short, an unknown op, no key, no commit time.  Every row comes back, kept
    or with its fault."""
    path = _dir(s, "bronze_faults")
    log = s.order_changes()
    case = F.col("id").cast("bigint") % 100
    text = bronze.to_bronze(
        log.withColumn("_case", case).withColumn("op", F.when(F.col("_case") == 2, "X").otherwise(F.col("op")))
        .withColumn("commit_ts", F.when(F.col("_case") != 4, F.col("commit_ts")))
        .withColumn("id", F.when(F.col("_case") != 3, F.col("id"))), "order")
    line = F.to_csv(F.struct("*"), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    cut = F.when(F.col("col2").cast("bigint") % 100 == 1, F.substring_index(line, ",", 6)).otherwise(line)
    text.select(cut.alias("value")).write.option("compression", "gzip").text(path)
    kept, out = bronze.split_bronze(bronze.read_bronze_csv(s.spark, path, "order"), "order")
    return kept.select("op", "id", F.lit("kept").alias("fault")).unionByName(out.select("op", "id", "fault"))


register("bronze_quarantine", "A2", with_fixtures("""
SELECT CASE WHEN okey % 100 = 2 THEN 'X' ELSE op END AS op, CASE WHEN okey % 100 <> 3 THEN id END AS id,
       CASE okey % 100 WHEN 1 THEN 'malformed' WHEN 2 THEN 'unknown_op' WHEN 3 THEN 'no_key'
            WHEN 4 THEN 'no_commit_time' ELSE 'kept' END AS fault
FROM t_order_log"""))(_quarantine)


def _gold_write(s):
    path = _dir(s, "gold_revenue_monthly")
    result = gold.revenue_by_tenant_monthly(s.order, s.tenant)
    sinks.write_parquet(result, path, partition_by=["month"])
    return s.spark.read.schema(result.schema).parquet(path).select(*result.columns)


register("gold_partitioned_write", "A7", REVENUE_MONTHLY_SQL)(_gold_write)


def _layout(s):
    path = _dir(s, "events_layout")
    ev = s.event.select("id", "tenant_id", "event_type", "created_at")
    laid = sinks.with_layout_keys(ev, "created_at")
    sinks.write_tenant_date_layout(ev, path, "created_at")
    return s.spark.read.schema(laid.schema).parquet(path).select("id", "tenant_id", "dt", "event_type")


register("tenant_date_layout", "A9", with_fixtures("""
SELECT id, tenant_id, cast(created_at AS date) AS dt, event_type FROM t_event"""))(_layout)


def _evolve(s):
    root = _dir(s, "customer_loads")
    c = s.customer.select("id", "tenant_id", "email", "phone")
    even = F.col("id").cast("bigint") % 2 == 0
    # Load 1 predates the phone column; load 2 carries it.
    sinks.write_parquet(c.where(even).drop("phone"), f"{root}/load=1", stamp=False)
    sinks.write_parquet(c.where(~even), f"{root}/load=2", stamp=False)
    return sinks.read_evolving(s.spark, [f"{root}/load=1", f"{root}/load=2"]).select(
        "id", "tenant_id", "email", "phone")


register("schema_evolution", "A10", with_fixtures("""
SELECT id, tenant_id, email, CASE WHEN cast(id AS bigint) % 2 = 0 THEN NULL ELSE phone END AS phone
FROM t_customer"""))(_evolve)


def _catalog(s):
    import uuid

    from ..sources import catalog
    root = _dir(s, "silver_layer")
    db = catalog.layer_database("silver", prefix=f"stratum_{uuid.uuid4().hex[:8]}")
    for entity, df in s.tables().items():
        path = f"{root}/core_{entity}"
        sinks.write_parquet(df, path, stamp=True)                          # A6 (+ B11 stamp)
        catalog.register_table(s.spark, db, f"core_{entity}", path)        # A5
    parts = [catalog.catalog_scan(s.spark, db, t)                          # A1
             .agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
             for t in catalog.select_tables(s.spark, db, ["core_*"])]       # A4
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


register("catalog_layer_counts", "A5", with_fixtures("""
SELECT 'core_tenant' AS table_name, count(*) AS row_count FROM t_tenant
UNION ALL SELECT 'core_customer', count(*) FROM t_customer
UNION ALL SELECT 'core_product', count(*) FROM t_product
UNION ALL SELECT 'core_order', count(*) FROM t_order
UNION ALL SELECT 'core_orderitem', count(*) FROM t_item
UNION ALL SELECT 'core_event', count(*) FROM t_event
UNION ALL SELECT 'core_subscription', count(*) FROM t_sub
UNION ALL SELECT 'core_invoice', count(*) FROM t_invoice"""))(_catalog)


def colocated_silver(s) -> tuple:
    """Silver orders and order items written bucketed by order id into a
    fresh silver database; returns their catalog scans (items, orders)."""
    import uuid

    from ..sources import catalog
    root = _dir(s, "silver_bucketed")
    db = catalog.layer_database("silver", prefix=f"stratum_{uuid.uuid4().hex[:8]}")
    n = int(s.spark.conf.get("spark.sql.shuffle.partitions"))
    catalog.save_bucketed(s.order, db, "core_order", f"{root}/core_order", "id", n)
    catalog.save_bucketed(s.orderitem, db, "core_orderitem", f"{root}/core_orderitem", "order_id", n)
    return catalog.catalog_scan(s.spark, db, "core_orderitem"), catalog.catalog_scan(s.spark, db, "core_order")


def _colocated_performance(s):
    items, orders = colocated_silver(s)
    return gold.product_performance(items, orders, s.product, s.tenant)


# C3 over the bucketed layout: the items x orders join shuffles neither side.
register("product_performance_colocated", "A5", with_fixtures(PRODUCT_PERFORMANCE_SQL))(
    _colocated_performance)


def _zorder(s):
    """Events of tenants '1' to '15' (in string order) in two weeks, from the files that can hold any."""
    path = _dir(s, "events_zorder")
    ev = s.event.select("id", "tenant_id", "event_type", "created_at")
    layout.write_zorder(ev, path, ["tenant_id", "created_at"], rows_per_file=5_000)
    first = ev.agg(F.min("created_at").alias("t")).first()["t"].replace(hour=0, minute=0, second=0, microsecond=0)
    rows = layout.read_between(s.spark, path, ev.schema, {
        "tenant_id": ("1", "15"), "created_at": (first + timedelta(days=5), first + timedelta(days=19))})
    return rows.groupBy("tenant_id", "event_type").agg(F.count(F.lit(1)).alias("event_count"))


register("events_zorder_range", "A9", with_fixtures("""
SELECT tenant_id, event_type, count(*) AS event_count
FROM t_event, (SELECT date_trunc('day', min(created_at)) AS first FROM t_event)
WHERE tenant_id BETWEEN '1' AND '15' AND created_at BETWEEN first + to_days(5) AND first + to_days(19)
GROUP BY ALL"""))(_zorder)
