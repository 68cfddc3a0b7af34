"""Batch jobs over lake folders: Bronze -> Silver per table, Silver -> Gold.

These are the runnable counterparts of the reference's ETL scripts (one
Bronze->Silver job per table, four Gold jobs), built from the operators:

    python -m stratum.jobs bronze-to-silver --bronze ROOT --silver ROOT --entity order [--mode insert_only]
                                            [--database DB --buckets N]
    python -m stratum.jobs silver-to-gold --silver ROOT --gold ROOT --job revenue [--database DB]

Each job reads once and writes once.  The Bronze->Silver job counts Bronze
and Silver rows with ``Observation`` metrics on its single write action (no
extra ``count`` jobs).  Silver and Gold tables are Snappy Parquet stamped
with ``processed_at`` (B11).  Fact tables are partitioned by a derived day
or month key, never by a raw timestamp (D14).  Every write overwrites its
target, so a job rerun after a lost executor or driver gives the same
tables.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.dates import day_of, month_of
from .operators import gold, silver
from .sources import bronze, catalog, sinks

ENTITIES = ("tenant", "customer", "product", "order", "orderitem", "event", "subscription", "invoice")

# Derived partition key per Silver table (tables not listed are not partitioned).
SILVER_PARTITION = {"order": ("order_month", lambda: month_of("order_date")),
                    "event": ("event_day", lambda: day_of("created_at"))}

GOLD_JOBS = ("revenue", "product", "customer", "tenant_summary")

# Silver tables that can be bucketed on the key of their joins with each
# other (order items x orders on the order id), so Gold joins them in place.
BUCKET_KEYS = {"order": "id", "orderitem": "order_id"}


def silver_table_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{bronze.TABLE_NAMES[entity]}"


def quarantine_path(root: str, entity: str) -> str:
    """Where the rows that could not be processed are kept, with the reason."""
    return f"{root.rstrip('/')}/_quarantine/{bronze.TABLE_NAMES[entity]}"


def bronze_to_silver(spark: SparkSession, bronze_root: str, silver_root: str, entity: str,
                     mode: str = "merge", database: str | None = None,
                     buckets: int | None = None) -> dict[str, int]:
    """Type one table's Bronze change files into its Silver table.

    Reads the full-load and change folders together (A2, A3), applies I/U/D
    latest-wins (B2) or, if asked, keeps inserts only (B1), types and parses the
    rows (B3-B10), and writes Silver (A6/A7).  With ``database`` and
    ``buckets``, orders and order items are instead saved as catalog
    tables bucketed by order id (co-located for Gold joins).  Returns the
    Bronze and Silver row counts observed during the write (E3).  Rows that
    cannot be processed are written to ``quarantine_path`` with their fault.
    """
    load, cdc = bronze.bronze_paths(bronze_root, entity)
    paths = [p for p in (load, cdc) if _exists(spark, p)]
    if not paths:
        raise FileNotFoundError(f"no Bronze files for {entity} under {bronze_root}")
    seen_bronze, seen_silver = Observation(f"bronze_{entity}"), Observation(f"silver_{entity}")
    raw = bronze.read_bronze_csv(spark, paths, entity).observe(seen_bronze, F.count(F.lit(1)).alias("rows"))
    named, _ = bronze.split_bronze(raw, entity)
    rows = silver.to_silver(named, entity, mode=mode)
    rows = rows.observe(seen_silver, F.count(F.lit(1)).alias("rows"))
    path = silver_table_path(silver_root, entity)
    if database and buckets and entity in BUCKET_KEYS:
        catalog.save_bucketed(sinks.stamp_processed_at(rows), database, bronze.TABLE_NAMES[entity],
                              path, BUCKET_KEYS[entity], buckets)
    else:
        part = SILVER_PARTITION.get(entity)
        if part is not None:
            rows = rows.withColumn(part[0], part[1]())
        sinks.write_parquet(rows, path, partition_by=[part[0]] if part else None)
    counts = {"bronze_rows": seen_bronze.get["rows"], "silver_rows": seen_silver.get["rows"]}
    seen_rejected = Observation(f"rejected_{entity}")
    again = bronze.split_bronze(bronze.read_bronze_csv(spark, paths, entity), entity)[1]
    sinks.write_parquet(again.observe(seen_rejected, F.count(F.lit(1)).alias("rows")), quarantine_path(silver_root, entity))
    return counts | {"quarantined_rows": seen_rejected.get["rows"]}


def read_silver(spark: SparkSession, silver_root: str, database: str | None = None) -> dict[str, DataFrame]:
    """Lazy scans of the Silver tables (partition keys and lineage stamps dropped).

    Tables bucketed into ``database`` are read through the catalog, which
    holds their bucket spec; the rest are read from their folders.
    """
    extra = {"processed_at"} | {k for k, _ in SILVER_PARTITION.values()}
    out = {}
    for e in ENTITIES:
        name = f"{database}.{bronze.TABLE_NAMES[e]}" if database else None
        if name and e in BUCKET_KEYS and spark.catalog.tableExists(name):
            df = catalog.catalog_scan(spark, database, bronze.TABLE_NAMES[e])
        else:
            df = spark.read.parquet(silver_table_path(silver_root, e))
        out[e] = df.select(*[c for c in df.columns if c not in extra])
    return out


def silver_to_gold(spark: SparkSession, silver_root: str, gold_root: str, job: str,
                   database: str | None = None) -> list[str]:
    """Run one Gold job; returns the Gold tables it wrote.

    revenue: C1 (partitioned by month), C2.  product: C3, then C4 read
    from the written C3 table (no recomputation, no cache).  customer:
    C6, C7 (partitioned by month), C8.  tenant_summary: C9.
    """
    t = read_silver(spark, silver_root, database)
    root = gold_root.rstrip("/")

    def write(name: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        sinks.write_parquet(df, f"{root}/{name}", partition_by=partition_by)
        return name

    if job == "revenue":
        return [write("revenue_by_tenant_monthly", gold.revenue_by_tenant_monthly(t["order"], t["tenant"]),
                      ["month"]),
                write("revenue_by_tenant_total",
                      gold.revenue_by_tenant_total(t["order"], t["tenant"], t["customer"]))]
    if job == "product":
        perf = write("product_performance",
                     gold.product_performance(t["orderitem"], t["order"], t["product"], t["tenant"]))
        written = spark.read.parquet(f"{root}/{perf}").drop("processed_at")
        return [perf,
                write("top_products_by_revenue", gold.top_products_by_revenue(written)),
                write("low_stock_alert", gold.low_stock_alert(t["product"], t["tenant"]))]
    if job == "customer":
        return [write("customer_ltv", gold.customer_ltv(t["order"], t["customer"], t["tenant"])),
                write("customer_acquisition", gold.customer_acquisition(t["customer"], t["tenant"]),
                      ["month"]),
                write("active_subscriptions", gold.active_subscriptions(t["subscription"], t["tenant"]))]
    if job == "tenant_summary":
        return [write("tenant_summary", gold.tenant_summary(t["tenant"], t["customer"]))]
    raise ValueError(f"unknown Gold job {job!r}; one of {GOLD_JOBS}")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m stratum.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bronze-to-silver")
    b.add_argument("--bronze", required=True)
    b.add_argument("--silver", required=True)
    b.add_argument("--entity", choices=ENTITIES, action="append", required=True)
    b.add_argument("--mode", choices=("merge", "insert_only"), default="merge")
    b.add_argument("--database", help="catalog database for bucketed Silver orders / order items")
    b.add_argument("--buckets", type=int, help="bucket count (with --database)")
    g = sub.add_parser("silver-to-gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--job", choices=GOLD_JOBS, action="append", required=True)
    g.add_argument("--database", help="catalog database holding bucketed Silver tables")
    args = ap.parse_args(argv)

    from .session import BASE_CONF
    builder = SparkSession.builder.appName(f"stratum-{args.cmd}")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if args.cmd == "bronze-to-silver":
        for e in args.entity:
            print(e, bronze_to_silver(spark, args.bronze, args.silver, e, args.mode,
                                      args.database, args.buckets))
    else:
        for j in args.job:
            print(j, silver_to_gold(spark, args.silver, args.gold, j, args.database))
    return 0


if __name__ == "__main__":
    sys.exit(main())
