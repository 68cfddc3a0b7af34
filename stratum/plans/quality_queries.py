"""E1-E8 data quality and H1-H2 governance, with their DuckDB oracles."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from ..operators import governance as G
from ..operators import quality as Q
from ..operators import silver
from ..session import scratch_path
from ..sources import sinks
from ..sources.fixtures import Shop
from ..streaming.sinks import fresh_dir
from .oracle import with_fixtures
from .registry import register
from .silver_queries import named_bronze

FRESHNESS_AS_OF = "2024-03-01"


def _silver_from_bronze(s, entity):
    return silver.to_silver(named_bronze(s, entity), entity)


register("dq_tenant_report", "E1", with_fixtures("""
SELECT count(*) FILTER (WHERE id IS NULL) AS null_ids, count(*) FILTER (WHERE name IS NULL) AS null_names,
       count(*) FILTER (WHERE NOT is_active) AS inactive_tenants, count(*) AS total_records
FROM t_tenant_f"""))(
    lambda s: Q.dq_tenant_report(s.faulty("tenant", _silver_from_bronze(s, "tenant"))))

register("dq_customer_report", "E2", with_fixtures("""
SELECT count(*) FILTER (WHERE email IS NULL) AS null_emails,
       count(*) FILTER (WHERE tenant_id IS NULL OR tenant_id IN ('', 'unknown')) AS missing_tenant_ids,
       count(*) AS total_records
FROM t_customer_f"""))(
    lambda s: Q.dq_customer_report(s.faulty("customer", _silver_from_bronze(s, "customer"))))


# Entities made from one small table each (an invoice schedule is many rows of a customer):
# their tables are few file splits, so rows are dealt out before they become text.
_FROM_SMALL_TABLES = ("customer", "product", "subscription", "invoice")


def _reconcile(s):
    """Every entity goes through its own Silver job.  The jobs run side by side, so that
    one with few or uneven tasks leaves no cores idle."""
    entities = ("tenant", "customer", "product", "order", "orderitem", "event", "subscription", "invoice")
    root = fresh_dir(scratch_path(s.spark, "io"), "reconcile")
    dealt = Shop(s.spark, s.sf_dir, tasks=2 * s.spark.sparkContext.defaultParallelism)
    bronze = {e: named_bronze(dealt if e in _FROM_SMALL_TABLES else s, e) for e in entities}
    with ThreadPoolExecutor(len(entities)) as jobs:
        runs = [jobs.submit(inheritable_thread_target(s.spark)(sinks.write_parquet), silver.to_silver(bronze[e], e), f"{root}/{e}")
                for e in entities]
        for run in runs:
            run.result()
    return Q.layer_row_reconcile(bronze, {e: s.spark.read.parquet(f"{root}/{e}") for e in entities})


register("layer_row_reconcile", "E3", with_fixtures("""
SELECT entity, bronze_rows, silver_rows, bronze_rows - silver_rows AS dropped_rows FROM (
  SELECT 'tenant' AS entity, (SELECT count(*) FROM t_tenant) AS bronze_rows, (SELECT count(*) FROM t_tenant) AS silver_rows
  UNION ALL SELECT 'customer', (SELECT count(*) FROM t_customer), (SELECT count(*) FROM t_customer)
  UNION ALL SELECT 'product', (SELECT count(*) FROM t_product), (SELECT count(*) FROM t_product)
  UNION ALL SELECT 'order', (SELECT count(*) FROM t_order_log), (SELECT count(*) FROM t_order_log WHERE op = 'I')
  UNION ALL SELECT 'orderitem', (SELECT count(*) FROM t_item), (SELECT count(*) FROM t_item)
  UNION ALL SELECT 'event', (SELECT count(*) FROM t_event), (SELECT count(*) FROM t_event)
  UNION ALL SELECT 'subscription', (SELECT count(*) FROM t_sub), (SELECT count(*) FROM t_sub)
  UNION ALL SELECT 'invoice', (SELECT count(*) FROM t_invoice), (SELECT count(*) FROM t_invoice))"""))(
    _reconcile)

_CTE = {"tenant": "t_tenant_f", "customer": "t_customer_f", "product": "t_product_f", "order": "t_order_f",
        "orderitem": "t_item_f", "event": "t_event_f", "subscription": "t_sub_f", "invoice": "t_invoice_f"}


def _orphans_sql() -> str:
    parts = []
    for child, fk, parent in Q.FOREIGN_KEYS:
        parts.append(f"SELECT '{child}.{fk} -> {parent}.id' AS relation, count(*) AS orphan_rows "
                     f"FROM {_CTE[child]} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
                     f"(SELECT 1 FROM {_CTE[parent]} p WHERE p.id = c.{fk})")
    return "\nUNION ALL ".join(parts)


register("dq_referential", "E4", with_fixtures(_orphans_sql()))(
    lambda s: Q.dq_referential(s.faulty_tables()))


def _unique_sql() -> str:
    parts = []
    for entity, cols in Q.UNIQUE_KEYS:
        key = ", ".join(cols)
        parts.append(f"SELECT '{entity}({key})' AS unique_key, count(*) AS duplicate_keys, "
                     f"cast(coalesce(sum(n), 0) AS bigint) AS duplicate_rows "
                     f"FROM (SELECT {key}, count(*) AS n FROM {_CTE[entity]} GROUP BY {key} HAVING count(*) > 1)")
    return "\nUNION ALL ".join(parts)


register("dq_uniqueness", "E5", with_fixtures(_unique_sql()))(
    lambda s: Q.dq_uniqueness(s.faulty_tables()))

_DOMAIN_SQL = {
    "order": [("status_in_domain", "status IN ('pending', 'processing', 'completed', 'cancelled')"),
              ("subtotal_non_negative", "subtotal >= 0"), ("tax_non_negative", "tax >= 0"),
              ("shipping_non_negative", "shipping >= 0"), ("total_non_negative", "total >= 0")],
    "orderitem": [("quantity_at_least_1", "quantity >= 1")],
    "product": [("price_at_least_0_01", "price >= 0.01"), ("cost_non_negative", "cost >= 0"),
                ("stock_non_negative", "stock_quantity >= 0")],
    "event": [("event_type_in_domain", "event_type IN ('page_view', 'product_view', 'search', 'add_to_cart', "
               "'remove_from_cart', 'checkout', 'purchase', 'click')")],
    "subscription": [("status_in_domain", "status IN ('trial', 'active', 'cancelled', 'expired')"),
                     ("billing_cycle_in_domain", "billing_cycle IN ('monthly', 'yearly')")],
    "invoice": [("status_in_domain", "status IN ('draft', 'sent', 'paid', 'overdue', 'cancelled')")],
}


def _domain_sql() -> str:
    parts = []
    for entity, rules in _DOMAIN_SQL.items():
        for name, cond in rules:
            parts.append(f"SELECT '{entity}' AS entity, '{name}' AS rule, count(*) AS checked_rows, "
                         f"count(*) FILTER (WHERE NOT coalesce({cond}, false)) AS violations FROM {_CTE[entity]}")
    return "\nUNION ALL ".join(parts)


def _valid_sql() -> str:
    parts = []
    for entity, rules in _DOMAIN_SQL.items():
        ok = " AND ".join(f"coalesce({c}, false)" for _, c in rules)
        parts.append(f"SELECT '{entity}' AS entity, count(*) AS total_rows, "
                     f"count(*) FILTER (WHERE id IS NOT NULL AND {ok}) AS valid_rows FROM {_CTE[entity]}")
    body = "\nUNION ALL ".join(parts)
    return (f"SELECT entity, total_rows, valid_rows, "
            f"CASE WHEN total_rows <> 0 THEN cast(valid_rows AS double) / cast(total_rows AS double) END AS valid_ratio, "
            f"CASE WHEN total_rows <> 0 THEN cast(valid_rows AS double) / cast(total_rows AS double) END > 0.99 "
            f"AS meets_target FROM ({body})")


register("dq_domain", "E6", with_fixtures(_domain_sql()))(
    lambda s: Q.dq_domain(s.faulty_tables()))

register("dq_freshness", "E7", with_fixtures(f"""
SELECT 'tenant' AS entity, max(created_at + INTERVAL 1 DAY) AS latest_ts FROM t_tenant
UNION ALL SELECT 'customer', max(created_at + INTERVAL 1 DAY) FROM t_customer
UNION ALL SELECT 'product', timestamp '1994-06-02 00:00:00'
UNION ALL SELECT 'order', max(order_date) FROM t_order
UNION ALL SELECT 'orderitem', max(l_shipdate) FROM lineitem
UNION ALL SELECT 'event', max(created_at) FROM t_event
UNION ALL SELECT 'subscription', max(cast(start_date AS timestamp)) FROM t_sub
UNION ALL SELECT 'invoice', max(cast(issue_date AS timestamp)) FROM t_invoice""".replace(
    "SELECT 'tenant' AS entity, max(created_at + INTERVAL 1 DAY) AS latest_ts FROM t_tenant",
    "SELECT entity, latest_ts, cast(date_diff('day', cast(latest_ts AS date), date '" + FRESHNESS_AS_OF
    + "') AS integer) AS lag_days FROM (SELECT 'tenant' AS entity, max(created_at + INTERVAL 1 DAY) AS latest_ts "
    "FROM t_tenant") + ")"))(
    lambda s: Q.dq_freshness(s.tables(), FRESHNESS_AS_OF))

register("dq_valid_ratio", "E8", with_fixtures(_valid_sql()))(
    lambda s: Q.dq_valid_ratio(s.faulty_tables()))

# ---------------------------------------------------------------- H1 / H2
SCOPED_PRINCIPAL = "analyst_enterprise"

register("tenant_scope", "H1", with_fixtures("""
SELECT o.id, o.tenant_id, o.status, cast(o.total AS double) AS total
FROM t_order o WHERE o.tenant_id IN (SELECT id FROM t_tenant WHERE plan_type = 'enterprise')"""))(
    lambda s: G.tenant_scope(s.order, G.tenant_grants(s.tenant), SCOPED_PRINCIPAL)
    .select("id", "tenant_id", "status", F.col("total").cast("double").alias("total")))

register("pii_mask", "H2", with_fixtures("""
SELECT id, tenant_id, substr(email, 1, 1) || '***@' || split_part(email, '@', 2) AS email,
       repeat('*', greatest(length(regexp_replace(phone, '[^0-9+]', '', 'g')) - 4, 0))
         || right(regexp_replace(phone, '[^0-9+]', '', 'g'), 4) AS phone,
       sha256('fixture-key' || sha256('fixture-key' || email)) AS email_hash
FROM t_customer"""))(
    lambda s: G.pii_mask(s.customer, "analyst", hash_key="fixture-key"))
