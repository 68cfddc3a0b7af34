"""Joins over time, ordered funnels, distributions and table differences, with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cube, distributions, sequences, silver, table_diff, temporal
from ..sources.staging import staged
from .oracle import month, with_fixtures
from .registry import register

_SUB_LOG = """
  SELECT customer_id, tenant_id, cast(start_date AS timestamp) AS since, 0 AS seq, 'trial' AS status, plan_name FROM t_sub
  UNION ALL
  SELECT customer_id, tenant_id, cast(start_date + 14 AS timestamp), 1, 'active', plan_name FROM t_sub WHERE status <> 'trial'
  UNION ALL
  SELECT customer_id, tenant_id, cast(end_date AS timestamp), 2, status, plan_name FROM t_sub WHERE status IN ('cancelled', 'expired')"""


def _asof(s):
    """Orders with the subscription status and plan of the customer at order time."""
    return temporal.asof_join(
        s.order.select("id", "tenant_id", "customer_id", "order_date"),
        s.subscription_changes().select("customer_id", "commit_ts", "seq", "status", "plan_name"),
        ["customer_id"], "order_date", "commit_ts", ["status", "plan_name", "commit_ts"], tiebreak=["seq"], prefix="sub_")


register("order_subscription_asof", "B26", with_fixtures(f"""
SELECT o.id, o.tenant_id, o.customer_id, o.order_date, l.status AS sub_status, l.plan_name AS sub_plan_name,
       l.since AS sub_commit_ts
FROM t_order o ASOF LEFT JOIN ({_SUB_LOG}) l ON o.customer_id = l.customer_id AND o.order_date >= l.since"""))(_asof)


def _interval(s):
    """Completed orders inside the validity of a subscription status, per status and plan."""
    history = silver.scd2_history(s.subscription_changes(), "customer_id", ["plan_name", "status"])
    met = temporal.interval_join(
        s.order.where(F.col("status") == "completed").select("id", "tenant_id", "customer_id", "order_date", "total"),
        history, ["customer_id"], "order_date", "valid_from", "valid_to", ["status", "plan_name", "valid_from", "valid_to"],
        prefix="sub_")
    return met.groupBy("tenant_id", "sub_status", "sub_plan_name").agg(
        F.count("id").alias("orders"), F.sum("total").cast("double").alias("revenue"),
        F.countDistinct("customer_id").alias("customers"))


_HISTORY = f"""
SELECT customer_id, status, plan_name, since AS valid_from,
       lead(since) OVER (PARTITION BY customer_id ORDER BY since, seq) AS valid_to FROM ({_SUB_LOG})"""

register("orders_in_subscription", "F16", with_fixtures(f"""
SELECT o.tenant_id, h.status AS sub_status, h.plan_name AS sub_plan_name, count(o.id) AS orders,
       cast(sum(o.total) AS double) AS revenue, count(DISTINCT o.customer_id) AS customers
FROM t_order o JOIN ({_HISTORY}) h ON h.customer_id = o.customer_id AND o.order_date >= h.valid_from
  AND (h.valid_to IS NULL OR o.order_date < h.valid_to)
WHERE o.status = 'completed' GROUP BY 1, 2, 3"""))(_interval)


def _open_invoices(s):
    """Per tenant and order day: the tenant's invoices that are open (issued, not yet due)."""
    days = s.order.select("tenant_id", F.to_date("order_date").alias("day")).distinct()
    met = temporal.interval_join(days.withColumn("at", F.col("day").cast("timestamp_ntz")), s.invoice, ["tenant_id"], "at",
                                 "issue_date", "due_date", ["id", "amount"], prefix="invoice_")
    return met.groupBy("tenant_id", "day").agg(F.count("invoice_id").alias("open_invoices"),
                                               F.sum("invoice_amount").cast("double").alias("open_amount"))


register("open_invoices_by_day", "B27", with_fixtures("""
SELECT d.tenant_id, d.day, count(i.id) AS open_invoices, cast(sum(i.amount) AS double) AS open_amount
FROM (SELECT DISTINCT tenant_id, cast(order_date AS date) AS day FROM t_order) d
JOIN t_invoice i ON i.tenant_id = d.tenant_id AND i.issue_date <= d.day AND d.day < i.due_date
GROUP BY 1, 2"""))(_open_invoices)


# ---------------------------------------------------------------- F8 / F9 in order
def _chain(steps: list[str]) -> str:
    """c<k>(tenant_id, session_id, start, t): the earliest time each start reaches step k."""
    ctes = [f"c1 AS (SELECT DISTINCT tenant_id, session_id, created_at AS start, created_at AS t FROM t_event "
            f"WHERE event_type = '{steps[0]}')"]
    for k, step in enumerate(steps[1:], 2):
        ctes.append(f"""c{k} AS (SELECT c.tenant_id, c.session_id, c.start, min(e.created_at) AS t FROM c{k - 1} c JOIN t_event e
  ON e.session_id = c.session_id AND e.tenant_id IS NOT DISTINCT FROM c.tenant_id AND e.event_type = '{step}'
  AND e.created_at > c.t AND e.created_at <= c.start + INTERVAL 24 HOUR GROUP BY 1, 2, 3)""")
    return ", ".join(ctes)


_STEPS = ["page_view", "product_view", "add_to_cart", "checkout", "purchase"]
_REACHED = " UNION ALL ".join(
    f"SELECT {k} AS step_no, '{s}' AS step, (SELECT count(*) FROM (SELECT DISTINCT tenant_id, session_id FROM c{k})) AS sessions"
    for k, s in enumerate(_STEPS, 1))

register("funnel_ordered", "F8", with_fixtures(f"""
SELECT step_no, step, sessions, cast(sessions AS double) / nullif(lag(sessions) OVER (ORDER BY step_no), 0) AS rate_from_prev,
       cast(sessions AS double) / nullif(first(sessions) OVER (ORDER BY step_no), 0) AS rate_from_start
FROM (WITH {_chain(_STEPS)} {_REACHED})"""))(lambda s: sequences.funnel_ordered(s.event))

register("cart_abandonment_ordered", "F9", with_fixtures(f"""
WITH {_chain(["add_to_cart", "purchase"])},
carts AS (SELECT DISTINCT tenant_id, session_id FROM c1), bought AS (SELECT DISTINCT tenant_id, session_id FROM c2),
shops AS (SELECT DISTINCT tenant_id FROM t_event WHERE event_type IN ('add_to_cart', 'purchase'))
SELECT s.tenant_id, coalesce(n, 0) AS cart_sessions, coalesce(n, 0) - coalesce(m, 0) AS abandoned_sessions,
       cast(coalesce(n, 0) - coalesce(m, 0) AS double) / nullif(n, 0) AS abandonment_rate
FROM shops s LEFT JOIN (SELECT tenant_id, count(*) AS n FROM carts GROUP BY 1) a ON a.tenant_id IS NOT DISTINCT FROM s.tenant_id
LEFT JOIN (SELECT tenant_id, count(*) AS m FROM bought GROUP BY 1) b ON b.tenant_id IS NOT DISTINCT FROM s.tenant_id""".replace("WITH ", "SELECT * FROM (WITH ", 1) + ")"))(
    lambda s: sequences.cart_abandonment_ordered(s.event))


# ---------------------------------------------------------------- F10 / C1: distributions
register("session_duration_quantiles", "F10", with_fixtures("""
SELECT cast(start AS date) AS day, count(*) AS sessions,
       cast(quantile_disc(us, 0.5) AS double) / 1000000 AS p50_seconds,
       cast(quantile_disc(us, 0.95) AS double) / 1000000 AS p95_seconds
FROM (SELECT min(created_at) AS start, date_diff('microsecond', min(created_at), max(created_at)) AS us
      FROM t_event WHERE created_at IS NOT NULL GROUP BY tenant_id, session_id)
GROUP BY 1"""))(lambda s: distributions.session_duration_quantiles(s.event))

# Fewer than 2^12 customers a tenant and month at the driver's scales, so the sketches are exact.
register("customers_from_sketches", "C1", with_fixtures(f"""
WITH held AS (SELECT DISTINCT tenant_id, {month('order_date')} AS month, customer_id FROM t_order WHERE status = 'completed'),
counts AS (SELECT tenant_id, {month('order_date')} AS month, count(id) AS order_count FROM t_order
           WHERE status = 'completed' GROUP BY 1, 2)
SELECT c.tenant_id, c.month, c.order_count, n AS unique_customers,
       CASE WHEN EXISTS (SELECT 1 FROM counts p WHERE p.tenant_id = c.tenant_id AND p.month + INTERVAL 1 MONTH = c.month)
            THEN (SELECT count(*) FROM held a JOIN held b ON a.tenant_id = b.tenant_id AND a.customer_id = b.customer_id
                  AND b.month + INTERVAL 1 MONTH = a.month WHERE a.tenant_id = c.tenant_id AND a.month = c.month) END
         AS retained_customers
FROM counts c JOIN (SELECT tenant_id, month, count(*) AS n FROM held GROUP BY 1, 2) h
  ON h.tenant_id = c.tenant_id AND h.month = c.month""".replace("\nWITH", "\nSELECT * FROM (WITH", 1) + ")"))(
    lambda s: distributions.customers_and_retention(staged(distributions.daily_customer_sketches(s.order), "customer-sketches")))


# ---------------------------------------------------------------- E3, row by row
_DIFF_COLUMNS = ["id", "tenant_id", "customer_id", "order_number", "status", "total", "order_date"]


def _order_diff(s):
    """Silver orders against the same orders with planted faults, some of them lost or twice."""
    left = s.order.select(*_DIFF_COLUMNS)
    n = F.col("id").cast("bigint")
    right = s.faulty("order").select(*_DIFF_COLUMNS).where(n % 211 != 5)
    right = right.unionByName(right.where(n % 223 == 6))
    return table_diff.diff(left, right, ["id"])


register("order_row_diff", "E3", with_fixtures("""
SELECT a.id, CASE WHEN a.okey % 211 = 5 THEN 'removed' WHEN cols <> '' THEN 'changed' ELSE 'recount' END AS change,
       CASE WHEN a.okey % 211 <> 5 AND a.okey % 223 <> 6 THEN cols END AS columns,
       cast(1 AS bigint) AS left_rows,
       cast(CASE WHEN a.okey % 211 = 5 THEN 0 WHEN a.okey % 223 = 6 THEN 2 ELSE 1 END AS bigint) AS right_rows
FROM t_order a JOIN (
  SELECT f.id, concat_ws(',', CASE WHEN f.customer_id IS DISTINCT FROM o.customer_id THEN 'customer_id' END,
                         CASE WHEN f.order_number IS DISTINCT FROM o.order_number THEN 'order_number' END,
                         CASE WHEN f.status IS DISTINCT FROM o.status THEN 'status' END,
                         CASE WHEN f.total IS DISTINCT FROM o.total THEN 'total' END) AS cols
  FROM t_order_f f JOIN t_order o ON o.id = f.id) d ON d.id = a.id
WHERE a.okey % 211 = 5 OR cols <> '' OR a.okey % 223 = 6"""))(_order_diff)


# ---------------------------------------------------------------- C1-C3 with all subtotals
register("revenue_cube", "C3", with_fixtures(f"""
SELECT tenant_id, category, month, cast(GROUPING(tenant_id, category, month) AS integer) AS level,
       count(*) AS items, cast(sum(quantity) AS bigint) AS units, cast(sum(total) AS double) AS revenue,
       count(DISTINCT customer_id) AS customers
FROM (SELECT o.tenant_id, p.category, {month('o.order_date')} AS month, o.customer_id, i.quantity, i.total
      FROM t_item i JOIN t_order o ON o.id = i.order_id AND o.status = 'completed'
      LEFT JOIN t_product p ON p.id = i.product_id)
GROUP BY CUBE (tenant_id, category, month)"""))(lambda s: cube.revenue_cube(s.orderitem, s.order, s.product))
