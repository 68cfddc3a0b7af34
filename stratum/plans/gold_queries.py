"""The shipped Gold tables, with their DuckDB oracles."""

from __future__ import annotations

from ..operators import gold
from .oracle import avg_money, month, ratio_money, with_fixtures
from .registry import register

REVENUE_MONTHLY_SQL = with_fixtures(f"""
SELECT o.tenant_id, t.name AS tenant_name, {month('o.order_date')} AS month,
       count(o.id) AS order_count, cast(sum(o.total) AS double) AS total_revenue,
       {avg_money('o.total')} AS avg_order_value,
       count(DISTINCT o.customer_id) AS unique_customers
FROM t_order o JOIN t_tenant t ON o.tenant_id = t.id
WHERE o.status = 'completed'
GROUP BY o.tenant_id, t.name, {month('o.order_date')}""")

register("revenue_by_tenant_monthly", "C1", REVENUE_MONTHLY_SQL)(
    lambda s: gold.revenue_by_tenant_monthly(s.order, s.tenant))

register("revenue_by_tenant_total", "C2", with_fixtures(f"""
SELECT o.tenant_id, t.name AS tenant_name, t.plan_type, c.total_customers,
       count(o.id) AS total_orders, cast(sum(o.total) AS double) AS total_revenue,
       {avg_money('o.total')} AS avg_order_value,
       {ratio_money('sum(o.total)', 'c.total_customers')} AS revenue_per_customer
FROM t_order o JOIN t_tenant t ON o.tenant_id = t.id
JOIN (SELECT tenant_id, count(id) AS total_customers FROM t_customer GROUP BY tenant_id) c
  ON c.tenant_id = o.tenant_id
WHERE o.status = 'completed'
GROUP BY o.tenant_id, t.name, t.plan_type, c.total_customers"""))(
    lambda s: gold.revenue_by_tenant_total(s.order, s.tenant, s.customer))

_PERF = f"""
SELECT o.tenant_id, t.name AS tenant_name, i.product_id, p.name AS product_name,
       cast(p.price AS double) AS current_price, p.stock_quantity AS current_stock,
       count(i.id) AS times_ordered, cast(sum(i.quantity) AS bigint) AS total_quantity_sold,
       cast(sum(i.total) AS double) AS total_revenue,
       {ratio_money('sum(i.total)', 'sum(i.quantity)')} AS avg_selling_price
FROM t_item i JOIN t_order o ON i.order_id = o.id
JOIN t_product p ON p.id = i.product_id
JOIN t_tenant t ON t.id = o.tenant_id
WHERE o.status = 'completed'
GROUP BY o.tenant_id, t.name, i.product_id, p.name, p.price, p.stock_quantity"""

PRODUCT_PERFORMANCE_SQL = _PERF

register("product_performance", "C3", with_fixtures(_PERF))(
    lambda s: gold.product_performance(s.orderitem, s.order, s.product, s.tenant))

register("top_products_by_revenue", "C4", with_fixtures(
    f"SELECT * FROM ({_PERF}) ORDER BY total_revenue DESC, tenant_id, product_id LIMIT 100"))(
    lambda s: gold.top_products_by_revenue(
        gold.product_performance(s.orderitem, s.order, s.product, s.tenant)))

register("low_stock_alert", "C5", with_fixtures("""
SELECT p.tenant_id, t.name AS tenant_name, p.id AS product_id, p.name AS product_name,
       p.stock_quantity, cast(p.price AS double) AS price
FROM t_product p JOIN t_tenant t ON t.id = p.tenant_id
WHERE p.stock_quantity < 50"""))(
    lambda s: gold.low_stock_alert(s.product, s.tenant))

register("customer_ltv", "C6", with_fixtures(f"""
SELECT o.tenant_id, t.name AS tenant_name, o.customer_id, c.email,
       count(o.id) AS total_orders, cast(sum(o.total) AS double) AS lifetime_value,
       {avg_money('o.total')} AS avg_order_value,
       min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date,
       cast(date_diff('day', cast(min(o.order_date) AS date), cast(max(o.order_date) AS date)) AS integer)
         AS customer_age_days
FROM t_order o JOIN t_customer c ON c.id = o.customer_id AND c.tenant_id = o.tenant_id
JOIN t_tenant t ON t.id = o.tenant_id
WHERE o.status = 'completed'
GROUP BY o.tenant_id, t.name, o.customer_id, c.email"""))(
    lambda s: gold.customer_ltv(s.order, s.customer, s.tenant))

register("customer_acquisition", "C7", with_fixtures(f"""
SELECT c.tenant_id, t.name AS tenant_name, {month('c.created_at')} AS month,
       count(c.id) AS new_customers
FROM t_customer c JOIN t_tenant t ON t.id = c.tenant_id
GROUP BY c.tenant_id, t.name, {month('c.created_at')}"""))(
    lambda s: gold.customer_acquisition(s.customer, s.tenant))

register("active_subscriptions", "C8", with_fixtures("""
SELECT s.tenant_id, t.name AS tenant_name, count(s.id) AS active_subscription_count,
       cast(sum(s.monthly_amount) AS double) AS monthly_recurring_revenue
FROM t_sub s JOIN t_tenant t ON t.id = s.tenant_id
WHERE s.status = 'active'
GROUP BY s.tenant_id, t.name"""))(
    lambda s: gold.active_subscriptions(s.subscription, s.tenant))

register("tenant_summary", "C9", with_fixtures("""
SELECT t.id AS tenant_id, t.name AS tenant_name, t.slug AS tenant_slug, t.is_active,
       coalesce(c.n, 0) AS customer_count
FROM t_tenant t LEFT JOIN (SELECT tenant_id, count(id) AS n FROM t_customer GROUP BY tenant_id) c
  ON c.tenant_id = t.id"""))(
    lambda s: gold.tenant_summary(s.tenant, s.customer))
