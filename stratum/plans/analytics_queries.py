"""D1q-D19q: the shipped SQL analytics, with their DuckDB oracles."""

from __future__ import annotations

from ..operators import analytics as A
from .oracle import avg_money, month, with_fixtures
from .registry import register
from .silver_queries import named_bronze

_COUNTS = """
SELECT 'core_tenant' AS table_name, count(*) AS row_count FROM t_tenant
UNION ALL SELECT 'core_customer', count(*) FROM t_customer
UNION ALL SELECT 'core_order', count(*) FROM t_order_log
UNION ALL SELECT 'core_product', count(*) FROM t_product
UNION ALL SELECT 'core_event', count(*) FROM t_event
UNION ALL SELECT 'core_subscription', count(*) FROM t_sub
UNION ALL SELECT 'core_invoice', count(*) FROM t_invoice"""

register("entity_row_counts", "D1q", with_fixtures(_COUNTS))(
    lambda s: A.entity_row_counts(s.tables(), s.order_changes()))

register("tenant_details", "D2q", with_fixtures("""
SELECT id, name, slug, is_active, plan_type, max_users FROM t_tenant ORDER BY id LIMIT 10"""))(
    lambda s: A.tenant_details(named_bronze(s, "tenant")))

register("customers_by_tenant", "D3q", with_fixtures("""
SELECT tenant_id, count(*) AS customer_count FROM t_customer GROUP BY tenant_id"""))(
    lambda s: A.customers_by_tenant(s.customer))

register("orders_by_status", "D4q", with_fixtures("""
SELECT status, count(*) AS order_count, cast(sum(total) AS double) AS total_amount
FROM t_order GROUP BY status"""))(
    lambda s: A.orders_by_status(s.order))

register("revenue_by_tenant", "D5q", with_fixtures(f"""
SELECT t.name AS tenant_name, count(DISTINCT o.id) AS order_count,
       cast(sum(o.total) AS double) AS total_revenue, {avg_money('o.total')} AS avg_order_value
FROM t_tenant t JOIN t_order o ON o.tenant_id = t.id
WHERE o.status = 'completed' GROUP BY t.name"""))(
    lambda s: A.revenue_by_tenant(s.order, s.tenant))

register("products_by_category", "D6q", with_fixtures(f"""
SELECT category, count(*) AS product_count, {avg_money('price')} AS avg_price
FROM t_product GROUP BY category"""))(
    lambda s: A.products_by_category(s.product))

register("top_products_by_orders", "D7q", with_fixtures("""
SELECT p.name AS product_name, p.category, count(*) AS times_ordered,
       cast(sum(i.quantity) AS bigint) AS total_quantity
FROM t_item i JOIN t_product p ON i.product_id = p.id
GROUP BY p.name, p.category
ORDER BY times_ordered DESC, product_name, category LIMIT 20"""))(
    lambda s: A.top_products_by_orders(s.orderitem, s.product))

register("top_products_completed", "D8q", with_fixtures("""
SELECT p.name AS product_name, p.category, count(i.id) AS times_ordered,
       cast(sum(i.quantity) AS bigint) AS total_quantity, cast(sum(i.total) AS double) AS total_revenue
FROM t_product p JOIN t_item i ON i.product_id = p.id JOIN t_order o ON o.id = i.order_id
WHERE o.status = 'completed'
GROUP BY p.name, p.category
ORDER BY total_revenue DESC, product_name, category LIMIT 20"""))(
    lambda s: A.top_products_completed(s.orderitem, s.order, s.product))

register("events_by_type", "D9q", with_fixtures("""
SELECT event_type, count(*) AS event_count, count(DISTINCT customer_id) AS unique_customers
FROM t_event GROUP BY event_type"""))(
    lambda s: A.events_by_type(s.event))

register("event_funnel_pct", "D10q", with_fixtures("""
SELECT event_type, event_count,
       cast((2 * 10000 * event_count + sum(event_count) OVER ()) // (2 * sum(event_count) OVER ()) AS double) / 100
         AS percentage
FROM event_counts""", extra={"event_counts": """
SELECT event_type, count(*) AS event_count FROM t_event GROUP BY event_type"""}))(
    lambda s: A.event_funnel_pct(s.event))

register("event_funnel_named", "D11q", with_fixtures("""
SELECT event_type, count(*) AS event_count, count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT session_id) AS unique_sessions
FROM t_event GROUP BY event_type"""))(
    lambda s: A.event_funnel_named(s.event))

register("subscriptions_by_status", "D12q", with_fixtures("""
SELECT status, count(*) AS subscription_count, cast(sum(monthly_amount) AS double) AS total_mrr
FROM t_sub GROUP BY status"""))(
    lambda s: A.subscriptions_by_status(s.subscription))

register("mrr_by_tenant", "D12q", with_fixtures(f"""
SELECT t.name AS tenant_name, count(s.id) AS active_subscriptions,
       cast(sum(s.monthly_amount) AS double) AS mrr,
       {avg_money('s.monthly_amount')} AS avg_subscription_value
FROM t_tenant t JOIN t_sub s ON s.tenant_id = t.id
WHERE s.status = 'active' GROUP BY t.name"""))(
    lambda s: A.mrr_by_tenant(s.subscription, s.tenant))

register("invoices_by_status", "D13q", with_fixtures("""
SELECT status, count(*) AS invoice_count, cast(sum(amount) AS double) AS total_amount
FROM t_invoice GROUP BY status"""))(
    lambda s: A.invoices_by_status(s.invoice))

register("record_counts_summary", "D14q", with_fixtures("""
SELECT 'Tenants' AS entity, count(*) AS record_count FROM t_tenant
UNION ALL SELECT 'Customers', count(*) FROM t_customer
UNION ALL SELECT 'Products', count(*) FROM t_product
UNION ALL SELECT 'Orders', count(*) FROM t_order_log WHERE op = 'I'
UNION ALL SELECT 'Order Items', count(*) FROM t_item
UNION ALL SELECT 'Events', count(*) FROM t_event
UNION ALL SELECT 'Subscriptions', count(*) FROM t_sub
UNION ALL SELECT 'Invoices', count(*) FROM t_invoice
ORDER BY record_count DESC"""))(
    lambda s: A.record_counts_summary(s.tables(), s.order_changes()))

register("null_key_checks", "D15q", with_fixtures("""
SELECT 'core_tenant' AS table_name, count(*) FILTER (WHERE id IS NULL) AS null_ids,
       count(*) FILTER (WHERE name IS NULL) AS null_names, count(*) AS total_records FROM t_tenant_f
UNION ALL
SELECT 'core_customer', count(*) FILTER (WHERE id IS NULL), count(*) FILTER (WHERE email IS NULL), count(*)
FROM t_customer_f
UNION ALL
SELECT 'core_order', count(*) FILTER (WHERE id IS NULL), count(*) FILTER (WHERE total IS NULL), count(*)
FROM t_order_f"""))(
    lambda s: A.null_key_checks(s.faulty("tenant"), s.faulty("customer"), s.faulty("order")))

register("business_summary", "D16q", with_fixtures("""
SELECT (SELECT count(*) FROM t_tenant) AS total_tenants,
       (SELECT count(*) FROM t_customer) AS total_customers,
       (SELECT count(*) FROM t_order WHERE status = 'completed') AS completed_orders,
       (SELECT cast(sum(total) AS double) FROM t_order WHERE status = 'completed') AS total_revenue,
       (SELECT cast(sum(monthly_amount) AS double) FROM t_sub WHERE status = 'active') AS total_mrr,
       (SELECT count(*) FROM t_event) AS total_events"""))(
    lambda s: A.business_summary(s.spark, s.tables()))

register("tenant_dashboard", "D17q", with_fixtures(f"""
SELECT t.name AS tenant_name, coalesce(c.customers, 0) AS customers, coalesce(o.orders, 0) AS orders,
       o.revenue, o.avg_order_value
FROM t_tenant t
LEFT JOIN (SELECT tenant_id, count(id) AS customers FROM t_customer GROUP BY tenant_id) c ON c.tenant_id = t.id
LEFT JOIN (SELECT tenant_id, count(id) AS orders, cast(sum(total) AS double) AS revenue,
                  {avg_money('total')} AS avg_order_value
           FROM t_order WHERE status = 'completed' GROUP BY tenant_id) o ON o.tenant_id = t.id"""))(
    lambda s: A.tenant_dashboard(s.tenant, s.customer, s.order))

register("acquisition_with_prev", "D18q", with_fixtures(f"""
SELECT {month('created_at')} AS month, tenant_id, count(*) AS new_customers,
       lag(count(*)) OVER (PARTITION BY tenant_id ORDER BY {month('created_at')}) AS prev_month
FROM t_customer GROUP BY {month('created_at')}, tenant_id"""))(
    lambda s: A.acquisition_with_prev(s.spark, s.customer))

register("customer_acquisition_global", "D19q", with_fixtures(f"""
SELECT {month('created_at')} AS month, count(*) AS new_customers
FROM t_customer GROUP BY {month('created_at')}"""))(
    lambda s: A.customer_acquisition_global(s.customer))

