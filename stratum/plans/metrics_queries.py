"""Planned metrics, with their DuckDB oracles."""

from __future__ import annotations

from ..operators import metrics as M
from .oracle import avg_money, month, with_fixtures
from .registry import register

SNAPSHOT_AS_OF = "1996-06-30 00:00:00"
LIFECYCLE_AS_OF = "1998-08-01 00:00:00"


def _pct(part: str, whole: str) -> str:
    return f"CASE WHEN ({whole}) <> 0 THEN cast({part} AS double) * 100.0 / cast({whole} AS double) END"


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN ({whole}) <> 0 THEN cast({part} AS double) / cast({whole} AS double) END"


register("revenue_daily", "F1", with_fixtures(f"""
SELECT tenant_id, cast(order_date AS date) AS day, count(id) AS order_count,
       count(DISTINCT customer_id) AS unique_customers, cast(sum(total) AS double) AS total_revenue,
       {avg_money('total')} AS avg_order_value
FROM t_order WHERE status = 'completed' GROUP BY tenant_id, cast(order_date AS date)"""))(
    lambda s: M.revenue_daily(s.order))


def _growth_sql(bucket: str, step: str) -> str:
    return with_fixtures(f"""
SELECT a.tenant_id, a.period, cast(a.revenue AS double) AS revenue, cast(p.revenue AS double) AS prev_revenue,
       {_pct('a.revenue - p.revenue', 'p.revenue')} AS growth_pct
FROM agg a LEFT JOIN agg p ON p.tenant_id = a.tenant_id AND p.period + INTERVAL {step} = a.period""",
                         extra={"agg": f"""
SELECT tenant_id, cast(date_trunc('{bucket}', order_date) AS date) AS period, sum(total) AS revenue
FROM t_order WHERE status = 'completed' GROUP BY 1, 2"""})


register("revenue_growth_mom", "F2", _growth_sql("month", "1 MONTH"))(
    lambda s: M.revenue_growth(s.order, "month"))
register("revenue_growth_qoq", "F2", _growth_sql("quarter", "3 MONTH"))(
    lambda s: M.revenue_growth(s.order, "quarter"))

_SOLD = """
SELECT i.id, i.product_id, i.quantity, i.total, o.tenant_id, o.order_date
FROM t_item i JOIN t_order o ON o.id = i.order_id WHERE o.status = 'completed'"""

register("category_performance", "F3", with_fixtures(f"""
SELECT p.category, count(s.id) AS times_ordered, cast(sum(s.quantity) AS bigint) AS units_sold,
       cast(sum(s.total) AS double) AS revenue,
       {_pct('sum(s.total)', 'sum(sum(s.total)) OVER ()')} AS revenue_share_pct
FROM sold s JOIN t_product p ON p.id = s.product_id GROUP BY p.category""", extra={"sold": _SOLD}))(
    lambda s: M.category_performance(s.orderitem, s.order, s.product))

register("category_trends", "F3", with_fixtures(f"""
SELECT a.category, a.month, cast(a.revenue AS double) AS revenue, cast(p.revenue AS double) AS prev_revenue,
       {_pct('a.revenue - p.revenue', 'p.revenue')} AS change_pct
FROM cat a LEFT JOIN cat p ON p.category = a.category AND p.month + INTERVAL 1 MONTH = a.month""",
                                           extra={"sold": _SOLD, "cat": f"""
SELECT p.category, {month('s.order_date')} AS month, sum(s.total) AS revenue
FROM sold s JOIN t_product p ON p.id = s.product_id GROUP BY 1, 2"""}))(
    lambda s: M.category_trends(s.orderitem, s.order, s.product))

register("customer_snapshot", "F4", with_fixtures(f"""
SELECT tenant_id, count(id) AS total_customers,
       count(*) FILTER (WHERE created_at > timestamp '{SNAPSHOT_AS_OF}' - INTERVAL 30 DAY) AS new_customers
FROM t_customer WHERE created_at <= timestamp '{SNAPSHOT_AS_OF}' GROUP BY tenant_id"""))(
    lambda s: M.customer_snapshot(s.customer, SNAPSHOT_AS_OF))

register("retention_cohorts", "F5", with_fixtures(f"""
SELECT c.cohort_month, cast(date_diff('month', c.cohort_month, m.month) AS integer) AS months_since,
       count(*) AS active_customers, z.cohort_size,
       {_ratio('count(*)', 'z.cohort_size')} AS retention_rate
FROM cm m JOIN (SELECT customer_id, min(month) AS cohort_month FROM cm GROUP BY customer_id) c
  ON c.customer_id = m.customer_id
JOIN (SELECT cohort_month, count(*) AS cohort_size
      FROM (SELECT customer_id, min(month) AS cohort_month FROM cm GROUP BY customer_id) GROUP BY 1) z
  ON z.cohort_month = c.cohort_month
GROUP BY c.cohort_month, months_since, z.cohort_size""", extra={"cm": f"""
SELECT DISTINCT customer_id, {month('order_date')} AS month FROM t_order WHERE status = 'completed'"""}))(
    lambda s: M.retention_cohorts(s.order))

register("customer_lifecycle", "F6", with_fixtures(f"""
SELECT c.id AS customer_id, c.tenant_id, p.first_order_date, p.last_order_date,
       CASE WHEN p.first_order_date IS NULL THEN 'prospect'
            WHEN p.first_order_date >= timestamp '{LIFECYCLE_AS_OF}' - INTERVAL 90 DAY THEN 'new'
            WHEN p.last_order_date >= timestamp '{LIFECYCLE_AS_OF}' - INTERVAL 90 DAY THEN 'active'
            ELSE 'churned' END AS stage
FROM t_customer c LEFT JOIN (
  SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date
  FROM t_order WHERE status = 'completed' AND order_date <= timestamp '{LIFECYCLE_AS_OF}'
  GROUP BY customer_id) p ON p.customer_id = c.id"""))(
    lambda s: M.customer_lifecycle(s.customer, s.order, LIFECYCLE_AS_OF))

_TYPES = ["page_view", "product_view", "search", "add_to_cart", "remove_from_cart", "checkout",
          "purchase", "click"]
register("funnel_hourly", "F7", with_fixtures(
    "SELECT tenant_id, date_trunc('hour', created_at) AS hour, "
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in _TYPES)
    + " FROM t_event GROUP BY tenant_id, date_trunc('hour', created_at)"))(
    lambda s: M.funnel_hourly(s.event))

_STEPS = ["page_view", "product_view", "add_to_cart", "checkout", "purchase"]
_FLAGS = ("SELECT tenant_id, session_id, " + ", ".join(
    f"bool_or(event_type = '{t}') AS {t}" for t in _STEPS) + " FROM t_event GROUP BY tenant_id, session_id")
_REACH = " UNION ALL ".join(
    f"SELECT {i + 1} AS step_no, '{t}' AS step, count(*) FILTER (WHERE "
    + " AND ".join(_STEPS[:i + 1]) + ") AS sessions FROM flags" for i, t in enumerate(_STEPS))
register("funnel_conversion", "F8", with_fixtures(f"""
SELECT step_no, step, sessions,
       {_ratio('sessions', 'lag(sessions) OVER (ORDER BY step_no)')} AS rate_from_prev,
       {_ratio('sessions', 'first_value(sessions) OVER (ORDER BY step_no)')} AS rate_from_start
FROM reach""", extra={"flags": _FLAGS, "reach": _REACH}))(
    lambda s: M.funnel_conversion(s.event))

register("cart_abandonment", "F9", with_fixtures(f"""
SELECT tenant_id, count(*) FILTER (WHERE cart) AS cart_sessions,
       count(*) FILTER (WHERE cart AND NOT bought) AS abandoned_sessions,
       {_ratio("count(*) FILTER (WHERE cart AND NOT bought)", "count(*) FILTER (WHERE cart)")}
         AS abandonment_rate
FROM (SELECT session_id, tenant_id, bool_or(event_type = 'add_to_cart') AS cart,
             bool_or(event_type = 'purchase') AS bought
      FROM t_event GROUP BY tenant_id, session_id) GROUP BY tenant_id"""))(
    lambda s: M.cart_abandonment(s.event))

register("session_duration_trend", "F10", with_fixtures("""
SELECT cast(st AS date) AS day, count(*) AS sessions,
       cast(sum(date_diff('microsecond', st, en)) AS double) / count(*) / 1000000 AS avg_duration_seconds
FROM (SELECT tenant_id, session_id, min(created_at) AS st, max(created_at) AS en
      FROM t_event GROUP BY tenant_id, session_id)
GROUP BY cast(st AS date)"""))(
    lambda s: M.session_duration_trend(s.event))

_W = "CASE event_type " + " ".join(
    f"WHEN '{t}' THEN {w}" for t, w in
    [("page_view", 1), ("product_view", 2), ("search", 1), ("click", 1), ("add_to_cart", 5),
     ("remove_from_cart", 0), ("checkout", 8), ("purchase", 10)]) + " ELSE 0 END"
register("engagement_score", "F11", with_fixtures(f"""
SELECT tenant_id, customer_id, event_count, score,
       cast(rank() OVER (ORDER BY score DESC) AS bigint) AS score_rank,
       cast(1 + (4 * (rank() OVER (ORDER BY score DESC) - 1)) // count(*) OVER () AS integer) AS band
FROM (SELECT tenant_id, customer_id, count(*) AS event_count, cast(sum({_W}) AS bigint) AS score
      FROM t_event WHERE customer_id IS NOT NULL GROUP BY tenant_id, customer_id)"""))(
    lambda s: M.engagement_score(s.event))

register("inventory_turnover", "F12", with_fixtures(f"""
SELECT p.id AS product_id, p.tenant_id, coalesce(u.units, 0) AS units_sold, p.stock_quantity,
       {_ratio('coalesce(u.units, 0)', 'p.stock_quantity')} AS turnover
FROM t_product p LEFT JOIN (SELECT product_id, cast(sum(quantity) AS bigint) AS units FROM sold
                            GROUP BY product_id) u ON u.product_id = p.id""", extra={"sold": _SOLD}))(
    lambda s: M.inventory_turnover(s.orderitem, s.order, s.product))

register("product_profitability", "F13", with_fixtures(f"""
SELECT u.product_id, p.tenant_id, u.units AS units_sold, cast(u.rev AS double) AS revenue,
       cast(p.cost * u.units AS double) AS cost_of_goods, cast(u.rev - p.cost * u.units AS double) AS gross_profit,
       {_pct('u.rev - p.cost * u.units', 'u.rev')} AS margin_pct
FROM (SELECT product_id, cast(sum(quantity) AS bigint) AS units, sum(total) AS rev FROM sold GROUP BY product_id) u
JOIN t_product p ON p.id = u.product_id""", extra={"sold": _SOLD}))(
    lambda s: M.product_profitability(s.orderitem, s.order, s.product))

register("best_sellers_by_tenant", "F14", with_fixtures("""
SELECT tenant_id, cast(rank AS integer) AS rank, product_id, cast(rev AS double) AS revenue, units AS units_sold
FROM (SELECT tenant_id, product_id, sum(total) AS rev, cast(sum(quantity) AS bigint) AS units,
             row_number() OVER (PARTITION BY tenant_id ORDER BY sum(total) DESC, product_id) AS rank
      FROM sold GROUP BY tenant_id, product_id) WHERE rank <= 5""", extra={"sold": _SOLD}))(
    lambda s: M.best_sellers_by_tenant(s.orderitem, s.order))

register("mrr_arr", "F15", with_fixtures("""
SELECT tenant_id, count(id) AS active_subscriptions, cast(sum(monthly_amount) AS double) AS mrr,
       cast(sum(monthly_amount) * 12 AS double) AS arr
FROM t_sub WHERE status = 'active' GROUP BY tenant_id"""))(
    lambda s: M.mrr_arr(s.subscription))

register("subscription_churn", "F16", with_fixtures(f"""
SELECT m.month,
       (SELECT count(*) FROM t_sub s WHERE s.start_date < m.month AND (s.end_date IS NULL OR s.end_date >= m.month))
         AS active_at_start,
       (SELECT count(*) FROM t_sub s WHERE s.status IN ('cancelled', 'expired')
          AND {month('s.end_date')} = m.month) AS churned,
       {_ratio(
           "(SELECT count(*) FROM t_sub s WHERE s.status IN ('cancelled', 'expired') AND " + month('s.end_date') + " = m.month)",
           "(SELECT count(*) FROM t_sub s WHERE s.start_date < m.month AND (s.end_date IS NULL OR s.end_date >= m.month))")}
         AS churn_rate
FROM (SELECT cast(unnest(generate_series(min({month('start_date')}),
                                         max({month('coalesce(end_date, start_date)')}),
                                         INTERVAL 1 MONTH)) AS date) AS month FROM t_sub) m"""))(
    lambda s: M.subscription_churn(s.subscription))

register("plan_distribution", "F17", with_fixtures(f"""
SELECT plan_name, count(id) AS subscription_count,
       {_pct('count(id)', 'sum(count(id)) OVER ()')} AS share_pct,
       cast(sum(monthly_amount) AS double) AS monthly_amount_total
FROM t_sub GROUP BY plan_name"""))(
    lambda s: M.plan_distribution(s.subscription))

register("payment_success_rate", "F18", with_fixtures(f"""
SELECT tenant_id, count(*) FILTER (WHERE status = 'paid') AS paid,
       count(*) FILTER (WHERE status IN ('paid', 'sent', 'overdue')) AS billed,
       {_ratio("count(*) FILTER (WHERE status = 'paid')",
               "count(*) FILTER (WHERE status IN ('paid', 'sent', 'overdue'))")} AS success_rate
FROM t_invoice GROUP BY tenant_id"""))(
    lambda s: M.payment_success_rate(s.invoice))

register("repeat_concentration", "F19", with_fixtures(f"""
SELECT tenant_id, count(*) AS customers, cast(sum(n) AS bigint) AS orders,
       count(*) FILTER (WHERE rk <= (customers_t * 30 + 99) // 100) AS top_customers,
       cast(coalesce(sum(n) FILTER (WHERE rk <= (customers_t * 30 + 99) // 100), 0) AS bigint) AS top_orders,
       {_ratio("coalesce(sum(n) FILTER (WHERE rk <= (customers_t * 30 + 99) // 100), 0)", "sum(n)")}
         AS top_order_share
FROM (SELECT tenant_id, n, rank() OVER (PARTITION BY tenant_id ORDER BY n DESC) AS rk,
             count(*) OVER (PARTITION BY tenant_id) AS customers_t
      FROM (SELECT tenant_id, customer_id, count(id) AS n FROM t_order WHERE status = 'completed'
            GROUP BY tenant_id, customer_id))
GROUP BY tenant_id"""))(
    lambda s: M.repeat_concentration(s.order))

register("star_dim_date", "F20", with_fixtures("""
SELECT cast(year(d) * 10000 + month(d) * 100 + day(d) AS integer) AS date_key, d AS date,
       cast(year(d) AS integer) AS year, cast(quarter(d) AS integer) AS quarter,
       cast(month(d) AS integer) AS month, cast(isodow(d) AS integer) AS day_of_week,
       isodow(d) >= 6 AS is_weekend
FROM (SELECT cast(unnest(generate_series(min(cast(order_date AS date)), max(cast(order_date AS date)),
                                         INTERVAL 1 DAY)) AS date) AS d FROM t_order)"""))(
    lambda s: M.dim_date(s.order))

register("star_fact_sales", "F20", with_fixtures("""
SELECT i.id AS item_id, i.order_id, i.product_id, o.customer_id, o.tenant_id, o.status,
       cast(year(o.order_date) * 10000 + month(o.order_date) * 100 + day(o.order_date) AS integer) AS date_key,
       i.quantity, cast(i.total AS double) AS revenue, cast(p.cost * i.quantity AS double) AS cost
FROM t_item i JOIN t_order o ON o.id = i.order_id LEFT JOIN t_product p ON p.id = i.product_id"""))(
    lambda s: M.fact_sales(s.orderitem, s.order, s.product))

register("anonymous_share", "F21", with_fixtures(f"""
SELECT tenant_id, count(*) AS events, count(*) FILTER (WHERE customer_id IS NULL) AS anonymous_events,
       count(*) FILTER (WHERE customer_id IS NOT NULL) AS known_events,
       {_ratio("count(*) FILTER (WHERE customer_id IS NULL)", "count(*)")} AS anonymous_share
FROM t_event GROUP BY tenant_id"""))(
    lambda s: M.anonymous_share(s.event))
