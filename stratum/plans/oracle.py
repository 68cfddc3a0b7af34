"""DuckDB oracle: the fixture entities as SQL CTEs over the driver's views.

The driver runs each ``oracle_sql()`` string in DuckDB with the driver
tables registered as views.  ``with_fixtures`` prefixes a query with the
CTEs it references (and their dependencies), written independently of
the Spark fixtures in ``sources.fixtures`` so that both sides check each
other.
"""

from __future__ import annotations

import re

_PLAN = ("CASE WHEN n_nationkey % 8 < 2 THEN 'enterprise' WHEN n_nationkey % 8 < 5 "
         "THEN 'professional' ELSE 'starter' END")

CTES: dict[str, str] = {
    "t_tenant": f"""
SELECT cast(n_nationkey AS varchar) AS id, n_name AS name,
       lower(replace(n_name, '_', '-')) AS slug,
       lower(replace(n_name, '_', '-')) || '.example.com' AS domain,
       n_nationkey % 10 <> 9 AS is_active,
       {_PLAN} AS plan_type,
       cast(40 + n_nationkey * 40 AS integer) AS max_users,
       CASE {_PLAN}
         WHEN 'enterprise' THEN ['analytics', 'api_access', 'custom_domain', 'priority_support', 'sso']
         WHEN 'professional' THEN ['analytics', 'api_access', 'custom_domain']
         ELSE ['analytics'] END AS features,
       timestamp '1994-01-01 00:00:00' + to_days(n_nationkey) AS created_at
FROM nation""",
    "t_customer": """
SELECT cast(c_custkey AS varchar) AS id, cast(c_nationkey AS varchar) AS tenant_id,
       trim(lower('  ' || upper(c_name) || '@Example.COM ')) AS email,
       '+1 (555) ' || substr(cast(1000000 + c_custkey AS varchar), 2, 3) || '-' ||
         substr(cast(1000000 + c_custkey AS varchar), 4, 4) AS phone,
       c_acctbal >= 0 AS is_active,
       cast(18 + c_custkey % 58 AS integer) AS age,
       c_mktsegment AS country,
       CASE c_custkey % 4 WHEN 0 THEN 'organic' WHEN 1 THEN 'paid_ad' WHEN 2 THEN 'referral'
            ELSE 'social' END AS signup_source,
       c_custkey % 2 = 0 AS newsletter,
       c_custkey % 3 = 0 AS notifications,
       timestamp '1995-01-01 00:00:00' + to_days(cast(c_custkey * 7 % 730 AS integer)) AS created_at
FROM customer""",
    "t_product": """
SELECT cast(p_partkey AS varchar) AS id, cast(p_partkey % 25 AS varchar) AS tenant_id,
       'SKU-' || p_partkey AS sku, p_name || ' ' || p_partkey AS name, p_name AS base_name,
       p_type AS category,
       cast(p_retailprice AS decimal(10,2)) AS price,
       cast(cast(p_retailprice AS decimal(10,2)) * cast(0.6 AS decimal(2,1)) AS decimal(10,2)) AS cost,
       cast(p_partkey * 37 % 501 AS integer) AS stock_quantity,
       p_partkey % 20 <> 0 AS is_active
FROM part""",
    "t_order": """
SELECT cast(o_orderkey AS varchar) AS id, cast(c_nationkey AS varchar) AS tenant_id,
       cast(o_custkey AS varchar) AS customer_id, 'ORD-' || o_orderkey AS order_number,
       CASE WHEN o_orderkey % 20 = 0 THEN 'cancelled' WHEN o_orderkey % 20 = 1 THEN 'pending'
            WHEN o_orderkey % 20 < 4 THEN 'processing' ELSE 'completed' END AS status,
       cast(cast(o_totalprice AS decimal(10,2))
            - cast(cast(o_totalprice AS decimal(10,2)) * cast(0.07 AS decimal(3,2)) AS decimal(10,2))
            - cast(o_orderkey % 51 AS decimal(10,2))
            + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS decimal(10,2)) AS subtotal,
       cast(cast(o_totalprice AS decimal(10,2)) * cast(0.07 AS decimal(3,2)) AS decimal(10,2)) AS tax,
       cast(o_orderkey % 51 AS decimal(10,2)) AS shipping,
       cast(o_totalprice AS decimal(10,2)) AS total,
       o_orderdate AS order_date,
       o_orderkey AS okey
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "t_item": """
SELECT concat_ws('-', cast(l_orderkey AS varchar), cast(l_linenumber AS varchar), cast(l_partkey AS varchar),
                 cast(l_suppkey AS varchar), cast(cast(l_extendedprice AS decimal(12,2)) AS varchar)) AS id,
       cast(l_orderkey AS varchar) AS order_id, cast(l_partkey AS varchar) AS product_id,
       cast(l_quantity AS integer) AS quantity,
       cast(p_retailprice AS decimal(10,2)) AS unit_price,
       cast(cast(round(l_discount * 100) AS integer) AS decimal(10,2)) AS discount,
       cast(cast(p_retailprice AS decimal(10,2)) * cast(l_quantity AS integer)
            - cast(cast(round(l_discount * 100) AS integer) AS decimal(10,2)) AS decimal(10,2)) AS total
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "t_event": """
SELECT cast(event_id AS varchar) AS id, cast(c_nationkey AS varchar) AS tenant_id,
       CASE WHEN event_id % 10 >= 7 THEN NULL ELSE cast(user_id AS varchar) END AS customer_id,
       CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view'
            WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'checkout'
            WHEN 'purchase' THEN 'purchase' END AS event_type,
       CASE event_id % 4
         WHEN 1 THEN replace(props, '}', ', "url": "/p/' || (event_id % 50) || '", "product_id": "'
                                    || (event_id % 200) || '"}')
         WHEN 2 THEN replace(props, '}', ', "search_term": "term ' || (event_id % 30) || '"}')
         ELSE props END AS event_data,
       cast(user_id % 97 AS varchar) || '-' || cast(cast(ts AS date) AS varchar) AS session_id,
       cast(10 + user_id % 200 AS varchar) || '.' || cast(event_id % 256 AS varchar) || '.7.9' AS ip_address,
       ts AS created_at,
       user_id AS uid
FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "t_sub": """
SELECT 'S' || c_custkey AS id, cast(c_nationkey AS varchar) AS tenant_id,
       cast(c_custkey AS varchar) AS customer_id, c_custkey AS ckey,
       CASE c_custkey % 4 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Pro' WHEN 2 THEN 'Premium'
            ELSE 'Enterprise' END AS plan_name,
       CASE WHEN c_custkey % 20 < 14 THEN 'active' WHEN c_custkey % 20 < 16 THEN 'trial'
            WHEN c_custkey % 20 < 19 THEN 'cancelled' ELSE 'expired' END AS status,
       cast(date '1998-01-01' + cast(c_custkey % 181 AS integer) AS date) AS start_date,
       cast(date '1998-01-01' + cast(c_custkey % 181 AS integer)
            + CASE WHEN c_custkey % 20 < 16 THEN 365 ELSE cast(30 + c_custkey % 151 AS integer) END
            AS date) AS end_date,
       cast(CASE c_custkey % 4 WHEN 0 THEN 9.99 WHEN 1 THEN 29.99 WHEN 2 THEN 99.99
            ELSE 299.99 END AS decimal(10,2)) AS monthly_amount,
       CASE WHEN c_custkey % 2 = 0 THEN 'monthly' ELSE 'yearly' END AS billing_cycle
FROM customer""",
    "t_invoice_k": """
SELECT s.id AS subscription_id, s.tenant_id, s.customer_id, s.ckey, s.status AS sub_status,
       s.monthly_amount AS amount, k.k AS k,
       (s.ckey * 7 + k.k * 13) % 20 AS h,
       cast(s.start_date + cast(30 * k.k AS integer) AS date) AS issue_date
FROM t_sub s JOIN LATERAL (SELECT unnest(range(0, date_diff('day', s.start_date, s.end_date) // 30 + 1)) AS k) k ON true""",
    "t_invoice": """
SELECT subscription_id || '-' || k AS id, tenant_id, customer_id, subscription_id,
       'INV-' || subscription_id || '-' || k AS invoice_number, amount, k,
       CASE WHEN sub_status = 'active' THEN CASE WHEN h < 17 THEN 'paid' WHEN h < 19 THEN 'sent' ELSE 'overdue' END
            WHEN sub_status = 'cancelled' THEN CASE WHEN (ckey + k) % 2 = 0 THEN 'paid' ELSE 'cancelled' END
            ELSE CASE WHEN (ckey + k) % 2 = 0 THEN 'paid' ELSE 'overdue' END END AS status,
       issue_date, cast(issue_date + 30 AS date) AS due_date, h,
       CASE WHEN (CASE WHEN sub_status = 'active' THEN h < 17 ELSE (ckey + k) % 2 = 0 END)
            THEN cast(issue_date + cast(1 + h AS integer) AS date) END AS paid_date
FROM t_invoice_k""",
    "t_order_log": """
SELECT 'I' AS op, order_date AS commit_ts, 0 AS seq, id, tenant_id, customer_id, status, total, order_date, okey
FROM t_order
UNION ALL
SELECT 'U', order_date + to_days(3), 1, id, tenant_id, customer_id, 'completed', total, order_date, okey
FROM t_order WHERE okey % 5 = 2
UNION ALL
SELECT 'U', order_date + to_days(5), 2, id, tenant_id, customer_id, 'pending', total, order_date, okey
FROM t_order WHERE okey % 35 = 2
UNION ALL
SELECT 'D', order_date + to_days(10), 3, id, tenant_id, customer_id, status, total, order_date, okey
FROM t_order WHERE okey % 50 = 0 OR okey % 55 = 2
UNION ALL
SELECT 'U', order_date + to_days(12), 4, id, tenant_id, customer_id, 'processing', total, order_date, okey
FROM t_order WHERE okey % 100 = 0""",
    # The entities with planted faults (see the Spark fixtures' rules).
    "t_tenant_f": """
SELECT * REPLACE (CASE WHEN cast(id AS bigint) % 7 = 3 THEN NULL ELSE name END AS name) FROM t_tenant""",
    "t_customer_f": """
SELECT * EXCLUDE (key) FROM (
  SELECT * REPLACE (
    CASE WHEN key % 11 = 3 THEN NULL WHEN key % 11 = 4 THEN 'no-address' WHEN key % 61 = 5 THEN 'same@example.com'
         ELSE email END AS email,
    CASE WHEN key % 13 = 5 THEN '' WHEN key % 13 = 6 THEN 'unknown' WHEN key % 13 = 7 THEN 'ghost'
         WHEN key % 61 = 5 THEN '1' ELSE tenant_id END AS tenant_id,
    CASE WHEN key % 17 = 2 THEN '123' WHEN key % 17 = 3 THEN NULL ELSE phone END AS phone)
  FROM (SELECT *, cast(id AS bigint) AS key FROM t_customer))""",
    "t_product_f": """
SELECT * REPLACE (cast(CASE WHEN cast(id AS bigint) % 23 = 1 THEN 0 ELSE price END AS decimal(10,2)) AS price,
                  CASE WHEN cast(id AS bigint) % 29 = 2 THEN -1 ELSE stock_quantity END AS stock_quantity,
                  CASE WHEN cast(id AS bigint) % 50 = 3 THEN 'SKU-TWIN' ELSE sku END AS sku) FROM t_product""",
    "t_order_f": """
SELECT * REPLACE (CASE WHEN okey % 101 = 7 THEN 'lost' ELSE status END AS status,
                  cast(CASE WHEN okey % 103 = 8 THEN -1 WHEN okey % 103 = 9 THEN NULL ELSE total END
                       AS decimal(10,2)) AS total,
                  CASE WHEN okey % 107 = 9 THEN 'ghost' ELSE customer_id END AS customer_id,
                  CASE WHEN okey % 109 = 10 THEN 'ORD-TWIN' ELSE order_number END AS order_number) FROM t_order""",
    "t_item_f": """
SELECT * REPLACE (CASE WHEN cast(order_id AS bigint) % 113 = 1 THEN 0 ELSE quantity END AS quantity,
                  CASE WHEN cast(order_id AS bigint) % 127 = 2 THEN 'ghost' ELSE product_id END AS product_id)
FROM t_item""",
    "t_event_f": """
SELECT * REPLACE (CASE WHEN cast(id AS bigint) % 131 = 3 THEN 'odd' ELSE event_type END AS event_type,
                  CASE WHEN cast(id AS bigint) % 137 = 4 THEN 'ghost' ELSE customer_id END AS customer_id)
FROM t_event""",
    "t_sub_f": """
SELECT * REPLACE (CASE WHEN ckey % 41 = 5 THEN 'paused' ELSE status END AS status,
                  CASE WHEN ckey % 43 = 6 THEN 'daily' ELSE billing_cycle END AS billing_cycle,
                  CASE WHEN ckey % 47 = 7 THEN 'ghost' ELSE tenant_id END AS tenant_id) FROM t_sub""",
    "t_invoice_f": """
SELECT * REPLACE (CASE WHEN cast(customer_id AS bigint) % 37 = 2 THEN 'void' ELSE status END AS status,
                  CASE WHEN cast(customer_id AS bigint) % 53 = 3 THEN 'ghost' ELSE subscription_id END AS subscription_id,
                  CASE WHEN cast(customer_id AS bigint) % 59 = 4 THEN 'INV-TWIN' ELSE invoice_number END AS invoice_number)
FROM t_invoice""",
}

_REF = re.compile(r"\bt_[a-z_]+\b")


def _deps(name: str) -> list[str]:
    return [d for d in dict.fromkeys(_REF.findall(CTES[name])) if d in CTES and d != name]


def with_fixtures(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the fixture CTEs it references, in dependency order.

    ``extra`` adds query-local CTEs (name -> body) placed after the fixtures.
    """
    extra = extra or {}
    text = sql + " ".join(extra.values())
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    for n in dict.fromkeys(_REF.findall(text)):
        if n in CTES:
            visit(n)
    parts = [f"{n} AS ({CTES[n].strip()})" for n in order]
    parts += [f"{n} AS ({body.strip()})" for n, body in extra.items()]
    if not parts:
        return sql.strip()
    return "WITH " + ",\n".join(parts) + "\n" + sql.strip()


# ---- DuckDB spellings of the money/date conventions in ``functions``
def avg_money(x: str) -> str:
    """Half-up average of a non-negative money column, in cents, as double."""
    return f"cast((2 * cast(sum({x}) * 100 AS hugeint) + count({x})) // (2 * count({x})) AS double) / 100"


def ratio_money(total: str, n: str) -> str:
    """Half-up total/n (total money >= 0, n integer > 0) as double; NULL for n = 0."""
    return (f"cast((2 * cast(({total}) * 100 AS hugeint) + ({n})) // nullif(2 * ({n}), 0) AS double) / 100")


def month(x: str) -> str:
    return f"cast(date_trunc('month', {x}) AS date)"
