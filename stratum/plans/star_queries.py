"""Effective-dated dimensions and the sales fact keyed by them (F20), with their DuckDB oracles.

Every dimension is loaded twice: first the changes with an odd sequence number, then the
others, so the second load brings late changes that split versions of the first.
"""

from __future__ import annotations

from ..operators import star
from ..sources.staging import staged
from .oracle import with_fixtures
from .registry import register

CUSTOMER, PRODUCT, TENANT = ["tenant_id", "email", "country"], ["tenant_id", "sku", "category", "cost"], ["name", "plan_type"]


def _loaded(changes, attrs):
    first = staged(star.history_of(changes.where("seq % 2 = 1"), "id", attrs), "history", release=True)
    both = staged(star.history_of(changes.where("seq % 2 = 0"), "id", attrs, first), "history", release=True)
    return star.versions(both, "id")


def _customers(s):
    return _loaded(s.customer_changes(), CUSTOMER)


def _products(s):
    return _loaded(s.product_changes(), PRODUCT)


def _tenants(s):
    return _loaded(s.tenant_changes(), TENANT)


_LOGS = {
    "t_customer_log": """
SELECT id, created_at AS since, false AS gone, tenant_id, email, country FROM t_customer
UNION ALL SELECT id, created_at + to_days(30), false, tenant_id, email, country FROM t_customer WHERE cast(id AS bigint) % 7 = 0
UNION ALL SELECT id, created_at + to_days(400), false, tenant_id, email, 'MOVED' FROM t_customer WHERE cast(id AS bigint) % 9 = 4
UNION ALL SELECT id, created_at + to_days(500), false, tenant_id, email, country FROM t_customer WHERE cast(id AS bigint) % 27 = 4
UNION ALL SELECT id, created_at + to_days(600), true, tenant_id, email, 'MOVED' FROM t_customer WHERE cast(id AS bigint) % 45 = 4""",
    "t_product_log": """
SELECT id, timestamp '1994-06-01' AS since, false AS gone, tenant_id, sku, category, cost FROM t_product
UNION ALL SELECT id, timestamp '1996-01-01', false, tenant_id, sku, category, cast(cost * 1.1 AS decimal(10,2))
FROM t_product WHERE cast(id AS bigint) % 3 = 0
UNION ALL SELECT id, timestamp '1996-09-01', false, tenant_id, sku, 'CLEARANCE',
  CASE WHEN cast(id AS bigint) % 3 = 0 THEN cast(cost * 1.1 AS decimal(10,2)) ELSE cost END
FROM t_product WHERE cast(id AS bigint) % 10 = 1
UNION ALL SELECT id, timestamp '1997-01-01', false, tenant_id, sku, category, cost FROM t_product WHERE cast(id AS bigint) % 12 = 0""",
    "t_tenant_log": """
SELECT id, created_at AS since, false AS gone, name, plan_type FROM t_tenant
UNION ALL SELECT id, timestamp '1996-07-01', false, name, 'enterprise' FROM t_tenant WHERE cast(id AS bigint) % 4 = 1
UNION ALL SELECT id, timestamp '1997-07-01', false, name, plan_type FROM t_tenant WHERE cast(id AS bigint) % 8 = 1""",
}


def _versions_sql(log: str, attrs: list[str]) -> str:
    cols = ", ".join(attrs)
    return f"""
SELECT md5(id || '|' || cast(epoch_us(since) AS varchar)) AS sk, id, {cols}, since AS valid_from, nxt AS valid_to,
       nxt IS NULL AS is_current
FROM (SELECT *, lead(since) OVER (PARTITION BY id ORDER BY since) AS nxt
      FROM (SELECT *, lag(row(gone, {cols})) OVER (PARTITION BY id ORDER BY since) AS was FROM {log})
      WHERE was IS DISTINCT FROM row(gone, {cols}))
WHERE NOT gone"""


_DIMS = _LOGS | {"t_dim_customer": _versions_sql("t_customer_log", CUSTOMER),
                 "t_dim_product": _versions_sql("t_product_log", PRODUCT),
                 "t_dim_tenant": _versions_sql("t_tenant_log", TENANT)}


def _sk(alias: str, key: str) -> str:
    return f"CASE WHEN {key} IS NULL THEN 'unknown' ELSE coalesce({alias}.sk, md5({key} || '|inferred')) END"


def _in_force(dim: str, alias: str, key: str) -> str:
    return (f"LEFT JOIN {dim} {alias} ON {alias}.id = {key} AND {alias}.valid_from <= o.order_date "
            f"AND (o.order_date < {alias}.valid_to OR {alias}.valid_to IS NULL)")


def _with_inferred_sql(dim: str, needs: str) -> str:
    return f"""
SELECT *, false AS is_inferred FROM {dim}
UNION ALL BY NAME
SELECT DISTINCT md5(key || '|inferred') AS sk, key AS id, true AS is_inferred FROM ({needs}) WHERE key IS NOT NULL"""


@register("star_dim_customer", "F20", with_fixtures(_with_inferred_sql("t_dim_customer", f"""
SELECT o.customer_id AS key FROM t_order o {_in_force('t_dim_customer', 'd', 'o.customer_id')} WHERE d.sk IS NULL"""), _DIMS))
def _dim_customer(s):
    dim = staged(_customers(s), "dim-customer", release=True)
    orders = s.order.select("customer_id", "order_date")
    return star.with_inferred(dim, star.lookup(orders, dim, "customer_id", "order_date", "customer_sk"),
                              "customer_id", "customer_sk")


@register("star_dim_product", "F20", with_fixtures(_with_inferred_sql("t_dim_product", f"""
SELECT i.product_id AS key FROM t_item i JOIN t_order o ON o.id = i.order_id
{_in_force('t_dim_product', 'd', 'i.product_id')} WHERE d.sk IS NULL"""), _DIMS))
def _dim_product(s):
    dim = staged(_products(s), "dim-product", release=True)
    lines = s.orderitem.select("order_id", "product_id").join(s.order.selectExpr("id AS order_id", "order_date"), "order_id")
    return star.with_inferred(dim, star.lookup(lines, dim, "product_id", "order_date", "product_sk"),
                              "product_id", "product_sk")


register("star_dim_tenant", "F20", with_fixtures("SELECT * FROM t_dim_tenant", _DIMS))(_tenants)


@register("star_fact_scd2", "F20", with_fixtures(f"""
SELECT i.id AS item_id, i.order_id, i.product_id, {_sk('p', 'i.product_id')} AS product_sk,
       {_sk('c', 'o.customer_id')} AS customer_sk, {_sk('t', 'o.tenant_id')} AS tenant_sk, o.status,
       cast(year(o.order_date) * 10000 + month(o.order_date) * 100 + day(o.order_date) AS integer) AS date_key,
       i.quantity, cast(i.total AS double) AS revenue, cast(p.cost * i.quantity AS double) AS cost
FROM t_item i JOIN t_order o ON o.id = i.order_id
{_in_force('t_dim_product', 'p', 'i.product_id')}
{_in_force('t_dim_customer', 'c', 'o.customer_id')}
{_in_force('t_dim_tenant', 't', 'o.tenant_id')}""", _DIMS))
def _fact(s):
    customers, tenants, products = [staged(d, "dim", release=True) for d in (_customers(s), _tenants(s), _products(s))]
    keyed = staged(star.keyed_orders(s.order, customers, tenants), "orders", release=True)
    if products.count() <= star.SMALL:
        return star.fact_sales(s.orderitem, keyed, products, few=0)
    return star.fact_sales(s.orderitem_by_product, keyed, products)
