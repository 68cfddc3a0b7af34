"""Silver -> Gold operators: the nine shipped Gold tables.

Shape of every job: filter early (pushed into the scan), aggregate on the
fact side with map-side partial aggregation, *then* join the small
dimensions (tenant broadcast after a size probe).  Distinct counts are
computed in two aggregation levels (per key+customer, then per key) so the
shuffle carries pre-aggregated rows and a hot tenant is spread over many
(tenant, customer) groups in the first level.

Money is summed exactly (decimal) and emitted as double; averages are
rounded half-up on cents (see ``functions.money``).  ``processed_at`` is
stamped by the sink, never here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domains
from ..functions.dates import month_of
from ..functions.joins import tenant_dim
from ..functions.money import cents, div_round_half_up, money_ratio


def _completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status") == "completed")


def _order_rollup(orders: DataFrame, keys: list[str], distinct_customers: bool) -> DataFrame:
    """count / exact sum / half-up avg of ``total`` per keys (+ distinct customers).

    Level 1 groups by keys + customer_id; level 2 by keys.  Both levels
    aggregate partially before their shuffle.
    """
    lvl1 = (orders.groupBy(*keys, "customer_id")
            .agg(F.count("id").alias("_n"), F.sum("total").alias("_sum"),
                 F.count("total").alias("_nt")))
    aggs = [F.sum("_n").alias("_orders"), F.sum("_sum").alias("_sum"), F.sum("_nt").alias("_nt")]
    if distinct_customers:
        aggs.append(F.count("customer_id").alias("_customers"))
    return lvl1.groupBy(*keys).agg(*aggs)


def _avg_from(sum_col: str, n_col: str):
    return (div_round_half_up(cents(F.col(sum_col)), F.col(n_col)).cast("double") / 100)


def revenue_by_tenant_monthly(orders: DataFrame, tenants: DataFrame) -> DataFrame:
    """Completed orders per (tenant, month): count, revenue, AOV, unique customers."""
    agg = _order_rollup(_completed(orders).withColumn("month", month_of("order_date")),
                        ["tenant_id", "month"], distinct_customers=True)
    return (agg.join(tenant_dim(tenants, "name"), "tenant_id")
            .select("tenant_id", "tenant_name", "month",
                    F.col("_orders").alias("order_count"),
                    F.col("_sum").cast("double").alias("total_revenue"),
                    _avg_from("_sum", "_nt").alias("avg_order_value"),
                    F.col("_customers").alias("unique_customers")))


def revenue_by_tenant_total(orders: DataFrame, tenants: DataFrame, customers: DataFrame) -> DataFrame:
    """C1 over all time + plan type + customer count + revenue per customer."""
    agg = (_completed(orders).groupBy("tenant_id")
           .agg(F.count("id").alias("total_orders"), F.sum("total").alias("_sum"),
                F.count("total").alias("_nt")))
    cust = customers.groupBy("tenant_id").agg(F.count("id").alias("total_customers"))
    return (agg.join(tenant_dim(tenants, "name", "plan_type"), "tenant_id")
            .join(cust, "tenant_id")
            .select("tenant_id", "tenant_name", "plan_type", "total_customers", "total_orders",
                    F.col("_sum").cast("double").alias("total_revenue"),
                    _avg_from("_sum", "_nt").alias("avg_order_value"),
                    money_ratio(F.col("_sum"), F.col("total_customers")).alias("revenue_per_customer")))


def product_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items of completed orders aggregated per (order tenant, product).

    The join on order_id is a shuffle join of two fact tables; only
    (id, tenant_id) of completed orders crosses it.  Aggregation follows
    with partial aggregation per map task.
    """
    o = _completed(orders).select(F.col("id").alias("order_id"), "tenant_id")
    return (items.select("id", "order_id", "product_id", "quantity", "total")
            .join(o, "order_id")
            .groupBy("tenant_id", "product_id")
            .agg(F.count("id").alias("times_ordered"),
                 F.sum("quantity").alias("total_quantity_sold"),
                 F.sum("total").alias("_rev")))


def product_performance(items: DataFrame, orders: DataFrame, products: DataFrame,
                        tenants: DataFrame) -> DataFrame:
    """Per (order's tenant, product): times ordered, units, revenue, avg price."""
    p = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"),
                        F.col("price").alias("_price"), F.col("stock_quantity").alias("current_stock"))
    return (product_sales(items, orders)
            .join(p, "product_id")
            .join(tenant_dim(tenants, "name"), "tenant_id")
            .select("tenant_id", "tenant_name", "product_id", "product_name",
                    F.col("_price").cast("double").alias("current_price"), "current_stock",
                    "times_ordered", "total_quantity_sold",
                    F.col("_rev").cast("double").alias("total_revenue"),
                    money_ratio(F.col("_rev"), F.col("total_quantity_sold")).alias("avg_selling_price")))


def top_products_by_revenue(performance: DataFrame, n: int = 100) -> DataFrame:
    """C4: top n of C3 by revenue; ties broken by (tenant_id, product_id).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps
    its own top n, only n rows per task reach the final merge.
    """
    return performance.orderBy(F.col("total_revenue").desc(), "tenant_id", "product_id").limit(n)


def low_stock_alert(products: DataFrame, tenants: DataFrame,
                    threshold: int = domains.LOW_STOCK_THRESHOLD) -> DataFrame:
    """Products with stock strictly below the threshold (NULL stock excluded)."""
    return (products.where(F.col("stock_quantity") < threshold)
            .join(tenant_dim(tenants, "name"), "tenant_id")
            .select("tenant_id", "tenant_name", F.col("id").alias("product_id"),
                    F.col("name").alias("product_name"), "stock_quantity",
                    F.col("price").cast("double").alias("price")))


def customer_ltv(orders: DataFrame, customers: DataFrame, tenants: DataFrame) -> DataFrame:
    """Per (tenant, customer) lifetime value over completed orders."""
    agg = (_completed(orders).groupBy("tenant_id", "customer_id")
           .agg(F.count("id").alias("total_orders"), F.sum("total").alias("_sum"),
                F.count("total").alias("_nt"),
                F.min("order_date").alias("first_order_date"),
                F.max("order_date").alias("last_order_date")))
    c = customers.select(F.col("id").alias("customer_id"), "tenant_id", "email")
    return (agg.join(c, ["tenant_id", "customer_id"])
            .join(tenant_dim(tenants, "name"), "tenant_id")
            .select("tenant_id", "tenant_name", "customer_id", "email", "total_orders",
                    F.col("_sum").cast("double").alias("lifetime_value"),
                    _avg_from("_sum", "_nt").alias("avg_order_value"),
                    "first_order_date", "last_order_date",
                    F.datediff(F.to_date("last_order_date"), F.to_date("first_order_date"))
                    .alias("customer_age_days")))


def customer_acquisition(customers: DataFrame, tenants: DataFrame) -> DataFrame:
    """New customers per (tenant, month of created_at)."""
    return (customers.groupBy("tenant_id", month_of("created_at").alias("month"))
            .agg(F.count("id").alias("new_customers"))
            .join(tenant_dim(tenants, "name"), "tenant_id")
            .select("tenant_id", "tenant_name", "month", "new_customers"))


def active_subscriptions(subscriptions: DataFrame, tenants: DataFrame) -> DataFrame:
    """Active subscriptions and MRR (sum of monthly_amount) per tenant."""
    return (subscriptions.where(F.col("status") == "active")
            .groupBy("tenant_id")
            .agg(F.count("id").alias("active_subscription_count"),
                 F.sum("monthly_amount").cast("double").alias("monthly_recurring_revenue"))
            .join(tenant_dim(tenants, "name"), "tenant_id")
            .select("tenant_id", "tenant_name", "active_subscription_count",
                    "monthly_recurring_revenue"))


def tenant_summary(tenants: DataFrame, customers: DataFrame) -> DataFrame:
    """Every tenant with its customer count (0 when it has none)."""
    counts = customers.groupBy("tenant_id").agg(F.count("id").alias("customer_count"))
    t = tenants.select(F.col("id").alias("tenant_id"), F.col("name").alias("tenant_name"),
                       F.col("slug").alias("tenant_slug"), "is_active")
    return (t.join(counts, "tenant_id", "left")
            .fillna(0, ["customer_count"])
            .select("tenant_id", "tenant_name", "tenant_slug", "is_active", "customer_count"))
