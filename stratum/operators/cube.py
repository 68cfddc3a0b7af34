"""Revenue with all subtotals from one pass over the facts (grouping sets)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_of

DIMENSIONS = ["tenant_id", "category", "month"]
ROWS_PER_TASK = 250_000         # facts, so what a task holds does not grow with the tables
# level -> its dimensions, and those that order the states of a group.  Both together
# give one of three orders, so all windows need three sorts.
_GROUPS = {
    7: ([], ["tenant_id", "category", "month"]), 3: (["tenant_id"], ["category", "month"]),
    1: (["tenant_id", "category"], ["month"]), 0: (DIMENSIONS, []),
    5: (["category"], ["month", "tenant_id"]), 4: (["category", "month"], ["tenant_id"]),
    6: (["month"], ["tenant_id", "category"]), 2: (["month", "tenant_id"], ["category"]),
}


def revenue_cube(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Completed item revenue by tenant x category x month with every subtotal.

    The facts are joined and reduced once, to a state per (tenant, category, month,
    customer).  All levels come from those states.  A customer's states (at most one per
    tenant, category and month) meet in one task, where for each level the first
    state of a (group, customer) is marked: the sum of the marks is an exact distinct
    count.  So the states are expanded to levels only to be summed at once into a row per
    group, and no level holds its customers in memory.

    ``level`` has a bit for each dimension that is summed over (4: tenant, 2: category,
    1: month); it tells a subtotal from a row whose dimension is NULL.
    """
    o = orders.where(F.col("status") == "completed").select(
        F.col("id").alias("order_id"), "tenant_id", "customer_id", month_of("order_date").alias("month"))
    p = products.select(F.col("id").alias("product_id"), "category")
    n = max(-(-items.count() // ROWS_PER_TASK), items.sparkSession.sparkContext.defaultParallelism)
    sold = items.select("order_id", "product_id", "quantity", "total").repartition(n, "order_id").join(o, "order_id")
    states = sold.join(p, "product_id", "left").repartition(n, *DIMENSIONS, "customer_id").groupBy(*DIMENSIONS, "customer_id").agg(
        F.sum("quantity").alias("units"), F.sum("total").alias("revenue"), F.count(F.lit(1)).alias("items")).repartition(n, "customer_id")
    known = F.col("customer_id").isNotNull()
    marked = states
    for level, (group, rest) in _GROUPS.items():
        place = F.row_number().over(Window.partitionBy("customer_id", *group).orderBy(*rest)) if rest else F.lit(1)
        marked = marked.withColumn(f"_first_{level}", (known & (place == 1)).cast("int"))
    sets = [list(some) for k in range(len(DIMENSIONS) + 1) for some in combinations(DIMENSIONS, k)]
    customers = F.get(F.array(*[F.sum(f"_first_{level}") for level in range(8)]), F.grouping_id().cast("int"))
    return marked.groupingSets(sets, *DIMENSIONS).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("items").alias("items"), F.sum("units").alias("units"), F.sum("revenue").cast("double").alias("revenue"),
        customers.alias("customers"))
