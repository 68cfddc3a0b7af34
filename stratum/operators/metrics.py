"""Planned Gold metrics (F1-F21); definitions marked *ours* where the plan
names a metric without a formula.

Scale notes.  Every metric aggregates the fact table first (partial
aggregation before each shuffle) and only then joins or windows.  Windows
run on small aggregates: months per tenant, distinct score values,
distinct order counts, funnel steps.  Global rankings (F11, F19) are
computed from a histogram of the ranked value, never by a window over
all customers, so no single task has to hold every customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import domains
from ..functions.dates import day_of, hour_of, month_of, quarter_of
from ..functions.money import cents, div_round_half_up, int_div, pct, ratio


def _completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status") == "completed")


def _avg_cents(sum_col: Column, n_col: Column) -> Column:
    return div_round_half_up(cents(sum_col), n_col).cast("double") / 100


# ---------------------------------------------------------------- F1 / F2
def revenue_daily(orders: DataFrame) -> DataFrame:
    """per tenant and day: orders, distinct customers, revenue, AOV."""
    lvl1 = (_completed(orders).groupBy("tenant_id", day_of("order_date").alias("day"), "customer_id")
            .agg(F.count("id").alias("_n"), F.sum("total").alias("_s"), F.count("total").alias("_nt")))
    return (lvl1.groupBy("tenant_id", "day")
            .agg(F.sum("_n").alias("order_count"), F.count("customer_id").alias("unique_customers"),
                 F.sum("_s").alias("_s"), F.sum("_nt").alias("_nt"))
            .select("tenant_id", "day", "order_count", "unique_customers",
                    F.col("_s").cast("double").alias("total_revenue"),
                    _avg_cents(F.col("_s"), F.col("_nt")).alias("avg_order_value")))


def _with_previous(agg: DataFrame, key: str, period: str, step: int) -> DataFrame:
    """``prev_revenue`` of the calendar period ``step`` months before, if there is one."""
    w = Window.partitionBy(key).orderBy(period)
    follows = F.lag(period).over(w) == F.add_months(F.col(period), -step)
    return agg.withColumn("prev_revenue", F.when(follows, F.lag("revenue").over(w)))


def revenue_growth(orders: DataFrame, period: str = "month") -> DataFrame:
    """revenue per tenant and period with growth over the previous calendar period.

    ``lag`` over the small per-period aggregate, taken only when the row
    before is the calendar period before, so a gap month yields NULL growth
    rather than comparing with an older month.  Orders are read once.
    """
    bucket, step = (month_of, 1) if period == "month" else (quarter_of, 3)
    agg = (_completed(orders).groupBy("tenant_id", bucket("order_date").alias("period"))
           .agg(F.sum("total").alias("revenue")))
    return (_with_previous(agg, "tenant_id", "period", step)
            .select("tenant_id", "period", F.col("revenue").cast("double").alias("revenue"),
                    F.col("prev_revenue").cast("double").alias("prev_revenue"),
                    pct(F.col("revenue") - F.col("prev_revenue"), F.col("prev_revenue"))
                    .alias("growth_pct")))


# ---------------------------------------------------------------- F3
def _sold_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    o = _completed(orders).select(F.col("id").alias("order_id"), "tenant_id", "order_date")
    return items.select("id", "order_id", "product_id", "quantity", "total").join(o, "order_id")


def category_performance(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """F3 (a): revenue by product category with its share of all revenue."""
    per_product = (_sold_items(items, orders).groupBy("product_id")
                   .agg(F.count("id").alias("_n"), F.sum("quantity").alias("_q"),
                        F.sum("total").alias("_r")))
    p = products.select(F.col("id").alias("product_id"), "category")
    agg = (per_product.join(p, "product_id").groupBy("category")
           .agg(F.sum("_n").alias("times_ordered"), F.sum("_q").alias("units_sold"),
                F.sum("_r").alias("_r")))
    return agg.select("category", "times_ordered", "units_sold",
                      F.col("_r").cast("double").alias("revenue"),
                      pct(F.col("_r"), F.sum("_r").over(Window.partitionBy())).alias("revenue_share_pct"))


def category_trends(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """F3 (b): category revenue per month with the change over the previous month."""
    per = (_sold_items(items, orders)
           .groupBy("product_id", month_of("order_date").alias("month"))
           .agg(F.sum("total").alias("_r")))
    p = products.select(F.col("id").alias("product_id"), "category")
    agg = per.join(p, "product_id").groupBy("category", "month").agg(F.sum("_r").alias("revenue"))
    return (_with_previous(agg, "category", "month", 1)
            .select("category", "month", F.col("revenue").cast("double").alias("revenue"),
                    F.col("prev_revenue").cast("double").alias("prev_revenue"),
                    pct(F.col("revenue") - F.col("prev_revenue"), F.col("prev_revenue"))
                    .alias("change_pct")))


# ---------------------------------------------------------------- F4-F6
def customer_snapshot(customers: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """per tenant at ``as_of``: customers so far and new in the last ``days`` days."""
    t = F.lit(as_of).cast("timestamp_ntz")
    since = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    return (customers.where(F.col("created_at") <= t).groupBy("tenant_id")
            .agg(F.count("id").alias("total_customers"),
                 F.count_if(F.col("created_at") > since).alias("new_customers")))


def retention_cohorts(orders: DataFrame) -> DataFrame:
    """cohort (month of first completed order) x months since: active customers, rate.

    One scan: a customer's distinct months become one set (at most as many as
    there are months), whose least month is the cohort.  Month 0 of a cohort
    holds all its customers, so its count is the cohort's size.
    """
    months = (_completed(orders).groupBy("customer_id")
              .agg(F.collect_set(month_of("order_date")).alias("months")))
    active = (months.select(F.array_min("months").alias("cohort_month"), F.explode("months").alias("month"))
              .groupBy("cohort_month",
                       F.months_between("month", "cohort_month").cast("int").alias("months_since"))
              .agg(F.count(F.lit(1)).alias("active_customers")))
    size = F.max(F.when(F.col("months_since") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month"))
    return (active.withColumn("cohort_size", size)
            .select("cohort_month", "months_since", "active_customers", "cohort_size",
                    ratio(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate")))


def customer_lifecycle(customers: DataFrame, orders: DataFrame, as_of: str,
                       window_days: int = 90) -> DataFrame:
    """F6 (ours): stage of each customer at ``as_of`` from completed orders up to it.

    prospect = no order yet; new = first order within the window;
    active = last order within the window; churned = otherwise.
    """
    t = F.lit(as_of).cast("timestamp_ntz")
    since = t - F.make_dt_interval(F.lit(window_days))
    per = (_completed(orders).where(F.col("order_date") <= t).groupBy("customer_id")
           .agg(F.min("order_date").alias("first_order_date"),
                F.max("order_date").alias("last_order_date")))
    c = customers.select(F.col("id").alias("customer_id"), "tenant_id")
    stage = (F.when(F.col("first_order_date").isNull(), "prospect")
             .when(F.col("first_order_date") >= since, "new")
             .when(F.col("last_order_date") >= since, "active")
             .otherwise("churned"))
    return (c.join(per, "customer_id", "left")
            .select("customer_id", "tenant_id", "first_order_date", "last_order_date",
                    stage.alias("stage")))


# ---------------------------------------------------------------- F7-F11
def funnel_hourly(events: DataFrame) -> DataFrame:
    """per tenant and hour, event counts per type (a pivot over the fixed type list)."""
    return (events.groupBy("tenant_id", hour_of("created_at").alias("hour"))
            .agg(*[F.count_if(F.col("event_type") == t).alias(t) for t in domains.EVENT_TYPES]))


def _session_flags(events: DataFrame) -> DataFrame:
    return (events.groupBy("tenant_id", "session_id")
            .agg(*[F.max(F.col("event_type") == s).alias(s) for s in domains.FUNNEL_STEPS]))


def funnel_conversion(events: DataFrame) -> DataFrame:
    """F8 (ours): sessions reaching each funnel step (having every earlier step too).

    Per-session flags first (one partial-aggregated pass), then one global
    aggregate of at most five counts, unpivoted with ``stack``.
    """
    steps = domains.FUNNEL_STEPS
    reached, cond = [], F.lit(True)
    for s in steps:
        cond = cond & F.col(s)
        reached.append(F.count_if(cond).alias(f"r_{s}"))
    wide = _session_flags(events).agg(*reached)
    pairs = ", ".join(f"{i + 1}, '{s}', r_{s}" for i, s in enumerate(steps))
    long = wide.selectExpr(f"stack({len(steps)}, {pairs}) AS (step_no, step, sessions)")
    w = Window.orderBy("step_no")
    return long.select("step_no", "step", "sessions",
                       ratio(F.col("sessions"), F.lag("sessions").over(w)).alias("rate_from_prev"),
                       ratio(F.col("sessions"), F.first("sessions").over(w)).alias("rate_from_start"))


def cart_abandonment(events: DataFrame) -> DataFrame:
    """per tenant: sessions with add_to_cart, those without purchase, and the rate."""
    f = _session_flags(events)
    return (f.groupBy("tenant_id")
            .agg(F.count_if(F.col("add_to_cart")).alias("cart_sessions"),
                 F.count_if(F.col("add_to_cart") & ~F.col("purchase")).alias("abandoned_sessions"))
            .withColumn("abandonment_rate", ratio(F.col("abandoned_sessions"), F.col("cart_sessions"))))


def session_duration_trend(events: DataFrame) -> DataFrame:
    """sessions per day (of session start) and their mean duration in seconds."""
    s = (events.groupBy("tenant_id", "session_id")
         .agg(F.min("created_at").alias("_start"), F.max("created_at").alias("_end")))
    return (s.groupBy(day_of("_start").alias("day"))
            .agg(F.count("session_id").alias("sessions"),
                 F.sum(F.timestamp_diff("MICROSECOND", F.col("_start"), F.col("_end"))).alias("_us"))
            .select("day", "sessions",
                    (F.col("_us").cast("double") / F.col("sessions") / 1_000_000)
                    .alias("avg_duration_seconds")))


# Score blocks per doubling of the score (F11): at most ~64 x 16 blocks in all.
SCORE_BLOCKS_PER_OCTAVE = 16


def engagement_score(events: DataFrame, bands: int = 4) -> DataFrame:
    """F11 (ours): weighted event score per known customer and a rank band 1..bands.

    rank = 1 + number of customers with a higher score; band =
    1 + floor(bands * (rank - 1) / n).  Ranks come from a histogram of
    scores (one row per distinct score), never from a window over all
    customers.  The histogram itself is ranked in two levels, so no task
    holds all distinct scores: scores fall into logarithmic blocks (block
    0 for scores <= 0, then 16 per doubling), a window over the block
    totals (at most ~1,000 rows) gives the customers above each block, and
    a window partitioned by block ranks the scores inside it.  A block
    near score a spans about a/22 integers, and at most total/a customers
    reach it, so a block holds O(sqrt(total score)) distinct scores.
    """
    w = F.lit(0)
    for t, v in domains.ENGAGEMENT_WEIGHTS.items():
        w = F.when(F.col("event_type") == t, F.lit(v)).otherwise(w)
    scores = (events.where(F.col("customer_id").isNotNull())
              .groupBy("tenant_id", "customer_id")
              .agg(F.count(F.lit(1)).alias("event_count"), F.sum(w).alias("score")))
    # The histogram is derived: AQE measures its shuffle output at run time and
    # broadcasts it when small, without a second pass to probe its size.
    return (scores.join(score_ranks(scores, bands), "score")
            .select("tenant_id", "customer_id", "event_count", "score", "score_rank",
                    F.col("band").cast("int").alias("band")))


def score_ranks(scores: DataFrame, bands: int) -> DataFrame:
    """(score, score_rank, band) per distinct integer ``score`` of ``scores``, ranked
    descending in two levels (see ``engagement_score``)."""
    score = F.col("score")
    block = F.when(score > 0, F.floor(F.log2(score) * SCORE_BLOCKS_PER_OCTAVE) + 1).otherwise(F.lit(0))
    hist = (scores.groupBy("score").agg(F.count(F.lit(1)).alias("_k"))
            .withColumn("_blk", block.cast("int")))
    above = Window.unboundedPreceding, -1
    blocks = (hist.groupBy("_blk").agg(F.sum("_k").alias("_bk"))
              .withColumn("_blk_above", F.coalesce(F.sum("_bk").over(
                  Window.orderBy(F.col("_blk").desc()).rowsBetween(*above)), F.lit(0)))
              .withColumn("_n", F.sum("_bk").over(Window.partitionBy()))
              .select("_blk", "_blk_above", "_n"))
    inside = Window.partitionBy("_blk").orderBy(score.desc()).rowsBetween(*above)
    return (hist.withColumn("_in_above", F.coalesce(F.sum("_k").over(inside), F.lit(0)))
            .join(blocks, "_blk")
            .withColumn("_above", F.col("_blk_above") + F.col("_in_above"))
            .select("score", (F.col("_above") + 1).alias("score_rank"),
                    (int_div(F.lit(bands) * F.col("_above"), F.col("_n")) + 1).alias("band")))


# ---------------------------------------------------------------- F12-F14
def _product_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    return (_sold_items(items, orders).groupBy("product_id")
            .agg(F.sum("quantity").alias("units_sold"), F.sum("total").alias("_r")))


def inventory_turnover(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """F12 (ours): units sold (completed orders) / current stock, per product."""
    p = products.select(F.col("id").alias("product_id"), "tenant_id", "stock_quantity")
    return (p.join(_product_sales(items, orders), "product_id", "left")
            .select("product_id", "tenant_id",
                    F.coalesce(F.col("units_sold"), F.lit(0)).alias("units_sold"), "stock_quantity",
                    ratio(F.coalesce(F.col("units_sold"), F.lit(0)), F.col("stock_quantity"))
                    .alias("turnover")))


def product_profitability(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """revenue - cost x units, and margin %, per product sold."""
    p = products.select(F.col("id").alias("product_id"), "tenant_id", "cost")
    cogs = F.col("cost") * F.col("units_sold")
    return (_product_sales(items, orders).join(p, "product_id")
            .select("product_id", "tenant_id", "units_sold",
                    F.col("_r").cast("double").alias("revenue"),
                    cogs.cast("double").alias("cost_of_goods"),
                    (F.col("_r") - cogs).cast("double").alias("gross_profit"),
                    pct(F.col("_r") - cogs, F.col("_r")).alias("margin_pct")))


def best_sellers_by_tenant(items: DataFrame, orders: DataFrame, k: int = 5) -> DataFrame:
    """top k products per (order) tenant by revenue; ties by product id.

    ``row_number() <= k`` over the (tenant, product) aggregate: Spark adds
    a partial WindowGroupLimit before the shuffle, so each map task sends
    at most k rows per tenant however large a tenant is.
    """
    agg = (_sold_items(items, orders).groupBy("tenant_id", "product_id")
           .agg(F.sum("total").alias("_r"), F.sum("quantity").alias("units_sold")))
    w = Window.partitionBy("tenant_id").orderBy(F.col("_r").desc(), "product_id")
    return (agg.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("tenant_id", "rank", "product_id", F.col("_r").cast("double").alias("revenue"),
                    "units_sold"))


# ---------------------------------------------------------------- F15-F18
def mrr_arr(subs: DataFrame) -> DataFrame:
    """MRR (active monthly amounts) and ARR = 12 x MRR per tenant."""
    return (subs.where(F.col("status") == "active").groupBy("tenant_id")
            .agg(F.count("id").alias("active_subscriptions"), F.sum("monthly_amount").alias("_m"))
            .select("tenant_id", "active_subscriptions", F.col("_m").cast("double").alias("mrr"),
                    (F.col("_m") * 12).cast("double").alias("arr")))


def subscription_churn(subs: DataFrame) -> DataFrame:
    """F16 (ours): per month M: subscriptions active at its start, churned in it, rate.

    Active at the start of M: start_date < M and (end_date >= M or open).
    Instead of a range join of a month spine against subscriptions, each
    subscription adds +1 at the month after it starts and -1 at the month
    after it ends, and one churn at its last month; one scan emits these
    changes and sums them per month.  Months without a change are filled in
    between the rows that ``lead`` finds, so only months are ever windowed.
    """
    first, last = month_of("start_date"), month_of("end_date")
    gone = F.col("status").isin("cancelled", "expired") & F.col("end_date").isNotNull()

    def change(month: Column, delta: Column | int, churned: Column | int, inside: bool) -> Column:
        as_long = [x if isinstance(x, Column) else F.lit(x) for x in (delta, churned)]
        return F.struct(month.alias("month"), as_long[0].cast("long").alias("delta"),
                        as_long[1].cast("long").alias("churned"), F.lit(inside).alias("inside"))

    # Months after the last start or end only carry deltas: they are no rows of the result.
    changes = F.array(
        change(first, 0, 0, True), change(F.add_months(first, 1), 1, 0, False),
        change(F.coalesce(last, first), 0, gone.cast("int"), True),
        change(F.add_months(last, 1), F.when(last.isNotNull(), -1).otherwise(0), 0, False))
    per = (subs.select(F.explode(changes).alias("c")).select("c.*").where(F.col("month").isNotNull())
           .groupBy("month").agg(F.sum("delta").alias("delta"), F.sum("churned").alias("churned"),
                                 F.max("inside").alias("inside")))
    w = Window.orderBy("month")
    whole = Window.partitionBy()
    spread = (per.withColumn("active_at_start", F.sum("delta").over(w))
              .withColumn("next", F.lead("month").over(w))
              .withColumn("hi", F.max(F.when(F.col("inside"), F.col("month"))).over(whole))
              .where(F.col("month") <= F.col("hi"))
              .withColumn("until", F.least(F.coalesce(F.add_months("next", -1), F.col("hi")), F.col("hi"))))
    return (spread.select(F.explode(F.sequence("month", "until", F.expr("INTERVAL 1 MONTH"))).alias("m"),
                          "month", "active_at_start", "churned")
            .select(F.col("m").alias("month"), "active_at_start",
                    F.when(F.col("m") == F.col("month"), F.col("churned")).otherwise(0).alias("churned"))
            .withColumn("churn_rate", ratio(F.col("churned"), F.col("active_at_start"))))


def plan_distribution(subs: DataFrame) -> DataFrame:
    """subscriptions per plan with their share."""
    agg = subs.groupBy("plan_name").agg(F.count("id").alias("subscription_count"),
                                        F.sum("monthly_amount").alias("_m"))
    return agg.select("plan_name", "subscription_count",
                      pct(F.col("subscription_count"), F.sum("subscription_count").over(Window.partitionBy()))
                      .alias("share_pct"),
                      F.col("_m").cast("double").alias("monthly_amount_total"))


def payment_success_rate(invoices: DataFrame) -> DataFrame:
    """F18 (ours): paid / (paid + sent + overdue) per tenant."""
    return (invoices.groupBy("tenant_id")
            .agg(F.count_if(F.col("status") == "paid").alias("paid"),
                 F.count_if(F.col("status").isin("paid", "sent", "overdue")).alias("billed"))
            .withColumn("success_rate", ratio(F.col("paid"), F.col("billed"))))


# ---------------------------------------------------------------- F19-F21
def repeat_concentration(orders: DataFrame, top_share_pct: int = 30) -> DataFrame:
    """F19 (ours): per tenant, share of completed orders placed by the top 30 % of customers.

    Customers are ranked by order count (rank = 1 + customers with more
    orders); the top set is rank <= ceil(30 % of customers), ties included.
    Ranks come from a per-tenant histogram of order counts.
    """
    per_c = _completed(orders).groupBy("tenant_id", "customer_id").agg(F.count("id").alias("n"))
    hist = per_c.groupBy("tenant_id", "n").agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("tenant_id").orderBy(F.col("n").desc())
    hist = (hist.withColumn("above", F.coalesce(F.sum("k").over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("customers", F.sum("k").over(Window.partitionBy("tenant_id")))
            .withColumn("orders", F.sum(F.col("n") * F.col("k")).over(Window.partitionBy("tenant_id"))))
    cut = int_div(F.col("customers") * top_share_pct + (100 - 1), F.lit(100))
    top = F.col("above") + 1 <= cut
    return (hist.groupBy("tenant_id")
            .agg(F.max("customers").alias("customers"), F.max("orders").alias("orders"),
                 F.sum(F.when(top, F.col("k")).otherwise(0)).alias("top_customers"),
                 F.sum(F.when(top, F.col("n") * F.col("k")).otherwise(0)).alias("top_orders"))
            .withColumn("top_order_share", ratio(F.col("top_orders"), F.col("orders"))))


def dim_date(orders: DataFrame) -> DataFrame:
    """F20 (a): a date dimension spanning the order dates (sequence + explode)."""
    b = orders.agg(F.min(F.to_date("order_date")).alias("lo"), F.max(F.to_date("order_date")).alias("hi"))
    d = F.col("date")
    return (b.select(F.explode(F.sequence("lo", "hi")).alias("date"))
            .select((F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"), "date",
                    F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
                    (F.weekday(d) + 1).alias("day_of_week"), (F.weekday(d) >= 5).alias("is_weekend")))


def fact_sales(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """F20 (b): line-grain sales fact with conformed keys."""
    o = orders.select(F.col("id").alias("order_id"), "tenant_id", "customer_id", "status", "order_date")
    p = products.select(F.col("id").alias("product_id"), "cost")
    d = F.to_date("order_date")
    return (items.select(F.col("id").alias("item_id"), "order_id", "product_id", "quantity", "total")
            .join(o, "order_id").join(p, "product_id", "left")
            .select("item_id", "order_id", "product_id", "customer_id", "tenant_id", "status",
                    (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"),
                    "quantity", F.col("total").cast("double").alias("revenue"),
                    (F.col("cost") * F.col("quantity")).cast("double").alias("cost")))


def anonymous_share(events: DataFrame) -> DataFrame:
    """anonymous vs known events per tenant."""
    return (events.groupBy("tenant_id")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count_if(F.col("customer_id").isNull()).alias("anonymous_events"))
            .select("tenant_id", "events", "anonymous_events",
                    (F.col("events") - F.col("anonymous_events")).alias("known_events"),
                    ratio(F.col("anonymous_events"), F.col("events")).alias("anonymous_share")))


