"""Ordered funnels: steps that follow each other in time, within a window.

F8 and F9 ask which event types a session has; here a step counts only after
the steps before it, and a chain of steps must fit into a time window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import domains
from ..functions.money import ratio
from .temporal import micros

WINDOW_SECONDS = 24 * 3600


def sequence_depth(events: DataFrame, keys: list[str], steps: list[str], window_seconds: int = WINDOW_SECONDS,
                   ts: str = "created_at", kind: str = "event_type") -> DataFrame:
    """Per key the greatest k such that steps 1..k happened in this order, each
    later than the one before, all within ``window_seconds`` of the first.

    Time is cut into buckets as long as the window, so a chain that starts in a
    bucket ends in it or in the next one: each event goes to the group of its bucket and, as
    a continuation, to the one before.  A group is read once in time order, and
    s_k at an event is the latest start of a chain that reaches step k there; a later
    start is never worse, so the latest is all that has to be remembered.  No task
    sees more of a key than two buckets.  Keys with no first step have depth 0;
    events without a time take no part.
    """
    us = window_seconds * 1_000_000
    ev = (events.where(F.col(kind).isin(*steps) & F.col(ts).isNotNull())
          .select(*keys, F.col(kind).alias("_kind"), micros(F.col(ts)).alias("_us"))
          .withColumn("_home", F.floor(F.col("_us") / us).cast("long"))
          .withColumn("_group", F.explode(F.array(F.col("_home"), F.col("_home") - 1))))
    earlier = Window.partitionBy(*keys, "_group").orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    ev = ev.withColumn("_s1", F.when((F.col("_kind") == steps[0]) & (F.col("_home") == F.col("_group")), F.col("_us")))
    for k, step in enumerate(steps[1:], 2):
        ev = ev.withColumn("_start", F.max(f"_s{k - 1}").over(earlier)).withColumn(
            f"_s{k}", F.when((F.col("_kind") == step) & (F.col("_us") - F.col("_start") <= us), F.col("_start")))
    depth = F.coalesce(*[F.when(F.col(f"_s{k}").isNotNull(), F.lit(k)) for k in range(len(steps), 0, -1)], F.lit(0))
    return ev.groupBy(*keys).agg(F.max(depth).alias("depth"))


def funnel_ordered(events: DataFrame, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """F8 with order: sessions that reach each funnel step after all earlier ones."""
    steps = domains.FUNNEL_STEPS
    per = sequence_depth(events, ["tenant_id", "session_id"], steps, window_seconds)
    wide = per.agg(*[F.count_if(F.col("depth") >= k).alias(f"r{k}") for k in range(1, len(steps) + 1)])
    pairs = ", ".join(f"{k}, '{s}', r{k}" for k, s in enumerate(steps, 1))
    long = wide.selectExpr(f"stack({len(steps)}, {pairs}) AS (step_no, step, sessions)")
    w = Window.orderBy("step_no")       # five rows
    return long.select("step_no", "step", "sessions",
                       ratio(F.col("sessions"), F.lag("sessions").over(w)).alias("rate_from_prev"),
                       ratio(F.col("sessions"), F.first("sessions").over(w)).alias("rate_from_start"))


def cart_abandonment_ordered(events: DataFrame, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """F9 with order: a cart is abandoned unless a purchase follows it within the window."""
    per = sequence_depth(events, ["tenant_id", "session_id"], ["add_to_cart", "purchase"], window_seconds)
    return (per.groupBy("tenant_id")
            .agg(F.count_if(F.col("depth") >= 1).alias("cart_sessions"),
                 F.count_if(F.col("depth") == 1).alias("abandoned_sessions"))
            .withColumn("abandonment_rate", ratio(F.col("abandoned_sessions"), F.col("cart_sessions"))))
