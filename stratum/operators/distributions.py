"""Quantiles and distinct counts: exact by range refinement, or by stored sketches.

Exact quantiles never sort: every round counts the rows of each wanted range in
``BINS`` bins (a partial aggregation, so a hot key collapses in its tasks) and keeps the bin that
holds the wanted rank, until ranges are single values.  A 64-bit range needs at most
seven rounds, an hour in microseconds three or four.

Sketches are stored per fine key (tenant and day) and merged to coarser ones without reading the
rows again.  Distinct counts are theta sketches, so sets can be intersected (retention);
they are exact up to ``2^lg_k`` values, and beyond that the relative standard error is
about ``2^(-lg_k / 2)``.  Quantiles are KLL sketches with a rank error of about 1.3 % at k = 200.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_of, month_of
from ..functions.money import int_div
from ..sources.staging import staged

BINS, LG_K, KLL_K = 1024, 12, 200
_WIDE = "decimal(38,0)"


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, quantiles: list[float], bins: int = BINS) -> DataFrame:
    """(keys, n, q<i>...): per key the number of values and, for each quantile, the
    least value that at least that share of the values does not exceed.

    ``value`` is an integer column; NULL values take no part, keys may be NULL.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    base = staged(rows.where(F.col(value).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(value).cast("long").alias("_v")), "quantile-rows")

    def rank(n: Column, q: float) -> Column:
        return F.greatest(F.lit(1).cast("long"), n - F.floor(n.cast("double") - n.cast("double") * F.lit(float(q))))

    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("_q"), rank(F.col("_n"), q).alias("_rank"))
                                 for i, q in enumerate(quantiles)])).alias("w")
    found = staged(base.groupBy(*names).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
                   .select(*names, "_n", "_lo", "_hi", wanted).select(*names, "_n", "_lo", "_hi", "w.*"), "quantile-ranges")
    # Bins are computed in decimals: a range of longs may be wider than a long.
    span = F.col("_hi").cast(_WIDE) - F.col("_lo").cast(_WIDE)
    while found.where(F.col("_lo") < F.col("_hi")).limit(1).count():
        width = int_div(span, F.lit(bins)) + 1
        at = int_div(F.col("_v").cast(_WIDE) - F.col("_lo").cast(_WIDE), F.col("_w")).cast("int")
        open_ = found.where(F.col("_lo") < F.col("_hi")).withColumn("_w", width.cast(_WIDE))
        same = F.lit(True)
        for n in names:
            same = same & base[n].eqNullSafe(open_[n])
        counted = (base.join(open_, same & base["_v"].between(open_["_lo"], open_["_hi"]))
                   .select(*[open_[n] for n in names], "_q", at.alias("_bin"))
                   .groupBy(*names, "_q", "_bin").agg(F.count(F.lit(1)).alias("_in")))
        # At most ``bins`` entries a range: the bin where the running count reaches the rank.
        listed = counted.groupBy(*names, "_q").agg(F.array_sort(F.collect_list(F.struct("_bin", "_in"))).alias("_bins"))
        start = F.struct(F.lit(0).cast("long").alias("below"), F.lit(-1).alias("bin"))

        def step(acc: Column, b: Column) -> Column:
            here = (acc["bin"] < 0) & (acc["below"] + b["_in"] >= F.col("_rank"))
            return F.struct(F.when((acc["bin"] >= 0) | here, acc["below"]).otherwise(acc["below"] + b["_in"]).alias("below"),
                            F.when(here, b["_bin"]).otherwise(acc["bin"]).alias("bin"))

        on = F.col("o._q") == F.col("l._q")
        for n in names:
            on = on & F.col(f"o.{n}").eqNullSafe(F.col(f"l.{n}"))
        joined = open_.alias("o").join(listed.alias("l"), on).select("o.*", "l._bins")
        chosen = joined.withColumn("_c", F.aggregate("_bins", start, step))
        low = F.col("_lo").cast(_WIDE) + F.col("_c.bin").cast(_WIDE) * F.col("_w")
        finer = chosen.select(*names, "_n", low.cast("long").alias("_lo"),
                              F.least(low + F.col("_w") - 1, F.col("_hi").cast(_WIDE)).cast("long").alias("_hi"),
                              "_q", (F.col("_rank") - F.col("_c.below")).alias("_rank"))
        found = staged(found.where(F.col("_lo") == F.col("_hi")).unionByName(finer), "quantile-ranges")
    cells = [F.max(F.when(F.col("_q") == i, F.col("_lo"))).alias(f"q{i}") for i in range(len(quantiles))]
    return found.groupBy(*names).agg(F.max("_n").alias("n"), *cells).select(
        *[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "n", *[f"q{i}" for i in range(len(quantiles))])


def session_durations(events: DataFrame) -> DataFrame:
    """(tenant_id, day, us): a row per session, by the day it starts."""
    s = events.where(F.col("created_at").isNotNull()).groupBy("tenant_id", "session_id").agg(
        F.min("created_at").alias("_start"), F.max("created_at").alias("_end"))
    return s.select("tenant_id", day_of("_start").alias("day"),
                    F.timestamp_diff("MICROSECOND", F.col("_start"), F.col("_end")).alias("us"))


def session_duration_quantiles(events: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """F10 with its distribution: per day p50 and p95 of the session durations, exact, in seconds."""
    q = exact_quantiles(session_durations(events), ["day"], "us", list(quantiles))
    return q.select("day", F.col("n").alias("sessions"), *[
        (F.col(f"q{i}").cast("double") / 1_000_000).alias(f"p{round(100 * x)}_seconds") for i, x in enumerate(quantiles)])


def duration_sketches(events: DataFrame, k: int = KLL_K) -> DataFrame:
    """(tenant_id, day, durations): KLL sketches of session durations to store."""
    return session_durations(events).groupBy("tenant_id", "day").agg(F.kll_sketch_agg_bigint("us", k).alias("durations"))


def merged_quantile(sketches: DataFrame, keys: list[str], quantile: float, k: int = KLL_K) -> DataFrame:
    """(keys, us): an approximate quantile from stored sketches of finer keys."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("durations", k).alias("_s")).select(
        *keys, F.kll_sketch_get_quantile_bigint("_s", F.lit(float(quantile))).alias("us"))


# ---------------------------------------------------------------- distinct counts
def daily_customer_sketches(orders: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(tenant_id, day, order_count, customers): completed orders per tenant and day, with
    a theta sketch of their customers to store."""
    return (orders.where(F.col("status") == "completed").groupBy("tenant_id", day_of("order_date").alias("day"))
            .agg(F.count("id").alias("order_count"), F.theta_sketch_agg("customer_id", lg_k).alias("customers")))


def monthly_customers(daily: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(tenant_id, month, order_count, customers): days merged to months."""
    return daily.groupBy("tenant_id", month_of("day").alias("month")).agg(
        F.sum("order_count").alias("order_count"), F.theta_union_agg("customers", lg_k).alias("customers"))


def customers_and_retention(daily: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Per tenant and month: orders, distinct customers, and how many of the customers of
    the month before ordered again - all from stored daily sketches."""
    now = monthly_customers(daily, lg_k)
    before = now.select(F.col("tenant_id").alias("_t"), F.add_months("month", 1).alias("_m"), F.col("customers").alias("_before"))
    met = now.join(before, (now["tenant_id"] == before["_t"]) & (now["month"] == before["_m"]), "left")
    again = F.theta_sketch_estimate(F.theta_intersection("customers", "_before"))
    return met.select("tenant_id", "month", "order_count", F.theta_sketch_estimate("customers").alias("unique_customers"),
                      F.when(F.col("_before").isNotNull(), again).alias("retained_customers"))
