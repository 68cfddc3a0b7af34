"""Exact quantiles, stored sketches and table differences."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import distributions, table_diff
from test_plans import plan_text


def brute_quantiles(rows, quantiles):
    by = {}
    for k, v in rows:
        if v is not None:
            by.setdefault(k, []).append(v)
    return {k: (len(v), *[sorted(v)[max(1, len(v) - math.floor(len(v) - len(v) * q)) - 1] for q in quantiles])
            for k, v in by.items()}


@pytest.mark.parametrize("bins", [4, 1024])
def test_exact_quantiles(spark, bins):
    rnd = random.Random(bins)
    rows = [(rnd.choice(["hot", "hot", "hot", "a", None]), rnd.choice([None, rnd.randrange(-50, 50), rnd.randrange(10**9)]))
            for _ in range(500)]
    rows += [("one", 7), ("none", None), ("wide", 2**63 - 1), ("wide", -(2**63)), ("wide", 0), ("same", 5), ("same", 5)]
    qs = [0.0, 0.1, 0.5, 0.95, 1.0]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {r.k: (r.n, *[r[f"q{i}"] for i in range(len(qs))]) for r in
           distributions.exact_quantiles(df, ["k"], "v", qs, bins).collect()}
    assert got == brute_quantiles(rows, qs)


def test_exact_quantiles_empty_and_whole(spark):
    df = spark.createDataFrame([], "k string, v long")
    assert distributions.exact_quantiles(df, ["k"], "v", [0.5]).count() == 0
    got = distributions.exact_quantiles(spark.range(1001), [], "id", [0.5, 0.99]).collect()
    assert [(r.n, r.q0, r.q1) for r in got] == [(1001, 500, 990)]


def test_quantiles_have_no_sort_of_the_rows(spark, shop):
    rows = distributions.session_durations(shop.event)
    text = plan_text(distributions.exact_quantiles(rows, ["day"], "us", [0.5])).split("== Initial Plan ==")[0]
    assert "rangepartitioning" not in text and "Window" not in text


def test_merged_quantile_sketch_is_close(spark):
    rows = spark.range(40_000).select(F.lit("t").alias("tenant_id"), F.col("id").cast("string").alias("session_id"),
                                      (F.col("id") * 7919 % 40_000).alias("us"))
    ev = rows.select("tenant_id", "session_id", F.explode(F.array(F.lit(0), F.col("us"))).alias("at")).select(
        "tenant_id", "session_id", (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                                    + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("at") / 1_000_000)).alias("created_at"))
    stored = distributions.duration_sketches(ev)
    for q in (0.5, 0.95):
        got = distributions.merged_quantile(stored, ["tenant_id"], q).first().us
        assert abs(got / 40_000 - q) < 0.03


@pytest.mark.parametrize("lg_k", [9, 12])
def test_sketch_error_is_bounded_and_merges(spark, lg_k):
    """Months merged from stored days: exact while the sketch holds all, then within four standard errors."""
    orders = spark.range(30_000).select(
        F.col("id").cast("string").alias("id"), F.lit("completed").alias("status"),
        F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("tenant_id"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 300).otherwise(F.col("id") % 9_001).cast("string").alias("customer_id"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(id % 60 AS int))").alias("order_date"))
    daily = distributions.daily_customer_sketches(orders, lg_k)
    got = {(r.tenant_id, r.month): r for r in distributions.customers_and_retention(daily, lg_k).collect()}
    month = F.trunc(F.to_date("order_date"), "month")
    exact = {(r.tenant_id, r.month): r.n for r in orders.groupBy("tenant_id", month.alias("month")).agg(
        F.countDistinct("customer_id").alias("n")).collect()}
    assert set(got) == set(exact)
    for key, n in exact.items():
        error = 0 if n <= 1 << lg_k else 4 * 2 ** (-lg_k / 2) * n
        assert abs(got[key].unique_customers - n) <= error
    held = {k: {r.customer_id for r in orders.where((F.col("tenant_id") == k[0]) & (month == k[1])).select("customer_id").distinct().collect()}
            for k in exact if k[0] == "t0"}
    months = sorted(m for t, m in exact if t == "t0")
    again = len(held["t0", months[1]] & held["t0", months[0]])
    assert got["t0", months[0]].retained_customers is None and got["t0", months[1]].retained_customers == again


# ---------------------------------------------------------------- table differences
SCHEMA = "k string, n int, v string, a array<int>"


def diff_rows(spark, left, right, buckets=64):
    found = table_diff.diff(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["k"], buckets)
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_every_kind_of_difference_is_listed(spark):
    same = [(f"k{i}", i, "v", [i]) for i in range(200)]
    left = same + [("gone", 1, "x", None), ("new value", 1, "x", [1]), ("swap a", 1, None, None), ("swap b", 2, None, None),
                   ("hole", None, "5", None), ("twice", 1, "y", None), (None, 1, "null key", None), ("partly", 1, "p", None),
                   ("partly", 2, "p", None)]
    right = same + [("come", 1, "x", None), ("new value", 1, "z", [2]), ("swap a", 2, None, None), ("swap b", 1, None, None),
                    ("hole", 5, None, None), ("twice", 1, "y", None), ("twice", 1, "y", None), (None, 2, "null key", None),
                    ("partly", 1, "p", None), ("partly", 3, "p", None)]
    random.Random(1).shuffle(right)
    want = sorted([("gone", "removed", None, 1, 0), ("come", "added", None, 0, 1), ("new value", "changed", "v,a", 1, 1),
                   ("swap a", "changed", "n", 1, 1), ("swap b", "changed", "n", 1, 1), ("hole", "changed", "n,v", 1, 1),
                   ("twice", "recount", None, 1, 2), (None, "changed", "n", 1, 1), ("partly", "changed", "n", 1, 1)], key=str)
    for buckets in (1, 64):
        assert diff_rows(spark, left, right, buckets) == want
    kinds = {r.change: r["keys"] for r in table_diff.summary(table_diff.diff(
        spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["k"])).collect()}
    assert kinds == {"removed": 1, "added": 1, "changed": 6, "recount": 1}


def test_equal_tables_read_no_second_level(spark):
    rows = [(f"k{i % 50}", i % 7, "v", None) for i in range(300)]
    a, b = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(list(reversed(rows)), SCHEMA)
    found = table_diff.diff(a, b, ["k"])
    assert found.count() == 0
    text = plan_text(found)
    assert not any(x in text for x in ("Join", "Exchange", "Aggregate"))
    assert table_diff.diff(a.limit(0), b.limit(0), ["k"]).count() == 0


def test_only_differing_buckets_are_compared(spark):
    a = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("n"))
    b = a.withColumn("n", F.when(F.col("k") == "77", 2).otherwise(1))
    assert table_diff.differing_buckets(a, b, ["k"]).count() == 1
    assert [tuple(r) for r in table_diff.diff(a, b, ["k"]).collect()] == [("77", "changed", "n", 1, 1)]
    with pytest.raises(ValueError):
        table_diff.diff(a, b.withColumnRenamed("n", "m"), ["k"])


def test_cube_scans_the_facts_once(spark, shop):
    from stratum.operators import cube
    text = plan_text(cube.revenue_cube(shop.orderitem, shop.order, shop.product)).split("== Initial Plan ==")[0]
    assert text.count("lineitem.parquet]") == 1 and text.count("orders.parquet]") == 1 and text.count("Expand") == 1


def test_cube_tells_null_from_subtotal(spark):
    from decimal import Decimal
    from datetime import datetime

    from stratum.operators import cube
    items = spark.createDataFrame([("o1", "p1", 2, Decimal(5)), ("o1", "p2", 1, Decimal(3)), ("o2", "p1", 1, Decimal(2))],
                                  "order_id string, product_id string, quantity int, total decimal(10,2)")
    orders = spark.createDataFrame([("o1", None, "c1", "completed", datetime(2024, 1, 5)), ("o2", "t", "c1", "completed", datetime(2024, 1, 6))],
                                   "id string, tenant_id string, customer_id string, status string, order_date timestamp_ntz")
    products = spark.createDataFrame([("p1", "A")], "id string, category string")
    got = {(r.tenant_id, r.category, r.level): (r["items"], r.revenue, r.customers)
           for r in cube.revenue_cube(items, orders, products).collect() if r.month is None}
    assert got[None, None, 7] == (3, 10.0, 1)           # the grand total: one customer
    assert got[None, None, 3] == (2, 8.0, 1) and got["t", None, 3] == (1, 2.0, 1)       # tenant NULL, tenant t
    assert got[None, None, 5] == (1, 3.0, 1) and got[None, "A", 5] == (2, 7.0, 1)       # category NULL, A


def test_cube_matches_brute_force_and_expands_without_customers(spark):
    import random
    from datetime import datetime
    from decimal import Decimal

    from stratum.operators import cube
    rnd = random.Random(7)
    orders = [(f"o{i}", rnd.choice(["t", "u", None]), rnd.choice(["c1", "c2", "c3", None]), rnd.choice(["completed", "pending"]),
               datetime(2024, rnd.randrange(1, 4), 5)) for i in range(80)]
    items = [(f"o{rnd.randrange(90)}", rnd.choice(["p1", "p2", "p3", None]), rnd.randrange(5), Decimal(rnd.randrange(100))) for _ in range(300)]
    kinds = {"p1": "A", "p2": "B", "p3": "A"}
    frames = (spark.createDataFrame(items, "order_id string, product_id string, quantity int, total decimal(10,2)"),
              spark.createDataFrame(orders, "id string, tenant_id string, customer_id string, status string, order_date timestamp_ntz"),
              spark.createDataFrame([*kinds.items()], "id string, category string"))
    want = {}
    by_id = {o[0]: o for o in orders if o[3] == "completed"}
    for order, product, units, total in items:
        if order in by_id:
            _, tenant, customer, _, day = by_id[order]
            dims = (tenant, kinds.get(product), day.strftime("%Y-%m"))
            for level in range(8):
                key = (*(None if level >> (2 - i) & 1 else d for i, d in enumerate(dims)), level)
                sums = want.setdefault(key, [0, 0, 0, set()])
                sums[0], sums[1], sums[2] = sums[0] + 1, sums[1] + units, sums[2] + total
                sums[3] |= {customer} - {None}
    cubed = cube.revenue_cube(*frames)
    got = {(r.tenant_id, r.category, r.month and str(r.month)[:7], r.level): (r["items"], r.units, r.revenue, r.customers)
           for r in cubed.collect()}
    assert got == {k: (n, u, float(t), len(c)) for k, (n, u, t, c) in want.items()}
    expand = [line for line in plan_text(cubed).splitlines() if "Expand [" in line][0]
    assert expand.count("customer_id") == 0
