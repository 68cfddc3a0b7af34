"""Effective-dated dimensions and as-of fact keys (F20) against plain Python."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stratum.operators import star
from stratum.sources.staging import CLEANUP, staged
from conftest import SMALL
from test_plans import plan_text

T0 = datetime(2024, 1, 1)
LOG = "op string, commit_ts timestamp_ntz, seq int, id string, plan string, size int"
FACTS = "n int, id string, t timestamp_ntz"


def log_rows(seed, n=300):
    rnd = random.Random(seed)
    return [(rnd.choice("IUUUD"), None if rnd.random() < 0.03 else T0 + timedelta(hours=rnd.randrange(400)), i,
             rnd.choice(["hot", "hot", "hot", "a", "b", "c", None]), rnd.choice(["x", "y", None]), rnd.choice([1, None]))
            for i in range(n)]


def brute_versions(rows):
    out = []
    for key in {r[3] for r in rows if r[3] is not None}:
        states = {}
        for op, at, seq, k, *attrs in rows:
            if k == key and at is not None and (at not in states or states[at][0] < seq):
                states[at] = (seq, op == "D", tuple(attrs))
        changes = []
        for at, (_, gone, attrs) in sorted(states.items()):
            if not changes or changes[-1][1:] != (gone, attrs):
                changes.append((at, gone, attrs))
        ends = [c[0] for c in changes[1:]] + [None]
        out += [(key, *attrs, at, end) for (at, gone, attrs), end in zip(changes, ends) if not gone]
    return out


def order(rows):
    return sorted(rows, key=repr)


def dim_of(spark, *loads):
    history = None
    for rows in loads:
        history = star.history_of(spark.createDataFrame(rows, LOG), "id", ["plan", "size"], history)
    return star.versions(history, "id")


@pytest.mark.parametrize("seed", [1, 2])
def test_versions_match_brute_force_in_any_order_of_loads(spark, seed):
    rows = log_rows(seed)
    whole = dim_of(spark, rows).collect()
    assert order((r.id, r.plan, r["size"], r.valid_from, r.valid_to) for r in whole) == order(brute_versions(rows))
    assert len({r.sk for r in whole}) == len(whole)
    late = dim_of(spark, rows[200:], rows[:100], rows[100:200], rows[:100]).collect()    # late and delivered twice
    assert order(late) == order(whole)


def test_keys_of_old_versions_stay_after_a_load(spark):
    rows = [r for r in log_rows(3) if r[1] is not None]
    cut = T0 + timedelta(hours=200)
    early = [r for r in rows if r[1] < cut]
    before = {(r.id, r.valid_from): r.sk for r in dim_of(spark, early).collect()}
    after = {(r.id, r.valid_from): r.sk for r in dim_of(spark, early, [r for r in rows if r[1] >= cut]).collect()}
    assert before.items() <= after.items() and len(after) > len(before)


def test_facts_take_the_version_in_force(spark):
    rows = log_rows(4)
    dim = dim_of(spark, rows).persist()
    rnd = random.Random(5)
    facts = [(i, rnd.choice(["hot", "hot", "a", "b", "none", None]),
              T0 + timedelta(hours=rnd.randrange(-20, 420))) for i in range(300)]
    got = star.lookup(spark.createDataFrame(facts, FACTS), dim, "id", "t", "sk", {"plan": "plan_then"})
    keys = {(r.id, r.valid_from): (r.sk, r.plan) for r in dim.collect()}
    inferred = set()
    for r in got.collect():
        held = [(k, f) for k, _, _, f, to in brute_versions(rows) if k == r.id and f <= r.t and (to is None or r.t < to)]
        assert len(held) <= 1
        if held:
            assert (r.sk, r.plan_then) == keys[held[0]]
        elif r.id is None:
            assert (r.sk, r.plan_then) == (star.UNKNOWN, None)
        else:
            assert r.sk not in {sk for sk, _ in keys.values()} and r.plan_then is None
            inferred.add((r.id, r.sk))
    assert inferred and got.count() == 300
    full = star.with_inferred(dim, got, "id", "sk")
    assert {(r.id, r.sk) for r in full.where("is_inferred").collect()} == inferred
    assert got.where(F.col("id").isNotNull()).join(full, "sk", "left_anti").count() == 0


def test_empty_inputs(spark):
    none = dim_of(spark, [])
    assert none.count() == 0 and none.columns == ["sk", "id", "plan", "size", "valid_from", "valid_to", "is_current"]
    facts = spark.createDataFrame([(1, "a", T0)], FACTS)
    assert star.lookup(facts, none, "id", "t", "sk").count() == 1
    assert star.lookup(facts.limit(0), none, "id", "t", "sk").count() == 0


def test_fact_plan_has_no_nested_loop(shop):
    log = star.history_of(shop.product_changes(), "id", ["cost"])
    lines = shop.orderitem.selectExpr("id AS item", "product_id", "created_at")
    plan = plan_text(star.lookup(lines, star.versions(log, "id"), "product_id", "created_at", "sk"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lookup_by_member_equals_lookup_by_bucket(spark):
    """Members of few versions are joined by key alone; the result is that of the as-of join."""
    dim = dim_of(spark, log_rows(6)).persist()
    rnd = random.Random(7)
    facts = spark.createDataFrame([(i, rnd.choice(["hot", "a", "none", None]), T0 + timedelta(hours=rnd.randrange(-20, 420)))
                                   for i in range(200)], FACTS)
    by_key, by_bucket, mixed = (order(tuple(r) for r in star.lookup(facts, dim, "id", "t", "sk", {"plan": "then"}, many=n).collect())
                                for n in (10**6, 0, 30))
    assert by_key == by_bucket == mixed and len(by_key) == 200


def test_fact_lines_are_shuffled_twice_and_without_digests(spark, monkeypatch):
    """By product and by order; they used to be moved by product, by order with two digests, and by product again."""
    monkeypatch.setattr(star, "SMALL", 0, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()["star_fact_scd2"](spark, SMALL)
        above = df._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at = next(i for i, line in enumerate(above) if "l_orderkey" in line and "FileScan" in line)
    depth, moves, digests = len(above[at]), 0, False
    for line in reversed(above[:at]):
        if (d := len(line) - len(line.lstrip(" :+-"))) < depth:
            depth, moves, digests = d, moves + ("Exchange" in line), digests or (moves < 2 and "md5" in line)
    assert moves == 2 and not digests


def test_fact_is_the_same_however_products_are_met(spark):
    rnd = random.Random(8)
    log = [r[:4] + (r[4], 3 + (r[5] or 0)) for r in log_rows(8)]
    history = star.history_of(spark.createDataFrame(log, LOG), "id", ["plan", "size"])
    made = star.versions(history, "id").withColumn("cost", F.col("size").cast("decimal(10,2)"))
    products = spark.createDataFrame(made.collect(), made.schema)
    orders = spark.createDataFrame([(str(i), rnd.choice(["a", "b", "none", None]), rnd.choice(["hot", None]), rnd.choice(["x", None]),
                                     None if i % 40 == 0 else T0 + timedelta(hours=rnd.randrange(-20, 420))) for i in range(120)],
                                   "id string, customer_id string, tenant_id string, status string, order_date timestamp_ntz")
    items = spark.createDataFrame([(f"i{i}", rnd.choice([str(rnd.randrange(130)), None]), rnd.choice(["hot", "a", "b", "none", None]),
                                    rnd.choice([1, 2, None]), 5.0) for i in range(300)],
                                  "id string, order_id string, product_id string, quantity int, total double")
    found = star.keyed_orders(orders, products, products)
    keyed = spark.createDataFrame(found.collect(), found.schema)
    after, some, carried = (order(tuple(r) for r in star.fact_sales(items, keyed, products, few=n).collect())
                            for n in (0, 60, 10**6))
    assert after == some == carried and len({r[3] for r in after}) > 5 and any(r[-1] for r in after)
    by_lookup = star.lookup(items.join(orders.selectExpr("id AS order_id", "order_date"), "order_id"), products, "product_id",
                            "order_date", "sk", {"cost": "then"}).selectExpr("id", "sk", "cast(then * quantity AS double)")
    assert order((r[0], r[3], r[-1]) for r in after) == order(tuple(r) for r in by_lookup.collect())


def test_items_by_product_are_the_items(shop):
    assert shop.orderitem_by_product.schema == shop.orderitem.schema
    assert shop.orderitem_by_product.exceptAll(shop.orderitem).isEmpty() and shop.orderitem.exceptAll(shop.orderitem_by_product).isEmpty()


def test_staged_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def files():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    kept, before = spark.conf.get(CLEANUP), files()
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(staged(counts, "counts", release=True).collect()) == 7 and spark.conf.get(CLEANUP) == kept
    for _ in range(50):                 # Spark drops them in the background
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    staged(counts, "counts")
    assert files() - before
