"""Streaming cart-purchase join and order checks against plain Python, drop by drop."""

import random
from datetime import datetime, timedelta

import pytest

from stratum.functions import domains
from stratum.session import scratch_path
from stratum.streaming import jobs, matching
from stratum.streaming.sinks import fresh_dir

T0 = datetime(2024, 1, 1)
EVENTS = "id string, customer_id string, event_type string, created_at timestamp_ntz"
LOG = "id string, op string, commit_ts timestamp_ntz, seq int, status string"


def folder(spark, name):
    root = fresh_dir(scratch_path(spark, "tests"), name)
    return f"{root}/in", f"{root}/out", f"{root}/ckpt"


def event_rows(seed, n=300):
    rnd = random.Random(seed)
    return [(f"e{i}", rnd.choice(["hot", "hot", "a", "b", None]), rnd.choice(["add_to_cart", "add_to_cart", "purchase"]),
             T0 + timedelta(minutes=rnd.randrange(60 * 1440), seconds=17 * (i % 3))) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 3])
def test_carts_and_purchases_over_drops_and_a_replay(spark, parts):
    rows = sorted(event_rows(parts), key=lambda r: r[3])
    src, out, ckpt = folder(spark, "carts")

    def run(checkpoint=ckpt):
        c, p = (jobs.read_parquet_stream(spark, src, spark.createDataFrame([], EVENTS).schema).where(f"event_type = '{t}'")
                for t in ("add_to_cart", "purchase"))
        matching.run_append(matching.carts_with_purchases(c, p, parts=parts), out, checkpoint)

    def pairs():
        return sorted(((r.cart_id, r.purchase_id, r.cart_at, r.purchase_at) for r in spark.read.parquet(out).collect()), key=repr)
    for some in (rows[:100], rows[100:200], rows[200:]):
        spark.createDataFrame(some, EVENTS).write.mode("append").parquet(src)
        run()
    carts, bought = ([r for r in rows if r[2] == t and r[1]] for t in ("add_to_cart", "purchase"))
    mark = min(max(r[3] for r in carts), max(r[3] for r in bought)) - timedelta(hours=1)
    want = []
    for c in carts:
        met = [p for p in bought if p[1] == c[1] and c[3] <= p[3] < c[3] + timedelta(hours=24)]
        want += [(c[0], p[0], c[3], p[3]) for p in met]
        if not met and c[3] + timedelta(hours=24) <= mark:
            want.append((c[0], None, c[3], None))
    assert any(w[1] is None for w in want)
    assert pairs() == sorted(want, key=repr)
    run()                                       # nothing new
    assert pairs() == sorted(want, key=repr)


def log_rows(seed, n=400):
    rnd = random.Random(seed)
    return [(rnd.choice([*"abcdefgh", "hot", "hot", "hot", None]), rnd.choice("IUUUUD"),
             T0 + timedelta(hours=rnd.randrange(24 * 60), minutes=7), i, rnd.choice([*domains.ORDER_STATUSES, None]))
            for i in range(n)]


def brute_findings(rows, mark, stuck, expire):
    out = []
    for key in {r[0] for r in rows if r[0]}:
        mine = sorted((r for r in rows if r[0] == key and r[4] and r[2] <= mark), key=lambda r: (r[2], r[3]))
        status = None
        for i, (_, op, at, _, now) in enumerate(mine):
            if i and at - mine[i - 1][2] >= expire:
                status = None
            if op != "D":
                if status not in (None, now) and (status, now) not in domains.ORDER_TRANSITIONS:
                    out.append((key, "forbidden", at, status, now))
                status = now
            end = mine[i + 1][2] if i + 1 < len(mine) else mark
            if op != "D" and now in matching.OPEN_STATUSES and min(end, mark) - at >= stuck:
                out.append((key, "stuck", at + stuck, now, None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,expire", [(1, 24 * 60), (2, 100)])
def test_order_findings_match_brute_force(spark, seed, expire):
    """Changes come in drops, up to a day out of order inside and between them."""
    rnd = random.Random(seed)
    rows = sorted(log_rows(seed), key=lambda r: r[2] + timedelta(hours=rnd.randrange(20)))
    src, out, ckpt = folder(spark, "findings")

    def run():
        stream = jobs.read_parquet_stream(spark, src, spark.createDataFrame([], LOG).schema)
        matching.run_append(matching.order_findings(stream, delay="25 hours", stuck_hours=60, expire_hours=expire), out, ckpt)

    def found():
        return sorted((tuple(r) for r in spark.read.schema(matching.FINDINGS).parquet(out).collect()), key=repr)
    for some in (rows[:150], rows[150:300], rows[300:]):
        spark.createDataFrame(some, LOG).write.mode("append").parquet(src)
        run()
    mark = max(r[2] for r in rows if r[0] and r[4]) - timedelta(hours=25)
    want = brute_findings(rows, mark, timedelta(hours=60), timedelta(hours=expire))
    assert {w[1] for w in want} == {"forbidden", "stuck"}
    assert found() == want
    run()
    assert found() == want


def test_limits_are_checked(spark):
    with pytest.raises(ValueError):
        matching.order_findings(spark.createDataFrame([], LOG), stuck_hours=10, expire_hours=5)


def test_orders_share_groups(spark):
    """One bucket holds all orders; a change far behind an expired state waits while the order's timer is past."""
    rows = [("a", "I", T0, 0, "pending"), ("b", "I", T0, 0, "completed"), ("c", "I", T0 + timedelta(days=9), 0, "completed"),
            ("b", "U", T0 + timedelta(days=9, hours=1), 1, "pending"), ("c", "U", T0 + timedelta(days=9, hours=2), 1, "pending")]
    src, out, ckpt = folder(spark, "shared")
    for some in (rows[:2], rows[2:], [("z", "I", T0 + timedelta(days=20), 0, "completed")]):
        spark.createDataFrame(some, LOG).write.mode("append").parquet(src)
        stream = jobs.read_parquet_stream(spark, src, spark.createDataFrame([], LOG).schema)
        matching.run_append(matching.order_findings(stream, stuck_hours=48, expire_hours=72, buckets=1), out, ckpt)
    want = brute_findings(rows, T0 + timedelta(days=19), timedelta(hours=48), timedelta(hours=72))
    assert {(w[0], w[1]) for w in want} == {("a", "stuck"), ("b", "stuck"), ("c", "forbidden"), ("c", "stuck")}
    assert sorted((tuple(r) for r in spark.read.schema(matching.FINDINGS).parquet(out).collect()), key=repr) == want
