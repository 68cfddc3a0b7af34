"""As-of join, interval join and ordered funnels against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratum.operators import metrics, sequences, temporal
from test_plans import plan_text

T0 = datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else T0 + timedelta(seconds=seconds)


def final_plan(df):
    return plan_text(df).split("== Initial Plan ==")[0]


# ---------------------------------------------------------------- as-of
def asof_rows(seed, n_left=400, n_right=300, span=20_000, keys=("hot", "hot", "hot", "a", "b", None)):
    rnd = random.Random(seed)
    left = [(i, rnd.choice(keys), rnd.choice([None, *range(0, span, 7)])) for i in range(n_left)]
    right = [(rnd.choice(keys), rnd.randrange(0, span, 7), rnd.randrange(3), rnd.choice(["x", "y", None])) for _ in range(n_right)]
    return left, right + right[:20]


def brute_asof(left, right):
    out = []
    for i, k, t in left:
        found = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        best = max(found, key=lambda r: (r[1], r[2], r[3] is not None, r[3] or ""), default=(None,) * 4)
        out.append((i, k, at(t), best[3], at(best[1])))
    return sorted(out)


def asof(spark, left, right, **args):
    lf = spark.createDataFrame([(i, k, at(t)) for i, k, t in left], "id int, k string, t timestamp_ntz")
    rt = spark.createDataFrame([(k, at(t), n, v) for k, t, n, v in right], "k string, t timestamp_ntz, n int, v string")
    return temporal.asof_join(lf, rt, ["k"], "t", "t", ["v", "t"], tiebreak=["n"], prefix="r_", **args)


@pytest.mark.parametrize("bucket", [60, 3600, 86_400])
def test_asof_matches_brute_force(spark, bucket):
    left, right = asof_rows(1)
    assert sorted(tuple(r) for r in asof(spark, left, right, bucket_seconds=bucket).collect()) == brute_asof(left, right)


def test_asof_empty_sides(spark):
    left, right = asof_rows(2, 20, 20)
    assert asof(spark, [], right).count() == 0
    assert [r.r_v for r in asof(spark, left, []).collect()] == [None] * 20


def test_asof_deals_a_hot_key_by_time(spark):
    """Rows of one key are windowed per bucket; no row window has the key alone."""
    left, right = asof_rows(3, keys=("hot",))
    df = asof(spark, left, right, bucket_seconds=600)
    text = final_plan(df)
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    row_windows = [x for x in text.split("\n") if "Window [" in x and "_row#" in x]
    assert row_windows == [] or all("_b#" in x for x in row_windows)
    windows = [x for x in text.split("\n") if "Window [last(_known" in x]
    assert windows and all("_b#" in x.split("], [", 1)[1] for x in windows)


# ---------------------------------------------------------------- interval
def interval_rows(seed, n=300):
    rnd = random.Random(seed)
    keys = ["hot", "hot", "hot", "a", "b", None]
    points = [(i, rnd.choice(keys), rnd.choice([None, *range(0, 500_000, 50)])) for i in range(n)]
    intervals = []
    for i in range(n // 2):
        a = rnd.choice([None, *range(-90_000, 500_000, 50)])
        length = rnd.choice([0, -50, 50, 600, 86_400, 250_000, 4_000_000, None])
        intervals.append((i, rnd.choice(keys), a, None if a is None or length is None else a + length))
    return points, intervals


def brute_interval(points, intervals, keyed=True):
    return sorted((p, i) for p, kp, t in points for i, ki, a, b in intervals
                  if t is not None and a is not None and (not keyed or kp is not None and kp == ki)
                  and a <= t and (b is None or t < b))


def interval(spark, points, intervals, keys=("k",), **args):
    p = spark.createDataFrame([(i, k, at(t)) for i, k, t in points], "id int, k string, t timestamp_ntz")
    i = spark.createDataFrame([(i, k, at(a), at(b)) for i, k, a, b in intervals],
                              "id int, k string, a timestamp_ntz, b timestamp_ntz")
    return temporal.interval_join(p, i, list(keys), "t", "a", "b", ["id"], prefix="i_", **args)


@pytest.mark.parametrize("args", [{}, {"base_seconds": 300}, {"base_seconds": 300, "split_rows": 5}, {"split_rows": 3}])
def test_interval_matches_brute_force(spark, args):
    points, intervals = interval_rows(4)
    got = sorted((r.id, r.i_id) for r in interval(spark, points, intervals, **args).collect())
    assert got == brute_interval(points, intervals)      # every pair, once


def test_interval_without_keys_and_empty(spark):
    points, intervals = interval_rows(5, 120)
    got = sorted((r.id, r.i_id) for r in interval(spark, points, intervals, (), split_rows=20).collect())
    assert got == brute_interval(points, intervals, keyed=False)
    assert interval(spark, [], intervals).count() == 0 and interval(spark, points, []).count() == 0


def test_interval_plan_is_an_equi_join(spark):
    points, intervals = interval_rows(6)
    text = final_plan(interval(spark, points, intervals, ()))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_hot_bin_is_split(spark):
    """A bin with all rows of both sides is dealt to a grid of parts."""
    points = [(i, "hot", 60 + i) for i in range(300)]
    intervals = [(i, "hot", 0, 10_000) for i in range(40)]
    df = interval(spark, points, intervals, split_rows=50)
    assert df.count() == 300 * 40
    text = final_plan(df)
    assert "_p#" in text and "_i#" in text


# ---------------------------------------------------------------- ordered funnel
STEPS = ["page_view", "product_view", "add_to_cart", "checkout", "purchase"]


def brute_depth(events, steps, window):
    """Longest prefix of the steps as a chain: every start, greedily earliest continuation."""
    by = defaultdict(list)
    for k, kind, t in events:
        if t is not None and kind in steps:
            by[k].append((t, kind))
    out = {}
    for k, rows in by.items():
        best = 0
        for start, kind in rows:
            if kind != steps[0]:
                continue
            now, depth = start, 1
            for step in steps[1:]:
                later = [t for t, x in rows if x == step and now < t <= start + window]
                if not later:
                    break
                now, depth = min(later), depth + 1
            best = max(best, depth)
        out[k] = best
    return out


def event_frame(spark, events):
    return spark.createDataFrame([("t", k, kind, at(t)) for k, kind, t in events],
                                 "tenant_id string, session_id string, event_type string, created_at timestamp_ntz")


@pytest.mark.parametrize("window", [500, 3600])
def test_sequence_depth_matches_brute_force(spark, window):
    rnd = random.Random(window)
    events = [(rnd.choice(["hot", "hot", "hot", "s1", "s2", "s3", None]), rnd.choice([*STEPS, "search", None]),
               rnd.choice([None, *range(0, 40 * window, window // 10)])) for _ in range(900)]
    events += events[:50]
    got = {r.session_id: r.depth for r in sequences.sequence_depth(
        event_frame(spark, events), ["tenant_id", "session_id"], STEPS, window).collect()}
    assert got == brute_depth(events, STEPS, window)


def test_order_and_window_matter(spark):
    rows = [("forward", s, 10 * i) for i, s in enumerate(STEPS)]
    rows += [("reversed", s, 1000 - 10 * i) for i, s in enumerate(STEPS)]
    rows += [("slow", s, 30_000 * i) for i, s in enumerate(STEPS)]       # the fourth step is over a day later
    rows += [("same time", s, 5) for s in STEPS]
    rows += [("restart", s, t) for s, t in (("page_view", 0), ("page_view", 80_000), ("product_view", 90_000),
                                             ("add_to_cart", 100_000), ("checkout", 110_000), ("purchase", 166_400))]
    ev = event_frame(spark, rows)
    depth = {r.session_id: r.depth for r in sequences.sequence_depth(ev, ["tenant_id", "session_id"], STEPS).collect()}
    assert depth == {"forward": 5, "reversed": 1, "slow": 3, "same time": 1, "restart": 5}
    unordered = {r.step: r.sessions for r in metrics.funnel_conversion(ev).collect()}
    ordered = {r.step: r.sessions for r in sequences.funnel_ordered(ev).collect()}
    assert unordered["purchase"] == 5 and ordered["purchase"] == 2
    assert metrics.cart_abandonment(ev).first().abandoned_sessions == 0
    got = sequences.cart_abandonment_ordered(ev).first()
    assert (got.cart_sessions, got.abandoned_sessions) == (5, 2)         # reversed, same time


def test_funnel_has_no_window_over_a_whole_session(spark):
    ev = event_frame(spark, [("s", s, i) for i, s in enumerate(STEPS)])
    text = final_plan(sequences.sequence_depth(ev, ["tenant_id", "session_id"], STEPS))
    windows = [x for x in text.split("\n") if "Window [" in x]
    assert len(windows) == len(STEPS) - 1 and all("_group#" in x for x in windows)
    assert text.count("Exchange hashpartitioning") <= 2
    assert Counter(r.depth for r in sequences.sequence_depth(ev.where(F.lit(False)), ["session_id"], STEPS).collect()) == {}
