"""Property tests: the skew-safe formulations against brute force on small random inputs."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.functions.money import div_round_half_up
from stratum.operators import metrics, silver

BASE = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def brute_sessions(events, gap_s=1800):
    out = {}
    by_actor = {}
    for i, (actor, secs) in enumerate(events):
        by_actor.setdefault(actor, []).append((secs, i))
    for actor, xs in by_actor.items():
        xs.sort()
        n, prev = 0, None
        for secs, _ in xs:
            if prev is None or secs - prev >= gap_s:
                n += 1
            out[(actor, n)] = out.get((actor, n), 0) + 1
            prev = secs
    return out


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.integers(min_value=0, max_value=6 * 3600)), min_size=1, max_size=60))
def test_bucketed_sessionize_equals_brute_force(spark, events):
    rows = [(i, a, BASE + dt.timedelta(seconds=s)) for i, (a, s) in enumerate(events)]
    df = spark.createDataFrame(rows, "id long, customer_id string, created_at timestamp_ntz")
    got = {(r.customer_id, r.session_no): r.event_count
           for r in silver.event_sessionize(df, bucket_seconds=900).collect()}
    assert got == brute_sessions(events)


@SETTINGS
@given(st.lists(st.sampled_from(["page_view", "product_view", "add_to_cart", "checkout", "purchase", "search"]),
                min_size=1, max_size=40),
       st.lists(st.integers(min_value=0, max_value=7), min_size=40, max_size=40))
def test_histogram_rank_band_equals_brute_force(spark, types, owners):
    rows = [(str(i), "t", f"c{owners[i]}", t) for i, t in enumerate(types)]
    df = spark.createDataFrame(rows, "id string, tenant_id string, customer_id string, event_type string")
    got = {r.customer_id: (r.score, r.score_rank, r.band) for r in metrics.engagement_score(df).collect()}
    from stratum.functions.domains import ENGAGEMENT_WEIGHTS
    score = {}
    for i, t in enumerate(types):
        score[f"c{owners[i]}"] = score.get(f"c{owners[i]}", 0) + ENGAGEMENT_WEIGHTS[t]
    n = len(score)
    for c, s in score.items():
        rank = 1 + sum(1 for v in score.values() if v > s)
        assert got[c] == (s, rank, 1 + (4 * (rank - 1)) // n)


@SETTINGS
@given(st.lists(st.one_of(st.integers(min_value=0, max_value=40), st.integers(min_value=0, max_value=10**12),
                          st.sampled_from([0, 1, 2, 1023, 1024, 1025, 2**20, 2**20 + 1])),
                min_size=1, max_size=60),
       st.integers(min_value=1, max_value=7))
def test_two_level_score_ranks_equal_brute_force(spark, scores, bands):
    """Wide integer scores with ties, spread over many logarithmic blocks."""
    df = spark.createDataFrame([(v,) for v in scores], "score long")
    got = {r.score: (r.score_rank, r.band) for r in metrics.score_ranks(df, bands).collect()}
    n = len(scores)
    want = {}
    for v in set(scores):
        rank = 1 + sum(1 for x in scores if x > v)
        want[v] = (rank, 1 + (bands * (rank - 1)) // n)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(min_value=0, max_value=10**9), st.integers(min_value=1, max_value=10**6)),
                min_size=1, max_size=30))
def test_half_up_division_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.q for r in df.select(div_round_half_up(F.col("n"), F.col("d")).alias("q")).collect()]
    want = [int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP)) for n, d in pairs]
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["t1", "t2"]), st.integers(min_value=0, max_value=9)),
                min_size=1, max_size=40))
def test_repeat_concentration_equals_brute_force(spark, orders):
    rows = [(str(i), t, f"c{c}", "completed") for i, (t, c) in enumerate(orders)]
    df = spark.createDataFrame(rows, "id string, tenant_id string, customer_id string, status string")
    got = {r.tenant_id: (r.customers, r.orders, r.top_customers, r.top_orders)
           for r in metrics.repeat_concentration(df).collect()}
    for t in {t for t, _ in orders}:
        counts = {}
        for tt, c in orders:
            if tt == t:
                counts[c] = counts.get(c, 0) + 1
        n = len(counts)
        cut = (n * 30 + 99) // 100
        top = [c for c, k in counts.items() if 1 + sum(1 for v in counts.values() if v > k) <= cut]
        assert got[t] == (n, sum(counts.values()), len(top), sum(counts[c] for c in top))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "k2"]),
                          st.integers(min_value=0, max_value=20), st.integers(min_value=0, max_value=3)),
                min_size=1, max_size=50),
       st.sampled_from(["prev", "next"]))
def test_bucketed_neighbour_equals_plain_lag_lead(spark, rows, direction):
    from stratum.functions.windows import neighbour
    data = [(k, BASE + dt.timedelta(hours=h), s, i) for i, (k, h, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, s int, v long")
    got = {r.v: r.nb_v for r in neighbour(df, ["k"], "ts", [F.col("s"), F.col("v")], ["v"],
                                          direction, prefix="nb_", bucket_seconds=3 * 3600).collect()}
    want = {}
    for k in {r[0] for r in data}:
        xs = sorted((r for r in data if r[0] == k), key=lambda r: (r[1], r[2], r[3]))
        for j, r in enumerate(xs):
            if direction == "prev":
                want[r[3]] = xs[j - 1][3] if j > 0 else None
            else:
                want[r[3]] = xs[j + 1][3] if j + 1 < len(xs) else None
    assert got == want
