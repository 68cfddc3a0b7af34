"""Streaming jobs driven over files derived from the driver tables.

Each query writes its input as a sequence of file drops into a fresh
folder under the shared checkpoint root (``spark.checkpoint.dir``), runs
the streaming job with ``availableNow`` after every drop (the checkpoint
carries offsets and watermark from run to run), and returns the sink
table read back as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import bronze
from ..streaming import jobs, matching
from ..streaming.incremental_gold import IncrementalGold, run_incremental_gold
from ..streaming.sinks import fresh_dir
from .oracle import avg_money, month, with_fixtures
from .registry import register
from .silver_queries import _MERGED


def _run_dir(shop, name: str) -> str:
    return fresh_dir(scratch_path(shop.spark, "streams"), name)


def _day_slices(events: DataFrame) -> list:
    """Conditions splitting events by day offset from the first day: [0,10), [10,20), [20, ...)."""
    first = events.agg(F.min(F.to_date("created_at")).alias("d")).first()["d"]
    off = F.datediff(F.to_date("created_at"), F.lit(first))
    return [off < 10, (off >= 10) & (off < 20), off >= 20]


def _drop_and_run(drops: list[DataFrame], src: str, run) -> None:
    for d in drops:
        d.write.mode("append").parquet(src)
        run()


# ---------------------------------------------------------------- G1 / G2
def _ingest(s):
    """The full-load file lands in the table's load folder, then the update
    and delete files in its ``cdc`` folder; one stream watches both folders
    (a glob), and each run on the same checkpoint picks up only new files."""
    root = _run_dir(s, "ingest")
    load, cdc = bronze.bronze_paths(f"{root}/bronze", "order")
    src = bronze.bronze_glob(f"{root}/bronze", "order")
    target, ckpt = f"{root}/bronze_parquet", f"{root}/ckpt"
    log = s.order_changes().drop("seq")
    for op, folder in (("I", load), ("U", cdc), ("D", cdc)):
        bronze.write_bronze_csv(bronze.to_bronze(log.where(F.col("op") == op), "order"), folder, mode="append")
        jobs.ingest_changes(jobs.read_change_stream(s.spark, src, "order", "csv"), target, ckpt)
    return s.spark.read.parquet(target).select("op", "id", "status", "commit_ts")


register("stream_bronze_ingest", "G1", with_fixtures("""
SELECT op, id, status, commit_ts FROM t_order_log"""))(_ingest)


# ---------------------------------------------------------------- G3 / G4
def _funnel(s):
    root = _run_dir(s, "funnel")
    src, target, ckpt = f"{root}/events", f"{root}/funnel", f"{root}/ckpt"
    ev = s.event.select("id", "tenant_id", "customer_id", "event_type", "created_at")
    schema = ev.schema
    _drop_and_run([ev.where(c) for c in _day_slices(ev)], src, lambda: jobs.run_funnel_upsert(
        jobs.funnel_counts(jobs.read_parquet_stream(s.spark, src, schema)), target, ckpt))
    return jobs.funnel_table(s.spark, target).read().select("tenant_id", "event_type", "hour", "event_count")


def _late_events(s):
    """A tenth of the first days' events arrives after all others: they are
    listed as late, and their hours are corrected."""
    root = _run_dir(s, "late")
    src, target, late, ckpt = f"{root}/events", f"{root}/funnel", f"{root}/late", f"{root}/ckpt"
    ev = s.event.select("id", "tenant_id", "customer_id", "event_type", "created_at") \
        .withColumn("tenant_id", F.coalesce("tenant_id", F.lit("unknown")))
    conds = _day_slices(ev)
    held_back = conds[0] & (F.col("id").cast("bigint") % 10 == 3)
    drops = [*[ev.where(c & ~held_back) for c in conds], ev.where(held_back)]
    _drop_and_run(drops, src, lambda: jobs.run_funnel_with_late(
        jobs.read_parquet_stream(s.spark, src, ev.schema), target, late, ckpt))
    hour = F.date_trunc("hour", F.col("created_at").cast("timestamp")).cast("timestamp_ntz")
    behind = s.spark.read.schema(ev.schema).parquet(f"{late}/batch=*").groupBy(
        "tenant_id", "event_type", hour.alias("hour")).agg(F.count(F.lit(1)).alias("late_events"))
    return jobs.late_funnel_store(s.spark, target).read("counts").join(behind, jobs.WINDOW_KEYS, "left").select(
        *jobs.WINDOW_KEYS, "event_count", F.coalesce("late_events", F.lit(0)).alias("late_events"))


_FUNNEL_SQL = """
SELECT tenant_id, event_type, date_trunc('hour', created_at) AS hour, count(*) AS event_count
FROM t_event GROUP BY 1, 2, 3"""

register("stream_funnel_hourly", "G3", with_fixtures(_FUNNEL_SQL))(_funnel)

register("stream_late_events", "G4", with_fixtures("""
SELECT coalesce(tenant_id, 'unknown') AS tenant_id, event_type, date_trunc('hour', created_at) AS hour,
       count(*) AS event_count,
       count(*) FILTER (WHERE date_diff('day', (SELECT min(cast(created_at AS date)) FROM t_event),
                                        cast(created_at AS date)) < 10
                        AND cast(id AS bigint) % 10 = 3) AS late_events
FROM t_event GROUP BY 1, 2, 3"""))(_late_events)


# ---------------------------------------------------------------- G5
def _sessions(s):
    root = _run_dir(s, "sessions")
    src, target, ckpt = f"{root}/events", f"{root}/sessions", f"{root}/ckpt"
    ev = s.event.select("id", "customer_id", "created_at")
    schema = ev.schema
    _drop_and_run([ev.where(c) for c in _day_slices(ev)], src, lambda: jobs.run_sessions(
        jobs.sessions(jobs.read_parquet_stream(s.spark, src, schema)), target, ckpt,
        output_mode="complete"))
    return s.spark.read.parquet(target)


_SESSIONS_SQL = """
SELECT * FROM (SELECT customer_id, min(created_at) AS session_start, max(created_at) + INTERVAL 30 MINUTE AS session_end,
       count(*) AS event_count
FROM (SELECT customer_id, created_at,
             sum(CASE WHEN prev IS NULL OR created_at - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
               OVER (PARTITION BY customer_id ORDER BY created_at, cast(id AS bigint)
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no
      FROM (SELECT customer_id, created_at, id,
                   lag(created_at) OVER (PARTITION BY customer_id ORDER BY created_at, cast(id AS bigint)) AS prev
            FROM t_event WHERE customer_id IS NOT NULL))
GROUP BY customer_id, session_no)"""

register("stream_sessions", "G5", with_fixtures(_SESSIONS_SQL))(_sessions)


def _sessions_append(s):
    """G5 as it runs in production: append mode, state evicted by the watermark.

    A session is written once the watermark (latest event time - 1 hour)
    passes its end, so the table holds the closed sessions only; those
    still open at the end of the input stay in bounded state.
    """
    root = _run_dir(s, "sessions_append")
    src, target, ckpt = f"{root}/events", f"{root}/sessions", f"{root}/ckpt"
    ev = s.event.select("id", "customer_id", "created_at")
    schema = ev.schema
    _drop_and_run([ev.where(c) for c in _day_slices(ev)], src, lambda: jobs.run_sessions(
        jobs.sessions(jobs.read_parquet_stream(s.spark, src, schema)), target, ckpt,
        output_mode="append"))
    return s.spark.read.parquet(target)


register("stream_sessions_closed", "G5", with_fixtures(_SESSIONS_SQL + """
WHERE session_end <= (SELECT max(created_at) FROM t_event WHERE customer_id IS NOT NULL) - INTERVAL 1 HOUR"""))(
    _sessions_append)


# ---------------------------------------------------------------- G6
def _dedup(s):
    """Changes arrive in commit-time order: everything up to the last 30 days
    of commits, then the last 30 days, then that same file again (a
    re-delivery).  The 30-day watermark delay covers the re-delivered
    file, so its rows meet their first copies in the dedup state, and the
    state holds at most 30 days of keys."""
    root = _run_dir(s, "dedup")
    src, target, ckpt = f"{root}/changes", f"{root}/deduped", f"{root}/ckpt"
    log = s.order_changes().select("op", "commit_ts", "seq", "id", "status")
    schema = log.schema
    last = log.agg(F.max("commit_ts").alias("t")).first()["t"]    # one value
    recent = F.col("commit_ts") >= F.lit(last) - F.make_dt_interval(F.lit(DEDUP_DAYS))
    drops = [log.where(~recent), log.where(recent), log.where(recent)]
    _drop_and_run(drops, src, lambda: jobs.run_available_now(
        jobs.dedup_changes(jobs.read_parquet_stream(s.spark, src, schema), f"{DEDUP_DAYS} days")
        .writeStream.format("parquet").option("path", target).outputMode("append"), ckpt))
    return s.spark.read.parquet(target).select("op", "id", "status", "commit_ts")


DEDUP_DAYS = 30


register("stream_dedup_changes", "G6", with_fixtures("""
SELECT op, id, status, commit_ts FROM t_order_log"""))(_dedup)


# ---------------------------------------------------------------- G7
def _upsert(s):
    root = _run_dir(s, "upsert")
    src, target, ckpt = f"{root}/changes", f"{root}/silver_order", f"{root}/ckpt"
    log = s.order_changes()
    schema = log.schema
    _drop_and_run([log.where(F.col("op") == op) for op in ("I", "U", "D")], src,
                  lambda: jobs.run_silver_upsert(jobs.read_parquet_stream(s.spark, src, schema),
                                                 target, ckpt))
    return (jobs.silver_view(s.spark, target, "order", schema)
            .select("id", "status", F.col("total").cast("double").alias("total"), "order_date"))


register("stream_upsert_silver", "G7", with_fixtures(_MERGED.format(where="")))(_upsert)


# ---------------------------------------------------------------- incremental Gold
def _arrival() -> Column:
    """The drop in which a change arrives: by commit time, but some updates come last,
    after later changes of their order."""
    late = (F.col("seq") == 1) & (F.col("id").cast("bigint") % 3 == 0)
    day = F.col("commit_ts")
    return (F.when(late, 3).when(day < F.lit("1997-01-01").cast("timestamp_ntz"), 0)
            .when(day < F.lit("1999-01-01").cast("timestamp_ntz"), 1).otherwise(3))


def _incremental(s) -> IncrementalGold:
    """Four drops on one stream, the third of them a replay of the second."""
    root = _run_dir(s, "incremental_gold")
    src, target, ckpt = f"{root}/changes", f"{root}/gold", f"{root}/ckpt"
    log = s.order_changes().withColumn("_drop", _arrival())
    _drop_and_run([log.where(F.col("_drop") == n).drop("_drop") for n in (0, 1, 1, 3)], src, lambda: run_incremental_gold(
        jobs.read_parquet_stream(s.spark, src, log.drop("_drop").schema), target, ckpt, retain=4))
    return IncrementalGold(s.spark, target, retain=4)


def _incremental_revenue(s):
    """C1 after every drop."""
    gold = _incremental(s)
    found = [gold.revenue_by_tenant_monthly(s.tenant, v).withColumn("version", F.lit(v)) for v in range(4)]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


_KNOWN = """
  SELECT * FROM (
    SELECT v.version, l.*, row_number() OVER (PARTITION BY v.version, id ORDER BY commit_ts DESC, seq DESC) AS rn
    FROM (SELECT *, CASE WHEN seq = 1 AND okey % 3 = 0 THEN 3 WHEN commit_ts < timestamp '1997-01-01' THEN 0
                         WHEN commit_ts < timestamp '1999-01-01' THEN 1 ELSE 3 END AS arrival FROM t_order_log) l
    JOIN (SELECT unnest([0, 1, 2, 3]) AS version) v ON l.arrival <= v.version)
  WHERE rn = 1 AND op <> 'D' AND status = 'completed'"""

register("gold_incremental", "G2", with_fixtures(f"""
SELECT o.version, o.tenant_id, t.name AS tenant_name, {month('o.order_date')} AS month,
       count(o.id) AS order_count, cast(sum(o.total) AS double) AS total_revenue,
       {avg_money('o.total')} AS avg_order_value, count(DISTINCT o.customer_id) AS unique_customers
FROM ({_KNOWN}) o JOIN t_tenant t ON o.tenant_id = t.id
GROUP BY o.version, o.tenant_id, t.name, {month('o.order_date')}"""))(_incremental_revenue)

register("gold_incremental_ltv", "G2", with_fixtures(f"""
SELECT o.tenant_id, t.name AS tenant_name, o.customer_id, c.email,
       count(o.id) AS total_orders, cast(sum(o.total) AS double) AS lifetime_value,
       {avg_money('o.total')} AS avg_order_value,
       min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date,
       cast(date_diff('day', cast(min(o.order_date) AS date), cast(max(o.order_date) AS date)) AS integer) AS customer_age_days
FROM ({_KNOWN}) o JOIN t_customer c ON c.id = o.customer_id AND c.tenant_id = o.tenant_id
JOIN t_tenant t ON t.id = o.tenant_id
WHERE o.version = 3
GROUP BY o.tenant_id, t.name, o.customer_id, c.email"""))(
    lambda s: _incremental(s).customer_ltv(s.customer, s.tenant))


# ---------------------------------------------------------------- joins and checks with state
def _cart_purchases(s):
    """Carts with their purchases of the next 24 hours; a cart without one is listed once its window has closed."""
    root = _run_dir(s, "carts")
    src, target, ckpt = f"{root}/events", f"{root}/pairs", f"{root}/ckpt"
    ev = s.event.select("id", "customer_id", "event_type", "created_at")

    def run():
        carts, bought = (jobs.read_parquet_stream(s.spark, src, ev.schema).where(F.col("event_type") == t)
                         for t in ("add_to_cart", "purchase"))
        matching.run_append(matching.carts_with_purchases(carts, bought), target, ckpt)
    _drop_and_run([ev.where(c) for c in _day_slices(ev)], src, run)
    return s.spark.read.parquet(target)


register("stream_cart_purchases", "F9", with_fixtures("""
SELECT c.id AS cart_id, c.customer_id, c.created_at AS cart_at, p.id AS purchase_id, p.created_at AS purchase_at
FROM t_event c LEFT JOIN (SELECT * FROM t_event WHERE event_type = 'purchase') p
  ON p.customer_id = c.customer_id AND p.created_at >= c.created_at AND p.created_at < c.created_at + INTERVAL 24 HOUR
WHERE c.event_type = 'add_to_cart' AND c.customer_id IS NOT NULL
  AND (p.id IS NOT NULL OR c.created_at + INTERVAL 25 HOUR <= (
    SELECT least(max(created_at) FILTER (WHERE event_type = 'add_to_cart'), max(created_at) FILTER (WHERE event_type = 'purchase'))
    FROM t_event WHERE customer_id IS NOT NULL))"""))(_cart_purchases)


def _order_findings(s):
    """The order change log in three drops by commit time, checked as it comes."""
    root = _run_dir(s, "order_findings")
    src, target, ckpt = f"{root}/changes", f"{root}/findings", f"{root}/ckpt"
    log = s.order_changes().select("id", "op", "commit_ts", "seq", "status")
    span = log.agg(F.min("commit_ts").alias("lo"), F.max("commit_ts").alias("hi")).first()
    cuts = [F.lit(span.lo + (span.hi - span.lo) * k / 3) for k in (1, 2)]
    at = F.col("commit_ts")
    _drop_and_run([log.where(at < cuts[0]), log.where((at >= cuts[0]) & (at < cuts[1])), log.where(at >= cuts[1])], src,
                  lambda: matching.run_append(matching.order_findings(
                      jobs.read_parquet_stream(s.spark, src, log.schema), delay="30 hours"), target, ckpt))
    return s.spark.read.parquet(target)


register("stream_order_findings", "B20", with_fixtures("""
SELECT id, 'forbidden' AS kind, commit_ts AS found_at, was AS from_status, status AS to_status
FROM (SELECT *, lag(status) OVER (PARTITION BY id ORDER BY commit_ts, seq) AS was FROM t_order_log WHERE op <> 'D'), t_end
WHERE was <> status AND commit_ts <= t_end.t AND (was, status) NOT IN (
  ('pending', 'processing'), ('processing', 'completed'), ('pending', 'completed'),
  ('pending', 'cancelled'), ('processing', 'cancelled'))
UNION ALL
SELECT id, 'stuck', commit_ts + to_days(4), status, NULL
FROM (SELECT *, lead(commit_ts) OVER (PARTITION BY id ORDER BY commit_ts, seq) AS nxt FROM t_order_log), t_end
WHERE op <> 'D' AND status IN ('pending', 'processing') AND commit_ts + to_days(4) <= least(nxt, t_end.t)""",
    {"t_end": "SELECT max(commit_ts) - INTERVAL 30 HOUR AS t FROM t_order_log"}))(_order_findings)
