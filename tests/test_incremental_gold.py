"""Incremental Gold equals the full recompute after every batch of changes."""

import glob
import os
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratum.operators import gold, silver
from stratum.streaming.incremental_gold import TABLES, IncrementalGold
from stratum.streaming.runs import Keyed, RunStore, runs_to_merge

LOG = ("op string, commit_ts timestamp_ntz, seq int, id string, tenant_id string, customer_id string, "
       "order_date timestamp_ntz, status string, total decimal(10,2)")
T0 = datetime(2024, 1, 1)


def scratch():
    return tempfile.mkdtemp(prefix="stratum-gold-", dir="/tmp")


def random_log(seed, n_orders=60, n_changes=260):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_changes):
        when = T0 + timedelta(minutes=rnd.randrange(100_000))
        op = rnd.choice("IUUUD")
        status = rnd.choice(["completed", "completed", "completed", "pending", None])
        rows.append((op, when, i, f"o{rnd.randrange(n_orders)}", rnd.choice(["t1", "t1", "t2", None]),
                     rnd.choice(["c1", "c1", "c1", "c2", "c3", None]),
                     T0 + timedelta(days=rnd.randrange(70)) if rnd.random() > 0.05 else None, status,
                     rnd.choice([None, rnd.randrange(1, 9999) / 100])))
    rows.append(("X", T0, 0, "o1", "t1", "c1", T0, "completed", 1.0))       # not mergeable: no part
    rows.append(("U", None, 0, "o1", "t1", "c1", T0, "completed", 1.0))
    return rows


@pytest.fixture(scope="module")
def dims(spark):
    tenants = spark.createDataFrame([("t1", "One"), ("t2", "Two")], "id string, name string")
    customers = spark.createDataFrame([(f"c{i}", t, f"{i}@x") for i in range(1, 4) for t in ("t1", "t2")],
                                      "id string, tenant_id string, email string")
    return tenants, customers


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(*r[:-1], None if r[-1] is None else Decimal(f"{r[-1]:.2f}")) for r in rows], LOG)


def test_every_version_equals_the_recompute(spark, dims):
    """Inserts, updates, deletes, late and repeated changes, replays: C1 and C6 stay exact."""
    tenants, customers = dims
    log = random_log(1)
    random.Random(2).shuffle(log)           # arrival order is not commit order
    g = IncrementalGold(spark, scratch(), fanout=3, retain=9)
    size, seen = len(log) // 5 + 1, []
    batches = [log[i:i + size] for i in range(0, len(log), size)]
    batches.insert(2, batches[1])           # old changes again, as a new version
    for version, batch in enumerate(batches):
        seen += batch
        assert g.refresh(frame(spark, batch), version)
        now = silver.cdc_merge_latest(frame(spark, seen).distinct())
        assert rows_of(g.revenue_by_tenant_monthly(tenants)) == rows_of(gold.revenue_by_tenant_monthly(now, tenants))
        assert rows_of(g.customer_ltv(customers, tenants)) == rows_of(gold.customer_ltv(now, customers, tenants))
    first = silver.cdc_merge_latest(frame(spark, batches[0]))
    assert rows_of(g.revenue_by_tenant_monthly(tenants, 0)) == rows_of(gold.revenue_by_tenant_monthly(first, tenants))
    assert g.refresh(frame(spark, batches[0]), 0) is False              # committed: skipped
    assert g.store.last() == len(batches) - 1
    assert len(g.store._manifest(g.store.last())["images"]) < len(batches)       # runs were merged


def test_crash_before_the_commit_changes_nothing(spark, dims):
    tenants, _ = dims
    root, log = scratch(), random_log(3, 20, 60)
    g = IncrementalGold(spark, root)
    g.refresh(frame(spark, log[:40]), 0)
    want = rows_of(g.revenue_by_tenant_monthly(tenants))
    g.refresh(frame(spark, log[40:]), 1)
    after = rows_of(g.revenue_by_tenant_monthly(tenants))
    # The crash: the rows of version 1 are there in part, its manifest is not.
    os.remove(os.path.join(root, "_manifest", "version=1", "_SUCCESS"))
    os.remove(glob.glob(os.path.join(root, "revenue", "v=1", "*.parquet"))[0])
    assert rows_of(g.revenue_by_tenant_monthly(tenants)) == want != after
    assert g.refresh(frame(spark, log[40:]), 1)
    assert rows_of(g.revenue_by_tenant_monthly(tenants)) == after


def test_a_small_batch_writes_little(spark):
    """1 % of the keys: less than 5 % of the rows are written, and no table is read whole
    but for the keys looked up."""
    root = scratch()
    rows = spark.range(5000).select(
        F.lit("I").alias("op"), F.lit(T0).cast("timestamp_ntz").alias("commit_ts"), F.lit(0).alias("seq"),
        F.concat(F.lit("o"), "id").alias("id"), F.concat(F.lit("t"), F.col("id") % 3).alias("tenant_id"),
        F.concat(F.lit("c"), F.col("id") % 900).alias("customer_id"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(id % 300 AS int))").alias("order_date"),
        F.lit("completed").alias("status"), (F.col("id") % 100).cast("decimal(10,2)").alias("total"))
    g = IncrementalGold(spark, root)
    g.refresh(rows, 0)

    def written(version):
        return sum(spark.read.parquet(p).count() for t in TABLES for k in ("v", "m")
                   for p in [f"{root}/{t}/{k}={version}"] if os.path.exists(p))

    whole = written(0)
    some = rows.where(F.expr("cast(substr(id, 2) AS int) % 100 = 7")).withColumn("op", F.lit("U")) \
        .withColumn("commit_ts", F.expr("commit_ts + INTERVAL 1 DAY")).withColumn("status", F.lit("cancelled"))
    g.refresh(some, 1)
    assert 0 < written(1) < 0.05 * whole
    assert g.store.read("revenue").agg(F.sum("n")).first()[0] == 4950


def test_runs_merge_like_a_counter():
    assert runs_to_merge([100, 1, 1, 1]) == 0
    assert runs_to_merge([100, 1, 1, 1, 1]) == 4
    assert runs_to_merge([4, 1, 1, 1, 1]) == 5
    runs, moved, most = [], 0, 0
    for _ in range(1000):
        runs.append(1)
        n = runs_to_merge(runs)
        if n:
            runs[-n:] = [sum(runs[-n:])]
            moved += runs[-1]
        most = max(most, len(runs))
    assert sum(runs) == 1000 and most <= 16 and moved < 1000 * 10


def test_run_store_settles_only_whole_merges(spark):
    """A zero in a merge of some runs still cancels what an older run holds."""
    spec = Keyed("k string, n long", lambda r: r.groupBy("k").agg(F.sum("n").alias("n")), lambda r: r.where("n <> 0"))
    store = RunStore(spark, scratch(), {"sums": spec}, fanout=2, retain=1)

    def put(version, *rows):
        store.write("sums", version, spark.createDataFrame(list(rows), "k string, n long"))
        store.commit(version, ["sums"])

    put(0, *[(f"k{i}", 1) for i in range(50)])
    put(1, ("k1", -1))
    put(2, ("k1", 0), ("k2", 5))
    got = {r.k: r.n for r in store.read("sums").collect()}
    assert got["k1"] == 0 and got["k2"] == 6 and len(got) == 50
    put(3, *[(f"k{i}", 1) for i in range(2, 50)])
    got = {r.k: r.n for r in store.read("sums").collect()}
    assert "k1" not in got and len(got) == 49
    assert store.versions() == [3]
    with pytest.raises(ValueError):
        store.commit(3, ["sums"])
    assert {r.k: r.n for r in store.lookup("sums", spark.createDataFrame([("k2",), ("zz",)], "k string")).collect()} == {"k2": 7}


def test_upsert_table_keeps_keyless_rows_and_expires_tombstones(spark):
    from stratum.streaming.jobs import silver_table
    schema = spark.createDataFrame([], "op string, commit_ts timestamp_ntz, seq int, id string, status string").schema
    table = silver_table(spark, scratch(), schema, tombstone_days=5)

    def batch(day, *rows):
        return spark.createDataFrame([(op, T0 + timedelta(days=day), 0, i, s) for op, i, s in rows], schema)

    def now():
        return {r.id: (r.op, r.status) for r in table.read().collect()}

    assert table.upsert(batch(0, ("I", "a", "new"), ("I", "b", "new"), ("I", None, "lost"), ("I", None, "lost")), 0)
    assert table.upsert(batch(1, ("D", "a", None), ("U", "b", "done")), 1)
    assert not table.upsert(batch(1, ("U", "b", "replayed")), 1)
    assert table.upsert(batch(0, ("U", "a", "late and old")), 2)
    assert now() == {"a": ("D", None), "b": ("U", "done")}
    assert table.rejected().count() == 2
    assert table.upsert(batch(9, ("I", "c", "new"), ("I", "d", "new")), 3)      # all runs become one
    assert table.upsert(batch(9, ("D", "d", None)), 4)
    assert now() == {"b": ("U", "done"), "c": ("I", "new"), "d": ("I", "new")} | {"d": ("D", None)}
