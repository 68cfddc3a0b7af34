"""Two streaming jobs with keyed state: carts matched to purchases, and order changes checked as they come.

Both keep state only as long as the watermark needs it, write in append mode to
a Parquet table (each row once, also after a replay), and run continuously or as
``availableNow`` back-fills.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import domains
from .sinks import run_available_now

# ---------------------------------------------------------------- carts and purchases
PARTS = 4


def carts_with_purchases(carts: DataFrame, purchases: DataFrame, window_hours: int = 24, delay: str = "1 hour",
                         parts: int = PARTS) -> DataFrame:
    """Every pair of a cart and a later purchase of its customer within the window, and
    every cart without one, once, when its window has closed (null purchase).

    Both sides have (id, customer_id, created_at); rows without a customer or a
    time take no part.  Two watermarks and the time range bound the state of
    both sides to window plus delay.  A cart lies in one (window-long bucket,
    part of ``parts``); a purchase goes to the two buckets, and all parts, whose
    carts it can follow.  So a customer's state is spread over buckets and parts, and an
    unmatched cart is reported by the one place that holds it.
    """
    width = window_hours * 3600

    def known(df: DataFrame, ident: str, ts: str) -> DataFrame:
        return (df.where(F.col("customer_id").isNotNull() & F.col("created_at").isNotNull())
                .select(F.col("id").alias(ident), "customer_id", F.col("created_at").cast("timestamp").alias(ts))
                .withColumn("bucket", F.floor(F.unix_seconds(ts) / width)).withWatermark(ts, delay))
    c = known(carts, "cart_id", "cart_ts").withColumn("part", F.pmod(F.xxhash64("cart_id"), F.lit(parts)))
    p = (known(purchases, "purchase_id", "purchase_ts").withColumnRenamed("customer_id", "buyer")
         .withColumn("bought", F.explode(F.array(F.col("bucket") - 1, F.col("bucket")))).drop("bucket")
         .withColumn("for_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))))
    within = ((F.col("purchase_ts") >= F.col("cart_ts"))
              & (F.col("purchase_ts") < F.col("cart_ts") + F.expr(f"INTERVAL {window_hours} HOURS")))
    same = (F.col("customer_id") == F.col("buyer")) & (F.col("bucket") == F.col("bought")) & (F.col("part") == F.col("for_part"))
    return c.join(p, same & within, "left_outer").select(
        "cart_id", "customer_id", F.col("cart_ts").cast("timestamp_ntz").alias("cart_at"), "purchase_id",
        F.col("purchase_ts").cast("timestamp_ntz").alias("purchase_at"))


def run_append(rows: DataFrame, target: str, checkpoint: str) -> None:
    run_available_now(rows.writeStream.format("parquet").option("path", target).outputMode("append"), checkpoint)


# ---------------------------------------------------------------- order changes
FINDINGS = "id string, kind string, found_at timestamp_ntz, from_status string, to_status string"
_STATE = "orders string"
OPEN_STATUSES = ("pending", "processing")
BUCKETS = 2048                  # groups with state; fixed for the life of a checkpoint
_OP_RANK = {"I": 0, "U": 1, "D": 2}
_HOUR = 3_600_000_000


class _Order:
    """The changes of one order in event time: its last status, and those above the watermark."""

    __slots__ = ("key", "stuck", "expire", "status", "since", "open", "waiting")

    def __init__(self, key: str, stuck: int, expire: int, status: str | None = None, since: int | None = None,
                 open: bool = False, waiting: list | None = None):
        self.key, self.stuck, self.expire = key, stuck, expire
        self.status, self.since, self.open, self.waiting = status, since, open, waiting or []

    def _late(self, now: int, found: list) -> None:
        if self.open and now >= self.since + self.stuck:
            found.append((self.key, "stuck", self.since + self.stuck, self.status, None))
            self.open = False

    def advance(self, watermark: int, found: list) -> None:
        if self.waiting:
            ready = sorted(w for w in self.waiting if w[0] <= watermark)
            self.waiting = [w for w in self.waiting if w[0] > watermark]
            for at, _, rank, status in ready:
                self._late(at, found)
                if self.since is not None and at - self.since >= self.expire:
                    self.status = None
                deleted = rank == _OP_RANK["D"]
                if not deleted:
                    if self.status is not None and status != self.status \
                            and (self.status, status) not in domains.ORDER_TRANSITIONS:
                        found.append((self.key, "forbidden", at, self.status, status))
                    self.status = status
                self.since, self.open = at, not deleted and status in OPEN_STATUSES
        self._late(watermark, found)
        if self.since is not None and not self.open and self.since + self.expire <= watermark:
            self.status = self.since = None             # what still waits is a first change

    def wake(self) -> int | None:
        """When something can happen next: a waiting change, a deadline, the end of the state."""
        times = [w[0] for w in self.waiting]
        if self.since is not None:
            times.append(self.since + (self.stuck if self.open else self.expire))
        return min(times, default=None)


def order_findings(changes: DataFrame, delay: str = "1 day", stuck_hours: int = 24 * 4, expire_hours: int = 24 * 60,
                   buckets: int = BUCKETS) -> DataFrame:
    """Forbidden status changes (those that B20 calls invalid), and orders that stay
    pending or processing for ``stuck_hours`` without any change.

    Changes (id, op, commit_ts, seq, status) may come in any order within ``delay``: they wait in
    the order's state until the watermark has passed them and are judged in the
    order (commit_ts, seq, op).  A timer reports stuck orders and drops the state of
    an order ``expire_hours`` after its last change (a later change is a first one again).
    A delete ends the wait and keeps the status, as in B20.  Rows without an id, time or status take
    no part.  State per order is its last status and the changes of the last ``delay``.

    A call per order costs milliseconds, so the orders of a bucket (a hash of the id) share
    a group: its state has one entry per live order, and its timer is the earliest of theirs.
    """
    if not 0 < stuck_hours <= expire_hours:
        raise ValueError("orders must be stuck before their state expires")
    stuck, expire = stuck_hours * _HOUR, expire_hours * _HOUR

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {}
        orders = {k: _Order(k, stuck, expire, *v) for k, v in held.items()}
        if not state.hasTimedOut:
            for f in frames:
                for k, *change in zip(*(f[c].tolist() for c in ("id", "us", "seq", "rank", "status")), strict=True):
                    if k not in orders:
                        orders[k] = _Order(k, stuck, expire)
                    orders[k].waiting.append(change)
        watermark = max(state.getCurrentWatermarkMs(), 0) * 1000
        found, live, first = [], {}, None
        for k, order in orders.items():
            order.advance(watermark, found)
            wake = order.wake()
            if wake is not None:
                live[k] = (order.status, order.since, order.open, order.waiting)
                first = wake if first is None else min(first, wake)
        if live:
            state.update((json.dumps(live, separators=(",", ":")),))
            state.setTimeoutTimestamp(-(-first // 1000))
        elif state.exists:
            state.remove()
        if found:
            out = pd.DataFrame(found, columns=["id", "kind", "found_at", "from_status", "to_status"])
            yield out.assign(found_at=pd.to_datetime(out["found_at"], unit="us"))

    rank = F.create_map(*[F.lit(x) for pair in _OP_RANK.items() for x in pair])[F.col("op")]
    rows = (changes.where(F.col("id").isNotNull() & F.col("commit_ts").isNotNull() & F.col("status").isNotNull())
            .withColumn("ts", F.col("commit_ts").cast("timestamp")).withWatermark("ts", delay)
            .select("id", "ts", F.unix_micros("ts").alias("us"), F.col("seq").cast("int").alias("seq"),
                    F.coalesce(rank, F.lit(1)).alias("rank"), "status",
                    F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket")))
    return rows.groupBy("bucket").applyInPandasWithState(step, FINDINGS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
