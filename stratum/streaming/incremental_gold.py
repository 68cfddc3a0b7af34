"""Gold tables kept up to date from order changes alone (G2, B2 -> C1, C6).

A refresh reads one batch of changes, never the log before it and never whole
Silver.  It looks up the stored image of the orders in the batch, and turns every
change into signed rows: the image before counts -1, the one after +1.  What the Gold
tables need follows from sums of signed rows:

* counts and money are sums;
* a distinct count is a counted multiset: a customer enters a tenant's month
  when their count there leaves zero, and goes when it returns to zero;
* first and last order date can be taken back: the dates of a customer
  are a counted multiset too, and the least and greatest with a count above zero are looked up
  for the customers touched.

The stored tables are runs of a ``RunStore``: a refresh writes its own rows, and
one manifest commits all tables.  Changes may come late, twice or out of order: an order's
image is replaced only by a later change (commit time, position, operation), and
deleted orders stay as tombstones so that older updates cannot revive them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_of
from ..functions.joins import tenant_dim
from ..operators.gold import _avg_from
from ..operators.silver import _op_rank, cdc_fault
from .runs import Keyed, RunStore
from .sinks import latest_per_key, run_available_now

MONEY = "decimal(28,2)"
ORDER = ["commit_ts", "seq", "rank"]
IMAGE = [*ORDER, "op", "tenant_id", "customer_id", "order_date", "status", "total"]
BUYER, MONTH, CUSTOMER = ["tenant_id", "month", "customer_id"], ["tenant_id", "month"], ["tenant_id", "customer_id"]
SUMS = ["n", "total", "n_total"]


def _summed(keys: list[str], sums: list[str]):
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    return merge


def _nonzero(sums: list[str]):
    def settle(rows: DataFrame) -> DataFrame:
        some = F.lit(False)
        for c in sums:
            some = some | (F.col(c) != 0)
        return rows.where(some)
    return settle


def _signed_table(columns: str, keys: list[str], sums: list[str]) -> Keyed:
    return Keyed(columns, _summed(keys, sums), _nonzero(sums))


TABLES = {
    # The latest image of every order, tombstones included.
    "images": Keyed("id string, commit_ts timestamp_ntz, seq int, rank int, op string, tenant_id string, customer_id string, "
                    f"order_date timestamp_ntz, status string, total {MONEY}",
                    lambda rows: latest_per_key(rows, ["id"], [F.col(c) for c in ORDER])),
    "buyers": _signed_table(f"tenant_id string, month date, customer_id string, n long, total {MONEY}, n_total long", BUYER, SUMS),
    "revenue": _signed_table(f"tenant_id string, month date, n long, total {MONEY}, n_total long, customers long",
                             MONTH, [*SUMS, "customers"]),
    "ltv": _signed_table(f"tenant_id string, customer_id string, n long, total {MONEY}, n_total long", CUSTOMER, SUMS),
    "days": _signed_table("tenant_id string, customer_id string, order_date timestamp_ntz, n long",
                          [*CUSTOMER, "order_date"], ["n"]),
    "spans": Keyed("tenant_id string, customer_id string, version long, first_order_date timestamp_ntz, "
                   "last_order_date timestamp_ntz",
                   lambda rows: latest_per_key(rows, CUSTOMER, [F.col("version")]),
                   lambda rows: rows.where(F.col("first_order_date").isNotNull())),
}


# A sum over no amounts is NULL, as in the full computation.
_MONEY_SUM = "CASE WHEN n_total > 0 THEN cast(total AS double) END"


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[f"_{k}"])
    return on


class IncrementalGold:
    """The Gold tables of completed orders under ``root``."""

    def __init__(self, spark: SparkSession, root: str, fanout: int = 4, retain: int = 2):
        self.store = RunStore(spark, root, TABLES, fanout, retain)

    # ------------------------------------------------------------ refresh
    def _changed(self, changes: DataFrame) -> DataFrame:
        """(id, before, after) of the orders that this batch really changes."""
        seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
        rows = changes.where(cdc_fault().isNull()).withColumns(
            {"seq": seq.cast("int"), "rank": _op_rank(), "total": F.col("total").cast(MONEY)}).select("id", *IMAGE)
        new = latest_per_key(rows, ["id"], [F.col(c) for c in ORDER]).select("id", F.struct(*IMAGE).alias("after"))
        old = self.store.lookup("images", new.select("id")).select(F.col("id").alias("_id"), F.struct(*IMAGE).alias("before"))
        order = {s: F.struct(*[F.col(f"{s}.{c}") for c in ORDER]) for s in ("before", "after")}
        return (new.join(old, new["id"] == old["_id"], "left")
                .where(F.col("before").isNull() | (order["after"] > order["before"])).select("id", "before", "after"))

    @staticmethod
    def _signed(changed: DataFrame) -> DataFrame:
        """Completed orders before (-1) and after (+1) the batch."""
        sides = F.explode(F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("o")),
                                  F.struct(F.lit(1).alias("sign"), F.col("after").alias("o")))).alias("s")
        return (changed.select(sides).select("s.sign", "s.o.*")
                .where((F.col("op") != "D") & (F.col("status") == "completed"))
                .withColumn("month", month_of("order_date")))

    def refresh(self, changes: DataFrame, version: int) -> bool:
        """Apply a batch of order changes as ``version``; False if it was applied before."""
        store, last = self.store, self.store.last()
        if last is not None and version <= last:
            return False
        changed = store.scratch("changed", version, self._changed(changes))
        store.write("images", version, changed.select("id", "after.*"))
        signed = self._signed(changed)
        buyers = store.write("buyers", version, _nonzero(SUMS)(signed.groupBy(*BUYER).agg(
            F.sum("sign").alias("n"), F.coalesce(F.sum(F.col("sign") * F.col("total")), F.lit(0)).alias("total"),
            F.sum(F.when(F.col("total").isNotNull(), F.col("sign")).otherwise(0)).alias("n_total"))))

        # Customers that enter or leave a month: their count there before and after.
        had = store.lookup("buyers", buyers.select(*BUYER)).select(*[F.col(k).alias(f"_{k}") for k in BUYER],
                                                                  F.col("n").alias("_n"))
        before = F.coalesce("_n", F.lit(0))
        moved = buyers.join(had, _same(buyers, had, BUYER), "left").withColumn(
            "customers", F.when(F.col("customer_id").isNotNull(),
                                (before + F.col("n") > 0).cast("int") - (before > 0).cast("int")).otherwise(0))
        store.write("revenue", version, _nonzero([*SUMS, "customers"])(_summed(MONTH, [*SUMS, "customers"])(moved)))
        store.write("ltv", version, _nonzero(SUMS)(_summed(CUSTOMER, SUMS)(buyers)))

        # First and last dates of the customers whose dates changed.
        days = store.write("days", version, _nonzero(["n"])(
            signed.groupBy(*CUSTOMER, "order_date").agg(F.sum("sign").alias("n"))))
        touched = days.select(*CUSTOMER).distinct()
        dates = _summed([*CUSTOMER, "order_date"], ["n"])(store.lookup("days", touched).unionByName(days))
        held = F.when(F.col("n") > 0, F.col("order_date"))
        store.write("spans", version, dates.groupBy(*CUSTOMER).agg(
            F.min(held).alias("first_order_date"), F.max(held).alias("last_order_date"))
            .withColumn("version", F.lit(version).cast("long")))
        store.commit(version, list(TABLES))
        return True

    # ------------------------------------------------------------ Gold
    def revenue_by_tenant_monthly(self, tenants: DataFrame, version: int | None = None) -> DataFrame:
        """C1 as of a version."""
        return (self.store.read("revenue", version).where(F.col("n") > 0)
                .join(tenant_dim(tenants, "name"), "tenant_id")
                .select("tenant_id", "tenant_name", "month", F.col("n").alias("order_count"),
                        F.expr(_MONEY_SUM).alias("total_revenue"), _avg_from("total", "n_total").alias("avg_order_value"),
                        F.col("customers").alias("unique_customers")))

    def customer_ltv(self, customers: DataFrame, tenants: DataFrame, version: int | None = None) -> DataFrame:
        """C6 as of a version."""
        ltv, spans = self.store.read("ltv", version).where(F.col("n") > 0), self.store.read("spans", version).drop("version")
        c = customers.select(F.col("id").alias("customer_id"), "tenant_id", "email")
        return (ltv.join(spans, CUSTOMER, "left").join(c, CUSTOMER).join(tenant_dim(tenants, "name"), "tenant_id")
                .select("tenant_id", "tenant_name", "customer_id", "email", F.col("n").alias("total_orders"),
                        F.expr(_MONEY_SUM).alias("lifetime_value"), _avg_from("total", "n_total").alias("avg_order_value"),
                        "first_order_date", "last_order_date",
                        F.datediff(F.to_date("last_order_date"), F.to_date("first_order_date")).alias("customer_age_days")))


def run_incremental_gold(changes: DataFrame, root: str, checkpoint: str, retain: int = 2) -> None:
    """Refresh from a change stream: a micro-batch is a version."""
    gold = IncrementalGold(changes.sparkSession, root, retain=retain)
    run_available_now(changes.writeStream.outputMode("append").foreachBatch(gold.refresh), checkpoint)
