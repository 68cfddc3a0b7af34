"""Data-quality checks.

Each check is one aggregation pass per table (``count_if`` columns), not
one Spark action per rule as in the reference, and returns a small
report DataFrame.  Cross-table checks (E4) are anti-joins; uniqueness
(E5) is a grouped count of rows dealt by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import domains
from ..functions.money import ratio


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def dq_tenant_report(tenants: DataFrame) -> DataFrame:
    """Null ids, null names, inactive tenants, total - one pass."""
    return tenants.agg(F.count_if(F.col("id").isNull()).alias("null_ids"),
                       F.count_if(F.col("name").isNull()).alias("null_names"),
                       F.count_if(F.col("is_active") == F.lit(False)).alias("inactive_tenants"),
                       F.count(F.lit(1)).alias("total_records"))


def dq_customer_report(customers: DataFrame) -> DataFrame:
    """Null e-mails and missing tenants (NULL, '' or 'unknown')."""
    missing = F.col("tenant_id").isNull() | F.col("tenant_id").isin("", "unknown")
    return customers.agg(F.count_if(F.col("email").isNull()).alias("null_emails"),
                         F.count_if(missing).alias("missing_tenant_ids"),
                         F.count(F.lit(1)).alias("total_records"))


def layer_row_reconcile(bronze: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """Rows of each Bronze frame vs rows of its Silver table, per entity.

    Both sides are counted, so a Silver job that loses rows shows.  The counts
    meet as one-row aggregates.
    """
    def counted(frames: dict[str, DataFrame], column: str) -> DataFrame:
        return _union([f.agg(F.count(F.lit(1)).alias(column)).select(F.lit(e).alias("entity"), column)
                       for e, f in frames.items()])

    return (counted(bronze, "bronze_rows").join(counted(silver, "silver_rows"), "entity")
            .withColumn("dropped_rows", F.col("bronze_rows") - F.col("silver_rows")))


# (child entity, FK column, parent entity) - the model's foreign keys.
FOREIGN_KEYS = [
    ("customer", "tenant_id", "tenant"), ("product", "tenant_id", "tenant"),
    ("order", "tenant_id", "tenant"), ("order", "customer_id", "customer"),
    ("orderitem", "order_id", "order"), ("orderitem", "product_id", "product"),
    ("event", "tenant_id", "tenant"), ("event", "customer_id", "customer"),
    ("subscription", "tenant_id", "tenant"), ("subscription", "customer_id", "customer"),
    ("invoice", "tenant_id", "tenant"), ("invoice", "customer_id", "customer"),
    ("invoice", "subscription_id", "subscription"),
]


def dq_referential(t: dict[str, DataFrame]) -> DataFrame:
    """Orphan foreign keys per relation (non-NULL FK with no parent row).

    Each child is read once and explodes its keys to (relation, key); keys are
    counted per relation (partial aggregation: a hot key collapses to one row
    per map task), and one join against the ids of all parents finds orphans.
    """
    def name(child: str, fk: str, parent: str) -> str:
        return f"{child}.{fk} -> {parent}.id"

    def keys_of(child: str) -> DataFrame:
        own = [(c, fk, p) for c, fk, p in FOREIGN_KEYS if c == child]
        refs = F.array(*[F.struct(F.lit(name(*r)).alias("relation"), F.lit(r[2]).alias("parent"),
                                  F.col(r[1]).alias("key")) for r in own])
        return t[child].select(F.explode(refs).alias("r")).select("r.*")

    used = _union([keys_of(c) for c in dict.fromkeys(r[0] for r in FOREIGN_KEYS)]) \
        .groupBy("relation", "parent", "key").agg(F.count(F.lit(1)).alias("_n"))
    ids = _union([t[p].select(F.lit(p).alias("parent"), F.col("id").alias("key"))
                  for p in dict.fromkeys(r[2] for r in FOREIGN_KEYS)]).distinct()
    found = used.join(ids.withColumn("_known", F.lit(True)), ["parent", "key"], "left")
    lost = found.groupBy("relation").agg(F.sum(F.when(
        F.col("key").isNotNull() & F.col("_known").isNull(), F.col("_n")).otherwise(0)).alias("_lost"))
    relations = F.array(*[F.lit(name(*r)) for r in FOREIGN_KEYS])
    every = used.sparkSession.range(1).select(F.explode(relations).alias("relation"))
    return every.join(lost, "relation", "left").select(
        "relation", F.coalesce("_lost", F.lit(0)).alias("orphan_rows"))


# Declared unique keys of the model.
UNIQUE_KEYS = [("tenant", ["name"]), ("tenant", ["slug"]), ("customer", ["tenant_id", "email"]),
               ("product", ["tenant_id", "sku"]), ("order", ["order_number"]),
               ("invoice", ["invoice_number"])]


SPREAD = 8      # tasks that may hold rows of one key


def dq_uniqueness(t: dict[str, DataFrame]) -> DataFrame:
    """E5: keys occurring more than once and the rows they cover, per unique key.

    Nearly every key is unique, so counting where the rows are read would hold all
    keys of a file split in one task.  Rows are dealt by key first, a hot key to
    ``SPREAD`` tasks; each counts its own share before the counts meet.
    """
    parts = []
    for entity, cols in UNIQUE_KEYS:
        share = F.pmod(F.xxhash64("id"), F.lit(SPREAD)).cast("tinyint")
        dealt = t[entity].select(*cols, share.alias("_share")).repartition(*cols, "_share")
        dup = (dealt.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
               .agg(F.count(F.lit(1)).alias("duplicate_keys"),
                    F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows")))
        parts.append(dup.select(F.lit(f"{entity}({', '.join(cols)})").alias("unique_key"),
                                "duplicate_keys", "duplicate_rows"))
    return _union(parts)


def domain_rules() -> dict[str, list[tuple[str, Column]]]:
    """Per entity: (rule name, condition a valid row satisfies)."""
    def in_set(c, values):
        return F.coalesce(F.col(c).isin(*values), F.lit(False))

    def ge(c, v):
        return F.coalesce(F.col(c) >= F.lit(v), F.lit(False))
    return {
        "order": [("status_in_domain", in_set("status", domains.ORDER_STATUSES)),
                  ("subtotal_non_negative", ge("subtotal", 0)), ("tax_non_negative", ge("tax", 0)),
                  ("shipping_non_negative", ge("shipping", 0)), ("total_non_negative", ge("total", 0))],
        "orderitem": [("quantity_at_least_1", ge("quantity", 1))],
        "product": [("price_at_least_0_01", ge("price", F.lit(domains.PRODUCT_MIN_PRICE).cast("decimal(10,2)"))),
                    ("cost_non_negative", ge("cost", 0)), ("stock_non_negative", ge("stock_quantity", 0))],
        "event": [("event_type_in_domain", in_set("event_type", domains.EVENT_TYPES))],
        "subscription": [("status_in_domain", in_set("status", domains.SUBSCRIPTION_STATUSES)),
                         ("billing_cycle_in_domain", in_set("billing_cycle", domains.BILLING_CYCLES))],
        "invoice": [("status_in_domain", in_set("status", domains.INVOICE_STATUSES))],
    }


def dq_domain(t: dict[str, DataFrame]) -> DataFrame:
    """Rows violating each domain rule (one pass per table)."""
    parts = []
    for entity, rules in domain_rules().items():
        agg = t[entity].agg(F.count(F.lit(1)).alias("_n"),
                            *[F.count_if(~cond).alias(f"_v{i}") for i, (_, cond) in enumerate(rules)])
        stacked = ", ".join(f"'{name}', _v{i}" for i, (name, _) in enumerate(rules))
        parts.append(agg.selectExpr(f"'{entity}' AS entity", "_n AS checked_rows",
                                    f"stack({len(rules)}, {stacked}) AS (rule, violations)"))
    return _union(parts).select("entity", "rule", "checked_rows", "violations")


FRESHNESS_COLUMN = {"tenant": "updated_at", "customer": "updated_at", "product": "updated_at",
                    "order": "updated_at", "orderitem": "updated_at", "event": "created_at",
                    "subscription": "updated_at", "invoice": "updated_at"}


def dq_freshness(t: dict[str, DataFrame], as_of: str) -> DataFrame:
    """Latest change time per entity and its lag in days at ``as_of``."""
    parts = []
    for entity, c in FRESHNESS_COLUMN.items():
        parts.append(t[entity].agg(F.max(c).alias("latest_ts"))
                     .select(F.lit(entity).alias("entity"), "latest_ts",
                             F.datediff(F.lit(as_of).cast("date"), F.to_date("latest_ts"))
                             .alias("lag_days")))
    return _union(parts)


def dq_valid_ratio(t: dict[str, DataFrame], target: float = 0.99) -> DataFrame:
    """Share of rows passing every domain rule (and having an id) per entity."""
    parts = []
    for entity, rules in domain_rules().items():
        ok = reduce(lambda a, b: a & b, [cond for _, cond in rules], F.col("id").isNotNull())
        parts.append(t[entity].agg(F.count(F.lit(1)).alias("total_rows"),
                                   F.count_if(ok).alias("valid_rows"))
                     .select(F.lit(entity).alias("entity"), "total_rows", "valid_rows"))
    out = _union(parts).withColumn("valid_ratio", ratio(F.col("valid_rows"), F.col("total_rows")))
    return out.withColumn("meets_target", F.col("valid_ratio") > F.lit(target))
