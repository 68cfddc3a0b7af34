"""Bronze -> Silver operators.

Every operator is a pure function of DataFrames.  Named Bronze frames (see
``sources.bronze.name_columns``) carry ``op`` (I/U/D), ``commit_ts`` and
optionally ``seq`` next to the entity's columns as text.

Parsing uses ``try_cast`` / ``from_json`` with explicit schemas: with ANSI
mode on, a bad value becomes NULL (and is counted by the quality checks)
instead of failing a 1000-executor job on one malformed row.

Skew: per-key "latest row" operators (B2, B13, B14, B29) use
``max(struct(order keys, payload))`` aggregates rather than a
``row_number`` window, so a key holding a third of all rows is reduced
map-side by partial aggregation instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import domains
from ..functions.joins import tenant_dim
from ..functions.json import CUSTOMER_METADATA, EVENT_DATA, ORDER_METADATA, TENANT_SETTINGS
from ..functions.money import pct
from ..functions.windows import neighbour

# Silver column types per entity; JSON documents are parsed separately.
SILVER_TYPES: dict[str, dict[str, str]] = {
    "tenant": {"id": "string", "name": "string", "slug": "string", "domain": "string",
               "is_active": "boolean", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"},
    "customer": {"id": "string", "tenant_id": "string", "first_name": "string",
                 "last_name": "string", "phone": "string", "is_active": "boolean",
                 "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"},
    "product": {"id": "string", "tenant_id": "string", "sku": "string", "name": "string",
                "description": "string", "category": "string", "price": "decimal(10,2)",
                "cost": "decimal(10,2)", "stock_quantity": "int", "is_active": "boolean",
                "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"},
    "order": {"id": "string", "tenant_id": "string", "customer_id": "string",
              "order_number": "string", "status": "string", "subtotal": "decimal(10,2)",
              "tax": "decimal(10,2)", "shipping": "decimal(10,2)", "total": "decimal(10,2)",
              "order_date": "timestamp_ntz", "completed_at": "timestamp_ntz",
              "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"},
    "orderitem": {"id": "string", "order_id": "string", "product_id": "string",
                  "quantity": "int", "unit_price": "decimal(10,2)", "discount": "decimal(10,2)",
                  "total": "decimal(10,2)", "created_at": "timestamp_ntz",
                  "updated_at": "timestamp_ntz"},
    "event": {"id": "string", "tenant_id": "string", "customer_id": "string",
              "event_type": "string", "session_id": "string", "ip_address": "string",
              "user_agent": "string", "created_at": "timestamp_ntz"},
    "subscription": {"id": "string", "tenant_id": "string", "customer_id": "string",
                     "plan_name": "string", "status": "string", "start_date": "date",
                     "end_date": "date", "monthly_amount": "decimal(10,2)",
                     "billing_cycle": "string", "created_at": "timestamp_ntz",
                     "updated_at": "timestamp_ntz"},
    "invoice": {"id": "string", "tenant_id": "string", "customer_id": "string",
                "subscription_id": "string", "invoice_number": "string",
                "amount": "decimal(10,2)", "status": "string", "issue_date": "date",
                "due_date": "date", "paid_date": "date", "created_at": "timestamp_ntz",
                "updated_at": "timestamp_ntz"},
}

def _op_rank() -> Column:
    return F.when(F.col("op") == "I", 0).when(F.col("op") == "U", 1).otherwise(2)


# ---------------------------------------------------------------- B1 / B2 / B29
def kept_by_insert_only() -> Column:
    """The row predicate of the insert-only Silver job (B1): op = 'I'."""
    return F.col("op") == "I"


def cdc_insert_only(changes: DataFrame) -> DataFrame:
    """B1: keep full-load / insert rows only (the reference's behaviour)."""
    return changes.where(kept_by_insert_only())


def cdc_fault(key: str = "id") -> Column:
    """Why a change row cannot be merged, or NULL if it can."""
    return (F.when(~F.coalesce(F.col("op").isin("I", "U", "D"), F.lit(False)), F.lit("unknown_op"))
            .when(F.col(key).isNull(), F.lit("no_key"))
            .when(F.col("commit_ts").isNull(), F.lit("no_commit_time")))


def cdc_quarantine(changes: DataFrame, key: str = "id") -> DataFrame:
    """The change rows that ``cdc_merge_latest`` leaves out, with ``fault``."""
    return changes.withColumn("fault", cdc_fault(key)).where(F.col("fault").isNotNull())


def cdc_merge_latest(changes: DataFrame, key: str = "id", as_of: str | None = None) -> DataFrame:
    """B2 (and B29 with ``as_of``): latest change per key wins; deleted keys drop out.

    Changes are ordered by (commit_ts, seq, op rank I<U<D).  A delete
    followed by a later insert revives the key.  One aggregate over
    ``max(struct(order, row))`` replaces a window: partial aggregation
    collapses a hot key on the map side.  Rows that cannot be ordered or keyed
    take no part; ``cdc_quarantine`` returns them.
    """
    changes = changes.where(cdc_fault(key).isNull())
    if as_of is not None:
        changes = changes.where(F.col("commit_ts") <= F.lit(as_of).cast("timestamp_ntz"))
    payload = [c for c in changes.columns if c not in (key,)]
    seq = F.col("seq") if "seq" in changes.columns else F.lit(0)   # source position, breaks ties of a commit
    ordered = F.struct(F.col("commit_ts").alias("_ts"), seq.alias("_seq"), _op_rank().alias("_rank"),
                       F.struct(*payload).alias("_row"))
    latest = changes.groupBy(key).agg(F.max(ordered).alias("_m"))
    return (latest.where(F.col("_m._row.op") != "D")
            .select(key, *[F.col(f"_m._row.{c}").alias(c) for c in payload]))


def snapshot_as_of(changes: DataFrame, as_of: str, key: str = "id") -> DataFrame:
    """Table state at time ``as_of`` (inclusive) from the change log."""
    return cdc_merge_latest(changes, key, as_of)


# ---------------------------------------------------------------- B3-B10
def _typed(named: DataFrame, entity: str) -> list[Column]:
    return [F.col(c).try_cast(t).alias(c) for c, t in SILVER_TYPES[entity].items()]


def to_silver(named: DataFrame, entity: str, mode: str = "insert_only") -> DataFrame:
    """Type one entity's named Bronze rows into its Silver schema.

    ``mode`` is ``insert_only`` (op = 'I', as the reference) or ``merge``
    (B2 latest-wins over I/U/D).
    """
    rows = cdc_insert_only(named) if mode == "insert_only" else cdc_merge_latest(named)
    cols = {c: e for c, e in zip(SILVER_TYPES[entity], _typed(rows, entity))}
    if entity == "tenant":
        s = F.from_json("settings", TENANT_SETTINGS)
        cols.update(plan_type=s["plan_type"].alias("plan_type"),
                    max_users=s["max_users"].alias("max_users"),
                    features=s["features"].alias("features"))
    elif entity == "customer":
        cols["email"] = F.trim(F.lower("email")).alias("email")
        cols["metadata"] = F.from_json("metadata", CUSTOMER_METADATA).alias("metadata")
    elif entity == "order":
        cols["metadata"] = F.from_json("metadata", ORDER_METADATA).alias("metadata")
    elif entity == "event":
        cols["event_data"] = F.from_json("event_data", EVENT_DATA).alias("event_data")
    return rows.select(*cols.values())


def silver_tenant(named: DataFrame) -> DataFrame:
    """Tenants with settings JSON parsed into plan_type / max_users / features."""
    return to_silver(named, "tenant")


def silver_customer(named: DataFrame) -> DataFrame:
    """Customers with normalised e-mail and parsed metadata."""
    return to_silver(named, "customer")


def silver_product(named: DataFrame) -> DataFrame:
    """B5"""
    return to_silver(named, "product")


def silver_order(named: DataFrame) -> DataFrame:
    """B6"""
    return to_silver(named, "order")


def silver_orderitem(named: DataFrame) -> DataFrame:
    """B7"""
    return to_silver(named, "orderitem")


def silver_event(named: DataFrame) -> DataFrame:
    """B8"""
    return to_silver(named, "event")


def silver_subscription(named: DataFrame) -> DataFrame:
    """B9"""
    return to_silver(named, "subscription")


def silver_invoice(named: DataFrame) -> DataFrame:
    """B10"""
    return to_silver(named, "invoice")


# ---------------------------------------------------------------- B12
def json_fragment_repair(parts: DataFrame, entity: str, json_col: str) -> DataFrame:
    """Rebuild a JSON column that a quote-unaware reader split on commas.

    ``parts`` holds each raw line split on every comma (``parts``,
    ``n_parts``).  With N expected fields and the document at position j,
    fragments j .. n_parts-(N-j) belong to the document and are re-joined
    with "," (the reference re-joined with "" and lost them, D13).  A line with
    too few fields keeps what it has, NULL elsewhere, and ``is_corrupt``.
    """
    from ..sources.bronze import LAYOUT
    names = ["op", "commit_ts"] + LAYOUT[entity]
    n_fields, j = len(names), names.index(json_col)
    extra = F.col("n_parts") - n_fields          # commas inside the document
    out = []
    for i, n in enumerate(names):
        if i < j:
            out.append(F.get("parts", F.lit(i)).alias(n))
        elif i == j:
            document = F.array_join(F.slice("parts", j + 1, F.greatest(extra + 1, F.lit(1))), ",")
            out.append(F.when(F.col("n_parts") > j, document).alias(n))
        else:
            at = F.when(extra >= 0, extra + i)
            out.append(F.get("parts", at.cast("int")).alias(n))
    return parts.select(*out, (extra < 0).alias("is_corrupt"))


# ---------------------------------------------------------------- B13-B17
def derive_customer_tenant(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Fill a missing / 'unknown' tenant from the customer's latest order.

    Latest = max (order_date, id).  Orders are reduced to one row per
    customer with a partial aggregate before the join.
    """
    latest = (orders.groupBy(F.col("customer_id").alias("id"))
              .agg(F.max(F.struct("order_date", F.col("id").alias("oid"), "tenant_id"))
                   .alias("_o")))
    missing = F.col("c.tenant_id").isNull() | F.col("c.tenant_id").isin("", "unknown")
    return (customers.alias("c").join(latest.alias("l"), "id", "left")
            .select("id",
                    F.when(missing, F.col("l._o.tenant_id")).otherwise(F.col("c.tenant_id"))
                    .alias("tenant_id"),
                    F.when(~missing, F.lit("customer"))
                    .when(F.col("l._o").isNotNull(), F.lit("latest_order"))
                    .alias("tenant_source")))


def customer_dedup(customers: DataFrame) -> DataFrame:
    """One row per (tenant_id, normalised e-mail): the latest updated, then highest id.

    Deterministic, and skew-safe (aggregate of a struct, no window).  Customers
    without an e-mail are no duplicates of each other: each stays.
    """
    cols = [c for c in customers.columns]
    norm = customers.withColumn("_email", F.trim(F.lower("email")))
    lone = F.when(F.col("_email").isNull(), F.col("id")).alias("_lone")
    best = (norm.groupBy("tenant_id", "_email", lone)
            .agg(F.max(F.struct("updated_at", F.col("id").alias("_id"),
                                F.struct(*cols).alias("_row"))).alias("_m"),
                 F.count(F.lit(1)).alias("duplicate_count")))
    return best.select(*[F.col(f"_m._row.{c}").alias(c) for c in cols if c != "email"],
                       F.col("_email").alias("email"), "duplicate_count")


def phone_standardize(phone: Column) -> Column:
    """Keep digits and '+' only (e.g. '+1 (555) 000-1234' -> '+15550001234')."""
    return F.regexp_replace(phone, r"[^0-9+]", "")


def customer_metadata_parse(customers: DataFrame) -> DataFrame:
    """Flatten the nested metadata document."""
    m = F.col("metadata")
    if dict(customers.dtypes)["metadata"] == "string":
        m = F.from_json("metadata", CUSTOMER_METADATA)
    return customers.select("id", m["age"].alias("age"), m["country"].alias("country"),
                            m["signup_source"].alias("signup_source"),
                            m["preferences"]["newsletter"].alias("newsletter"),
                            m["preferences"]["notifications"].alias("notifications"))


EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def customer_quality_flags(customers: DataFrame) -> DataFrame:
    """Per-row quality flags and the list of failed rules."""
    phone = phone_standardize(F.col("phone"))
    age = F.col("metadata.age")
    flags = {
        "email_valid": F.coalesce(F.col("email").rlike(EMAIL_PATTERN), F.lit(False)),
        "phone_valid": F.coalesce(F.length(phone).between(11, 16) & phone.startswith("+"), F.lit(False)),
        "tenant_present": F.col("tenant_id").isNotNull() & ~F.col("tenant_id").isin("", "unknown"),
        "age_valid": F.coalesce(age.between(13, 120), F.lit(False)),
        "source_valid": F.coalesce(F.col("metadata.signup_source").isin(*domains.SIGNUP_SOURCES),
                                   F.lit(False)),
    }
    failed = F.concat_ws(",", *[F.when(~v, F.lit(k.rsplit("_", 1)[0])) for k, v in flags.items()])
    return customers.select("id", "tenant_id", *[v.alias(k) for k, v in flags.items()],
                            failed.alias("failed_rules"))


# ---------------------------------------------------------------- B18-B21
def order_total_check(orders: DataFrame) -> DataFrame:
    """Orders whose total differs from subtotal + tax + shipping."""
    recomputed = F.col("subtotal") + F.col("tax") + F.col("shipping")
    return (orders.where(recomputed != F.col("total"))
            .select("id", "tenant_id", F.col("subtotal").cast("double").alias("subtotal"),
                    F.col("tax").cast("double").alias("tax"),
                    F.col("shipping").cast("double").alias("shipping"),
                    F.col("total").cast("double").alias("total"),
                    recomputed.cast("double").alias("recomputed_total"),
                    (F.col("total") - recomputed).cast("double").alias("difference")))


def order_totals_from_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Roll items up per order: line = price*qty - discount; tax 8 %; + shipping.

    Items are aggregated per order before joining the order's shipping.
    """
    line = F.col("unit_price") * F.col("quantity") - F.col("discount")
    per_order = (items.groupBy("order_id")
                 .agg(F.count("id").alias("item_count"), F.sum(line).alias("_sub")))
    o = orders.select(F.col("id").alias("order_id"), "shipping")
    tax = (F.col("_sub") * F.lit(domains.TAX_RATE).cast("decimal(3,2)")).cast("decimal(12,2)")
    return (per_order.join(o, "order_id")
            .select("order_id", "item_count", F.col("_sub").cast("double").alias("subtotal"),
                    tax.cast("double").alias("tax"),
                    F.col("shipping").cast("double").alias("shipping"),
                    (F.col("_sub") + tax + F.col("shipping")).cast("double").alias("total")))


def order_status_transitions(changes: DataFrame) -> DataFrame:
    """Consecutive status pairs per order from the change log, with validity.

    The previous status comes from ``functions.windows.neighbour``: rows are
    windowed per (order, day bucket) only, so an order with a very long
    history is spread over many tasks.
    """
    seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
    allowed = F.array(*[F.struct(F.lit(a).alias("f"), F.lit(b).alias("t"))
                        for a, b in domains.ORDER_TRANSITIONS])
    pair = F.struct(F.col("from_status").alias("f"), F.col("to_status").alias("t"))
    rows = changes.where(F.col("op") != "D").select("id", "commit_ts", "status", "op",
                                                    seq.alias("_seq"))
    with_prev = neighbour(rows, ["id"], "commit_ts", [F.col("_seq"), _op_rank()], ["status"],
                          "prev", prefix="from_")
    return (with_prev.where(F.col("from_status").isNotNull())
            .select("id", "commit_ts", "from_status", F.col("status").alias("to_status"))
            .withColumn("is_valid", (F.col("from_status") == F.col("to_status"))
                        | F.array_contains(allowed, pair)))


def order_enriched(orders: DataFrame, customers: DataFrame, tenants: DataFrame,
                   items: DataFrame) -> DataFrame:
    """Orders with customer, tenant and item/product counts.

    Tenants are broadcast after a size probe; customers and the per-order
    item counts are shuffle-joined on their keys (both grow with the data).
    """
    counts = (items.groupBy("order_id", "product_id").agg(F.count("id").alias("_n"))
              .groupBy("order_id")
              .agg(F.sum("_n").alias("item_count"), F.count("product_id").alias("product_count")))
    c = customers.select(F.col("id").alias("customer_id"), F.col("email").alias("customer_email"),
                         F.col("metadata.signup_source").alias("signup_source"))
    return (orders.select("id", "tenant_id", "customer_id", "status", "total", "order_date")
            .join(c, "customer_id", "left")
            .join(tenant_dim(tenants, "name", "plan_type"), "tenant_id", "left")
            .join(counts.withColumnRenamed("order_id", "id"), "id", "left")
            .select("id", "tenant_id", "tenant_name", "plan_type", "customer_id", "customer_email",
                    "signup_source", "status", F.col("total").cast("double").alias("total"),
                    "order_date", F.coalesce("item_count", F.lit(0)).alias("item_count"),
                    F.coalesce("product_count", F.lit(0)).alias("product_count")))


# ---------------------------------------------------------------- B22-B25
def event_data_parse(events: DataFrame) -> DataFrame:
    """event_data JSON -> typed fields."""
    d = F.col("event_data")
    if dict(events.dtypes)["event_data"] == "string":
        d = F.from_json("event_data", EVENT_DATA)
    return events.select("id", "event_type", d["url"].alias("url"),
                         d["product_id"].alias("product_id"),
                         d["search_term"].alias("search_term"), d["k"].alias("k"))


SESSION_GAP_SECONDS = 30 * 60
SESSION_BUCKET_SECONDS = 3600


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def event_sessionize(events: DataFrame, actor: str = "customer_id",
                     gap_seconds: int = SESSION_GAP_SECONDS,
                     bucket_seconds: int = SESSION_BUCKET_SECONDS) -> DataFrame:
    """Gap-based sessions per actor (new session when the gap >= ``gap_seconds``).

    Skew-safe and exact.  Events are windowed only inside (actor, hour
    bucket), so one very active actor is spread over many tasks, and reduced
    there to local sessions (start, end, count).  A window per actor then
    stitches local sessions that continue across a bucket edge; it sees
    sessions, not events.  Events without a time form one session of their
    actor, numbered first, with NULL start and end.

    Returns one row per session: actor, session_no, session_start,
    session_end, event_count.
    """
    gap = gap_seconds * 1_000_000
    ev = (events.where(F.col(actor).isNotNull())
          .select(F.col(actor).alias("actor"), F.col("id").alias("eid"), "created_at",
                  _micros(F.col("created_at")).alias("_us"))
          .withColumn("bucket", F.floor(F.col("_us") / (bucket_seconds * 1_000_000)).cast("bigint")))
    wb = Window.partitionBy("actor", "bucket").orderBy("_us", "eid")
    starts = F.coalesce(F.col("_us") - F.lag("_us").over(wb) >= gap, F.lit(False))
    local = (ev.withColumn("_start", starts.cast("int"))
             .withColumn("_no", F.sum("_start").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("actor", "bucket", "_no")
             .agg(F.min("created_at").alias("_from"), F.max("created_at").alias("_to"),
                  F.count(F.lit(1)).alias("_n")))
    wa = Window.partitionBy("actor").orderBy("_from")
    begins = F.coalesce(_micros(F.col("_from")) - _micros(F.lag("_to").over(wa)) >= gap, F.lit(True))
    numbered = (local.withColumn("_new", begins.cast("bigint"))
                .withColumn("session_no", F.sum("_new").over(wa.rowsBetween(Window.unboundedPreceding, 0))))
    return (numbered.groupBy("actor", "session_no")
            .agg(F.min("_from").alias("session_start"), F.max("_to").alias("session_end"),
                 F.sum("_n").alias("event_count"))
            .withColumnRenamed("actor", actor))


def session_metrics(events: DataFrame) -> DataFrame:
    """Per tenant and session id: start, end, duration, events, bounce, converted."""
    return (events.groupBy("tenant_id", "session_id")
            .agg(F.min("created_at").alias("session_start"),
                 F.max("created_at").alias("session_end"),
                 F.count(F.lit(1)).alias("event_count"),
                 F.max(F.col("event_type") == "purchase").alias("converted"))
            .select("tenant_id", "session_id", "session_start", "session_end",
                    (F.timestamp_diff("MICROSECOND", F.col("session_start"), F.col("session_end"))
                     / 1_000_000).alias("duration_seconds"),
                    "event_count", (F.col("event_count") == 1).alias("is_bounce"), "converted"))


def ip_anonymize(ip: Column) -> Column:
    """Zero the last IPv4 octet."""
    return F.regexp_replace(ip, r"\.[0-9]+$", ".0")


# ---------------------------------------------------------------- B26-B30
def scd2_history(changes: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Validity ranges of each version (valid_to = next change's time).

    The next change per key comes from ``functions.windows.neighbour``
    (bucketed, skew-safe) rather than a ``lead`` over the whole key.
    """
    seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
    rows = changes.where(F.col("op") != "D").select(key, *tracked, "commit_ts", "op", seq.alias("_seq"))
    nxt = neighbour(rows, [key], "commit_ts", [F.col("_seq"), _op_rank()], ["commit_ts"],
                    "next", prefix="next_")
    return (nxt.select(key, *tracked, F.col("commit_ts").alias("valid_from"),
                       F.col("next_commit_ts").alias("valid_to"))
            .withColumn("is_current", F.col("valid_to").isNull()))


def invoice_reconciliation(invoices: DataFrame, as_of: str) -> DataFrame:
    """Per subscription: invoiced, paid, outstanding amounts and lateness.

    Billable = sent / paid / overdue.  Days late of an invoice =
    max(0, (paid_date or as_of) - due_date).
    """
    billable = F.col("status").isin("sent", "paid", "overdue")
    paid = F.col("status") == "paid"
    late = F.greatest(F.lit(0), F.datediff(F.coalesce("paid_date", F.lit(as_of).cast("date")),
                                           F.col("due_date")))
    return (invoices.groupBy("subscription_id")
            .agg(F.count("id").alias("invoice_count"),
                 F.sum(F.when(billable, F.col("amount"))).alias("_inv"),
                 F.sum(F.when(paid, F.col("amount"))).alias("_paid"),
                 F.count_if(F.col("status") == "overdue").alias("overdue_count"),
                 F.max(F.when(billable, late)).alias("max_days_late"))
            .select("subscription_id", "invoice_count",
                    F.coalesce(F.col("_inv"), F.lit(0)).cast("double").alias("invoiced_amount"),
                    F.coalesce(F.col("_paid"), F.lit(0)).cast("double").alias("paid_amount"),
                    (F.coalesce(F.col("_inv"), F.lit(0)) - F.coalesce(F.col("_paid"), F.lit(0)))
                    .cast("double").alias("outstanding_amount"),
                    "overdue_count", "max_days_late"))


def product_enrich_validate(products: DataFrame) -> DataFrame:
    """Category clean-up, margin, and the model's bounds as a validity flag."""
    valid = ((F.col("price") >= F.lit(domains.PRODUCT_MIN_PRICE).cast("decimal(10,2)"))
             & (F.col("cost") >= 0) & (F.col("stock_quantity") >= 0))
    margin = F.col("price") - F.col("cost")
    return products.select("id", "tenant_id",
                           F.initcap(F.trim(F.lower("category"))).alias("category"),
                           margin.cast("double").alias("margin"),
                           pct(margin, F.col("price")).alias("margin_pct"),
                           F.coalesce(valid, F.lit(False)).alias("is_valid"))


def invoice_schedule(subscriptions: DataFrame, as_of: str | None = None,
                     max_invoices: int | None = None) -> DataFrame:
    """One row per invoice a subscription generates.

    Invoices start at ``start_date`` and repeat every 30 days while the
    issue date is on or before the end date (``as_of`` for open-ended
    subscriptions), all of them unless ``max_invoices`` says otherwise (the
    application's seeder stops at 12).  A ``sequence`` + ``explode`` per row: no
    join, no shuffle.
    """
    period = domains.INVOICE_PERIOD_DAYS
    end = F.col("end_date")
    if as_of is not None:
        end = F.coalesce(end, F.lit(as_of).cast("date"))
    last_k = F.floor(F.datediff(end, F.col("start_date")) / period).cast("int")
    if max_invoices is not None:
        last_k = F.least(F.lit(max_invoices - 1), last_k)
    return (subscriptions
            .select(F.col("id").alias("subscription_id"), "customer_id", "tenant_id",
                    F.col("status").alias("sub_status"), "start_date",
                    F.col("monthly_amount").alias("amount"),
                    F.explode(F.when(last_k >= 0, F.sequence(F.lit(0), last_k))).alias("k"))
            .withColumn("issue_date", F.date_add("start_date", F.col("k") * period))
            .withColumn("due_date", F.date_add("issue_date", period)))
