"""Bronze -> Silver operators over Bronze rows derived from the driver tables.

Silver queries run the full path: shop source rows -> positional Bronze
text (``to_bronze``) -> named columns (A3) -> typed Silver.  Struct and
array outputs are flattened so the oracle can compare scalars.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import silver
from ..sources import bronze
from .oracle import with_fixtures
from .registry import register

AS_OF_DATE = "1999-12-31"
SNAPSHOT_AT = "1998-06-30 00:00:00"


def named_bronze(shop, entity: str):
    """Named Bronze frame of an entity: the order change log, else a full load."""
    if entity == "order":
        changes = shop.order_changes().drop("seq")
    else:
        changes = bronze.inserts_of(shop.source(entity))
    return bronze.name_columns(bronze.to_bronze(changes, entity), entity)


# ---------------------------------------------------------------- B1 / B2 / B29
register("cdc_insert_only", "B1", with_fixtures("""
SELECT id, status, commit_ts FROM t_order_log WHERE op = 'I'"""))(
    lambda s: silver.cdc_insert_only(named_bronze(s, "order")).select("id", "status", "commit_ts"))

_MERGED = """
SELECT id, status, cast(total AS double) AS total, order_date FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_ts DESC, seq DESC) AS rn
  FROM t_order_log {where}) WHERE rn = 1 AND op <> 'D'"""

register("cdc_merge_latest", "B2", with_fixtures(_MERGED.format(where="")))(
    lambda s: silver.to_silver(named_bronze(s, "order"), "order", mode="merge")
    .select("id", "status", F.col("total").cast("double").alias("total"), "order_date"))

register("snapshot_as_of", "B29", with_fixtures(
    _MERGED.format(where=f"WHERE commit_ts <= timestamp '{SNAPSHOT_AT}'")))(
    lambda s: silver.snapshot_as_of(s.order_changes(), SNAPSHOT_AT)
    .select("id", "status", F.col("total").cast("double").alias("total"), "order_date"))

# ---------------------------------------------------------------- B3-B10
register("silver_tenant", "B3", with_fixtures("""
SELECT id, name, slug, domain, is_active, plan_type, max_users,
       array_to_string(features, ',') AS features, created_at
FROM t_tenant"""))(
    lambda s: silver.silver_tenant(named_bronze(s, "tenant"))
    .select("id", "name", "slug", "domain", "is_active", "plan_type", "max_users",
            F.array_join("features", ",").alias("features"), "created_at"))

register("silver_customer", "B4", with_fixtures("""
SELECT id, tenant_id, email, phone, is_active, age, country, signup_source, newsletter,
       notifications, created_at
FROM t_customer"""))(
    lambda s: silver.silver_customer(named_bronze(s, "customer"))
    .select("id", "tenant_id", "email", "phone", "is_active", "metadata.age", "metadata.country",
            "metadata.signup_source", "metadata.preferences.newsletter",
            "metadata.preferences.notifications", "created_at"))

register("silver_product", "B5", with_fixtures("""
SELECT id, tenant_id, sku, name, category, cast(price AS double) AS price,
       cast(cost AS double) AS cost, stock_quantity, is_active
FROM t_product"""))(
    lambda s: silver.silver_product(named_bronze(s, "product"))
    .select("id", "tenant_id", "sku", "name", "category", F.col("price").cast("double").alias("price"),
            F.col("cost").cast("double").alias("cost"), "stock_quantity", "is_active"))

register("silver_order", "B6", with_fixtures("""
SELECT id, tenant_id, customer_id, order_number, status, cast(subtotal AS double) AS subtotal,
       cast(tax AS double) AS tax, cast(shipping AS double) AS shipping,
       cast(total AS double) AS total, order_date
FROM t_order"""))(
    lambda s: silver.silver_order(named_bronze(s, "order"))
    .select("id", "tenant_id", "customer_id", "order_number", "status",
            *[F.col(c).cast("double").alias(c) for c in ("subtotal", "tax", "shipping", "total")],
            "order_date"))

register("silver_orderitem", "B7", with_fixtures("""
SELECT id, order_id, product_id, quantity, cast(unit_price AS double) AS unit_price,
       cast(discount AS double) AS discount, cast(total AS double) AS total
FROM t_item"""))(
    lambda s: silver.silver_orderitem(named_bronze(s, "orderitem"))
    .select("id", "order_id", "product_id", "quantity",
            *[F.col(c).cast("double").alias(c) for c in ("unit_price", "discount", "total")]))

register("silver_event", "B8", with_fixtures("""
SELECT id, tenant_id, customer_id, event_type, session_id, ip_address, created_at,
       cast(json_extract_string(event_data, '$.k') AS integer) AS k
FROM t_event"""))(
    lambda s: silver.silver_event(named_bronze(s, "event"))
    .select("id", "tenant_id", "customer_id", "event_type", "session_id", "ip_address",
            "created_at", F.col("event_data.k").alias("k")))

register("silver_subscription", "B9", with_fixtures("""
SELECT id, tenant_id, customer_id, plan_name, status, start_date, end_date,
       cast(monthly_amount AS double) AS monthly_amount, billing_cycle
FROM t_sub"""))(
    lambda s: silver.silver_subscription(named_bronze(s, "subscription"))
    .select("id", "tenant_id", "customer_id", "plan_name", "status", "start_date", "end_date",
            F.col("monthly_amount").cast("double").alias("monthly_amount"), "billing_cycle"))

register("silver_invoice", "B10", with_fixtures("""
SELECT id, tenant_id, customer_id, subscription_id, invoice_number, cast(amount AS double) AS amount,
       status, issue_date, due_date, paid_date
FROM t_invoice"""))(
    lambda s: silver.silver_invoice(named_bronze(s, "invoice"))
    .select("id", "tenant_id", "customer_id", "subscription_id", "invoice_number",
            F.col("amount").cast("double").alias("amount"), "status", "issue_date", "due_date",
            "paid_date"))


# ---------------------------------------------------------------- B12-B17
def _repaired_customers(s):
    lines = bronze.lines_unquoted(bronze.to_bronze(bronze.inserts_of(s.customer_source), "customer"))
    fixed = silver.json_fragment_repair(bronze.naive_split(lines, "customer"), "customer", "metadata")
    return silver.customer_metadata_parse(fixed)


register("json_fragment_repair", "B12", with_fixtures("""
SELECT id, age, country, signup_source, newsletter, notifications FROM t_customer"""))(
    _repaired_customers)

register("derive_customer_tenant", "B13", with_fixtures("""
SELECT c.id, CASE WHEN cast(c.id AS bigint) % 2 = 0 THEN c.tenant_id ELSE l.tenant_id END AS tenant_id,
       CASE WHEN cast(c.id AS bigint) % 2 = 0 THEN 'customer'
            WHEN l.customer_id IS NOT NULL THEN 'latest_order' END AS tenant_source
FROM t_customer c LEFT JOIN (
  SELECT customer_id, tenant_id FROM (
    SELECT customer_id, tenant_id,
           row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, id DESC) AS rn
    FROM t_order) WHERE rn = 1) l ON l.customer_id = c.id"""))(
    # Every other customer as the reference's Silver job writes it: tenant 'unknown' (defect D3).
    lambda s: silver.derive_customer_tenant(
        s.customer.withColumn("tenant_id", F.when(F.col("id").cast("bigint") % 2 == 0, F.col("tenant_id"))
                              .otherwise("unknown")), s.order))

register("customer_dedup", "B14", with_fixtures("""
SELECT id, tenant_id, trim(lower(email)) AS email, first_name, duplicate_count FROM (
  SELECT c.*, count(*) OVER (PARTITION BY tenant_id, trim(lower(email))) AS duplicate_count,
         row_number() OVER (PARTITION BY tenant_id, trim(lower(email))
                            ORDER BY updated_at DESC, id DESC) AS rn
  FROM (SELECT id, tenant_id, email, 'Customer' AS first_name,
               created_at + to_days(1) AS updated_at FROM t_customer
        UNION ALL
        SELECT id, tenant_id, upper(email), 'Customer (resent)',
               created_at + to_days(2) FROM t_customer WHERE cast(id AS bigint) % 7 = 0) c)
WHERE rn = 1"""))(
    lambda s: silver.customer_dedup(s.customer_redelivered())
    .select("id", "tenant_id", "email", "first_name", "duplicate_count"))

register("phone_standardize", "B15", with_fixtures("""
SELECT id, phone AS phone_raw, regexp_replace(phone, '[^0-9+]', '', 'g') AS phone FROM t_customer"""))(
    lambda s: s.customer.select("id", F.col("phone").alias("phone_raw"),
                                silver.phone_standardize(F.col("phone")).alias("phone")))

register("customer_metadata_parse", "B16", with_fixtures("""
SELECT id, age, country, signup_source, newsletter, notifications FROM t_customer"""))(
    lambda s: silver.customer_metadata_parse(s.customer_source))

register("customer_quality_flags", "B17", with_fixtures(f"""
SELECT id, tenant_id, email_valid, phone_valid, tenant_present, age_valid, source_valid,
       concat_ws(',', CASE WHEN NOT email_valid THEN 'email' END, CASE WHEN NOT phone_valid THEN 'phone' END,
                 CASE WHEN NOT tenant_present THEN 'tenant' END, CASE WHEN NOT age_valid THEN 'age' END,
                 CASE WHEN NOT source_valid THEN 'source' END) AS failed_rules
FROM (SELECT id, tenant_id,
             coalesce(regexp_matches(email, '{silver.EMAIL_PATTERN}'), false) AS email_valid,
             coalesce(length(regexp_replace(phone, '[^0-9+]', '', 'g')) BETWEEN 11 AND 16
                      AND starts_with(regexp_replace(phone, '[^0-9+]', '', 'g'), '+'), false) AS phone_valid,
             tenant_id IS NOT NULL AND tenant_id NOT IN ('', 'unknown') AS tenant_present,
             coalesce(age BETWEEN 13 AND 120, false) AS age_valid,
             coalesce(signup_source IN ('organic', 'paid_ad', 'referral', 'social'), false) AS source_valid
      FROM t_customer_f)"""))(
    lambda s: silver.customer_quality_flags(s.faulty("customer")))

# ---------------------------------------------------------------- B18-B21
register("order_total_check", "B18", with_fixtures("""
SELECT id, tenant_id, cast(subtotal AS double) AS subtotal, cast(tax AS double) AS tax,
       cast(shipping AS double) AS shipping, cast(total AS double) AS total,
       cast(subtotal + tax + shipping AS double) AS recomputed_total,
       cast(total - (subtotal + tax + shipping) AS double) AS difference
FROM t_order WHERE subtotal + tax + shipping <> total"""))(
    lambda s: silver.order_total_check(s.order))

register("order_totals_from_items", "B19", with_fixtures("""
SELECT i.order_id, i.item_count, cast(i.sub AS double) AS subtotal,
       cast(cast(i.sub * cast(0.08 AS decimal(3,2)) AS decimal(12,2)) AS double) AS tax,
       cast(o.shipping AS double) AS shipping,
       cast(i.sub + cast(i.sub * cast(0.08 AS decimal(3,2)) AS decimal(12,2)) + o.shipping AS double) AS total
FROM (SELECT order_id, count(id) AS item_count, sum(unit_price * quantity - discount) AS sub
      FROM t_item GROUP BY order_id) i
JOIN t_order o ON o.id = i.order_id"""))(
    lambda s: silver.order_totals_from_items(s.orderitem, s.order))

register("order_status_transitions", "B20", with_fixtures("""
SELECT id, commit_ts, from_status, to_status,
       from_status = to_status OR (from_status, to_status) IN (
         ('pending', 'processing'), ('processing', 'completed'), ('pending', 'completed'),
         ('pending', 'cancelled'), ('processing', 'cancelled')) AS is_valid
FROM (SELECT id, commit_ts, lag(status) OVER (PARTITION BY id ORDER BY commit_ts, seq) AS from_status,
             status AS to_status
      FROM t_order_log WHERE op <> 'D')
WHERE from_status IS NOT NULL"""))(
    lambda s: silver.order_status_transitions(s.order_changes()))

register("order_enriched", "B21", with_fixtures("""
SELECT o.id, o.tenant_id, t.name AS tenant_name, t.plan_type, o.customer_id,
       c.email AS customer_email, c.signup_source, o.status, cast(o.total AS double) AS total,
       o.order_date, coalesce(i.item_count, 0) AS item_count,
       coalesce(i.product_count, 0) AS product_count
FROM t_order o
LEFT JOIN t_customer c ON c.id = o.customer_id
LEFT JOIN t_tenant t ON t.id = o.tenant_id
LEFT JOIN (SELECT order_id, count(id) AS item_count, count(DISTINCT product_id) AS product_count
           FROM t_item GROUP BY order_id) i ON i.order_id = o.id"""))(
    lambda s: silver.order_enriched(s.order, s.customer, s.tenant, s.orderitem))

# ---------------------------------------------------------------- B22-B25
register("event_data_parse", "B22", with_fixtures("""
SELECT id, event_type, json_extract_string(event_data, '$.url') AS url,
       json_extract_string(event_data, '$.product_id') AS product_id,
       json_extract_string(event_data, '$.search_term') AS search_term,
       cast(json_extract_string(event_data, '$.k') AS integer) AS k
FROM t_event"""))(
    lambda s: silver.event_data_parse(s.event_source))

register("event_sessionize", "B23", with_fixtures("""
SELECT customer_id, cast(session_no AS bigint) AS session_no, min(created_at) AS session_start, max(created_at) AS session_end,
       count(*) AS event_count
FROM (SELECT customer_id, created_at,
             sum(CASE WHEN prev IS NULL OR created_at - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
               OVER (PARTITION BY customer_id ORDER BY created_at, id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no
      FROM (SELECT customer_id, created_at, cast(id AS bigint) AS id,
                   lag(created_at) OVER (PARTITION BY customer_id ORDER BY created_at, cast(id AS bigint)) AS prev
            FROM t_event WHERE customer_id IS NOT NULL))
GROUP BY customer_id, cast(session_no AS bigint)"""))(
    lambda s: silver.event_sessionize(s.event.withColumn("id", F.col("id").cast("bigint"))))

register("session_metrics", "B24", with_fixtures("""
SELECT tenant_id, session_id, min(created_at) AS session_start, max(created_at) AS session_end,
       date_diff('microsecond', min(created_at), max(created_at)) / 1000000 AS duration_seconds,
       count(*) AS event_count, count(*) = 1 AS is_bounce,
       bool_or(event_type = 'purchase') AS converted
FROM t_event GROUP BY tenant_id, session_id"""))(
    lambda s: silver.session_metrics(s.event))

register("ip_anonymize", "B25", with_fixtures("""
SELECT id, regexp_replace(ip_address, '\\.[0-9]+$', '.0') AS ip_address FROM t_event"""))(
    lambda s: s.event.select("id", silver.ip_anonymize(F.col("ip_address")).alias("ip_address")))

# ---------------------------------------------------------------- B26-B30
register("subscription_status_history", "B26", with_fixtures("""
SELECT id, status, valid_from, lead(valid_from) OVER (PARTITION BY id ORDER BY valid_from, seq) AS valid_to,
       lead(valid_from) OVER (PARTITION BY id ORDER BY valid_from, seq) IS NULL AS is_current
FROM (SELECT id, 'trial' AS status, cast(start_date AS timestamp) AS valid_from, 0 AS seq FROM t_sub
      UNION ALL
      SELECT id, 'active', cast(start_date + 14 AS timestamp), 1 FROM t_sub WHERE status <> 'trial'
      UNION ALL
      SELECT id, status, cast(end_date AS timestamp), 2 FROM t_sub WHERE status IN ('cancelled', 'expired'))"""))(
    lambda s: silver.scd2_history(s.subscription_changes(), "id", ["status"]))

register("invoice_reconciliation", "B27", with_fixtures(f"""
SELECT subscription_id, count(id) AS invoice_count,
       cast(coalesce(sum(amount) FILTER (WHERE status IN ('sent', 'paid', 'overdue')), 0) AS double) AS invoiced_amount,
       cast(coalesce(sum(amount) FILTER (WHERE status = 'paid'), 0) AS double) AS paid_amount,
       cast(coalesce(sum(amount) FILTER (WHERE status IN ('sent', 'paid', 'overdue')), 0)
            - coalesce(sum(amount) FILTER (WHERE status = 'paid'), 0) AS double) AS outstanding_amount,
       count(*) FILTER (WHERE status = 'overdue') AS overdue_count,
       cast(max(greatest(0, date_diff('day', due_date, coalesce(paid_date, date '{AS_OF_DATE}'))))
            FILTER (WHERE status IN ('sent', 'paid', 'overdue')) AS integer) AS max_days_late
FROM t_invoice GROUP BY subscription_id"""))(
    lambda s: silver.invoice_reconciliation(s.invoice, AS_OF_DATE))

register("invoice_schedule", "B28", with_fixtures("""
SELECT subscription_id, cast(k AS integer) AS k, issue_date, cast(issue_date + 30 AS date) AS due_date,
       cast(amount AS double) AS amount
FROM t_invoice_k"""))(
    lambda s: silver.invoice_schedule(s.subscription)
    .select("subscription_id", "k", "issue_date", "due_date",
            F.col("amount").cast("double").alias("amount")))

register("product_enrich_validate", "B30", with_fixtures("""
SELECT id, tenant_id, upper(substr(trim(lower(category)), 1, 1)) || substr(trim(lower(category)), 2) AS category,
       cast(price - cost AS double) AS margin,
       CASE WHEN price <> 0 THEN cast(price - cost AS double) * 100.0 / cast(price AS double) END AS margin_pct,
       coalesce(price >= 0.01 AND cost >= 0 AND stock_quantity >= 0, false) AS is_valid
FROM t_product_f"""))(
    lambda s: silver.product_enrich_validate(s.faulty("product")))
