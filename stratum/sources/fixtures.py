"""The eight shop entities and the order change log, derived from the
driver's tables by Spark (see FIXTURES.md §3).

``Shop`` hands out lazy DataFrames.  Three layers are exposed:

* ``source(entity)`` - rows as the application database holds them
  (raw e-mail text, JSON documents as text), the input to Bronze;
* ``silver(entity)`` / the named accessors - typed, cleaned Silver rows,
  the input to the Gold and analytics operators;
* ``order_changes()`` - the insert/update/delete log of ``order``.

Nothing here collects; every frame grows with the driver tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import domains
from ..functions.json import CUSTOMER_METADATA, EVENT_DATA, ORDER_METADATA, TENANT_SETTINGS
from .tables import read_table

ENTITIES = ("tenant", "customer", "product", "order", "orderitem", "event",
            "subscription", "invoice")


# Planted faults: column -> CASE arms over the entity's own (unchanged) columns.
_ID = "cast(id AS bigint)"
_ORDER_OF_ITEM = "cast(order_id AS bigint)"
_CUSTOMER = "cast(customer_id AS bigint)"
FAULTS: dict[str, dict[str, str]] = {
    "tenant": {"name": f"WHEN {_ID} % 7 = 3 THEN NULL"},
    "customer": {"email": f"WHEN {_ID} % 11 = 3 THEN NULL WHEN {_ID} % 11 = 4 THEN 'no-address' "
                          f"WHEN {_ID} % 61 = 5 THEN 'same@example.com'",
                 "tenant_id": f"WHEN {_ID} % 13 = 5 THEN '' WHEN {_ID} % 13 = 6 THEN 'unknown' "
                              f"WHEN {_ID} % 13 = 7 THEN 'ghost' WHEN {_ID} % 61 = 5 THEN '1'",
                 "phone": f"WHEN {_ID} % 17 = 2 THEN '123' WHEN {_ID} % 17 = 3 THEN NULL"},
    "product": {"price": f"WHEN {_ID} % 23 = 1 THEN 0.00", "stock_quantity": f"WHEN {_ID} % 29 = 2 THEN -1",
                "sku": f"WHEN {_ID} % 50 = 3 THEN 'SKU-TWIN'"},
    "order": {"status": f"WHEN {_ID} % 101 = 7 THEN 'lost'", "total": f"WHEN {_ID} % 103 = 8 THEN -1 "
                                                                    f"WHEN {_ID} % 103 = 9 THEN NULL",
              "customer_id": f"WHEN {_ID} % 107 = 9 THEN 'ghost'",
              "order_number": f"WHEN {_ID} % 109 = 10 THEN 'ORD-TWIN'"},
    "orderitem": {"quantity": f"WHEN {_ORDER_OF_ITEM} % 113 = 1 THEN 0",
                  "product_id": f"WHEN {_ORDER_OF_ITEM} % 127 = 2 THEN 'ghost'"},
    "event": {"event_type": f"WHEN {_ID} % 131 = 3 THEN 'odd'", "customer_id": f"WHEN {_ID} % 137 = 4 THEN 'ghost'"},
    "subscription": {"status": f"WHEN {_CUSTOMER} % 41 = 5 THEN 'paused'",
                     "billing_cycle": f"WHEN {_CUSTOMER} % 43 = 6 THEN 'daily'",
                     "tenant_id": f"WHEN {_CUSTOMER} % 47 = 7 THEN 'ghost'"},
    "invoice": {"status": f"WHEN {_CUSTOMER} % 37 = 2 THEN 'void'",
                "subscription_id": f"WHEN {_CUSTOMER} % 53 = 3 THEN 'ghost'",
                "invoice_number": f"WHEN {_CUSTOMER} % 59 = 4 THEN 'INV-TWIN'"},
}


def _case(key: str, pairs: list[tuple[str, str]], default: str) -> str:
    arms = " ".join(f"WHEN {cond} THEN {val}" for cond, val in pairs)
    return f"CASE {arms} ELSE {default} END"


def _sql_str_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


class Shop:
    """Entity provider over one scale-factor folder of driver tables.

    With ``tasks``, the rows of a table are dealt evenly to so many tasks after the
    scan: a small file is one split, but each of its rows may become many wide ones.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, tasks: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tasks = tasks

    def _t(self, name: str) -> DataFrame:
        rows = read_table(self.spark, self.sf_dir, name)
        return rows if self.tasks is None else rows.repartition(self.tasks)

    # ------------------------------------------------------------------ source
    @cached_property
    def tenant_source(self) -> DataFrame:
        plan = "CASE WHEN n_nationkey % 8 < 2 THEN 'enterprise' " \
               "WHEN n_nationkey % 8 < 5 THEN 'professional' ELSE 'starter' END"
        feats = domains.PLAN_FEATURES
        features = ("CASE plan_type "
                    + " ".join(f"WHEN '{p}' THEN array({_sql_str_list(v)})" for p, v in feats.items())
                    + " END")
        return (self._t("nation")
                .selectExpr("n_nationkey", "n_name",
                            f"{plan} AS plan_type")
                .selectExpr(
                    "cast(n_nationkey AS string) AS id",
                    "n_name AS name",
                    "lower(replace(n_name, '_', '-')) AS slug",
                    "lower(replace(n_name, '_', '-')) || '.example.com' AS domain",
                    "n_nationkey % 10 <> 9 AS is_active",
                    f"to_json(named_struct('plan_type', plan_type, 'max_users', "
                    f"cast(40 + n_nationkey * 40 AS int), 'features', {features})) AS settings",
                    "timestamp_ntz '1994-01-01 00:00:00' + make_dt_interval(n_nationkey) AS created_at",
                    "timestamp_ntz '1994-01-02 00:00:00' + make_dt_interval(n_nationkey) AS updated_at"))

    @cached_property
    def customer_source(self) -> DataFrame:
        sources = domains.SIGNUP_SOURCES
        signup = _case("c_custkey % 4", [(f"c_custkey % 4 = {i}", f"'{s}'")
                                         for i, s in enumerate(sources[:-1])], f"'{sources[-1]}'")
        return (self._t("customer")
                .selectExpr(
                    "cast(c_custkey AS string) AS id",
                    "'  ' || upper(c_name) || '@Example.COM ' AS email",
                    "'Customer' AS first_name",
                    "cast(c_custkey AS string) AS last_name",
                    "'+1 (555) ' || substr(cast(1000000 + c_custkey AS string), 2, 3) || '-' || "
                    "substr(cast(1000000 + c_custkey AS string), 4, 4) AS phone",
                    "c_acctbal >= 0 AS is_active",
                    "to_json(named_struct('age', cast(18 + c_custkey % 58 AS int), "
                    "'country', c_mktsegment, "
                    f"'signup_source', {signup}, "
                    "'preferences', named_struct('newsletter', c_custkey % 2 = 0, "
                    "'notifications', c_custkey % 3 = 0))) AS metadata",
                    "timestamp_ntz '1995-01-01 00:00:00' + make_dt_interval(cast(c_custkey * 7 % 730 AS int)) AS created_at",
                    "timestamp_ntz '1995-01-01 00:00:00' + make_dt_interval(cast(c_custkey * 7 % 730 AS int) + 1) AS updated_at",
                    "cast(c_nationkey AS string) AS tenant_id"))

    @cached_property
    def product_source(self) -> DataFrame:
        return (self._t("part")
                .selectExpr("p_partkey", "p_name", "p_type",
                            "cast(p_retailprice AS decimal(10,2)) AS price")
                .selectExpr(
                    "cast(p_partkey AS string) AS id",
                    "'SKU-' || p_partkey AS sku",
                    "p_name || ' ' || p_partkey AS name",
                    "'Fixture product ' || p_partkey AS description",
                    "p_type AS category",
                    "price",
                    "cast(price * cast(0.6 AS decimal(2,1)) AS decimal(10,2)) AS cost",
                    "cast(p_partkey * 37 % 501 AS int) AS stock_quantity",
                    "p_partkey % 20 <> 0 AS is_active",
                    "timestamp_ntz '1994-06-01 00:00:00' AS created_at",
                    "timestamp_ntz '1994-06-02 00:00:00' AS updated_at",
                    "cast(p_partkey % 25 AS string) AS tenant_id"))

    @cached_property
    def order_source(self) -> DataFrame:
        o = self._t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        c = self._t("customer").select("c_custkey", "c_nationkey")
        status = ("CASE WHEN o_orderkey % 20 = 0 THEN 'cancelled' WHEN o_orderkey % 20 = 1 THEN 'pending' "
                  "WHEN o_orderkey % 20 < 4 THEN 'processing' ELSE 'completed' END")
        pay = "element_at(array('credit_card', 'paypal', 'bank_transfer'), cast(o_orderkey % 3 AS int) + 1)"
        return (o.join(c, o.o_custkey == c.c_custkey, "left")
                .selectExpr("o_orderkey", "o_custkey", "c_nationkey", "o_orderdate",
                            f"{status} AS status",
                            "cast(o_totalprice AS decimal(10,2)) AS total",
                            f"{pay} AS payment_method")
                .selectExpr("*", "cast(total * cast(0.07 AS decimal(3,2)) AS decimal(10,2)) AS tax",
                            "cast(o_orderkey % 51 AS decimal(10,2)) AS shipping")
                .selectExpr(
                    "cast(o_orderkey AS string) AS id",
                    "'ORD-' || o_orderkey AS order_number",
                    "status",
                    "cast(total - tax - shipping + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END "
                    "AS decimal(10,2)) AS subtotal",
                    "tax", "shipping", "total",
                    "o_orderdate AS order_date",
                    "CASE WHEN status = 'completed' THEN o_orderdate + make_dt_interval(3) END AS completed_at",
                    "to_json(named_struct('payment_method', payment_method, 'shipping_address', "
                    "named_struct('city', 'City ' || (o_custkey % 50), 'country', 'US'))) AS metadata",
                    "o_orderdate AS created_at",
                    "o_orderdate AS updated_at",
                    "cast(o_custkey AS string) AS customer_id",
                    "cast(c_nationkey AS string) AS tenant_id"))

    @cached_property
    def orderitem_source(self) -> DataFrame:
        li = self._t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                        "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
        p = self._t("part").select("p_partkey", "p_retailprice")
        return self._items(li.join(p, li.l_partkey == p.p_partkey, "left"), "cast(l_partkey AS string)")

    @cached_property
    def orderitem_by_product(self) -> DataFrame:
        """The rows of ``orderitem``, dealt by ``product_id`` where they find their price, so that a
        join by product that follows need not deal them again."""
        li = self._t("lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                            "l_extendedprice", "l_discount", "l_shipdate", "cast(l_partkey AS string) AS product")
        p = self._t("part").selectExpr("cast(p_partkey AS string) AS priced", "p_retailprice")
        return self._silver_items(self._items(li.join(p.hint("merge"), li.product == p.priced, "left"), "product"))

    @staticmethod
    def _items(priced: DataFrame, product_id: str) -> DataFrame:
        return (priced.selectExpr("*", "cast(p_retailprice AS decimal(10,2)) AS unit_price",
                            "cast(l_quantity AS int) AS quantity",
                            "cast(cast(round(l_discount * 100) AS int) AS decimal(10,2)) AS discount")
                .selectExpr(
                    "concat_ws('-', cast(l_orderkey AS string), cast(l_linenumber AS string), "
                    "cast(l_partkey AS string), cast(l_suppkey AS string), "
                    "cast(cast(l_extendedprice AS decimal(12,2)) AS string)) AS id",
                    "quantity", "unit_price", "discount",
                    "cast(unit_price * quantity - discount AS decimal(10,2)) AS total",
                    "l_shipdate AS created_at", "l_shipdate AS updated_at",
                    "cast(l_orderkey AS string) AS order_id",
                    f"{product_id} AS product_id"))

    @cached_property
    def event_source(self) -> DataFrame:
        e = self._t("events").select("event_id", "ts", "user_id", "event_type", "props")
        c = self._t("customer").select("c_custkey", "c_nationkey")
        etype = "CASE event_type " + " ".join(
            f"WHEN '{k}' THEN '{v}'" for k, v in domains.DRIVER_EVENT_MAP.items()) + " END"
        return (e.join(c, e.user_id == c.c_custkey, "left")
                .selectExpr(
                    "cast(event_id AS string) AS id",
                    f"{etype} AS event_type",
                    "CASE event_id % 4 "
                    "WHEN 1 THEN replace(props, '}', ', \"url\": \"/p/' || event_id % 50 || '\", \"product_id\": \"' "
                    "|| event_id % 200 || '\"}') "
                    "WHEN 2 THEN replace(props, '}', ', \"search_term\": \"term ' || event_id % 30 || '\"}') "
                    "ELSE props END AS event_data",
                    "(user_id % 97) || '-' || cast(cast(ts AS date) AS string) AS session_id",
                    "(10 + user_id % 200) || '.' || (event_id % 256) || '.7.9' AS ip_address",
                    "'Mozilla/5.0 (fixture ' || (user_id % 5) || ')' AS user_agent",
                    "ts AS created_at",
                    "CASE WHEN event_id % 10 >= 7 THEN NULL ELSE cast(user_id AS string) END AS customer_id",
                    "cast(c_nationkey AS string) AS tenant_id"))

    @cached_property
    def subscription_source(self) -> DataFrame:
        plans = domains.SUBSCRIPTION_PLANS
        plan_name = "CASE " + " ".join(f"WHEN c_custkey % 4 = {i} THEN '{n}'" for i, (n, _) in enumerate(plans)) + " END"
        amount = "CASE " + " ".join(f"WHEN c_custkey % 4 = {i} THEN {a}" for i, (_, a) in enumerate(plans)) + " END"
        status = ("CASE WHEN c_custkey % 20 < 14 THEN 'active' WHEN c_custkey % 20 < 16 THEN 'trial' "
                  "WHEN c_custkey % 20 < 19 THEN 'cancelled' ELSE 'expired' END")
        return (self._t("customer").select("c_custkey", "c_nationkey")
                .selectExpr("*", f"{status} AS status",
                            "date_add(date '1998-01-01', cast(c_custkey % 181 AS int)) AS start_date")
                .selectExpr(
                    "'S' || c_custkey AS id",
                    f"{plan_name} AS plan_name",
                    "status",
                    "start_date",
                    "CASE WHEN status IN ('active', 'trial') THEN date_add(start_date, 365) "
                    "ELSE date_add(start_date, cast(30 + c_custkey % 151 AS int)) END AS end_date",
                    f"cast({amount} AS decimal(10,2)) AS monthly_amount",
                    "CASE WHEN c_custkey % 2 = 0 THEN 'monthly' ELSE 'yearly' END AS billing_cycle",
                    "cast(start_date AS timestamp_ntz) AS created_at",
                    "cast(start_date AS timestamp_ntz) AS updated_at",
                    "cast(c_custkey AS string) AS customer_id",
                    "cast(c_nationkey AS string) AS tenant_id"))

    @cached_property
    def invoice_source(self) -> DataFrame:
        from ..operators.silver import invoice_schedule
        sched = invoice_schedule(self.subscription_source)
        h = "(cast(customer_id AS bigint) * 7 + k * 13) % 20"
        par = "(cast(customer_id AS bigint) + k) % 2 = 0"
        status = (f"CASE WHEN sub_status = 'active' THEN CASE WHEN {h} < 17 THEN 'paid' "
                  f"WHEN {h} < 19 THEN 'sent' ELSE 'overdue' END "
                  f"WHEN sub_status = 'cancelled' THEN CASE WHEN {par} THEN 'paid' ELSE 'cancelled' END "
                  f"ELSE CASE WHEN {par} THEN 'paid' ELSE 'overdue' END END")
        return (sched.selectExpr("*", f"{status} AS status", f"{h} AS h")
                .selectExpr(
                    "subscription_id || '-' || k AS id",
                    "'INV-' || subscription_id || '-' || k AS invoice_number",
                    "amount", "status", "issue_date", "due_date",
                    "CASE WHEN status = 'paid' THEN date_add(issue_date, cast(1 + h AS int)) END AS paid_date",
                    "cast(issue_date AS timestamp_ntz) AS created_at",
                    "cast(issue_date AS timestamp_ntz) AS updated_at",
                    "customer_id", "subscription_id", "tenant_id"))

    def source(self, entity: str) -> DataFrame:
        return getattr(self, f"{entity}_source")

    # ------------------------------------------------------------------ change log
    def order_changes(self) -> DataFrame:
        """Insert / update / delete log of ``order`` (op, commit_ts, seq + row).

        Every order is inserted at its order date; every 5th (id % 5 = 2) is
        updated to completed 3 days later, and some of those (id % 35 = 2) back
        to pending, which is not allowed, 5 days later; orders with id % 50 = 0
        or id % 55 = 2 are deleted 10 days later, and id % 100 = 0 comes back
        as processing after 12 days.  One scan of the source expands each order
        into its versions (``inline`` of a per-row array), instead of one scan
        per op.
        """
        o = self.order_source
        k = "cast(id AS bigint)"
        versions = ("inline(filter(array("
                    "named_struct('op', 'I', 'seq', 0, 'days', 0, 'now', status), "
                    f"CASE WHEN {k} % 5 = 2 THEN named_struct('op', 'U', 'seq', 1, 'days', 3, 'now', 'completed') END, "
                    f"CASE WHEN {k} % 35 = 2 THEN named_struct('op', 'U', 'seq', 2, 'days', 5, 'now', 'pending') END, "
                    f"CASE WHEN {k} % 50 = 0 OR {k} % 55 = 2 THEN "
                    "named_struct('op', 'D', 'seq', 3, 'days', 10, 'now', status) END, "
                    f"CASE WHEN {k} % 100 = 0 THEN named_struct('op', 'U', 'seq', 4, 'days', 12, 'now', 'processing') END), "
                    "v -> v IS NOT NULL))")
        rows = o.selectExpr(versions, "*")
        upd = F.col("op") == "U"
        return (rows.withColumn("status", F.col("now"))
                .withColumn("updated_at", F.when(upd, F.expr("order_date + make_dt_interval(days)"))
                            .otherwise(F.col("updated_at")))
                .selectExpr("op", "order_date + make_dt_interval(days) AS commit_ts", "seq",
                            *o.columns))

    def subscription_changes(self) -> DataFrame:
        """Status change log of ``subscription``: every subscription starts as
        a trial; non-trial ones become active 14 days later; cancelled and
        expired ones take their final status at the end date.  One scan,
        expanded per row as in ``order_changes``."""
        s = self.subscription_source.select("id", "customer_id", "tenant_id", "plan_name",
                                            "status", "start_date", "end_date")
        versions = ("inline(filter(array("
                    "named_struct('op', 'I', 'seq', 0, 'at', start_date, 'new_status', 'trial'), "
                    "CASE WHEN status <> 'trial' THEN named_struct('op', 'U', 'seq', 1, "
                    "'at', date_add(start_date, 14), 'new_status', 'active') END, "
                    "CASE WHEN status IN ('cancelled', 'expired') THEN named_struct('op', 'U', 'seq', 2, "
                    "'at', end_date, 'new_status', status) END), v -> v IS NOT NULL))")
        return (s.selectExpr(versions, "id", "customer_id", "tenant_id", "plan_name")
                .selectExpr("op", "cast(at AS timestamp_ntz) AS commit_ts", "seq", "id", "customer_id",
                            "tenant_id", "plan_name", "new_status AS status"))

    def customer_changes(self) -> DataFrame:
        """Change log of ``customer``: everyone is inserted when created; id % 7 = 0
        is delivered again unchanged after 30 days, id % 9 = 4 moves to another country
        after 400 days, id % 27 = 4 back after 500, id % 45 = 4 is deleted after 600."""
        k = "cast(id AS bigint)"
        versions = ("inline(filter(array("
                    "named_struct('op', 'I', 'seq', 0, 'days', 0, 'now', metadata.country), "
                    f"CASE WHEN {k} % 7 = 0 THEN named_struct('op', 'U', 'seq', 1, 'days', 30, 'now', metadata.country) END, "
                    f"CASE WHEN {k} % 9 = 4 THEN named_struct('op', 'U', 'seq', 2, 'days', 400, 'now', 'MOVED') END, "
                    f"CASE WHEN {k} % 27 = 4 THEN named_struct('op', 'U', 'seq', 3, 'days', 500, 'now', metadata.country) END, "
                    f"CASE WHEN {k} % 45 = 4 THEN named_struct('op', 'D', 'seq', 4, 'days', 600, 'now', 'MOVED') END), "
                    "v -> v IS NOT NULL))")
        return (self.customer.selectExpr(versions, "id", "tenant_id", "email", "created_at")
                .selectExpr("op", "created_at + make_dt_interval(days) AS commit_ts", "seq", "id", "tenant_id",
                            "email", "now AS country"))

    def product_changes(self) -> DataFrame:
        """Change log of ``product``: id % 3 = 0 is repriced on 1996-01-01, id % 12 = 0
        back on 1997-01-01, id % 10 = 1 gets another category on 1996-09-01."""
        k = "cast(id AS bigint)"
        dearer = "cast(cost * cast(1.1 AS decimal(2,1)) AS decimal(10,2))"
        versions = ("inline(filter(array("
                    "named_struct('op', 'I', 'seq', 0, 'commit_ts', created_at, 'new_cost', cost, 'now', category), "
                    f"CASE WHEN {k} % 3 = 0 THEN named_struct('op', 'U', 'seq', 1, 'commit_ts', "
                    f"timestamp_ntz '1996-01-01 00:00:00', 'new_cost', {dearer}, 'now', category) END, "
                    f"CASE WHEN {k} % 10 = 1 THEN named_struct('op', 'U', 'seq', 2, 'commit_ts', timestamp_ntz "
                    f"'1996-09-01 00:00:00', 'new_cost', CASE WHEN {k} % 3 = 0 THEN {dearer} ELSE cost END, 'now', 'CLEARANCE') END, "
                    f"CASE WHEN {k} % 12 = 0 THEN named_struct('op', 'U', 'seq', 3, 'commit_ts', "
                    "timestamp_ntz '1997-01-01 00:00:00', 'new_cost', cost, 'now', category) END), v -> v IS NOT NULL))")
        return (self.product.selectExpr(versions, "id", "tenant_id", "sku")
                .selectExpr("op", "commit_ts", "seq", "id", "tenant_id", "sku", "now AS category", "new_cost AS cost"))

    def tenant_changes(self) -> DataFrame:
        """Change log of ``tenant``: id % 4 = 1 changes to enterprise on 1996-07-01, id % 8 = 1 back a year later."""
        k = "cast(id AS bigint)"
        versions = ("inline(filter(array("
                    "named_struct('op', 'I', 'seq', 0, 'commit_ts', created_at, 'now', plan_type), "
                    f"CASE WHEN {k} % 4 = 1 THEN named_struct('op', 'U', 'seq', 1, 'commit_ts', "
                    "timestamp_ntz '1996-07-01 00:00:00', 'now', 'enterprise') END, "
                    f"CASE WHEN {k} % 8 = 1 THEN named_struct('op', 'U', 'seq', 2, 'commit_ts', "
                    "timestamp_ntz '1997-07-01 00:00:00', 'now', plan_type) END), v -> v IS NOT NULL))")
        return self.tenant.selectExpr(versions, "id", "name", "plan_type").selectExpr(
            "op", "commit_ts", "seq", "id", "name", "now AS plan_type")

    def customer_redelivered(self) -> DataFrame:
        """Silver customers plus a re-delivered copy of every 7th one (upper-case
        e-mail, one day newer) - the input of the de-duplication operator.
        One scan; the copy is generated next to its original."""
        c = self.customer
        again = F.col("_copy")
        rows = c.select(F.explode(F.when(F.col("id").cast("bigint") % 7 == 0, F.array(F.lit(False), F.lit(True)))
                                  .otherwise(F.array(F.lit(False)))).alias("_copy"), "*")
        return (rows.withColumn("email", F.when(again, F.upper("email")).otherwise(F.col("email")))
                .withColumn("first_name", F.when(again, F.lit("Customer (resent)")).otherwise(F.col("first_name")))
                .withColumn("updated_at", F.when(again, F.expr("updated_at + make_dt_interval(1)"))
                            .otherwise(F.col("updated_at")))
                .select(*c.columns))

    # ------------------------------------------------------------------ silver
    @cached_property
    def tenant(self) -> DataFrame:
        s = F.from_json("settings", TENANT_SETTINGS)
        return (self.tenant_source.withColumn("s", s)
                .selectExpr("id", "name", "slug", "domain", "is_active", "s.plan_type AS plan_type",
                            "s.max_users AS max_users", "s.features AS features",
                            "created_at", "updated_at"))

    @cached_property
    def customer(self) -> DataFrame:
        return self.customer_source.select(
            "id", "tenant_id", F.trim(F.lower("email")).alias("email"), "first_name", "last_name",
            "phone", "is_active", F.from_json("metadata", CUSTOMER_METADATA).alias("metadata"),
            "created_at", "updated_at")

    @cached_property
    def product(self) -> DataFrame:
        return self.product_source.select(
            "id", "tenant_id", "sku", "name", "description", "category", "price", "cost",
            "stock_quantity", "is_active", "created_at", "updated_at")

    @cached_property
    def order(self) -> DataFrame:
        return self.order_source.select(
            "id", "tenant_id", "customer_id", "order_number", "status", "subtotal", "tax",
            "shipping", "total", "order_date", "completed_at",
            F.from_json("metadata", ORDER_METADATA).alias("metadata"), "created_at", "updated_at")

    @cached_property
    def orderitem(self) -> DataFrame:
        return self._silver_items(self.orderitem_source)

    @staticmethod
    def _silver_items(items: DataFrame) -> DataFrame:
        return items.select(
            "id", "order_id", "product_id", "quantity", "unit_price", "discount", "total",
            "created_at", "updated_at")

    @cached_property
    def event(self) -> DataFrame:
        return self.event_source.select(
            "id", "tenant_id", "customer_id", "event_type",
            F.from_json("event_data", EVENT_DATA).alias("event_data"), "session_id",
            "ip_address", "user_agent", "created_at")

    @cached_property
    def subscription(self) -> DataFrame:
        return self.subscription_source.select(
            "id", "tenant_id", "customer_id", "plan_name", "status", "start_date", "end_date",
            "monthly_amount", "billing_cycle", "created_at", "updated_at")

    @cached_property
    def invoice(self) -> DataFrame:
        return self.invoice_source.select(
            "id", "tenant_id", "customer_id", "subscription_id", "invoice_number", "amount",
            "status", "issue_date", "due_date", "paid_date", "created_at", "updated_at")

    def silver(self, entity: str) -> DataFrame:
        return getattr(self, entity)

    def tables(self) -> dict[str, DataFrame]:
        return {e: self.silver(e) for e in ENTITIES}

    def faulty(self, entity: str, rows: DataFrame | None = None) -> DataFrame:
        """Silver rows with faults planted by key rule, for the checks that
        must find them (``FAULTS``); ``rows`` may be another frame of the entity."""
        df = self.silver(entity) if rows is None else rows
        return df.withColumns({c: F.expr(f"CASE {arms} ELSE {c} END").cast(df.schema[c].dataType)
                               for c, arms in FAULTS[entity].items() if c in df.columns})

    def faulty_tables(self) -> dict[str, DataFrame]:
        return {e: self.faulty(e) for e in ENTITIES}
