"""Conformed dimensions with history (F20): effective-dated versions, stable keys, as-of facts.

A dimension is stored as its ``history``: one state per (key, time), the one
with the greatest sequence number if several are given.  Loads are merged by
union and ``max``, so the order in which changes arrive (late ones included)
never matters.  ``versions`` derives the effective-dated rows: states equal to
the one before are no versions, a delete ends a version.  A version's surrogate
key is a digest of its key and start, so it is the same after every load and
needs no counter that one task would have to hand out.

A fact takes the version in force at its own time.  Where there is none (the
member is not known yet, or is deleted), it takes the member's inferred row,
which ``with_inferred`` adds to the dimension; a fact without a key takes UNKNOWN.
Rows of a change log without a key or a time take no part.  Lookups join facts with
the versions of their member; members of many versions are met by (key, time bucket), so
neither their facts nor their versions meet all the others.  Until the last join a version
is named by member and start: a digest does not compress, and is made where it is returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import neighbour
from .temporal import asof_join, micros

UNKNOWN = "unknown"
MANY = 64       # versions of a member that every fact of it may be compared with
FEW = 4         # versions of a member that its facts carry along until their time is known
SMALL = 200_000     # versions of a dimension that its facts rather meet where they are, by broadcast


def history_of(changes: DataFrame, key: str, attrs: list[str], history: DataFrame | None = None) -> DataFrame:
    """(key, at, gone, state) of a change log (op, commit_ts, seq), merged into ``history``."""
    rows = changes.where(F.col(key).isNotNull() & F.col("commit_ts").isNotNull()).select(
        key, F.col("commit_ts").alias("at"), F.struct(
            F.col("seq").cast("int").alias("seq"), (F.col("op") == "D").alias("gone"),
            F.struct(*attrs).alias("state")).alias("last"))
    if history is not None:
        rows = rows.unionByName(history.select(key, "at", F.struct("seq", "gone", "state").alias("last")))
    return rows.groupBy(key, "at").agg(F.max("last").alias("last")).select(key, "at", "last.*")


def versions(history: DataFrame, key: str) -> DataFrame:
    """(sk, key, attributes, valid_from, valid_to, is_current) of every version."""
    states = history.select(key, "at", F.struct("gone", "state").alias("now"))
    changed = neighbour(states, [key], "at", [], ["now"], "prev", prefix="was_").where(
        ~F.col("now").eqNullSafe(F.col("was_now"))).select(key, "at", "now")
    ranged = neighbour(changed, [key], "at", [], ["at"], "next", prefix="next_").where(~F.col("now.gone"))
    return ranged.select(version_key(F.col(key), F.col("at")).alias("sk"), key, "now.state.*",
                         F.col("at").alias("valid_from"), F.col("next_at").alias("valid_to"),
                         F.col("next_at").isNull().alias("is_current"))


def version_key(key: Column, valid_from: Column) -> Column:
    return F.md5(F.concat(key, F.lit("|"), micros(valid_from).cast("string")))


def inferred_key(key: Column) -> Column:
    return F.md5(F.concat(key, F.lit("|inferred")))


def sk_of(key: Column, start: Column) -> Column:
    """The surrogate key of the version of ``key`` that starts at ``start``; without one the inferred row's, without a key UNKNOWN."""
    return F.when(key.isNull(), UNKNOWN).when(start.isNotNull(), version_key(key, start)).otherwise(inferred_key(key))


def lookup(facts: DataFrame, dim: DataFrame, key: str, ts: str, sk: str, values: dict[str, str] | None = None,
           dim_key: str = "id", many: int = MANY) -> DataFrame:
    """``facts`` with ``sk``, the key of the version in force at ``ts``, and that version's ``values`` (column -> new name)."""
    values = values or {}
    found = in_force(facts, dim, key, ts, "_start", values, dim_key, many)
    return found.select(*facts.columns, sk_of(F.col(key), F.col("_start")).alias(sk), *values.values())


def in_force(facts: DataFrame, dim: DataFrame, key: str, ts: str, start: str, values: dict[str, str] | None = None,
             dim_key: str = "id", many: int = MANY) -> DataFrame:
    """``facts`` with ``start``, when the version in force at ``ts`` begins, and that version's ``values`` (column -> new name).

    Key and start name a version in a few bytes, so joins that follow need not move digests.
    Facts meet the versions of their member by key: one shuffle, none if the dimension is small
    enough to be broadcast.  Members of more than ``many`` versions are met by (key, time bucket)."""
    values = values or {}
    held = ["start", "valid_to", *values]
    known = _known(dim, key, list(values), dim_key).withColumn("start", F.col("valid_from"))
    rich = _rich(known, key, many)
    if rich is None:
        found = _of_member(facts, known, key, ts, held)
    else:
        of_rich = F.col(key) == F.col("_rich")
        found = _of_member(facts.join(rich, of_rich, "left_anti"), known.join(rich, of_rich, "left_anti"), key, ts, held) \
            .unionByName(asof_join(facts.join(rich, of_rich, "left_semi"), known.join(rich, of_rich, "left_semi"),
                                   [key], ts, "valid_from", held, prefix="_found_"))
    holds = F.col("_found_valid_to").isNull() | (F.col(ts) < F.col("_found_valid_to"))
    return found.select(*facts.columns, F.when(holds, F.col("_found_start")).alias(start),
                        *[F.when(holds, F.col(f"_found_{v}")).alias(name) for v, name in values.items()])


def _known(dim: DataFrame, key: str, values: list[str], dim_key: str) -> DataFrame:
    return dim.select(F.col(dim_key).alias(key), "valid_from", "valid_to", *values).where(
        F.col(key).isNotNull() & F.col("valid_from").isNotNull())


def _rich(known: DataFrame, key: str, many: int) -> DataFrame | None:
    """(_rich), the members of more than ``many`` versions, if there are any."""
    rich = known.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > many).select(F.col(key).alias("_rich"))
    return None if rich.isEmpty() else rich


def _of_member(facts: DataFrame, known: DataFrame, key: str, ts: str, held: list[str]) -> DataFrame:
    """``facts`` with the ``held`` columns (``_found_...``) of the last version that starts by ``ts``,
    as ``asof_join`` gives them: of versions that start together the greatest counts."""
    one = known.groupBy(F.col(key).alias("_key"), micros(F.col("valid_from")).alias("_from")).agg(
        F.max(F.struct(*held)).alias("_found"))
    ranged = one.withColumn("_until", F.lead("_from").over(Window.partitionBy("_key").orderBy("_from"))).select(
        "_key", "_from", "_until", *[F.col(f"_found.{c}").alias(f"_found_{c}") for c in held])
    at = micros(F.col(ts))
    met = (F.col(key) == F.col("_key")) & (F.col("_from") <= at) & (F.col("_until").isNull() | (at < F.col("_until")))
    return facts.join(ranged, met, "left").drop("_key", "_from", "_until")


def carrying(facts: DataFrame, dim: DataFrame, key: str, values: list[str], dim_key: str = "id") -> DataFrame:
    """``facts`` with ``_versions``, all versions of their member (null: none), for ``carried_in_force``:
    facts that must be moved to learn their time need not be moved back to their member."""
    held = _known(dim, "_key", values, dim_key).groupBy("_key").agg(
        F.collect_list(F.struct("valid_from", "valid_to", *values)).alias("_versions"))
    return facts.join(held, F.col(key) == F.col("_key"), "left").drop("_key")


def carried_in_force(facts: DataFrame, ts: str, start: str, values: dict[str, str]) -> DataFrame:
    """``facts`` with what ``in_force`` finds, from the ``_versions`` they carry."""
    at = F.col(ts).cast("timestamp_ntz")
    last = F.array_max(F.filter("_versions", lambda v: v["valid_from"].cast("timestamp_ntz") <= at))
    holds = F.col("_last.valid_to").isNull() | (F.col(ts) < F.col("_last.valid_to"))
    return facts.withColumn("_last", last).withColumns(
        {start: F.when(holds, F.col("_last.valid_from"))}
        | {name: F.when(holds, F.col(f"_last.{v}")) for v, name in values.items()}).drop("_versions", "_last")


def with_inferred(dim: DataFrame, looked_up: DataFrame, key: str, sk: str, dim_key: str = "id") -> DataFrame:
    """The dimension with one inferred row per member that facts need and no version covers."""
    need = looked_up.where(F.col(sk) == inferred_key(F.col(key))).select(
        F.col(sk).alias("sk"), F.col(key).alias(dim_key)).distinct()
    return (dim.withColumn("is_inferred", F.lit(False))
            .unionByName(need.withColumn("is_inferred", F.lit(True)), allowMissingColumns=True))


def keyed_orders(orders: DataFrame, customers: DataFrame, tenants: DataFrame) -> DataFrame:
    """Orders with the starts of the customer and tenant versions at order time."""
    o = orders.select("id", "tenant_id", "customer_id", "status", "order_date")
    return in_force(in_force(o, customers, "customer_id", "order_date", "customer_from"),
                    tenants, "tenant_id", "order_date", "tenant_from")


def fact_sales(items: DataFrame, keyed: DataFrame, products: DataFrame, few: int = FEW) -> DataFrame:
    """Line-grain sales; the cost is that of the product version at order time.

    Lines meet the versions of their product before they move to their order, whose time selects one;
    lines of products of more than ``few`` versions (0: all lines) meet them after it.  Digests are made last."""
    o = keyed.withColumnRenamed("id", "order_id")
    lines = items.select(F.col("id").alias("item_id"), "order_id", "product_id", "quantity", "total")
    rich = _rich(_known(products, "product_id", [], "id"), "product_id", few) if few else None

    def carried(lines: DataFrame, products: DataFrame) -> DataFrame:
        return carried_in_force(carrying(lines, products, "product_id", ["cost"]).join(o, "order_id"),
                                "order_date", "product_from", {"cost": "unit_cost"})

    def looked_up(lines: DataFrame, products: DataFrame) -> DataFrame:
        return in_force(lines.join(o, "order_id"), products, "product_id", "order_date", "product_from", {"cost": "unit_cost"})

    if rich is None:
        found = carried(lines, products) if few else looked_up(lines, products)
    else:
        line_of, product_of = F.col("product_id") == F.col("_rich"), F.col("id") == F.col("_rich")
        found = carried(lines.join(rich, line_of, "left_anti"), products.join(rich, product_of, "left_anti")).unionByName(
            looked_up(lines.join(rich, line_of, "left_semi"), products.join(rich, product_of, "left_semi")))
    d = F.to_date("order_date")
    return found.select(
        "item_id", "order_id", "product_id",
        *[sk_of(F.col(f"{m}_id"), F.col(f"{m}_from")).alias(f"{m}_sk") for m in ("product", "customer", "tenant")], "status",
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"), "quantity",
        F.col("total").cast("double").alias("revenue"),
        (F.col("unit_cost") * F.col("quantity")).cast("double").alias("cost"))
