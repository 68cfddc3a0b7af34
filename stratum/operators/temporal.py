"""Joins over time: as-of (the value last known) and point-in-interval.

Both stay exact and spread out when one key holds a third of all rows: rows
are dealt by (key, time bucket), never by key alone, and no plan has a nested
loop or a cartesian product.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"
DAY = 86_400


def micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


# ---------------------------------------------------------------- as-of
def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
              values: list[str], tiebreak: list[str] | None = None, prefix: str = "",
              bucket_seconds: int = 30 * DAY) -> DataFrame:
    """Every row of ``left`` with the ``values`` of the latest row of ``right`` that has
    the same keys and whose time is not after it; NULL where there is none.

    Of right rows at the same time the one with the greatest ``tiebreak`` counts,
    then the greatest values.  Rows of both sides are windowed together inside
    (key, bucket) only; what was known before a bucket comes from a summary with
    one row per (key, bucket), carried forward per key.  Left rows without a key or a
    time stay and find nothing; such right rows take no part.
    """
    b = bucket_seconds * 1_000_000
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    found = F.struct(F.col("_us"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tiebreak or [])],
                     *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)])
    r = right.withColumn("_us", micros(F.col(right_ts))).select(*keyed, "_us", found.alias("_known"))
    r = r.where(_all([F.col(c).isNotNull() for c in (*names, "_us")]))
    held = F.struct(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(left.columns)])
    lft = left.withColumn("_us", micros(F.col(left_ts))).select(*keyed, "_us", held.alias("_row"))
    whole = _all([F.col(c).isNotNull() for c in (*names, "_us")])
    known_type, row_type = r.schema["_known"].dataType, lft.schema["_row"].dataType
    rows = (lft.where(whole).withColumn("_known", F.lit(None).cast(known_type))
            .unionByName(r.withColumn("_row", F.lit(None).cast(row_type)))
            .withColumn("_b", F.floor(F.col("_us") / b).cast("long")))
    # Right rows come first at equal times; inside a bucket the last one seen counts.
    w = (Window.partitionBy(*names, "_b").orderBy("_us", F.col("_row").isNotNull(), "_known")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = rows.withColumn("_here", F.last("_known", ignorenulls=True).over(w)).where(F.col("_row").isNotNull())
    before = Window.partitionBy(*names).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (rows.groupBy(*names, "_b").agg(F.max("_known").alias("_end"))
               .withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).drop("_end"))
    out = local.join(carried, [*names, "_b"]).select("_row", F.coalesce("_here", "_carried").alias("_known"))
    lost = lft.where(~whole).select("_row", F.lit(None).cast(known_type).alias("_known"))
    return out.unionByName(lost).select(
        *[F.col(f"_row._c{i}").alias(c) for i, c in enumerate(left.columns)],
        *[F.col(f"_known._v{i}").alias(f"{prefix}{v}") for i, v in enumerate(values)])


# ---------------------------------------------------------------- point in interval
LEVEL_STEP = 4                  # bins of a level are this many times as wide as those below
SPLIT_ROWS = 200_000            # rows of one side of a bin in one task


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], ts: str, start: str, end: str,
                  values: list[str], prefix: str = "", base_seconds: int = DAY,
                  split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Every pair of a point and an interval with the same keys (or all, without
    keys) and ``start <= ts < end``, once; the point's columns and the interval's ``values``.

    An interval goes to the level whose bins are about as long as itself, so it
    covers at most LEVEL_STEP + 1 of them, and a point has one bin per level in use: the
    join is an equi-join on (keys, level, bin).  Where a bin has more than
    ``split_rows`` rows on a side, that side is dealt to parts by a hash and the
    other side goes to each of them, so a hot key or time is spread as well.
    A NULL end is open.  Rows without a key, time or start join with nothing, and
    neither do empty intervals.
    """
    base = base_seconds * 1_000_000
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    p = points.withColumn("_us", micros(F.col(ts))).select(
        *keyed, "_us", F.struct(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(points.columns)]).alias("_row"))
    p = p.where(_all([F.col(c).isNotNull() for c in (*names, "_us")]))
    # Intervals are cut to the time that has points, so open ones are finite: one row.
    span = p.agg(F.min("_us").alias("lo"), (F.max("_us") + 1).alias("hi")).first()
    lo, hi = (span.lo, span.hi) if span.lo is not None else (0, 0)
    i = intervals.select(
        *keyed, F.greatest(micros(F.col(start)), F.lit(lo).cast("long")).alias("_from"),
        F.least(F.coalesce(micros(F.col(end)), F.lit(hi).cast("long")), F.lit(hi).cast("long")).alias("_to"),
        F.col(start).isNotNull().alias("_ok"),
        F.struct(*[F.col(v).alias(f"_v{n}") for n, v in enumerate(values)]).alias("_found"))
    i = i.where(_all([F.col(c).isNotNull() for c in names] + [F.col("_ok"), F.col("_from") < F.col("_to")])).drop("_ok")
    level = F.greatest(F.lit(0), F.ceil(F.log((F.col("_to") - F.col("_from")) / base) / F.log(F.lit(float(LEVEL_STEP))))).cast("int")
    i = i.withColumn("_level", level)
    levels = sorted(r[0] for r in i.select("_level").distinct().collect())      # at most the log of the time span
    width = {n: base * LEVEL_STEP ** n for n in levels}

    def bin_of(us: Column, level: Column) -> Column:
        out = F.lit(None).cast("long")
        for n, w in width.items():
            out = F.when(level == n, F.floor(us / w).cast("long")).otherwise(out)
        return out

    # (us / w) is exact below 2^53 microseconds, some 285 years around the epoch.
    at = ["_level", "_bin", *names]
    i = i.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_from"), F.col("_level")),
                                                  bin_of(F.col("_to") - 1, F.col("_level")))))
    p = p.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))) \
        .withColumn("_bin", bin_of(F.col("_us"), F.col("_level")))
    n_p, n_i = (df.groupBy(*at).agg(F.count(F.lit(1)).alias(n)) for df, n in ((p, "_np"), (i, "_ni")))
    parts = [F.ceil(F.col(n) / split_rows).cast("int").alias(s) for n, s in (("_np", "_sp"), ("_ni", "_si"))]
    hot = n_p.join(n_i, at).where((F.col("_np") > split_rows) | (F.col("_ni") > split_rows)).select(*at, *parts)

    def dealt(df: DataFrame, own: str, n_own: str, other: str, n_other: str, by: list[str]) -> DataFrame:
        df = df.join(hot, at, "left").fillna(1, ["_sp", "_si"])
        return (df.withColumn(own, F.pmod(F.xxhash64(*by), F.col(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))).drop("_sp", "_si"))

    p = dealt(p, "_p", "_sp", "_i", "_si", ["_us", "_row"])
    i = dealt(i, "_i", "_si", "_p", "_sp", ["_from", "_to", "_found"])
    met = p.join(i, [*at, "_p", "_i"]).where((F.col("_from") <= F.col("_us")) & (F.col("_us") < F.col("_to")))
    return met.select(*[F.col(f"_row._c{n}").alias(c) for n, c in enumerate(points.columns)],
                      *[F.col(f"_found._v{n}").alias(f"{prefix}{v}") for n, v in enumerate(values)])
