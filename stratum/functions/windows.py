"""Neighbour-row lookups per key that stay exact when one key is very large.

``Window.partitionBy(key)`` sends all rows of a key to one task.  Here rows
are windowed only inside (key, time bucket); the neighbour of a bucket's
first (or last) row comes from a per-(key, bucket) summary - one row per
bucket - windowed per key.  A key that holds a third of the data but spans
many buckets is thus spread over many tasks, and the answer is identical
to a plain ``lag`` / ``lead`` over the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def neighbour(df: DataFrame, keys: list[str], ts_col: str, tiebreak: list[Column],
              values: list[str], direction: str = "prev", prefix: str = "prev_",
              bucket_seconds: int = 86_400) -> DataFrame:
    """Add ``<prefix><v>`` = value of the previous (or next) row of the same key.

    Order within a key is (ts_col, *tiebreak); ties must be broken by the
    tiebreak columns for the result to be deterministic.
    """
    order = [F.col("_us")] + [t.alias(f"_t{i}") for i, t in enumerate(tiebreak)]
    rows = (df.withColumn("_us", _micros(F.col(ts_col)))
            .withColumn("_b", F.floor(F.col("_us") / (bucket_seconds * 1_000_000)).cast("bigint")))
    for i, t in enumerate(tiebreak):
        rows = rows.withColumn(f"_t{i}", t)
    ocols = ["_us"] + [f"_t{i}" for i in range(len(tiebreak))]
    asc = direction == "prev"
    sort = [F.col(c).asc() if asc else F.col(c).desc() for c in ocols]
    wb = Window.partitionBy(*keys, "_b").orderBy(*sort)
    rows = rows.withColumn("_edge", F.row_number().over(wb) == 1)
    for v in values:
        rows = rows.withColumn(f"_loc_{v}", F.lag(v).over(wb))
    # per (key, bucket): its last row in travel direction = the neighbour of the next bucket's edge row
    key_struct = F.struct(*[F.col(c) for c in ocols], *[F.col(v) for v in values])
    edge = F.max(key_struct) if asc else F.min(key_struct)
    summary = rows.groupBy(*keys, "_b").agg(edge.alias("_end"))
    wk = Window.partitionBy(*keys).orderBy(F.col("_b").asc() if asc else F.col("_b").desc())
    summary = summary.select(*[F.col(c).alias(f"_s_{c}") for c in (*keys, "_b")],
                             F.lag("_end").over(wk).alias("_from_prev_bucket"))
    # Null-safe: rows without a key or a time keep their place (nulls are one bucket).
    same = F.lit(True)
    for c in (*keys, "_b"):
        same = same & rows[c].eqNullSafe(summary[f"_s_{c}"])
    out = rows.join(summary, same).drop(*[f"_s_{c}" for c in (*keys, "_b")])
    for v in values:
        out = out.withColumn(f"{prefix}{v}", F.when(F.col("_edge"), F.col(f"_from_prev_bucket.{v}"))
                             .otherwise(F.col(f"_loc_{v}")))
    drop = ["_us", "_b", "_edge", "_from_prev_bucket"] + [f"_t{i}" for i in range(len(tiebreak))] \
        + [f"_loc_{v}" for v in values]
    return out.drop(*drop)
