"""Row-by-row reconciliation of two tables (E3): what differs, found by digests.

Both tables are reduced to a digest of ``buckets`` buckets of the key: how many rows,
and the sums of two hashes of the rows.  Sums do not depend on order and count repeated rows, so
equal tables have equal digests, and the check ends there.  Otherwise only the
rows of buckets that differ are compared, as multisets: rows are counted on both
sides by their whole content, and those with equal counts drop out.  Different tables pass as equal
only if both sums of 64-bit hashes agree in every bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged

BUCKETS = 4096


def _hash(columns: list[str], seed: int) -> Column:
    # The hash skips NULLs, so where they stand goes in as well.
    holes = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), holes, *[F.col(f"`{c}`") for c in columns])


def _bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(_hash(key, 7), F.lit(buckets)).cast("int")


def digest(rows: DataFrame, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, h1, h2): at most ``buckets`` rows, whatever the table."""
    sums = [F.sum(_hash(rows.columns, i).cast("decimal(38,0)")).alias(f"h{i}") for i in (1, 2)]
    return rows.groupBy(_bucket(key, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), *sums)


def differing_buckets(left: DataFrame, right: DataFrame, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The buckets whose digests are not the same."""
    sides = digest(left, key, buckets).select("*", F.lit(1).alias("sign")).unionByName(
        digest(right, key, buckets).select("*", F.lit(-1).alias("sign")))
    sums = [F.sum(F.col(c) * F.col("sign")).alias(c) for c in ("n", "h1", "h2")]
    return sides.groupBy("bucket").agg(*sums).where("n <> 0 OR h1 <> 0 OR h2 <> 0").select("bucket")


def diff(left: DataFrame, right: DataFrame, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per key that differs: key, ``change``, ``columns``, ``left_rows``, ``right_rows``.

    ``change`` is ``removed`` (only on the left), ``added`` (only on the right), ``changed``
    (other content) or ``recount`` (the same rows, not as often).  ``columns``
    names the columns that differ, in the table's order, where a key has one
    row on each side.  The row counts are of the rows that differ.  Both tables have
    the same columns; keys may be NULL.
    """
    if left.columns != right.columns:
        raise ValueError("the tables have different columns")
    rest = [c for c in left.columns if c not in key]
    names = [f"_k{i}" for i in range(len(key))]
    found = staged(differing_buckets(left, right, key, buckets), "diff-buckets")

    def touched(df: DataFrame, sign: int) -> DataFrame:
        bucketed = df.withColumn("_bucket", _bucket(key, buckets))
        some = bucketed.join(found, bucketed["_bucket"] == found["bucket"], "left_semi")
        return some.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(key, names, strict=True)],
                           F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]).alias("_row"),
                           F.lit(sign).alias("_side"))

    columns = "columns string, left_rows long, right_rows long"
    if found.isEmpty():        # equal: no row is read again
        kinds = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in key)
        return left.sparkSession.createDataFrame([], f"{kinds}, change string, {columns}")
    both = touched(left, 0).unionByName(touched(right, 1))
    side = [F.count_if(F.col("_side") == i).alias(n) for i, n in enumerate(("_l", "_r"))]
    unequal = both.groupBy(*names, "_row").agg(*side).where(F.col("_l") != F.col("_r"))
    per_key = unequal.groupBy(*names).agg(
        F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"),
        F.count_if((F.col("_l") > 0) & (F.col("_r") > 0)).alias("_shared"), F.count(F.lit(1)).alias("_rows"),
        F.max(F.when(F.col("_l") > 0, F.col("_row"))).alias("_a"), F.max(F.when(F.col("_r") > 0, F.col("_row"))).alias("_b"))
    change = (F.when(F.col("_shared") == F.col("_rows"), "recount").when(F.col("right_rows") == 0, "removed")
              .when(F.col("left_rows") == 0, "added").otherwise("changed"))
    single = (F.col("left_rows") == 1) & (F.col("right_rows") == 1)
    cells = F.array_compact(F.array(*[F.when(~F.col(f"_a.c{i}").eqNullSafe(F.col(f"_b.c{i}")), F.lit(c))
                                      for i, c in enumerate(rest)])) if rest else F.array().cast("array<string>")
    return per_key.select(*[F.col(n).alias(k) for n, k in zip(names, key, strict=True)], change.alias("change"),
                          F.when(single, F.array_join(cells, ",")).alias("columns"), "left_rows", "right_rows")


def summary(differences: DataFrame) -> DataFrame:
    """How many keys changed in which way."""
    return differences.groupBy("change").agg(F.count(F.lit(1)).alias("keys"))

