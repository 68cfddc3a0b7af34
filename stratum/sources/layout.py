"""Space-filling table layout (A9): files that are narrow in several columns at once.

Rows are written in the order of a Z-order key: each column is cut into ranges
of about equal counts, and the bits of the range numbers are interleaved.  Rows
near each other in all columns share a file, so a filter on any of them leaves
out most files.  The bounds of every file are kept in a small table beside the
data; ``read_between`` lists the files that can match and reads only these.

Ranges are cut at approximate quantiles, at most ``2 ** bits - 1`` values per
column.  Strings are placed by their first seven bytes; bounds and filters compare
whole strings.  Nulls come first and match no filter.  A value that a
third of all rows hold is spread over files by a hash of the row, the last part
of the sort key, and rows never move from the result: layout decides only where they lie.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.windows import _micros

BITS = 6
ROWS_PER_FILE = 2_000_000


def _place(df: DataFrame, column: str) -> Column:
    """A column's values as numbers in (nearly) the same order."""
    c, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.StringType):
        padded = F.rpad(F.hex(F.encode(c, "UTF-8")), 14, "0")
        return F.conv(padded, 16, 10).cast("long")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return _micros(c)
    return c.cast("double")


def zorder_key(df: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """The interleaved bits of each column's range number; one aggregate over ``df`` finds the ranges."""
    if not 1 <= bits * len(columns) <= 62:
        raise ValueError("bits times columns must lie between 1 and 62")
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    cuts = df.agg(*[F.percentile_approx(_place(df, c), shares, 10_000).alias(f"c{i}")
                    for i, c in enumerate(columns)]).first()         # 2 ** bits - 1 numbers a column
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        number = _range_number(_place(df, c).cast("double"), sorted(set(cuts[i] or [])), bits)
        for b in range(bits):
            bit = F.shiftright(number, b).bitwiseAND(F.lit(1).cast("long"))
            key = key + F.shiftleft(bit, b * len(columns) + i)
    return key


def _range_number(place: Column, cuts: list, bits: int) -> Column:
    """How many of the cuts are at or below a place, stretched to ``bits`` bits if frequent
    values leave fewer cuts, so that every column's first bits divide it; 0 for null."""
    passed = F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda cut: cut <= place)
    stretched = F.floor(F.size(passed) * F.lit(2.0 ** bits / (len(cuts) + 1)))
    return F.when(place.isNull(), 0).otherwise(stretched).cast("long")


def _bounds_path(path: str) -> str:
    return path.rstrip("/") + "_bounds"


def write_zorder(df: DataFrame, path: str, columns: list[str], rows_per_file: int = ROWS_PER_FILE, bits: int = BITS) -> None:
    """Write ``df`` in Z-order of ``columns``, and the bounds of its files."""
    files = max(1, ceil(df.count() / rows_per_file))
    hashable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    laid = df.withColumns({"_z": zorder_key(df, columns, bits), "_h": F.xxhash64(*[F.col(f"`{c}`") for c in hashable])})
    (laid.repartitionByRange(files, "_z", "_h").sortWithinPartitions("_z", "_h").drop("_z", "_h")
     .write.mode("overwrite").option("compression", "snappy").parquet(path))
    held = df.sparkSession.read.schema(df.schema).parquet(path).select(
        F.col("_metadata.file_path").alias("file"), *columns)
    held.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[f(c).alias(f"{name}_{c}") for c in columns for f, name in ((F.min, "min"), (F.max, "max"))]
    ).coalesce(1).write.mode("overwrite").parquet(_bounds_path(path))


def files_between(spark: SparkSession, path: str, between: dict[str, tuple]) -> DataFrame:
    """(file, n_rows) of the files that can hold rows with every column inside its closed range."""
    held = spark.read.parquet(_bounds_path(path))
    for c, (lo, hi) in between.items():
        held = held.where((F.col(f"max_{c}") >= F.lit(lo)) & (F.col(f"min_{c}") <= F.lit(hi)))
    return held.select("file", "n_rows")


def read_between(spark: SparkSession, path: str, schema: T.StructType, between: dict[str, tuple]) -> DataFrame:
    """The rows whose columns lie in their closed ranges, from the files that can hold some."""
    files = [r.file for r in files_between(spark, path, between).collect()]     # names, as any file listing
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for c, (lo, hi) in between.items():
        rows = rows.where(F.col(c).between(F.lit(lo), F.lit(hi)))
    return rows
