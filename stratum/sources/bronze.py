"""Bronze change files (A2, A3): headerless CSV, all text, op + commit time first.

Layout per table: ``col0`` = op (I/U/D), ``col1`` = commit timestamp, then
the table's columns in physical (migration) order, foreign keys last.
Reading uses an explicit all-string schema (no inference) and RFC-4180
quoting, so JSON documents containing commas stay in one column.  GZIP is
decoded by the CSV source; since gzip is not splittable, a job should
rewrite Bronze to Parquet once (``sinks.write_parquet``) and scan that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Physical column order of each application table after op / commit time.
LAYOUT: dict[str, list[str]] = {
    "tenant": ["id", "name", "slug", "domain", "is_active", "settings", "created_at", "updated_at"],
    "customer": ["id", "email", "first_name", "last_name", "phone", "is_active", "metadata",
                 "created_at", "updated_at", "tenant_id"],
    "product": ["id", "sku", "name", "description", "category", "price", "cost", "stock_quantity",
                "is_active", "created_at", "updated_at", "tenant_id"],
    "order": ["id", "order_number", "status", "subtotal", "tax", "shipping", "total", "order_date",
              "completed_at", "metadata", "created_at", "updated_at", "customer_id", "tenant_id"],
    "orderitem": ["id", "quantity", "unit_price", "discount", "total", "created_at", "updated_at",
                  "order_id", "product_id"],
    "event": ["id", "event_type", "event_data", "session_id", "ip_address", "user_agent",
              "created_at", "customer_id", "tenant_id"],
    "subscription": ["id", "plan_name", "status", "start_date", "end_date", "monthly_amount",
                     "billing_cycle", "created_at", "updated_at", "customer_id", "tenant_id"],
    "invoice": ["id", "invoice_number", "amount", "status", "issue_date", "due_date", "paid_date",
                "created_at", "updated_at", "customer_id", "subscription_id", "tenant_id"],
}

# Application table name of each entity (A4 selects tables by this prefix).
TABLE_NAMES = {e: f"core_{e}" for e in LAYOUT}

CORRUPT = "_corrupt_record"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def bronze_schema(entity: str) -> T.StructType:
    n = len(LAYOUT[entity]) + 2
    return T.StructType([T.StructField(f"col{i}", T.StringType()) for i in range(n)])


def _as_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, TS_FORMAT)
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def to_bronze(changes: DataFrame, entity: str) -> DataFrame:
    """Format an (op, commit_ts, <source columns>) frame as positional Bronze text."""
    types = dict((f.name, f.dataType) for f in changes.schema.fields)
    cols = [F.col("op").alias("col0"), _as_text(F.col("commit_ts"), types["commit_ts"]).alias("col1")]
    for i, name in enumerate(LAYOUT[entity]):
        cols.append(_as_text(F.col(name), types[name]).alias(f"col{i + 2}"))
    return changes.select(*cols)


def inserts_of(source: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """A full-load change frame: every source row as op 'I' at its creation time."""
    return source.select(F.lit("I").alias("op"), F.col(ts_col).alias("commit_ts"), "*")


def name_columns(bronze: DataFrame, entity: str) -> DataFrame:
    """A3: positional ``colN`` -> semantic names (op, commit_ts, table columns).

    The commit timestamp is parsed here (``try_cast``: a bad value becomes
    NULL instead of failing the job); table columns stay text for Silver.
    """
    names = ["op", "commit_ts"] + LAYOUT[entity]
    out = [F.col(f"col{i}").alias(n) for i, n in enumerate(names)]
    out[1] = F.col("col1").try_cast("timestamp_ntz").alias("commit_ts")
    # The row's place in the change files, if the scan gave it, orders changes of one commit.
    return bronze.select(*out, *[c for c in ("seq",) if c in bronze.columns])


def split_bronze(raw: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """A2: the named rows that can be processed, and the rest with its ``fault``.

    ``raw`` is a ``read_bronze_csv`` scan.  Faults: ``malformed`` (too few or too
    many fields), ``unknown_op``, ``no_key``, ``no_commit_time``.  Every row is
    in exactly one of the two.
    """
    fault = (F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
             .when(~F.coalesce(F.col("col0").isin("I", "U", "D"), F.lit(False)), F.lit("unknown_op"))
             .when(F.col("col2").isNull() | (F.col("col2") == ""), F.lit("no_key"))
             .when(F.col("col1").try_cast("timestamp_ntz").isNull(), F.lit("no_commit_time")))
    marked = raw.withColumn("fault", fault)
    kept = name_columns(marked.where(F.col("fault").isNull()), entity)
    out = marked.where(F.col("fault").isNotNull()).select(
        "fault", F.col("col0").alias("op"), F.col("col2").alias("id"), "seq",
        F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[f"col{i}" for i in range(len(LAYOUT[entity]) + 2)]))).alias("line"))
    return kept, out


def write_bronze_csv(bronze: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write positional Bronze rows as headerless, gzip-compressed CSV.

    Values are written verbatim: the CSV writer's default trimming of
    leading/trailing blanks is switched off.
    """
    (bronze.write.mode(mode).option("header", "false").option("quote", '"')
     .option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").option("compression", "gzip").csv(path))


def bronze_paths(root: str, entity: str, schema: str = "public") -> tuple[str, str]:
    """A2: (full-load folder, change folder) of one table under the Bronze root.

    Full-load files go under ``<root>/<schema>/<table>``; ongoing changes
    go under the separate ``<root>/cdc/<schema>/<table>`` folder.
    """
    table = TABLE_NAMES[entity]
    return f"{root}/{schema}/{table}", f"{root}/cdc/{schema}/{table}"


def bronze_glob(root: str, entity: str, schema: str = "public") -> str:
    """One path pattern covering a table's full-load and change folders
    (for a file stream, which watches a single path)."""
    return f"{root}/{{{schema},cdc/{schema}}}/{TABLE_NAMES[entity]}"


def read_bronze_csv(spark: SparkSession, path: str | list[str], entity: str) -> DataFrame:
    """A2: scan Bronze change files (one folder, or the full-load and change
    folders together) with an explicit all-string schema.

    A line with too few or too many fields is kept whole in ``_corrupt_record``;
    ``seq`` is the row's place: file name, then position in the file (files of a
    change feed are named in time order).
    """
    schema = bronze_schema(entity).add(CORRUPT, "string")
    rows = (spark.read.schema(schema).option("header", "false")
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", "false")      # fields are counted only when all are parsed
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
            .csv(path))
    position = F.format_string("%014d", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return rows.select("*", F.concat_ws("#", F.col("_metadata.file_name"),
                                        F.format_string("%014d", F.col("_metadata.file_block_start")), position).alias("seq"))


def naive_split(bronze_lines: DataFrame, entity: str, line_col: str = "value") -> DataFrame:
    """Split raw lines on every comma, ignoring quotes (how a quote-unaware
    reader sees them): JSON documents spill into extra columns (defect D13).

    Returns ``parts`` (array<string>) and ``n_parts``.
    """
    return bronze_lines.select(F.split(F.col(line_col), ",").alias("parts")) \
        .withColumn("n_parts", F.size("parts"))


def lines_unquoted(bronze: DataFrame) -> DataFrame:
    """Positional Bronze rows joined with bare commas (one ``value`` per row)."""
    cols = [c for c in bronze.columns]
    return bronze.select(F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in cols]).alias("value"))
