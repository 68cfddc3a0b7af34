"""Z-order layout (A9): what is read, how many files and row groups a filter leaves out."""

from datetime import datetime, timedelta

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from stratum.session import scratch_path
from stratum.sources import layout
from stratum.streaming.sinks import fresh_dir

T0 = datetime(2024, 1, 1)
SCHEMA = "id int, tenant string, t timestamp_ntz"


def events(spark, n=40_000):
    """Tenants in turn, one of them with a third of the rows; times in an order of their own."""
    return spark.range(n).selectExpr(
        "cast(id AS int) AS id", "CASE WHEN id % 3 = 0 THEN '7' ELSE cast(id * 13 % 25 AS string) END AS tenant",
        "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, cast(id * 7919 % 2400 AS int)) AS t")


def written(spark, df, by, **args):
    path = f"{fresh_dir(scratch_path(spark, 'tests'), 'layout')}/t"
    layout.write_zorder(df, path, by, **args)
    return path


def test_filters_leave_out_most_files_and_row_groups(spark):
    df = events(spark)
    path = written(spark, df, ["tenant", "t"], rows_per_file=1000)
    by_time = written(spark, df, ["t"], rows_per_file=1000)
    files = spark.read.parquet(path + "_bounds")
    assert 30 <= files.count() <= 40 and files.agg(F.sum("n_rows")).first()[0] == 40_000
    assert files.agg(F.max("n_rows")).first()[0] < 3000          # the hot tenant is spread
    tenant, days = {"tenant": ("12", "12")}, {"t": (T0 + timedelta(days=40), T0 + timedelta(days=44))}
    touched = {name: layout.files_between(spark, path, f).count() for name, f in
               (("tenant", tenant), ("days", days), ("both", tenant | days))}
    assert touched["both"] <= 4 and touched["tenant"] <= 12 and touched["days"] <= 16, touched
    # The same table by time alone, and as it came, cannot leave out files by tenant.
    plain = f"{path}_plain"
    df.repartition(40).write.parquet(plain)

    def row_groups(at, tenant_id):
        hit = 0
        for f in spark.read.parquet(at).inputFiles():
            meta = pq.ParquetFile(f.removeprefix("file://")).metadata
            for g in range(meta.num_row_groups):
                s = next(meta.row_group(g).column(c).statistics for c in range(meta.num_columns)
                         if meta.row_group(g).column(c).path_in_schema == "tenant")
                hit += s.min <= tenant_id <= s.max
        return hit
    assert row_groups(path, "12") <= 12 and row_groups(by_time, "12") >= 30 and row_groups(plain, "12") == 40


def test_reads_what_a_plain_filter_reads(spark):
    df = events(spark).withColumn("tenant", F.when(F.col("id") % 11 != 0, F.col("tenant"))) \
        .withColumn("t", F.when(F.col("id") % 13 != 0, F.col("t")))
    df = df.unionByName(df.where("id < 50"))           # repeated rows
    path = written(spark, df, ["tenant", "t"], rows_per_file=2000)
    key = ["id", "tenant", "t"]
    assert spark.read.parquet(path).exceptAll(df).count() == df.exceptAll(spark.read.parquet(path)).count() == 0
    f = {"tenant": ("1", "15"), "t": (T0 + timedelta(days=3), T0 + timedelta(days=30))}
    want = df.where(F.col("tenant").between("1", "15") & F.col("t").between(*map(F.lit, f["t"])))
    got = layout.read_between(spark, path, df.schema, f)
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))
    none = layout.read_between(spark, path, df.schema, {"tenant": ("zz", "zzz")})
    assert none.count() == 0 and none.schema == df.schema


def test_empty_and_constant_tables(spark):
    empty = written(spark, spark.createDataFrame([], SCHEMA), ["tenant", "t"])
    assert layout.read_between(spark, empty, events(spark).schema, {"tenant": ("a", "b")}).count() == 0
    same = spark.range(3000).selectExpr("1 AS id", "cast(NULL AS string) AS tenant", "timestamp_ntz '2024-01-01' AS t")
    path = written(spark, same, ["tenant", "t"], rows_per_file=1000)
    assert layout.read_between(spark, path, same.schema, {"t": (T0, T0)}).count() == 3000


def test_key_orders_numbers_strings_and_times(spark):
    df = spark.range(4096).selectExpr("cast(id AS double) AS x")
    key = layout.zorder_key(df, ["x"])
    rows = df.withColumn("z", key).orderBy("x").collect()
    assert [r.z for r in rows] == sorted(r.z for r in rows) and len({r.z for r in rows}) >= 60
