"""Keyed tables kept as a few merged runs, committed together by version.

``RunStore`` holds several keyed tables under one folder:

    <table>/v=<n>            what version n added: new rows, or signed changes of sums
    <table>/m=<n>            runs merged into one while version n was committed
    _manifest/version=<n>    (table, run, rows): which runs make up each table after n

A commit writes only what it adds.  A table is the merge of its runs; the merge must
give the same result in whatever order and grouping rows meet (the latest row per
key, sums per key).  When at least ``FANOUT`` newest runs together are as large as the
one before them they become one run, so a table has a logarithmic number of runs and a
row is rewritten a logarithmic number of times, whatever the size of the table.  Only a
merge of all runs may drop rows that say nothing any more (sums of zero, old
tombstones): ``settle``.

The manifest's ``_SUCCESS`` marker commits all tables at once.  A commit that died
before it left every table as it was and is simply repeated; a version that is
committed is skipped.  The last ``retain`` versions stay readable.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sinks import _Folder

FANOUT, RETAIN = 4, 2
Frame = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Keyed:
    """A table: schema, its merge, and what a merge of all runs leaves."""
    schema: str | StructType
    merge: Frame
    settle: Frame | None = None


def runs_to_merge(rows: list[int], fanout: int = FANOUT) -> int:
    """How many of the newest runs (sizes from old to new) become one; 0 for none."""
    for start in range(len(rows) - fanout + 1):
        if rows[start] <= sum(rows[start + 1:]):
            return len(rows) - start
    return 0


class RunStore:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Keyed],
                 fanout: int = FANOUT, retain: int = RETAIN):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        self.fanout, self.retain = fanout, max(1, retain)
        self._folder = _Folder(spark, self.root)

    # ------------------------------------------------------------ reading
    def versions(self) -> list[int]:
        """Committed versions that are still readable, ascending."""
        return [n for n in self._folder.numbers("_manifest", "version=")
                if self._folder.exists(f"_manifest/version={n}/_SUCCESS")]

    def last(self) -> int | None:
        done = self.versions()
        return done[-1] if done else None

    def _manifest(self, version: int | None) -> dict[str, list[tuple[str, int]]]:
        """Runs of every table from old to new: a few rows for each table."""
        runs: dict[str, list[tuple[str, int]]] = {t: [] for t in self.tables}
        if version is not None:
            rows = self.spark.read.schema("place int, name string, run string, n long").parquet(
                f"{self.root}/_manifest/version={version}").collect()
            for r in sorted(rows, key=lambda r: r.place):
                runs[r.name].append((r.run, r.n))
        return runs

    def _rows(self, table: str, runs: list[str]) -> DataFrame:
        schema = self.tables[table].schema
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{table}/{r}" for r in runs])

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The table as ``version`` (by default the last one) left it."""
        runs = [r for r, _ in self._manifest(self.last() if version is None else version)[table]]
        rows = self._rows(table, runs)
        return rows if len(runs) < 2 else self.tables[table].merge(rows)

    def lookup(self, table: str, keys: DataFrame) -> DataFrame:
        """The rows of the table whose key columns are in ``keys`` (null-safe); they
        are selected run by run, so only they are merged."""
        runs = [r for r, _ in self._manifest(self.last())[table]]
        rows = self._rows(table, runs)
        k = keys.select(*[keys[c].alias(f"_{c}") for c in keys.columns])
        on = [rows[c].eqNullSafe(k[f"_{c}"]) for c in keys.columns]
        return self.tables[table].merge(rows.join(k, on, "left_semi"))

    # ------------------------------------------------------------ writing
    def write(self, table: str, version: int, rows: DataFrame) -> DataFrame:
        """Write what ``version`` adds to a table, not yet committed, and read it back."""
        schema = self.spark.createDataFrame([], self.tables[table].schema).schema
        path = f"{self.root}/{table}/v={version}"
        rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema]).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def scratch(self, name: str, version: int, rows: DataFrame) -> DataFrame:
        """A table of this version only, which goes with it."""
        path = f"{self.root}/_work/{name}/v={version}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(self, version: int, written: list[str]) -> None:
        """Commit the tables ``written`` under ``version``, after merging runs."""
        last = self.last()
        if last is not None and version <= last:
            raise ValueError(f"version {version} comes after version {last} was committed")
        after = self._manifest(last)
        for table in written:
            rows = self._rows(table, [f"v={version}"]).count()      # from the files' footers
            if rows:
                after[table].append((f"v={version}", rows))
            n = runs_to_merge([r for _, r in after[table]], self.fanout)
            if n:
                after[table][-n:] = self._merged(table, version, [r for r, _ in after[table][-n:]], n == len(after[table]))
        rows = [(i, table, run, n) for table, runs in after.items() for i, (run, n) in enumerate(runs)]
        (self.spark.createDataFrame(rows, "place int, name string, run string, n long").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/_manifest/version={version}"))
        self._clean(version)

    def _merged(self, table: str, version: int, runs: list[str], whole: bool) -> list[tuple[str, int]]:
        spec = self.tables[table]
        rows = spec.merge(self._rows(table, runs))
        if whole and spec.settle:
            rows = spec.settle(rows)
        schema = self.spark.createDataFrame([], spec.schema).schema
        rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema]).write.mode("overwrite").parquet(
            f"{self.root}/{table}/m={version}")
        n = self._rows(table, [f"m={version}"]).count()
        return [(f"m={version}", n)] if n else []

    def _clean(self, version: int) -> None:
        """Delete manifests beyond the retained ones, and runs that none of those names."""
        done = self.versions()
        keep = done[-self.retain:]
        used = {(t, r) for v in keep for t, runs in self._manifest(v).items() for r, _ in runs}
        for n in done[:-self.retain]:
            self._folder.delete(f"_manifest/version={n}")
        for table in self.tables:
            for kind in ("v=", "m="):
                for n in self._folder.numbers(table, kind):
                    if n <= version and (table, f"{kind}{n}") not in used:
                        self._folder.delete(f"{table}/{kind}{n}")
        self._folder.delete("_work")


class UpsertTable:
    """A keyed table that micro-batches are merged into, as runs.

    A batch writes its own merged rows, not the buckets or partitions they fall in; rows
    without a complete key are kept apart (``rejected``).
    """

    def __init__(self, spark: SparkSession, target: str, schema: str | StructType, keys: list[str], merge: Frame,
                 settle: Frame | None = None):
        self.keys, self.merge = keys, merge
        self.store = RunStore(spark, target, {"rows": Keyed(schema, merge, settle), "rejected": Keyed(schema, lambda rows: rows)})

    def upsert(self, batch: DataFrame, batch_id: int) -> bool:
        """Merge a batch; False if it was merged before."""
        last = self.store.last()
        if last is not None and batch_id <= last:
            return False
        keyless = F.lit(False)
        for k in self.keys:
            keyless = keyless | F.col(k).isNull()
        batch = batch.persist()
        try:
            self.store.write("rows", batch_id, self.merge(batch.where(~keyless)))
            self.store.write("rejected", batch_id, batch.where(keyless))
        finally:
            batch.unpersist()
        self.store.commit(batch_id, ["rows", "rejected"])
        return True

    def read(self) -> DataFrame:
        return self.store.read("rows")

    def rejected(self) -> DataFrame:
        return self.store.read("rejected")
