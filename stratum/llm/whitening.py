"""Embedding whitening (13): leading components of a distributed covariance.

1. Every usable vector becomes integers x = floor(256 c), packed in the least of
   16, 32 or 64 bits.  The fit list is each distinct packed vector once.
2. One pass over the fit list gives n and the exact sums S, a second one the
   covariance: tasks add up (x - S/n)(x - S/n)^T, centred before multiplying,
   and their matrices are added row by row in a shuffle.
3. The matrix, of the size of one vector squared whatever the corpus, comes to
   the driver; ``symmetric_eigen`` gives the leading components.
4. The projection (vector length x components) goes out with the tasks.  The
   covariance of the whitened fit list is measured by Spark's ``covar_pop``.

What reaches the driver or is sent to the tasks is bounded by ``MAX_LENGTH``; longer
vectors are refused with an error.

Defined results: vectors that are null, empty or hold null, NaN or infinite
entries take no part; neither do those of another length than the most frequent
one (the longer, if tied).  Entries beyond 64-bit integers count as the nearest
of them.  A component without variance has no direction to scale: ``whitened``
is null, ``explained`` 0, and ``identity_error`` covers the others (null if
there are none).  Null and repeated ids stay as they are; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .symmetric_eigen import leading

COMPONENTS, SCALE, MAX_LENGTH = 4, 256, 4096
_TOP = 2.0 ** 63


# ---- packed integer vectors --------------------------------------------------------

def _pack(x: np.ndarray) -> list[bytes]:
    """Rows as bytes; equal rows are equal bytes, since the width follows the row."""
    low, high = x.min(1), x.max(1)
    out: list[bytes] = [b""] * len(x)
    done = np.zeros(len(x), bool)
    for kind in ("<i2", "<i4", "<i8"):
        info = np.iinfo(kind)
        rows = np.flatnonzero(~done & (low >= info.min) & (high <= info.max))
        done[rows] = True
        raw, step = x[rows].astype(kind).tobytes(), x.shape[1] * np.dtype(kind).itemsize
        for at, row in enumerate(rows.tolist()):
            out[row] = raw[at * step:(at + 1) * step]
    return out


def _unpack(column: pa.Array, length: int) -> np.ndarray:
    """Packed vectors as a matrix of 64-bit integers."""
    rows = column.to_pylist()
    x = np.empty((len(rows), length), np.int64)
    width = np.fromiter(map(len, rows), np.int64, len(rows)) // length
    for kind in (2, 4, 8):
        at = np.flatnonzero(width == kind)
        if len(at):
            x[at] = np.frombuffer(b"".join([rows[i] for i in at.tolist()]), f"<i{kind}").reshape(-1, length)
    return x


def _integers(length: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                kept = part.filter(pa.compute.equal(pa.compute.list_value_length(part.column(1)), length))
                flat = kept.column(1).flatten()
                c = flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, length)   # null: NaN
                fine = np.isfinite(c).all(1)
                whole = np.floor(scale * c[fine])
                x = np.where(whole >= _TOP, 2 ** 63 - 1, np.clip(whole, -_TOP, np.nextafter(_TOP, 0)).astype(np.int64))
                if len(x):
                    yield pa.RecordBatch.from_arrays(
                        [kept.column(0).filter(pa.array(fine)), pa.array(_pack(x), pa.binary())], ["vec_id", "x"])

    return run


def vector_length(vectors: DataFrame) -> int:
    """The most frequent length of the vectors; 0 if there is none."""
    size = F.size("embedding")
    common = vectors.filter(size > 0).groupBy(size.alias("n")).agg(F.count(F.lit(1)).alias("rows")) \
        .orderBy(F.desc("rows"), F.desc("n")).first()
    return common.n if common else 0


def integer_vectors(vectors: DataFrame, length: int, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the usable vectors as packed integers."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").filter(F.size("embedding") == length).mapInArrow(
        _integers(length, scale), f"vec_id {kind}, x binary")


# ---- the fit -------------------------------------------------------------------------

@dataclass(frozen=True)
class Fit:
    length: int
    n: int
    sums: tuple[int, ...]           # exact
    mean: np.ndarray
    values: np.ndarray              # eigenvalues, falling
    vectors: np.ndarray             # unit eigenvectors as columns
    trace: float

    @property
    def scaled(self) -> np.ndarray:
        """The vectors over the root of their eigenvalue; NaN where there is no variance."""
        noise = self.length * np.finfo(float).eps * self.trace
        return self.vectors / np.sqrt(np.where(self.values > noise, self.values, np.nan))


def _sums(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(length, object)
        for batch in batches:
            x = _unpack(batch.column(0), length)
            if len(x):
                top = max(abs(int(x.min())), abs(int(x.max())))
                total = total + (x.sum(0) if top * len(x) < 2 ** 62 else x.astype(object).sum(0)).astype(object)
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(range(length), pa.int32()), pa.array([n] * length, pa.int64()),
                pa.array([int(t) for t in total], pa.decimal128(38))], ["i", "n", "s"])

    return run


def _products(length: int, mean: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length, length))
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                centred = _unpack(batch.column(0).slice(at, 4000), length) - mean
                total += centred.T @ centred
        for i in range(0, length, 64):
            rows = total[i:i + 64]
            yield pa.RecordBatch.from_arrays([
                pa.array(range(i, i + len(rows)), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["i", "row"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the rows with the same number, as they stream by."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            row = np.frombuffer(raw)
            total[i] = total[i] + row if i in total else row
    if total:
        yield pa.RecordBatch.from_arrays([
            pa.array(list(total), pa.int32()), pa.array([r.tobytes() for r in total.values()], pa.binary())], ["i", "row"])


def fit(listed: DataFrame, length: int, components: int = COMPONENTS) -> Fit | None:
    """The components of the distinct packed vectors ``listed`` (x); None without any."""
    if length > MAX_LENGTH:
        raise ValueError(f"vectors of {length} entries; at most {MAX_LENGTH} are taken")
    sums = listed.mapInArrow(_sums(length), "i int, n long, s decimal(38,0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()       # one row an entry
    if not sums:
        return None
    n, exact = sums[0].n, tuple(int(r.s) for r in sums)
    mean = np.array([s / n for s in exact])
    rows = listed.mapInArrow(_products(length, mean), "i int, row binary").repartition("i").mapInArrow(
        _added, "i int, row binary").collect()                                     # one row an entry
    covariance = np.empty((length, length))
    for r in rows:
        covariance[r.i] = np.frombuffer(r.row) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading(covariance, components)
    return Fit(length, n, exact, mean, values, vectors, float(np.trace(covariance)))


def _projected(found: Fit):
    k = len(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                w = (_unpack(batch.column(0).slice(at, 4000), found.length) - found.mean) @ found.scaled
                yield pa.RecordBatch.from_arrays([pa.array(w[:, j]) for j in range(k)], [f"w{j}" for j in range(k)])

    return run


def identity_error(listed: DataFrame, found: Fit) -> float | None:
    """The largest entry, in size, of the whitened fit list's covariance minus the identity."""
    alive = np.flatnonzero(np.isfinite(found.scaled).all(0)).tolist()
    if not alive:
        return None
    w = listed.mapInArrow(_projected(found), ", ".join(f"w{j} double" for j in range(len(found.values))))
    pairs = [(i, j) for i in alive for j in alive if i <= j]
    got = w.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


# ---- whitened rows ---------------------------------------------------------------------

def _deviation(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Per row the exact sum of (n x - S)^2."""
    top = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if top < 2 ** 62 and top * top * x.shape[1] < 2 ** 63:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(1).tolist()
    d = n * x.astype(object) - np.array(sums, object)
    return (d * d).sum(1).tolist()


def _whitened(found: Fit):
    k = len(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                x = _unpack(part.column(1), found.length)
                w = ((x - found.mean) @ found.scaled).ravel()
                far = np.repeat(np.array([str(d) for d in _deviation(x, found.n, found.sums)], object), k)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(far, pa.string()), pa.array(w, mask=np.isnan(w))],
                    ["vec_id", "component", "deviation", "whitened"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per
    usable vector and component.  ``deviation`` is a string of digits, exact at any size."""
    spark, length = vectors.sparkSession, vector_length(vectors)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = materialise(integer_vectors(vectors, max(length, 1), scale), "whitening-vectors")
    listed = materialise(rows.select("x").distinct(), "whitening-fit")
    found = fit(listed, max(length, 1), components)
    if found is None:
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation string, "
                                         "whitened double, explained double, identity_error double")
    error = identity_error(listed, found)
    alive = np.isfinite(found.scaled).all(0)
    share = F.array(*[F.lit(float(v / found.trace) if a else 0.0)
                      for v, a in zip(found.values, alive, strict=True)])
    out = rows.mapInArrow(_whitened(found), f"vec_id {kind}, component int, deviation string, whitened double")
    return out.select("vec_id", "component", F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(share, F.col("component") - 1).alias("explained"),
                      F.lit(error).cast("double").alias("identity_error"))


def digest(whitened: DataFrame) -> DataFrame:
    """With ``deviation`` as a long (null beyond 64 bits)."""
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))
