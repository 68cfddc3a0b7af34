"""Approximate nearest neighbours (7): a robust-pruned directed graph per shard.

``build_index`` indexes every distinct usable vector: vectors are dealt to
shards by norm (within a factor of 2) and hash, and each shard builds a graph in
which greedy searches propose neighbours and relaxed distance pruning keeps
diverse edges.  Distances on a sphere that must hold norms of very different
size tell little apart, hence the shards by norm.  ``search`` runs a beam search
for every query in every shard of its dimension, takes the products again in
double precision on the original vectors and keeps the best over all shards.

A search task meets a shard first and then streams its queries, so the index is
shuffled once if there are at least as many shards as shuffle partitions,
however many queries there are; with fewer shards it is copied to fill them.

Equal vectors are one point of the graph with the ids of its rows.  Of the ids
of one vector only the ``k + 1`` smallest can ever be among a query's k nearest
(ties go to the smaller id, and the query's own row takes one place), so more
are not carried; this drops no result, however often a vector repeats.

Defined results: null or zero vectors and vectors with a null or non-finite
component, or without components, take no part; neither do rows without an id;
rows that repeat both id and vector count once; a query's own row means all
rows of its id; vectors meet only vectors of the same length; with fewer than
k candidates all are returned; an empty table gives an empty result; columns
other than the id and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .vector_graph import Graph, lifted

SHARD_POINTS = 12_000
QUERY_BLOCK = 4_000
INDEX = ("dim int, shard bigint, n int, vectors binary, near binary, start int, degree int, "
         "ids array<bigint>, id_ends array<int>")


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v) with v the vector in double precision; unusable rows left out."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.coalesce(finite, F.lit(False))).filter(
        F.exists("v", lambda x: x != 0)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))


def _points(rows: DataFrame, copies: int) -> DataFrame:
    """(v, ids): distinct vectors with the smallest ids of their rows."""
    place = Window.partitionBy("v").orderBy("vec_id")
    few = rows.select("vec_id", "v").distinct().withColumn("place", F.row_number().over(place)) \
        .filter(F.col("place") <= copies)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _band(v: Column) -> Column:
    """The power of two nearest to a vector's norm; unit vectors lie in the middle of a band."""
    largest = F.array_max(F.transform(v, F.abs))
    squares = F.aggregate(v, F.lit(0.0), lambda total, x: total + (x / largest) * (x / largest))
    return F.floor(F.log2(largest) + F.log2(squares) / 2 + 0.5).cast("long")


def _build(degree: int, beam: int, relax: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim, shard = (k.as_py() for k in key)
        x = np.ascontiguousarray(table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
                                 .reshape(-1, dim))
        ids = table["ids"].to_pylist()
        order = sorted(range(len(ids)), key=lambda i: ids[i])   # the same graph whatever the row order
        x, ids = x[order], [ids[i] for i in order]
        graph = Graph(lifted(x), degree, beam, relax).build()
        ends = np.cumsum([len(i) for i in ids])
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int64()),
            "n": pa.array([len(ids)], pa.int32()), "vectors": pa.array([x.astype("<f8").tobytes()], pa.binary()),
            "near": pa.array([graph.near.astype("<i4").tobytes()], pa.binary()),
            "start": pa.array([graph.start], pa.int32()), "degree": pa.array([degree], pa.int32()),
            "ids": pa.array([[i for own in ids for i in own]], pa.list_(pa.int64())),
            "id_ends": pa.array([ends.tolist()], pa.list_(pa.int32()))})

    return run


def build_index(vectors: DataFrame, k: int = 20, shard_points: int = SHARD_POINTS, degree: int = 32,
                beam: int = 64, relax: float = 1.2) -> DataFrame:
    """One row per shard: vectors, graph and row ids; every usable vector is in."""
    points = materialise(_points(usable(vectors), k + 1).select(
        F.size("v").alias("dim"), _band(F.col("v")).alias("band"), "v", "ids"), "ann-points")
    sizes = points.groupBy("dim", "band").agg(F.ceil(F.count(F.lit(1)) / shard_points).alias("parts"))
    dealt = points.join(sizes, ["dim", "band"]).select(
        "dim", (F.col("band") * 2 ** 32 + F.pmod(F.xxhash64("v"), F.col("parts"))).alias("shard"), "v", "ids")
    return materialise(dealt.groupBy("dim", "shard").applyInArrow(_build(degree, beam, relax), INDEX), "ann-index")


class _Shard:
    """A shard's graph, vectors and ids, read from its index row."""

    def __init__(self, row: pa.RecordBatch):
        one = {c: row.column(c)[0] for c in ("dim", "n", "vectors", "near", "start", "degree", "ids", "id_ends")}
        n, self.dim = one["n"].as_py(), one["dim"].as_py()
        self.x = np.frombuffer(one["vectors"].as_buffer(), "<f8").reshape(n, self.dim)
        self.graph = Graph(lifted(self.x), one["degree"].as_py())
        self.graph.near = np.frombuffer(one["near"].as_buffer(), "<i4").reshape(n, -1)
        self.graph.start = one["start"].as_py()
        self.ids = one["ids"].values.to_numpy()
        self.ends = one["id_ends"].values.to_numpy()
        self.starts = np.r_[0, self.ends[:-1]]

    def nearest(self, own_ids: list[int], q: np.ndarray, k: int, beam: int) -> Iterator[tuple[int, int, float]]:
        """(query, vec_id, score) of the k nearest found for each query."""
        # Search does not depend on scale; a largest component of 1 keeps single precision in range.
        unit = q / np.abs(q).max(1, keepdims=True)
        flat = np.hstack([unit, np.zeros((len(q), 1))]).astype(np.float32)
        found, _ = self.graph.search(flat, max(beam, k + 1))
        for own, vec, cand in zip(own_ids, q, found, strict=True):
            cand = cand[cand >= 0]
            score = (self.x[cand] * vec).sum(1)
            best = np.argsort(-score, kind="stable")
            # All points that tie with the last one needed must stay.
            last = score[best[min(k, len(best) - 1)]] if len(best) else 0.0
            rows = sorted((-s, int(i)) for c, s in zip(cand, score, strict=True) if s >= last
                          for i in self.ids[self.starts[c]:self.ends[c]] if i != own)
            for s, i in rows[:k]:
                yield own, i, -s


def _search(k: int, beam: int, rows: int = 256):
    """Every index row is followed by the queries of its shard (and part of the queries)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_hand, shard = None, None
        for batch in batches:
            heads = np.flatnonzero(~np.asarray(batch.column("is_query").to_pylist(), bool)).tolist()
            cuts = sorted({0, batch.num_rows, *heads, *(h + 1 for h in heads)})
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo in heads:
                    at_hand, shard = batch.slice(lo, 1), None     # read when its first query comes
                    continue
                shard = shard or _Shard(at_hand)
                for at in range(lo, hi, rows):
                    some = batch.slice(at, min(rows, hi - at))
                    q = some.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, shard.dim)
                    found = list(shard.nearest(some.column("vec_id").to_pylist(), q, k, beam))
                    own, ids, scores = zip(*found, strict=True) if found else ((), (), ())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())],
                        ["query_id", "vec_id", "score"])

    return run


def search(queries: DataFrame, index: DataFrame, k: int = 20, beam: int = 128,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found.

    ``queries`` has vec_id and v (see ``usable``).  Where shards are fewer than shuffle
    partitions, a shard's queries are dealt to copies of it, at least about ``query_block`` to
    each; a task holds one shard and one batch of queries.
    """
    asked = materialise(queries.select("vec_id", "v").distinct(), "ann-queries")
    tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_shards = max(1, index.count())
    copies = max(1, min(-(-tasks // n_shards), -(-asked.count() // query_block)))
    shards = index.groupBy("dim").agg(F.collect_set("shard").alias("shards"))
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(copies)).cast("int")
    sent = asked.select("vec_id", "v", F.size("v").alias("dim"), block.alias("block")).join(shards, "dim") \
        .select(F.lit(True).alias("is_query"), "dim", F.explode("shards").alias("shard"), "block", "vec_id", "v")
    held = index.select(F.lit(False).alias("is_query"), "*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("block"))
    keys = ("dim", "shard", "block")
    met = held.unionByName(sent, allowMissingColumns=True).repartition(tasks, *keys).sortWithinPartitions(*keys, "is_query")
    found = met.mapInArrow(_search(k, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
