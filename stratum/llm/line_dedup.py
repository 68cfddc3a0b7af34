"""Line dedup (3): sharded cuckoo filters over exact reference counts.

State of a ``LineIndex``:
* ``refs``: one row per (line key, document) - the exact references,
* ``counts``: per key the number of documents and the largest doc_id,
* ``filters``: per shard of the key space a cuckoo filter with the keys that
  stand in ``min_docs`` documents or more (the frequent ones).

``insert`` and ``delete`` change the references, recount the keys concerned and
put into or take out of the filters the keys that became frequent or ceased to
be; deleting what was inserted restores references, counts and results, so the
dedup is reversible.  A shard has a fixed size (``n_buckets`` x 8 bytes); the
number of shards follows the frequent keys, ``n_shards`` or a doubling of it, so
that no more than ``LOAD`` of the slots are taken.  When a change asks for more
shards, or for far fewer, or finds a full one, all filters are built anew from
the exact counts, one shard at a time in a task.

``dedup`` asks the filters first.  Up to ``BROADCAST_BYTES`` they travel to all
tasks: documents without a line that may be frequent keep their text and are never
shuffled; the lines of the others are checked against the exact counts.  Filters
beyond that size stay in the shared folder, and the distinct keys of the
documents come to the shards instead, each key once, so a hot line is one row.
A shard whose filter is full answers "maybe" to everything: more lines are then
checked exactly, none is lost.

A line's key is the line without ASCII white space at both ends, A-Z in lower
case; keys under ``min_chars`` code points do not count.  Keys are held as
128-bit hashes.  Frequent keys lose their lines everywhere but in the largest
doc_id that holds them.

Defined results: null or empty text is one empty line and stays as it is;
rows that share a doc_id (null is one id, below all others) are one document;
an empty table gives an empty result; other columns stay, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, materialise, tidy

MIN_CHARS, MIN_DOCS = 40, 5
N_SHARDS, N_BUCKETS, SLOTS = 32, 1 << 14, 4
LOAD, MAX_SHARDS = 0.75, 1 << 16    # a shard is named by 16 bits of the key
BROADCAST_BYTES = 32 << 20          # of all filters that travel to the tasks
MAX_KICKS = 500
_REF = "key binary, doc_id {}"


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    bare = line.strip(SPACE)
    if len(bare) < min_chars:
        return None
    # On bytes, lower() changes A-Z only.
    return hashlib.blake2b(bare.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


def keys_of(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    return [line_key(x, min_chars) for x in (text or "").split("\n")]


class CuckooFilter:
    """16-bit fingerprints in buckets of four; 0 is an empty slot.

    ``slots`` may have more fingerprints put in (``add``) and taken out
    (``remove``).  Displacement follows a fixed rotation, so the same calls
    make the same filter.  A filter that had to refuse a key is ``full``.
    """

    def __init__(self, slots: np.ndarray, full: bool = False):
        self.slots, self.full, self.mask = slots, full, len(slots) - 1

    @classmethod
    def empty(cls, n_buckets: int = N_BUCKETS) -> CuckooFilter:
        return cls(np.zeros((n_buckets, SLOTS), np.uint16))

    @staticmethod
    def hashes(keys: Iterable[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)[:, 0]

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of hashed keys."""
        mark = ((h >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.int64)
        first = (h & np.uint64(self.mask)).astype(np.int64)
        return mark, first, self.other(first, mark)

    def other(self, bucket, mark):
        return bucket ^ ((mark * 0x5BD1E995 >> 7) & self.mask)

    def maybe(self, h: np.ndarray) -> np.ndarray:
        if self.full:
            return np.ones(len(h), bool)
        mark, a, b = self.places(h)
        return ((self.slots[a] == mark[:, None]) | (self.slots[b] == mark[:, None])).any(1)

    def add(self, key: bytes) -> None:
        mark, a, b = (int(x[0]) for x in self.places(self.hashes([key])))
        for bucket in (a, b):
            for s in range(SLOTS):
                if not self.slots[bucket, s]:
                    self.slots[bucket, s] = mark
                    return
        bucket = a
        for kick in range(MAX_KICKS):
            s = kick % SLOTS
            mark, self.slots[bucket, s] = int(self.slots[bucket, s]), mark
            bucket = self.other(bucket, mark)
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = mark
                return
        self.full = True

    def remove(self, key: bytes) -> None:
        """Take out a key that was added (a full filter stays full)."""
        mark, a, b = (int(x[0]) for x in self.places(self.hashes([key])))
        for bucket in (a, b):
            for s in range(SLOTS):
                if self.slots[bucket, s] == mark:
                    self.slots[bucket, s] = 0
                    return

    def to_bytes(self) -> bytes:
        return bytes([self.full]) + self.slots.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw[1:], "<u2").reshape(-1, SLOTS).copy(), bool(raw[0]))


def shard_of(h: np.ndarray, n_shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64) % n_shards


def _shard(key: str, n_shards: int) -> Column:
    """``shard_of`` as a column: bytes 4 and 5 of the key."""
    raw = F.hex(key)
    pair = F.conv(F.concat(F.substring(raw, 11, 2), F.substring(raw, 9, 2)), 16, 10).cast("long")
    return (pair % n_shards).cast("int")


def _sharded(n_buckets: int):
    """Stream of (shard, step, key, old filter), sorted by shard and step, to
    one filter per shard.  Step 0 brings the old filter, 1 removes, 2 adds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([held.to_bytes()], pa.binary())], ["shard", "filter"])

        for batch in batches:
            for s, step, key, old in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s != shard:
                    if held is not None:
                        yield out()
                    shard, held = s, CuckooFilter.empty(n_buckets)
                if step == 0:
                    held = CuckooFilter.from_bytes(old)
                elif step == 1:
                    held.remove(key)
                elif not held.full:
                    held.add(key)
        if held is not None:
            yield out()

    return run


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a stream as above, in which step 1 brings keys to ask for, the keys that
    may be frequent; a shard without a filter has none."""
    shard, held = None, None
    for batch in batches:
        asked: list[bytes] = []
        out: list[bytes] = []

        def answer() -> None:
            if asked and held is not None:
                hit = held.maybe(CuckooFilter.hashes(asked))
                out.extend(k for k, x in zip(asked, hit, strict=True) if x)
            asked.clear()

        for s, step, key, old in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if s != shard:
                answer()
                shard, held = s, None
            if step == 0:
                held = CuckooFilter.from_bytes(old)
            else:
                asked.append(key)
        answer()
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["key"])


class LineIndex:
    """References, counts and filters; every change gives a new index.

    ``shards`` is the number of shards in use, ``n_shards`` the least."""

    def __init__(self, refs: DataFrame, counts: DataFrame, filters: DataFrame,
                 min_chars: int, min_docs: int, n_shards: int, n_buckets: int, shards: int | None = None):
        self.refs, self.counts, self.filters = refs, counts, filters
        self.shards = shards or n_shards
        self.params = dict(min_chars=min_chars, min_docs=min_docs, n_shards=n_shards, n_buckets=n_buckets)

    @classmethod
    def empty(cls, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
              n_shards: int = N_SHARDS, n_buckets: int = N_BUCKETS, id_type: str = "bigint") -> LineIndex:
        return cls(spark.createDataFrame([], _REF.format(id_type)),
                   spark.createDataFrame([], f"key binary, n_docs bigint, last_doc {id_type}"),
                   spark.createDataFrame([], "shard int, filter binary"),
                   min_chars, min_docs, n_shards, n_buckets)

    # -- references ---------------------------------------------------------

    def _references(self, docs: DataFrame) -> DataFrame:
        min_chars = self.params["min_chars"]

        @F.pandas_udf("array<binary>")
        def keys(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            return tidy(lambda given: (texts.map(lambda t: sorted(set(keys_of(t, min_chars)) - {None})) for texts in given))(parts)

        found = docs.select("doc_id", F.explode(keys(F.col("text").cast("string"))).alias("key"))
        return found.select("key", "doc_id").distinct()

    def _recounted(self, refs: DataFrame, touched: DataFrame | None) -> LineIndex:
        """The index with new references; only ``touched`` keys can change."""
        p = self.params
        concerned = refs if touched is None else refs.join(touched, "key", "left_semi")
        fresh = concerned.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        if touched is None:
            counts = materialise(fresh, "line-counts")
            changes = None
        else:
            counts = materialise(self.counts.join(touched, "key", "left_anti").unionByName(fresh), "line-counts")
            was = self.counts.join(touched, "key", "left_semi").filter(F.col("n_docs") >= p["min_docs"]).select("key")
            now = counts.join(touched, "key", "left_semi").filter(F.col("n_docs") >= p["min_docs"]).select("key")
            changes = was.join(now, "key", "left_anti").select("key", F.lit(1).alias("step")).unionByName(
                now.join(was, "key", "left_anti").select("key", F.lit(2).alias("step")))
        frequent = counts.filter(F.col("n_docs") >= p["min_docs"]).select("key")
        needed = self._shards_for(frequent.count())
        if touched is not None and self.shards // 16 < needed <= self.shards and not _any_full(self.filters):
            return LineIndex(refs, counts, self._filled(changes, self.filters, self.shards), **p, shards=self.shards)
        # Built anew; if keys fall together so that a shard is full, with twice the shards.
        anew = frequent.withColumn("step", F.lit(2))
        filters = self._filled(anew, None, needed)
        while 2 * needed <= MAX_SHARDS and _any_full(filters):
            needed *= 2
            filters = self._filled(anew, None, needed)
        return LineIndex(refs, counts, filters, **p, shards=needed)

    def _shards_for(self, n_keys: int) -> int:
        n, room = self.params["n_shards"], LOAD * SLOTS * self.params["n_buckets"]
        while n * room < n_keys and 2 * n <= MAX_SHARDS:
            n *= 2
        return n

    def _filled(self, changes: DataFrame, old: DataFrame | None, n_shards: int) -> DataFrame:
        """The old filters, or empty ones, after changes (key, step)."""
        steps = _stream(changes, old, n_shards).mapInArrow(tidy(_sharded(self.params["n_buckets"])), "shard int, filter binary")
        return materialise(steps, "line-filters")

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add the lines of documents (known references stay single)."""
        new = materialise(self._references(docs), "line-refs-new")
        if self.refs.isEmpty():
            return self._recounted(new, None)
        both = materialise(self.refs.unionByName(new).distinct(), "line-refs")
        return self._recounted(both, new.select("key").distinct())

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Remove all references of the documents named in column doc_id."""
        gone = doc_ids.select(F.col("doc_id").alias("gone_id")).distinct()
        same = self.refs["doc_id"].eqNullSafe(gone["gone_id"])
        touched = materialise(self.refs.join(gone, same, "left_semi").select("key").distinct(), "line-keys")
        rest = materialise(self.refs.join(gone, same, "left_anti"), "line-refs")
        return self._recounted(rest, touched)

    # -- use ----------------------------------------------------------------

    def _filters_on_tasks(self):
        """The filters, at most ``BROADCAST_BYTES``, for all tasks."""
        rows = {r.shard: bytes(r.filter) for r in self.filters.collect()}
        return self.refs.sparkSession.sparkContext.broadcast(rows)

    def dedup(self, docs: DataFrame) -> DataFrame:
        """``docs`` with duplicate lines dropped from text, and two columns more:
        ``__n_lines`` (before dropping) and ``__n_dropped`` (both long)."""
        p = self.params
        n_shards, min_chars = self.shards, p["min_chars"]
        small = n_shards * (8 * p["n_buckets"] + 1) <= BROADCAST_BYTES
        shared = self._filters_on_tasks() if small else None

        def suspected(texts: pd.Series) -> pd.Series:
            filters = _opened(shared)
            per_text = [sorted(set(keys_of(t, min_chars)) - {None}) for t in texts]
            keys = [k for ks in per_text for k in ks]
            hit = np.zeros(len(keys), bool)
            if keys:
                h = CuckooFilter.hashes(keys)
                shards = shard_of(h, n_shards)
                for s, f in filters.items():
                    at = np.flatnonzero(shards == s)
                    hit[at] = f.maybe(h[at])
            out, i = [], 0
            for ks in per_text:
                out.append([k for k, x in zip(ks, hit[i:i + len(ks)], strict=True) if x])
                i += len(ks)
            return pd.Series(out, index=texts.index)

        @F.pandas_udf("array<binary>")
        def maybe_frequent(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            return tidy(lambda given: map(suspected, given))(parts)

        def edited_part(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
            out = []
            for text, drop in zip(texts, drops, strict=True):
                lines = (text or "").split("\n")
                gone = set() if drop is None else set(map(bytes, drop))
                kept = [x for x, k in zip(lines, keys_of(text, min_chars), strict=True) if k not in gone] if gone else lines
                # A text that loses nothing stays what it was, null included.
                out.append((text if len(kept) == len(lines) else "\n".join(kept), len(lines) - len(kept)))
            return pd.DataFrame(out, columns=["text", "n_dropped"])

        @F.pandas_udf("text string, n_dropped bigint")
        def without(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            return tidy(lambda given: (edited_part(*columns) for columns in given))(parts)

        text = F.col("text").cast("string")
        n_lines = F.size(F.split(F.coalesce(text, F.lit("")), "\n", -1)).cast("long")
        frequent = self.counts.filter(F.col("n_docs") >= p["min_docs"]).select("key", "last_doc")
        if small:
            asked = docs.withColumn("__maybe", maybe_frequent(text))
            clean = asked.filter(F.size("__maybe") == 0).drop("__maybe") \
                .withColumn("__n_lines", n_lines).withColumn("__n_dropped", F.lit(0).cast("long"))
            suspect = materialise(asked.filter(F.size("__maybe") > 0), "line-suspects")
            held = suspect.select(F.col("doc_id"), F.explode("__maybe").alias("key")).distinct()
        else:
            clean, suspect = None, docs
            held = materialise(self._references(docs), "line-asked")
            probes = held.select("key").distinct().withColumn("step", F.lit(1))
            maybe = _stream(probes, self.filters, n_shards).mapInArrow(tidy(_probed), "key binary")
            frequent = frequent.join(maybe, "key")
        drops = held.join(frequent, "key").filter(~F.col("doc_id").eqNullSafe(F.col("last_doc"))) \
            .groupBy(F.col("doc_id").alias("__drop_id")).agg(F.collect_list("key").alias("__drops"))
        joined = suspect.join(drops, suspect["doc_id"].eqNullSafe(drops["__drop_id"]), "left") \
            .withColumn("__n_lines", n_lines).withColumn("__new", without(text, F.col("__drops")))
        edited = joined.select(*[
            F.col("__new.text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
            "__n_lines", F.col("__new.n_dropped").alias("__n_dropped"))
        return edited if clean is None else clean.unionByName(edited)


def _any_full(filters: DataFrame) -> bool:
    return not filters.filter(F.hex(F.substring("filter", 1, 1)) == "01").isEmpty()


def _stream(rows: DataFrame, filters: DataFrame | None, n_shards: int) -> DataFrame:
    """Rows (key, step) and filters (step 0), each shard in one task, sorted by shard and step."""
    steps = rows.select(_shard("key", n_shards).alias("shard"), "step", "key", F.lit(None).cast("binary").alias("old"))
    if filters is not None:
        steps = steps.unionByName(filters.select(
            "shard", F.lit(0).alias("step"), F.lit(None).cast("binary").alias("key"), F.col("filter").alias("old")))
    return steps.repartition("shard").sortWithinPartitions("shard", "step", "key")


_OPENED: list = [None, None]


def _opened(shared) -> dict[int, CuckooFilter]:
    """The broadcast filters, decoded once per worker and broadcast."""
    value = shared.value
    if _OPENED[0] is not value:
        _OPENED[:] = value, {s: CuckooFilter.from_bytes(raw) for s, raw in value.items()}
    return _OPENED[1]


def dedup_lines(docs: DataFrame, **params) -> DataFrame:
    """Insert all documents into a new index and dedup them with it."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return LineIndex.empty(docs.sparkSession, id_type=kind, **params).insert(docs).dedup(docs)


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))
