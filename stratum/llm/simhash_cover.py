"""SimHash near-dedup (12): covering locality-sensitive hashing.

A document's fingerprint has 64 bits.  Every 4-word shingle, repeats included,
is hashed (XXH64, seed 42); a bit of the fingerprint is 1 if it is set in over
half of the hashes.  Documents link when their fingerprints differ in at most
``RADIUS`` bits, and the result names the component each document is in.

Finding the links.  Give bit i of the fingerprint a vector m(i) of RADIUS + 1
bits.  For every vector v but zero, the mask a(v) has the bits i for which
<m(i), v> is odd, and table v keeps a fingerprint under its bits in a(v).  Two
fingerprints that differ in at most RADIUS places have that many vectors m(i),
which leave room for a v orthogonal to all of them: the mask a(v) then has none
of the places that differ, and the two collide in table v.  So the 2^(RADIUS+1)
- 1 = 31 tables find every link, with certainty, while a mask holds about half
of the bits, so unlike fingerprints rarely meet.

1. Equal fingerprints are one class, however many copies there are.
2. Classes are dealt to the tables; buckets of one class leave after a count.
3. Buckets of up to ``LIMIT`` classes are searched inside the tasks, one bucket
   at a time: from a class all unvisited classes in reach are linked to it and
   searched next.  Links are at most as many as classes.
4. Larger buckets go another exact way: two fingerprints are within 4 bits if
   and only if some third one is within 2 bits of both.  Each of their classes
   is put under all 2,081 fingerprints within 2 bits, and the classes that
   meet - never more than 2,081 - are linked to the least of them.  The work
   grows with the classes, not with their pairs.
5. Components of the links, by alternating stars.

Defined results: a text with fewer words is one shingle; null or wordless text
has fingerprint zero and is linked like any other; rows that repeat an id are
separate rows; null ids are never the least unless all ids of a component are
null; texts are read in segments, so very long ones need no more memory than
the text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from .common import materialise
from .components import components

WORDS, SEED, BITS, RADIUS = 4, 42, 64, 4
LIMIT = 4096                    # classes of a bucket that a task searches by itself
SEGMENT = 1 << 20               # bytes of a text that are split at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# ---- fingerprints ------------------------------------------------------------------

def _segments(raw: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + SEGMENT)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def _bit_counts(shingles: list[bytes]) -> np.ndarray:
    digests = b"".join(map(xxh64_digest, shingles, repeat(SEED)))
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(0, dtype=np.int64)


def fingerprint(text: str | None, words: int = WORDS) -> bytes:
    """The fingerprint of a text, most significant byte first."""
    counts, n, held = np.zeros(BITS, np.int64), 0, []
    for part in _segments((text or "").encode("utf-8", "surrogatepass").lower()):
        held += part.split()
        if len(held) < words:
            continue
        joined = b" ".join(held)
        ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        found = [joined[a:b] for a, b in zip(begins.tolist(), ends[words - 1:].tolist(), strict=False)]
        counts += _bit_counts(found)
        n += len(found)
        held = held[len(held) - words + 1:]
    if not n and held:
        counts, n = _bit_counts([b" ".join(held)]), 1
    return np.packbits(2 * counts > n).tobytes()


def _prints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                raw = b"".join(fingerprint(t.as_py(), words) for t in part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.frombuffer(raw, ">i8").astype(np.int64))], ["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, print) per row of ``docs``; the print's 64 bits as a long."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _prints(words), f"doc_id {kind}, print long")


# ---- tables --------------------------------------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """The masks a(v), v = 1 .. 2^(radius+1) - 1; the vectors m(i) go round all but zero."""
    full = (1 << (radius + 1)) - 1
    vector = [1 + i % full for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, full + 1)]


def _dealt(classes: DataFrame, radius: int) -> DataFrame:
    """(table, key, print): every class under its bits in every mask."""
    places = [F.struct(F.lit(v).alias("table"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("key"))
              for v, m in enumerate(masks(radius=radius))]
    return classes.select("print", F.explode(F.array(*places)).alias("p")).select("p.table", "p.key", "print")


def _bucket_links(prints: np.ndarray, radius: int) -> tuple[list, list]:
    """A spanning forest of the links inside one bucket, as two columns."""
    left, a, b = prints, [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                found = left[near]
                a.extend(found.tolist())
                b.extend([int(at)] * len(found))
                queue.extend(found)
                left = left[~near]
    return a, b


def _search(radius: int):
    """Rows (table, key, print) in the order of their buckets to links (a, b)."""
    def links_of(prints: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
        size = np.diff(np.append(start, len(prints)))
        two = start[size == 2]
        x, y = prints[two], prints[two + 1]
        near = np.bitwise_count(x ^ y) <= radius
        a, b = x[near].tolist(), y[near].tolist()
        for at, n in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            more = _bucket_links(prints[at:at + n], radius)
            a += more[0]
            b += more[1]
        return pa.RecordBatch.from_arrays([pa.array(np.array(c, np.uint64).view(np.int64)) for c in (a, b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, t) for t in (np.int32, np.int64, np.uint64)]
        for batch in batches:
            new = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64))
            table, key, prints = (np.concatenate(c) for c in zip(held, new, strict=True))
            if not len(prints):
                continue
            start = np.flatnonzero(np.concatenate(([True], (table[1:] != table[:-1]) | (key[1:] != key[:-1]))))
            last = start[-1]        # this bucket may go on in the next batch
            if last:
                yield links_of(prints[:last], start[:-1])
            held = [table[last:], key[last:], prints[last:]]
        if len(held[2]):
            yield links_of(held[2], np.zeros(1, np.int64))

    return run


def _meeting_links(hot: DataFrame, radius: int) -> DataFrame:
    """Links among the classes ``hot`` by common neighbours at half the radius."""
    half = radius // 2
    if radius % 2:
        raise ValueError("the radius must be even")
    flips = [_signed(sum(1 << i for i in some)) for k in range(half + 1) for some in combinations(range(BITS), k)]
    near: Column = F.transform(F.lit(flips).cast("array<bigint>"), lambda m: F.col("print").bitwiseXOR(m))
    met = hot.select("print", F.explode(near).alias("z")).groupBy("z").agg(
        F.collect_list("print").alias("members")).filter(F.size("members") > 1)
    return met.select(F.explode("members").alias("a"), F.array_min("members").alias("b")).filter(
        F.col("a") != F.col("b")).distinct()


def links(classes: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all that are in reach."""
    dealt = _dealt(classes, radius)
    sizes = dealt.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    # Spark sizes the exploded rows as if there were one per class, and would broadcast millions of them.
    met = materialise(dealt.join(sizes.hint("merge"), ["table", "key"]), "simhash-buckets")
    found = met.filter(F.col("n") <= limit).select("table", "key", "print").repartition("table", "key") \
        .sortWithinPartitions("table", "key").mapInArrow(_search(radius), "a long, b long")
    hot = met.filter(F.col("n") > limit).select("print").distinct()
    return found.unionByName(_meeting_links(hot, radius))


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``."""
    rows = materialise(fingerprints(docs, words), "simhash-prints")
    classes = materialise(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-classes")
    joined = components(links(classes.select("print"), radius, limit)).withColumnRenamed("node", "print")
    named = classes.join(joined, "print", "left").withColumn("component", F.coalesce("component", "print"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = materialise(named.join(least, "component").select("print", "component_id"), "simhash-components")
    return rows.join(of_class, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
