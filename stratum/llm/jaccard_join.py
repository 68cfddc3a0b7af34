"""N-gram Jaccard join (10): prefix filters under several global orders.

Documents are sets of distinct word shingles and link when their Jaccard
similarity reaches ``threshold``.  Put the shingles of all sets into one global
order: two sets that link must then share one of the first
``n - ceil(t n) + 1`` shingles of either (the prefix).  This holds for any
order, so a pair must pass under every order used, and the filters are
intersected before a pair is verified exactly.

Orders: the rarest shingles first, by a sketch of their frequencies, ties by a
hash - a different one in each order.  The sketch is a table of 2^22 counters
of hashed shingles (4 MB when it travels), whatever the corpus; it decides how
well the filters work, never what is right.  For corpora whose shingles are
many more than its counters, raise ``SKETCH_BITS``.

Texts with equal sets are one class.  The join works in two rounds:

1. *Stars.*  Classes that share the first shingle under one of ``STARS`` plain
   hash orders are paired with one class of their group, the one with the
   fewest shingles that are rare for it: the text that the others are copies
   of.  The pairs are as many as the classes, however large a group is.
   Verified pairs link, and give components.
2. *Prefixes.*  Shingles of prefixes held by classes of two or more components
   are joined, and only pairs across components are made: within a component
   another link changes nothing.  The number and the places of the shared
   prefix shingles bound the overlap, already at the join; pairs that can reach the threshold pass
   the filter of the second order and are verified, so no link between
   components is missed.

Rounds never emit all pairs of a group, and shingles of a single class - nearly
all - leave after one exchange of packed arrays, deduplicated per task first.
Classes and shingles are known by 64-bit hashes.

Defined results: a text with fewer than 5 words is one shingle, without words
(or null) it is the empty set, which links with nothing and is its own
component; rows that repeat an id with another text are separate sets whose
component is the least id reachable; null ids come last; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, tidy
from .components import components

WORDS, THRESHOLD = 5, 75        # words in a shingle; similarity in percent
STARS = 4                       # hash orders of the first round
SKETCH_BITS, CHUNK_BITS = 22, 16
BITMAP_BITS = 23                # of the documents whose sets are wanted
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SALTS = [np.uint64(int.from_bytes(hashlib.blake2b(b"order %d" % i, digest_size=8).digest(), "little"))
          for i in range(16)]


# ---- sets of one text -----------------------------------------------------------

def mix(h: np.ndarray, salt: np.uint64) -> np.ndarray:
    """A permutation of 64-bit integers for every salt."""
    with np.errstate(over="ignore"):
        h = h ^ salt
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


# Of every byte: its lower case (ASCII only), whether it is white space, a random weight.
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_WEIGHT = mix(np.arange(256, dtype=np.uint64), np.uint64(0x5DEECE66D))[_LOWER]
_BACK = np.uint64(pow(int(_ODD), -1, 1 << 64))
SEGMENT = 1 << 18               # bytes of a text that are hashed at a time


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes.

    A word's hash is the sum of its bytes' weights times powers of an odd
    number, taken from running sums over the text and brought to the word's
    start by the inverse power, all modulo 2^64: no loop over words.
    """

    def __init__(self, words: int = WORDS):
        self.words = words
        self.powers = self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            with np.errstate(over="ignore"):
                step = np.full(n, _ODD), np.full(n, _BACK)
                step[0][0] = step[1][0] = 1
                self.powers, self.back = np.cumprod(step[0]), np.cumprod(step[1])

    def _segments(self, raw: np.ndarray):
        """The text in pieces that end between words."""
        at = 0
        while at < len(raw):
            end = at + SEGMENT
            while end < len(raw) and not _IS_SPACE[raw[end]]:
                after = np.flatnonzero(_IS_SPACE[raw[end:end + SEGMENT]])
                end += int(after[0]) if len(after) else SEGMENT
            yield raw[at:end]
            at = end

    def word_hashes(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        out = []
        for part in self._segments(raw):
            inside = np.concatenate(([False], ~_IS_SPACE[part], [False]))
            edge = np.flatnonzero(inside[1:] != inside[:-1])
            start, end = edge[::2], edge[1::2]
            self._grow(len(part) + 1)
            with np.errstate(over="ignore"):
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_WEIGHT[part] * self.powers[:len(part)])))
                out.append((sums[end] - sums[start]) * self.back[start])
        return mix(np.concatenate(out), _SALTS[14]) if out else np.empty(0, np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        h = self.word_hashes(text or "")
        if not len(h):
            return h
        k = min(self.words, len(h))
        with np.errstate(over="ignore"):
            acc = h[:len(h) - k + 1].copy()
            for i in range(1, k):
                acc = acc * _ODD + h[i:len(h) - k + 1 + i]
        acc = np.sort(mix(acc, np.uint64(k)))
        return acc[np.concatenate(([True], acc[1:] != acc[:-1]))]


def signature(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1 if n else 0


def _bucket(s: np.ndarray, bits: int) -> np.ndarray:
    return (s >> np.uint64(64 - bits)).astype(np.int64)


def in_order(s: np.ndarray, levels: np.ndarray, order: int, first: int) -> np.ndarray:
    """The first shingles of a set under an order: rare first, ties by hash."""
    level = levels[_bucket(s, SKETCH_BITS)].astype(np.uint64)
    key = (level << np.uint64(56)) | (mix(s, _SALTS[8 + order]) >> np.uint64(8))
    if first < len(s):
        at = np.argpartition(key, first - 1)[:first]
        at = at[np.argsort(key[at], kind="stable")]
    else:
        at = np.argsort(key, kind="stable")
    return s[at]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


# ---- first scan: frequency sketch; second scan: classes and star tokens -------------

def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sketch = Shingler(words), np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                pooled = [_bucket(shingler.shingles(t.as_py()), SKETCH_BITS) for t in batch.column(0).slice(at, 1000)]
                sketch += np.bincount(np.concatenate(pooled), minlength=len(sketch)).astype(np.uint32)
        # Saturated counts order as well: what is that frequent in one task is frequent.
        for chunk, part in enumerate(sketch.reshape(-1, 1 << CHUNK_BITS)):
            if part.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk], pa.int32()),
                    pa.array([np.minimum(part, 255).astype(np.uint8).tobytes()], pa.binary())], ["chunk", "counts"])

    return run


def rare_shingles(s: np.ndarray, levels: np.ndarray) -> int:
    """How many shingles are less than half as frequent as the set's median one."""
    level = levels[_bucket(s, SKETCH_BITS)].astype(np.int64)
    return int((level < np.median(level) - 4).sum()) if len(s) else 0


def _profile(levels, words: int, stars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, level = Shingler(words), np.frombuffer(levels.value, np.uint8)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingler.shingles(t.as_py()) for t in part.column(1)]
                firsts = [[int(mix(s, _SALTS[i]).min().view(np.int64)) for i in range(stars)] if len(s) else [] for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([signature(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([rare_shingles(s, level) for s in sets], pa.int64()),
                    pa.array(firsts, pa.list_(pa.int64())), *part.columns[2:]],
                    ["doc_id", "sig", "n", "rare", "firsts", *part.schema.names[2:]])

    return run


def _add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the counters of each chunk as they stream by; then levels of them."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            got = np.frombuffer(raw, np.uint8).astype(np.int64)
            total[chunk] = total[chunk] + got if chunk in total else got
    for chunk, counts in total.items():
        # Four levels to the doubling.
        level = np.minimum(np.floor(4 * np.log2(counts + 1)), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([level.tobytes()], pa.binary())],
                                         ["chunk", "levels"])


def _levels(sketched: DataFrame) -> bytes:
    """The frequency level of every bucket: 2^SKETCH_BITS bytes."""
    n = 1 << (SKETCH_BITS - CHUNK_BITS)
    rows = sketched.repartition(n, "chunk").mapInArrow(tidy(_add_chunks), "chunk int, levels binary").collect()
    have = {r.chunk: bytes(r.levels) for r in rows}
    return b"".join(have.get(i, bytes(1 << CHUNK_BITS)) for i in range(n))


# ---- verification ------------------------------------------------------------------

def _sets(docs: DataFrame, wanted: DataFrame, levels, words: int) -> DataFrame:
    """(sig, n, set) of the wanted (doc_id, sig); the set is in the second order.

    A bitmap of hashed ids (1 MB) spares the texts not wanted.
    """
    word = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS))
    bits = wanted.select(word.alias("at")).distinct().groupBy(F.floor(F.col("at") / 32).alias("w")).agg(
        F.sum(F.pow(F.lit(2.0), F.col("at") % 32).cast("long")).alias("m")).collect()
    bitmap = np.zeros((1 << BITMAP_BITS) // 32, np.uint32)
    for r in bits:
        bitmap[r.w] = r.m
    shared = docs.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bitmap = Shingler(words), np.frombuffer(shared.value, np.uint32)
        level = np.frombuffer(levels.value, np.uint8)
        for batch in batches:
            at = batch.column(2).to_numpy()
            keep = np.flatnonzero(bitmap[at >> 5] >> (at & 31).astype(np.uint32) & 1)
            for i in range(0, len(keep), 250):
                out = {k: [] for k in ("sig", "n", "set")}
                for t in batch.column(1).take(pa.array(keep[i:i + 250])):
                    s = shingler.shingles(t.as_py())
                    out["sig"].append(signature(s))
                    out["n"].append(len(s))
                    out["set"].append(in_order(s, level, 1, len(s)).view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(out["sig"], pa.int64()), pa.array(out["n"], pa.int64()),
                    pa.array(out["set"], pa.list_(pa.int64()))], list(out))

    found = docs.select("doc_id", F.col("text").cast("string").alias("text"), word.alias("at")).mapInArrow(
        tidy(run), "sig long, n long, `set` array<long>")
    return found.dropDuplicates(["sig"])


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, levels,
             words: int = WORDS, percent: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) of class signatures that pass all filters and link."""
    sigs = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    wanted = materialise(classes.select("sig", "doc_id").join(sigs, "sig"), "jaccard-wanted")
    # Used twice below: one exchange by class serves both joins.
    sets = _sets(docs, wanted, levels, words)
    left = sets.select(*[F.col(c).alias(f"{c}_a") for c in sets.columns])
    right = sets.select(*[F.col(c).alias(f"{c}_b") for c in sets.columns])
    both = pairs.join(left, pairs["a"] == left["sig_a"]).join(right, pairs["b"] == right["sig_b"])

    def prefix(side: str):
        n = F.col(f"n_{side}")
        return F.slice(f"set_{side}", F.lit(1), (n - F.ceil(n * percent / 100) + 1).cast("int"))

    alike = both.filter(F.arrays_overlap(prefix("a"), prefix("b")))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return alike.filter(100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")


def _sizes_allow(n_a, n_b, percent: int):
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


# ---- round 1: stars -----------------------------------------------------------------

def _star_pairs(classes: DataFrame, percent: int) -> DataFrame:
    held = classes.select("sig", "n", "rare", F.posexplode("firsts").alias("i", "token"))
    centre = held.groupBy("i", "token").agg(F.min(F.struct("rare", "n", "sig")).alias("centre"))
    return held.join(centre, ["i", "token"]).filter(
        (F.col("sig") != F.col("centre.sig")) & _sizes_allow(F.col("n"), F.col("centre.n"), percent)
    ).select(F.least("sig", "centre.sig").alias("a"), F.greatest("sig", "centre.sig").alias("b")).distinct()


# ---- round 2: prefixes ----------------------------------------------------------------

def _entries(levels, words: int, percent: int, n_buckets: int):
    """(bucket, tokens, sigs, places): the prefix entries of many documents, packed
    by bucket; entries of documents with equal sets are sent once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, level = Shingler(words), np.frombuffer(levels.value, np.uint8)
        tokens, sigs, places, held, seen = [], [], [], 0, set()

        def out() -> pa.RecordBatch:
            t, s, at = np.concatenate(tokens), np.concatenate(sigs), np.concatenate(places)
            bucket = (mix(t, _SALTS[15]) % np.uint64(n_buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            t, s, at, bucket = t[by], s[by], at[by], bucket[by]
            start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            ends = np.r_[start[1:], len(t)]
            return pa.RecordBatch.from_arrays([
                pa.array(bucket[start].astype(np.int32)),
                pa.array([t[a:b].tobytes() for a, b in zip(start, ends, strict=True)], pa.binary()),
                pa.array([s[a:b].tobytes() for a, b in zip(start, ends, strict=True)], pa.binary()),
                pa.array([at[a:b].tobytes() for a, b in zip(start, ends, strict=True)], pa.binary())],
                ["bucket", "tokens", "sigs", "places"])

        for batch in batches:
            for text in batch.column(0):
                s = shingler.shingles(text.as_py())
                sig = signature(s)
                if not len(s) or sig in seen:
                    continue
                seen.add(sig)
                first = in_order(s, level, 0, prefix_size(len(s), percent))
                tokens.append(first)
                sigs.append(np.full(len(first), sig, np.int64))
                places.append(np.arange(1, len(first) + 1, dtype=np.int32))
                held += len(first)
                if held > 1_000_000:
                    yield out()
                    tokens, sigs, places, held = [], [], [], 0
                    if len(seen) > 200_000:
                        seen.clear()
        if held:
            yield out()

    return run


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the packed entries of a task's buckets, those whose token more than
    one class has, as rows (token, sig, place), each once."""
    packed: dict[int, list[tuple[bytes, bytes, bytes]]] = {}
    for batch in batches:
        for bucket, *entries in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            packed.setdefault(bucket, []).append(entries)
    for bucket in list(packed):
        parts = packed.pop(bucket)
        t = np.concatenate([np.frombuffer(p[0], np.int64) for p in parts])
        s = np.concatenate([np.frombuffer(p[1], np.int64) for p in parts])
        at = np.concatenate([np.frombuffer(p[2], np.int32) for p in parts])
        by = np.lexsort((s, t))
        t, s, at = t[by], s[by], at[by]
        new = np.r_[True, (t[1:] != t[:-1]) | (s[1:] != s[:-1])]
        t, s, at = t[new], s[new], at[new]
        with_next = np.r_[t[1:] == t[:-1], False]
        many = with_next | np.r_[False, t[1:] == t[:-1]]
        t, s, at = t[many], s[many], at[many]
        for i in range(0, len(t), 100_000):
            part = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(t[part]), pa.array(s[part]), pa.array(at[part])],
                                             ["token", "sig", "place"])


def _prefix_pairs(docs: DataFrame, classes: DataFrame, known: DataFrame, levels, words: int, percent: int) -> DataFrame:
    """Pairs of classes from different components that share a prefix token."""
    n_buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        tidy(_entries(levels, words, percent, n_buckets)), "bucket int, tokens binary, sigs binary, places binary")
    shared = packed.repartition(n_buckets, "bucket").mapInArrow(tidy(_shared_tokens), "token long, sig long, place int")
    sized = classes.select("sig", "n").join(known.withColumnRenamed("node", "sig"), "sig", "left") \
        .withColumn("component", F.coalesce("component", "sig"))
    member = materialise(shared.join(sized, "sig"), "jaccard-prefixes")
    mixed = member.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .filter(F.col("lo") != F.col("hi")).select("token")
    few = materialise(member.join(mixed, "token", "left_semi"), "jaccard-mixed")
    x, y = few.alias("x"), few.alias("y")
    # A shingle can only be the first that two linked sets share if enough of both
    # follows it.  These shingles head the shared ones, so beyond the last of them
    # no more than the shorter rest can be shared either.
    rest = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.component") < F.col("y.component"))
                 & _sizes_allow(F.col("x.n"), F.col("y.n"), percent)
                 & ((100 + percent) * (1 + rest) >= percent * (F.col("x.n") + F.col("y.n"))))
    per_pair = met.groupBy(F.col("x.sig").alias("s"), F.col("y.sig").alias("t")).agg(
        F.count(F.lit(1)).alias("k"), F.max("x.n").alias("n_s"), F.max("y.n").alias("n_t"),
        F.max("x.place").alias("at_s"), F.max("y.place").alias("at_t"))
    most = F.col("k") + F.least(F.col("n_s") - F.col("at_s"), F.col("n_t") - F.col("at_t"))
    return per_pair.filter((100 + percent) * most >= percent * (F.col("n_s") + F.col("n_t"))).select(
        F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b"))


# ---- the join ---------------------------------------------------------------------------

def _grouped(docs: DataFrame, words: int, percent: int, stars: int, hashed: bool = False) -> DataFrame:
    """(doc_id, sig, n, component, component_id) per row of ``docs``, with the
    ``text_hash`` if ``hashed``; the last two are null for the empty set."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    docs = docs.select("doc_id", text.alias("text"), *[F.xxhash64(text).alias("text_hash")] * hashed)
    sketched = docs.select("text").mapInArrow(tidy(_sketch(words)), "chunk int, counts binary")
    levels = spark.sparkContext.broadcast(_levels(sketched))
    rows = materialise(docs.mapInArrow(
        tidy(_profile(levels, words, stars)),
        f"doc_id {kind}, sig long, n long, rare long, firsts array<long>" + ", text_hash long" * hashed), "jaccard-profile")
    classes = materialise(rows.filter(F.col("n") > 0).groupBy("sig").agg(
        F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("rare").alias("rare"),
        F.max("firsts").alias("firsts")), "jaccard-classes")

    stars_found = materialise(_star_pairs(classes, percent), "jaccard-star-pairs")
    links = materialise(verified(stars_found, docs, classes, levels, words, percent), "jaccard-links")
    known = materialise(components(links), "jaccard-components")
    across = materialise(_prefix_pairs(docs, classes, known, levels, words, percent), "jaccard-pairs")
    more = materialise(verified(across, docs, classes, levels, words, percent), "jaccard-links")
    final = components(links.unionByName(more))

    # The component of a class, then the least id in every component.
    named = materialise(classes.select("sig", "doc_id").join(final.withColumnRenamed("node", "sig"), "sig", "left")
                        .withColumn("component", F.coalesce("component", "sig")), "jaccard-named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(least, "component").select(F.col("sig").alias("c_sig"), "component", "component_id")
    return rows.join(of_class, (rows["sig"] == of_class["c_sig"]) & (rows["n"] > 0), "left").select(
        "doc_id", "sig", "n", "component", "component_id", *["text_hash"] * hashed)


def join_groups(docs: DataFrame, words: int = WORDS, percent: int = THRESHOLD, stars: int = STARS) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``."""
    return _grouped(docs, words, percent, stars).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = THRESHOLD, stars: int = STARS) -> DataFrame:
    """``docs``, same columns, with one document of each component: the least id.

    Rows are judged by (doc_id, hash of text), never by id alone.  Rows of a
    component that share its least id are one document if their sets differ, and
    all stay; of equal sets under one id one row stays, with the least text hash,
    then the least hash of the row.  Null is no id: of a component without ids
    only the least set stays.  Documents without words are kept: they are linked
    with nothing.
    """
    rows = materialise(_grouped(docs, words, percent, stars, hashed=True).filter(F.col("n") > 0), "jaccard-grouped")
    same_id = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # The rows that stand for a component, as keys; for one without ids, of one set.
    heads = rows.filter(same_id).groupBy(
        "component", "doc_id", F.when(F.col("doc_id").isNotNull(), F.col("sig")).alias("set")).agg(
        F.min(F.struct("sig", "text_hash")).alias("least")).select(
        F.col("doc_id").alias("h_id"), F.col("least.text_hash").alias("h_hash"))
    keys = rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_rows"))
    judged = materialise(keys.join(heads, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_hash") == F.col("h_hash")),
                                   "left").select(F.col("doc_id").alias("__key_id"), F.col("text_hash").alias("__key_hash"),
                                                  "n_rows", F.col("h_hash").isNotNull().alias("head")), "jaccard-judged")
    on = docs["doc_id"].eqNullSafe(F.col("__key_id")) & (F.xxhash64(docs["text"].cast("string")) == F.col("__key_hash"))
    repeated = judged.filter(F.col("head") & (F.col("n_rows") > 1))
    kept = docs.join(judged.filter(~F.col("head") | (F.col("n_rows") > 1)).select("__key_id", "__key_hash"), on, "left_anti")
    if repeated.isEmpty():
        return kept
    # Equal rows meet in a partial aggregation, so a hot key is no hot task.
    cells = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    first = docs.join(repeated.select("__key_id", "__key_hash"), on, "left_semi").select(
        F.col("doc_id").alias("__id"), F.xxhash64(F.col("text").cast("string")).alias("__hash"),
        F.struct(*cells).alias("__row")).groupBy("__id", "__hash").agg(
        F.min_by("__row", F.xxhash64("__row")).alias("__row"))
    return kept.unionByName(first.select(*[F.col(f"__row.c{i}").alias(c) for i, c in enumerate(docs.columns)]))
