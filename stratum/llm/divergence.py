"""Source divergence audit (11): how far the sources of a language stand apart.

Counting, inside the tasks that read the texts (``TermCounter``):

1. The terms of a block of texts are found on the raw bytes of the column: runs
   of letters, where every byte of a character beyond ASCII counts as a letter.
2. Terms are bucketed by length.  One of up to 8 bytes is one uint64 word, of up to 16 bytes
   two; the bytes stand high to low, so words sort as the bytes do.  A bucket
   is sorted by a radix sort in numpy, two bytes a pass, and only over the bytes its
   lengths have; the first pass is by the group (language, source).  Equal
   terms of a group are then runs, whose lengths are the counts; inside a run
   the documents are in order too, so the document counts come with it.
3. Longer terms go to buckets of fixed widths, powers of two, sorted as bytes.
4. Runs of many blocks are merged by the same sort before they leave the task.

Spark adds the runs up by (language, source, term), keeps the terms that stand in enough
documents of the language, and gives every group its exact shares p.

Terms with a higher share than in the language are ranked per group.  Sources
are compared in blocks of terms: a group of one language, one block of kept terms
and two blocks of sources becomes a small dense matrix, whatever the number of
terms and sources; only sums per pair of sources leave it, and the report has a
row for each of these pairs anyway.

All arithmetic is exact: shares by decimal division, the rest in 64-bit integers
that cannot overflow.

Defined results: null language, source and text are empty strings; a text
without terms still makes its group occur; rows that repeat an id are documents
of their own; ties are ranked by the item's bytes; a text is cut into segments
between terms when it is long; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

MIN_DOCS, TOP, UNIT = 10, 10, 1_000_000_000
TERM_BLOCK, SOURCE_BLOCK = 2048, 256
BLOCK_BYTES = 4 << 20           # text that is split at a time
HELD_RUNS = 1_000_000           # runs a task merges before they leave

_BYTE = np.arange(256)
_LETTER = ((_BYTE | 32) >= 97) & ((_BYTE | 32) <= 122) & (_BYTE < 128) | (_BYTE >= 128)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
# The first k bytes of a word.
_FIRST = np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], np.uint64)


# ---- sorting and counting runs --------------------------------------------------------

def _by_digit(order: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``order`` sorted further by 16-bit values, stable: numpy's radix sort."""
    return order[np.argsort(values[order], kind="stable")]


def radix_order(words: list[np.ndarray], width: int, group: np.ndarray) -> np.ndarray:
    """The order of terms by their bytes, then by group, then as they stand.

    ``width`` is the greatest length of the terms in bytes; two bytes a pass.
    """
    order = np.arange(len(group))
    order = _by_digit(order, group.astype(np.uint16))
    if len(group) and group.max() > 0xFFFF:
        order = _by_digit(order, (group >> 16).astype(np.uint16))
    for digit in range((width + 1) // 2 - 1, -1, -1):
        word, place = divmod(digit, 4)
        order = _by_digit(order, (words[word] >> np.uint64(48 - 16 * place)).astype(np.uint16))
    return order


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Whether a row differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _strings(words: list[np.ndarray]) -> pa.Array:
    """Packed terms as strings; they hold no zero byte."""
    raw = np.stack(words, 1).astype(">u8").view(np.uint8)
    held = raw != 0
    ends = np.concatenate(([0], np.cumsum(held.sum(1)))).astype(np.int32)
    return pa.StringArray.from_buffers(len(raw), pa.py_buffer(ends), pa.py_buffer(raw[held].tobytes()))


class TermCounter:
    """Counts of one task's terms: runs (term, group, n, df) by length bucket."""

    def __init__(self, held_runs: int = HELD_RUNS):
        self.groups: dict[tuple[str, str], int] = {}
        self.held_runs = held_runs
        self.runs: dict[int, list[tuple]] = {}      # digits -> [(words, group, n, df)]
        self.long: dict[tuple[int, bytes], list[int]] = {}
        self.n_runs = 0

    def group(self, lang: str, source: str) -> int:
        return self.groups.setdefault((lang, source), len(self.groups))

    def _count(self, words: list[np.ndarray], digits: int, group: np.ndarray, doc: np.ndarray) -> tuple:
        order = radix_order(words, 2 * digits, group)
        words, group, doc = [w[order] for w in words], group[order], doc[order]
        new = _changes([*words, group])
        at = np.flatnonzero(new)
        df = np.add.reduceat((new | _changes([doc])).astype(np.int64), at)
        return [w[at] for w in words], group[at], np.diff(np.append(at, len(new))), df

    def _count_long(self, terms: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple:
        order = np.argsort(group, kind="stable")
        order = order[np.argsort(terms[order], kind="stable")]
        terms, group, doc = terms[order], group[order], doc[order]
        new = _changes([terms, group])
        at = np.flatnonzero(new)
        df = np.add.reduceat((new | _changes([doc])).astype(np.int64), at)
        return terms[at], group[at], np.diff(np.append(at, len(new))), df

    def runs_of(self, raw: np.ndarray, starts: np.ndarray, group: np.ndarray) -> dict[int, tuple]:
        """The runs of a block: its bytes, where its documents start, their groups.

        Keys are the 16-bit digits of packed terms (1 to 8) or, for long ones,
        minus the width in bytes."""
        if not len(raw):
            return {}
        letter = _LETTER[raw]
        before, after = np.empty_like(letter), np.empty_like(letter)
        before[0] = after[-1] = False
        before[1:], after[:-1] = letter[:-1], letter[1:]
        inner = starts[(starts > 0) & (starts < len(raw))]
        before[inner] = False
        after[inner - 1] = False
        begin, end = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~after) + 1
        doc = np.searchsorted(starts, begin, "right") - 1
        length = end - begin
        low = np.concatenate((_LOWER[raw], np.zeros(16, np.uint8)))
        eight = np.ndarray((len(low) - 7,), ">u8", low, 0, (1,))      # the 8 bytes from any place
        found: dict[int, tuple] = {}
        digits = (np.minimum(length, 17) + 1) // 2
        for k in range(1, 9):
            some = np.flatnonzero(digits == k)
            if not len(some):
                continue
            b, n = begin[some], length[some]
            words = [eight[b].astype(np.uint64) & _FIRST[np.minimum(n, 8)]]
            if k > 4:
                words.append(eight[b + 8].astype(np.uint64) & _FIRST[n - 8])
            found[k] = self._count(words, k, group[doc[some]], doc[some])
        rest = np.flatnonzero(digits == 9)
        width = 1 << np.ceil(np.log2(length[rest])).astype(np.int64)
        for w in np.unique(width).tolist():
            some = rest[width == w]
            terms = np.array([low[b:e].tobytes() for b, e in zip(begin[some], end[some], strict=True)], f"S{w}")
            found[-w] = self._count_long(terms, group[doc[some]], doc[some])
        return found

    def add(self, found: dict[int, tuple]) -> None:
        for k, (terms, group, n, df) in found.items():
            if k < 0:
                for t, g, a, b in zip(terms.tolist(), group.tolist(), n.tolist(), df.tolist(), strict=True):
                    sums = self.long.setdefault((g, t), [0, 0])
                    sums[0] += a
                    sums[1] += b
                    self.n_runs += sums[0] == a
            else:
                self.runs.setdefault(k, []).append((terms, group, n, df))
                self.n_runs += len(n)

    def add_block(self, raw: np.ndarray, starts: np.ndarray, group: np.ndarray) -> None:
        self.add(self.runs_of(raw, starts, group))

    def add_long_text(self, raw: np.ndarray, group: int, block: int) -> None:
        """One text in segments that end between terms; each term is in one document."""
        own = TermCounter()
        at = 0
        while at < len(raw):
            end = min(at + block, len(raw))
            while end < len(raw) and _LETTER[raw[end]]:
                gap = np.flatnonzero(~_LETTER[raw[end:end + block]])
                end += int(gap[0]) if len(gap) else len(raw[end:end + block])
            own.add_block(raw[at:end], np.zeros(1, np.int64), np.full(1, group))
            if own.n_runs > self.held_runs:
                own.merge()
            at = end
        own.merge()
        self.add({k: (words, g, n, np.ones_like(df)) for k, [(words, g, n, df)] in own.runs.items()})
        for key, (n, _) in own.long.items():
            sums = self.long.setdefault(key, [0, 0])
            sums[0] += n
            sums[1] += 1
            self.n_runs += sums[1] == 1

    def merge(self) -> None:
        """Equal runs of different blocks become one."""
        for k, parts in self.runs.items():
            if len(parts) > 1:
                words = [np.concatenate(w) for w in zip(*(p[0] for p in parts), strict=True)]
                group, n, df = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
                order = radix_order(words, 2 * k, group)
                words, group = [w[order] for w in words], group[order]
                at = np.flatnonzero(_changes([*words, group]))
                self.runs[k] = [([w[at] for w in words], group[at],
                                 np.add.reduceat(n[order], at), np.add.reduceat(df[order], at))]
        self.n_runs = sum(len(p[2]) for parts in self.runs.values() for p in parts) + len(self.long)

    def flush(self) -> Iterator[pa.RecordBatch]:
        """(lang, source, term, n, df) of everything held, which is then forgotten."""
        self.merge()
        names = list(self.groups)
        lang, source = (pa.array([g[i] for g in names], pa.string()) for i in (0, 1))

        def batch(term: pa.Array, group: np.ndarray, n: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
            at = pa.array(group)
            return pa.RecordBatch.from_arrays(
                [lang.take(at), source.take(at), term, pa.array(n), pa.array(df)], ["lang", "source", "term", "n", "df"])

        for [(words, group, n, df)] in self.runs.values():
            for i in range(0, len(n), 50_000):
                part = slice(i, i + 50_000)
                yield batch(_strings([w[part] for w in words]), group[part], n[part], df[part])
        if self.long:
            keys, sums = list(self.long), np.array(list(self.long.values()), np.int64)
            for i in range(0, len(keys), 5_000):
                some = keys[i:i + 5_000]
                yield batch(pa.array([t for _, t in some], pa.binary()).cast(pa.string()),
                            np.array([g for g, _ in some], np.int64), *sums[i:i + 5_000].T)
        self.runs, self.long, self.n_runs = {}, {}, 0


def _blocks(offsets: np.ndarray, block: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to ``block`` bytes, or of one longer row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + block, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def _counted(block: int, held_runs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter(held_runs)
        for batch in batches:
            text = batch.column(2).cast(pa.large_string())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            group = np.array([counter.group(*g) for g in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], np.int64)
            for a, b in _blocks(offsets, block):
                part = raw[offsets[a]:offsets[b]]
                if len(part) > block:
                    counter.add_long_text(part, int(group[a]), block)
                else:
                    counter.add_block(part, offsets[a:b] - offsets[a], group[a:b])
                if counter.n_runs > held_runs:
                    counter.merge()
                    if counter.n_runs > held_runs // 2:
                        yield from counter.flush()
        yield from counter.flush()

    return run


def term_counts(docs: DataFrame, block: int = BLOCK_BYTES, held_runs: int = HELD_RUNS) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents; one row each, dealt
    by (lang, term)."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = rows.mapInArrow(_counted(block, held_runs), "lang string, source string, term string, n long, df long")
    return found.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("df").alias("df"))


# ---- shares ------------------------------------------------------------------------------

def _share(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(UNIT (count + 2) / (total + 2 v)), exact; 1 where there are no terms."""
    over = (count + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    by = F.greatest(total + 2 * v, F.lit(1)).cast("decimal(20,0)")
    part = over - over % by
    return F.when(v > 0, 1 + (part / by).cast("long")).otherwise(F.lit(1).cast("long"))


def _distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of positive 64-bit integers."""
    square, by = (p - q) * (p - q), p + q
    return ((square - square % by).cast("decimal(20,0)") / by.cast("decimal(20,0)")).cast("long")


def _kept(counts: DataFrame, min_docs: int) -> DataFrame:
    """The counts of the terms in at least ``min_docs`` documents of their language,
    with the count in it and whether the row is the first of its term."""
    term = Window.partitionBy("lang", "term")
    return counts.withColumns({
        "docs": F.sum("df").over(term), "lang_n": F.sum("n").over(term),
        "first": F.row_number().over(term.orderBy("source")) == 1,
    }).filter(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "first")


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, v, lang_total, total) of every group that occurs."""
    occurring = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("lang_total"))
    sources = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    return occurring.join(langs, "lang", "left").join(sources, ["lang", "source"], "left") \
        .fillna(0, ["v", "lang_total", "total"])


def _term_part(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    p = _share(F.col("n"), F.col("total"), F.col("v"))
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    high = kept.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"),
                                                        p.alias("p"), q.alias("q")).filter("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return high.select("lang", "source", "item", _distance(F.col("p"), F.col("q")).alias("value")) \
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top) \
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


_KEY = ["lang", "block_a", "block_b", "term_block"]
_PAIRS = "lang string, a string, b string, value long, seen long, unseen_value long"


def _compare(terms: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums over one block of terms for all pairs of two blocks of sources."""
    names = sources.sort_by("source")
    name, block = names.column("source").to_pylist(), names.column("block").to_numpy()
    place = {s: i for i, s in enumerate(name)}
    coded = terms.column("term").combine_chunks().dictionary_encode()
    p0 = names.column("p0").to_numpy()
    p = np.repeat(p0[:, None], len(coded.dictionary), 1)
    p[[place[s] for s in terms.column("source").to_pylist()], coded.indices.to_numpy()] = terms.column("p").to_numpy()
    out: dict[str, list] = {c: [] for c in ("a", "b", "value", "unseen_value")}
    one = names.column("block_a")[0] == names.column("block_b")[0]
    for i in range(len(name)):
        if one:
            others = np.arange(i + 1, len(name))
        else:
            others = np.flatnonzero(block != block[i]) if block[i] == block.min() else np.empty(0, np.int64)
        if len(others):
            d, s = p[others] - p[i], p[others] + p[i]
            d0, s0 = p0[others] - p0[i], p0[others] + p0[i]
            out["a"] += [name[i]] * len(others)
            out["b"] += [name[j] for j in others.tolist()]
            out["value"] += (d * d // s).sum(1).tolist()
            out["unseen_value"] += (d0 * d0 // s0).tolist()
    n = len(out["a"])
    return pa.table({
        "lang": pa.array([names.column("lang")[0].as_py()] * n, pa.string()),
        "a": pa.array(out["a"], pa.string()), "b": pa.array(out["b"], pa.string()),
        "value": pa.array(out["value"], pa.int64()), "seen": pa.array([len(coded.dictionary)] * n, pa.int64()),
        "unseen_value": pa.array(out["unseen_value"], pa.int64())})


def _pair_part(kept: DataFrame, groups: DataFrame, term_block: int, source_block: int) -> DataFrame:
    sizes = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / source_block).cast("int").alias("n_blocks"),
        F.greatest(F.ceil(F.max("v") / term_block), F.lit(1)).cast("int").alias("n_term_blocks"))
    sized = groups.join(sizes, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("n_blocks")).cast("int"))
    # A block of sources meets every block, itself included, the lesser number first.
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    meeting = [F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b")]
    sources = sized.select("*", other).select("*", F.explode(F.sequence(F.lit(0), F.col("n_term_blocks") - 1)).alias("term_block")) \
        .select(*meeting, "lang", "term_block", "source", "block",
                _share(F.lit(0), F.col("total"), F.col("v")).alias("p0"))
    terms = kept.join(sized, ["lang", "source"]).select("*", other).select(
        *meeting, "lang", F.pmod(F.xxhash64("term"), F.col("n_term_blocks")).cast("int").alias("term_block"),
        "source", "term", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    partial = terms.groupBy(*_KEY).cogroup(sources.groupBy(*_KEY)).applyInArrow(_compare, _PAIRS)
    v = groups.groupBy("lang").agg(F.max("v").alias("v"))
    sums = partial.groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.max("unseen_value").alias("unseen_value")).join(v, "lang")
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s")
    rows = sums.select("lang", both, (F.col("value") + (F.col("v") - F.col("seen")) * F.col("unseen_value")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value") \
        .withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, term_block: int = TERM_BLOCK,
          source_block: int = SOURCE_BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): see the module's docstring."""
    kept = materialise(_kept(term_counts(docs), min_docs), "audit-terms")
    groups = materialise(_groups(docs, kept), "audit-groups")
    return _pair_part(kept, groups, term_block, source_block).unionByName(_term_part(kept, groups, top))
