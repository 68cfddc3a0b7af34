"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# The ASCII white space that separates words in every word-based operator.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage: later stages, retries and lost executors read the written
    table and do not repeat what made it.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return the memory that this process no longer uses to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):           # another C library than glibc
        pass


def tidy(run: Callable[[Iterator], Iterator], forget: Callable[[], None] | None = None) -> Callable[[Iterator], Iterator]:
    """A function of batches (``mapInArrow``, iterator UDF) that gives its memory back when its task ends.

    Spark keeps a task's Python worker for later tasks and stages and takes the idle
    ones in turn, so what each holds adds up beside the executor's own memory.
    ``forget`` drops what the worker remembers between tasks.
    """
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            if forget is not None:
                forget()
            give_back()

    return tidied


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(x)`` with ``x`` bound to ``value``, evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null: none)."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(bare) > 0, F.split(bare, SPACE_RE)).otherwise(
        F.array().cast("array<string>"))


CHUNK = 256     # entries of an array that are folded together


def in_chunks(items: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of every run of ``CHUNK`` entries of a non-empty array.

    A fold that appends to an array copies it each time.  Folding chunks, and then
    the few chunks, keeps that cost in proportion to the array.
    """
    last = F.floor((F.size(items) - 1) / CHUNK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: body(F.slice(items, i * CHUNK + 1, F.lit(CHUNK))))


def _starts(chunks: Column, after: Callable[[Column, Column], Column]) -> Column:
    """Where every chunk begins: 0, then ``after(start, chunk)`` of the one before."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(chunks, zero, lambda acc, c: F.struct(
        after(acc["at"], c).cast("long").alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"])


def placed(pieces: Column, spans: str, step: Callable[[Column, Column], tuple[Column, Column, Column]]) -> Column:
    """Spans along a row of pieces.  ``step(at, piece)`` gives the position after the
    piece, whether it makes a span, and that span (of the type ``spans``, with start and end)."""
    empty = F.array().cast(f"array<{spans}>")
    zero = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def fold(acc: Column, p: Column) -> Column:
        after, keep, span = step(acc["at"], p)
        return F.struct(after.cast("long").alias("at"),
                        F.when(keep, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def shifted(start: Column, chunk: Column) -> Column:
        return F.transform(chunk["out"], lambda s: s.withField("start", s["start"] + start).withField("end", s["end"] + start))

    some = let(in_chunks(pieces, lambda part: F.aggregate(part, zero, fold)), lambda chunks: F.flatten(
        F.zip_with(chunks, _starts(chunks, lambda at, c: at + c["at"]), lambda c, start: shifted(start, c))))
    return F.when(F.size(pieces) > 0, some).otherwise(empty)


def match_spans(text: Column, pattern: str, keep: Callable[[Column], Column]) -> Column:
    """Spans of the leftmost non-overlapping matches of a Java pattern.

    ``array<struct<start,end,hit>>`` in code points, end exclusive, only the
    matches for which ``keep(hit)`` is true.  ``split`` gives the gaps and
    ``regexp_extract_all`` the matches of the same scan, so a running sum of
    their lengths gives the positions.  The pattern must not match empty text.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(at: Column, p: Column) -> tuple[Column, Column, Column]:
        start = at + p["gap"]
        end = start + F.coalesce(F.length(p["hit"]), F.lit(0))
        return end, p["hit"].isNotNull() & keep(p["hit"]), F.struct(start.alias("start"), end.alias("end"), p["hit"].alias("hit"))

    return let(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")),
               lambda pairs: placed(pairs, "struct<start:bigint,end:bigint,hit:string>", step))


def _piece(text: Column, start: Column, end: Column) -> Column:
    return F.substr(text, (start + 1).cast("int"), F.greatest(F.lit(0), end - start).cast("int"))


def span_texts(text: Column, spans: Column) -> Column:
    """The texts of spans sorted by start, as an array.

    A position in a text is found by counting from its start, so the text of a
    chunk of spans is cut out first."""
    def of(part: Column) -> Column:
        first, last = F.get(part, F.lit(0))["start"], F.array_max(F.transform(part, lambda s: s["end"]))
        return let(F.struct(_piece(text, first, last).alias("text"), first.alias("first")), lambda own: F.transform(
            part, lambda s: _piece(own["text"], s["start"] - own["first"], s["end"] - own["first"])))

    return F.when(F.size(spans) > 0, F.flatten(in_chunks(spans, of))).otherwise(F.array().cast("array<string>"))


def replace_spans(text: Column, spans: Column, fill: Callable[[Column, Column], Column]) -> Column:
    """``text`` with ``fill(span, at)`` in place of its spans, which are sorted by start
    and may overlap; ``at`` is the position up to which text has been written."""
    zero = F.array().cast("array<string>")

    def of(chunk: Column, begin: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(
                _piece(acc["own"], acc["at"] - begin, s["start"] - begin), fill(s, acc["at"]))).alias("out"),
                acc["own"].alias("own"))

        start = F.struct(begin.alias("at"), zero.alias("out"), _piece(text, begin, chunk["last"]).alias("own"))
        return F.aggregate(chunk["part"], start, step, lambda acc: F.array_join(acc["out"], ""))

    cut = in_chunks(spans, lambda part: F.struct(part.alias("part"), F.array_max(F.transform(part, lambda s: s["end"])).alias("last")))
    done = let(cut, lambda chunks: F.array_join(F.zip_with(
        chunks, _starts(chunks, lambda at, c: F.greatest(at, c["last"])), of), ""))
    end = F.array_max(F.transform(spans, lambda s: s["end"]))
    return F.when(F.size(spans) > 0, F.concat(done, F.substr(text, (end + 1).cast("int")))).otherwise(text)


def no_spans() -> Column:
    return F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` comma-joined; ``spans`` are structs with kind, start, end."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sorted_spans(parts: list[tuple[str, Column]]) -> Column:
    """Span arrays of several kinds in one array by start, then by listed kind."""
    def tag(n: int, kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(n).alias("ord"), s["end"].alias("end"),
            F.lit(kind).alias("kind")))

    return F.array_sort(F.concat(*[tag(n, kind, spans) for n, (kind, spans) in enumerate(parts)]))


def count_kind(kind: str) -> Column:
    """How many entries of the column ``spans`` are of a kind."""
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
