"""Language ID (5) by rank-order profiles of letter n-grams.

Training counts the 1- to 3-grams of letters (word edges included) of all
labelled texts per language; the most frequent ``top`` of each language, in
order, are its profile.  A document's own most frequent n-grams are compared
with every profile: each n-gram adds the distance between its two ranks, or
``top`` if the profile lacks it, and the language with the smallest sum wins
(ties: the smaller name).  The profiles are at most ``top`` rows per label.

An n-gram is one integer, 21 bits per character, so counting is sorting.

Defined results: null text, or text without a letter, is ``und`` with score 0,
as is every text when nothing was learned; texts of any length are counted
whole, in segments of bounded size that go on from each other; repeated rows are judged one by one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP = 400
UNKNOWN = "und"
EDGE = 1            # stands for the edge of a word; no letter has this code
SEGMENT = 1 << 20   # characters counted at a time


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point: itself if it is a letter, else EDGE."""
    every = np.arange(sys.maxunicode + 1, dtype=np.int64)
    is_letter = np.fromiter((chr(c).isalpha() for c in every), bool, len(every))
    return np.where(is_letter, every, EDGE)


def _segment_grams(text: str, before: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that end in this segment, and the codes that the next one goes on from."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    codes = np.concatenate((before, codes, [EDGE] if last else []))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != EDGE) | (codes[:-1] != EDGE)
    c = codes[keep].astype(np.int64)
    one = c[len(before):]
    two = (c[:-1] << 21) | c[1:]
    three = ((two[:-1] << 21) | c[2:])[c[1:-1] != EDGE] if len(c) > 2 else two[:0]
    known = max(0, len(before) - 1)         # pairs of ``before`` were counted with it
    return np.concatenate((one[one != EDGE], two[known:], three)), c[-2:]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text (ascending) and their counts."""
    low, parts, before = text.lower(), [], np.array([EDGE])
    for at in range(0, len(low), SEGMENT):
        found, before = _segment_grams(low[at:at + SEGMENT], before, at + SEGMENT >= len(low))
        parts.append(np.unique(found, return_counts=True))
    return _added(parts)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(place, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) rows to (lang, gram, n), summed per task."""
    held: dict[str, list] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            codes, n = _added(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], ["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = grams(text.as_py())
            held.setdefault(lang, []).append(part)
            size += len(part[0])
            if size > 2_000_000:
                held = {k: [_added(v)] for k, v in held.items()}
                size = sum(len(v[0][0]) for v in held.values())
                if size > 1_000_000:
                    yield from out()
                    held, size = {}, 0
    yield from out()


def train(docs: DataFrame, top: int = TOP) -> list[tuple[str, int, int]]:
    """Profiles as (lang, rank, gram), learned from text and non-null lang."""
    counted = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")) \
        .dropna().mapInArrow(_count, "lang string, gram long, n long")
    total = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = total.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < top)
    return sorted((r.lang, r.rank, r.gram) for r in best.select("lang", "rank", "gram").collect())


class Classifier:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, profiles: list[tuple[str, int, int]], top: int = TOP):
        self.top = top
        self.langs = sorted({p[0] for p in profiles})
        self.grams = np.unique(np.array([p[2] for p in profiles], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        column = {lang: k for k, lang in enumerate(self.langs)}
        for lang, rank, gram in profiles:
            self.ranks[np.searchsorted(self.grams, gram), column[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, n = grams(text or "")
        if not self.langs or not (codes < 1 << 21).any():
            return UNKNOWN, 0.0
        first = np.lexsort((codes, -n))[:self.top]
        own = codes[first]
        at = np.searchsorted(self.grams, own)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != own)] = len(self.grams)
        theirs = self.ranks[at]
        apart = np.where(theirs < 0, self.top, np.abs(theirs - np.arange(len(own))[:, None])).sum(0)
        best = int(np.argmin(apart))
        return self.langs[best], float(1 - apart[best] / (self.top * len(own)))


def identify(docs: DataFrame, profiles: list[tuple[str, int, int]], top: int = TOP) -> DataFrame:
    """(doc_id, lang_pred, score) of every row's whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Classifier(profiles, top)
        for batch in batches:
            got = [own.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([g[0] for g in got], pa.string()),
                pa.array([g[1] for g in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the ids that training never sees."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
