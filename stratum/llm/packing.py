"""Packing (1): token sequences of one length by minimum bin slack.

Every document is tokenised, closed with an end id and cut into full windows
and a rest.  The rests are a multiset of lengths.  For each window the longest
rest is taken as the seed and a bitset subset-sum over the remaining lengths
finds the multiset that fills the window closest to capacity; backtracking
through the bitsets gives the count of each length.  A pattern is repeated
while the counts last.  If some slack remains, the longest rest left is cut to
fill it, so every window but the last of a task is full; the last one is
written as pieces at powers of two, which need no padding either.

Packing runs inside the tasks that tokenise, on blocks of a bounded number of
tokens: no shuffle, nothing on the driver, memory bounded by the block and the
longest single document.  A lost task is repeated with the same result, since
its rows come from the same scan in the same order (after a shuffle: ``pin_order``).

Defined results: null or empty text is the end id alone; repeated rows and
rows with a null or repeated doc_id are packed one by one; an empty table
gives no pieces; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy
from .tokens import default_path, forget_chunks, library_cache

WINDOW = 2048
END_ID = 1
BLOCK_TOKENS = 2_000_000
PART_BYTES = 4 << 20            # text that is tokenised at a time
# Sequence ids: the task in the high bits, the window's number in the low ones.
TASK_SHIFT = 36


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of available lengths whose sum is closest to capacity.

    Bit s of the set says that sum s can be reached.  Counts enter in powers of
    two; the sets before each step are kept and followed back for the counts.
    """
    reach, steps = 1, []
    limit = (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        left = min(counts[length], capacity // length)
        copies = 1
        while left:
            take = min(copies, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & limit
            left -= take
            copies *= 2
        if reach >> capacity & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= length * take
    return used


class Packer:
    """Windows of one task; ``out`` collects (item, start, length, sequence, offset)."""

    def __init__(self, window: int = WINDOW):
        self.window, self.n_sequences = window, 0
        self.rests: dict[int, list[tuple[int, int]]] = {}   # length -> (item, start)
        self.total = 0
        self.out: list[tuple[int, int, int, int, int]] = []

    def add(self, item: int, n_tokens: int) -> None:
        start = 0
        while n_tokens - start >= self.window:
            self._emit([(item, start, self.window)])
            start += self.window
        self._rest(item, start, n_tokens - start)

    def _rest(self, item: int, start: int, length: int) -> None:
        if length:
            self.rests.setdefault(length, []).append((item, start))
            self.total += length

    def _take(self, length: int) -> tuple[int, int, int]:
        held = self.rests[length]
        item, start = held.pop()
        if not held:
            del self.rests[length]
        self.total -= length
        return item, start, length

    def _emit(self, pieces: list[tuple[int, int, int]]) -> None:
        offset = 0
        for item, start, length in pieces:
            self.out.append((item, start, length, self.n_sequences, offset))
            offset += length
        self.n_sequences += 1

    def fill(self) -> None:
        """Make full windows while the rests suffice for one."""
        while self.total >= self.window:
            counts = {length: len(held) for length, held in self.rests.items()}
            seed = max(counts)
            counts[seed] -= 1
            pattern = best_fill({k: n for k, n in counts.items() if n}, self.window - seed)
            pattern[seed] = pattern.get(seed, 0) + 1
            used = sum(k * n for k, n in pattern.items())
            if used == self.window:
                for _ in range(min(len(self.rests[k]) // n for k, n in pattern.items())):
                    self._emit([self._take(k) for k, n in pattern.items() for _ in range(n)])
                continue
            pieces = [self._take(k) for k, n in pattern.items() for _ in range(n)]
            self._emit([*pieces, self._cut(self.window - used)])

    def _cut(self, length: int) -> tuple[int, int, int]:
        """The first ``length`` tokens of the longest rest (which is longer)."""
        item, start, whole = self._take(max(self.rests))
        self._rest(item, start + length, whole - length)
        return item, start, length

    def finish(self) -> None:
        """What is left, less than a window, in sequences at powers of two."""
        while self.total:
            room, pieces = 1 << (self.total.bit_length() - 1), []
            while room:
                longest = max(self.rests)
                pieces.append(self._take(longest) if longest <= room else self._cut(room))
                room -= pieces[-1][2]
            self._emit(pieces)


def _parts(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have up to ``most`` bytes, or of one longer row."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(end, len(texts))
        at = end


def _window_batches(path: str, window: int, end_id: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << TASK_SHIFT
        cache, packer = library_cache(path), Packer(window)
        keys: dict[int, object] = {}
        ids: dict[int, np.ndarray] = {}             # views of a block's ids
        n_items = held = 0
        key_type = None

        def flush() -> Iterator[pa.RecordBatch]:
            pieces, packer.out = packer.out, []
            for i in range(0, len(pieces), 5000):
                some = pieces[i:i + 5000]
                item, start, length, seq, offset = zip(*some, strict=True)
                cut = np.concatenate([ids[k][s:s + n] for k, s, n, *_ in some])
                ends = np.concatenate(([0], np.cumsum(length))) * 4
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[k] for k in item], key_type), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.BinaryArray.from_buffers(pa.binary(), len(some), [
                        None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(cut)]),
                    pa.array([len(ids[k]) for k in item], pa.int64()),
                    pa.array(np.array(seq, np.int64) + base), pa.array(offset, pa.int64())],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            live = {item for rest in packer.rests.values() for item, _ in rest}
            for k in [k for k in ids if k not in live]:
                del ids[k], keys[k]
            for k in live:
                ids[k] = ids[k].copy()              # lets go of the block

        for batch in batches:
            key_type = batch.column(0).type
            texts = batch.column(1).cast(pa.large_string())
            for a, b in _parts(texts, PART_BYTES):
                found, ends = cache.column_ids(texts.slice(a, b - a))
                block = np.insert(found, ends, end_id).astype("<u4")
                at = 0
                for key, end in zip(batch.column(0).slice(a, b - a).to_pylist(),
                                    (ends + np.arange(1, b - a + 1)).tolist(), strict=True):
                    keys[n_items], ids[n_items] = key, block[at:end]
                    packer.add(n_items, end - at)
                    n_items, held, at = n_items + 1, held + end - at, end
                if held >= block_tokens:
                    packer.fill()
                    yield from flush()
                    held = 0
        packer.fill()
        packer.finish()
        yield from flush()

    return run


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID,
         block_tokens: int = BLOCK_TOKENS, pin_order: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian
    unsigned 32 bit), doc_tokens, sequence_id, offset.

    Pieces of a sequence, in the order of offset and without gaps, are its ids.
    ``pin_order`` is for rows that come from a shuffle, whose order may change when a
    task is repeated: they are sorted inside their partitions first.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if pin_order:
        rows = rows.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    path = path or default_path()
    return rows.mapInArrow(
        tidy(_window_batches(path, window, end_id, block_tokens), lambda: forget_chunks(path)),
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
