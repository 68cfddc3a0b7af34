"""BPE encoding and decoding (4) by dynamic programming over prefixes.

For every prefix of a word exactly one token can be the last one of its BPE
encoding.  A suffix automaton of the vocabulary reads the word once; its state
is the longest end of the prefix that stands inside some token, and the links
from state to state that mark whole tokens list the tokens that end there,
longest first.  The one that is compatible with the last token of the prefix
before it is the prefix's last token.  Following the last tokens back from the
end of the word gives the ids that merging would give.

Two tokens are compatible if they stand side by side in the encoding of their
concatenation.  A merge applies as soon as its pair exists, and a pair's merge
is always later than those that made its parts, so ranks are points in time:
the two tokens are taken apart at their common border, the later one first,
and no pair met there may have a merge that would have come first.

Defined results: null or empty text has no ids and decodes to empty text;
repeated rows are encoded one by one; an empty table gives an empty result;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import ChunkCache, default_path

_NEVER = 1 << 60


def _ranges(chars: str) -> str:
    """The contents of a character class that matches the given characters."""
    codes = np.array(sorted(map(ord, set(chars))), np.int64)
    breaks = np.flatnonzero(np.diff(codes) != 1) + 1
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in np.split(codes, breaks) if len(r))


@lru_cache(maxsize=1)
def _newer() -> str:
    """Letters, numbers and marks newer than Python's Unicode version."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    return "".join(c for c in regex.findall(r"[\p{L}\p{N}\p{M}]", every) if unicodedata.category(c) == "Cn")


@lru_cache(maxsize=1)
def _words() -> regex.Pattern:
    """The pattern that splits normalised text into words (a fixed value).

    Letters and numbers that are newer than the tokenizers library's own
    Unicode tables are neither in its eyes, so they are taken out of both.
    """
    from tokenizers import Regex, pre_tokenizers

    def too_new(kind: str) -> str:
        ours = regex.findall(rf"\p{{{kind}}}", _newer())
        theirs = pre_tokenizers.Split(Regex(rf"\p{{{kind}}}"), "removed", True).pre_tokenize_str("".join(ours))
        return _ranges("".join(set(ours) - {c for piece, _ in theirs for c in piece}))

    letters, numbers = too_new("L"), too_new("N")
    no_letter, no_number = (f"--[{x}]" if x else "" for x in (letters, numbers))
    return regex.compile(
        rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}{no_letter}]+|[\p{{N}}{no_number}]"
        rf"|[[^\p{{White_Space}}\p{{L}}\p{{N}}]{letters}{numbers}]+")


def _byte_names() -> list[str]:
    """The printable character that stands for each byte: itself, or else the
    next free one from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in own}
    rest = [b for b in range(256) if b not in names]
    return [names.get(b) or chr(256 + rest.index(b)) for b in range(256)]


class SuffixAutomaton:
    """All substrings of the tokens; ``token`` marks the states that are whole tokens (-1: none).

    A state's longest string has ``length`` symbols; ``link`` leads to the longest of its
    ends that is a state of its own, ``shorter`` to the next such state that is a token (0: none).
    """

    def __init__(self, tokens: dict[int, str]):
        self.step: list[dict[str, int]] = [{}]
        self.length, self.link, self.token = [0], [-1], [-1]
        for i, symbols in tokens.items():
            state = 0
            for c in symbols:
                state = self._extended(state, c)
            self.token[state] = i
        self.shorter = [0] * len(self.step)
        for s in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            up = self.link[s]
            self.shorter[s] = up if self.token[up] >= 0 else self.shorter[up]

    def _new(self, length: int, step: dict[str, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        self.token.append(-1)
        return len(self.step) - 1

    def _extended(self, state: int, c: str) -> int:
        """The state of the string read so far with one more symbol."""
        if c in self.step[state]:
            return self._exact(state, c)
        made, at = self._new(self.length[state] + 1, {}, 0), state
        while at >= 0 and c not in self.step[at]:
            self.step[at][c] = made
            at = self.link[at]
        if at >= 0:
            self.link[made] = self._exact(at, c)
        return made

    def _exact(self, state: int, c: str) -> int:
        """The state after ``c`` whose longest string is just one symbol longer; split off if need be."""
        there, length = self.step[state][c], self.length[state] + 1
        if self.length[there] == length:
            return there
        own = self._new(length, dict(self.step[there]), self.link[there])
        self.link[there] = own
        while state >= 0 and self.step[state].get(c) == there:
            self.step[state][c] = own
            state = self.link[state]
        return own


class PrefixEncoder:
    """Encoder and decoder for a word-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        # A word is a string with one character, chr(id), per base symbol.
        inner = _byte_names()
        self.inner = [chr(vocab[c]) for c in inner]
        self.final = [chr(vocab[c + suffix]) for c in inner]
        self.rank = {i: -1 for i in vocab.values()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        spelled = {vocab[c]: chr(vocab[c]) for c in [*inner, *(c + suffix for c in inner)]}
        sound = set(spelled)
        for rank, (a, b) in enumerate(model["merges"]):
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.merge[left, right] = rank
            self.rank[made], self.parts[made] = rank, (left, right)
            spelled[made] = spelled[left] + spelled[right]
        for made, (left, right) in self.parts.items():
            # A token that merging can never make is no candidate.
            if left in sound and right in sound and self._apart(left, right, self.rank[made], self.rank[made]):
                sound.add(made)
        self.automaton = SuffixAutomaton({i: spelled[i] for i in sorted(sound)})
        self.pattern, self.newer = _words(), regex.compile(f"[{_ranges(_newer())}]")
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, list[int]] = {}

    def _apart(self, a: int, b: int, a_ends: int, b_ends: int) -> bool:
        """True if no merge across the border of a and b comes first.

        ``a_ends`` and ``b_ends`` are the ranks at which a and b are absorbed
        into their own tokens; of equal pairs the left one merges first.
        """
        while True:
            rank = self.merge.get((a, b), _NEVER)
            if rank < a_ends and rank <= b_ends:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                a, a_ends = self.parts[a][1], ra
            else:
                b, b_ends = self.parts[b][0], rb

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 500_000:
                self.pairs.clear()
            known = self.pairs[a, b] = self._apart(a, b, _NEVER, _NEVER)
        return known

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word (a match of the word pattern)."""
        raw = word.encode()
        symbols = "".join([self.inner[x] for x in raw[:-1]]) + self.final[raw[-1]]
        n = len(symbols)
        last = [-1] * (n + 1)      # the last token of every prefix
        before = [0] * (n + 1)     # where it starts
        step, length, link = self.automaton.step, self.automaton.length, self.automaton.link
        token, shorter = self.automaton.token, self.automaton.shorter
        state = matched = 0
        for end, c in enumerate(symbols, 1):
            following = step[state].get(c)
            while following is None and state:
                state = link[state]
                matched = length[state]
                following = step[state].get(c)
            state, matched = (0, 0) if following is None else (following, matched + 1)
            whole = token[state] >= 0 and length[state] == matched
            ends_here = state if whole else shorter[state]
            while ends_here:
                at = end - length[ends_here]
                if at == 0 or self.compatible(last[at], token[ends_here]):
                    last[end], before[end] = token[ends_here], at
                    break
                ends_here = shorter[ends_here]
        out, end = [], n
        while end:
            out.append(last[end])
            end = before[end]
        return out[::-1]

    def _plain(self, chunk: str) -> list[int]:
        """A chunk without special tokens: normalise, split, encode."""
        if not chunk.isascii() and self.newer.search(chunk):
            # Letters newer than Python's tables: the library knows their lower case.
            text = self.library_normal(chunk)
        else:
            # Lower case is taken character by character: no final form of sigma.
            text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        out = []
        for w in self.pattern.findall(text):
            ids = self.words.get(w)
            if ids is None:
                if len(self.words) > 200_000:
                    self.words.clear()
                ids = self.words[w] = self.encode_word(w)
            out += ids
        return out

    @staticmethod
    def library_normal(chunk: str) -> str:
        from tokenizers import normalizers
        return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str(chunk)

    def encode_chunk(self, chunk: str) -> list[int]:
        out, at = [], 0
        for m in self.split_special.finditer(chunk):
            out += [*self._plain(chunk[at:m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self._plain(chunk[at:])

    def decode(self, ids: list[int]) -> str:
        """The vocabulary has no decoder: token names joined by a space."""
        return " ".join(map(self.names.__getitem__, ids))


_CODERS: dict[str, tuple[PrefixEncoder, ChunkCache]] = {}


def coder(path: str) -> tuple[PrefixEncoder, ChunkCache]:
    if path not in _CODERS:
        own = PrefixEncoder(path)
        _CODERS[path] = own, ChunkCache(lambda chunks: map(own.encode_chunk, chunks))
    return _CODERS[path]


def _pieces(batch: pa.RecordBatch, rows: int = 500) -> Iterator[tuple[pa.Array, list[str]]]:
    for i in range(0, batch.num_rows, rows):
        some = batch.slice(i, rows)
        yield some.column(0), [t or "" for t in some.column(1).to_pylist()]


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every row's whole text."""
    path = path or default_path()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = coder(path)
        for batch in batches:
            for keys, texts in _pieces(batch):
                ids = cache.ids(texts)
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int64)
                flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
                yield pa.RecordBatch.from_arrays([
                    keys, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32))),
                    pa.array([own.decode(x.tolist()) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, decoded string")


def digest(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
