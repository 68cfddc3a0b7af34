"""Token ids of texts, chunk by chunk, with a bounded memory of known chunks.

White space never enters a token of the vocabularies used here and never joins
what stands on its two sides, so a text's ids are those of its white-space
separated chunks, one after the other.  A worker remembers the chunks it has
encoded in two generations of bounded size; the older one is dropped when the
newer one is full, so frequent chunks stay known.  ``forget_chunks`` drops both.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

# str.split() takes these for white space, the tokenizers do not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACES = re.compile("[^\\S\x1c-\x1f]+")
_BYTE = np.arange(256)
_BLANK = np.isin(_BYTE, [9, 10, 11, 12, 13, 32])
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
# Marks that never stand in a special token or a contraction.
_LETTERS, _MARKS = "abcdefghijklmnopqrstuvwxyz", "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_IS_LETTER, _IS_MARK = (np.isin(_BYTE, [ord(c) for c in s]) for s in (_LETTERS + _LETTERS.upper(), _MARKS))
DEFAULT_FILE = "word_bpe_49k.json"


def default_path() -> str:
    """The public vocabulary file; callers may pass any other path instead."""
    import public_tokenizers
    return public_tokenizers.path(DEFAULT_FILE)


def chunks_of(text: str) -> list[str]:
    if _SEPARATORS.search(text):
        return [c for c in _SPACES.split(text) if c]
    return text.split()


class Generations:
    """A bounded memory of ``make(keys) -> values`` (see module doc)."""

    def __init__(self, make: Callable[[list], Iterable], most: int = 600_000):
        self.make, self.most = make, most
        self.known: dict = {}
        self.older: dict = {}

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def lookup(self, keys: list) -> list:
        """The value of every key, in order."""
        try:
            return list(map(self.known.__getitem__, keys))
        except KeyError:
            pass
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        new = []
        for k in set(keys).difference(self.known):
            value = self.older.get(k)
            if value is None:
                new.append(k)
            else:
                self.known[k] = value
        self.known.update(zip(new, self.make(new), strict=True))
        return list(map(self.known.__getitem__, keys))


class ChunkCache:
    """Texts to ids (uint32) through ``encode_many``, which maps chunks to ids.

    ``lowers``: ASCII letters may be lower-cased first; ``splits``: the marks of
    ``_MARKS`` that end a chunk after an ASCII letter are a chunk of their own.  Both only
    make chunks alike, so fewer have to be encoded.
    """

    def __init__(self, encode_many: Callable[[list[str]], Iterable[list[int]]], lowers: bool = False, splits: bool = False):
        self.chunks = Generations(lambda new: [array("I", i).tobytes() for i in encode_many(new)])
        self.lowers, self.splits = lowers, splits

    def ids(self, texts: list[str], part: int = 50_000) -> list[np.ndarray]:
        """Ids of each text; a long text is looked up ``part`` chunks at a time."""
        out = []
        for text in texts:
            chunks = chunks_of(text)
            found = [b"".join(self.chunks.lookup(chunks[i:i + part])) for i in range(0, len(chunks), part)]
            out.append(np.frombuffer(found[0] if len(found) == 1 else b"".join(found), "<u4"))
        return out


    def column_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts of a column, one after the other, and
        where each text's ids end.

        The chunks between ASCII white space are found on the bytes of the whole
        column and numbered by Arrow; only distinct ones are looked up.
        """
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        starts = offsets[:-1] - offsets[0]
        if self.lowers and b"<|" not in memoryview(raw).tobytes():      # special tokens keep their case
            raw = _LOWER[raw]
        inside = ~_BLANK[raw]
        begin, end = inside.copy(), inside.copy()
        cuts = starts[(starts > 0) & (starts < len(raw))]
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        begin[cuts] = inside[cuts]
        end[cuts - 1] = inside[cuts - 1]
        if self.splits:
            mark = inside & _IS_MARK[raw]
            first, last = mark & begin, mark & end      # of every run of marks
            first[1:] |= mark[1:] & ~mark[:-1]
            last[:-1] |= mark[:-1] & ~mark[1:]
            run = np.flatnonzero(first)
            run = run[end[np.flatnonzero(last)] & ~begin[run]]
            run = run[_IS_LETTER[raw[run - 1]]]
            begin[run] = end[run - 1] = True
        at, to = np.flatnonzero(begin), np.flatnonzero(end) + 1
        bounds = np.concatenate(([0], np.cumsum(to - at)))
        chunks = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(raw[inside]))
        coded = chunks.dictionary_encode()
        found = self.chunks.lookup(coded.dictionary.to_pylist())
        which = coded.indices.to_numpy()
        ids = np.frombuffer(b"".join([found[i] for i in which.tolist()]), "<u4")
        until = np.cumsum((np.fromiter(map(len, found), np.int64, len(found)) // 4)[which])
        n_chunks = np.searchsorted(at, np.append(starts[1:], len(raw)))     # up to each text's end
        return ids, np.concatenate(([0], until))[n_chunks[:len(texts)]]


_LIBRARY: dict[str, ChunkCache] = {}


def _encoder(tok) -> Callable[[list[str]], list[list[int]]]:
    """Chunks to ids by a tokenizer of the library.

    A chunk of letters that the tokenizer's own rules leave as they are, and take as one
    piece, goes straight to its merges; every other chunk goes through the tokenizer.
    """
    plain: dict[str, str] = {}
    if tok.normalizer is not None and tok.pre_tokenizer is not None:
        for c in map(chr, range(ord("a"), 0x250)):
            if c.isalpha() and tok.normalizer.normalize_str(c) == c:
                alone, joined = (tok.pre_tokenizer.pre_tokenize_str(t) for t in (c, f"{c}a{c}"))
                if len(alone) == len(joined) == 1 and joined[0][0] == f"{alone[0][0]}a{alone[0][0]}":
                    plain[c] = alone[0][0]
    letters, table, model = "".join(plain), str.maketrans(plain), tok.model

    def encode(chunks: list[str]) -> list[list[int]]:
        out, rest = [], []
        for chunk in chunks:
            if chunk.strip(letters):
                rest.append(len(out))
                out.append([])
            else:
                out.append([t.id for t in model.tokenize(chunk.translate(table))])
        found = tok.encode_batch_fast([chunks[i] for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found, strict=True):
            out[i] = e.ids
        return out

    return encode


def library_cache(path: str) -> ChunkCache:
    """The tokenizers library behind a ``ChunkCache``, one per worker and file."""
    if path not in _LIBRARY:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        # What the vocabulary's own rules do with every letter, and with every letter and mark.
        lowers = tok.normalizer is not None and tok.normalizer.normalize_str(_LETTERS.upper()) == _LETTERS
        splits = tok.pre_tokenizer is not None and all(
            len(tok.pre_tokenizer.pre_tokenize_str(c + m)) == 2 for c in _LETTERS + _LETTERS.upper() for m in _MARKS)
        _LIBRARY[path] = ChunkCache(_encoder(tok), lowers, splits)
    return _LIBRARY[path]


def forget_chunks(path: str) -> None:
    """Drop the chunks that this worker has encoded with a file; the tokenizer stays."""
    if path in _LIBRARY:
        _LIBRARY[path].chunks.forget()
