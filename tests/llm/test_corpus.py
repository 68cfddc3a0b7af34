"""Packing, line dedup, BPE, language ID, neighbours and the Jaccard join."""

from __future__ import annotations

import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import ann, bpe, components, jaccard_join, language, line_dedup, packing, queries, tokens

SMALL = "/root/testdata/sf0.001"
EMPTY = "doc_id long, text string"

HARD = [
    None, "", "   ", "hello world", "Hello\tWORLD x y\x1cz\x1f", "don't I'll WE'VE it's 1234 ½ ² x²y",
    "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>!", "<|END|> <|endoftext |>",
    "ΣΊΣΥΦΟΣ ΟΔΟΣ Σ İstanbul ǅ ﬁ Ａ", "é é é̂ ́lone", "日本語テキスト 한국어 العربية हिन्दी",
    "🙂👩‍👩‍👧🏽 \U0001F1E9\U0001F1EA", "!!!???...---___", "a" * 700, "ab" * 400 + "." * 300, "\x00\x01﻿​",
    "the quick brown fox " * 50, "x\x85y z᠎w", "ſtraße ẞ ŉ ǰ",
]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, length int, ids string")


def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_path())
    t.no_truncation()
    t.no_padding()
    return t


# ---- BPE -------------------------------------------------------------------------

def test_bpe_words_match_library():
    own, lib = bpe.PrefixEncoder(tokens.default_path()), library()
    for t in HARD[1:]:
        want = lib.encode(t, add_special_tokens=False).ids
        got = [i for c in tokens.chunks_of(t) for i in own.encode_chunk(c)]
        assert got == want, t
        assert own.decode(got) == lib.decode(want, skip_special_tokens=False)


def test_bpe_every_character():
    own, lib = bpe.PrefixEncoder(tokens.default_path()), library()
    chars = [chr(c) for c in range(1, 0x3000)] + [chr(c) for c in range(0xF900, 0x10000)] + \
        [chr(c) for c in range(0x1F300, 0x1F700)]
    bad = [hex(ord(c)) for c in chars if [i for k in tokens.chunks_of(f"a{c}B") for i in own.encode_chunk(k)]
           != lib.encode(f"a{c}B", add_special_tokens=False).ids]
    assert not bad


def test_bpe_random_words():
    own, lib = bpe.PrefixEncoder(tokens.default_path()), library()
    rng = np.random.default_rng(3)
    for alphabet in ("aehinorst", "ab", "tion", "éè, .'sd", "lrwuvm'0"):
        for _ in range(150):
            w = "".join(rng.choice(list(alphabet), rng.integers(1, 40)))
            assert [i for c in tokens.chunks_of(w) for i in own.encode_chunk(c)] == \
                lib.encode(w, add_special_tokens=False).ids, w


def test_bpe_query(spark):
    lib = library()
    rows = queries.queries()["op4_bpe"](spark, SMALL).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(lib.decode(ids, skip_special_tokens=False)))
    out = {r.doc_id: r for r in bpe.encode_decode(docs_of(spark, HARD)).collect()}
    assert len(out) == len(HARD) and out[0].ids == [] and out[0].decoded == ""
    assert bpe.encode_decode(spark.createDataFrame([], EMPTY)).count() == 0


# ---- packing -----------------------------------------------------------------------

def check_packing(rows, texts, window=2048):
    lib = library()
    ids = {i: [*(lib.encode(t or "", add_special_tokens=False).ids), 1] for i, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert (zlib.crc32(part), len(ids[r.doc_id])) == (r.ids_crc32, r.doc_tokens)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0
            at += p.length
        assert at == len(ids[i])
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or at < window and at & (at - 1) == 0


def test_column_ids_match_the_library():
    """Chunks numbered by Arrow, letters straight to the merges: the ids of whole texts."""
    import random

    import pyarrow as pa
    rnd, lib, cache = random.Random(5), library(), tokens.library_cache(tokens.default_path())
    parts = ["a", "B", "é", "É", ",", ".", "!", "***", "-", "'", "s", "S", " ", "\n", "<|endoftext|>", "<", "|>", "1", "½",
             "\u0301", "—", "日", "Σ", "\x85", "\x1c", "İ", "ı", "ß", "ǆ", "ŉ", "ª"]
    texts = [t or "" for t in HARD] + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(12))) for _ in range(4000)]
    texts += [f"{a}{chr(c)}{b}" for c in range(1, 0x300) for a in ("", "a") for b in ("b", ".", "!?")]
    for some in (texts, [t for t in texts if "<|" not in t], ["", ""], []):
        ids, ends = cache.column_ids(pa.array(["skipped", *some], pa.string()).slice(1))
        assert len(ends) == len(some)
        for at, end, t in zip([0, *ends.tolist()], ends.tolist(), some):
            assert ids[at:end].tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_packing_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    check_packing(queries.queries()["op1_packing"](spark, SMALL).collect(), texts)


def test_packing_hard_and_hot(spark):
    texts = [*HARD, *["many equal copies of this text " * 40] * 60, "long " * 9000]
    df = docs_of(spark, texts).repartition(3)
    rows = packing.digest(packing.pack(df, block_tokens=3000)).collect()
    check_packing(rows, dict(enumerate(texts)))
    assert packing.pack(spark.createDataFrame([], EMPTY)).count() == 0
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, None)], EMPTY)
    assert sorted((str(r.doc_id), r.doc_tokens) for r in packing.pack(twice).collect())[:1] == [("7", 1)]


def test_best_fill_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        counts = {int(k): int(rng.integers(1, 4)) for k in rng.integers(1, 30, 4)}
        cap = int(rng.integers(1, 60))
        reach = {0}
        for k, n in counts.items():
            reach = {s + k * j for s in reach for j in range(n + 1)}
        used = packing.best_fill(counts, cap)
        assert all(n <= counts[k] for k, n in used.items())
        assert sum(k * n for k, n in used.items()) == max(s for s in reach if s <= cap)


# ---- line dedup ----------------------------------------------------------------------

LONG = "This line is long enough to count as a line of its own."


def line_texts():
    texts = [f"{LONG}\nunique line number {i} that is long enough as well, truly\nshort" for i in range(8)]
    texts += [f"  \t{LONG.upper()}\x0b\r\n{LONG}", None, "", "\n\n", "é" * 40, "é" * 39, *["é" * 40 + "\n" + "x" * 39] * 5]
    return texts


def test_line_dedup_small(spark):
    texts = line_texts()
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_docs int, key string")
    got = line_dedup.dedup_lines(df)
    rows = sorted(tuple(r) for r in line_dedup.digest(got).collect())
    assert rows == sorted(brute.line_dedup(list(enumerate(texts))))
    assert set(df.columns) <= set(got.columns)


def test_line_dedup_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.queries()["op3_line_dedup"](spark, SMALL).collect())
    assert got == sorted(brute.line_dedup(rows))


def test_line_dedup_tiny_filters(spark):
    """Full filters answer maybe, results stay exact."""
    texts = [f"line {j % 60} that is long enough to be counted here, yes" + f"\n{LONG} {j % 7}" for j in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), EMPTY)
    got = line_dedup.dedup_lines(df, n_shards=2, n_buckets=4)
    assert sorted(tuple(r) for r in line_dedup.digest(got).collect()) == sorted(brute.line_dedup(list(enumerate(texts))))


def test_line_index_is_reversible(spark):
    texts = line_texts()
    first = spark.createDataFrame(list(enumerate(texts)), EMPTY)
    more = spark.createDataFrame([(100 + i, f"{LONG}\nanother line that several new documents have in common") for i in range(6)], EMPTY)
    index = line_dedup.LineIndex.empty(spark).insert(first)
    grown = index.insert(more).insert(more)      # inserting twice changes nothing
    both = list(enumerate(texts)) + [(r.doc_id, r.text) for r in more.collect()]
    want = sorted(brute.line_dedup(both))
    assert sorted(tuple(r) for r in line_dedup.digest(grown.dedup(first.unionByName(more))).collect()) == want
    back = grown.delete(more.select("doc_id"))
    state = lambda x: (sorted((bytes(r.key), r.doc_id) for r in x.refs.collect()),
                       sorted((bytes(r.key), r.n_docs, r.last_doc) for r in x.counts.collect()))
    assert state(back) == state(index)
    assert sorted(tuple(r) for r in line_dedup.digest(back.dedup(first)).collect()) == \
        sorted(brute.line_dedup(list(enumerate(texts))))
    filters = {r.shard: r.filter for r in back.filters.collect()}
    ours = {r.shard: r.filter for r in index.filters.collect()}
    assert all(not np.frombuffer(bytes(filters[s])[1:], "<u2").any() for s in filters if s not in ours)


def test_line_filters_follow_the_counts(spark):
    """Shards grow with the frequent keys, none stays full, and shrink after deletion."""
    lines = [f"line {j} that is long enough to be counted here, yes" for j in range(300)]
    few = spark.createDataFrame([(i, "\n".join(lines[:5])) for i in range(6)], EMPTY)
    many = spark.createDataFrame([(100 + i, "\n".join(lines)) for i in range(6)], EMPTY)
    index = line_dedup.LineIndex.empty(spark, n_shards=1, n_buckets=4).insert(few)
    grown = index.insert(many)
    assert index.shards == 1 and grown.shards * 12 >= 300
    for x in (index, grown):
        filters = {r.shard: line_dedup.CuckooFilter.from_bytes(bytes(r.filter)) for r in x.filters.collect()}
        keys = [bytes(r.key) for r in x.counts.filter("n_docs >= 5").collect()]
        assert not any(f.full for f in filters.values())
        for key, s in zip(keys, line_dedup.shard_of(line_dedup.CuckooFilter.hashes(keys), x.shards), strict=True):
            assert filters[int(s)].maybe(line_dedup.CuckooFilter.hashes([key])).all()
    rows = [(r.doc_id, r.text) for r in few.unionByName(many).collect()]
    assert sorted(tuple(r) for r in line_dedup.digest(grown.dedup(few.unionByName(many))).collect()) == \
        sorted(brute.line_dedup(rows))
    back = grown.delete(many.select("doc_id"))
    assert back.shards == 1
    assert {r.shard: r.filter for r in back.filters.collect()} == {r.shard: r.filter for r in index.filters.collect()}
    assert sorted(tuple(r) for r in line_dedup.digest(back.dedup(few)).collect()) == sorted(brute.line_dedup(rows[:6]))


def test_line_filters_beyond_a_broadcast(spark, monkeypatch):
    """Keys come to the shards when the filters outgrow the broadcast; the rows are the same."""
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    texts = [f"line {j % 60} that is long enough to be counted here, yes" + f"\n{LONG} {j % 7}" for j in range(400)]
    texts += line_texts()
    df = spark.createDataFrame([*enumerate(texts), (None, LONG + " 1"), (None, None), (3, LONG + " 2")], EMPTY)
    df = df.withColumn("key", F.lit(1)).withColumn("step", F.lit("x"))
    index = line_dedup.LineIndex.empty(spark, n_shards=4, n_buckets=16).insert(df)
    got = sorted(tuple(r)[1:] + (str(r.doc_id),) for r in line_dedup.digest(index.dedup(df)).collect())
    monkeypatch.undo()
    want = sorted(tuple(r)[1:] + (str(r.doc_id),) for r in line_dedup.digest(index.dedup(df)).collect())
    assert got == want and any(r[1] for r in got)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    got = sorted(tuple(r) for r in queries.queries()["op3_line_dedup"](spark, SMALL).collect())
    assert got == sorted(brute.line_dedup(rows))


def test_line_dedup_ids(spark):
    """Rows that share an id are one document; the null id is one too."""
    rows = [(1, LONG)] * 6 + [(None, LONG)] * 3 + [(2, LONG), (3, LONG)]
    got = line_dedup.digest(line_dedup.dedup_lines(spark.createDataFrame(rows, EMPTY))).collect()
    assert all(r.n_dropped == 0 for r in got) and len(got) == len(rows)
    got = line_dedup.digest(line_dedup.dedup_lines(spark.createDataFrame([*rows, (4, LONG)], EMPTY))).collect()
    assert sorted((str(r.doc_id), r.n_dropped) for r in got) == sorted(
        [("1", 1)] * 6 + [("None", 1)] * 3 + [("2", 1), ("3", 1), ("4", 0)])
    assert line_dedup.dedup_lines(spark.createDataFrame([], EMPTY)).count() == 0


# ---- language ---------------------------------------------------------------------------

def test_language_query(spark):
    rows = queries.queries()["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang]
    assert all(r.held_out == brute.is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held)
    assert right > 0.97, right


def test_language_matches_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in rows}
    want = brute.languages([(t, lang) for i, t, lang in rows if not out[i]], [(i, t) for i, t, _ in rows])
    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.queries()["op5_language_id"](spark, SMALL).collect()}
    assert {i: lang for i, lang, _ in want} == {i: g[0] for i, g in got.items()}
    assert all(abs(got[i][1] - score) < 1e-12 for i, _, score in want)


def test_language_segments_go_on_from_each_other(monkeypatch):
    text = "Straße " * 20 + "日本語" * 40 + "..a1b " + "x" * 50 + " É" + "\n" * 9
    codes, n = language.grams(text)
    assert dict(zip(codes.tolist(), n.tolist(), strict=True)) == brute.language_grams(text)
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(language, "SEGMENT", size)
        again = language.grams(text)
        assert again[0].tolist() == codes.tolist() and again[1].tolist() == n.tolist()


def test_language_cases(spark):
    df = spark.createDataFrame([(1, "the cat and the dog", "en", "x"), (2, "le chat et le chien", "fr", "y"),
                                (3, "nothing", None, "z"), (4, None, "de", "z")],
                               "doc_id long, text string, lang string, score string")
    profiles = language.train(df)
    assert {p[0] for p in profiles} == {"en", "fr"}
    asked = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "the the"), (None, "le le"), (5, "Ω")], EMPTY)
    got = {str(r.doc_id): (r.lang_pred, r.score) for r in language.identify(asked, profiles).collect()}
    assert got["1"] == got["2"] == got["3"] == ("und", 0.0)
    assert got["4"][0] == "en" and got["None"][0] == "fr" and got["5"][0] in ("en", "fr")
    assert language.identify(asked, []).filter("lang_pred != 'und'").count() == 0
    assert language.identify(spark.createDataFrame([], EMPTY), profiles).count() == 0


def test_language_segments():
    text = "alpha beta gamma delta " * 500
    whole = language.grams(text)
    old, language.SEGMENT = language.SEGMENT, 100
    try:
        parts = language.grams(text)
    finally:
        language.SEGMENT = old
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


# ---- neighbours ----------------------------------------------------------------------------

def exact_neighbours(rows, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            s = x @ np.array(v, np.float64)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), s[j]) for j in order]
    return out


def test_ann_recall(spark):
    rows = queries.queries()["op7_ann"](spark, "/root/testdata/sf0.1").collect()
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want = exact_neighbours(given)
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    for q, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda p: (-p[1], p[0]))


def test_ann_shards_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(60, 8)).round(2)
    rows = [(i, base[i % 60].tolist(), "x") for i in range(300)]
    rows += [(300 + i, base[0].tolist(), "x") for i in range(200)]
    bad = [(900, None, "x"), (901, [0.0] * 8, "x"), (920, [float("nan")] * 8, "x"), (921, [None] * 8, "x"),
           (922, [float("inf")] + [1.0] * 7, "x"), (None, base[1].tolist(), "x"), (940, [], "x"), (960, [1.0, 2.0], "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, score string")
    asked = ann.usable(df).filter(F.col("vec_id") % 20 == 0)
    got = defaultdict(list)
    for r in sorted(ann.search(asked, ann.build_index(df, shard_points=20), query_block=5).collect(),
                    key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    want = exact_neighbours([(i, np.array(v, np.float32)) for i, v, _ in rows])
    assert got == {q: [(i, round(s, 9)) for i, s in w] for q, w in want.items()}


def test_ann_few_and_none(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (21, [0.5, 0.5]), (40, [0.0, -1.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): r.vec_id for r in ann.search(
        ann.usable(df).filter("vec_id % 20 = 0"), ann.build_index(df)).collect()}
    assert got == {(20, 1): 21, (20, 2): 40, (40, 1): 20, (40, 2): 21}
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.search(ann.usable(none), ann.build_index(none)).count() == 0


# ---- Jaccard join ---------------------------------------------------------------------------

def near_texts(seed=11):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one two", "ONE  two", "one two three four five", "a b c d", "a b c d"]
    for _ in range(12):
        base = list(rng.choice(vocab, int(rng.integers(20, 160))))
        for _ in range(int(rng.integers(1, 9))):
            t = list(base)
            for _ in range(int(rng.integers(0, 1 + len(t) // 25))):
                t[int(rng.integers(len(t)))] = str(rng.choice(vocab))
            texts.append(" ".join(t))
    passage = " ".join(rng.choice(vocab, 30))
    texts += [passage + " " + " ".join(rng.choice(vocab, int(n))) for n in rng.integers(0, 60, 40)]
    return texts


@pytest.mark.parametrize("seed", [11, 12])
def test_jaccard_small(spark, seed):
    texts = near_texts(seed)
    df = docs_of(spark, texts).withColumn("sig", F.lit(1)).withColumn("n", F.lit("x"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_groups(df).collect()}
    assert got == brute.jaccard_components(list(enumerate(texts)))


def test_jaccard_rounds_find_all(spark):
    """Without star tokens everything must come from the prefixes."""
    texts = near_texts(13)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.join_groups(docs_of(spark, texts), stars=0).collect()}
    assert got == brute.jaccard_components(list(enumerate(texts)))


def test_jaccard_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.queries()["op10_ngram_jaccard"](spark, SMALL).collect()}
    assert got == brute.jaccard_components(rows)


def test_jaccard_keep_one_and_ids(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(5, t, 1), (3, t, 2), (None, t, 3), (3, t + " x", 4), (9, None, 5), (8, "", 6)],
                               "doc_id long, text string, n int")
    got = sorted((str(r.doc_id), r.component_id) for r in jaccard_join.join_groups(df).collect())
    assert got == [("3", 3), ("3", 3), ("5", 3), ("8", 8), ("9", 9), ("None", 3)]
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.n for r in kept.collect()) == [2, 4, 5, 6]
    none = spark.createDataFrame([], EMPTY)
    assert jaccard_join.join_groups(none).count() == 0


def test_jaccard_keep_one_judges_rows_not_ids(spark):
    """Unique texts under a null or shared id stay; each group leaves one document."""
    t, u, v, w, x = (" ".join(f"{c}{i}" for i in range(30)) for c in "tuvwx")
    df = spark.createDataFrame([
        (5, t, 1), (None, t + " x", 2), (None, u, 3),          # a copy and a unique text without id
        (7, t, 4), (7, v, 5), (6, w, 6), (8, w, 7), (8, v + " y", 8),  # ids of two texts
        (None, x, 9), (None, x + " z", 10), (None, x, 11),     # a group without ids
        (4, "equal rows of one id stay once", 12), (4, "equal rows of one id stay once", 12),
        (4, "EQUAL rows of one id stay once", 12), (2, "", 13), (2, "", 13)],
        "doc_id long, text string, `a.n` int")
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(r["a.n"] for r in kept.collect())
    assert [n for n in got if n not in (9, 10, 11)] == [1, 3, 5, 6, 12, 13, 13]
    assert sum(n in (9, 10, 11) for n in got) == 1


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7)] + [(300, 300 + i) for i in range(1, 50)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100, **{300 + i: 300 for i in range(50)}}


@pytest.mark.parametrize("kind", ["clustered", "log-normal", "outlier"])
def test_ann_recall_whatever_the_norms(spark, kind):
    """Three full shards and more; norms over several powers of ten."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 24))
    x = centres[rng.integers(0, 60, 6000)] + 0.5 * rng.normal(size=(6000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "log-normal":
        x *= np.exp(rng.normal(size=(6000, 1)))
    if kind == "outlier":
        x[17] *= 1e4
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    index = ann.build_index(df, shard_points=2000)
    assert index.count() >= 3
    got = ann.search(ann.usable(df).filter("vec_id % 20 = 0"), index).collect()
    hit = 0
    for i in range(0, 6000, 20):
        score = x @ x[i]
        score[i] = -np.inf
        hit += len(set(np.argsort(-score)[:20].tolist()) & {r.vec_id for r in got if r.query_id == i})
    assert hit >= 0.95 * 300 * 20
