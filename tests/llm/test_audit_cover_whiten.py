"""Source divergence audit, covering SimHash and embedding whitening."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratum.llm import divergence, queries, simhash_cover, symmetric_eigen, whitening
from test_plans import plan_text

SMALL = "/root/testdata/sf0.001"


# ---- 11: divergence --------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, min_docs=10, top=10):
    rows = [(lang or "", source or "", [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")])
            for lang, source, text in rows]
    docs, count = Counter(), defaultdict(Counter)
    for lang, source, terms in rows:
        docs.update((lang, t) for t in set(terms))
        count[lang, source].update(terms)
    out = []
    for lang in {r[0] for r in rows}:
        kept = [t for (la, t), n in docs.items() if la == lang and n >= min_docs]
        sources = [s for la, s in count if la == lang]
        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: shares(count[lang, s]) for s in sources}, shares(whole)

        def f(a, b):
            return (a - b) * (a - b) // (a + b)

        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(found[:most], 1)]
    return sorted(out)


def audit_rows(df, **args):
    return sorted(tuple(r) for r in divergence.audit(df, **args).collect())


def audit_docs(seed=3, n=260):
    rng = np.random.default_rng(seed)
    vocab = ["a", "Be", "the", "Über", "naïve", "longerword", "sixteenletterswd", "seventeenletters1x", "日本語のとても長い言葉です",
             "x" * 40, "y" * 300, "ÀÉ"] + [f"{c}{d}{e}" * int(k) for c in "abc" for d in "xyz" for e in "mn" for k in rng.integers(1, 7, 2)]
    rows = []
    for _ in range(n):
        words = rng.choice(vocab, int(rng.integers(0, 40)))
        rows.append((str(rng.choice(["en", "de", "é"])), f"s{int(rng.integers(0, 7)) ** 2 % 5}",
                     "".join(w + str(rng.choice([" ", "\n", "-", "7", "\x00", ", "])) for w in words)))
    rows += [(None, "s1", "alone"), ("", None, None), ("fr", "x", ""), ("fr", "y", "x"), ("en", "only", "!!"), ("en", None, None)]
    return rows


def audit_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "q") for r in rows], "lang string, source string, text string, n int, term string")


@pytest.mark.parametrize("blocks", [{}, {"term_block": 5, "source_block": 2}])
def test_audit_small(spark, blocks):
    rows = audit_docs()
    assert audit_rows(audit_frame(spark, rows), **blocks) == brute_audit(rows)


def test_audit_nothing_kept_and_empty(spark):
    rows = audit_docs(n=5)
    assert audit_rows(audit_frame(spark, rows)) == brute_audit(rows)
    assert audit_rows(audit_frame(spark, rows), min_docs=1) == brute_audit(rows, min_docs=1)
    assert audit_rows(audit_frame(spark, [])) == []


def test_term_counter_segments_and_merges():
    """Long texts in segments and early merges give the counts of whole texts."""
    rows = audit_docs(4, 60) + [("en", "s1", " ".join(r[2] for r in audit_docs(5, 200) if r[2])), ("en", "s2", "z" * 900)]
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] or "" for r in rows], pa.string()) for i in range(3)], ["a", "b", "c"])
    want = defaultdict(lambda: [0, 0])
    for lang, source, text in rows:
        for t, n in Counter(TERM.findall(text or "")).items():
            key = (lang or "", source or "", t.translate({c: c + 32 for c in range(65, 91)}))
            want[key][0] += n
    for lang, source, text in rows:
        for t in {t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")}:
            want[lang or "", source or "", t][1] += 1
    for block, held in ((1 << 20, 1 << 20), (300, 50), (64, 10)):
        got = defaultdict(lambda: [0, 0])
        # The first rows as a slice, whose text does not start at the buffer's start.
        for b in divergence._counted(block, held)(iter([batch.slice(0, 7), batch.slice(7)])):
            for r in b.to_pylist():
                got[r["lang"], r["source"], r["term"]][0] += r["n"]
                got[r["lang"], r["source"], r["term"]][1] += r["df"]
        assert got == want


# ---- 12: SimHash -------------------------------------------------------------------------

def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, near):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in combinations(sorted(parent), 2):
        if near(a, b):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {n: root(n) for n in parent}


def brute_simhash(rows, radius=4):
    prints = [(i, brute_print(t)) for i, t in rows]
    root = brute_components({p for _, p in prints}, lambda a, b: (a ^ b).bit_count() <= radius)
    least = defaultdict(list)
    for i, p in prints:
        least[root[p]].append(i)
    return sorted((i, f"{p:016x}", min(least[root[p]])) for i, p in prints)


def test_masks_cover():
    """Any few places are left out by some mask: a set of them of full size suffices."""
    masks = simhash_cover.masks()
    out = np.array([[not m >> i & 1 for m in masks] for i in range(64)])
    for a, b, c in combinations(range(64), 3):
        both = out[a] & out[b] & out[c]
        assert (out & both).any(1).all(), (a, b, c)


def test_fingerprint_segments(monkeypatch):
    text = " ".join(f"W{i % 37} x{i}" for i in range(500))
    whole = simhash_cover.fingerprint(text)
    assert int.from_bytes(whole, "big") == brute_print(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(simhash_cover, "SEGMENT", size)
        assert simhash_cover.fingerprint(text) == whole
    for t in (None, "", " \n", "One", "a b C", "É\x85x y z w v", "a  b\tc\x0bd"):
        assert int.from_bytes(simhash_cover.fingerprint(t), "big") == brute_print(t)


@pytest.mark.parametrize("limit", [simhash_cover.LIMIT, 3, 1])
def test_simhash_small(spark, limit):
    """Small buckets inside the tasks, larger ones by common neighbours: the same."""
    rng = np.random.default_rng(8)
    texts = [None, "", "one", "ONE", "two words", "a b c d", "a b c d e"]
    for _ in range(8):
        base = [f"w{int(i)}" for i in rng.integers(0, 300, 90)]
        for k in range(9):
            t = list(base)
            for _ in range(k):
                t[int(rng.integers(len(t)))] = f"v{int(rng.integers(99))}"
            texts += [" ".join(t)] * (1 + k % 2)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, print int, key string")
    got = sorted(tuple(r) for r in simhash_cover.near_duplicates(df, limit=limit).collect())
    assert got == brute_simhash(list(enumerate(texts)))


@pytest.mark.parametrize("limit", [4096, 2])
def test_links_of_prints(spark, limit):
    """Chains and balls of fingerprints, at and beyond the radius."""
    rng = np.random.default_rng(2)
    prints = set()
    for _ in range(6):
        p = int(rng.integers(0, 1 << 63)) * 2
        for _ in range(40):
            for b in rng.choice(64, int(rng.integers(1, 8)), replace=False):
                p ^= 1 << int(b)
            prints.add(p)
    near = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    df = spark.createDataFrame([(simhash_cover._signed(p),) for p in prints], "print long")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash_cover.links(df, limit=limit).collect()]
    have = {frozenset(x) for x in found}
    assert brute_components(prints, lambda a, b: frozenset((a, b)) in have) == near
    assert len(set(near.values())) < len(prints)


def test_simhash_ids_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, None), (7, "a b c D"), (7, "other words here now")], "doc_id long, text string")
    got = sorted(((str(r.doc_id), r.component_id) for r in simhash_cover.near_duplicates(df).collect()), key=str)
    assert got == [("7", 7), ("7", 7), ("None", 7), ("None", None)]
    assert simhash_cover.near_duplicates(df.limit(0)).count() == 0


def test_simhash_classes_dealt_to_the_tables_are_not_broadcast(spark, monkeypatch):
    """Each class becomes 31 rows, which Spark counts as one: a join sized by that would broadcast millions."""
    joined = {}

    def kept(df, name):
        joined[name] = df
        return df

    monkeypatch.setattr(simhash_cover, "materialise", kept)
    classes = spark.createDataFrame([(7,), (6,), (1 << 40,)], "print long")
    assert simhash_cover.links(classes).count() > 0
    text = plan_text(joined["simhash-buckets"])
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_simhash_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op12_simhash_cover(spark, SMALL).collect())
    assert got == brute_simhash(rows)


# ---- 13: whitening -------------------------------------------------------------------------

def brute_whiten(rows, k=4):
    """numpy's own eigenvectors, exact integers."""
    good = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    w = (np.array([x for _, x in good], float) - mean) @ vectors[:, :k] / np.sqrt(values[:k])
    deviation = [sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for _, x in good]
    return n, [i for i, _ in good], deviation, w, values[:k] / values.sum()


def check_whitened(out, rows, k=4):
    n, ids, deviation, w, explained = brute_whiten(rows, k)
    got = defaultdict(dict)
    for r in out:
        got[r.vec_id][r.component] = r
    assert len(out) == k * len(ids) and set(got) == set(ids)
    mine = np.array([[got[i][j + 1].whitened for j in range(k)] for i in ids])
    for j in range(k):
        sign = np.sign(mine[:, j] @ w[:, j])
        assert np.allclose(mine[:, j] * sign, w[:, j], rtol=1e-7, atol=1e-7)
    for i, d in zip(ids, deviation, strict=True):
        for j in range(k):
            r = got[i][j + 1]
            assert (r.n, int(r.deviation)) == (n, d)
            assert r.explained == pytest.approx(explained[j], rel=1e-9) and 0 <= r.identity_error < 1e-9


def vectors(seed=5, n=150, d=9):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 3
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[i][1]) for i in range(20)]          # copies count once in the fit
    return rows + [(2000, None), (2001, []), (2002, [None] + [1.0] * (d - 1)), (2003, [float("nan")] * d),
                   (2004, [float("inf")] + [0.0] * (d - 1)), (2005, [0.0] * d)]


def test_whitening_small(spark):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, b"x") for i, v in rows], "vec_id long, embedding array<double>, n int, x binary")
    check_whitened(whitening.whiten(df).collect(), rows)


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check_whitened(queries.op13_whitening(spark, SMALL).collect(), rows)


def test_whitening_lengths_and_size(spark):
    """Vectors of a rarer length take no part; huge entries stay exact; few entries give few components."""
    rows = [(1, [1e7, 2.0, 3.0]), (2, [-5e7, 1.0, 7.0]), (3, [3.0, 9e7, 1.5]), (4, [0.5, 1.0]), (None, [1.0, 2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = whitening.whiten(df, components=2).collect()
    assert max(int(r.deviation) for r in out) > 2 ** 63
    check_whitened(out, [r for r in rows if len(r[1]) == 3], 2)
    far = whitening.whiten(spark.createDataFrame([(1, [1e300, -1e300]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>"))
    # n x - S = +-(2^63 - 1) and its like: exact beyond 64 bits; the query then says null.
    assert {int(r.deviation) for r in far.collect()} == {(2 ** 63 - 1) ** 2 + (2 ** 63 + 256) ** 2}
    assert whitening.digest(far).filter(F.col("deviation").isNotNull()).count() == 0


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    out = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in out] == [(1, "0", None, 0.0, None)] * 4
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert sorted((r.vec_id, r.component, r.whitened and round(abs(r.whitened), 9), round(r.explained, 9)) for r in flat) == [
        (1, 1, 1.0, 1.0), (1, 2, None, 0.0), (2, 1, 1.0, 1.0), (2, 2, None, 0.0)]
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("matrix", [
    np.eye(7), np.zeros((4, 4)), np.ones((6, 6)), np.diag([3.0, 3.0, 1.0, 3.0, 0.0]), np.array([[2.0]]),
    np.diag(np.arange(30.0)) + np.diag(np.full(29, 1e-9), 1) + np.diag(np.full(29, 1e-9), -1)])
def test_eigenpairs_of_special_matrices(matrix):
    values, v = symmetric_eigen.leading(matrix, 4)
    want = np.linalg.eigvalsh(matrix)[::-1][:4]
    assert np.allclose(values, want, rtol=1e-13, atol=1e-14)
    assert np.allclose(matrix @ v, v * values, atol=1e-13 * max(1, np.abs(matrix).max()))
    assert np.allclose(v.T @ v, np.eye(len(values)), atol=1e-13)


def test_eigenpairs_of_close_values():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(60, 60)))
    matrix = q @ np.diag([9, 9 - 1e-12, 9 - 1e-8, 8.999] + [1.0] * 56) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, v = symmetric_eigen.leading(matrix, 4)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:4], rtol=1e-13)
    assert np.allclose(matrix @ v, v * values, atol=1e-12) and np.allclose(v.T @ v, np.eye(4), atol=1e-12)
