"""Plain Python versions of the query contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def _listing(found: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def secrets(text: str | None) -> tuple:
    text = text or ""
    found = []
    pat = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for m in pat.finditer(text):
        if len(m[1]) >= 8:
            found.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            found.append((m.start(), 2, m.end(), "hex"))
    n = Counter(k for *_, k in found)
    return n["assign"], n["access"], n["hex"], sha(_listing(found))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text: str | None) -> tuple:
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    n = Counter(k for *_, k in found)
    return n["email"], n["ip"], n["card"], n["phone"], sha(_listing(found))


def quality(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i:i + 3])].append(i)
    covered = {i + d for at in windows.values() if len(at) > 1 for i in at for d in range(3)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), n < 50 or 100 * len(covered) > 50 * n)


STOP = set(
    "the of and to in is that it for was on are as with at be this have from or a an "
    "der die das und ist zu den mit von ein eine nicht sich auf des dem im "
    "le la les de et en un une du que qui dans pour par sur au avec est "
    "el los las y es por con para del se lo como su".split())


def quality_kept(text: str | None) -> bool:
    n, chars, symbols, dup, _, failed = quality(text)
    if failed:
        return False
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (3 * n <= chars <= 10 * n and 10 * symbols <= n and 20 * sum(x.lower() in STOP for x in w) >= n
            and 10 * dup <= 4 * len(lines) and 2 * len(re.findall("[A-Z]", text)) <= chars)


def chats(rows: list[tuple]) -> dict:
    """rows: (conv_id, turn, role, text) -> conv_id: (n, turns hash, loss chars, loss hash)."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        learned = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(learned), sha(learned))
    return out


def line_dedup(rows: list[tuple], min_len: int = 40, min_docs: int = 5) -> list[tuple]:
    return [(i, n, dropped, sha(t)) for i, n, dropped, t in line_dedup_texts(rows, min_len, min_docs)]


def line_dedup_texts(rows: list[tuple], min_len: int = 40, min_docs: int = 5) -> list[tuple]:
    def key(line: str) -> str:
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    docs_of = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_len:
                docs_of[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(docs_of.get(key(x), ())) < min_docs or max(docs_of[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text: str | None) -> set:
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def jaccard_components(rows: list[tuple]) -> dict:
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].add(k)
    seen = set()
    for members in holders.values():
        members = sorted(members)
        for a in range(len(members)):
            for b in range(a + 1, len(members)):
                p = (members[a], members[b])
                if p in seen:
                    continue
                seen.add(p)
                (i, s), (j, t) = sets[p[0]], sets[p[1]]
                if 100 * len(s & t) >= 75 * len(s | t):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


# ---- language -----------------------------------------------------------------------

def language_grams(text):
    """n-grams of letters with word edges, as integers of 21 bits a character."""
    edge, codes = 1, [1]
    for ch in (text or "").lower():
        code = ord(ch) if ch.isalpha() else edge
        if code != edge or codes[-1] != edge:
            codes.append(code)
    if codes[-1] != edge:
        codes.append(edge)
    found = Counter(c for c in codes if c != edge)
    found.update(a << 21 | b for a, b in zip(codes, codes[1:]))
    found.update(a << 42 | b << 21 | c for a, b, c in zip(codes, codes[1:], codes[2:]) if b != edge)
    return found


def languages(train, asked, top=400):
    """(id, language, score) by out-of-place distance to the profiles of ``train`` (text, lang)."""
    total = defaultdict(Counter)
    for text, lang in train:
        if text is not None and lang is not None:
            total[lang].update(language_grams(text))

    def ranks(counts):
        return {g: i for i, g in enumerate(sorted(counts, key=lambda g: (-counts[g], g))[:top])}

    profiles = {lang: ranks(c) for lang, c in total.items() if c}
    out = []
    for i, text in asked:
        if not profiles or not any(c.isalpha() for c in (text or "").lower()):
            out.append((i, "und", 0.0))
            continue
        own = ranks(language_grams(text))
        far = {lang: sum(abs(p[g] - r) if g in p else top for g, r in own.items()) for lang, p in profiles.items()}
        best = min(far, key=lambda lang: (far[lang], lang))
        out.append((i, best, 1 - far[best] / (top * len(own))))
    return out
