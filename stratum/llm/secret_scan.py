"""Secret scan (2): a trigram inverted index in front of regular expressions.

1. ``trigram_query`` derives from each rule's pattern a Boolean query over
   trigrams that every match must contain (lower-cased).
2. ``build_index`` posts, for the trigrams that any rule asks for, the ids of
   the documents that contain them: one row per (trigram, document).
3. ``candidates`` intersects the postings: per document the posted trigrams
   are or-ed into a bit mask and each rule's query is tested on the mask.
4. ``scan`` verifies the candidates with the pattern itself.  A rule without a
   mandatory trigram has the query "any" and scans every document in full.

The index only skips work: a document without a rule's trigrams cannot match
it, so the spans are those of a plain scan.  Everything is built-in Spark
expressions; postings carry ids, never text.

Defined results: null text is empty text; a null doc_id is an id like any
other; rows that share a doc_id share postings (a superset, verified per row);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from re import _constants as _sc
from re import _parser as _sp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import count_kind, match_spans, no_spans, sorted_spans, span_list


def _everything(hit: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Rule:
    """A pattern valid in Java and Python alike, and a test of each match."""
    name: str
    pattern: str
    keep: Callable[[Column], Column] = field(default=_everything)
    base: bool = False


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = (
    Rule("assign", _ASSIGN,
         lambda hit: F.length(F.regexp_extract(hit, _ASSIGN, 1)) >= 8, base=True),
    # Runs of one class: asking for the length in the pattern drops the same runs as
    # testing it afterwards, since a later start in a run only leaves less of it.
    Rule("access", r"AKIA[A-Z0-9]{12,}", base=True),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", base=True),
    # Added by the method: formats that announce themselves.
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]+", lambda hit: F.length(hit) >= 40),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
         lambda hit: F.length(hit) >= 40),
)
# A cheap full-scan test for rules whose matches are long runs of one class.
RUN_TEST = {"hex": r"[0-9a-f]{32}"}

# ---- Boolean trigram queries -------------------------------------------------
# A query is True (any document), a trigram, or ("and" | "or", set of queries).

_MAX_STRINGS = 8


def _all_of(parts) -> object:
    parts = {p for p in parts if p is not True}
    return True if not parts else next(iter(parts)) if len(parts) == 1 else ("and", frozenset(parts))


def _one_of(parts) -> object:
    parts = set(parts)
    return True if True in parts or not parts else next(iter(parts)) if len(parts) == 1 else ("or", frozenset(parts))


def _of_strings(strings: set[str]) -> object:
    return _one_of(_all_of(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def _exact(tree) -> set[str] | None:
    """All strings a small pattern matches, lower-cased, or None if many."""
    found = {""}
    for op, arg in tree:
        if op is _sc.LITERAL:
            more = {chr(arg).lower()}
        elif op is _sc.SUBPATTERN:
            more = _exact(arg[-1])
        elif op is _sc.BRANCH:
            branches = [_exact(b) for b in arg[1]]
            more = None if None in branches else set().union(*branches)
        elif op is _sc.IN and all(o is _sc.LITERAL for o, _ in arg):
            more = {chr(a).lower() for _, a in arg}
        elif op in (_sc.MAX_REPEAT, _sc.MIN_REPEAT) and arg[1] == 1:
            more = _exact(arg[2])
            more = None if more is None else more | ({""} if arg[0] == 0 else set())
        else:
            more = None
        if more is None or len(found) * len(more) > _MAX_STRINGS:
            return None
        found = {a + b for a in found for b in more}
    return found


def _query(tree) -> object:
    """What every match of a parsed pattern must contain."""
    must, run = [], {""}
    for node in tree:
        strings = _exact([node])
        if strings is not None and len(run) * len(strings) <= _MAX_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        must.append(_of_strings(run))
        run = strings if strings is not None else {""}
        op, arg = node
        if strings is None:
            if op is _sc.SUBPATTERN:
                must.append(_query(arg[-1]))
            elif op is _sc.BRANCH:
                must.append(_one_of(_query(b) for b in arg[1]))
            elif op in (_sc.MAX_REPEAT, _sc.MIN_REPEAT) and arg[0] > 0:
                must.append(_query(arg[2]))
    return _all_of([*must, _of_strings(run)])


def trigram_query(pattern: str) -> object:
    return _query(list(_sp.parse(pattern)))


def trigrams_of(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


# ---- index, intersection, verification ----------------------------------------

_WORD = 62  # trigram bits in one mask column


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, tid, doc_id) of the given trigrams."""
    lowered = docs.select(F.col("doc_id"), F.lower(F.col("text")).alias("lowered"))
    held = F.array_compact(F.array(*[
        F.when(F.contains("lowered", F.lit(t)), F.lit(n)) for n, t in enumerate(trigrams)]))
    names = F.array(*[F.lit(t) for t in trigrams])
    return lowered.select("doc_id", F.explode(held).alias("tid")).select(
        F.get(names, F.col("tid")).alias("trigram"), "tid", "doc_id")


def _test(query: object, trigrams: list[str]) -> Column:
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        n = trigrams.index(query)
        return F.col(f"mask{n // _WORD}").bitwiseAND(F.lit(1 << (n % _WORD))) != 0
    out = None
    for q in sorted(query[1], key=str):
        t = _test(q, trigrams)
        out = t if out is None else (out & t if query[0] == "and" else out | t)
    return out


def candidates(index: DataFrame, rules: tuple[Rule, ...], trigrams: list[str]) -> DataFrame:
    """(doc_id, rules): the rules whose trigram query holds in the document.

    Rules without a mandatory trigram are not listed: they scan everything.
    """
    masks = [F.bit_or(F.when(
        F.floor(F.col("tid") / _WORD) == k,
        F.pow(F.lit(2.0), F.col("tid") % _WORD).cast("long"),
    ).otherwise(F.lit(0).cast("long"))).alias(f"mask{k}") for k in range(1 + len(trigrams) // _WORD)]
    per_doc = index.groupBy("doc_id").agg(*masks)
    queries = {r.name: trigram_query(r.pattern) for r in rules}
    hits = F.array_compact(F.array(*[
        F.when(_test(q, trigrams), F.lit(n)) for n, q in queries.items() if q is not True]))
    return per_doc.select("doc_id", hits.alias("rules")).filter(F.size("rules") > 0)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, text, spans): spans are structs (start, ord, end, kind), sorted."""
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    queries = {r.name: trigram_query(r.pattern) for r in rules}
    trigrams = sorted(set().union(*map(trigrams_of, queries.values())))
    if trigrams:
        found = candidates(build_index(rows, trigrams), rules, trigrams).withColumnRenamed("doc_id", "hit_id")
        rows = rows.join(found, rows["doc_id"].eqNullSafe(found["hit_id"]), "left")
    else:
        rows = rows.withColumn("rules", F.array().cast("array<string>"))
    parts = []
    for r in rules:
        if queries[r.name] is True:
            test = F.col("text").rlike(RUN_TEST[r.name]) if r.name in RUN_TEST else F.lit(True)
        else:
            test = F.coalesce(F.array_contains("rules", r.name), F.lit(False))
        parts.append((r.name, F.when(test, match_spans(F.col("text"), r.pattern, r.keep)).otherwise(no_spans())))
    return rows.select("doc_id", "text", sorted_spans(parts).alias("spans"))


def digest(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document the counts, hash and list of the query contract."""
    base = [r.name for r in rules if r.base]
    of_base = F.filter("spans", lambda s: s["kind"].isin(*base))
    return scanned.select(
        "doc_id",
        *[count_kind(n).alias(f"n_{n}") for n in base],
        F.sha2(span_list(of_base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"))
