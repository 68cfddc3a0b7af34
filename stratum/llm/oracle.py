"""DuckDB SQL for the queries that SQL can express, written independently."""

from __future__ import annotations

from .quality_rules import STOP_WORDS

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_DOCS = "docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)"
_WORDS = (r"list_filter(regexp_split_to_array({t}, '[\x20\x09-\x0D]+'), lambda w: w <> '')")


def _spans(kind: str, ord_: int, pattern: str, keep: str) -> str:
    """Spans of one kind: running lengths of the gaps and the matches before."""
    p = pattern.replace("'", "''")
    return f"""
SELECT doc_id, {ord_} AS ord, '{kind}' AS kind, begins AS s, begins + length(hit) AS e FROM (
  SELECT doc_id, hits[i] AS hit,
         list_sum(list_transform(gaps[1:i], lambda g: length(g)))
           + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS begins
  FROM (SELECT doc_id, regexp_split_to_array(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS hits FROM docs) x,
       unnest(range(1, len(hits) + 1)) AS r(i))
WHERE {keep.replace('$P', f"'{p}'")}"""


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = [
    ("assign", _ASSIGN, "length(regexp_extract(hit, $P, 1)) >= 8"),
    ("access", "AKIA[A-Z0-9]+", "length(hit) >= 16"),
    ("hex", "[0-9a-f]+", "length(hit) >= 32"),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"),
    ("hub_token", "gh[pousr]_[A-Za-z0-9]+", "length(hit) >= 40"),
    ("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "length(hit) >= 40"),
]

SECRETS = f"""
WITH {_DOCS}, spans AS ({" UNION ALL ".join(_spans(k, n, p, c) for n, (k, p, c) in enumerate(_KINDS))}),
found AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) FILTER (WHERE ord < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN found f ON f.doc_id = d.doc_id"""

LINES = f"""
WITH {_DOCS}, lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
               unnest(range(1, len(string_split(t, chr(10))) + 1)) AS pos FROM docs)),
frequent AS (SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 40
             GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT l.*, f.key IS NULL OR f.last_doc = l.doc_id AS stays FROM lines l LEFT JOIN frequent f ON f.key = l.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
QUALITY = f"""
WITH {_DOCS}, w AS (SELECT doc_id, t, {_WORDS.format(t='t')} AS ws FROM docs),
windows AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM w, unnest(range(1, len(ws) - 1)) AS r(i)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(0, 3) AS r(k) GROUP BY doc_id),
counted AS (
  SELECT w.doc_id, cast(len(ws) AS bigint) AS n_words,
         cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS bigint) AS word_chars,
         cast(len(regexp_extract_all(t, '[#*$%&|<>]')) AS bigint) AS n_symbols,
         cast(len(regexp_extract_all(t, '[A-Z]')) AS bigint) AS n_capitals,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         cast(coalesce(c.n, 0) AS bigint) AS n_repeat_words,
         len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop
  FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id),
judged AS (
  SELECT *, cast(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 3 * n_words AND 10 * n_words AND 10 * n_symbols <= n_words
         AND 20 * n_stop >= n_words AND 10 * n_dup_lines <= 4 * len(lines) AND 2 * n_capitals <= word_chars AS kept
FROM judged"""


def _escaped(x: str) -> str:
    return rf"replace(replace({x}, '\', '\\'), '<|', '<\|')"


_ORDER = "ORDER BY turn, role, text"
CHATS = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
grouped AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' {_ORDER}) AS flat,
         coalesce(string_agg(text, '' {_ORDER}) FILTER (WHERE role = 'assistant'), '') AS learned,
         cast(sum(length('<|im_start|>') + length(replace({_escaped('role')}, chr(10), '\\n')) + 1
                  + length({_escaped('text')}) + length('<|im_end|>') + 1) AS bigint) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(flat) AS turns_sha256, length(learned) AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars
FROM grouped"""

JACCARD = f"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, {_WORDS.format(t='t')} AS ws FROM lowered),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM w, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) AS r(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 75 * (m.n + n.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = w.doc_id) AS component_id
FROM w LEFT JOIN sizes s ON s.doc_id = w.doc_id"""

DIVERGENCE = r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     coalesce(text, '') AS t FROM documents),
terms AS (SELECT d, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
          FROM (SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM docs)),
kept AS (SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
held AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM terms t JOIN kept k ON k.lang = t.lang AND k.term = t.term
         GROUP BY t.lang, t.source, t.term),
totals AS (SELECT lang, source, sum(n) AS total FROM held GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
         1 + (1000000000 * cast(coalesce(h.n, 0) + 2 AS hugeint)) // cast(coalesce(t.total, 0) + 2 * l.v AS hugeint) AS p,
         1 + (1000000000 * cast(k.n + 2 AS hugeint)) // cast(l.total + 2 * l.v AS hugeint) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
  GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, cast(value AS bigint) AS value, cast(rank AS integer) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 10"""

ORACLE_SQL = {
    "op2_secret_scan": SECRETS,
    "op3_line_dedup": LINES,
    "op8_quality_rules": QUALITY,
    "op9_chat_format": CHATS,
    "op10_ngram_jaccard": JACCARD,
    "op11_source_divergence": DIVERGENCE,
}
