"""DuckDB SQL for the operators that SQL can express, written independently of the Spark code.

Without an oracle are those on XXH64 fingerprints, trained models, tokenizer files, least-cost
edits and rolling hashes (2, 7, 8, 9, 11 and 13); ``tests/llm`` compares them with plain versions instead.
"""

from __future__ import annotations

from basketspark.llm.licenses import TEMPLATES

_QUALITY = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
p AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM p),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM g WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, w.host, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(u.n_dup_lines, 0) AS n_dup_lines, coalesce(c.n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN u USING (doc_id) LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT host, count(*) AS host_docs, CAST(sum(base_failed::INT) AS BIGINT) AS host_failed FROM f WHERE host IS NOT NULL GROUP BY host),
s AS (SELECT count(*) AS m, sum(host_docs) AS n, sum(host_failed) / sum(host_docs) AS mean, sum(host_docs::DOUBLE * host_docs) AS nn FROM h),
b AS (SELECT s.*, mean * (1 - mean) AS free, n - nn / n AS scale,
  (SELECT sum(host_docs * pow(host_failed / host_docs - s.mean, 2)) FROM h) AS between_hosts FROM s),
r AS (SELECT *, CASE WHEN free > 0 AND scale > m - 1 THEN (between_hosts - (m - 1) * free) / (free * (scale - (m - 1))) ELSE 0 END AS rho FROM b),
q AS (SELECT *, CASE WHEN rho > 0 THEN least(1000.0, 1 / rho - 1) ELSE 1000.0 END AS weight FROM r),
v AS (SELECT host, host_docs, host_failed,
  (host_failed + greatest(mean * weight, 1e-6)) / (host_docs + greatest(mean * weight, 1e-6) + greatest((1 - mean) * weight, 1e-6)) AS rate FROM h, q)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(rate <= 0.5, true) AS kept, f.host, host_docs, host_failed, round(rate, 6) AS host_rate
FROM f LEFT JOIN v ON f.host = v.host
"""

_EMBEDDINGS = """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
ok AS (
  SELECT * FROM e WHERE v IS NOT NULL AND label IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
root AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(deg.n, 0) AS n_links, root.component_id, e.vec_id = root.component_id AS kept
FROM e JOIN root USING (vec_id) LEFT JOIN deg USING (vec_id)
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_BIGRAMS = """list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))"""
_WORDS = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"

_LICENSES = f"""
WITH known(template, license, body) AS (VALUES {", ".join(f"({i}, {_text(n)}, {_text(t)})" for i, (n, t) in enumerate(TEMPLATES))}),
tb AS (SELECT template, license, {_BIGRAMS} AS b FROM (SELECT *, {_WORDS.format("body")} AS ws FROM known)),
ti AS (SELECT template, license, len(b) AS size_b, unnest(b) AS bigram FROM tb),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS (SELECT doc_id, list_concat(string_split(t, chr(10)),
  list_filter(string_split_regex(t, '\\n[ \\t\\r]*\\n'), lambda p: contains(p, chr(10)))) AS units FROM d),
u AS (SELECT doc_id, unnest(units) AS part, generate_subscripts(units, 1) - 1 AS unit FROM parts),
ub AS (SELECT doc_id, unit, {_BIGRAMS} AS a FROM (SELECT *, {_WORDS.format("part")} AS ws FROM u)),
x AS (SELECT doc_id, unit, len(a) AS size_a, unnest(a) AS bigram FROM ub),
s AS (SELECT doc_id, unit, license, template, 2.0::DOUBLE * count(*) / (size_a + size_b) AS dice
  FROM x JOIN ti USING (bigram) GROUP BY doc_id, unit, license, template, size_a, size_b),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, unit) AS n FROM s WHERE dice >= 0.8)
SELECT doc_id, license, CAST(unit AS INTEGER) AS unit, dice FROM r
WHERE n = 1 AND (license <> 'proprietary' OR doc_id NOT IN (SELECT doc_id FROM r WHERE license <> 'proprietary'))
"""

#: kind, rank, role, strong, least length, pattern, further condition on the value.
_KINDS = (
    ("assign", 0, "secret", True, 8, r"""(?:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", "true"),
    ("access", 1, "identity", True, 16, r"(AKIA[A-Z0-9]+)", "true"),
    ("hex", 2, "secret", True, 32, r"([0-9a-f]+)", "true"),
    ("user", 3, "identity", False, 3, r"""(?:\b(?i:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]+))""", "true"),
    ("opaque", 4, "secret", False, 20, r"([A-Za-z0-9+/_=-]+)", "regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]')"),
    ("endpoint", 5, "endpoint", False, 10, r"""((?:https?|ftp|ssh|postgres(?:ql)?|mysql|redis|mongodb|amqps?)://[^\s"'<>]+)""", "true"),
)


def _finds(kind: str, rank: int, role: str, strong: bool, least: int, pattern: str, also: str) -> str:
    lazy = _text(f"(?s)(.*?)({pattern})")
    parts = ", ".join(f"unnest(regexp_extract_all(t, {lazy}, {g})) AS {n}" for g, n in ((1, "gap"), (2, "hit"), (3, "val")))
    at = f"unnest(range(len(regexp_extract_all(t, {lazy}, 1)))) AS i"
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rk, '{role}' AS role, {strong} AS strong, stop - length(hit) AS start, stop FROM (
  SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM (SELECT doc_id, {parts}, {at} FROM d)
) WHERE length(val) >= {least} AND {also}"""


_SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS ({" UNION ALL ".join(_finds(*k) for k in _KINDS)}),
met AS (
  SELECT w.doc_id, w.rk, w.role, w.start, w.stop,
    bool_or(apart AND o.role = 'identity') AS i, bool_or(apart AND o.role = 'secret') AS s, bool_or(apart AND o.role = 'endpoint') AS e,
    bool_or(NOT apart AND o.strong) AS over_strong
  FROM parts w JOIN (SELECT * FROM parts) o ON w.doc_id = o.doc_id AND o.start < w.stop + 200 AND o.stop > w.start - 200,
    LATERAL (SELECT o.start >= w.stop OR o.stop <= w.start AS apart)
  WHERE NOT w.strong GROUP BY ALL),
spans AS (
  SELECT doc_id, kind, rk, strong, start, stop FROM parts WHERE strong
  UNION ALL
  SELECT p.doc_id, p.kind, p.rk, p.strong, p.start, p.stop FROM parts p JOIN met m ON p.doc_id = m.doc_id AND p.rk = m.rk AND p.start = m.start
  WHERE NOT m.over_strong AND CASE m.role WHEN 'identity' THEN m.s WHEN 'secret' THEN m.i OR m.e ELSE m.i AND m.s END)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rk) FILTER (strong), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rk), '') AS spans
FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id
"""

_SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(words) - 33)) AS i, words FROM d WHERE len(words) >= 35),
w AS (SELECT doc_id, i, array_to_string(words[i : i + 34], ' ') AS win FROM p),
n AS (SELECT doc_id, i, count(*) OVER (PARTITION BY win) AS n FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM n WHERE n > 1),
g AS (SELECT doc_id, list(i) AS lost, count(*) AS n FROM gone GROUP BY doc_id),
t AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
k AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS kept FROM t LEFT JOIN gone USING (doc_id, i) WHERE gone.i IS NULL GROUP BY t.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""

_LINES = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
h AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, line, pos, coalesce(k.doc_id <> holder, false) AS lost FROM k LEFT JOIN h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_PHRASES = """
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
s AS (
  SELECT c.*, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1 : c.cut], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1 : c.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_pairs AS (SELECT lang, a AS longer, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase FROM c WHERE k = 3),
gone AS (SELECT DISTINCT b.lang, b.phrase FROM b JOIN inner_pairs i ON b.lang = i.lang AND b.phrase = i.phrase WHERE 100 * i.longer >= 50 * b.a),
kept AS (SELECT b.* FROM b ANTI JOIN gone USING (lang, phrase)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": _QUALITY,
    "op3_embedding_dups": _EMBEDDINGS,
    "op4_license_scan": _LICENSES,
    "op5_secret_scan": _SECRETS,
    "op6_substring_dedup": _SUBSTRINGS,
    "op10_line_dedup": _LINES,
    "op12_collocations": _PHRASES,
}
