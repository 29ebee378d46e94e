"""DuckDB SQL for the queries that SQL can express (see ``queries``).

Tokenizers, trained models and the pipeline that begins with one are not
expressible; their tests hold them against the tokenizers library, held-out
accuracy and brute force.
"""

from __future__ import annotations

_SPACED = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


_OP1 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")},
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all({_lower("coalesce(text, '')")},
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item, least(13, len(ws)) AS n,
         array_to_string(ws[p:p + least(13, len(ws)) - 1], ' ') AS gram
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS p
        FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p
        FROM d, sizes WHERE len(ws) >= n)),
hits AS (SELECT doc_id, p, n, item FROM grams JOIN win USING (n, gram)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP3 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_SPACED}') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS p
        FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
  FROM s x JOIN s y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS other FROM sym
  UNION SELECT r.doc_id, sym.b FROM reach r JOIN sym ON r.other = sym.a),
low AS (SELECT doc_id, min(other) AS low FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       coalesce(low, d.doc_id) AS component_id, coalesce(low, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""

_OP4 = rf"""
WITH l AS (
  SELECT doc_id, p, body, regexp_extract_all(body, '{_SPACED}') AS ws
  FROM (SELECT doc_id, generate_subscripts(ls, 1) AS p, unnest(ls) AS body
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
k AS (SELECT doc_id, p, ws, array_to_string(ws, ' ') AS key,
             row_number() OVER (ORDER BY doc_id, p) AS o FROM l WHERE len(ws) > 0),
f AS (SELECT key, min(o) AS o, any_value(ws) AS ws FROM k GROUP BY 1),
v AS (
  SELECT key, o, q, array_to_string(list_concat(ws[1:q - 1], ws[q + 1:]), ' ') AS variant
  FROM (SELECT key, o, ws, unnest(range(1, len(ws) + 1)) AS q FROM f WHERE len(ws) >= 5)),
near AS (
  SELECT x.key FROM f x JOIN v y ON x.key = y.variant WHERE len(x.ws) >= 5 AND y.o < x.o
  UNION SELECT x.key FROM v x JOIN f y ON x.variant = y.key WHERE len(y.ws) >= 5 AND y.o < x.o
  UNION SELECT key FROM (SELECT key, o, min(o) OVER (PARTITION BY variant, q) AS low FROM v)
        WHERE low < o),
gone AS (
  SELECT k.doc_id, k.p FROM k JOIN f USING (key)
  WHERE k.o > f.o OR key IN (SELECT key FROM near)),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(gone.p) AS n_removed,
         string_agg(CASE WHEN gone.p IS NULL THEN body END, chr(10) ORDER BY l.p) AS kept
  FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.p = l.p GROUP BY 1)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256 FROM kept
"""

_OP5 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS ws FROM documents),
w AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY gram ORDER BY doc_id, p) AS nth
  FROM (SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS gram
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p
              FROM d WHERE len(ws) >= 20))),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM w WHERE nth > 1),
words AS (SELECT doc_id, generate_subscripts(ws, 1) AS q, unnest(ws) AS word FROM d),
kept AS (
  SELECT words.doc_id, count(gone.q) AS n_removed,
         string_agg(CASE WHEN gone.q IS NULL THEN word END, ' ' ORDER BY words.q) AS kept
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.q = words.q GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_OP6 = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x,
         strlen(coalesce(text, '')) AS n FROM documents),
w AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS nth
  FROM (SELECT doc_id, p, md5(substring(x, 2 * p + 1, 200)) AS s
        FROM (SELECT doc_id, x, unnest(range(n - 99)) AS p FROM d WHERE n >= 100))),
runs AS (
  SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before
  FROM w WHERE nth > 1),
grouped AS (
  SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 100 THEN 1 ELSE 0 END)
                    OVER (PARTITION BY doc_id ORDER BY p) AS g FROM runs),
spans AS (SELECT doc_id, g, min(p) AS a, max(p) + 100 AS b FROM grouped GROUP BY 1, 2),
cuts AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM spans),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
         string_agg(substring(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head
  FROM cuts JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substring(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_OP9 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS ws FROM documents),
g AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS n
  FROM (SELECT doc_id, p, array_to_string(ws[p:p + 4], ' ') AS gram
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS p FROM d WHERE len(ws) >= 5))),
r AS (SELECT doc_id, count(DISTINCT q) AS n_repeat
      FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM g WHERE n > 1) GROUP BY 1),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_SPACED}')) AS ls
  FROM d),
m AS (
  SELECT d.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS bad
      FROM b WHERE source IS NOT NULL GROUP BY 1),
q AS (SELECT sum(bad) / sum(n) AS mean, sum(n) AS n, count(*) AS hosts,
             sum(n * (bad / n) * (bad / n)) AS square FROM h),
prior AS (
  SELECT mean, least(greatest(mean * (1 - mean) / greatest(
           square / n - mean * mean - mean * (1 - mean) * hosts / n, 1e-9) - 1, 1.0), 1e6)
         AS strength FROM q),
verdict AS (SELECT source, (bad + mean * strength) / (n + strength) >= 0.5 AS rejected
            FROM h, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM b LEFT JOIN verdict USING (source)
"""


# fixed values: kind, pattern, measured group, least length; the first three are the
# contract's, written out here so that a wrong pattern of the operator shows
_SECRET_RULES = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     2, 8),
    ("access", r"(AKIA[A-Z0-9]{12,})", 1, 16),
    ("hex", r"([0-9a-f]{32,})", 1, 32),
    ("pem", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 1),
    ("github", r"(gh[pousr]_[A-Za-z0-9]{36,})", 1, 40),
    ("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 1),
]


def _rule_sql(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of one rule: the texts between matches and the matches alternate."""
    pattern = pattern.replace("'", "''")
    return rf"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start,
         length(found[i]) AS size
  FROM (SELECT doc_id, unnest(range(1, len(found) + 1)) AS i, gaps, found, measured
        FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps,
                     regexp_extract_all(t, '{pattern}') AS found,
                     regexp_extract_all(t, '{pattern}', {group}) AS measured FROM d))
  WHERE length(measured[i]) >= {least}"""


_RULES = "\n  UNION ALL".join(
    _rule_sql(i, *rule) for i, rule in enumerate(_SECRET_RULES))

_OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({_RULES}),
o AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
         count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT),
                    ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT),
                    ',' ORDER BY start, rank) AS spans
  FROM s GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign,
       CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (doc_id)
"""

_FINITE = """embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
_INTEGERS = """list_transform(embedding,
                        lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"""


def _nearest(book: str) -> str:
    """Parts with their nearest entry and squared distance, packed for the tie-break."""
    return f"""
  SELECT id, part, any_value(x) AS x, min(d * 64 + entry) AS best
  FROM (SELECT pts.id, pts.part, pts.x, b.entry,
               CAST(list_inner_product(list_concat(pts.y, [1.0, pts.norm]),
                    list_concat(list_transform(b.c, lambda v: -2.0 * v),
                                [list_inner_product(b.c, b.c), 1.0])) AS BIGINT) AS d
        FROM pts JOIN {book} b USING (part))
  GROUP BY id, part"""


def _means(found: str, book: str) -> str:
    return f"""
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c
  FROM {book} b LEFT JOIN (
    SELECT part, entry, list(floor(s / n) ORDER BY place) AS c
    FROM (SELECT part, best % 64 AS entry, place, CAST(sum(x[place]) AS DOUBLE) AS s, count(*) AS n
          FROM {found}, (SELECT unnest(range(1, (SELECT min(len(x)) FROM pts) + 1)) AS place)
          GROUP BY ALL) GROUP BY part, entry) m USING (part, entry)"""


_OP11 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, {_INTEGERS} AS q
  FROM embeddings WHERE {_FINITE}),
pts AS MATERIALIZED (
  SELECT id, part, x, y, list_inner_product(y, y) AS norm
  FROM (SELECT id, part, x, list_transform(x, lambda n: CAST(n AS DOUBLE)) AS y
        FROM (SELECT id, part, q[part * len(q) // 16 + 1:(part + 1) * len(q) // 16] AS x
              FROM v, (SELECT unnest(range(16)) AS part)))),
b0 AS MATERIALIZED (SELECT part, id - 1 AS entry, y AS c FROM pts WHERE id <= 64),
n0 AS MATERIALIZED ({_nearest("b0")}),
b1 AS MATERIALIZED ({_means("n0", "b0")}),
n1 AS MATERIALIZED ({_nearest("b1")}),
b2 AS MATERIALIZED ({_means("n1", "b1")}),
n2 AS MATERIALIZED ({_nearest("b2")}),
codes AS (
  SELECT id, string_agg(printf('%02x', CAST(best % 64 AS BIGINT)), '' ORDER BY part) AS code,
         CAST(sum(best // 64) AS BIGINT) AS error
  FROM n2 GROUP BY id),
books AS (
  SELECT sha256(string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place))
         AS sha
  FROM (SELECT part, entry, unnest(c) AS value, generate_subscripts(c, 1) AS place FROM b2))
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha FROM books) AS codebooks_sha256
FROM v JOIN codes USING (id)
"""

_OP12 = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform({_INTEGERS}, lambda n: CAST(n AS DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score
  FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
                               ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM pos JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": _OP1,
    "op3_minhash": _OP3,
    "op4_line_dedup": _OP4,
    "op5_substring_dedup": _OP5,
    "op6_byte_dedup": _OP6,
    "op9_quality_rules": _OP9,
    "op10_secret_scan": _OP10,
    "op11_vector_codes": _OP11,
    "op12_hard_negatives": _OP12,
}
