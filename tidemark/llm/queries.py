"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from .byte_bpe import op13_byte_bpe
from .decontaminate import op1_decontamination
from .language import op8_language
from .merkle import op11_merkle
from .neighbours import op9_neighbours
from .packing import op3_packing
from .secrets import op2_secrets
from .sharding import op7_sharding
from .simhash import op10_simhash
from .substring_dedup import op6_substring_dedup
from .suffix_dedup import op4_suffix_dedup
from .toxicity import op5_toxicity
from .whitening import op12_whitening

QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_secrets, op3_packing, op4_suffix_dedup, op5_toxicity, op6_substring_dedup,
    op7_sharding, op8_language, op9_neighbours, op10_simhash, op11_merkle, op12_whitening,
    op13_byte_bpe)}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: Queries that SQL cannot express (tokenizer, XXH64, CRC-32, trained models,
#: approximate search, windowed entropy) have none; tests/llm checks those
#: against brute force.
ORACLE_SQL = {
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
h AS (SELECT DISTINCT doc_id, s, n, win FROM dw WHERE (win, n) IN (SELECT (win, n) FROM iw)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h JOIN iw USING (win, n)) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op4_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, s, x[2 * s + 1:2 * s + 100] AS win FROM (
  SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS s FROM d WHERE length(x) >= 100)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY win) AS low FROM w) WHERE low < doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM r),
n AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (prev IS NULL OR prev < p - 1) AS n_spans FROM (
  SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS prev FROM g) GROUP BY doc_id),
k AS (SELECT b.doc_id, string_agg(b.c, '' ORDER BY b.p) AS kept FROM (
  SELECT doc_id, p, x[2 * p + 1:2 * p + 2] AS c FROM (
    SELECT doc_id, x, unnest(range(0, length(x) // 2)) AS p FROM d WHERE doc_id IN (SELECT doc_id FROM n))) b
  ANTI JOIN g ON b.doc_id = g.doc_id AND b.p = g.p GROUP BY b.doc_id)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_removed IS NULL THEN x ELSE coalesce(kept, '') END)) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op6_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS win FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY win) AS low FROM v) WHERE low < doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM r),
n AS (SELECT doc_id, count(*) AS n_removed FROM g GROUP BY doc_id),
k AS (SELECT b.doc_id, string_agg(b.t, ' ' ORDER BY b.p) AS kept FROM (
  SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d) b
  ANTI JOIN g ON b.doc_id = g.doc_id AND b.p = g.p GROUP BY b.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)""",
    # crc32 bit by bit; trees level by level, first per language, then over the subroots
    "op11_merkle": """
WITH RECURSIVE f AS (SELECT doc_id, coalesce('=' || lang, '') AS run,
  list_transform([CAST(doc_id AS VARCHAR), source, lang], lambda x: coalesce(strlen(x) || ':' || x, '-')) AS a,
  coalesce(strlen(text) || ':' || text, '-') AS z, CAST(n_chars AS VARCHAR) AS n0, CAST(n_chars + 1 AS VARCHAR) AS n1,
  xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, o: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) AS crc FROM documents),
l AS (SELECT run, doc_id, crc, sha256(array_to_string(a, '') || coalesce(strlen(n0) || ':' || n0, '-') || z) AS leaf,
  sha256(array_to_string(a, '') || coalesce(strlen(n1) || ':' || n1, '-') || z) AS changed FROM f),
d AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY run) AS n FROM l),
t AS (SELECT run, 0 AS k, p, n, leaf AS h FROM d UNION ALL
  SELECT run, k + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM t WHERE n > 1 GROUP BY run, k, p // 2, n),
r AS (SELECT run, h, row_number() OVER (ORDER BY run) - 1 AS p, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS k, p, n, h FROM r UNION ALL
  SELECT k + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM u WHERE n > 1 GROUP BY k, p // 2, n),
g AS (SELECT a.run, a.p, list(CASE WHEN b.h IS NULL THEN '' WHEN b.p % 2 = 0 THEN 'L' || b.h ELSE 'R' || b.h END ORDER BY a.k) AS steps
  FROM (SELECT d.run, d.p, x.k FROM d JOIN (SELECT DISTINCT run, k FROM t WHERE n > 1) x USING (run)) a
  LEFT JOIN t b ON b.run = a.run AND b.k = a.k AND b.p = xor(a.p >> a.k, 1) GROUP BY a.run, a.p),
v AS (SELECT a.run, list(CASE WHEN b.h IS NULL THEN '' WHEN b.p % 2 = 0 THEN 'L' || b.h ELSE 'R' || b.h END ORDER BY a.k) AS steps
  FROM (SELECT r.run, r.p, x.k FROM r, (SELECT DISTINCT k FROM u WHERE n > 1) x) a
  LEFT JOIN u b ON b.k = a.k AND b.p = xor(a.p >> a.k, 1) GROUP BY a.run),
w AS (SELECT d.doc_id, d.leaf, CASE WHEN d.crc % 7 = 0 THEN d.changed ELSE d.leaf END AS claim, r.h AS subroot,
  (SELECT h FROM u WHERE n = 1) AS root, list_concat(coalesce(g.steps, []), coalesce(v.steps, [])) AS steps
  FROM d JOIN r USING (run) LEFT JOIN g ON g.run = d.run AND g.p = d.p LEFT JOIN v ON v.run = d.run)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM (SELECT *, list_reduce(list_concat([claim], steps), lambda h, s: sha256(
  CASE WHEN s[1] = 'L' THEN s[2:] || h WHEN s[1] = 'R' THEN h || s[2:] ELSE h END)) AS folded_root FROM w)""",
}
