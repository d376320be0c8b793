"""Equivalent SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

from . import p5_repetition

#: What Python and Unicode count as white space.
SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]+"

WORDS = f"list_filter(string_split_regex(lower(text), '{SPACE}'), lambda x: x <> '')"

P5 = f"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE text IS NOT NULL),
r AS (SELECT doc_id, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS r FROM w WHERE len(w) >= 30)
SELECT doc_id FROM r WHERE 1 - len(list_distinct(r)) / len(r) >= 0.3 - 1e-12
"""

ODD = r"[\x{ff01}-\x{ff5e}\x{0300}-\x{036f}\x{1ab0}-\x{1aff}\x{1dc0}-\x{1dff}\x{20d0}-\x{20dc}\x{20e1}\x{20e5}-\x{20f0}\x{fe20}-\x{fe2f}\x{180e}\x{200b}\x{200c}\x{200e}\x{200f}\x{2060}-\x{2064}\x{feff}\x{00a0}\x{2007}\x{202f}]"
JOINER = r"(?:\A|[^\x{2190}-\x{2bff}\x{fe0f}\x{1f000}-\x{1faff}])\x{200d}|\x{200d}(?:\z|[^\x{2190}-\x{2bff}\x{1f000}-\x{1faff}])"
MIXED = r"\p{Latin}[^\s\p{Z}]*[\p{Cyrillic}\p{Greek}]|[\p{Cyrillic}\p{Greek}][^\s\p{Z}]*\p{Latin}"

P6 = f"""
WITH t AS (
  SELECT 'document' AS record_kind, doc_id AS record_id, text FROM documents
  UNION ALL SELECT 'candidate', candidate_id, fragment FROM boilerplate_candidates)
SELECT DISTINCT record_kind, record_id FROM t WHERE regexp_matches(text, '{ODD}|{JOINER}') OR regexp_matches(text, '{MIXED}')
"""

P7 = f"""
WITH l AS (
  SELECT source, doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no, unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE source IS NOT NULL AND text IS NOT NULL),
f AS (SELECT source, doc_id, line_no, trim(regexp_replace(lower(line), '{SPACE}', ' ', 'g')) AS form FROM l),
n AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source),
r AS (SELECT f.source, form FROM f JOIN n USING (source) WHERE form <> '' GROUP BY f.source, form, n
      HAVING count(DISTINCT doc_id) >= 4 AND count(DISTINCT doc_id) >= 0.05 * n - 1e-9)
SELECT DISTINCT 'document' AS record_kind, doc_id AS record_id, CAST(line_no AS INTEGER) AS line_no FROM f JOIN r USING (source, form)
UNION ALL
SELECT DISTINCT 'candidate', candidate_id, 0 FROM boilerplate_candidates c JOIN r
  ON r.source = regexp_replace(regexp_replace(lower(trim(c.domain)), '^www\\.', ''), ':[0-9]+$', '')
  AND r.form = trim(regexp_replace(lower(c.fragment), '{SPACE}', ' ', 'g'))
"""

SQUEEZED = f"trim(regexp_replace(x, '{SPACE}', ' ', 'g'))"


def run_share(n: int) -> str:
    runs = f"list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))"
    return f"CASE WHEN len(w) >= {n} THEN 1 - len(list_distinct({runs})) / len({runs}) ELSE 0.0 END AS run{n}_share"


def unlike(items: str) -> str:
    return f"CASE WHEN len({items}) > 0 THEN 1 - len(list_distinct({items})) / len({items}) ELSE 0.0 END"


PROFILE = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p AS (SELECT doc_id, {WORDS} AS w,
  list_filter(list_transform(string_split(lower(text), chr(10)), lambda x: {SQUEEZED}), lambda x: x <> '') AS l,
  list_filter(list_transform(string_split_regex(lower(text), '[.!?\\n]'), lambda x: {SQUEEZED}), lambda x: x <> '') AS s FROM t),
c AS (SELECT *, list_sum(list_transform(l, lambda x: length(x))) AS chars, list_sum(list_transform(list_distinct(l), lambda x: length(x))) AS once FROM p)
SELECT doc_id, len(w) AS n_words, {unlike('l')} AS line_share, {unlike('s')} AS sentence_share, {', '.join(map(run_share, (2, 3, 4, 5)))},
  CASE WHEN chars > 0 THEN (chars - once) / chars ELSE 0.0 END AS repeated_chars FROM c
"""
REPETITIVE = f"SELECT doc_id FROM ({PROFILE}) WHERE n_words >= 30 AND (" + " OR ".join(f"{name} >= {limit} - 1e-12" for name, limit in p5_repetition.LIMITS.items()) + ")"

RECORDS = "t AS (SELECT 'document' AS record_kind, doc_id AS record_id, text FROM documents UNION ALL SELECT 'candidate', candidate_id, fragment FROM boilerplate_candidates)"
FINDINGS = f"""
WITH {RECORDS}
SELECT record_kind, record_id, coalesce(regexp_matches(text, '[\\x{{ff01}}-\\x{{ff5e}}]'), false) AS full_width,
  coalesce(regexp_matches(text, '[\\x{{0300}}-\\x{{036f}}\\x{{1ab0}}-\\x{{1aff}}\\x{{1dc0}}-\\x{{1dff}}\\x{{20d0}}-\\x{{20dc}}\\x{{20e1}}\\x{{20e5}}-\\x{{20f0}}\\x{{fe20}}-\\x{{fe2f}}]'), false) AS marks,
  coalesce(regexp_matches(text, '[\\x{{180e}}\\x{{200b}}\\x{{200c}}\\x{{200e}}\\x{{200f}}\\x{{2060}}-\\x{{2064}}\\x{{feff}}]|{JOINER}'), false) AS zero_width,
  coalesce(regexp_matches(text, '[\\x{{00a0}}\\x{{2007}}\\x{{202f}}]'), false) AS fixed_space, coalesce(regexp_matches(text, '{MIXED}'), false) AS mixed_script FROM t
"""

REPEATED = P7.split("SELECT DISTINCT 'document'")[0]
P7_TEXT = f"""{REPEATED},
g AS (SELECT DISTINCT doc_id, line_no FROM f JOIN r USING (source, form)),
k AS (SELECT l.doc_id, count(g.line_no) AS n, coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.line_no IS NULL), '') AS kept FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.line_no = l.line_no GROUP BY l.doc_id)
SELECT d.doc_id, d.source, CASE WHEN n > 0 THEN kept ELSE text END AS text, CAST(coalesce(n, 0) AS INTEGER) AS n_removed FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""

WINDOWS = """
WITH l AS (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no, regexp_replace(unnest(string_split(text, chr(10))), '\\r$', '') AS line FROM documents WHERE length(text) >= 250),
w AS (SELECT doc_id, line_no, line, unnest(range(1, length(line) - 248)) AS j FROM l WHERE length(line) >= 250),
h AS (SELECT doc_id, line_no, j, md5_number_lower(substr(line, j, 250)) AS h FROM w),
s AS (SELECT h FROM h GROUP BY h HAVING min(doc_id) <> max(doc_id))"""
P10 = f"{WINDOWS}, m AS (SELECT DISTINCT h, doc_id FROM h WHERE h IN (SELECT h FROM s)) SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM m a JOIN m b ON a.h = b.h AND a.doc_id < b.doc_id"
P10_SHARE = f"""{WINDOWS},
c AS (SELECT doc_id, least(250, coalesce(lead(j) OVER (PARTITION BY doc_id, line_no ORDER BY j) - j, 250)) AS c FROM h WHERE h IN (SELECT h FROM s)),
u AS (SELECT doc_id, CAST(sum(c) AS BIGINT) AS shared_chars FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(length(text), 0) AS BIGINT) AS n_chars, coalesce(shared_chars, 0) AS shared_chars, CASE WHEN length(text) > 0 THEN coalesce(shared_chars, 0) / length(text) ELSE 0.0 END AS shared_share FROM documents d LEFT JOIN u USING (doc_id)
"""


#: All pairs by the items they share; the near-duplicate operator finds them by banding and may miss some near the limit.
P2 = f"""
WITH d AS (SELECT doc_id AS id, {WORDS} AS w FROM documents WHERE text IS NOT NULL),
ds AS (SELECT id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS s FROM d WHERE len(w) >= 40),
u AS (SELECT min(seq) AS id, url FROM scraped_urls WHERE url <> '' GROUP BY url),
ua AS (SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(url), '^[a-z][a-z0-9+.\\-]*://', ''), '^www\\.', ''), '(?s)[?#].*$', ''), '/+$', '') AS a FROM u),
us AS (SELECT id, list_distinct(list_transform(range(1, length(a) - 2), lambda i: substr(a, i, 4))) AS s FROM ua WHERE length(a) >= 4),
x AS (SELECT 'document' AS record_kind, id, s, len(s) AS n, 0.7 AS least FROM ds UNION ALL SELECT 'url', id, s, len(s), 0.75 FROM us),
g AS (SELECT record_kind, id, n, least, hash(unnest(s)) AS g FROM x),
c AS (SELECT a.record_kind, a.id AS id_a, b.id AS id_b, a.n AS n_a, b.n AS n_b, any_value(a.least) AS least, count(*) AS common FROM g a JOIN g b ON a.record_kind = b.record_kind AND a.g = b.g AND a.id < b.id
  AND least(a.n, b.n) >= a.least * greatest(a.n, b.n) - 1e-9 GROUP BY ALL)
SELECT record_kind, id_a, id_b FROM c WHERE common / (n_a + n_b - common) >= least - 1e-12
"""

P2_LINKS = f"""{P2.rsplit('SELECT record_kind', 1)[0].rstrip()},
k AS (SELECT id_a, id_b FROM c WHERE record_kind = 'document' AND common / (n_a + n_b - common) >= least - 1e-12),
e AS (SELECT id_a AS id FROM k UNION ALL SELECT id_b FROM k),
o AS (SELECT id, min(id) OVER (PARTITION BY list_sort(s)) AS class_id FROM ds)
SELECT o.id AS doc_id, class_id, count(e.id) AS n_links FROM o LEFT JOIN e ON e.id = o.id GROUP BY o.id, class_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": P2,
        "p2_links": P2_LINKS,
        "p5_found": P5,
        "p5_profile": PROFILE,
        "p5_repetitive": REPETITIVE,
        "p6_found": P6,
        "p6_findings": FINDINGS,
        "p7_found": P7,
        "p7_text": P7_TEXT,
        "p10_found": P10,
        "p10_share": P10_SHARE,
    }
