"""DuckDB SQL with the same results as the queries of the core."""

from __future__ import annotations

import re

from ..functions import constants as C
from . import fixtures as X
from . import pages

#: What counts as white space, for RE2.
SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '\A{SPACE}+|{SPACE}+\z', '', 'g')"


def collapse(c: str) -> str:
    return f"regexp_replace({c}, '{SPACE}+', ' ', 'g')"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def content_hash(c: str) -> str:
    return f"sha1(trim({collapse(f'lower({c})')}))"


SCHEME = r"'^([A-Za-z][A-Za-z0-9+.\-]*):'"
REST = f"regexp_replace(url, {SCHEME}, '')"


def of(column: str, template: str) -> str:
    return template.replace("url", column) if column != "url" else template


NETLOC = f"regexp_extract({REST}, '^//([^/?#]*)', 1)"
PATH = rf"regexp_replace(regexp_extract(regexp_replace({REST}, '^//[^/?#]*', ''), '^([^?#]*)', 1), ';[^/]*$', '')"
BARE = f"regexp_replace({PATH}, '/+$', '')"
NORM = f"lower(regexp_extract(url, {SCHEME}, 1)) || '://' || {NETLOC} || {BARE}"
RAW = f"replace({NETLOC}, 'www.', '')"
DOMAIN = f"lower({RAW})"
ADDRESSES = "u AS (SELECT seq, url, base FROM scraped_urls UNION ALL SELECT -seq, url, base FROM " + X.relation(X.URLS, "seq, url, base") + ")"


def words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '{SPACE}+'), lambda w: w <> '')"


def listed(items: list[str]) -> str:
    return "[" + ", ".join(map(q, items)) + "]"


PREFIXES = "s AS (SELECT domain, listing_path_prefixes AS prefixes FROM site_overrides UNION ALL SELECT * FROM (VALUES " + ", ".join(f"({q(d)}, CAST({listed(p)} AS VARCHAR[]))" for d, _, _, p in C.SITES) + "))"
LANGUAGES = "l AS (SELECT domain, '' AS prefix, code, locked FROM site_overrides UNION ALL SELECT domain, prefix, code, true FROM " + X.relation(C.SITE_LANGUAGES, "domain, prefix, code") + ")"

SLUG = f"string_split({BARE}, '/')[-1]"


def filename(variant: str) -> str:
    inner = rf"SELECT seq, {NORM} AS url FROM u"
    slug = rf"substr(regexp_replace(CASE WHEN {SLUG} = '' THEN 'index' ELSE {SLUG} END, '[^a-zA-Z0-9\-_]', '_', 'g'), 1, 80)"
    return f"{RAW} || '__' || {slug} || '__' || substr(sha1(url), 1, 8) || '{variant}.txt'", inner


def _filename_query() -> str:
    a, inner = filename("")
    b, _ = filename("__lemma")
    return f"WITH {ADDRESSES}, n AS ({inner}) SELECT seq, {a} AS filename, {b} AS lemma_filename FROM n"


ARTICLE = rf"""
  coalesce({RAW} = replace(base, 'www.', '')
  AND NOT ({' OR '.join(f"ends_with(lower({PATH}), {q(x)})" for x in C.STATIC_EXTENSIONS)})
  AND NOT ({' OR '.join(f"contains(lower({PATH}), {q(x)})" for x in C.NON_ARTICLE_HINTS)})
  AND CASE WHEN coalesce(len(prefixes), 0) > 0 THEN len(list_filter(prefixes, lambda x: starts_with(lower({PATH}), x))) > 0
      ELSE len(list_filter(string_split({BARE}, '/'), lambda x: x <> '')) >= 2
        AND (length(regexp_replace({SLUG}, '[^-]', '', 'g')) >= 3 OR regexp_matches({BARE}, '\d{{4,}}')) END, false)
"""
HASHED = f"h AS (SELECT doc_id, url, {content_hash('text')} AS content_hash FROM documents)"

# Paragraphs of documents and of small literal cases
CASES = [(-1, "A\nA\nB"), (-2, "A vis mere\nA\nA\nB"), (-3, "The council vis mere\nThe council met today."), (-4, "Brödtext här.\nFramsteg runt om i världen\nSå arbetar vi\nJust nuX"), (-5, "Brödtext här.\nFramsteg runt om i världen"), (-6, "Head"), (-7, "så arbetar vi\nx"), (-8, "A visa mer\nA visa mer\nA\nA lees meer\nA"), (-9, "x\n\ny")]
LINES = f"""
d AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL UNION ALL SELECT * FROM {X.relation(CASES, 'doc_id, text')}),
p AS (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, unnest(string_split(text, chr(10))) AS p FROM d)"""
DIGEST = "count(p) AS n, sha1(coalesce(string_agg(p, chr(10) ORDER BY i), '')) AS digest"
END = f"lower({strip('p')}) = 'så arbetar vi'"
ENDS = "[" + ", ".join(q(c) for c in C.SENTENCE_ENDS) + "]"
KEEPER = f"({strip('p')} = '' OR length({strip('p')}) > 60 OR list_contains({ENDS}, right({strip('p')}, 1)))"
MORE = rf"(?i){SPACE}*(?:{'|'.join(C.READ_MORE)}){SPACE}*$"


def deduped(x: str = "") -> str:
    """CTEs over ``{x}p`` (doc_id, i, p): the paragraphs that stay are those of ``{x}r`` that no teaser's full text follows."""
    return f"""
{x}k AS (SELECT doc_id, i, p, {strip('p')} AS b, lag({strip('p')}) OVER w AS a, {strip(f"regexp_replace(lag({strip('p')}) OVER w, '{MORE}', '')")} AS short FROM {x}p WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
{x}t AS (SELECT *, CASE WHEN a IS NULL THEN 1 WHEN a = b THEN 0 WHEN short <> '' AND short = b THEN 2 ELSE 1 END AS kind FROM {x}k),
{x}r AS (SELECT *, lead(kind) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM {x}t WHERE kind <> 0)"""


DEDUPE = deduped()

FREE = [x for x in C.PATTERNS if not x.startswith("^")]
ANCHORED = [x for x in C.PATTERNS if x.startswith("^")]


def flagged(c: str) -> str:
    on_line = " AND ".join(rf"regexp_matches(x, '(?i)\b{w}\b')" for w in C.ALL_OF)
    together = f"len(list_filter(string_split({c}, chr(10)), lambda x: {on_line})) > 0"
    return f"(list_contains({listed([x.lower() for x in C.LITERALS])}, lower({c})) OR regexp_matches({c}, {q('(?i)(?:' + '|'.join(ANCHORED + FREE) + ')')}) OR ({together}))"


def cleaned(lines: str, x: str = "", filter_last: bool = True) -> str:
    """CTE ``{x}n4`` (doc_id, article): the cleaning of one extraction path over ``lines`` (doc_id, i, p stripped)."""
    return f"""
{x}n2 AS (SELECT *, min(i) FILTER (WHERE {END}) OVER (PARTITION BY doc_id) AS e FROM {lines}),
{x}n3 AS (SELECT *, min(i) OVER v AS a, coalesce(max(i) FILTER (WHERE {KEEPER}) OVER v, 0) AS z FROM {x}n2 WHERE e IS NULL OR i < e WINDOW v AS (PARTITION BY doc_id)),
{x}p AS (SELECT doc_id, i, p FROM {x}n3 WHERE e IS NULL OR i <= greatest(a, z)), {deduped(x)},
{x}n4 AS (SELECT doc_id, string_agg(p, chr(10) || chr(10) ORDER BY i) AS article FROM {x}r WHERE coalesce(next, 1) = 1 {'AND NOT ' + flagged('p') if filter_last else ''} GROUP BY doc_id)"""


#: ``made``: the article of each document (null where at most 200 characters are left) and its hash.
CLEANED = f"""
n0 AS (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, unnest(string_split(text, chr(10))) AS p FROM documents WHERE text IS NOT NULL),
n1 AS (SELECT doc_id, i, {strip('p')} AS p FROM n0 WHERE length({strip('p')}) >= 20), {cleaned('n1')},
made AS (SELECT d.doc_id, d.url, source, CASE WHEN length(article) > 200 THEN article END AS article, CASE WHEN length(article) > 200 THEN {content_hash('article')} END AS content_hash FROM documents d LEFT JOIN n4 ON n4.doc_id = d.doc_id),
firsts AS (SELECT * FROM made WHERE article IS NOT NULL QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) = 1)"""

N_WORDS = f"len({words('p')})"
SUSPICIOUS = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, len({words('text')}) AS n, list_transform(list_filter(string_split(text, chr(10)), lambda p: {strip('p')} <> ''), lambda p: {N_WORDS}) AS s FROM t)
SELECT doc_id, n < {C.MIN_WORDS} OR coalesce(s[1] <= {C.SHORT_WORDS}, false) OR coalesce(s[-1] <= {C.SHORT_WORDS}, false)
  OR (len(s) >= {C.MIN_PARAGRAPHS} AND len(list_filter(s, lambda x: x <= {C.SHORT_WORDS})) / len(s) >= {C.SHORT_SHARE}) AS suspicious FROM w
"""

# Votes
WEIGHTS = "x(judge, weight) AS (VALUES " + ", ".join(f"('{j}', CAST({w} AS DOUBLE))" for j, w in C.JUDGE_WEIGHTS.items()) + ")"
VALID = f"""{WEIGHTS},
v AS (SELECT url, seq, judge, code, confidence, weight FROM (
  SELECT j.*, weight, row_number() OVER (PARTITION BY url, judge ORDER BY seq, code, confidence) AS rn
  FROM judge_votes j JOIN x USING (judge) WHERE url IS NOT NULL AND code IS NOT NULL AND confidence IS NOT NULL) WHERE rn = 1)"""


def resolved(votes: str, prefix: str = "") -> str:
    """CTEs ``r`` (url, winner_code, winner_share, n_votes, disputed, own) over a vote relation."""
    return f"""{prefix}c AS (SELECT url, code, sum(weight * confidence) AS w, min(seq) AS s, count(*) AS n FROM {votes} GROUP BY url, code),
{prefix}o AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY round(w, 9) DESC, s) AS rn, sum(w) OVER (PARTITION BY url) AS total, max(w) OVER (PARTITION BY url) AS top, sum(n) OVER (PARTITION BY url) AS n_votes FROM {prefix}c),
{prefix}r AS (SELECT url, code AS winner_code, CASE WHEN total > 0 THEN top / total ELSE 0.0 END AS winner_share, CAST(n_votes AS BIGINT) AS n_votes, n AS own,
  n_votes < {C.MIN_JUDGES} OR CASE WHEN total > 0 THEN top / total ELSE 0.0 END < {C.CONSENSUS_SHARE} AS disputed FROM {prefix}o WHERE rn = 1)"""


LOCAL = "('glotlid', 'openlid', 'lingua')"
PANEL = f"pv AS (SELECT * FROM v WHERE judge IN {LOCAL} UNION ALL SELECT * FROM v WHERE judge = 'site_hint' AND url IN (SELECT url FROM v WHERE judge IN {LOCAL}))"
ROUTE = f"""
WITH {VALID}, {PANEL}, {resolved('pv')}, {LANGUAGES},
e AS (SELECT doc_id, d.url, max(locked) AS locked, max_by(code, length(prefix)) AS code FROM documents d LEFT JOIN l ON  l.domain = {DOMAIN.replace('url', 'd.url')} AND starts_with({PATH.replace('url', 'd.url')}, prefix) GROUP BY doc_id, d.url)
SELECT e.url, CASE WHEN locked AND code IS NOT NULL THEN code WHEN winner_code IS NULL THEN 'unknown' WHEN disputed THEN 'disputed' ELSE winner_code END AS lang_folder,
  CASE WHEN locked AND code IS NOT NULL THEN 'locked' WHEN coalesce(disputed, false) THEN 'disputed' ELSE 'panel' END AS how
FROM e LEFT JOIN r ON r.url = e.url
"""

FILE = f"{RAW} || '__' || substr(regexp_replace(CASE WHEN {SLUG} = '' THEN 'index' ELSE {SLUG} END, '[^a-zA-Z0-9\\-_]', '_', 'g'), 1, 80) || '__' || substr(sha1(url), 1, 8) || '.txt'"
CORPUS = f"""
WITH {CLEANED}, {VALID}, {PANEL}, {resolved('pv', 'j')}, {LANGUAGES},
e AS (SELECT doc_id, max(locked) AS locked, max_by(code, length(prefix)) AS code FROM firsts f LEFT JOIN l ON l.domain = {DOMAIN.replace('url', 'f.url')} AND starts_with({PATH.replace('url', 'f.url')}, prefix) GROUP BY doc_id),
nu AS (SELECT doc_id, {NORM} AS url FROM firsts)
SELECT firsts.doc_id, {FILE.replace('url', 'nu.url')} AS filename, CAST(length(article) AS INTEGER) AS n_chars,
  CASE WHEN locked AND code IS NOT NULL THEN code WHEN winner_code IS NULL THEN 'unknown' WHEN disputed THEN 'disputed' ELSE winner_code END AS lang_folder
FROM firsts JOIN e ON e.doc_id = firsts.doc_id JOIN nu ON nu.doc_id = firsts.doc_id LEFT JOIN jr ON jr.url = firsts.url
"""

# Candidates
STRIPPED = strip("fragment")
COVERED = f"coalesce({flagged(STRIPPED)}, false)"
PENDING = f"(NOT coalesce(reviewed, false) AND NOT coalesce(discarded, false) AND NOT {COVERED} AND fragment IS NOT NULL)"
ESCAPED = lambda c: rf"regexp_replace({c}, '([\\.^$|?*+()\[\]{{}}])', '\\\1', 'g')"


def ends(keys: str, source: str) -> str:
    return f"""
f AS (SELECT *, {STRIPPED} AS f FROM {source} WHERE fragment IS NOT NULL),
g AS (SELECT {keys}, count(*) AS n, min(f) AS lo, max(f) AS hi, min(reverse(f)) AS rlo, max(reverse(f)) AS rhi, min(length(f)) AS shortest FROM f GROUP BY {keys}),
e AS (SELECT *, {prefix_of('lo', 'hi')} AS prefix, reverse({prefix_of('rlo', 'rhi')}) AS suffix FROM g)"""


def prefix_of(a: str, b: str) -> str:
    n = f"least(length({a}), length({b}))"
    return f"substr({a}, 1, coalesce(list_min(list_filter(range(1, {n} + 1), lambda i: substr({a}, i, 1) <> substr({b}, i, 1))) - 1, {n}))"


HEADED = "(SELECT *, lower(substr(fragment, 1, 12)) AS head FROM boilerplate_candidates)"
GENERAL = rf"""n >= 2 AND length(prefix) + length(suffix) < shortest AND length({strip('prefix')}) >= {C.MIN_PREFIX} AND length({strip('suffix')}) >= {C.MIN_SUFFIX}
  AND regexp_matches({strip('prefix')}, '[\p{{L}}\p{{N}}]') AND regexp_matches({strip('suffix')}, '[\p{{L}}\p{{N}}]')"""
PATTERN = f"CASE WHEN {GENERAL} THEN '^' || {ESCAPED(strip('prefix'))} || '.+' || {ESCAPED(strip('suffix'))} || '$' END"



def suggested(keys: str, source: str) -> str:
    """CTE ``z``: keys, pattern (null where the group has none), generalized."""
    first, *rest = keys.split(", ")
    equal = " AND ".join(f"f.{k} IS NOT DISTINCT FROM k.{k}" for k in (first, *rest))
    return f"""{ends(keys, source)},
k AS (SELECT {keys}, {PATTERN} AS pattern FROM e),
z0 AS (SELECT {', '.join('f.' + k for k in (first, *rest))}, k.pattern AS general, bool_and(coalesce(regexp_matches(f.f, '(?i)' || k.pattern), false)) AS ok, min(lower(f.f)) AS flo, max(lower(f.f)) AS fhi, arg_min(f.f, candidate_id) AS f1 FROM f JOIN k ON {equal} GROUP BY ALL),
z AS (SELECT {keys}, CASE WHEN general IS NOT NULL THEN CASE WHEN ok THEN general END WHEN flo = fhi THEN '^' || {ESCAPED('f1')} || '$' END AS pattern, general IS NOT NULL AND ok AS generalized FROM z0)"""


PROPOSED = f"""WITH {suggested('domain, reason', f'(SELECT * FROM boilerplate_candidates WHERE {PENDING})')},
pp AS (SELECT candidate_id, f.domain, f.reason, f.url, coalesce(z.pattern, '^' || {ESCAPED('f.f')} || '$') AS pattern, coalesce(z.pattern IS NOT NULL AND generalized, false) AS generalized
  FROM f LEFT JOIN z ON f.domain IS NOT DISTINCT FROM z.domain AND f.reason IS NOT DISTINCT FROM z.reason)"""

FENCED = r"regexp_replace(trim(raw), '\A```(?:json)?\s*|\s*```\z', '', 'g')"
PARSED = f"""
WITH b AS (SELECT batch_id, n, {FENCED} AS v FROM {X.relation(X.REPLIES, 'batch_id, n, raw')}),
a AS (SELECT batch_id, n, CAST(v AS JSON) AS j FROM b WHERE json_valid(v) AND json_type(v) = 'ARRAY'),
i AS (SELECT batch_id, n, unnest(json_extract(j, '$[*]')) AS x, unnest(range(CAST(json_array_length(j) AS BIGINT))) AS item FROM a),
g AS (SELECT batch_id, n, item, json_extract(x, '$.candidates') AS c,
  CASE WHEN json_type(x, '$.id') IN ('UBIGINT', 'BIGINT') THEN CAST(x->>'$.id' AS BIGINT) WHEN json_type(x, '$.id') = 'BOOLEAN' THEN CAST(x->>'$.id' = 'true' AS BIGINT) END AS slot FROM i),
l AS (SELECT * FROM g WHERE slot >= 0 AND slot < n AND json_type(c) = 'ARRAY' QUALIFY row_number() OVER (PARTITION BY batch_id, slot ORDER BY item DESC) = 1),
u AS (SELECT batch_id, slot, unnest(json_extract(c, '$[*]')) AS y, unnest(range(CAST(json_array_length(c) AS BIGINT))) AS pos FROM l)
SELECT batch_id, slot, CAST(pos AS INTEGER) AS pos, trim(y->>'$.fragment') AS fragment, coalesce(trim(y->>'$.reason'), '') AS reason FROM u WHERE trim(y->>'$.fragment') <> ''
"""
CODED = f"""
WITH b AS (SELECT id, {FENCED} AS v FROM {X.relation(X.CODES, 'id, raw')}),
c AS (SELECT id, CASE WHEN json_valid(v) THEN lower(trim(v->>'$.language_code')) END AS code, CASE WHEN json_valid(v) THEN TRY_CAST(v->>'$.confidence' AS DOUBLE) END AS sure FROM b)
SELECT id, CASE WHEN regexp_matches(code, '^[a-z]{{2}}$') THEN code END AS reply_code,
  CASE WHEN regexp_matches(code, '^[a-z]{{2}}$') THEN CASE WHEN sure >= 0 AND sure <= 1 THEN sure ELSE {C.REPLY_CONFIDENCE} END END AS reply_confidence FROM c
"""
FIRST_LINES = f"""
WITH q AS ({SUSPICIOUS}), k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM q WHERE suspicious),
fl AS (SELECT k.doc_id, url, n, trim(string_split(coalesce(text, ''), chr(10))[1], ' ' || chr(13)) AS fragment FROM k JOIN documents d ON d.doc_id = k.doc_id),
fr AS (SELECT * FROM fl WHERE length(fragment) BETWEEN 1 AND 60)"""


# Pages made from documents: the elements that a parser finds in them, numbered as it would
def element(pre: str, post: str, tag: str, cls: str = "NULL", item: str = "NULL", text: str = "''") -> str:
    return f"{{'pre': {pre}, 'post': {post}, 'tag': {tag}, 'class': {cls}, 'itemprop': {item}, 'text': {text}}}"


ITEM = q("[itemprop='articleBody']")
FIXED = [
    element("0", "s0 + 20 + w", "'html'"),
    element("1", "s0 + 19 + w", "'body'"),
    element("2", "7", "'nav'", "'menu'"),
    element("3", "4", "'a'"),
    element("5", "6", "'a'"),
    element("8", "s0 + 14 + w", "'main'", "'page'"),
    element("CASE WHEN w = 1 THEN 9 ELSE -1 END", "s0 + 12", f"CASE WHEN sel = 'article' THEN 'article' WHEN sel IN ('.article-body', {ITEM}) THEN 'div' ELSE 'section' END", "CASE WHEN sel = '.article-body' THEN 'article-body' END", f"CASE WHEN sel = {ITEM} THEN 'articleBody' END"),
    element("9 + w", "10 + w", "'h1'", text=q(pages.TITLE)),
    *(element(f"s0 + {4 * b}", f"s0 + {4 * b + 3}", "'div'", q(c), text=q(t)) for b, (c, t) in enumerate(pages.BLOCKS)),
    *(element(f"s0 + {4 * b + 1}", f"s0 + {4 * b + 2}", "'p'", text=q(t)) for b, (c, t) in enumerate(pages.BLOCKS)),
    element("s0 + 12 + w", "s0 + 13 + w", "'a'"),
    element("s0 + 15 + w", "s0 + 18 + w", "'footer'"),
    element("s0 + 16 + w", "s0 + 17 + w", "'p'", text=q(pages.FOOTER)),
]
MADE = f"""
pl0 AS (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, unnest(string_split(text, chr(10))) AS p FROM documents WHERE text IS NOT NULL),
pl AS (SELECT doc_id, {collapse(strip('p'))} AS p, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM pl0 WHERE {strip('p')} <> ''),
pg AS (SELECT doc_id AS page_id, url, article_selector AS sel, exclude_selectors AS excl, CASE WHEN article_selector = 'main' THEN 0 ELSE 1 END AS w, coalesce(n, 0) AS n,
  11 + CASE WHEN article_selector = 'main' THEN 0 ELSE 1 END + 2 * coalesce(n, 0) AS s0
  FROM documents d LEFT JOIN site_overrides s ON s.domain = d.source LEFT JOIN (SELECT doc_id AS id, count(*) AS n FROM pl GROUP BY doc_id) ON id = d.doc_id WHERE text IS NOT NULL)"""


def dom(with_literals: bool = True) -> str:
    """CTE ``dom``: page_id, pre, post, tag, class, itemprop, text."""
    literals = f"UNION ALL SELECT -page_id, pre, post, tag, class, NULL, text FROM {X.relation(X.NODES, 'page_id, pre, post, parent, tag, class, text')}" if with_literals else ""
    return f"""{MADE},
fx AS (SELECT page_id, unnest([{', '.join(FIXED)}]) AS e FROM pg),
dom AS (SELECT page_id, e.pre AS pre, e.post AS post, e.tag AS tag, e.class AS class, e.itemprop AS itemprop, e.text AS text FROM fx WHERE e.pre >= 0
  UNION ALL SELECT page_id, 11 + w + 2 * (k - 1), 12 + w + 2 * (k - 1), 'p', NULL, NULL, p FROM pl JOIN pg ON page_id = doc_id {literals})"""


def fits(part: str, a: str) -> str:
    """Whether the element ``a`` matches a selector without spaces; attributes that no page here has match nothing."""
    if re.fullmatch(r"[a-z]+", part):
        return f"{a}.tag = {q(part)}"
    if part.startswith("."):
        return f"list_contains(string_split_regex(coalesce({a}.class, ''), '\\s+'), {q(part[1:])})"
    if m := re.fullmatch(r"\[(class|itemprop)(\*?=)'([^']*)'\]", part):
        value = f"coalesce({a}.{m[1]}, '')"
        return f"contains({value}, {q(m[3])})" if m[2] == "*=" else f"{value} = {q(m[3])}"
    return "false"


INSIDE = "o.page_id = i.page_id AND o.pre < i.pre AND o.post > i.post"


def matched(selectors: list[str]) -> str:
    out = []
    for place, s in enumerate(selectors):
        *outer, last = s.split(" ")
        held = "".join(f" AND EXISTS (SELECT 1 FROM dom o WHERE {INSIDE} AND {fits(x, 'o')})" for x in outer)
        out.append(f"SELECT i.*, {q(s)} AS selector, {place} AS place FROM dom i WHERE {fits(last, 'i')}{held}")
    return " UNION ALL ".join(out)


BOXES = f"bx AS (SELECT * FROM ({matched(C.CANDIDATE_CONTAINERS)}) QUALIFY row_number() OVER (PARTITION BY page_id, selector ORDER BY pre) = 1)"
RANKS = f"rk AS (SELECT o.page_id, o.selector, o.place, count(i.pre) AS n_paras, CAST(coalesce(sum(length(i.text)), 0) AS BIGINT) AS total_len FROM bx o LEFT JOIN dom i ON {INSIDE} AND i.tag = 'p' AND length(i.text) >= 20 GROUP BY ALL)"
HELD = f"""sm AS ({matched(C.SUSPECTS)}),
s1 AS (SELECT i.*, o.selector AS container FROM sm i JOIN bx o ON {INSIDE}),
su AS (SELECT * FROM s1 i WHERE NOT EXISTS (SELECT 1 FROM s1 o WHERE {INSIDE} AND o.container = i.container AND o.selector = i.selector))"""
GENERATED = r"(regexp_matches(token, '^(?i:(?:sc|css|emotion|jsx|styled)[-_][a-z0-9]{5,})$') OR (length(token) >= 6 AND regexp_matches(replace(token, '-', ''), '^[\p{L}\p{N}]+$') AND length(regexp_replace(lower(token), '[^aeiou]', '', 'g')) <= 1))"


def tokens(source: str, keys: str) -> str:
    """CTE ``ct``: keys, n, token, stable."""
    on = " AND ".join(f"y.{k} = x.{k}" for k in keys.split(", "))
    return f"""c0 AS (SELECT {keys}, count(*) AS n, count(*) FILTER (WHERE coalesce(class, '') <> '') AS classed FROM {source} GROUP BY ALL),
c1 AS (SELECT {keys}, unnest(list_distinct(string_split_regex(coalesce(class, ''), '\\s+'))) AS token FROM {source}),
c2 AS (SELECT {keys}, token, count(*) AS m FROM c1 WHERE token <> '' GROUP BY ALL),
c3 AS (SELECT y.*, length(token) >= {C.MIN_TOKEN} AND NOT {GENERATED} AS stable FROM c2 y JOIN c0 x ON {on} WHERE m = classed AND n >= 2 QUALIFY row_number() OVER (PARTITION BY {', '.join('y.' + k for k in keys.split(', '))} ORDER BY stable DESC, length(token) DESC, token) = 1),
ct AS (SELECT x.*, token, stable FROM c0 x LEFT JOIN c3 y ON {on})"""


EXCLUDES = f"""{tokens('su', 'page_id, container, selector')},
tg AS (SELECT page_id, container, selector, min(tag) AS t1, max(tag) AS t2, min(place) AS place FROM su GROUP BY ALL),
ex AS (SELECT page_id, container, selector, place, CASE WHEN t1 = t2 AND t1 IN ('footer', 'nav', 'aside') THEN t1 WHEN token IS NOT NULL THEN concat('[class*=', chr(39), token, chr(39), ']') ELSE selector END AS exclude,
  NOT (t1 = t2 AND t1 IN ('footer', 'nav', 'aside')) AND NOT coalesce(stable, false) AS chk FROM tg JOIN ct USING (page_id, container, selector))"""
INSPECT = f"""
WITH {dom(False)}, {BOXES}, {RANKS}, {HELD}, {EXCLUDES},
sn AS (SELECT page_id, container AS selector, count(DISTINCT selector) AS n_suspects FROM su GROUP BY page_id, container),
r1 AS (SELECT rk.*, coalesce(n_suspects, 0) AS n_suspects, count(*) OVER (PARTITION BY page_id) AS n_containers, row_number() OVER (PARTITION BY page_id ORDER BY total_len DESC, place) AS rn FROM rk LEFT JOIN sn USING (page_id, selector)),
al AS (SELECT r.page_id, r.selector FROM r1 r JOIN r1 t ON t.page_id = r.page_id AND t.rn = 1 WHERE r.rn > 1 AND r.n_suspects = 0 AND r.total_len >= {C.CLEAN_RATIO} * t.total_len QUALIFY row_number() OVER (PARTITION BY r.page_id ORDER BY r.total_len DESC, r.place) = 1),
pk AS (SELECT t.page_id, t.n_containers, CASE WHEN n_suspects = 0 OR al.selector IS NULL THEN t.selector ELSE al.selector END AS selector, n_suspects > 0 AND al.selector IS NULL AS excludes FROM r1 t LEFT JOIN al USING (page_id) WHERE rn = 1),
e1 AS (SELECT page_id, container, exclude, min(place) AS place FROM ex GROUP BY ALL),
e2 AS (SELECT page_id, container, string_agg(exclude, ' ' ORDER BY place) AS list FROM e1 GROUP BY ALL),
e3 AS (SELECT page_id, container, sum(CAST(chk AS INTEGER)) AS n_checks FROM ex GROUP BY ALL),
ch AS (SELECT page_id, sum(length(text)) AS page_chars FROM dom WHERE tag = 'p' GROUP BY ALL)
SELECT d.doc_id AS page_id, {DOMAIN.replace('url', 'd.url')} AS domain, pk.selector AS article_selector, CASE WHEN excludes THEN coalesce(list, '') ELSE '' END AS exclude_selectors, CAST(coalesce(n_containers, 0) AS BIGINT) AS n_containers,
  CAST(CASE WHEN excludes THEN coalesce(n_checks, 0) ELSE 0 END AS BIGINT) AS n_checks, CAST(coalesce(page_chars, 0) AS BIGINT) AS page_chars, CASE WHEN pk.selector IS NOT NULL THEN 'ok' WHEN coalesce(page_chars, 0) < 500 THEN 'no_text' ELSE 'no_container' END AS diagnosis
FROM documents d LEFT JOIN pk ON pk.page_id = d.doc_id LEFT JOIN e2 ON e2.page_id = d.doc_id AND e2.container = pk.selector LEFT JOIN e3 ON e3.page_id = d.doc_id AND e3.container = pk.selector LEFT JOIN ch ON ch.page_id = d.doc_id
"""
# Paragraphs of each path; blocks go where the site excludes them, and stand behind the lines
PATHS = f"""{MADE},
bl AS (SELECT page_id, unnest([{', '.join(f"{{'i': 1000000000 + {b}, 'p': {q(t)}, 'gone': list_contains(excl, {q(e)})}}" for b, ((_, t), e) in enumerate(zip(pages.BLOCKS, ["[class*='share']", '.advert', "[class*='tag']"])))}]) AS b FROM pg),
al AS (SELECT doc_id, k AS i, p, false AS gone FROM pl UNION ALL SELECT page_id, b.i, b.p, coalesce(b.gone, false) FROM bl)"""
ARTICLES = f"""{PATHS},
ov AS (SELECT al.doc_id, i, p FROM al JOIN pg ON page_id = al.doc_id WHERE sel IS NOT NULL AND NOT gone AND length(p) >= 20), {cleaned('ov', 'v')},
oa AS (SELECT * FROM vn4 WHERE length(article) > 200),
g0 AS (SELECT doc_id, i, p FROM al WHERE i < 1000000000 AND length(p) >= 20 AND doc_id NOT IN (SELECT doc_id FROM oa)),
g1 AS (SELECT * FROM g0 WHERE doc_id IN (SELECT doc_id FROM g0 GROUP BY doc_id HAVING sum(length(p)) + 2 * (count(*) - 1) > 200)), {cleaned('g1', 'g')},
ga AS (SELECT * FROM gn4 WHERE article <> ''),
f0 AS (SELECT doc_id, i, p FROM al WHERE length(p) >= 40 AND NOT {flagged('p')} AND doc_id NOT IN (SELECT doc_id FROM oa) AND doc_id NOT IN (SELECT doc_id FROM ga)), {cleaned('f0', 'f', False)},
art AS (SELECT d.doc_id AS page_id, d.url, CASE WHEN oa.article IS NOT NULL THEN 'override' WHEN ga.article IS NOT NULL THEN 'general' WHEN fn4.article <> '' THEN 'fallback' END AS how,
  {strip("coalesce(oa.article, ga.article, fn4.article)")} AS article FROM documents d LEFT JOIN oa ON oa.doc_id = d.doc_id LEFT JOIN ga ON ga.doc_id = d.doc_id LEFT JOIN fn4 ON fn4.doc_id = d.doc_id)"""
DIGEST_OF = "sha1(coalesce(string_agg(p, chr(10) ORDER BY i) FILTER (WHERE {}), ''))"
FILED = f"""
WITH {ARTICLES}, sv AS (SELECT *, {content_hash('article')} AS h FROM art WHERE article IS NOT NULL QUALIFY row_number() OVER (PARTITION BY h ORDER BY page_id) = 1),
{VALID}, {PANEL}, {resolved('pv', 'j')}, {LANGUAGES},
e AS (SELECT page_id, max(locked) AS locked, max_by(code, length(prefix)) AS code FROM sv LEFT JOIN l ON l.domain = {DOMAIN.replace('url', 'sv.url')} AND starts_with({PATH.replace('url', 'sv.url')}, prefix) GROUP BY page_id),
nu AS (SELECT page_id, {NORM} AS url FROM sv),
fi AS (SELECT sv.page_id, {FILE.replace('url', 'nu.url')} AS filename, article, CASE WHEN locked AND code IS NOT NULL THEN code WHEN winner_code IS NULL THEN 'unknown' WHEN disputed THEN 'disputed' ELSE winner_code END AS lang_folder
  FROM sv JOIN e ON e.page_id = sv.page_id JOIN nu ON nu.page_id = sv.page_id LEFT JOIN jr ON jr.url = sv.url)
SELECT page_id, lang_folder, 'raw' AS variant, filename, sha1(article) AS digest FROM fi
UNION ALL SELECT page_id, lang_folder, 'lemmatized', regexp_replace(filename, '\\.txt$', '__lemma.txt'), sha1({collapse(strip('article'))}) FROM fi
"""
SHARES = "[class*='share']"


def oracle_sql() -> dict[str, str]:
    seen = f"m AS (SELECT DISTINCT {NORM} AS norm FROM documents)"
    return {
        "corpus_pipeline": CORPUS,
        "article_text": f"WITH {CLEANED} SELECT doc_id, CAST(length(article) AS INTEGER) AS n_chars, content_hash FROM made",
        "source_totals": f"WITH {CLEANED} SELECT source, count(*) AS n, CAST(sum(length(article)) AS BIGINT) AS n_chars FROM firsts GROUP BY source",
        "run_counters": f"WITH {CLEANED} SELECT CASE WHEN article IS NULL THEN 'failed' WHEN doc_id IN (SELECT doc_id FROM firsts) THEN 'saved' ELSE 'duplicate' END AS status, count(*) AS n FROM made GROUP BY 1",
        "normalize_url": f"WITH {ADDRESSES} SELECT seq, {NORM} AS url_norm FROM u",
        "domain_key": f"WITH {ADDRESSES} SELECT seq, {DOMAIN} AS domain, {RAW} AS raw_domain FROM u",
        "safe_filename": _filename_query(),
        "looks_like_article": f"WITH {ADDRESSES}, {PREFIXES}, k AS (SELECT *, {DOMAIN} AS dom FROM u) SELECT seq, {ARTICLE} AS is_article FROM k LEFT JOIN s ON s.domain = k.dom",
        "url_dedup": f"WITH {ADDRESSES} SELECT min(seq) AS seq, {NORM} AS url FROM u WHERE url IS NOT NULL GROUP BY {NORM}",
        "new_links": f"WITH {ADDRESSES}, {PREFIXES}, {seen}, k AS (SELECT *, {DOMAIN} AS dom FROM u), a AS (SELECT seq, {NORM} AS norm FROM k LEFT JOIN s ON s.domain = k.dom WHERE {ARTICLE}) SELECT min(seq) AS seq, norm AS url FROM a WHERE norm NOT IN (SELECT norm FROM m WHERE norm IS NOT NULL) GROUP BY norm",
        "expected_language": f"WITH {ADDRESSES}, {LANGUAGES}, k AS (SELECT seq, {DOMAIN} AS dom, {PATH} AS path FROM u WHERE url IS NOT NULL) SELECT seq, max_by(code, length(prefix)) AS code, max(locked) AS locked FROM k JOIN l ON l.domain = k.dom AND starts_with(path, prefix) GROUP BY seq",
        "site_override": f"WITH k AS (SELECT doc_id, {DOMAIN} AS domain FROM documents) SELECT doc_id, domain, article_selector, CAST(len(exclude_selectors) AS INTEGER) AS n_excludes FROM k LEFT JOIN site_overrides USING (domain)",
        "known_locked_languages": "SELECT DISTINCT code FROM " + X.relation(C.LISTINGS, "domain, code, url"),
        "listing_urls_for_codes": "SELECT min(ord) AS ord, url FROM " + X.relation([(i, *r) for i, r in enumerate(C.LISTINGS)], "ord, domain, code, url") + " WHERE code IN ('is', 'cy', 'nb', 'fr') GROUP BY url",
        "content_hash": f"WITH {HASHED} SELECT doc_id, content_hash FROM h",
        "content_dedup": f"WITH {HASHED} SELECT min(doc_id) AS doc_id, content_hash FROM h WHERE content_hash IS NOT NULL GROUP BY content_hash",
        "content_duplicates": f"WITH {HASHED}, k AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY content_hash) AS first_key FROM h WHERE content_hash IS NOT NULL) SELECT doc_id, first_key FROM k WHERE doc_id <> first_key",
        "content_known": f"WITH {HASHED} SELECT DISTINCT doc_id FROM h JOIN scraped_urls s ON s.content_hash = h.content_hash AND s.url <> h.url",
        "manifest_parse": "SELECT trim(string_split(v, chr(9))[1]) AS url, nullif(trim(string_split(v, chr(9))[2]), '') AS content_hash FROM " + X.relation(X.MANIFEST, "i, v") + " WHERE trim(v) <> ''",
        "manifest_reconcile": "SELECT seq, url FROM scraped_urls WHERE url <> '' AND substr(sha1(url), 1, 8) IN (SELECT substr(sha1(url), 1, 8) FROM documents)",
        "boilerplate_flag": f"WITH b AS (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS p FROM documents WHERE text IS NOT NULL UNION ALL SELECT candidate_id, -1, fragment FROM boilerplate_candidates WHERE fragment IS NOT NULL) SELECT doc_id, CAST(pos AS INTEGER) AS pos FROM b WHERE {flagged(strip('p'))}",
        "truncate_end_marker": f"WITH {LINES}, e AS (SELECT doc_id, min(i) FILTER (WHERE {END}) AS e FROM p GROUP BY doc_id), k AS (SELECT p.doc_id, i, CASE WHEN e IS NULL OR i < e THEN p END AS p FROM p JOIN e USING (doc_id)) SELECT doc_id, CAST(count(p) AS INTEGER) AS n, sha1(coalesce(string_agg(p, chr(10) ORDER BY i), '')) AS digest FROM k GROUP BY doc_id",
        "strip_trailing_fragment": f"WITH {LINES}, e AS (SELECT doc_id, greatest(1, coalesce(max(i) FILTER (WHERE {KEEPER}), 0)) AS e FROM p GROUP BY doc_id) SELECT doc_id, CAST(count(p) AS INTEGER) AS n, sha1(string_agg(p, chr(10) ORDER BY i)) AS digest FROM p JOIN e USING (doc_id) WHERE i <= e GROUP BY doc_id",
        "dedupe_consecutive": f"WITH {LINES}, {DEDUPE} SELECT doc_id, CAST(count(*) AS INTEGER) AS n, sha1(string_agg(p, chr(10) ORDER BY i)) AS digest FROM r WHERE coalesce(next, 1) = 1 GROUP BY doc_id",
        "is_suspicious": SUSPICIOUS,
        "detection_sample": f"WITH s AS (SELECT doc_id, CASE WHEN length(text) > {C.HEAD_CHARS + C.TAIL_CHARS} THEN substr(text, 1, {C.HEAD_CHARS}) || {X.literal(C.OMITTED)} || right(text, {C.TAIL_CHARS}) ELSE text END AS t FROM documents) SELECT doc_id, CAST(length(t) AS INTEGER) AS n_chars, sha1(t) AS digest FROM s",
        "llm_batches": f"WITH q AS ({SUSPICIOUS}), k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM q WHERE suspicious) SELECT doc_id, n // {C.BATCH} AS batch_id, CAST(n % {C.BATCH} AS INTEGER) AS slot FROM k",
        "batch_payloads": f"WITH q AS ({SUSPICIOUS}), k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM q WHERE suspicious) SELECT n // {C.BATCH} AS batch_id, count(*) AS n, least(8000, 200 + 300 * count(*)) AS max_tokens FROM k GROUP BY 1",
        "batch_replies": f"{FIRST_LINES} SELECT n // {C.BATCH} AS batch_id, CAST(n % {C.BATCH} AS INTEGER) AS slot, 0 AS pos, fragment, 'short first line' AS reason FROM fr",
        "batch_candidates": f"{FIRST_LINES}, kk AS (SELECT *, {RAW} AS domain, lower({strip('fragment')}) AS key FROM fr), seen AS (SELECT coalesce(domain, '') AS dom, lower({strip('fragment')}) AS key FROM boilerplate_candidates WHERE fragment IS NOT NULL) SELECT doc_id, url, domain, fragment, 'short first line' AS reason FROM kk WHERE (domain, key) NOT IN (SELECT (dom, key) FROM seen) QUALIFY row_number() OVER (PARTITION BY domain, key ORDER BY n) = 1",
        "parse_batch_response": PARSED,
        "parse_language_response": CODED,
        "llm_tiebreak": f"WITH {VALID}, {PANEL}, {resolved('pv', 'a')}, z AS (SELECT url, seq, judge, code, confidence, weight FROM pv UNION ALL SELECT d.url, 1000000, 'gemini', CASE WHEN contains(substr(text, 1, 2000), ' the ') THEN 'en' ELSE 'is' END, CASE WHEN contains(substr(text, 1, 2000), ' the ') THEN 0.8 ELSE {C.REPLY_CONFIDENCE} END, 0.9 FROM documents d JOIN ar ON ar.url = d.url AND ar.disputed WHERE {strip('text')} <> ''), {resolved('z')} SELECT url, winner_code, round(winner_share, 6) AS winner_share, n_votes, disputed FROM r",
        "judge_panel": f"""WITH t AS (SELECT url, source, substr(coalesce(text, ''), 1, 2000) AS t FROM documents),
v AS (SELECT url, 0 AS seq, 'glotlid' AS judge, 'is' AS code, CAST(0.9 AS DOUBLE) AS confidence FROM t WHERE contains(t, 'ð')
UNION ALL SELECT url, 1, 'openlid', 'is', 0.8 FROM t WHERE contains(lower(t), 'þ')
UNION ALL SELECT url, 2, 'lingua', 'en', 0.6 FROM t WHERE contains(replace(t, chr(10), ' '), ' the '))
SELECT * FROM v UNION ALL SELECT url, 4, 'site_hint', code, {C.SITE_HINT_CONFIDENCE} FROM t JOIN site_overrides s ON s.domain = t.source WHERE url IN (SELECT url FROM v) AND code IS NOT NULL""",
        "iso_normalize": "WITH m(a, b) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in C.ISO3.items()) + "), k AS (SELECT id, lower(string_split(replace(label, '__label__', ''), '_')[1]) AS c FROM " + X.relation(X.LABELS, "id, label") + ") SELECT id, coalesce(b, c) AS code FROM k LEFT JOIN m ON a = c",
        "openlid_preprocess": rf"SELECT doc_id, sha1(regexp_replace(regexp_replace(lower(replace({strip('text')}, chr(10), ' ')), '[^\p{{L}}\p{{M}}\p{{Nl}}\p{{Pc}}\x{{200c}}\x{{200d}}\s\p{{Z}}\x0b\x85]|\p{{Nd}}', '', 'g'), '[\s\p{{Z}}\x0b\x85]{{2,}}', ' ', 'g')) AS digest FROM documents WHERE text IS NOT NULL",
        "resolve_votes": f"WITH {VALID}, {resolved('v')} SELECT url, winner_code, round(winner_share, 6) AS winner_share, n_votes, disputed FROM r",
        "strict_votes": f"WITH {VALID}, {resolved('v')} SELECT url, disputed OR own < {C.MIN_JUDGES} AS disputed FROM r",
        "panel_verdict": f"WITH {VALID}, {PANEL}, {resolved('pv')} SELECT d.url, CASE WHEN winner_code IS NULL THEN 'unknown' WHEN disputed THEN 'disputed' ELSE winner_code END AS code, coalesce(disputed, false) AS disputed, winner_code, round(coalesce(winner_share, 0.0), 6) AS winner_share FROM documents d LEFT JOIN r ON r.url = d.url",
        "tiebreak_verdict": f"WITH {VALID}, {PANEL}, {resolved('pv', 'a')}, z AS (SELECT url, seq, judge, code, confidence, weight FROM pv UNION ALL SELECT d.url, 1000000, 'gemini', s.code, 0.6, 0.9 FROM documents d JOIN site_overrides s ON s.domain = d.source JOIN ar ON ar.url = d.url AND ar.disputed), {resolved('z')} SELECT url, winner_code, round(winner_share, 6) AS winner_share, n_votes, disputed FROM r",
        "route_language": ROUTE,
        "dispute_log": f"WITH {VALID}, {PANEL}, {resolved('pv')}, b AS (SELECT url, list(DISTINCT judge) AS judges FROM pv GROUP BY url) SELECT r.url, n_votes, array_to_string(list_filter(['glotlid', 'openlid', 'lingua'], lambda j: NOT list_contains(judges, j)), ',') AS abstained, winner_code AS best_guess, round_even(winner_share, 3) AS best_guess_share FROM r JOIN b USING (url) WHERE disputed AND r.url NOT IN (SELECT url FROM language_disputes WHERE url IS NOT NULL)",
        "pending_candidates": f"SELECT count(*) AS n FROM boilerplate_candidates WHERE {PENDING}",
        "candidate_groups": f"SELECT domain, reason, count(*) AS n, min(candidate_id) AS first_id FROM boilerplate_candidates WHERE {PENDING} GROUP BY domain, reason",
        "discard_pending": f"SELECT candidate_id, CASE WHEN {PENDING} THEN true ELSE reviewed END AS reviewed, CASE WHEN {PENDING} THEN true ELSE discarded END AS discarded, promoted FROM boilerplate_candidates",
        "candidate_upsert": f"WITH k AS (SELECT candidate_id, coalesce(domain, '') AS dom, lower({strip(chr(99) + 'oalesce(fragment, ' + chr(39) * 2 + ')')}) AS key FROM boilerplate_candidates) SELECT min(candidate_id) AS candidate_id FROM k WHERE key <> '' AND (dom, key) NOT IN (('bbc.com', 'contains upsetting scenes.'), ('', 'x')) GROUP BY dom, key",
        "lcp_lcs": f"WITH {ends('domain, reason', 'boilerplate_candidates')} SELECT domain, reason, n, prefix, suffix FROM e",
        "generalize_group": f"WITH {ends('domain, head', HEADED)} SELECT domain, head, n, {PATTERN} AS pattern FROM e",
        "literal_patterns": f"WITH f AS (SELECT DISTINCT domain, reason, {STRIPPED} AS fragment FROM boilerplate_candidates WHERE fragment IS NOT NULL) SELECT domain, reason, fragment, '^' || {ESCAPED('fragment')} || '$' AS pattern FROM f WHERE fragment <> ''",
        "suggested_patterns": f"WITH {suggested('domain, head', HEADED)} SELECT domain, head, pattern, generalized FROM z WHERE pattern IS NOT NULL",
        "review_proposals": f"{PROPOSED} SELECT candidate_id, pattern, generalized FROM pp",
        "review_flags": f"{PROPOSED} SELECT c.candidate_id, CASE WHEN pattern IS NOT NULL THEN true ELSE reviewed END AS reviewed, discarded, CASE WHEN length(pattern) % 2 = 0 THEN true ELSE promoted END AS promoted FROM boilerplate_candidates c LEFT JOIN pp ON pp.candidate_id = c.candidate_id",
        "review_patterns": f"{PROPOSED} SELECT domain, reason, pattern, generalized, count(*) AS n, min(url) FILTER (WHERE url <> '') AS example FROM pp WHERE length(pattern) % 2 = 0 GROUP BY domain, reason, pattern, generalized",
        "hash_like": r"SELECT id, regexp_matches(token, '^(?i:(?:sc|css|emotion|jsx|styled)[-_][a-z0-9]{5,})$') OR (length(token) >= 6 AND regexp_matches(replace(token, '-', ''), '^[\p{L}\p{N}]+$') AND length(regexp_replace(lower(token), '[^aeiou]', '', 'g')) <= 1) AS looks_generated FROM " + X.relation(X.TOKENS, "id, token"),
        "dedupe_nested": f"WITH {dom()}, m AS ({matched([SHARES])}) SELECT page_id, CAST(pre AS INTEGER) AS pre, tag FROM m i WHERE NOT EXISTS (SELECT 1 FROM m o WHERE {INSIDE})",
        "container_rank": f"WITH {dom()}, {BOXES}, {RANKS} SELECT page_id, selector, n_paras, total_len FROM rk",
        "container_suspects": f"WITH {dom()}, {BOXES}, {HELD} SELECT page_id, container, selector, CAST(pre AS INTEGER) AS pre, tag FROM su",
        "common_class_token": f"WITH {dom()}, sm AS ({matched(C.SUSPECTS)}), {tokens('sm', 'page_id, selector')} SELECT page_id, selector, n, token, stable FROM ct",
        "exclude_selectors": f"WITH {dom()}, {BOXES}, {HELD}, {EXCLUDES} SELECT page_id, container, selector, exclude FROM ex",
        "inspect_report": INSPECT,
        "page_links": f"WITH h AS (SELECT doc_id AS page_id, lower(regexp_extract(url, {SCHEME}, 1)) AS sch, {NETLOC} AS host, url FROM documents WHERE text IS NOT NULL), k AS (SELECT page_id, unnest([sch || '://' || host || '/news/', url || '?ref=menu', sch || '://other.example/a-b-c-d-2026']) AS url, unnest([0, 1, 2]) AS seq FROM h) SELECT page_id, CAST(seq AS INTEGER) AS seq, url FROM k",
        "page_paragraphs": f"WITH {PATHS}, fo AS (SELECT doc_id, CAST(count(*) + 1 AS INTEGER) AS n_paras, CAST(sum(length(p)) + {len(pages.FOOTER)} AS BIGINT) AS page_chars, CAST(count(*) FILTER (WHERE NOT gone AND length(p) >= 20) AS INTEGER) AS n_override, {DIGEST_OF.format('NOT gone AND length(p) >= 20')} AS override, CAST(count(*) AS INTEGER) AS n_fallback, {DIGEST_OF.format('true')} AS fallback FROM al GROUP BY doc_id) SELECT d.doc_id AS page_id, coalesce(n_paras, 0) AS n_paras, coalesce(page_chars, 0) AS page_chars, CASE WHEN s.domain IS NOT NULL THEN coalesce(n_override, 0) END AS n_override, CASE WHEN s.domain IS NOT NULL THEN coalesce(override, sha1('')) END AS override, coalesce(n_fallback, 0) AS n_fallback, coalesce(fallback, sha1('')) AS fallback FROM documents d LEFT JOIN fo ON fo.doc_id = d.doc_id LEFT JOIN site_overrides s ON s.domain = d.source",
        "page_articles": f"WITH {ARTICLES} SELECT page_id, how, CAST(length(article) AS INTEGER) AS n_chars, {content_hash('article')} AS content_hash FROM art",
        "scraped_corpus": FILED,
        "scrape_counters": f"WITH {ARTICLES}, h AS (SELECT *, {content_hash('article')} AS h FROM art), st AS (SELECT CASE WHEN article IS NULL THEN 'failed' WHEN page_id = min(page_id) OVER (PARTITION BY h) THEN 'saved' ELSE 'duplicate' END AS status FROM h) SELECT status, count(*) AS n FROM st GROUP BY status",
        "pick_container": "WITH r AS (SELECT * FROM " + X.relation(X.RANKED, "page_id, selector, place, total_len, n_suspects") + "), t AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY total_len DESC, place) AS rn FROM r), a AS (SELECT * FROM t WHERE rn = 1), b AS (SELECT t.page_id, t.selector, row_number() OVER (PARTITION BY t.page_id ORDER BY t.total_len DESC, t.place) AS rn FROM t JOIN a USING (page_id) WHERE t.rn > 1 AND t.n_suspects = 0 AND t.total_len >= 0.7 * a.total_len) SELECT a.page_id, CASE WHEN a.n_suspects = 0 OR b.selector IS NULL THEN a.selector ELSE b.selector END AS selector, a.n_suspects > 0 AND b.selector IS NULL AS excludes FROM a LEFT JOIN b ON b.page_id = a.page_id AND b.rn = 1",
    }
