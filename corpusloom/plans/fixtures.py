"""Small literal inputs, written once and used by Spark and by the SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def literal(value: object) -> str:
    """A literal that Spark and DuckDB both read the same way."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    if isinstance(value, int):
        return str(value)
    parts = str(value).replace("\\", "\x00").split("\n")
    out = " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts)
    return out.replace("\x00", "' || chr(92) || '") if "\x00" in out else out


def relation(rows: list[tuple], names: str) -> str:
    """``(VALUES ...) AS t(names)``."""
    return "(VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + f") AS t({names})"


def frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


URLS = [
    (1, "https://www.ruv.is/frettir/some-slug-2026?utm=x#top", "www.ruv.is"),
    (2, "https://www.bbc.com/news/articles/c80ny93xlrvo/", "www.bbc.com"),
    (3, "https://www.bbc.com/news/live/c80ny93xlrvo", "www.bbc.com"),
    (4, "https://www.bbc.com/news/about-our-new-site-2026", "www.bbc.com"),
    (5, "https://example.com/world/biden-signs-new-bill", "www.example.com"),
    (6, "https://example.com/biden-signs-new-bill", "example.com"),
    (7, "https://example.com/a/photo-12345.jpg", "example.com"),
    (8, "https://other.org/world/a-b-c-d", "example.com"),
    (9, "https://example.com/accountability/some-long-slug-here", "example.com"),
    (10, "https://Example.com/world/a-b-c-d", "example.com"),
    (11, "https://example.com/x/y;v=1?q=2", "example.com"),
    (12, "https://example.com/", "example.com"),
    (13, "https://example.com/2026/07/story", "example.com"),
    (14, "https://www.bbc.com/cymrufyw/erthyglau/c1d2e3", "www.bbc.com"),
    (15, "https://www.bbc.com/cymrufyw", "www.bbc.com"),
    (16, "HTTP://www.nrk.no:8080/Nyheter//a-b-c-d-1///", "nrk.no"),
    (17, "", "example.com"),
    (18, None, "example.com"),
]
LABELS = [(1, "__label__nld_Latn"), (2, "__label__kal_Latn"), (3, "__label__fao_Latn"), (4, "isl"), (5, "__label__ENG_Latn"), (6, ""), (7, None)]
TOKENS = [(1, "sc-jXbNGH"), (2, "css-1a2b3c"), (3, "sports"), (4, "trc_related_container"), (5, "shareBox"), (6, "byline"), (7, "taglist"), (8, "article-body"), (9, "xkcdqz"), (10, ""), (11, None)]
MANIFEST = [(1, "u1\th1"), (2, "u2"), (3, ""), (4, "u3\t"), (5, "  ")]
NODES = [
    # page_id, pre, post, parent, tag, class, text
    (1, 0, 39, -1, "body", None, ""),
    (1, 1, 30, 0, "main", "page", ""),
    (1, 2, 21, 1, "article", "story", ""),
    (1, 3, 4, 2, "p", None, "The council met on Tuesday to discuss the bridge."),
    (1, 5, 14, 2, "div", "share", "Share this"),
    (1, 6, 13, 4, "div", "share-tools", "Share this"),
    (1, 7, 12, 5, "ul", "share-list", "Share this"),
    (1, 8, 9, 6, "a", "share-link sc-jXbNGH", "Share"),
    (1, 10, 11, 6, "a", "share-link", "this"),
    (1, 15, 16, 2, "p", None, "Nobody voted against the plan for the new school."),
    (1, 17, 18, 2, "p", None, "Short."),
    (1, 22, 25, 1, "footer", None, "All rights reserved"),
    (1, 23, 24, 11, "p", None, "All rights reserved by the publisher."),
    (2, 0, 19, -1, "body", None, ""),
    (2, 1, 10, 0, "main", None, ""),
    (2, 2, 3, 1, "p", "lead", "A harbour town waits for its ferry, once more."),
    (2, 4, 5, 1, "p", None, "The road authority has no answer to the letter."),
    (2, 11, 14, 0, "nav", "promo promo-x7rtbd", "Home"),
    (2, 15, 16, 0, "div", "promo promo-x7rtbd", "More"),
]
RANKED = [
    (1, "main", 8, 1000, 0),
    (2, "main", 8, 1000, 2),
    (2, "article", 0, 700, 0),
    (3, "main", 8, 1000, 2),
    (3, "article", 0, 699, 0),
    (4, "article", 0, 500, 1),
    (4, "main", 8, 500, 0),
]
REPLIES = [
    (1, 2, '```json\n[{"id":1,"candidates":[{"fragment":" A ","reason":"r"}]},{"id":5,"candidates":[]},{"id":"0","candidates":[{"fragment":"B"}]},7,{"id":1,"candidates":[{"fragment":"C"},{"fragment":""}]}]\n```'),
    (2, 2, "oops"),
    (3, 1, '{"id":0}'),
    (4, 2, '[{"id":true,"candidates":[{"fragment":"D","reason":" x "}]},{"id":0,"candidates":"no"}]'),
    (5, 1, None),
]
CODES = [(1, '{"language_code":"IS","confidence":0.9}'), (2, '{"language_code":"da"}'), (3, '{"language_code":"nb","confidence":"x"}'), (4, '{"language_code":"sv","confidence":1.5}'), (5, '{"language_code":"unknown"}'), (6, "not json"), (7, None), (8, '```json\n{"language_code":"fr","confidence":0.25}\n```')]
PAGES = [
    (
        1,
        "https://www.example.com/news/index.html",
        "<html><body><nav><a href='/news/about-us'>About</a></nav><article><h1>Title</h1><p>The council met on Tuesday to discuss the repair of the long bridge.<p>The council met on Tuesday to discuss the repair of the long bridge."
        "<p>Nobody voted against the plan, and the mayor said that the work would begin before winter &amp; end in May.</p><p>Share</p><script>var a='</p>';</script><div class='share'><p>Share this article with all of your many friends</p></div></article>"
        '<a href="story-one-two-three-2026">One</a><a href="https://other.org/a/b-c-d-e">Other</a><a href="#top">Top</a><footer><p>All rights reserved by the publisher of this page.</p></footer></body></html>',
    ),
    (2, "https://www.example.com/empty", "<html><body><main></main></body></html>"),
    (3, "https://www.example.com/plain", "<p>" + "A paragraph outside of every container is taken from the whole page. " * 4 + "</p><!-- note --><p>Too short</p>"),
    (4, "https://www.example.com/null", None),
]
