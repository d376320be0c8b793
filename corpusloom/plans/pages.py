"""Rendered pages made from documents: each text stands in the markup that its site's article selector asks for.

The given tables hold no pages, so the page operators run over these: navigation, the site's container with a heading and
one paragraph a line (closing tags left out, as on real pages), share, advert and tag blocks, a link beside the article
and a footer. Null texts are pages that never came (null html).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Blocks inside the container, with their classes and texts.
BLOCKS = [
    ("share share-tools", "Share this article with all of your many good friends"),
    ("advert", "Buy a new boat at the harbour shop before the summer ends"),
    ("taglist tag-x7rtbd", "Harbour, ferries, bridges, schools and everything else"),
]
TITLE, FOOTER = "A page of the paper", "All rights reserved by the publisher of this page."
#: Opening and closing tags of the container by the site's selector; main stands on every page.
OPENINGS = {"[itemprop='articleBody']": ('<div itemprop="articleBody">', "</div>"), "article": ("<article>", "</article>"), ".article-body": ('<div class="article-body">', "</div>"), "main": ("", "")}
SECTION = ("<section>", "</section>")


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def pages(documents: DataFrame, sites: DataFrame) -> DataFrame:
    """page_id, url, html, article_selector, exclude_selectors (both of the site, null where it has none)."""
    own = sites.select(F.col("domain").alias("source"), "article_selector", "exclude_selectors")
    at = documents.select("doc_id", "url", "source", "text").join(F.broadcast(own), "source", "left")  # a table written by hand, a row a site
    lines = F.filter(F.transform(F.split("text", "\n"), T.strip), lambda p: p != "")
    body = F.concat(F.array_join(F.transform(lines, lambda p: F.concat(F.lit("<p>"), escaped(p))), ""), F.when(F.size(lines) > 0, "</p>").otherwise(""))
    opening, closing = (F.lit(SECTION[k]) for k in (0, 1))
    for selector, tags in OPENINGS.items():
        opening = F.when(F.col("article_selector") == selector, tags[0]).otherwise(opening)
        closing = F.when(F.col("article_selector") == selector, tags[1]).otherwise(closing)
    blocks = "".join(f'<div class="{c}"><p>{t}</p></div>' for c, t in BLOCKS)
    html = F.concat(
        F.lit('<html><body><nav class="menu"><a href="/news/">News</a><a href="'), escaped(F.coalesce("url", F.lit(""))), F.lit('?ref=menu">Here</a></nav><main class="page">'), opening, F.lit(f"<h1>{TITLE}</h1>"),
        body, F.lit(blocks), closing, F.lit(f'<a href="//other.example/a-b-c-d-2026">Other</a></main><footer><p>{FOOTER}</p></footer></body></html>'),
    )
    return at.select(F.col("doc_id").alias("page_id"), "url", html.alias("html"), "article_selector", "exclude_selectors")
