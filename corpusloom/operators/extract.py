"""The extraction cascade over pages: the site's selector, a general extractor, known containers; the first success wins.

A page is parsed once, in the worker that holds it, and gives the paragraphs of all three paths, so nothing is shuffled;
cleaning is left to generated code. A path is only cleaned where those before it gave nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T
from . import dom as D
from . import paragraphs as P

#: Pages handled at once inside a worker; bounds its memory whatever the Arrow batch size is.
ROWS = 256
MIN_OVERRIDE, MIN_FALLBACK, ACCEPT, SHORT = 20, 40, 200, 500
Extractor = Callable[[str, str | None], str | None]


class Page:
    """A parsed page: its nodes, their texts, and which match a selector."""

    def __init__(self, html: str | None):
        tree = D.Tree()
        tree.feed(html or "")
        tree.close()
        self.nodes = tree.nodes
        self.ps = [i for i, n in enumerate(self.nodes) if n["tag"] == "p"]
        self._text: dict[int, str] = {}

    def text(self, i: int) -> str:
        if i not in self._text:
            self._text[i] = D.node_text(self.nodes[i])
        return self._text[i]

    def match(self, selector: str) -> list[bool]:
        *outer, last = selector.split(" ")
        got = [D.node_matches(n, last) for n in self.nodes]
        for part in outer:
            within = self.within([D.node_matches(n, part) for n in self.nodes])
            got = [g and w for g, w in zip(got, within)]
        return got

    def within(self, matched: list[bool]) -> list[bool]:
        """Whether a node stands inside a matched one."""
        out: list[bool] = []
        for n in self.nodes:
            up = n["parent"]
            out.append(up >= 0 and (out[up] or matched[up]))
        return out

    def override(self, selector: str, excludes: list[str]) -> list[str]:
        inside = self.within(self.match(selector))
        gone = [False] * len(self.nodes)
        for e in excludes:
            matched = self.match(e)
            gone = [g or m or w for g, m, w in zip(gone, matched, self.within(matched))]
        return [t for i in self.ps if inside[i] and not gone[i] and len(t := self.text(i)) >= MIN_OVERRIDE]

    def fallback(self) -> list[str]:
        for selector in C.CONTAINERS:
            first = next((i for i, m in enumerate(self.match(selector)) if m), None)
            if first is not None:
                held = self.within([i == first for i in range(len(self.nodes))])
                if any(held[i] for i in self.ps):
                    return [self.text(i) for i in self.ps if held[i]]
        return [self.text(i) for i in self.ps]

    def densest(self) -> str | None:
        """The paragraphs of the element whose own paragraphs hold most text (of equal ones the first)."""
        held: dict[int, list[str]] = {}
        for i in self.ps:
            if len(t := self.text(i)) >= MIN_OVERRIDE:
                held.setdefault(self.nodes[i]["parent"], []).append(t)
        return "\n\n".join(max(held.values(), key=lambda ts: sum(map(len, ts)))) if held else None


def extracted(pages: DataFrame, general: Extractor | None = None) -> DataFrame:
    """page_id, url, override, general, fallback (paragraphs of each path, null where there is none), page_chars, n_paras.

    ``pages`` has page_id, url, html, article_selector, exclude_selectors and, optionally, html_later: a snapshot taken
    later, which counts where the first gives a short text and the later one a longer. ``general`` takes (html, url); it
    defaults to the densest element. One that fails gives nothing.
    """
    later = "html_later" in pages.columns

    def ask(page: Page, html: str | None, url: str | None) -> str | None:
        if general is None:
            return page.densest()
        try:
            return general(html, url) if html else None
        except Exception:  # noqa: BLE001  a page that can't be read goes on to the fallback
            return None

    def run(frames):
        for f in (whole.iloc[at : at + ROWS] for whole in frames for at in range(0, len(whole), ROWS)):
            out: dict[str, list] = {k: [] for k in ("page_id", "url", "override", "general", "fallback", "page_chars", "n_paras")}
            for row in f.to_dict("records"):
                html, url = row["html"], row["url"]
                page = Page(html)
                selector, excludes = row["article_selector"], row["exclude_selectors"]
                text = ask(page, html, url)
                if text and ACCEPT < len(text.strip()) < SHORT and later and row["html_later"]:
                    again = ask(Page(row["html_later"]), row["html_later"], url)
                    if again and len(again.strip()) > len(text.strip()):
                        text = again
                out["page_id"].append(row["page_id"])
                out["url"].append(url)
                out["override"].append(page.override(selector, [] if excludes is None else list(excludes)) if selector else None)
                out["general"].append(text.strip().split("\n\n") if text and len(text.strip()) > ACCEPT else None)
                out["fallback"].append(page.fallback())
                out["page_chars"].append(sum(len(page.text(i)) for i in page.ps))
                out["n_paras"].append(len(page.ps))
            yield pd.DataFrame({k: pd.Series(v, dtype=object if k in ("url", "override", "general", "fallback") else "int64" if v and k != "page_id" else None) for k, v in out.items()})

    columns = ["page_id", "url", "html", "article_selector", "exclude_selectors", *(["html_later"] if later else [])]
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, override array<string>, general array<string>, fallback array<string>, page_chars bigint, n_paras int"
    return pages.select(*columns).mapInPandas(run, schema)


def cascade(pages: DataFrame, general: Extractor | None = None) -> DataFrame:
    """page_id, url, how (override, general, fallback or null), article."""
    none = F.array().cast("array<string>")
    df = extracted(pages, general)
    for path, options in (("override", {"min_chars": MIN_OVERRIDE, "accept": ACCEPT}), ("general", {"min_chars": 0, "accept": 0}), ("fallback", {"filter_first": True, "min_chars": MIN_FALLBACK, "accept": 0})):
        before = [F.col(f"_{p}") for p in ("override", "general") if f"_{p}" in df.columns]
        open_ = F.lit(True)
        for b in before:
            open_ = open_ & b.isNull()
        df = P.article(df.withColumn("_ps", F.when(open_, F.coalesce(path, none)).otherwise(none)), "_ps", f"_{path}", **options).drop("_ps")
    how = F.when(F.col("_override").isNotNull(), "override").when(F.col("_general").isNotNull(), "general").when(F.col("_fallback").isNotNull(), "fallback")
    article = T.strip(F.coalesce("_override", "_general", "_fallback"))
    return P.once(df.select("page_id", "url", how.alias("how"), article.alias("_article")), "article", F.when(F.col("_article") != "", F.col("_article"))).select("page_id", "url", "how", "article")
