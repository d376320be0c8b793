"""Elements of pages as rows, and the container rules over them.

dom_nodes: page_id, pre, post, parent, tag, id, class, role, itemprop, component, text. A node contains another if
its (pre, post) interval holds the other's; all containment joins carry page_id as equi-key, so they stay within a
page's rows. Selectors are compiled to predicates: tag, .class, #id, [attr='v'], [attr*='v'], one descendant space.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T

SCHEMA = "page_id bigint, pre int, post int, parent int, tag string, id string, class string, role string, itemprop string, component string, text string"
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Pages handled at once inside a worker.
ROWS = 256
#: Elements that end an open paragraph where they start.
CLOSES_P = frozenset("p address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol pre section table ul".split())
ATTRIBUTES = {"class": "class", "id": "id", "role": "role", "itemprop": "itemprop", "data-component": "component"}
PART = re.compile(r"^(?:(?P<tag>[a-z]+)|\.(?P<class>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?P<op>\*?=)'(?P<value>[^']*)'\])$")


class Tree(HTMLParser):
    """Nodes of one page; ``text`` is what stands inside, white space collapsed, br as a line feed."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.open: list[int] = []
        self.clock = 0

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close("p")
        a = dict(attrs)
        if tag == "br":
            self.handle_data("\n")
        self.nodes.append({"pre": self.clock, "post": self.clock, "parent": self.open[-1] if self.open else -1, "tag": tag, "parts": []} | {name: a.get(attr) for attr, name in ATTRIBUTES.items()})
        self.clock += 1
        if tag in VOID:
            self.nodes[-1]["post"] = self.clock
            self.clock += 1
        else:
            self.open.append(len(self.nodes) - 1)

    def handle_endtag(self, tag):
        self._close(tag)

    def _close(self, tag: str) -> None:
        if any(self.nodes[i]["tag"] == tag for i in self.open):
            while self.open:
                i = self.open.pop()
                self.nodes[i]["post"] = self.clock
                self.clock += 1
                if self.nodes[i]["tag"] == tag:
                    break

    def handle_data(self, data):
        if self.open and self.nodes[self.open[-1]]["tag"] not in ("script", "style"):
            for i in self.open:
                self.nodes[i]["parts"].append(data)

    def close(self):
        super().close()
        while self.open:
            self.nodes[self.open.pop()]["post"] = self.clock
            self.clock += 1


def node_text(node: dict) -> str:
    return "\n".join(" ".join(x.split()) for x in "".join(node["parts"]).split("\n")).strip()


def node_matches(node: dict, part: str) -> bool:
    """``simple_selector`` for a node of a parsed page."""
    m = PART.match(part)
    if not m:
        raise ValueError(f"selector not supported: {part}")
    if m["tag"]:
        return node["tag"] == m["tag"]
    if m["class"]:
        return m["class"] in (node["class"] or "").split()
    if m["id"]:
        return node["id"] == m["id"]
    value = node[ATTRIBUTES[m["attr"]]] or ""
    return m["value"] in value if m["op"] == "*=" else value == m["value"]


def nodes(pages: DataFrame) -> DataFrame:
    """dom_nodes of pages (page_id, html), parsed once per page; null html has none."""

    def run(frames):
        for f in (whole.iloc[at : at + ROWS] for whole in frames for at in range(0, len(whole), ROWS)):
            out = []
            for page, html in zip(f["page_id"], f["html"]):
                tree = Tree()
                tree.feed(html or "")
                tree.close()
                for n in tree.nodes:
                    out.append({"page_id": page, "text": node_text(n)} | {k: n[k] for k in ("pre", "post", "parent", "tag", *ATTRIBUTES.values())})
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SCHEMA.split(", ")])

    return pages.select("page_id", "html").mapInPandas(run, SCHEMA)


def simple_selector(part: str, c: str = "") -> Column:
    """Predicate of one compound-free selector over a node's columns (``c`` is a prefix such as ``a.``)."""
    m = PART.match(part)
    if not m:
        raise ValueError(f"selector not supported: {part}")
    if m["tag"]:
        return F.col(f"{c}tag") == m["tag"]
    if m["class"]:
        return F.array_contains(F.split(F.coalesce(F.col(f"{c}class"), F.lit("")), r"\s+"), m["class"])
    if m["id"]:
        return F.coalesce(F.col(f"{c}id") == m["id"], F.lit(False))
    value = F.coalesce(F.col(f"{c}{ATTRIBUTES[m['attr']]}"), F.lit(""))
    return value.contains(m["value"]) if m["op"] == "*=" else value == m["value"]


def inside(outer: str, inner: str) -> Column:
    return (F.col(f"{outer}.page_id") == F.col(f"{inner}.page_id")) & (F.col(f"{outer}.pre") < F.col(f"{inner}.pre")) & (F.col(f"{outer}.post") > F.col(f"{inner}.post"))


def select(dom: DataFrame, selector: str) -> DataFrame:
    """Nodes that match ``selector``; with a descendant space the first part must contain the second."""
    *outer, last = selector.split(" ")
    found = dom.where(simple_selector(last))
    for part in outer:
        found = found.alias("i").join(dom.where(simple_selector(part)).alias("o"), inside("o", "i"), "left_semi").select("i.*")
    return found


def matches(dom: DataFrame, selectors: list[str]) -> DataFrame:
    """All nodes with the selectors they match and the selectors' places."""
    out = None
    for place, s in enumerate(selectors):
        one = select(dom, s).withColumn("selector", F.lit(s)).withColumn("place", F.lit(place))
        out = one if out is None else out.unionByName(one)
    return out


def outermost(matched: DataFrame, *keys: str) -> DataFrame:
    """Without nodes that stand inside another node of the same matches."""
    same = inside("o", "i")
    for k in keys:
        same = same & (F.col(f"o.{k}") == F.col(f"i.{k}"))
    return matched.alias("i").join(matched.alias("o"), same, "left_anti").select("i.*")


def first_matches(matched: DataFrame) -> DataFrame:
    """The first node of each selector on each page."""
    firsts = matched.groupBy("page_id", "selector").agg(F.min("pre").alias("pre"))
    return matched.join(firsts, ["page_id", "selector", "pre"], "left_semi")


def container_rank(dom: DataFrame, selectors: list[str] | None = None, min_chars: int = 20) -> DataFrame:
    """page_id, selector, place, n_paras, total_len and preview of the first match of each selector, empty ones too."""
    boxes = first_matches(matches(dom, selectors or C.CANDIDATE_CONTAINERS))
    ps = dom.where((F.col("tag") == "p") & (F.length("text") >= min_chars))
    held = boxes.alias("o").join(ps.alias("i"), inside("o", "i"), "left").groupBy("o.page_id", "o.selector", "o.place")
    counted = held.agg(F.count("i.pre").alias("n_paras"), F.coalesce(F.sum(F.length("i.text")), F.lit(0)).cast("bigint").alias("total_len"), F.slice(F.transform(F.array_sort(F.collect_list(F.when(F.col("i.pre").isNotNull(), F.struct("i.pre", "i.text")))), lambda x: x["text"]), 1, 2).alias("preview"))
    return counted.select("page_id", "selector", "place", "n_paras", "total_len", "preview")


def suspects(dom: DataFrame, boxes: DataFrame) -> DataFrame:
    """page_id, container, selector, place, tag, class, text: outermost suspect elements inside each container."""
    found = matches(dom, C.SUSPECTS).alias("i").join(boxes.withColumnRenamed("selector", "container").alias("o"), inside("o", "i"))
    rows = found.select("i.page_id", F.col("o.container").alias("container"), F.col("i.selector").alias("selector"), F.col("i.place").alias("place"), "i.pre", "i.post", "i.tag", "i.class", "i.text")
    return outermost(rows, "container", "selector")


def common_class_token(found: DataFrame, *keys: str) -> DataFrame:
    """Per group: the longest class token of all its classed elements (ties by alphabet) and whether it looks stable.

    Null with one element or nothing shared. Unstable tokens are taken only where no stable one is shared.
    """
    rows = found.withColumn("_row", F.struct(*[c for c in ("page_id", "pre") if c in found.columns]))
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.when(F.coalesce("class", F.lit("")) != "", 1).otherwise(0)).alias("classed"))
    tokens = rows.select(*keys, F.explode(F.array_distinct(F.split(F.coalesce("class", F.lit("")), r"\s+"))).alias("token")).where("token <> ''")
    shared = tokens.groupBy(*keys, "token").agg(F.count("*").alias("k")).join(sizes, list(keys)).where("k = classed and n >= 2")
    stable = (F.length("token") >= C.MIN_TOKEN) & ~T.hash_like(F.col("token"))
    # max_by of (stable, length); equal ones by the least token
    best = shared.withColumn("stable", stable).groupBy(*keys).agg(F.max(F.struct("stable", F.length("token").alias("l"))).alias("m"))
    top = shared.withColumn("stable", stable).join(best, list(keys)).where((F.col("stable") == F.col("m.stable")) & (F.length("token") == F.col("m.l")))
    got = top.groupBy(*keys).agg(F.min("token").alias("token"), F.first("stable").alias("stable"))
    return sizes.select(*keys, "n").join(got, list(keys), "left")


def exclude_selectors(found: DataFrame, *keys: str) -> DataFrame:
    """Per group (keys end with ``selector``): the selector that leaves its elements out, and whether to check it by hand."""
    tags = found.groupBy(*keys).agg(F.min("tag").alias("t1"), F.max("tag").alias("t2"))
    token = common_class_token(found, *keys)
    semantic = (F.col("t1") == F.col("t2")) & F.col("t1").isin(C.SEMANTIC_TAGS)
    made = F.when(semantic, F.col("t1")).when(F.col("token").isNotNull(), F.concat(F.lit("[class*='"), F.col("token"), F.lit("']"))).otherwise(F.col("selector"))
    return tags.join(token, list(keys)).select(*keys, made.alias("exclude"), (~semantic & ~F.coalesce("stable", F.lit(False))).alias("check"))


def pick_container(ranked: DataFrame) -> DataFrame:
    """page_id, selector, excludes. ``ranked`` has page_id, selector, place, total_len, n_suspects.

    The fullest container if clean; else the fullest clean one of at least CLEAN_RATIO of its length; else the
    fullest with excludes. Equal lengths go by place.
    """
    order = F.struct(F.col("total_len"), -F.col("place"))
    top = ranked.groupBy("page_id").agg(F.max_by(F.struct("selector", "total_len", "n_suspects", "place"), order).alias("top"))
    rest = ranked.join(top, "page_id").where("place <> top.place and n_suspects = 0 and total_len >= %f * top.total_len" % C.CLEAN_RATIO)
    alternative = rest.groupBy("page_id").agg(F.max_by("selector", order).alias("alt"))
    joined = top.join(alternative, "page_id", "left")
    clean = F.col("top.n_suspects") == 0
    chosen = F.when(clean | F.col("alt").isNull(), F.col("top.selector")).otherwise(F.col("alt"))
    return joined.select("page_id", chosen.alias("selector"), (~clean & F.col("alt").isNull()).alias("excludes"))


def inspect(dom: DataFrame, pages: DataFrame) -> DataFrame:
    """A draft override for every page: page_id, domain, article_selector, exclude_selectors, n_containers, n_checks (excludes to
    look at by hand), page_chars (of all paragraphs) and diagnosis: ok, no_container, or no_text where the page is so
    short that the article never loaded."""
    from ..functions import urls as U

    boxes = first_matches(matches(dom, C.CANDIDATE_CONTAINERS)).select("page_id", "selector", "pre", "post")
    held = suspects(dom, boxes)
    groups = held.groupBy("page_id", F.col("container").alias("selector")).agg(F.countDistinct("selector").alias("n_suspects"))
    ranked = container_rank(dom).join(groups, ["page_id", "selector"], "left").na.fill(0, ["n_suspects"])
    picked = pick_container(ranked).join(ranked.groupBy("page_id").agg(F.count("*").alias("n_containers")), "page_id")
    places = held.groupBy("page_id", "container", "selector").agg(F.min("place").alias("place"))
    made = exclude_selectors(held, "page_id", "container", "selector").join(places, ["page_id", "container", "selector"])
    listed = made.groupBy("page_id", "container").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("place", "exclude"))), lambda x: x["exclude"])).alias("list"), F.sum(F.col("check").cast("int")).alias("n_checks"))
    drafted = picked.join(listed.withColumnRenamed("container", "selector"), ["page_id", "selector"], "left")
    whole = dom.where("tag = 'p'").groupBy("page_id").agg(F.sum(F.length("text")).alias("page_chars"))
    out = pages.select("page_id", U.domain_key(U.netloc(F.col("url"))).alias("domain")).join(drafted, "page_id", "left").join(whole, "page_id", "left")
    chars = F.coalesce("page_chars", F.lit(0)).cast("bigint")
    excludes = F.when(F.col("excludes"), F.coalesce("list", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    diagnosis = F.when(F.col("selector").isNotNull(), "ok").when(chars < 500, "no_text").otherwise("no_container")
    return out.select("page_id", "domain", F.col("selector").alias("article_selector"), excludes.alias("exclude_selectors"), F.coalesce("n_containers", F.lit(0)).cast("bigint").alias("n_containers"), F.when(F.col("excludes"), F.coalesce("n_checks", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("n_checks"), chars.alias("page_chars"), diagnosis.alias("diagnosis"))


def override_paragraphs(dom: DataFrame, selector: str, excludes: list[str], min_chars: int = 20) -> DataFrame:
    """page_id, ps: texts of all paragraphs inside any match, without those with an excluded ancestor anywhere."""
    ps = dom.where((F.col("tag") == "p") & (F.length("text") >= min_chars))
    kept = ps.alias("i").join(select(dom, selector).alias("o"), inside("o", "i"), "left_semi").select("i.*")
    for e in excludes:
        kept = kept.where(~simple_selector(e)).alias("i").join(select(dom, e).alias("o"), inside("o", "i"), "left_anti").select("i.*")
    return kept.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pre", "text"))), lambda x: x["text"]).alias("ps"))


def fallback_paragraphs(dom: DataFrame, min_chars: int = 40) -> DataFrame:
    """page_id, ps: paragraphs of the first container selector whose first match has any; else of the whole page."""
    ps = dom.where(F.col("tag") == "p")
    boxes = first_matches(matches(dom, C.CONTAINERS))
    held = boxes.alias("o").join(ps.alias("i"), inside("o", "i")).select("o.page_id", "o.place", F.col("i.pre").alias("pre"), F.col("i.text").alias("text"))
    whole = ps.select("page_id", F.lit(len(C.CONTAINERS)).alias("place"), "pre", "text")
    every = held.unionByName(whole)
    best = every.groupBy("page_id").agg(F.min("place").alias("place"))
    chosen = every.join(best, ["page_id", "place"], "left_semi").where(F.length("text") >= min_chars)
    return chosen.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pre", "text"))), lambda x: x["text"]).alias("ps"))


def links(pages: DataFrame) -> DataFrame:
    """page_id, seq, url: absolute addresses of all href attributes, relative ones resolved against the page."""
    from ..functions import urls as U

    found = pages.select("page_id", F.col("url").alias("_page"), F.posexplode(F.regexp_extract_all("html", F.lit(r"(?i)<a\s[^>]*href\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1))).alias("seq", "href"))
    root = F.concat(U.scheme(F.col("_page")), F.lit("://"), U.netloc(F.col("_page")))
    folder = F.regexp_replace(U.path(F.col("_page")), r"[^/]*$", "")
    href = F.trim(F.replace(F.col("href"), F.lit("&amp;"), F.lit("&")))
    absolute = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(U.scheme(F.col("_page")), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.rlike("^[?#]|^$"), F.concat(root, U.path(F.col("_page")), href))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), href))
    )
    return found.select("page_id", "seq", absolute.alias("url"))
