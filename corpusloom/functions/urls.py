"""Address expressions by regular expression: parse_url drops ports, keeps parameters and fails on odd input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C
from .text import reduce_or

SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SCHEME, 1))


def _rest(url: Column) -> Column:
    return F.regexp_replace(url, SCHEME, "")


def netloc(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^//([^/?#]*)", 1)


def path(url: Column) -> Column:
    """Without query, fragment and the parameters of the last segment."""
    after = F.regexp_replace(_rest(url), r"^//[^/?#]*", "")
    return F.regexp_replace(F.regexp_extract(after, r"^([^?#]*)", 1), r";[^/]*$", "")


def bare_path(url: Column) -> Column:
    return F.regexp_replace(path(url), "/+$", "")


def normalize_url(url: Column) -> Column:
    return F.concat(scheme(url), F.lit("://"), netloc(url), bare_path(url))


def raw_domain(host: Column) -> Column:
    """Without any ``www.``, in the case given."""
    return F.replace(host, F.lit("www."), F.lit(""))


def domain_key(host: Column) -> Column:
    """Lower case, after every ``www.`` in lower case was taken out; the port stays."""
    return F.lower(raw_domain(host))


def safe_filename(url: Column, variant: str | None = None, max_len: int = 80) -> Column:
    last = F.element_at(F.split(bare_path(url), "/"), -1)
    slug = F.substring(F.regexp_replace(F.when(last == "", "index").otherwise(last), r"[^a-zA-Z0-9\-_]", "_"), 1, max_len)
    tail = f"__{variant}.txt" if variant else ".txt"
    return F.concat(raw_domain(netloc(url)), F.lit("__"), slug, F.lit("__"), F.substring(F.sha1(F.encode(url, "UTF-8")), 1, 8), F.lit(tail))


def looks_like_article(url: Column, base: Column, prefixes: Column) -> Column:
    """``prefixes`` are the site's listing prefixes (null or empty where it has none)."""
    p = F.lower(path(url))
    same = raw_domain(netloc(url)) == raw_domain(base)
    static = reduce_or([p.endswith(x) for x in C.STATIC_EXTENSIONS])
    hint = reduce_or([p.contains(x) for x in C.NON_ARTICLE_HINTS])
    segments = F.filter(F.split(bare_path(url), "/"), lambda s: s != "")
    slug = F.coalesce(F.try_element_at(segments, F.lit(-1)), F.lit(""))
    generic = (F.size(segments) >= 2) & ((F.length(F.regexp_replace(slug, "[^-]", "")) >= 3) | bare_path(url).rlike(r"(?U)\d{4,}"))
    listed = F.coalesce(F.size(prefixes), F.lit(0)) > 0
    return F.coalesce(same & ~static & ~hint & F.when(listed, F.exists(prefixes, lambda x: F.startswith(p, x))).otherwise(generic), F.lit(False))
