"""All queries of the core. Each runs over its whole tables; ``sql.py`` has the same in SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T
from ..functions import urls as U
from ..functions.judges import panel_votes
from ..operators import candidates as K
from ..operators import dom as D
from ..operators import extract
from ..operators import ordering as O
from ..operators import paragraphs as P
from ..operators import replies as R
from ..operators import votes as V
from ..session import cut, spread, table
from ..sources import manifest as M
from . import fixtures as X
from . import pipeline
from . import sql
from .pages import pages as made_pages

Query = Callable[[SparkSession, str], DataFrame]
_all: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _all[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_all)


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()


def _docs(spark, d):
    return spread(table(spark, d, "documents"))


def _urls(spark, d):
    """Manifest addresses, and literal ones with seq below 0."""
    own = table(spark, d, "scraped_urls").select("seq", "url", "base")
    return own.unionByName(X.frame(spark, [(-i, u, b) for i, u, b in X.URLS], "seq bigint, url string, base string"))


def _prefixes(spark, d):
    sites = table(spark, d, "site_overrides").select("domain", "listing_path_prefixes")
    return sites.unionByName(X.frame(spark, [(s[0], s[3]) for s in C.SITES], "domain string, listing_path_prefixes array<string>"))


def _languages(spark, d):
    sites = table(spark, d, "site_overrides").select("domain", F.lit("").alias("prefix"), "code", "locked")
    return sites.unionByName(X.frame(spark, [(*r, True) for r in C.SITE_LANGUAGES], "domain string, prefix string, code string, locked boolean"))


# Addresses


@query
def corpus_pipeline(spark, d):
    return pipeline.corpus(_docs(spark, d), _languages(spark, d), table(spark, d, "judge_votes"))


@query
def normalize_url(spark, d):
    return _urls(spark, d).select("seq", U.normalize_url(F.col("url")).alias("url_norm"))


@query
def domain_key(spark, d):
    host = U.netloc(F.col("url"))
    return _urls(spark, d).select("seq", U.domain_key(host).alias("domain"), U.raw_domain(host).alias("raw_domain"))


@query
def safe_filename(spark, d):
    norm = U.normalize_url(F.col("url"))
    return _urls(spark, d).select("seq", U.safe_filename(norm).alias("filename"), U.safe_filename(norm, "lemma").alias("lemma_filename"))


@query
def looks_like_article(spark, d):
    formed = _urls(spark, d).withColumn("domain", U.domain_key(U.netloc(F.col("url")))).join(_prefixes(spark, d), "domain", "left")
    return formed.select("seq", U.looks_like_article(F.col("url"), F.col("base"), F.col("listing_path_prefixes")).alias("is_article"))


@query
def url_dedup(spark, d):
    return pipeline.given(_urls(spark, d).where("url is not null"))


@query
def new_links(spark, d):
    seen = _docs(spark, d).select(U.normalize_url(F.col("url")).alias("url"))
    return pipeline.auto(_urls(spark, d), seen, _prefixes(spark, d))


@query
def expected_language(spark, d):
    longest = F.max_by("code", F.length("prefix"))
    at = _urls(spark, d).where("url is not null").select("seq", "url", U.domain_key(U.netloc(F.col("url"))).alias("domain"))
    fit = at.join(_languages(spark, d), "domain").where(F.startswith(U.path(F.col("url")), F.col("prefix")))
    return fit.groupBy("seq").agg(longest.alias("code"), F.max("locked").alias("locked"))


@query
def site_override(spark, d):
    sites = table(spark, d, "site_overrides").select("domain", "article_selector", F.size("exclude_selectors").alias("n_excludes"))
    docs = _docs(spark, d).select("doc_id", U.domain_key(U.netloc(F.col("url"))).alias("domain"))
    return docs.join(sites, "domain", "left").select("doc_id", "domain", "article_selector", "n_excludes")


@query
def known_locked_languages(spark, d):
    return X.frame(spark, C.LISTINGS, "domain string, code string, url string").select("code").distinct().orderBy("code")


@query
def listing_urls_for_codes(spark, d):
    rows = X.frame(spark, [(i, *r) for i, r in enumerate(C.LISTINGS)], "ord int, domain string, code string, url string")
    return O.keep_first(rows.where(F.col("code").isin("is", "cy", "nb", "fr")), "url", "ord").select("ord", "url")


# Ordered de-duplication and the manifest


@query
def content_hash(spark, d):
    return _docs(spark, d).select("doc_id", T.content_hash(F.col("text")).alias("content_hash"))


@query
def content_dedup(spark, d):
    hashed = content_hash(spark, d).where("content_hash is not null")
    return O.keep_first(hashed, "content_hash", "doc_id").select("doc_id", "content_hash")


@query
def content_duplicates(spark, d):
    hashed = content_hash(spark, d).where("content_hash is not null")
    return O.content_firsts(hashed, "doc_id", "content_hash").where("is_duplicate").select("doc_id", "first_key")


@query
def content_known(spark, d):
    """Documents whose hash the manifest already has from an earlier line than their own."""
    own = _docs(spark, d).select("doc_id", "url", T.content_hash(F.col("text")).alias("content_hash"))
    lines = table(spark, d, "scraped_urls").where("content_hash is not null and url is not null").select("content_hash", F.col("url").alias("other"))
    return own.join(lines, "content_hash").where("url <> other").select("doc_id").distinct()


@query
def manifest_parse(spark, d):
    return M.parse_manifest(X.frame(spark, [(v,) for _, v in X.MANIFEST], "value string"))


@query
def manifest_reconcile(spark, d):
    files = _docs(spark, d).select(U.safe_filename(F.col("url")).alias("name"))
    return O.reconcile(table(spark, d, "scraped_urls").select("seq", "url"), files).select("seq", "url")


@query
def run_counters(spark, d):
    made = cut(pipeline.clean(_docs(spark, d)).select("doc_id", "content_hash"))
    firsts = O.content_firsts(made.where("content_hash is not null"), "doc_id", "content_hash")
    status = made.select("doc_id").join(firsts.select("doc_id", "is_duplicate"), "doc_id", "left")
    return status.select(F.when(F.col("is_duplicate").isNull(), "failed").when(F.col("is_duplicate"), "duplicate").otherwise("saved").alias("status")).groupBy("status").agg(F.count("*").alias("n"))


# Paragraphs


@query
def boilerplate_flag(spark, d):
    ps = _docs(spark, d).select("doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("pos", "p"))
    own = table(spark, d, "boilerplate_candidates").select(F.col("candidate_id").alias("doc_id"), F.lit(-1).alias("pos"), F.col("fragment").alias("p")).where("p is not null")
    return ps.unionByName(own).where(T.looks_like_boilerplate(F.col("p"))).select("doc_id", "pos")


def _joined(df, ps):
    return df.select("doc_id", F.size(ps).alias("n"), F.sha1(F.encode(F.array_join(ps, "\n"), "UTF-8")).alias("digest"))


def _paragraphs(spark, d):
    extra = [
        (-1, ["A", "A", "B"]),
        (-2, ["A vis mere", "A", "A", "B"]),
        (-3, ["The council vis mere", "The council met today."]),
        (-4, ["Brödtext här.", "Framsteg runt om i världen", "Så arbetar vi", "Just nuX"]),
        (-5, ["Brödtext här.", "Framsteg runt om i världen"]),
        (-6, ["Head"]),
        (-7, ["så arbetar vi", "x"]),
        (-8, ["A visa mer", "A visa mer", "A", "A lees meer", "A"]),
        (-9, ["x", "", "y"]),
    ]
    own = _docs(spark, d).where("text is not null").select("doc_id", T.paragraphs(F.col("text")).alias("ps"))
    return own.unionByName(X.frame(spark, [(i, "\n".join(p)) for i, p in extra], "doc_id bigint, t string").select("doc_id", T.paragraphs(F.col("t")).alias("ps")))


@query
def truncate_end_marker(spark, d):
    return _joined(_paragraphs(spark, d).select("doc_id", P.truncated(F.col("ps")).alias("ps")), "ps")


@query
def strip_trailing_fragment(spark, d):
    return _joined(_paragraphs(spark, d).select("doc_id", P.without_trailing_fragment(F.col("ps")).alias("ps")), "ps")


@query
def dedupe_consecutive(spark, d):
    return _joined(P.dedupe_consecutive(_paragraphs(spark, d), "ps", "out").select("doc_id", F.col("out").alias("ps")), "ps")


@query
def article_text(spark, d):
    return pipeline.clean(_docs(spark, d)).select("doc_id", F.length("article").alias("n_chars"), "content_hash")


@query
def source_totals(spark, d):
    made = pipeline.clean(_docs(spark, d)).where("article is not null").select("doc_id", "source", F.length("article").alias("n_chars"), "content_hash")
    return pipeline.first_of_contents(made).groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))


# Suspicion, batches and replies


@query
def is_suspicious(spark, d):
    return _docs(spark, d).select("doc_id", T.is_suspicious(F.col("text")).alias("suspicious"))


@query
def detection_sample(spark, d):
    s = T.detection_sample(F.col("text"))
    return _docs(spark, d).select("doc_id", F.length(s).alias("n_chars"), F.sha1(F.encode(s, "UTF-8")).alias("digest"))


@query
def llm_batches(spark, d):
    return R.batches(_docs(spark, d)).select("doc_id", "batch_id", "slot")


@query
def batch_payloads(spark, d):
    return R.payloads(R.batches(_docs(spark, d))).select("batch_id", "n", "max_tokens")


def short_first_lines(payload: str) -> str:
    """Stands in for a model: proposes the first line of each text that has at most 60 characters."""
    items = [(x["id"], x["text"].split("\n")[0].strip(" \r")) for x in json.loads(payload)]
    reply = [{"id": i, "candidates": [{"fragment": t, "reason": "short first line"}] if 0 < len(t) <= 60 else []} for i, t in items]
    return f"```json\n{json.dumps(reply, ensure_ascii=False)}\n```"


def _replied(spark, d):
    batched = cut(R.batches(_docs(spark, d)))
    return R.parsed(R.asked(R.payloads(batched), short_first_lines)), batched


@query
def batch_replies(spark, d):
    """Suspicious documents, batches, payloads, replies of a model's stand-in, and what is read from them."""
    return _replied(spark, d)[0].select("batch_id", F.col("slot").cast("int").alias("slot"), "pos", "fragment", "reason")


@query
def batch_candidates(spark, d):
    """What the replies add to the candidate log."""
    found, batched = _replied(spark, d)
    return K.upsert(table(spark, d, "boilerplate_candidates"), R.logged(found, batched, _docs(spark, d)), "place").select("doc_id", "url", "domain", "fragment", "reason")


@query
def parse_batch_response(spark, d):
    return R.parsed(X.frame(spark, X.REPLIES, "batch_id bigint, n bigint, raw string"))


@query
def parse_language_response(spark, d):
    return R.language_reply(X.frame(spark, X.CODES, "id int, raw string")).select("id", "reply_code", "reply_confidence")


# The language panel


@query
def iso_normalize(spark, d):
    return X.frame(spark, X.LABELS, "id int, label string").select("id", T.iso_code(F.col("label")).alias("code"))


@query
def openlid_preprocess(spark, d):
    return _docs(spark, d).where("text is not null").select("doc_id", F.sha1(F.encode(T.openlid_preprocess(F.col("text")), "UTF-8")).alias("digest"))


def _shown(df):
    return df.withColumn("winner_share", F.round("winner_share", 6))


@query
def resolve_votes(spark, d):
    return _shown(V.resolve(V.valid(table(spark, d, "judge_votes"))))


@query
def strict_votes(spark, d):
    return V.resolve(V.valid(table(spark, d, "judge_votes")), strict=True).select("url", "disputed")


@query
def panel_verdict(spark, d):
    return _shown(V.verdicts(_docs(spark, d).select("url"), V.resolve(V.panel(V.valid(table(spark, d, "judge_votes"))))))


def _second_opinion(spark, d):
    """Stands in for a model's opinion: the site's own code."""
    sites = table(spark, d, "site_overrides").select(F.col("domain").alias("source"), "code")
    return _docs(spark, d).join(sites, "source").select("url", "code", F.lit(0.6).alias("confidence"))


@query
def tiebreak_verdict(spark, d):
    return _shown(V.tiebreak(table(spark, d, "judge_votes"), _second_opinion(spark, d)))


def _stand_in(rule):
    """A loader as a model has it: the callable is made on the worker."""
    return lambda: rule


JUDGES = {
    "glotlid": _stand_in(lambda t: ("__label__isl_Latn", 0.9) if "ð" in t else ("__label__eng_Latn", 0.2)),
    "openlid": _stand_in(lambda t: ("__label__isl_Latn", 0.8) if "þ" in t else None),
    "lingua": _stand_in(lambda t: ("en", 0.6) if " the " in t else ("kl", 0.7) if "q" in t else None),
}


@query
def judge_panel(spark, d):
    """Votes of three stand-ins for the models, with the site's hint: thresholds, abstentions, the closed list."""
    sites = table(spark, d, "site_overrides").select(F.col("domain").alias("source"), "code")
    docs = _docs(spark, d).select("url", "text", "source")
    return panel_votes(docs, JUDGES, docs.join(sites, "source").select("url", "code"), codes=["is", "en"])


def common_words(text: str) -> str:
    """Stands in for a model that names a language."""
    return '{"language_code": "EN", "confidence": 0.8}' if " the " in text else '{"language_code": "is"}'


@query
def llm_tiebreak(spark, d):
    """Disputed urls are asked about, the reply is read and votes once more."""
    votes = table(spark, d, "judge_votes")
    disputed = V.resolve(V.panel(V.valid(votes))).where("disputed").select("url")
    asked = R.ask_language(_docs(spark, d).join(disputed, "url", "left_semi"), common_words)
    named = R.language_reply(asked).where("reply_code is not null").select("url", F.col("reply_code").alias("code"), F.col("reply_confidence").alias("confidence"))
    return _shown(V.tiebreak(votes, named))


@query
def route_language(spark, d):
    return V.route(_docs(spark, d).select("url"), _languages(spark, d), table(spark, d, "judge_votes"))


@query
def dispute_log(spark, d):
    return V.disputes(table(spark, d, "judge_votes"), table(spark, d, "language_disputes"))


# Candidates


@query
def pending_candidates(spark, d):
    c = table(spark, d, "boilerplate_candidates")
    return c.where(K.pending(c)).agg(F.count("*").alias("n"))


@query
def candidate_groups(spark, d):
    c = table(spark, d, "boilerplate_candidates")
    return c.where(K.pending(c)).groupBy("domain", "reason").agg(F.count("*").alias("n"), F.min("candidate_id").alias("first_id"))


@query
def discard_pending(spark, d):
    return K.discard_pending(table(spark, d, "boilerplate_candidates")).select("candidate_id", "reviewed", "discarded", "promoted")


@query
def candidate_upsert(spark, d):
    c = table(spark, d, "boilerplate_candidates")
    log = X.frame(spark, [("bbc.com", " Contains upsetting scenes."), (None, "x")], "domain string, fragment string")
    return K.upsert(log, c, "candidate_id").select("candidate_id")


@query
def lcp_lcs(spark, d):
    return K.shared_ends(table(spark, d, "boilerplate_candidates"), "domain", "reason").select("domain", "reason", "n", "prefix", "suffix")


@query
def generalize_group(spark, d):
    return K.generalized(table(spark, d, "boilerplate_candidates").withColumn("head", F.lower(F.substring("fragment", 1, 12))), "domain", "head")


@query
def literal_patterns(spark, d):
    return K.literals(table(spark, d, "boilerplate_candidates"))


@query
def suggested_patterns(spark, d):
    return K.suggestions(table(spark, d, "boilerplate_candidates").withColumn("head", F.lower(F.substring("fragment", 1, 12))), "domain", "head")


def _decided(candidates):
    """Decisions on every proposal, y or n by the length of its pattern, as someone who looks at them would write down."""
    made = K.proposals(candidates).select("domain", "reason", "pattern").distinct()
    return made.withColumn("choice", F.when(F.length("pattern") % 2 == 0, "y").otherwise("n"))


@query
def review_proposals(spark, d):
    return K.proposals(table(spark, d, "boilerplate_candidates")).select("candidate_id", "pattern", "generalized")


@query
def review_flags(spark, d):
    c = table(spark, d, "boilerplate_candidates")
    return K.review(c, _decided(c))[0].select("candidate_id", "reviewed", "discarded", "promoted")


@query
def review_patterns(spark, d):
    c = table(spark, d, "boilerplate_candidates")
    return K.review(c, _decided(c))[1]


# Pages


def _pages(spark, d):
    """Pages made from the documents, and literal ones with page_id below 0 (without a site)."""
    own = made_pages(_docs(spark, d), table(spark, d, "site_overrides"))
    odd = X.frame(spark, [(-i, u, h, None, None) for i, u, h in X.PAGES], "page_id bigint, url string, html string, article_selector string, exclude_selectors array<string>")
    return own.unionByName(odd)


def _dom(spark, d):
    """Elements of the pages made from documents, and literal ones with page_id below 0."""
    rows = [(-p, a, b, up, tag, None, cls, None, None, None, text) for p, a, b, up, tag, cls, text in X.NODES]
    made = D.nodes(made_pages(_docs(spark, d), table(spark, d, "site_overrides")))
    return cut(made.unionByName(X.frame(spark, rows, D.SCHEMA)))  # each selector reads it


@query
def hash_like(spark, d):
    return X.frame(spark, X.TOKENS, "id int, token string").select("id", T.hash_like(F.col("token")).alias("looks_generated"))


@query
def dedupe_nested(spark, d):
    return D.outermost(D.select(_dom(spark, d), "[class*='share']")).select("page_id", "pre", "tag")


@query
def container_rank(spark, d):
    return D.container_rank(_dom(spark, d)).select("page_id", "selector", "n_paras", "total_len")


def _suspects(dom):
    boxes = D.first_matches(D.matches(dom, C.CANDIDATE_CONTAINERS)).select("page_id", "selector", "pre", "post")
    return D.suspects(dom, boxes)


@query
def container_suspects(spark, d):
    return _suspects(_dom(spark, d)).select("page_id", "container", "selector", "pre", "tag")


@query
def common_class_token(spark, d):
    return D.common_class_token(D.matches(_dom(spark, d), C.SUSPECTS), "page_id", "selector").select("page_id", "selector", "n", "token", "stable")


@query
def exclude_selectors(spark, d):
    return D.exclude_selectors(_suspects(_dom(spark, d)), "page_id", "container", "selector").select("page_id", "container", "selector", "exclude")


@query
def pick_container(spark, d):
    return D.pick_container(X.frame(spark, X.RANKED, "page_id int, selector string, place int, total_len int, n_suspects int"))


@query
def inspect_report(spark, d):
    own = made_pages(_docs(spark, d), table(spark, d, "site_overrides"))
    report = D.inspect(cut(D.nodes(own)), own)
    return report.withColumn("exclude_selectors", F.array_join("exclude_selectors", " "))


@query
def page_links(spark, d):
    return D.links(made_pages(_docs(spark, d), table(spark, d, "site_overrides")))


@query
def page_paragraphs(spark, d):
    """What each path of the cascade reads from a page, as counts and digests."""
    got = extract.extracted(made_pages(_docs(spark, d), table(spark, d, "site_overrides")))
    digest = lambda c: F.sha1(F.encode(F.array_join(c, "\n"), "UTF-8"))
    return got.select("page_id", "n_paras", "page_chars", F.size("override").alias("n_override"), digest("override").alias("override"), F.size("fallback").alias("n_fallback"), digest("fallback").alias("fallback"))


@query
def page_articles(spark, d):
    """The whole cascade: the site's selector, the densest element, known containers."""
    got = extract.cascade(made_pages(_docs(spark, d), table(spark, d, "site_overrides")))
    return got.select("page_id", "how", F.length("article").alias("n_chars"), T.content_hash(F.col("article")).alias("content_hash"))


@query
def scraped_corpus(spark, d):
    """From pages to filed articles: extraction, a second try of failed pages, content duplicates, language, both variants."""
    own = made_pages(_docs(spark, d), table(spark, d, "site_overrides"))
    run = pipeline.scrape(own, _languages(spark, d), table(spark, d, "judge_votes"))
    return run.files.select("page_id", "lang_folder", "variant", "filename", F.sha1(F.encode("text", "UTF-8")).alias("digest"))


@query
def scrape_counters(spark, d):
    own = made_pages(_docs(spark, d), table(spark, d, "site_overrides"))
    run = pipeline.scrape(own, _languages(spark, d), table(spark, d, "judge_votes"))
    return run.status.groupBy("status").agg(F.count("*").alias("n"))
