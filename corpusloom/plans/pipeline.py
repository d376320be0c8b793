"""The corpus pipeline: one lazy plan from saved texts to routed, named, de-duplicated articles."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import judges
from ..functions import text as T
from ..functions import urls as U
from ..operators import extract, ordering, paragraphs, votes
from ..session import cut


def clean(documents: DataFrame, accept: int = 200) -> DataFrame:
    """doc_id, url, source, article (null where too little is left), content_hash."""
    split = documents.select("doc_id", "url", "source", F.transform(T.paragraphs(F.col("text")), T.strip).alias("ps"))
    made = paragraphs.article(split, "ps", "article", accept=accept)
    return paragraphs.once(made.select("doc_id", "url", "source", "article"), "content_hash", T.content_hash(F.col("article")))


def first_of_contents(good: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """One row of ``good`` (doc_id, content_hash, ...) for each content, that of the least doc_id; none of ``seen``."""
    rest = [c for c in good.columns if c != "content_hash"]
    firsts = good.groupBy("content_hash").agg(F.min_by(F.struct(*rest), F.struct(F.col("doc_id").isNull(), *rest)).alias("_row")).select("content_hash", "_row.*")
    return ordering.not_in(firsts, seen, "content_hash").select(*good.columns) if seen is not None else firsts.select(*good.columns)


def corpus(documents: DataFrame, languages: DataFrame, vote_rows: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """doc_id, filename, lang_folder, n_chars of every article that is new: the first of equal contents, none of ``seen``.

    Each article is one row whatever its url: null urls have a null filename and the folder ``unknown``, repeated urls
    with different contents stay different articles. Articles travel as their hash and length only.
    """
    good = clean(documents).where("article is not null").select("doc_id", "url", F.length("article").alias("n_chars"), "content_hash")
    routed = votes.route(cut(first_of_contents(good, seen)), languages, vote_rows)
    return routed.select("doc_id", U.safe_filename(U.normalize_url(F.col("url"))).alias("filename"), "lang_folder", "n_chars")


class Run(NamedTuple):
    """What a run leaves: ``files`` (page_id, url, lang_folder, variant, filename, text) for the article sink, ``status``
    (page_id, url, status: saved, duplicate, failed; tries) and ``manifest`` (url, content_hash), where duplicates stand too."""

    files: DataFrame
    status: DataFrame
    manifest: DataFrame


def scrape(pages: DataFrame, languages: DataFrame, vote_rows: DataFrame, seen: DataFrame | None = None, again: DataFrame | None = None, general: extract.Extractor | None = None, lemmas=None) -> Run:
    """Pages to filed articles. ``pages`` is as ``extract.extracted`` takes it.

    Pages that give no article are read a second time from ``again`` (the same columns) where it has them; what fails
    twice is ``failed``. The first of equal contents is saved (least page_id), later ones and those of ``seen`` are
    duplicates: not filed, but entered in the manifest. ``lemmas`` (loader by language, see ``judges.lemmatize``) adds
    a second file of each article; False leaves it out.
    """
    def read(from_: DataFrame, tries: int) -> DataFrame:
        made = extract.cascade(from_, general)
        return cut(made.select("page_id", "url", "article", T.content_hash(F.col("article")).alias("content_hash"), F.lit(tries).alias("tries")))

    every = read(pages, 1)
    failed = every.where("article is null").select("page_id", "url")
    if again is not None:
        second = read(again.join(failed.select("page_id"), "page_id", "left_semi"), 2).where("article is not null")
        failed = failed.join(second.select("page_id"), "page_id", "left_anti")
        every = every.unionByName(second)
    good = every.where("article is not null")
    # All that follows is told from keys and hashes; the articles join their place once.
    narrow = good.select("page_id", "url", "tries", "content_hash").distinct()
    heads = narrow.groupBy("content_hash").agg(F.min("page_id").alias("page_id"))
    if seen is not None:
        heads = ordering.not_in(heads, seen, "content_hash")
    heads = cut(heads.select("page_id", "content_hash"))
    marked = narrow.join(heads.withColumn("_saved", F.lit("saved")), ["page_id", "content_hash"], "left")
    status = marked.select("page_id", "url", F.coalesce("_saved", F.lit("duplicate")).alias("status"), "tries").unionByName(failed.select("page_id", "url", F.lit("failed").alias("status"), F.lit(1 if again is None else 2).alias("tries")))
    placed = votes.route(marked.where("_saved is not null").select("page_id", "url").dropDuplicates(["page_id"]), languages, vote_rows).select("page_id", "url", "lang_folder")
    saved = good.select("page_id", "content_hash", F.col("article").alias("text")).join(heads, ["page_id", "content_hash"], "left_semi").drop("content_hash")
    routed = placed.join(saved, "page_id").dropDuplicates(["page_id"]).select("page_id", "url", "text", "lang_folder")
    norm = U.normalize_url(F.col("url"))
    files = routed.withColumn("variant", F.lit("raw")).withColumn("filename", U.safe_filename(norm))
    if lemmas is not False:
        lemmatized = judges.lemmatize(routed, *([lemmas] if lemmas else [])).withColumn("text", F.col("lemmas")).drop("lemmas")
        files = files.unionByName(lemmatized.withColumn("variant", F.lit("lemmatized")).withColumn("filename", U.safe_filename(norm, "lemma")))
    return Run(files, status, narrow.select(norm.alias("url"), "content_hash"))


def auto(listing: DataFrame, manifest: DataFrame, prefixes: DataFrame) -> DataFrame:
    """seq, url: article links of listing pages (url, seq, base), normalised, first ones kept, none of the manifest.

    ``prefixes`` has domain and listing_path_prefixes.
    """
    formed = listing.withColumn("domain", U.domain_key(U.netloc(F.col("url")))).join(prefixes, "domain", "left")
    articles = formed.where(U.looks_like_article(F.col("url"), F.col("base"), F.col("listing_path_prefixes")))
    firsts = ordering.keep_first(articles.withColumn("url", U.normalize_url(F.col("url"))), "url", "seq")
    return ordering.not_in(firsts, manifest, "url").select("seq", "url")


def given(urls: DataFrame) -> DataFrame:
    """seq, url of addresses given by hand: normalised, first ones kept; the manifest is not asked."""
    return ordering.keep_first(urls.withColumn("url", U.normalize_url(F.col("url"))), "url", "seq").select("seq", "url")
