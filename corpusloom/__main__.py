"""Command line: auto (listing pages), url (given addresses), review, clear, delete.

    python -m corpusloom auto --pages PAGES --listings LISTINGS --out OUT
    python -m corpusloom url --pages PAGES --urls FILE --out OUT
    python -m corpusloom review --out OUT --decisions FILE
    python -m corpusloom clear --out OUT --yes
    python -m corpusloom delete --out OUT --yes

Pages are parquet (page_id, url, html and optionally html_later); what fetches them is not part of the engine.
"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import constants as C
from .functions import urls as U
from .operators import candidates as K
from .operators import dom as D
from .plans import pipeline
from .sources import manifest as M

LANGUAGES = "domain string, prefix string, code string, locked boolean"
VOTES = "url string, seq int, judge string, code string, confidence double"


def sites(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(C.SITES, "domain string, article_selector string, exclude_selectors array<string>, listing_path_prefixes array<string>")


def with_sites(pages: DataFrame) -> DataFrame:
    """Pages with their site's selectors; the site table has a row a site, written by hand."""
    own = sites(pages.sparkSession).select(F.col("domain").alias("_domain"), "article_selector", "exclude_selectors")
    return pages.withColumn("_domain", U.domain_key(U.netloc(F.col("url")))).join(F.broadcast(own), "_domain", "left").drop("_domain")


def lines_of(spark: SparkSession, out: str) -> DataFrame:
    """The manifest, empty before the first run."""
    try:
        return M.read_manifest(spark, f"{out}/manifest")
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "url string, content_hash string")


def run(spark: SparkSession, pages: DataFrame, wanted: DataFrame, out: str, votes: DataFrame | None) -> DataFrame:
    """Scrapes the pages of ``wanted`` (url) and files what they give; counts by status."""
    normal = pages.withColumn("_url", U.normalize_url(F.col("url")))
    chosen = normal.join(wanted.select(F.col("url").alias("_url")).distinct(), "_url", "left_semi").drop("url").withColumnRenamed("_url", "url")
    languages = spark.createDataFrame([(*r, True) for r in C.SITE_LANGUAGES], LANGUAGES)
    made = pipeline.scrape(with_sites(chosen), languages, votes if votes is not None else spark.createDataFrame([], VOTES), seen=lines_of(spark, out))
    M.write_articles(made.files, f"{out}/articles")
    M.append_manifest(made.manifest, f"{out}/manifest")
    return made.status.groupBy("status").agg(F.count("*").alias("n"))


def auto(spark: SparkSession, pages: str, listings: str, out: str, votes: DataFrame | None = None) -> DataFrame:
    listed = spark.read.parquet(listings)
    links = D.links(listed).join(listed.select("page_id", U.netloc(F.col("url")).alias("base")), "page_id")
    ordered = links.select("url", "base", (F.col("page_id") * 1_000_000 + F.col("seq")).alias("seq"))
    wanted = pipeline.auto(ordered, lines_of(spark, out), sites(spark).select("domain", "listing_path_prefixes"))
    return run(spark, spark.read.parquet(pages), wanted, out, votes)


def given(spark: SparkSession, pages: str, urls: str, out: str, votes: DataFrame | None = None) -> DataFrame:
    rows = spark.read.text(urls).where(F.trim("value") != "").select(F.trim("value").alias("url"), F.monotonically_increasing_id().alias("seq"))
    return run(spark, spark.read.parquet(pages), pipeline.given(rows), out, votes)


def review(spark: SparkSession, out: str, decisions: str) -> DataFrame:
    """Decisions are JSON lines of domain, reason, pattern, choice. Flags go to candidates-reviewed, patterns to patterns."""
    log = M.read_candidates(spark, f"{out}/candidates").withColumn("candidate_id", F.xxhash64("domain", "url", "fragment", "reason", "detected_at"))
    chosen = spark.read.schema("domain string, reason string, pattern string, choice string").json(decisions)
    flagged, approved = K.review(log, chosen)
    M.append_log(flagged.drop("candidate_id"), f"{out}/candidates-reviewed")
    M.append_patterns(approved, f"{out}/patterns", datetime.now(UTC).strftime("%Y-%m-%d"))
    return approved


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, wants in (("auto", ("pages", "listings", "out")), ("url", ("pages", "urls", "out")), ("review", ("out", "decisions")), ("clear", ("out",)), ("delete", ("out",))):
        one = commands.add_parser(name)
        for w in wants:
            one.add_argument(f"--{w}", required=True)
        if name in ("clear", "delete"):
            one.add_argument("--yes", action="store_true")
    a = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("corpusloom").getOrCreate()
    if a.command == "clear":
        return 0 if all([M.clear(spark, f"{a.out}/{x}", a.yes) for x in ("articles", "manifest")]) else 1
    if a.command == "delete":
        return 0 if M.clear(spark, f"{a.out}/candidates", a.yes) else 1
    if a.command == "review":
        review(spark, a.out, a.decisions).show(truncate=False)
    elif a.command == "auto":
        auto(spark, a.pages, a.listings, a.out).show()
    else:
        given(spark, a.pages, a.urls, a.out).show()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
