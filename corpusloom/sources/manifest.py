"""Text-file sources and sinks: the manifest, candidate and dispute logs, article files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CANDIDATE_SCHEMA = "domain string, url string, fragment string, reason string, detected_at string, reviewed boolean, discarded boolean, promoted boolean"
DISPUTE_SCHEMA = "url string, domain string, votes map<string,struct<code:string,confidence:double>>, abstained array<string>, best_guess string, best_guess_share double, logged_at string"


def parse_manifest(lines: DataFrame) -> DataFrame:
    """url, content_hash of manifest lines (column ``value``): tab-separated, the hash may be missing, blanks skipped."""
    parts = F.split(F.rtrim(F.regexp_replace("value", "[\r\n]+$", "")), "\t")
    rows = lines.where(F.trim("value") != "").select(F.trim(F.element_at(parts, 1)).alias("url"), F.trim(F.try_element_at(parts, F.lit(2))).alias("content_hash"))
    return rows.where("url <> ''").withColumn("content_hash", F.when(F.col("content_hash") != "", F.col("content_hash")))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parse_manifest(spark.read.text(path))


def append_manifest(entries: DataFrame, path: str) -> None:
    entries.select(F.concat_ws("\t", "url", F.coalesce("content_hash", F.lit(""))).alias("value")).write.mode("append").text(path)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """The candidate log; corrupt records come out as null rows and are dropped."""
    return spark.read.schema(CANDIDATE_SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").json(path).where("fragment is not null")


def read_disputes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DISPUTE_SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").json(path).where("url is not null")


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


PATTERN_SCHEMA = "pattern string, domain string, reason string, n bigint, example string, approved_at string"


def append_patterns(approved: DataFrame, path: str, approved_at: str) -> None:
    """Approved patterns (of ``candidates.review``) at the end of the pattern table, with what they came from."""
    approved.select("pattern", "domain", "reason", "n", "example", F.lit(approved_at).alias("approved_at")).write.mode("append").json(path)


def read_patterns(spark: SparkSession, path: str) -> list[str]:
    """The approved patterns that compile, each once, in order: people approved them one by one, so they fit the driver."""
    import re

    rows = spark.read.schema(PATTERN_SCHEMA).json(path).where("pattern is not null").groupBy("pattern").agg(F.min("approved_at").alias("at")).orderBy("at", "pattern").collect()
    out = []
    for r in rows:
        try:
            re.compile(r.pattern)
        except re.error:
            continue
        out.append(r.pattern)
    return out


def write_articles(articles: DataFrame, path: str) -> None:
    """Articles (lang_folder, variant, filename, text) as parquet by language and variant."""
    articles.select("lang_folder", "variant", "filename", "text").write.mode("append").partitionBy("lang_folder", "variant").parquet(path)


def clear(spark: SparkSession, path: str, confirmed: bool = False) -> bool:
    """Delete a corpus or log folder. Nothing happens without confirmation."""
    if not confirmed:
        return False
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True))
