"""Incremental ingestion: each micro-batch of saved texts is cleaned, compared with the manifest, routed and appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import pipeline

MANIFEST = "url string, content_hash string, batch_id bigint, prefix string"


def known(spark: SparkSession, path: str, hashes: DataFrame, batch_id: int) -> DataFrame:
    """Hashes of earlier batches that ``hashes`` has too. The manifest lies in folders by the first two figures of the
    hash; of these only the ones that the batch needs are read (at most 256 names come to the driver)."""
    needed = [r.prefix for r in hashes.select(F.substring("content_hash", 1, 2).alias("prefix")).distinct().collect()]
    lines = spark.read.schema(MANIFEST).parquet(path).where(F.col("prefix").isin(needed) & (F.col("batch_id") != batch_id))
    return lines.join(hashes.select("content_hash").distinct(), "content_hash", "left_semi").select("content_hash").distinct()


def ingest(spark: SparkSession, source: str, out: str, checkpoint: str, schema: str, files_per_batch: int = 100, route: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Streams parquet files from ``source``; writes articles to ``out``/articles and hashes to ``out``/manifest.

    The manifest grows without bound by design, so it is a table of which each batch reads the folders it needs, not
    stream state. A batch that is run again after a failure overwrites its own folder, so articles and hashes stand once.
    ``route`` adds lang_folder to a batch (such as ``votes.route`` with its tables); without it all go to ``unknown``.
    """
    spark.createDataFrame([], MANIFEST).write.mode("append").partitionBy("prefix").parquet(f"{out}/manifest")

    def write(batch: DataFrame, batch_id: int) -> None:
        good = pipeline.clean(batch).where("article is not null").select("doc_id", "url", "article", "content_hash").persist()
        try:
            firsts = pipeline.first_of_contents(good)
            new = firsts.join(known(batch.sparkSession, f"{out}/manifest", good, batch_id), "content_hash", "left_anti")
            routed = route(new) if route else new.withColumn("lang_folder", F.lit("unknown"))
            routed.select("doc_id", "url", "article", "content_hash", "lang_folder", F.lit(batch_id).cast("bigint").alias("batch_id")).write.mode("overwrite").parquet(f"{out}/articles/part={batch_id}")
        finally:
            good.unpersist()
        written = batch.sparkSession.read.parquet(f"{out}/articles/part={batch_id}")
        lines = written.select("url", "content_hash", "batch_id", F.substring("content_hash", 1, 2).alias("prefix"))
        done = batch.sparkSession.read.schema(MANIFEST).parquet(f"{out}/manifest").where(F.col("batch_id") == batch_id)
        lines.join(done.select("content_hash"), "content_hash", "left_anti").select("url", "content_hash", "batch_id", "prefix").repartition("prefix").write.mode("append").partitionBy("prefix").parquet(f"{out}/manifest")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
