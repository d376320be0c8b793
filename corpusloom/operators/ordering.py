"""Ordered de-duplication: keep-first, anti-joins, content duplicates, manifest reconciliation.

Keep-first is a hash aggregate with ``min_by`` (combined before the shuffle, so a hot key costs one row a task),
not a window over the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """One row per non-null ``key``: that of the least ``order``."""
    rest = [c for c in columns if c not in (key, order)]
    first = F.min_by(F.struct(*rest), F.col(order)).alias("_row") if rest else None
    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(order), *([first] if rest else []))
    return grouped.select(key, order, *(f"_row.{c}" for c in rest))


def not_in(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in ``seen``; null keys stay."""
    return df.join(seen.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def content_firsts(df: DataFrame, key: str, content_hash: str, seen: DataFrame | None = None) -> DataFrame:
    """key, content_hash, first_key of each row; is_duplicate where another row came first or ``seen`` has the hash."""
    firsts = df.groupBy(content_hash).agg(F.min(key).alias("first_key"))
    got = df.select(key, content_hash).join(firsts, content_hash)
    duplicate = F.col(key) != F.col("first_key")
    if seen is None:
        return got.withColumn("is_duplicate", duplicate)
    known = seen.select(F.col("content_hash").alias(content_hash)).where(F.col(content_hash).isNotNull()).distinct().withColumn("_known", F.lit(True))
    return got.join(known, content_hash, "left").withColumn("is_duplicate", duplicate | F.coalesce("_known", F.lit(False))).drop("_known")


def reconcile(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest lines some text file stands for: its name holds ``__`` and the first 8 characters of sha1(url).

    Every 8-figure hexadecimal run after ``__`` in a name is a key (overlapping runs too), so the substring search
    becomes an equi-join.
    """
    tails = F.expr("transform(sequence(1, greatest(1, length(name) - 1)), i -> substring(name, i, 10))")
    keys = files.where(F.col("name").endswith(".txt")).select(F.explode(tails).alias("tail")).where(F.col("tail").rlike("^__[0-9a-f]{8}$")).select(F.substring("tail", 3, 8).alias("key")).distinct()
    return manifest.where(F.col("url").isNotNull() & (F.col("url") != "")).withColumn("key", F.substring(F.sha1(F.encode("url", "UTF-8")), 1, 8)).join(keys, "key", "left_semi").drop("key")
