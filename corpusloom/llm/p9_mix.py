"""Problem 9: mixing sources to target weights.

Tokens are summed per source (a public tokenizer, problem 8's encoder), repetition rates follow from them, and
each document is emitted floor(rate) times plus one more time if its hash-seeded uniform number lies below the
fraction of the rate: no shuffle of the documents, the same result on every run and every partitioning.

The total is the largest that meets every target share without taking a source more often than its
``max_repeats`` (or ``total_tokens``, where rates above the cap are cut to it and the report shows the miss).
Sources without a target or with a null one get rate 0; a target without tokens is left out of the total's
bound and reported with no tokens; shares are taken relative to the sum of the usable ones. Null and empty
texts have 0 tokens and are emitted at their source's rate like any other row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import p8_encode as encode

SEED = 20260101


def rates(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """source, target_share, max_repeats, tokens, rate. ``sized`` has source and n_tokens."""
    per = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    wanted = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    joined = wanted.join(per, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    usable = (F.col("tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    weights = joined.agg(F.sum(F.when(usable, F.col("target_share"))).alias("weight"))
    known = joined.crossJoin(F.broadcast(weights))  # one row
    share = F.col("target_share") / F.col("weight")
    bound = known.agg(F.min(F.when(usable, F.col("max_repeats") * F.col("tokens") / share)).alias("bound"))  # one row
    total = F.lit(float(total_tokens)) if total_tokens is not None else F.col("bound")
    rate = F.when(usable, F.least(F.col("max_repeats").cast("double"), total * share / F.col("tokens"))).otherwise(F.lit(0.0))
    return known.crossJoin(F.broadcast(bound)).select("source", "target_share", "max_repeats", "tokens", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def uniform(key: str, seed: int) -> F.Column:
    """In [0, 1), from the key and the seed only."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 11).cast("double") / F.lit(float(1 << 53))


def copies(sized: DataFrame, rate_table: DataFrame, key: str = "coin", seed: int = SEED) -> DataFrame:
    """Each row of ``sized`` as often as it is taken, numbered by ``copy`` from 1. One rate row per source.

    The rates are broadcast: they have a row per row of the targets, which the caller wrote down, and documents of a
    source that holds a third of all rows are never shuffled by it.
    """
    joined = sized.join(F.broadcast(rate_table.select("source", "rate")), "source")
    times = (F.floor("rate") + F.when(uniform(key, seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")
    return joined.withColumn("times", times).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times", "rate")


def with_coin(documents: DataFrame) -> DataFrame:
    """doc_id, source, text, coin: what the random copy is drawn by, the key or, where it is null, the text."""
    key = F.col("doc_id").cast("bigint")
    return documents.select(key.alias("doc_id"), "source", "text", F.coalesce(key, F.xxhash64("text")).alias("coin"))


def sized(documents: DataFrame, **tokenizer) -> DataFrame:
    return encode.count_tokens(with_coin(documents), ["doc_id", "source", "coin"], **tokenizer)


def mixed_texts(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, source, text, copy: the mixture itself, read from the documents a second time once the rates are known."""
    table = cut(rates(sized(documents), targets, total_tokens))
    return copies(with_coin(documents), table, seed=seed).select("doc_id", "source", "text", "copy")


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, source, n_tokens, copy of every copy that the mixture holds."""
    counted = cut(sized(documents))
    return copies(counted, rates(counted, targets, total_tokens), seed=seed).select("doc_id", "source", "n_tokens", "copy")


def report(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = SEED) -> DataFrame:
    """Per target: its share, tokens before and after, rate, documents taken and the share reached."""
    counted = cut(sized(documents))
    table = rates(counted, targets, total_tokens)
    taken = copies(counted, table, seed=seed).groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.count("*").alias("mixed_rows"))
    joined = table.join(taken, "source", "left").na.fill(0, ["mixed_tokens", "mixed_rows"])
    whole = joined.agg(F.sum("mixed_tokens").alias("all_tokens"))  # one row
    return joined.crossJoin(F.broadcast(whole)).select("source", "target_share", "max_repeats", "tokens", "rate", "mixed_rows", "mixed_tokens", F.when(F.col("all_tokens") > 0, F.col("mixed_tokens") / F.col("all_tokens")).otherwise(F.lit(0.0)).alias("actual_share"))
