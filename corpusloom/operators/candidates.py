"""Boilerplate candidates: log upsert, pending counts, groups, suggested patterns and review decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T


def fragment_key() -> Column:
    return F.lower(T.strip(F.coalesce("fragment", F.lit(""))))


def upsert(log: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """Rows of ``new`` with a fragment whose (domain, folded fragment) is not in the log, the first of each by ``order``."""
    keyed = new.withColumn("_key", fragment_key()).where("_key <> ''").withColumn("_domain", F.coalesce("domain", F.lit("")))
    seen = log.select(F.coalesce("domain", F.lit("")).alias("_domain"), fragment_key().alias("_key")).distinct()
    fresh = keyed.join(seen, ["_domain", "_key"], "left_anti")
    firsts = fresh.groupBy("_domain", "_key").agg(F.min_by(F.struct(*new.columns), F.col(order)).alias("r"))
    return firsts.select("r.*")


def pending(candidates: DataFrame, extra: list[str] | None = None) -> Column:
    """Neither reviewed nor discarded nor matched by an active pattern; ``extra`` are patterns approved since."""
    is_set = lambda c: F.coalesce(F.col(c), F.lit(False))
    covered = F.coalesce(T.looks_like_boilerplate(F.col("fragment"), extra), F.lit(False))
    return ~is_set("reviewed") & ~is_set("discarded") & ~covered & F.col("fragment").isNotNull()


def discard_pending(candidates: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Pending rows become reviewed and discarded."""
    mark = candidates.withColumn("_p", pending(candidates, extra))
    return mark.withColumn("reviewed", F.when(F.col("_p"), True).otherwise(F.col("reviewed"))).withColumn("discarded", F.when(F.col("_p"), True).otherwise(F.col("discarded"))).drop("_p")


def common_prefix(a: Column, b: Column) -> Column:
    """Characters that two strings share at their start: the least place where they differ."""
    n = F.least(F.length(a), F.length(b))
    place = F.expr("1")
    differs = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i > n) | (F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))
    return F.substring(a, place, F.coalesce(F.array_min(differs) - 1, n))


def shared_ends(df: DataFrame, *keys: str) -> DataFrame:
    """Per group: prefix and suffix shared by all fragments, told from the least and greatest string (and reversed)."""
    f = df.where(F.col("fragment").isNotNull()).withColumn("_f", T.strip(F.col("fragment")))
    ends = f.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min("_f").alias("lo"), F.max("_f").alias("hi"), F.min(F.reverse("_f")).alias("rlo"), F.max(F.reverse("_f")).alias("rhi"), F.min(F.length("_f")).alias("shortest")
    )
    return ends.select(*keys, "n", "shortest", "lo", common_prefix(F.col("lo"), F.col("hi")).alias("prefix"), F.reverse(common_prefix(F.col("rlo"), F.col("rhi"))).alias("suffix"))


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\.^$|?*+()\[\]{}])", r"\\$1")


def generalized(df: DataFrame, *keys: str) -> DataFrame:
    """Per group of two and more fragments: ``pattern`` from their shared ends, null where too little is shared."""
    e = shared_ends(df, *keys)
    p, s = T.strip(F.col("prefix")), T.strip(F.col("suffix"))
    enough = (F.col("n") >= 2) & (F.length("prefix") + F.length("suffix") < F.col("shortest")) & (F.length(p) >= C.MIN_PREFIX) & (F.length(s) >= C.MIN_SUFFIX)
    enough = enough & T.has_real_content(p) & T.has_real_content(s)
    return e.select(*keys, "n", F.when(enough, F.concat(F.lit("^"), escape(p), F.lit(".+"), escape(s), F.lit("$"))).alias("pattern"))


def literal(c: Column) -> Column:
    return F.concat(F.lit("^"), escape(c), F.lit("$"))


def same(a: str, b: str, *keys: str) -> Column:
    """Equality of all keys of two aliases, nulls being equal."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def suggestions(df: DataFrame, *keys: str) -> DataFrame:
    """Per group: a pattern from shared ends that matches all its fragments, or the literal of the first (least
    candidate_id) if all are the same but for case; no row for other groups. Null keys are a group of their own."""
    rows = df.where(F.col("fragment").isNotNull()).withColumn("_f", T.strip(F.col("fragment")))
    general = generalized(df, *keys).select(*keys, F.col("pattern").alias("_general"))
    both = rows.alias("r").join(general.alias("g"), same("r", "g", *keys)).select("r.*", "_general")
    matched = F.coalesce(F.expr("_f rlike concat('(?iuUd)', _general)"), F.lit(False))
    per = both.groupBy(*keys, "_general").agg(F.min(matched).alias("_all"), F.min(F.lower("_f")).alias("_lo"), F.max(F.lower("_f")).alias("_hi"), F.min_by("_f", "candidate_id").alias("_first"))
    is_general = F.col("_general").isNotNull() & F.col("_all")
    pattern = F.when(is_general, F.col("_general")).when(F.col("_general").isNull() & (F.col("_lo") == F.col("_hi")), literal(F.col("_first")))
    return per.select(*keys, pattern.alias("pattern"), F.coalesce(is_general, F.lit(False)).alias("generalized")).where("pattern is not null")


def literals(df: DataFrame) -> DataFrame:
    """domain, reason, fragment and its literal pattern, each fragment once."""
    f = df.where(F.col("fragment").isNotNull()).select("domain", "reason", T.strip(F.col("fragment")).alias("fragment")).where("fragment <> ''").distinct()
    return f.withColumn("pattern", literal(F.col("fragment")))


def proposals(candidates: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """candidate_id, domain, reason, url, pattern, generalized of every pending candidate: its group's suggestion, or its
    own literal where the group's fragments are too different for one pattern."""
    waiting = candidates.where(pending(candidates, extra)).select("candidate_id", "domain", "reason", "url", "fragment")
    suggested = suggestions(waiting, "domain", "reason").withColumnRenamed("pattern", "_pattern")
    joined = waiting.alias("w").join(suggested.alias("s"), same("w", "s", "domain", "reason"), "left")
    own = literal(T.strip(F.col("w.fragment")))
    return joined.select("w.candidate_id", "w.domain", "w.reason", "w.url", F.coalesce("_pattern", own).alias("pattern"), F.coalesce("generalized", F.lit(False)).alias("generalized"))


def review(candidates: DataFrame, decisions: DataFrame, extra: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Candidates with their flags set by ``decisions`` (domain, reason, pattern, choice y/n), and the patterns approved.

    A decision is about one proposed pattern of a group and marks all pending candidates it was proposed for; what is
    not decided stays pending. The patterns come with the number of their candidates and the least url, for
    ``append_patterns``; given back as ``extra`` they are active in the next step of a run.
    """
    proposed = proposals(candidates, extra)
    wanted = decisions.groupBy("domain", "reason", "pattern").agg(F.max("choice").alias("choice")).where(F.col("choice").isin("y", "n"))
    decided = proposed.alias("p").join(wanted.alias("d"), same("p", "d", "domain", "reason", "pattern")).select("p.*", "choice")
    marks = decided.groupBy("candidate_id").agg(F.max("choice").alias("_choice"))
    joined = candidates.join(marks, "candidate_id", "left")
    hit, yes = F.col("_choice").isNotNull(), F.col("_choice") == "y"
    flagged = joined.withColumn("reviewed", F.when(hit, True).otherwise(F.col("reviewed"))).withColumn("promoted", F.when(hit & yes, True).otherwise(F.col("promoted")))
    patterns = decided.where("choice = 'y'").groupBy("domain", "reason", "pattern", "generalized").agg(F.count("*").alias("n"), F.min(F.when(F.col("url") != "", F.col("url"))).alias("example"))
    return flagged.select(*candidates.columns), patterns


def end_of_run(candidates: DataFrame, choice: str, decisions: DataFrame | None = None) -> DataFrame:
    """What becomes of pending candidates after a run: r reviews them by ``decisions``, d discards them, s or q leaves them."""
    if choice == "r":
        return candidates if decisions is None else review(candidates, decisions)[0]
    return discard_pending(candidates) if choice == "d" else candidates
