"""The language panel: weighted votes, verdicts, tiebreaks, disputes and routing.

Votes are rows (url, seq, judge, code, confidence). A judge votes once per url (its least seq); a null code or
confidence abstains; judges without a weight don't count. Everything is two hash aggregates per url.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C


def weight(judge: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in C.JUDGE_WEIGHTS.items() for x in pair])
    return F.try_element_at(table, judge)


def valid(votes: DataFrame) -> DataFrame:
    """One vote per url and judge, abstentions left out."""
    cast = votes.where(F.col("url").isNotNull() & F.col("code").isNotNull() & F.col("confidence").isNotNull() & weight(F.col("judge")).isNotNull())
    first = F.min_by(F.struct("code", "confidence"), F.struct("seq", "code", "confidence"))
    return cast.groupBy("url", "judge").agg(F.min("seq").alias("seq"), first.alias("v")).select("url", "seq", "judge", "v.code", "v.confidence")


def resolve(votes: DataFrame, strict: bool = False) -> DataFrame:
    """url, winner_code, winner_share, n_votes, disputed. The heaviest code wins, of equal ones the first voted.

    ``strict`` also disputes a winner with fewer than two judges of its own.
    """
    per_code = votes.groupBy("url", "code").agg(F.sum(weight(F.col("judge")) * F.col("confidence")).alias("w"), F.min("seq").alias("seq"), F.count("*").alias("n"))
    best = F.max_by(F.struct("code", "n"), F.struct(F.round("w", 9), -F.col("seq"))).alias("best")
    per_url = per_code.groupBy("url").agg(best, F.max("w").alias("top"), F.sum("w").alias("total"), F.sum("n").alias("n_votes"))
    share = F.when(F.col("total") > 0, F.col("top") / F.col("total")).otherwise(F.lit(0.0))
    disputed = (F.col("n_votes") < C.MIN_JUDGES) | (share < C.CONSENSUS_SHARE)
    if strict:
        disputed = disputed | (F.col("best.n") < C.MIN_JUDGES)
    return per_url.select("url", F.col("best.code").alias("winner_code"), share.alias("winner_share"), "n_votes", disputed.alias("disputed"))


def panel(votes: DataFrame) -> DataFrame:
    """The votes of the local judges, and of the site hint where a judge voted."""
    local = votes.where(F.col("judge").isin(C.LOCAL_JUDGES))
    hints = votes.where(F.col("judge") == "site_hint").join(local.select("url").distinct(), "url", "left_semi")
    return local.unionByName(hints)


def verdicts(urls: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row per url: without votes ``unknown`` and not disputed, disputed without a code of its own."""
    joined = urls.join(resolved, "url", "left")
    code = F.when(F.col("winner_code").isNull(), "unknown").when(F.col("disputed"), "disputed").otherwise(F.col("winner_code"))
    return joined.select("url", code.alias("code"), F.coalesce("disputed", F.lit(False)).alias("disputed"), "winner_code", F.coalesce("winner_share", F.lit(0.0)).alias("winner_share"))


def tiebreak(votes: DataFrame, extra: DataFrame) -> DataFrame:
    """Disputed urls again, with one more vote ("gemini") where ``extra`` (url, code, confidence) has one; others unchanged."""
    base = cut_panel = panel(valid(votes))
    disputed = resolve(cut_panel).where("disputed").select("url")
    last = base.groupBy("url").agg((F.max("seq") + 1).alias("seq"))
    added = extra.join(disputed, "url", "left_semi").join(last, "url").select("url", "seq", F.lit("gemini").alias("judge"), "code", "confidence")
    return resolve(base.unionByName(added))


def route(documents: DataFrame, languages: DataFrame, votes: DataFrame) -> DataFrame:
    """The rows of ``documents`` with lang_folder and how. A locked site's code is taken without asking the panel.

    The site is that of the row's own url; rows without one have no site and no votes (``unknown``). Rows aren't joined
    by url with each other, so repeated urls stay as many rows as they are. ``languages`` has domain, prefix, code,
    locked; of several prefixes the longest wins.
    """
    from ..functions import urls as U

    sites = languages.where(F.col("domain").isNotNull()).groupBy("domain").agg(F.max("locked").alias("_locked"), F.collect_list(F.struct("prefix", "code")).alias("_codes")).withColumnRenamed("domain", "_domain")
    at = documents.withColumn("_domain", U.domain_key(U.netloc(F.col("url")))).join(sites, "_domain", "left")
    fitting = F.filter("_codes", lambda x: F.startswith(U.path(F.col("url")), x["prefix"]))
    longest = F.aggregate(fitting, F.lit(None).cast("struct<prefix:string,code:string>"), lambda a, x: F.when(a.isNull() | (F.length(x["prefix"]) > F.length(a["prefix"])), x).otherwise(a))
    known = at.withColumn("_expected", longest["code"])
    known = known.withColumn("_fixed", F.coalesce(F.col("_locked") & F.col("_expected").isNotNull(), F.lit(False)))
    asked = known.where(~F.col("_fixed") & F.col("url").isNotNull()).select("url").distinct()
    judged = resolve(panel(valid(votes)).join(asked, "url", "left_semi")).select("url", F.col("winner_code").alias("_code"), F.col("disputed").alias("_disputed"))
    joined = known.join(judged, "url", "left")
    disputed = F.coalesce("_disputed", F.lit(False))
    folder = F.when(F.col("_fixed"), F.col("_expected")).when(F.col("_code").isNull(), "unknown").when(disputed, "disputed").otherwise(F.col("_code"))
    how = F.when(F.col("_fixed"), "locked").when(disputed, "disputed").otherwise("panel")
    return joined.select(*documents.columns, folder.alias("lang_folder"), how.alias("how"))


def disputes(votes: DataFrame, logged: DataFrame) -> DataFrame:
    """Disputed urls that the log hasn't: url, n_votes, abstained, best_guess, best_guess_share (three figures)."""
    cast = panel(valid(votes))
    who = cast.groupBy("url").agg(F.array_sort(F.collect_set("judge")).alias("judges"))
    new = resolve(cast).where("disputed").join(logged.select("url").distinct(), "url", "left_anti")
    local = F.array(*[F.lit(j) for j in C.LOCAL_JUDGES])
    return new.join(who, "url").select("url", "n_votes", F.array_join(F.array_except(local, "judges"), ",").alias("abstained"), F.col("winner_code").alias("best_guess"), F.bround("winner_share", 3).alias("best_guess_share"))
