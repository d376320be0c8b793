"""Operations on arrays of paragraphs, each linear in their number, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T


def truncated(ps: Column) -> Column:
    """The paragraphs before the first end marker."""
    at = F.array_position(F.transform(ps, T.is_end_marker), True)
    return F.when(at > 0, F.slice(ps, F.lit(1), (at - 1).cast("int"))).otherwise(ps)


def without_trailing_fragment(ps: Column) -> Column:
    """Without bare headings at the end; the first paragraph always stays."""
    keeps = F.transform(ps, lambda p: _keeper(T.strip(p)))
    last = F.array_max(F.transform(keeps, lambda k, i: F.when(k, i + 1).otherwise(F.lit(0))))
    return F.when(F.size(ps) == 0, ps).otherwise(F.slice(ps, F.lit(1), F.greatest(F.lit(1), last)))


def _keeper(p: Column) -> Column:
    return (p == "") | (F.length(p) > 60) | F.lit(C.SENTENCE_ENDS).contains(F.right(p, F.lit(1)))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is evaluated once a row: the optimiser neither merges it into its uses nor pushes filters below."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def dedupe_consecutive(df: DataFrame, ps: str, out: str) -> DataFrame:
    """Adjacent repeats go, and a teaser before its full text is replaced by it.

    The last paragraph kept always equals, stripped, the previous one read, so each paragraph is told from its
    neighbour: 0 repeats it, 2 replaces the teaser, 1 is new. Of 1 and 2 those stay that no 2 follows. Neighbours are
    paired by zipping the array with itself moved by one: a lambda that looks other places up would be evaluated anew
    for each place.
    """
    c = F.col(ps)
    pairs = F.arrays_zip(c.alias("p"), F.concat(F.array(F.lit(None).cast("string")), F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0)))).alias("q"))
    read = once(df, "_read", F.filter(F.transform(F.slice(pairs, F.lit(1), F.greatest(F.size(c), F.lit(1))), lambda z: F.struct(z["p"].alias("p"), _kind(z["p"], z["q"]).alias("k"))), lambda x: x["k"] != 0))
    r = F.col("_read")
    follows = F.arrays_zip(r.alias("now"), F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))).alias("next"))
    kept = F.filter(follows, lambda z: F.coalesce(z["next"]["k"], F.lit(1)) == 1)
    return once(read, out, F.when(F.size(c) == 0, c).otherwise(F.transform(kept, lambda z: z["now"]["p"]))).drop("_read")


def _kind(p: Column, before: Column) -> Column:
    now, last = T.strip(p), T.strip(before)
    short = T.strip(T.without_read_more(last))
    return F.when(before.isNull(), 1).when(now == last, 0).when((short != "") & (short == now), 2).otherwise(1)


def filtered(ps: Column, min_chars: int = 0, extra: list[str] | None = None) -> Column:
    return F.filter(ps, lambda p: (F.length(p) >= min_chars) & ~T.looks_like_boilerplate(p, extra))


def article(df: DataFrame, ps: str, out: str, filter_first: bool = False, min_chars: int = 20, accept: int = 200) -> DataFrame:
    """The cleaning cascade of one extraction path: joined text, null where at most ``accept`` characters are left.

    Site containers and the general extractor filter last, the container fallback filters first.
    """
    start = F.filter(F.col(ps), lambda p: F.length(T.strip(p)) >= min_chars)
    first = once(df, "_start", filtered(start) if filter_first else start)
    flagged = once(first, "_before", truncated(F.col("_start")))
    cut = once(flagged, "_cut", F.when(F.size("_before") < F.size("_start"), without_trailing_fragment(F.col("_before"))).otherwise(F.col("_start")))
    single = dedupe_consecutive(cut, "_cut", "_single")
    text = once(single, "_text", F.array_join(F.col("_single") if filter_first else filtered(F.col("_single")), "\n\n"))
    return text.withColumn(out, F.when(F.length("_text") > accept, F.col("_text"))).drop("_start", "_before", "_cut", "_single", "_text")
