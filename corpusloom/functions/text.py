"""Text expressions. Every function takes and gives Columns, so all of it stays in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C

#: What Python's str methods take for white space, spelt out: trimming and translating by a list of characters takes a
#: tenth of the time of a regular expression.
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Unicode classes and case folding, and line ends as line feeds only.
FLAGS = "(?iuUd)"


def escaped(text: str) -> str:
    """A regex that matches the text itself, in Java and RE2 alike."""
    return "".join("\\" + c if c in r"\.^$|?*+()[]{}" else c for c in text)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def spaced(c: Column, blanks: str = BLANKS) -> Column:
    """Every white-space character as a space."""
    return F.translate(c, blanks, " " * len(blanks))


def collapse(c: Column) -> Column:
    return F.regexp_replace(spaced(c), "  +", " ")


def content_hash(c: Column) -> Column:
    """SHA-1 of the stripped, lower-cased text with white space as single spaces; null for null."""
    return F.sha1(F.encode(F.trim(collapse(F.lower(c))), "UTF-8"))


def words(c: Column) -> Column:
    return F.array_remove(F.split(spaced(c), " "), "")


def paragraphs(c: Column) -> Column:
    """Lines of a text; empty array for null."""
    return F.coalesce(F.split(c, "\n"), F.array().cast("array<string>"))


def any_of(patterns: list[str]) -> str | None:
    return f"{FLAGS}(?:{'|'.join(patterns)})" if patterns else None


def matches(c: Column, patterns: list[str]) -> Column:
    """Whether any pattern is found; an empty table matches nothing (never everything)."""
    pattern = any_of(patterns)
    return c.rlike(pattern) if pattern else F.lit(False)


def looks_like_boilerplate(c: Column, extra: list[str] | None = None) -> Column:
    """Whether an active pattern is found in a paragraph, whatever its case.

    Whole-paragraph literals are a set look-up. Each free pattern is searched only where a text that it needs stands,
    and "all of these words" is asked of single lines, as its look-aheads don't go past a line feed.
    """
    anchored = [p for p in C.PATTERNS if p.startswith("^")]
    free = [p for p in C.PATTERNS if not p.startswith("^")]

    def on_line(line: Column) -> Column:
        return reduce(lambda a, w: a & line.rlike(rf"(?U)\b{w}\b"), C.ALL_OF, F.lit(True))

    def covered(low: Column) -> Column:
        found = low.isin([x.lower() for x in C.LITERALS]) | low.rlike(f"(?Ud)^(?:{'|'.join(p[1:] for p in anchored)})")
        for p in free:
            needs = C.NEEDS[p]
            found = found | ((low.rlike(needs[1:]) if needs.startswith("~") else low.contains(needs)) & low.rlike(f"(?Ud){p}"))
        together = reduce(lambda a, w: a & low.contains(w), C.ALL_OF, F.lit(True)) & F.exists(F.split(low, "\n"), on_line)
        return found | together | matches(low, extra) if extra else found | together

    # A lambda over one element binds the lower case once; inside other lambdas it would be computed for every test.
    return F.exists(F.array(F.lower(strip(c))), covered)


def is_end_marker(c: Column) -> Column:
    return matches(strip(c), C.END_MARKERS)


def without_read_more(c: Column) -> Column:
    has_one = F.lower(F.right(strip(c), F.lit(max(map(len, C.READ_MORE))))).rlike("|".join(C.READ_MORE))
    return F.when(has_one, F.regexp_replace(c, rf"{FLAGS}\s*(?:{'|'.join(C.READ_MORE)})\s*$", "")).otherwise(c)


def is_suspicious(c: Column) -> Column:
    """Short, or with a short first or last paragraph, or with many short ones. Null counts as empty: suspicious."""
    lines = F.split(spaced(F.coalesce(c, F.lit("")), BLANKS.replace("\n", "")), "\n")
    sizes = F.array_remove(F.transform(lines, lambda p: F.size(F.array_remove(F.split(p, " "), ""))), 0)
    # Five numbers in one fold: words, paragraphs, short ones, and the first and the last size.
    zero = F.struct(*[F.lit(v).alias(n) for n, v in (("words", 0), ("n", 0), ("short", 0), ("first", 0), ("last", 0))])
    step = lambda a, n: F.struct(
        (a["words"] + n).alias("words"), (a["n"] + 1).alias("n"), (a["short"] + (n <= C.SHORT_WORDS).cast("int")).alias("short"), F.when(a["n"] == 0, n).otherwise(a["first"]).alias("first"), n.alias("last")
    )
    decide = lambda a: (a["words"] < C.MIN_WORDS) | (a["first"] <= C.SHORT_WORDS) | (a["last"] <= C.SHORT_WORDS) | ((a["n"] >= C.MIN_PARAGRAPHS) & (a["short"] / a["n"] >= C.SHORT_SHARE))
    return F.aggregate(sizes, zero, step, decide)


def detection_sample(c: Column) -> Column:
    """Head and tail of a long text around a marker."""
    long = F.length(c) > C.HEAD_CHARS + C.TAIL_CHARS
    return F.when(long, F.concat(F.substring(c, 1, C.HEAD_CHARS), F.lit(C.OMITTED), F.substring(c, -C.TAIL_CHARS, C.TAIL_CHARS))).otherwise(c)


def has_real_content(c: Column) -> Column:
    return c.rlike(r"[\p{L}\p{N}]")


def hash_like(token: Column) -> Column:
    """Class tokens that look generated: a known prefix, or six or more letters and figures with at most one vowel."""
    vowels = F.length(F.regexp_replace(F.lower(token), "[^aeiou]", ""))
    plain = F.regexp_replace(token, "-", "").rlike(r"^[\p{L}\p{N}]+$")
    return token.rlike(r"^(?i:(?:sc|css|emotion|jsx|styled)[-_][a-z0-9]{5,})$") | ((F.length(token) >= 6) & plain & (vowels <= 1))


def openlid_preprocess(c: Column) -> Column:
    """Lower case on one line, without figures and punctuation, spaces squeezed."""
    flat = F.lower(F.translate(strip(c), "\n", " "))
    return F.regexp_replace(F.regexp_replace(flat, r"(?U)[^\w\s]|\d", ""), r"(?U)\s\s+", " ")


def iso_code(label: Column) -> Column:
    """Two-letter code of a model's label such as __label__isl_Latn; unknown three-letter codes stay."""
    base = F.lower(F.regexp_extract(F.regexp_replace(label, "__label__", ""), "^([^_]*)", 1))
    table = F.create_map(*[F.lit(x) for pair in C.ISO3.items() for x in pair])
    return F.coalesce(F.try_element_at(table, base), base)


def is_code(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[a-z]{2}\z"), F.lit(False))


def reduce_or(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
