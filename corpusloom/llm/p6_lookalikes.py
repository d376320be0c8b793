"""Problem 6: visually identical text with different characters.

``repair`` brings texts to one form in two stages. The first tells inside the JVM which texts hold any character
that isn't settled, and whether one of them stands in for others (``differs``); all others pass as they are. The second
stage mends the texts in Python: full-width
forms to ASCII, composed accents, plain spaces, no zero-width characters, and script-aware repair of words: the dominant
script of a word is told from its letters, look-alikes of the other scripts are substituted only in mixed-script words,
and only when the result stands in the corpus vocabulary (the unmixed words of all texts, counted whole). Words wholly
of one script, quotes, dashes, superscripts, fractions and emoji stay. ``consistent`` gives the texts of the repair, ``found``
the keys of those that it met in another form, mended or not: a word that the vocabulary doesn't know is a case too.

Null texts stay null and are flagged nothing; empty texts stay empty. Words are pieces between white space.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from ._common import fragments, map_rows, texts

FULL_WIDTH = "\\uff01-\\uff5e"
#: Marks of the general combining blocks; marks of single scripts belong to their words.
MARKS = "\\u0300-\\u036f\\u1ab0-\\u1aff\\u1dc0-\\u1dff\\u20d0-\\u20dc\\u20e1\\u20e5-\\u20f0\\ufe20-\\ufe2f"
ZERO_WIDTH = "\\u180e\\u200b\\u200c\\u200e\\u200f\\u2060-\\u2064\\ufeff"
FIXED_SPACE = "\\u00a0\\u2007\\u202f"
#: A joiner between pictographs is part of an emoji.
JOINER = "(?:\\A|[^\\u2190-\\u2bff\\ufe0f\\x{1f000}-\\x{1faff}])\\u200d|\\u200d(?:\\z|[^\\u2190-\\u2bff\\x{1f000}-\\x{1faff}])"
OTHER = "[\\p{IsCyrillic}\\p{IsGreek}]"
MIXED = f"(?U)(?:\\p{{IsLatin}}\\S*{OTHER}|{OTHER}\\S*\\p{{IsLatin}})"

#: Blocks that hold all Greek and Cyrillic letters, and others; cheaper to test than the scripts.
NEAR_OTHER = "\\u0370-\\u052f\\u1c80-\\u1c8f\\u1d26-\\u1d78\\u1dbf\\u1f00-\\u1fff\\u2126\\u2de0-\\u2dff\\ua640-\\ua69f\\uab65\\ufe2e\\ufe2f\\x{10140}-\\x{101a0}\\x{1d200}-\\x{1d245}\\x{1e030}-\\x{1e08f}"

#: Characters that are no case and that composition leaves alone, the commonest first: Latin, punctuation, currency,
#: arrows and symbols, pictographs.
SETTLED = "\\x00-\\x9f\\u00a1-\\u02ff\\u2010-\\u2027\\u2030-\\u205e\\u20a0-\\u20cf\\u2190-\\u2328\\u232b-\\u2adb\\x{1f000}-\\x{1faff}"

#: Cyrillic and Greek letters and the Latin letters they look like.
LOOKS_LIKE = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝҮүΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυχϲϳк",
        "ABESIJKMHOPCTYXaesijopcyxhdqwYyABEZHIKMNOPTYXaivopuxcjk",
    )
)


def findings(records: DataFrame) -> DataFrame:
    """record_kind, record_id and one boolean per kind of difference. ``records`` has record_kind, record_id, text."""
    t = F.col("text")
    flag = lambda pattern: F.coalesce(t.rlike(pattern), F.lit(False))
    return records.select(
        "record_kind",
        "record_id",
        flag(f"[{FULL_WIDTH}]").alias("full_width"),
        flag(f"[{MARKS}]").alias("marks"),
        flag(f"[{ZERO_WIDTH}]|{JOINER}").alias("zero_width"),
        flag(f"[{FIXED_SPACE}]").alias("fixed_space"),
        flag(MIXED).alias("mixed_script"),
    )


def differs(text: F.Column) -> F.Column:
    """Whether a text is not in its consistent form. One scan passes texts of plain characters only; the rest is looked
    at by kind, the rare ones only where a character of theirs stands."""
    plain = f"[{FULL_WIDTH}{MARKS}{ZERO_WIDTH}{FIXED_SPACE}]"
    mixed = text.rlike(f"[{NEAR_OTHER}]") & text.rlike(OTHER) & text.rlike(MIXED)
    detail = text.rlike(plain) | (text.contains("\u200d") & text.rlike(JOINER)) | mixed
    return F.coalesce(text.rlike(f"[^{SETTLED}]") & detail, F.lit(False))


_full = str.maketrans({chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)})
_zero = re.compile("[᠎​‌‎‏⁠-⁤﻿]|(?<![←-⯿️\U0001f000-\U0001faff])‍|‍(?![←-⯿\U0001f000-\U0001faff])")
_space = re.compile("[   ]")
_odd = re.compile(f"[{FULL_WIDTH}{MARKS}{ZERO_WIDTH}{FIXED_SPACE}\\u200d]")
_latin_like = str.maketrans(LOOKS_LIKE)
_other = re.compile("[Ͱ-ϿЀ-ԯἀ-῿]")
_edge = re.compile(r"^[^\w]+|[^\w]+$")


def script(char: str) -> str:
    if not char.isalpha():
        return ""
    c = ord(char)
    if 0x0370 <= c <= 0x03FF or 0x1F00 <= c <= 0x1FFF:
        return "greek"
    if 0x0400 <= c <= 0x052F:
        return "cyrillic"
    return "latin" if c < 0x0250 or 0x1E00 <= c <= 0x1EFF else "other"


def dominant(word: str) -> tuple[str, bool]:
    """The script of most letters (Latin where tied), and whether Latin and another look-alike script are mixed."""
    count: dict[str, int] = {}
    for c in word:
        if s := script(c):
            count[s] = count.get(s, 0) + 1
    mixed = "latin" in count and bool(count.keys() & {"greek", "cyrillic"})
    return max(count, key=lambda s: (count[s], s == "latin"), default=""), mixed


def simple(text: str) -> str:
    """Everything but the repair of mixed-script words."""
    if text.isascii() or (not _odd.search(text) and unicodedata.is_normalized("NFC", text)):
        return text
    return unicodedata.normalize("NFC", _space.sub(" ", _zero.sub("", text.translate(_full))))


def repaired(word: str) -> str | None:
    """The word with look-alikes brought to its dominant script; None where some letter has no look-alike in it."""
    main, mixed = dominant(word)
    if not mixed:
        return None
    if main == "latin":
        got = word.translate(_latin_like)
        return got if not _other.search(got) else None
    back = {b: a for a, b in reversed(LOOKS_LIKE.items()) if script(a) == main}
    got = "".join(back.get(c, c) if script(c) == "latin" else c for c in word)
    return got if dominant(got)[1] is False else None


def bare(word: str) -> str:
    return _edge.sub("", word).lower()


def repair(records: DataFrame) -> DataFrame:
    """record_kind, record_id, text (in its consistent form), changed, differed (was not in it), of every record."""
    shape = "record_kind string, record_id bigint, text string, changed boolean, differed boolean"
    staged = records.select("record_kind", "record_id", "text", F.coalesce(F.col("text").rlike(f"[^{SETTLED}]"), F.lit(False)).alias("odd"))
    settled = staged.where("not odd").select("record_kind", "record_id", "text", F.lit(False).alias("changed"), F.lit(False).alias("differed"))
    plain = map_rows(staged.where("odd").select("record_kind", "record_id", "text", differs(F.col("text")).alias("differed")), shape + ", doubtful array<string>", _simplify)
    plain = cut(plain)

    def block(rows: dict) -> dict:
        seen: set[str] = set()
        for text in rows["text"]:
            if text:
                seen.update(text.lower().split())
        words = {b for w in seen if (b := _edge.sub("", w)) and not (_other.search(b) and dominant(b)[1])}
        return {"word": list(words)}

    wanted = plain.select(F.explode("doubtful").alias("word")).distinct()
    corrected = map_rows(wanted, "word string, better string, bare string", lambda rows: _corrections(rows["word"]))
    vocabulary = map_rows(settled.select("text").unionByName(plain.select("text")), "word string", block)
    known = corrected.join(vocabulary.distinct(), corrected.bare == vocabulary.word, "left_semi").select("word", "better")
    per = plain.where(F.size("doubtful") > 0).select("record_kind", "record_id", F.explode("doubtful").alias("word")).join(known, "word")
    fixes = per.groupBy("record_kind", "record_id").agg(F.map_from_entries(F.collect_set(F.struct("word", "better"))).alias("fixes"))
    joined = plain.where(F.size("doubtful") > 0).join(fixes, ["record_kind", "record_id"], "left").select("record_kind", "record_id", "text", "changed", "differed", "fixes")
    mended = map_rows(joined, shape, _mend)
    return settled.unionByName(plain.where(F.size("doubtful") == 0).drop("doubtful")).unionByName(mended)


def consistent(records: DataFrame) -> DataFrame:
    """record_kind, record_id, text (in its consistent form), changed, of every record."""
    return repair(records).drop("differed")


def differing(records: DataFrame) -> DataFrame:
    """record_kind, record_id of the texts that the repair met in another form than the consistent one."""
    return repair(records).where("differed").select("record_kind", "record_id")


def _simplify(rows: dict) -> dict:
    out: dict[str, list] = {"record_kind": rows["record_kind"], "record_id": rows["record_id"], "text": [], "changed": [], "differed": rows["differed"], "doubtful": []}
    for text in rows["text"]:
        got = simple(text) if text else text
        out["text"].append(got)
        out["changed"].append(got != text)
        out["doubtful"].append(sorted({w for w in got.split() if _other.search(w) and dominant(w)[1]}) if got and _other.search(got) else [])
    return out


def _corrections(words: list[str]) -> dict:
    pairs = [(w, b) for w in words if (b := repaired(w))]
    return {"word": [w for w, _ in pairs], "better": [b for _, b in pairs], "bare": [bare(b) for _, b in pairs]}


def _mend(rows: dict) -> dict:
    out: dict[str, list] = {"record_kind": rows["record_kind"], "record_id": rows["record_id"], "text": [], "changed": [], "differed": rows["differed"]}
    for text, changed, fixes in zip(rows["text"], rows["changed"], rows["fixes"]):
        fixes = dict(fixes or [])
        got = re.sub(r"\S+", lambda m: fixes.get(m.group(), m.group()), text) if fixes else text
        out["text"].append(got)
        out["changed"].append(changed or got != text)
    return out


def found(documents: DataFrame, candidates: DataFrame) -> DataFrame:
    return differing(texts(documents).unionByName(fragments(candidates))).distinct()
