"""Problem 1: page boilerplate mixed with main content.

A standard-library parser streams over each text and every line gets its text length and its number of tags. The ratio
of the two, smoothed with a Gaussian over neighbouring lines, is split by a threshold between its two clusters: the
lines above it are the content regions, all others are boilerplate (``content_regions``). Nothing else removes a line.

An extractor has left few real tags, so those that the page must have had are restored first (``tags_of``): every
word of a line counts as a link where the line is a menu (separators), a control (address, telephone, time, copyright,
the site's own name or host), a short agency credit, a teaser behind a label, or *furniture*, a line whose skeleton
recurs in many documents of its source.

What recurs is learnt from all documents (``learn``): skeletons in at least ``SHARE`` of a source's documents
(``MASKED_SHARE`` where names are masked), labels (furniture that rare short lines follow), the beginnings of headlines
and of subheads, and the site's name. It is bounded by the thresholds, some hundred rows a source. Up to ``TABLE_ROWS``
rows it travels as a broadcast variable; beyond, it is merged with the documents by source and salt (``_merged``), which
gives the same rows.

Null, empty and blank texts have no lines, texts that are cases of problem 4 keep all of theirs. Rows without a source
share one nameless source.
"""

from __future__ import annotations

import math
import operator
import re
import unicodedata
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from ._common import map_rows
from .p4_residue import is_residue
from .p6_lookalikes import _latin_like, _other, simple

#: Longer lines are paragraphs and have no skeleton.
SHORT = 200
SHARE, MASKED_SHARE, LEAST_DOCS = 0.01, 0.02, 3
LABEL_FOLLOWED = 0.6
#: Restored tags a word, characters that count in a line, width of the smoothing, and bounds of the threshold.
TAGS, LONG_ENOUGH, SIGMA, LOW, HIGH = 8, 80, 0.5, 1.5, 2.0
#: Learnt rows that may be broadcast, and parts that each source's documents are split into beyond.
TABLE_ROWS, SALTS = 200_000, 32

DIGITS = re.compile(r"\d+")
SPACES = re.compile(r"\s+")
SEPARATORS = re.compile(r"\s[|/·>»•–]\s|\s{2,}")
CONTROL = re.compile(r"\S@\S+\.\w|\+\d[\d ]{5,}|©|\bhttps?://|\bwww\.|^\W*\d{1,2}\.\d{1,2}\.\d{4}(?:\s+\d{1,2}:\d{2})?\W*$")
TEASER = re.compile(r"\s[›»>→]$|\s\(\d+\)$")
AGENCY = re.compile(r"^\W*[A-Z]{2,5}\W*$|^\W*[A-Za-z]{2,5}\W+[^\W\d]+(?:[ -][^\W\d]+)?\W*$|^[A-Z]{2,5}/\w+$")
ENDS = (".", "!", "?", "…", ".”", ".“", ".»", ".’", '."', "”", "»", ",”")
BULLET = re.compile(r"^[–—•*-]\s")
NUMBER = re.compile(r"^\d+[.)]\s")


class Tags(HTMLParser):
    """Counts the tags of each line from the parser's events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)

    def count(self, text: str) -> Counter:
        self.reset()
        self.found: Counter = Counter()
        self.feed(text)
        self.close()
        return self.found

    def handle_starttag(self, tag, attrs):
        self.found[self.getpos()[0]] += 1

    def handle_endtag(self, tag):
        self.found[self.getpos()[0]] += 1


_tags = Tags()


def plain(line: str) -> str:
    if not line.isascii():
        line = simple(line)
        if _other.search(line):
            line = line.translate(_latin_like)
    return line


def skeleton(line: str) -> str:
    """Folded case, figures as 0, white space and end marks normalised."""
    return SPACES.sub(" ", DIGITS.sub("0", line.casefold())).strip(" .!:›»")


def masked(line: str) -> list[str]:
    """Forms of a line with capitalised words as X: one keeps the first word, and one of short lines masks it too,
    where a second capital makes it likely a name. None where nothing or everything would be masked."""
    words = DIGITS.sub("0", line).split()
    if len(words) < 2 or line.isupper():
        return []
    rest = ["X" + w[-1] * (w[-1] in ",:.") if w[:1].isupper() else w for w in words[1:]]
    out = []
    if any(w[0] == "X" for w in rest):
        out.append(" ".join([words[0].casefold(), *rest]))
        if len(words) <= 6 and rest[0][0] == "X" and words[0][:1].isupper() and any(w[0] != "X" for w in rest):
            out.append(" ".join(["X", *rest]))
    return out


def starts(line: str) -> str:
    """The first two words, figures and what follows a capital inside masked."""
    words = line.casefold().split()[:2]
    return DIGITS.sub("0", " ".join(words))


def fold(text: str) -> str:
    text = text.replace("ð", "d").replace("þ", "th").replace("æ", "ae").replace("ø", "o").replace("å", "a")
    return "".join(c for c in unicodedata.normalize("NFD", text.casefold()) if "a" <= c <= "z")


def within(short: str, long: str) -> bool:
    it = iter(long)
    return all(c in it for c in short)


def site_names(source: str, line: str) -> list[str]:
    """Runs of up to five words of a line that spell the first label of the source's host, with little besides."""
    label = fold(source.split(".")[0])
    low = line.casefold()
    if len(label) < 4 or (label[:4] not in low and label[-4:] not in low):
        return []
    words = line.split()
    out = []
    for i in range(len(words)):
        for j in range(min(len(words), i + 5), i, -1):
            name = " ".join(words[i:j]).strip(".,:;|·–-©")
            folded = fold(name)
            if "." not in name and "@" not in name and folded and len(label) >= 0.66 * len(folded) and within(label, folded) and name[:1].isupper():
                out.append(name)
    if out:
        best = max(out, key=lambda n: (-abs(len(fold(n)) - len(label)), -len(n)))
        return [best]
    return []


def shape(text: str) -> list[tuple[int, str]]:
    """(number, line in consistent characters) of the lines that aren't blank."""
    return [(no, plain(s) if len(s) <= 2 * SHORT else s) for no, x in enumerate(text.split("\n"), 1) if (s := x.strip())]


def is_long(line: str) -> bool:
    return len(line) > SHORT or (len(line) > 110 and line.endswith(ENDS))


def learn(documents: DataFrame) -> DataFrame:
    """source, kind, item, n, m: kinds size, line, masked, headline, subhead, name; m counts where a line acts as label."""

    def block(rows: dict) -> dict:
        count: dict[tuple[str, str, str], list[int]] = {}

        def add(source: str, kind: str, item: str, n: int = 1, k: int = 0) -> None:
            got = count.setdefault((source, kind, item), [0, 0])
            got[0] += n
            got[1] += k

        follows: list[tuple[str, str, str]] = []
        for source, text in zip(rows["source"], rows["text"]):
            source = source or ""
            add(source, "size", "")
            if not text or text.isspace():
                continue
            lines = [x for _, x in shape(text)]
            seen: set[tuple[str, str]] = set()
            long = [is_long(x) for x in lines]
            body = False
            for i, line in enumerate(lines):
                if long[i]:
                    body = True
                    continue
                if len(line) > SHORT:
                    continue
                key = skeleton(line)
                if ("line", key) not in seen:
                    seen.add(("line", key))
                    add(source, "line", key)
                for hidden in masked(line):
                    if ("masked", hidden) not in seen:
                        seen.add(("masked", hidden))
                        add(source, "masked", hidden)
                for name in site_names(source, line):
                    add(source, "name", name)
                if body and len(key) <= 40:
                    after = lines[i + 1] if i + 1 < len(lines) else ""
                    follows.append((source, key, skeleton(after) if after and not long[i + 1] and not after.endswith(".") and len(after.split()) > 3 else ""))
                if body and 0 < i < len(lines) - 1 and long[i - 1] and long[i + 1]:
                    add(source, "subhead", starts(line))
                if not body and i + 1 < len(lines) and long[i + 1]:
                    add(source, "headline", starts(line))
        followed: Counter = Counter()
        for source, key, after in follows:
            add(source, "line", key, 0, 1)
            if after:
                followed[source, key, after] += 1
        keys, pairs = list(count), list(followed)
        return {
            "source": [x[0] for x in [*keys, *pairs]],
            "kind": [k[1] for k in keys] + ["follow"] * len(pairs),
            "item": [k[2] for k in keys] + [p[1] for p in pairs],
            "after": [""] * len(keys) + [p[2] for p in pairs],
            "n": [count[k][0] for k in keys] + [followed[p] for p in pairs],
            "k": [count[k][1] for k in keys] + [0] * len(pairs),
        }

    counted = map_rows(documents.select("source", "text"), "source string, kind string, item string, after string, n bigint, k bigint", block)
    every = cut(counted.groupBy("source", "kind", "item", "after").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).where("n >= 2 or kind in ('size', 'follow')"))
    summed = every.where("kind <> 'follow'").drop("after")
    sizes = summed.where("kind = 'size'").select("source", F.col("n").alias("size"))
    needed = F.greatest(F.when(F.col("kind") == "masked", LEAST_DOCS + 2).otherwise(LEAST_DOCS), F.ceil(F.col("size") * F.when(F.col("kind") == "line", SHARE).when(F.col("kind") == "masked", MASKED_SHARE).otherwise(0.004)))
    kept = summed.where("kind <> 'size'").join(sizes, "source").where(F.col("n") >= needed).drop("size")
    # A follower is rare if it stands in one document or in less than SHARE of the source's. A share, as teasers recur in
    # a large source: the same headline is listed under many articles.
    labels = kept.where("kind = 'line' and k >= 2").select("source", "item")
    recurring = summed.where("kind = 'line'").join(sizes, "source").where(F.col("n") >= F.greatest(F.lit(2), F.ceil(F.col("size") * SHARE))).select("source", F.col("item").alias("after"))
    rare = every.where("kind = 'follow'").join(labels, ["source", "item"], "left_semi").join(recurring, ["source", "after"], "left_anti")
    m = rare.groupBy("source", "item").agg(F.sum("n").alias("m")).withColumn("kind", F.lit("line"))
    return kept.join(m, ["source", "kind", "item"], "left").select("source", "kind", "item", "n", F.coalesce("m", F.lit(0)).cast("bigint").alias("m"), "k")


class Site:
    """What was learnt of one source."""

    def __init__(self) -> None:
        self.lines: dict[str, int] = {}
        self.labels: set[str] = set()
        self.masked: dict[str, int] = {}
        self.headline: dict[str, int] = {}
        self.subhead: dict[str, int] = {}
        self.names: list[tuple[int, str]] = []

    def add(self, kind: str, item: str, n: int, m: int, k: int) -> None:
        if kind == "line":
            self.lines[item] = n
            if k >= 2 and m >= LABEL_FOLLOWED * k and len(item) <= 40:
                self.labels.add(item)
        elif kind == "masked":
            self.masked[item] = n
        elif kind == "name":
            self.names = sorted([*self.names, (n, item)], reverse=True)[:3]
        else:
            getattr(self, kind)[item] = n

    def recurs(self, line: str, key: str) -> bool:
        """Whether a line is furniture by its skeleton, and not one of many lines that begin like headlines."""
        n = max([self.lines.get(key, 0), *(self.masked.get(x, 0) for x in masked(line))])
        begin = starts(line)
        return n > 0 and self.headline.get(begin, 0) + self.subhead.get(begin, 0) < 2 * n

    def is_subhead(self, line: str) -> bool:
        key = starts(line)
        return self.subhead.get(key, 0) > self.headline.get(key, 0)


def sites_of(rows: list) -> dict[str, Site]:
    out: dict[str, Site] = {}
    for source, kind, item, n, m, k in rows:
        out.setdefault(source, Site()).add(kind, item, n, m, k)
    return out


REACH = 2
KERNEL = [math.exp(-0.5 * (d / SIGMA) ** 2) for d in range(-REACH, REACH + 1)]
KERNEL = [k / sum(KERNEL) for k in KERNEL]


def content_regions(lengths: list[int], tags: list[int]) -> list[bool]:
    """True for lines whose smoothed text-to-tag ratio lies above the threshold between its two clusters.

    The ratio is taken as a logarithm, of at most LONG_ENOUGH characters, so that one long paragraph doesn't lift its
    neighbours. The threshold is the middle of the two cluster means (two means, at most eight rounds), kept between
    LOW and HIGH, so that a text of one kind isn't split.
    """
    ratio = [math.log1p(min(n, LONG_ENOUGH) / (1 + t)) for n, t in zip(lengths, tags)]
    padded = [ratio[0]] * REACH + ratio + [ratio[-1]] * REACH
    smooth = [sum(map(operator.mul, KERNEL, padded[i : i + len(KERNEL)])) for i in range(len(ratio))]
    low, high = min(smooth), max(smooth)
    for _ in range(8):
        split = (low + high) / 2
        up, down = [x for x in smooth if x > split], [x for x in smooth if x <= split]
        new = (sum(down) / len(down), sum(up) / len(up)) if up and down else (low, high)
        if new == (low, high):
            break
        low, high = new
    split = min(max((low + high) / 2, LOW), HIGH)
    return [x > split for x in smooth]


def tags_of(shaped: list[tuple[int, str]], text: str, source: str, site: Site) -> list[int]:
    """Tags of each line that isn't blank: those the parser met, and those restored."""
    real = _tags.count(text) if "<" in text else {}
    names = [n.casefold() for _, n in site.names]
    host = source.casefold() if "." in source else None
    lines = [x for _, x in shaped]
    linked, label = [], []
    for line in lines:
        furniture = marked = False
        if len(line) <= SHORT:
            key, low, long = skeleton(line), line.casefold(), is_long(line)
            parts = len(SEPARATORS.findall(line))
            own = next((n for n in names if n in low), None)
            marked = key in site.labels
            furniture = (
                site.recurs(line, key)
                or (not long and (CONTROL.search(line) is not None or (host is not None and host in low)))
                or (parts >= 2 and max(map(len, SEPARATORS.split(line))) <= 30)
                or (own is not None and not long and (parts > 0 or low.startswith(own) or low.endswith(own) or len(line) < 90))
                or TEASER.search(line) is not None
                or (len(line) < 30 and AGENCY.match(line) is not None)
            )
            if not marked and ":" in line and skeleton(line.split(":", 1)[0]) in site.labels:
                furniture = marked = True
        linked.append(furniture)
        label.append(marked)
    # A label and the teasers behind it are a list of links.
    i = 0
    while i < len(lines):
        if label[i] and (i > 0 or linked[i]):
            linked[i] = True
            j = i + 1
            while j < len(lines) and not label[j] and not is_long(lines[j]) and not BULLET.match(lines[j]) and (TEASER.search(lines[j]) if linked[j] else NUMBER.match(lines[j]) or not lines[j].endswith(".")):
                j += 1
            stop = j
            if j < len(lines) and not linked[j] and j - 1 > i and site.is_subhead(lines[j - 1]):
                stop = j - 1
            linked[i + 1 : stop] = [True] * (stop - i - 1)
            i = max(stop, i + 1)
        else:
            i += 1
    return [real.get(no, 0) + (TAGS * len(line.split()) if link else 0) for (no, line), link in zip(shaped, linked)]


def boilerplate(text: str | None, source: str | None, site: Site) -> list[int]:
    """Numbers of the lines that are not part of the article; none in null and blank texts and cases of problem 4."""
    if not text or text.isspace():
        return []
    shaped = shape(text)
    inside = content_regions([len(x) for _, x in shaped], tags_of(shaped, text, source or "", site))
    gone = [no for (no, _), keep in zip(shaped, inside) if not keep]
    return [] if gone and is_residue(text) else gone


def _per_source(documents: DataFrame, schema: str, handle, table_rows: int | None = None) -> DataFrame:
    """Runs ``handle(rows, sites)`` with what was learnt."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text")
    learnt = cut(learn(documents))
    if learnt.count() > (TABLE_ROWS if table_rows is None else table_rows):
        return _merged(docs, learnt, schema, handle)
    shipped = documents.sparkSession.sparkContext.broadcast([tuple(r) for r in learnt.select("source", "kind", "item", "n", "m", "k").toLocalIterator()])
    held: dict = {}

    def block(rows: dict) -> dict:
        if not held:
            held.update(sites_of(shipped.value) or {"": Site()})
        return handle(rows, held)

    return map_rows(docs, schema, block)


def _merged(docs: DataFrame, learnt: DataFrame, schema: str, handle) -> DataFrame:
    """The same for any number of learnt rows: each source's documents are split by a salt, and what was learnt of the
    source is sorted before each part, so a worker holds one source at a time."""
    salted = docs.select(F.coalesce("source", F.lit("")).alias("source"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)).cast("int").alias("salt"), F.lit(None).cast("struct<kind:string,item:string,n:bigint,m:bigint,k:bigint>").alias("learnt"), "doc_id", "text")
    copied = learnt.select("source", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.struct("kind", "item", "n", "m", "k").alias("learnt"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    sorted_ = copied.unionByName(salted).repartition("source", "salt").sortWithinPartitions("source", "salt", F.col("learnt").isNull())
    held: dict = {"of": None, "site": Site()}

    def block(rows: dict) -> dict:
        parts: list[dict] = []
        for source, salt, item, key, text in zip(rows["source"], rows["salt"], rows["learnt"], rows["doc_id"], rows["text"]):
            if held["of"] != (source, salt):
                held.update(of=(source, salt), site=Site())
            if item is not None:
                held["site"].add(*item.values())
            else:
                parts.append(handle({"doc_id": [key], "source": [source], "text": [text]}, {source: held["site"]}))
        return {n: [x for p in parts for x in p[n]] for n in parts[0]} if parts else None

    return map_rows(sorted_, schema, block)


EMPTY = Site()


def boilerplate_lines(documents: DataFrame, table_rows: int | None = None) -> DataFrame:
    """doc_id, line_no of the lines that are not part of the article."""

    def handle(rows: dict, sites: dict[str, Site]) -> dict:
        out: dict[str, list] = {"doc_id": [], "line_no": []}
        for key, source, text in zip(rows["doc_id"], rows["source"], rows["text"]):
            got = boilerplate(text, source, sites.get(source or "", EMPTY))
            out["doc_id"] += [key] * len(got)
            out["line_no"] += got
        return out

    return _per_source(documents, "doc_id bigint, line_no int", handle, table_rows)


def main_content(documents: DataFrame, table_rows: int | None = None) -> DataFrame:
    """doc_id, text (only the main body's lines, byte for byte), n_removed; null texts stay null."""

    def handle(rows: dict, sites: dict[str, Site]) -> dict:
        texts, removed = [], []
        for source, text in zip(rows["source"], rows["text"]):
            gone = set(boilerplate(text, source, sites.get(source or "", EMPTY)))
            texts.append("\n".join(x for no, x in enumerate(text.split("\n"), 1) if no not in gone) if gone else text)
            removed.append(len(gone))
        return {"doc_id": rows["doc_id"], "text": texts, "n_removed": removed}

    return _per_source(documents, "doc_id bigint, text string, n_removed int", handle, table_rows)


def found(documents: DataFrame) -> DataFrame:
    return boilerplate_lines(documents).distinct()
