"""Queries over whole tables, and rows that the given tables don't have."""

import re

from corpusloom.functions import constants as C
from corpusloom.functions import text as T
from corpusloom.plans import catalogue, pipeline, sql
from pyspark.sql import functions as F

from .helpers import by_duckdb, by_spark

DATA = "/root/testdata/sf0.001"


def test_reconcile_takes_all_documents(spark):
    whole = "SELECT seq, url FROM scraped_urls WHERE url <> '' AND substr(sha1(url), 1, 8) IN (SELECT substr(sha1(url), 1, 8) FROM documents)"
    odd = "SELECT doc_id FROM documents JOIN scraped_urls USING (url) WHERE doc_id % 2 = 1"
    assert by_duckdb(DATA, odd)[1]
    assert by_spark(catalogue.queries()["manifest_reconcile"](spark, DATA)) == by_duckdb(DATA, whole)


def openlid(text):
    """The same steps in plain Python, over the whole text."""
    return re.sub(r"\s\s+", " ", re.sub(r"[^\w\s]|\d", "", text.strip().replace("\n", " ").lower()))


def test_openlid_preprocess_takes_whole_texts(spark):
    tail = "ord " * 500 + "Slutten, nr. 7!"
    assert len(tail) > 2000 and openlid(tail).endswith("slutten nr ")
    made = spark.createDataFrame([(tail,)], "text string").select(T.openlid_preprocess(F.col("text")).alias("t")).first().t
    assert made == openlid(tail)
    assert by_duckdb(DATA, "SELECT doc_id FROM documents WHERE length(text) > 2000")[1]
    assert "2000" not in sql.oracle_sql()["openlid_preprocess"]


def test_all_44_boilerplate_patterns(spark):
    assert len(C.PATTERNS) + len(C.LITERALS) + 1 == 44 and len({*C.PATTERNS, *C.LITERALS}) == 43
    begins = ["The owner of this website (apnews.com)", "The Guardian\nThe Guardian\nINT Focused", "Sign up to The Week in Patriarchy\n\nGet Arwa", "Privacy Notice: Newsletters may contain", "The Guardian\nThe Guardian\nSign up for the Football Daily"]
    texts = [next((x for x in C.LITERALS if x.startswith(b)), b) for b in begins]
    rows = [*texts, *(f" {t.upper()}\n" for t in texts), *(f"{t} And more." for t in texts)]
    got = [r.b for r in spark.createDataFrame(list(enumerate(rows)), "i int, t string").select("i", T.looks_like_boilerplate(F.col("t")).alias("b")).orderBy("i").collect()]
    assert got == [True] * 10 + [False] * 5


def test_upsert_takes_the_whole_table(spark):
    key = f"lower({sql.strip(chr(39) * 2 + ' || fragment')})"
    whole = f"WITH k AS (SELECT candidate_id, coalesce(domain, '') AS dom, {key} AS key FROM boilerplate_candidates WHERE fragment IS NOT NULL) SELECT min(candidate_id) AS candidate_id FROM k WHERE key <> '' AND (dom, key) NOT IN (('bbc.com', 'contains upsetting scenes.'), ('', 'x')) GROUP BY dom, key"
    assert by_spark(catalogue.queries()["candidate_upsert"](spark, DATA)) == by_duckdb(DATA, whole)


def test_all_words_stand_on_one_line(spark):
    rows = ["Sign up for the newsletter here", "sign up\nfor the newsletter here", "x\nHere: sign up, newsletter\ny", "newsletters: sign up here"]
    got = [r.b for r in spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").orderBy("i").select(T.looks_like_boilerplate(F.col("t")).alias("b")).collect()]
    want = [bool(re.search(r"(?=.*\bnewsletter\b)(?=.*\bsign up\b)(?=.*\bhere\b)", t.strip(), re.IGNORECASE)) for t in rows]
    assert got == want == [True, False, True, False]


def test_guards_are_sound(spark):
    """A pattern searched behind its guard finds what it finds alone."""
    rows = [*("Sími: 515 3000|simi 5|NETFANG: a@b|kt. 120174-3399|kt1201743399|515-3000|x 515 3000 y|515-30000|ALL RIGHTS RESERVED.|Vafrakökur|maak nos jouw voorkeursbron in google|".split("|"))]
    rows += [" ".join(p.replace("\\", "") for p in C.NEEDS), "\u0665\u0661\u0665-\u0663\u0660\u0660\u0660", "simi", "kt. 1", ""]
    got = [r.b for r in spark.createDataFrame(list(enumerate(rows)), "i int, t string").orderBy("i").select(T.looks_like_boilerplate(F.col("t")).alias("b")).collect()]
    assert got == [any(re.search(p, t, re.IGNORECASE) for p in C.PATTERNS) for t in rows] and set(C.NEEDS) == {p for p in C.PATTERNS if not p.startswith("^")}


def test_white_space_as_in_python(spark):
    every = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert sorted(every) == sorted(T.BLANKS)
    rows = [f"{c}a{c}{c}b{c}" for c in every] + ["", " ", "a", "\u200ba\u200b", "  a\n\n b "]
    got = spark.createDataFrame(list(enumerate(rows)), "i int, t string").orderBy("i").select(T.strip(F.col("t")).alias("s"), T.words(F.col("t")).alias("w"), T.collapse(F.col("t")).alias("c")).collect()
    assert [(r.s, r.w, r.c) for r in got] == [(t.strip(), t.split(), re.sub(r"\s+", " ", t)) for t in rows]


def suspicious(text):
    ps = [p for p in (text or "").split("\n") if p.strip()]
    sizes = [len(p.split()) for p in ps]
    if sum(sizes) < 80:
        return True
    return sizes[0] <= 6 or sizes[-1] <= 6 or (len(sizes) >= 3 and sum(s <= 6 for s in sizes) / len(sizes) >= 0.4)


def test_suspicion_is_the_rule_written_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = docs.select("text", T.is_suspicious(F.col("text")).alias("s")).collect()
    assert all(r.s == suspicious(r.text) for r in got) and {r.s for r in got} == {True, False}


def test_articles_stay_whatever_their_urls(spark):
    """Repeated and null urls neither multiply nor lose articles; the first of equal contents stays."""
    body = "The council met on Tuesday to discuss the repair of the long bridge over the river near the old mill. " * 3
    rows = [(1, "https://a.example/x", body + "One."), (2, "https://a.example/x", body + "Two."), (3, None, body + "Three."), (4, None, body.upper() + "ONE."), (5, "", body + "Five."), (6, "https://b.example/", "short"), (7, "https://a.example/y", None), (None, "https://a.example/z", body + "Six."), (1, "https://a.example/x", body + "One.")]
    docs = spark.createDataFrame([(i, u, t, "s", "clash", 1) for i, u, t in rows], "doc_id bigint, url string, text string, source string, lang_folder string, ps int")
    languages = spark.createDataFrame([("a.example", "", "is", True)], "domain string, prefix string, code string, locked boolean")
    votes = spark.createDataFrame([(None, 1, "glotlid", "da", 0.9), ("", 1, "glotlid", "da", 0.9), ("", 2, "openlid", "da", 0.9)], "url string, seq int, judge string, code string, confidence double")
    got = sorted(((r.doc_id, r.lang_folder, r.filename is None) for r in pipeline.corpus(docs, languages, votes).collect()), key=repr)
    assert got == [(1, "is", False), (2, "is", False), (3, "unknown", True), (5, "da", False), (None, "is", False)]
    seen = spark.createDataFrame([(r.content_hash,) for r in pipeline.clean(docs).where("doc_id = 2").collect()], "content_hash string")
    assert 2 not in {r.doc_id for r in pipeline.corpus(docs, languages, votes, seen).collect()}
    assert pipeline.corpus(docs.limit(0), languages.limit(0), votes.limit(0)).count() == 0
