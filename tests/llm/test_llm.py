import random
import re
import unicodedata

import numpy as np
import pytest
from corpusloom.llm import _common as common
from corpusloom.llm import p1_main_content as p1
from corpusloom.llm import p2_near as p2
from corpusloom.llm import p3_language as p3
from corpusloom.llm import p4_residue as p4
from corpusloom.llm import p5_repetition as p5
from corpusloom.llm import p6_lookalikes as p6
from corpusloom.llm import p7_site_lines as p7
from corpusloom.llm import p8_encode as p8
from corpusloom.llm import p9_mix as p9
from corpusloom.llm import p10_spans as p10
from corpusloom.llm import queries as Q
from corpusloom.llm import sql
from corpusloom.llm._common import fragments, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ..helpers import by_duckdb, by_spark

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, url string, fetched_at timestamp, minimiser string, id string, bundle int"
CANDIDATES = "candidate_id bigint, domain string, fragment string, source string"


def docs(spark, rows):
    """Documents from (doc_id, text[, lang[, source]]), with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, None, None, None, "x", "y", 7) for r in rows], DOCS)


def inputs(spark, rows):
    return {
        "documents": docs(spark, rows),
        "boilerplate_candidates": spark.createDataFrame([(i, "www.A.example:80" if i % 2 else None, r[1], "x") for i, r in enumerate(rows)], CANDIDATES),
        "scraped_urls": spark.createDataFrame([(i, None if i % 5 == 0 else "" if i % 5 == 1 else f"https://a.example/{i}") for i, _ in enumerate(rows)], "seq bigint, url string"),
        "language_samples": spark.read.parquet(f"{DATA}/language_samples.parquet"),
        "mix_targets": spark.createDataFrame([("a.example", 0.5, 2), ("b.example", 0.5, 1), ("none.example", None, 3)], "source string, target_share double, max_repeats int"),
    }


ODD_ROWS = [
    (1, None), (2, ""), (3, "   \n \r\n"), (4, "x"), (None, "a row without a key " * 20), (5, "word " * 60_000), (6, "same text here " * 30), (6, "same text here " * 30),
    (7, "a\n" * 3000, "is-IS", "a.example"), (8, "é́‍﻿￿\U0001f600" * 50, "", "b.example"), (9, "<p>\n<b>&amp;" * 100, "xx", ""),
]


@pytest.mark.parametrize("name", sorted(Q.queries()))
@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_odd_and_empty_tables(spark, monkeypatch, name, kind):
    made = inputs(spark, ODD_ROWS if kind == "odd" else [])
    if kind == "empty":
        made = {k: v.limit(0) for k, v in made.items()}
    monkeypatch.setattr(Q, "table", lambda s, d, t: made[t])
    rows = Q.queries()[name](spark, "").collect()
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
    if kind == "odd" and name == "p8_ids":
        assert {r.doc_id: len(r.ids) for r in rows if r.doc_id in (1, 2)} == {1: 0, 2: 0} and len(rows) == len(ODD_ROWS)
    if kind == "odd" and name == "p5_found":
        assert {r.doc_id for r in rows} == {5, 6, 7, 9, None}


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_same_as_sql(spark, name):
    assert by_spark(Q.queries()[name](spark, DATA)) == by_duckdb(DATA, sql.oracle_sql()[name])


def test_main_content(spark):
    rnd = random.Random(3)
    noun, verb = ["council", "harbour", "school", "ferry", "bridge"], ["met", "waits", "closed", "opened", "burned"]

    def sentence():
        return f"The {rnd.choice(noun)} {rnd.choice(verb)} after {rnd.randrange(999)} days and the {rnd.choice(noun)} {rnd.choice(verb)} in spite of {rnd.randrange(999)} protests."

    def name():
        return "".join(rnd.choice("abcdefgh") for _ in range(6))

    rows, gone = [], set()
    for i in range(60):
        lines = ["Home / News / Sport / Contact us", f"The {rnd.choice(noun)} of {name()} {rnd.choice(verb)} for {name()}", f"{rnd.randrange(1, 28)}.05.2026 10:00", *[" ".join(sentence() for _ in range(3)) for _ in range(4)], "Read also", f"The {rnd.choice(noun)} of {name()} {rnd.choice(verb)} with {name()} once more", "All content on harbour-post.example is protected by law."]
        rows.append((i, "\n".join(lines), "en", "harbour-post.example"))
        gone |= {(i, n) for n in (1, 3, 8, 9, 10)}
    found = {tuple(r) for r in p1.found(docs(spark, rows)).collect()}
    assert found == gone
    kept = {r.doc_id: r for r in p1.main_content(docs(spark, rows)).collect()}
    assert kept[0].n_removed == 5 and kept[0].text.split("\n")[0] == rows[0][1].split("\n")[1]
    assert p1.content_regions([5, 5, 300, 280, 4], [3, 2, 0, 0, 2]) == [False, False, True, True, False]
    merged = {tuple(r) for r in p1.boilerplate_lines(docs(spark, rows), table_rows=0).collect()}
    assert merged == gone
    texts_ = sorted(map(tuple, p1.main_content(docs(spark, rows)).collect()))
    assert texts_ == sorted(map(tuple, p1.main_content(docs(spark, rows), table_rows=0).collect()))


def test_regions_decide(monkeypatch):
    """Without the clusters of the smoothed ratio no line goes, and without tags none lies outside."""
    text = "Menu / News / Sport / Contact\nA headline of the day\n" + "The council met on Tuesday to discuss the bridge, said the mayor of the town. " * 4
    assert p1.boilerplate(text, "s", p1.Site()) == [1]
    assert all(p1.content_regions([40, 30, 300, 5, 300], [0] * 5))
    monkeypatch.setattr(p1, "content_regions", lambda lengths, tags: [True] * len(lengths))
    assert p1.boilerplate(text, "s", p1.Site()) == []


def test_merged_tables_are_the_same_on_real_documents(spark):
    given_ = spark.read.parquet(f"{DATA}/documents.parquet")
    shipped, merged = ({tuple(r) for r in p1.boilerplate_lines(given_.repartition(n), table_rows=t).collect()} for n, t in ((1, None), (3, 0)))
    assert shipped == merged and shipped

def near_rows():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(0, 120, 4):
        base = [rnd.choice(words) for _ in range(120)]
        for k, edits in enumerate((0, 0, 4, 12)):
            text = list(base)
            for _ in range(edits):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((i + k, " ".join(text)))
    return rows


def test_near_documents(spark):
    rows = near_rows()
    sets = {i: {tuple(w[j : j + 3]) for j in range(len(w) - 2)} for i, t in rows if len(w := t.split()) >= 40}
    true = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7}
    links, members = p2.document_links(docs(spark, rows))
    got = {tuple(r) for r in p2.expand(links, members).collect()}
    assert got <= true and len(got) >= 0.97 * len(true)
    counts = {r.doc_id: r.n_links for r in p2.link_counts(docs(spark, rows)).collect()}
    assert len(counts) == len(rows) and sum(counts.values()) == 2 * len(got)
    group = {r.doc_id: r.group_id for r in p2.document_groups(docs(spark, rows)).collect()}
    assert all(group[a] == group[b] for a, b in got) and len(set(group.values())) >= 30


def test_near_addresses(spark):
    rows = [(1, "https://www.a.example/news/one-two-three-four?x=1"), (2, "http://a.example/news/one-two-three-four/"), (3, "https://a.example/news/one-two-three-five"), (4, "https://b.example/quite/another-address"), (5, None), (6, ""), (7, "https://www.a.example/news/one-two-three-four?x=1"), (8, "abc")]
    links, members = p2.url_links(spark.createDataFrame(rows, "seq bigint, url string"))
    assert {tuple(r) for r in p2.expand(links, members).collect()} >= {(1, 2)}
    assert {tuple(r) for r in p2.expand(links, members).collect()} <= {(1, 2), (1, 3), (2, 3)}


def test_long_chain_is_one_group(spark):
    links = spark.createDataFrame([(i, i + 1, 1.0) for i in range(40)], "id_a bigint, id_b bigint, similarity double")
    members = spark.createDataFrame([(i, i) for i in range(42)], "class_id bigint, id bigint")
    got = dict(p2.groups(links, members).collect())
    assert {got[i] for i in range(41)} == {0} and got[41] == 41


def test_language(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/language_samples.parquet").select("code", "sample").orderBy("sample_id").collect()]
    held = rows[::5]
    model = p3.train([r for i, r in enumerate(rows) if i % 5])
    scores, _ = p3.Scorer(model).lines([t for _, t in held])
    assert np.mean([model.codes[k] == c for k, (c, _) in zip(scores.argmax(axis=1), held)]) >= 0.95
    assert [p3.label_code(x) for x in ("is-IS", "ISL", "EN", "unknown", "und", None, " ", "disputed", "pt_BR")] == ["is", "is", "en", None, None, None, None, None, "pt"]
    own = {c: [t for k, t in rows if k == c] for c in ("is", "de")}
    text = "\n\n".join([*own["is"][:4], *own["de"][:4]])
    made = p3.detect(docs(spark, [(1, text, "is"), (2, "\n".join(own["de"][:6]), "de-DE"), (3, None, None)]), spark.read.parquet(f"{DATA}/language_samples.parquet")).collect()
    got = sorted((r.doc_id, r.seg_no, r.code) for r in made)
    assert got == [(1, 1, "is"), (1, 2, "de"), (2, 0, "de"), (3, 0, "und")] and all(0 <= r.confidence <= 1 for r in made)


def best_by_force(evidence, switch):
    n, k = evidence.shape
    score = {c: (evidence[0, c], (c,)) for c in range(k)}
    for i in range(1, n):
        score = {c: max((s - switch * (b != c) + evidence[i, c], path + (c,)) for b, (s, path) in score.items()) for c in range(k)}
    return max(score.values())[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.floats(-5, 5), min_size=3, max_size=3), min_size=1, max_size=7))
def test_path_is_the_best(rows):
    evidence = np.array(rows)
    path = p3.best_path(evidence, 3.0)
    got = evidence[np.arange(len(path)), path].sum() - 3.0 * (np.diff(path) != 0).sum()
    assert got == pytest.approx(best_by_force(evidence, 3.0))


def test_residue(spark):
    article = "The council met on Tuesday. It discussed the error message “page not found” for two hours, said a speaker. " * 2
    cases = ["{{ title }}\n{{ body }}", "Headline of the day\n\nPlease enable JavaScript", "404 – Page not found", "Lorem ipsum dolor sit amet consectetur elit.", "TypeError: cannot read properties of undefined (reading 'html') at a1.js:7", "Ｐａｇｅ not found"]
    others = [None, "", " \n", "Short", "Sport", article, f"{article}\nPage not found", "a.example", "1234567890"]
    assert [p4.is_residue(t) for t in cases] == [True] * len(cases) and not any(map(p4.is_residue, others))
    assert {r.record_id for r in p4.residue(texts(docs(spark, list(enumerate([*cases, *others]))))).collect()} == set(range(len(cases)))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=30, max_size=80), st.floats(0.05, 0.95))
def test_rules_reject_no_case(words, least):
    total = len(words) - 4
    share = 1 - len(set(p5.runs(words, 5))) / total
    if share >= least:
        assert not any(rule(words, 5, (1 - least) * total + 1e-9) for rule in p5.RULES.values())


def test_repetition(spark):
    rows = [(1, "one two three four five six " * 10), (2, " ".join(map(str, range(60)))), (3, None), (4, "a b " * 10)]
    assert {r.doc_id for r in p5.found(docs(spark, rows)).collect()} == {1}
    profile = {r.doc_id: r for r in p5.repetition_profile(docs(spark, rows)).collect()}
    assert profile[3].n_words == 0 and profile[2].run5_share == 0 and profile[1].run5_share == pytest.approx(1 - 6 / 56)
    assert p5.order_rules({}) == list(p5.RULES) and p5.order_rules({"first_two": (9, 1.0), "first_word": (1, 1.0)})[0] == "first_two"
    many = [(i, f"{t} " * 3 + " ".join(f"w{i}x{k}" for k in range(40 * (i % 3)))) for i, t in enumerate(["the same line\n", "One. Two. Three four five six. ", "a b c d e f g h "] * 9)]
    profile = {r.doc_id: r for r in p5.repetition_profile(docs(spark, many)).collect()}
    want = {i for i, r in profile.items() if r.n_words >= 30 and any(getattr(r, k) >= v - 1e-12 for k, v in p5.LIMITS.items())}
    assert {r.doc_id for r in p5.repetitive(docs(spark, many)).collect()} == want and 0 < len(want) < len(many)


def test_lookalikes(spark):
    rows = [(1, "Ｈａｒｂｏｕｒ the of"), (2, "étude"), (3, "a​b"), (4, "a b"), (5, "hаrbour the"), (6, "Привет “plain” m² ½ 🚢🌊 👨‍👩"), (7, None), (8, ""), (9, "the harbour Harbour"), (10, "zаqx")]
    got = {r.record_id for r in p6.differing(texts(docs(spark, rows))).collect()}
    assert got == {1, 2, 3, 4, 5, 10}
    made = {r.record_id: r.text for r in p6.consistent(texts(docs(spark, rows))).collect()}
    assert made[1] == "Harbour the of" and made[2] == "étude" and made[3] == "ab" and made[4] == "a b" and made[5] == "harbour the"
    assert made[6] == rows[5][1] and made[7] is None and made[8] == "" and made[10] == "zаqx"
    flags = {r.record_id: r for r in p6.findings(texts(docs(spark, rows))).collect()}
    assert flags[5].mixed_script and not flags[5].marks and not flags[7].mixed_script
    assert p6.differing(fragments(spark.createDataFrame([(1, "d", "ａ", "x")], CANDIDATES))).count() == 1


def test_site_lines(spark):
    rows = [(i, f"Own line {i}\n Share  THIS\r\nBody {i}\n" + ("rare" if i < 3 else ""), None, "a.example") for i in range(40_000, 40_040)] + [(1, "share this\nshare this", None, None)]
    cand = spark.createDataFrame([(1, "WWW.a.example:8080", "share this", "x"), (2, "b.example", "share this", "x"), (3, None, "share this", "x"), (4, "a.example", "share this!", "x")], CANDIDATES)
    got = {tuple(r) for r in p7.found(docs(spark, rows), cand).collect()}
    assert got == {("document", i, 2) for i in range(40_000, 40_040)} | {("candidate", 1, 0)}
    text = {r.doc_id: r for r in p7.without_repeated_lines(docs(spark, rows)).collect()}
    assert text[40_000].text == "Own line 40000\nBody 40000\n" and text[1].n_removed == 0


def test_encoding(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(f"{p8.TOKENIZERS}/{p8.NAME}.json")
    own.encode_special_tokens = True
    odd = ["a  b", " x ", "\n\n a \n", "it's 's 'll !'s <|endoftext|>\t\r\n c", "à la  à", "　 x 日本 語", "🚢 a‍ b", "1 2  3…  ."]
    enc = p8.Encoder(p8.TOKENIZERS, p8.NAME, 5)
    for t in odd + [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").where("text <> ''").select("text").collect()]:
        assert np.frombuffer(enc.encode(t), dtype=np.int32).tolist() == own.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab1'sé à \t\r\n .,!Š日🚢"), min_size=1, max_size=30))
def test_encoding_any_text(text):
    enc = p8.encoder()
    assert np.frombuffer(enc.encode(text), dtype=np.int32).tolist() == enc.bpe.encode_ordinary(text)


def test_mixing(spark):
    rows = [(i, "word " * 20, None, "a.example" if i < 3000 else "b.example") for i in range(4000)]
    targets = spark.createDataFrame([("a.example", 0.5, 3), ("b.example", 0.5, 2), ("c.example", 0.2, 1)], "source string, target_share double, max_repeats int")
    made = {r.source: r for r in p9.report(docs(spark, rows), targets).collect()}
    assert made["b.example"].rate == pytest.approx(2.0) and made["a.example"].rate == pytest.approx(2 / 3)
    assert made["a.example"].actual_share == pytest.approx(0.5, abs=0.03) and made["c.example"].mixed_rows == 0
    got = p9.mix(docs(spark, rows), targets)
    again = p9.mix(docs(spark, rows).repartition(7), targets)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))
    assert got.where("source = 'b.example'").count() == 2000


def test_spans(spark):
    rnd = random.Random(2)
    word = lambda n: "".join(rnd.choice("abcdefghij ") for _ in range(n))
    shared, other = word(400), word(300)
    rows = [(1, word(90) + shared + word(50)), (2, shared[:250]), (3, shared[150:]), (4, word(50) + other), (5, other[:249]), (6, other + "\r\n" + word(20)), (7, None), (8, shared[:125] + "\n" + shared[125:]), (9, word(700)), (10, word(10) + shared[100:350] + "z")]
    windows = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            line = line.removesuffix("\r")
            for j in range(len(line) - 249):
                windows.setdefault(line[j : j + 250], set()).add(i)
    true = {(a, b) for v in windows.values() for a in v for b in v if a < b}
    assert {tuple(r) for r in p10.found(docs(spark, rows)).collect()} == true
    share = {r.doc_id: r.shared_chars for r in p10.shared_share(docs(spark, rows)).collect()}
    for i, t in rows:
        places = set()
        for k, line in enumerate((t or "").split("\n")):
            line = line.removesuffix("\r")
            places |= {(k, j + m) for j in range(len(line) - 249) if len(windows[line[j : j + 250]]) > 1 for m in range(250)}
        assert share[i] == len(places)


def test_copies_of_one_passage(spark):
    text = "".join(random.Random(i).choice("abcdefgh ") for i in range(300))
    rows = [(i, text) for i in range(25)]
    assert p10.found(docs(spark, rows)).count() == 25 * 24 // 2


def test_sliding_minimum():
    x = np.random.default_rng(1).integers(0, 1 << 60, 500).astype(np.uint64)
    for w in (1, 2, 7, 123, 500):
        assert (p10.sliding_min(x, w) == np.array([x[i : i + w].min() for i in range(len(x) - w + 1)])).all()


HELD_OUT = [
    "Oops! That page can't be found.", "The requested URL was not found on this server.", "Sorry, this page isn't available.", "We couldn't find the page you were looking for.", "Hmm, we can't find that page.",
    "This site can't be reached", "HTTP Error 404.0 - Not Found", "You need to enable scripts to view this site.", "You need to enable JavaScript to run this app.", "This website requires JavaScript. Please enable it in your browser settings.",
    "For full functionality of this site it is necessary to enable JavaScript.", "JavaScript seems to be disabled in your browser.", "Sorry, you have been blocked", "You don't have permission to access this resource.", "Error establishing a database connection",
    "There has been a critical error on this website.", "Our systems have detected unusual traffic from your computer network.", "Please verify you are a human", "The page you requested does not exist.", "This content is no longer available.",
    "500 Internal Server Error", "503 Service Temporarily Unavailable", "The connection has timed out", "Uncaught TypeError: x is not a function at main.js:12:5", "java.lang.NullPointerException at com.site.Page.render(Page.java:42)",
    "{title}", "%TITLE%", "[Insert headline here]", "Your text goes here", "Lorem ipsum dolor sit amet",
    "Seite nicht gefunden", "Die angeforderte Seite konnte nicht gefunden werden.", "Bitte aktivieren Sie JavaScript in Ihrem Browser.", "Zugriff verweigert", "Es ist ein Fehler aufgetreten.",
    "Page introuvable", "Désolé, cette page n'existe pas.", "Accès refusé", "Une erreur est survenue", "Veuillez activer JavaScript.",
    "Página no encontrada", "Lo sentimos, la página que buscas no existe.", "Página não encontrada", "Pagina non trovata", "Pagina niet gevonden",
    "Sidan kunde inte hittas", "Siden blev ikke fundet", "Siden finnes ikke", "Síðan fannst ekki", "Strona nie została znaleziona",
]
NO_RESIDUE = [
    "Council not found guilty in bridge case, judge says", "Officials try again to find the missing boats", "Nothing went wrong at the harbour festival this year", "The ferry service is temporarily unavailable on Tuesdays in winter",
    "Active las notificaciones para recibir noticias", "New website for the regional hospital", "45 % of the residents voted, 12% stayed at home", "Error costs team the title", "404 votes for the new school", "Enable notifications", "Accept cookies", "Please log in to comment",
]


def test_wordings_that_no_table_was_made_from():
    """Messages of well-known servers and systems, written down after the phrase tables."""
    assert sum(map(p4.is_residue, HELD_OUT)) >= 0.8 * len(HELD_OUT)
    assert not any(map(p4.is_residue, NO_RESIDUE))


def test_length_of_the_document_counts():
    """Short lines beyond those that may stand beside residue count against it."""
    beside = ["A headline of the day", "By Ann Lee", "Sport"]
    more = ["Weather", "Economy and trade", "Local news", "Opinion of the week"]
    assert p4.is_residue("\n".join([*beside, "Page not found"])) and not p4.is_residue("\n".join([*beside, *more, "Page not found"]))
    assert p4.is_residue("\n".join([*beside, *more[:1], *["{{ title }} {{ body }} {{ intro }}"] * 5]))


def test_hot_first_halves_give_the_same_candidates(spark):
    base = docs(spark, near_rows())
    signed = p2.sign_documents(base).select("id", F.explode("first").alias("bundle"), F.col("second").alias("others"))
    cold, mixed, hot = ({tuple(r) for r in p2.candidates(signed, signed, 1, hot=h).collect()} for h in (10**9, 3, 1))
    assert cold == mixed == hot and cold


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 300), min_size=1, max_size=200), st.sets(st.integers(0, 300), min_size=1, max_size=200))
def test_sketches_are_a_lower_bound(x, y):
    sets = [p2.mix64(np.array(sorted(s), dtype=np.uint64)) for s in (x, y)]
    a, b = (np.frombuffer(k, dtype=np.uint8) for k in p2.parities(np.concatenate(sets), np.array([len(s) for s in sets])))
    assert np.bitwise_count(a ^ b).sum() <= len(x ^ y)


def test_slices_of_a_group_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(common, "SLICE", 7)
    members = spark.createDataFrame([(g, i) for g, n in ((1, 40), (2, 1), (3, 8)) for i in range(n)], "g int, i bigint")
    got = [tuple(r) for r in common.pairs_within(members, "g", "i", "a", "b").collect()]
    assert len(got) == 40 * 39 // 2 + 8 * 7 // 2 and all(a < b for a, b in got)


def test_composition_is_told_by_rule(spark):
    rows = [(1, "e\u0301"), (2, "\u212b"), (3, "\u1100\u1161"), (4, "\u0928\u093c"), (5, "plain é"), (6, "x\u0302")]
    made = {r.record_id: r.text for r in p6.consistent(texts(docs(spark, rows))).collect()}
    assert made == {i: unicodedata.normalize("NFC", t) for i, t in rows}
    spans = [[int(x, 16) for x in re.findall(r"(?:x|u|x\{)([0-9a-f]+)", part)] for part in re.findall(r"\\x?\S+?-\\(?:x\{\w+\}|\w+)", p6.SETTLED)]
    settled = [chr(c) for a, b in spans for c in range(a, b + 1)]
    assert len(spans) == 8 and all(unicodedata.is_normalized("NFC", c) and not unicodedata.combining(c) and not p6._odd.search(c) for c in settled)
    assert all(unicodedata.is_normalized("NFC", f"{a}{b}") for a in "aeé≠" for b in settled)


def test_bitmaps_are_small_and_exact(spark):
    """Spread keys, several spellings of a line, and a line in a twentieth of the documents: at most 4 bytes a bit."""
    rows = [(i * 1_000_003, ("SHARED line" if i % 2 else "shared  line") + f"\nown {i}" if i % 20 == 0 or i % 20 == 1 else f"own {i}", None, "a.example" if i % 3 else "b.example") for i in range(6000)]
    places, bitmaps = p7.repeated_places(docs(spark, rows))
    got = bitmaps.selectExpr("source", "size(docs) as words", "aggregate(docs, 0L, (n, w) -> n + bit_count(w.bits)) as bits", "n_docs").collect()
    true = {s: sum(1 for r in rows if r[3] == s and "shared" in r[1].lower()) for s in ("a.example", "b.example")}
    assert {r.source: r.n_docs for r in got} == true and all(10 * r.words <= 4 * r.bits for r in got)
    gone, _ = p7.deletable(docs(spark, rows))
    assert {(r.doc_id, r.line_no) for r in gone.collect()} == {(r[0], 1) for r in rows if "shared" in r[1].lower()}


def test_training_needs_few_landmarks_and_little_memory():
    import tracemalloc

    rnd = random.Random(1)
    letters = {c: "".join(rnd.sample("abcdefghijklmnopqrstuvwxyzáéíóúæøåß", 14)) for c in ("aa", "bb", "cc")}
    samples = [(c, " ".join("".join(rnd.choice(own) for _ in range(6)) for _ in range(9)) + f" {i}") for c, own in letters.items() for i in range(700)]
    tracemalloc.start()
    model = p3.train(samples, 60)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    scores, _ = p3.Scorer(model).lines([t for _, t in samples[::50]])
    assert np.mean([model.codes[k] == c for k, (c, _) in zip(scores.argmax(axis=1), samples[::50])]) >= 0.95


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("日本語漢字かなカナ한국어ไทยé'sñ 。、a1"), min_size=60, max_size=400))
def test_encoding_of_unspaced_scripts(text):
    enc = p8.encoder()
    assert np.frombuffer(enc.encode(text), dtype=np.int32).tolist() == enc.bpe.encode_ordinary(text)


def test_long_unspaced_text_is_cut():
    rnd = random.Random(4)
    text = "".join(chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(5000))
    enc = p8.encoder()
    parts = enc.fragments(text)
    assert "".join(parts) == text and max(map(len, parts)) < 1000 and len(parts) > 20
    assert np.frombuffer(enc.encode(text), dtype=np.int32).tolist() == enc.bpe.encode_ordinary(text)


def test_mixture_with_texts(spark):
    rows = [(i, f"word {i} " * 20, None, "a.example" if i % 3 else "b.example") for i in range(300)] + [(None, f"keyless {i}", None, "a.example") for i in range(200)]
    targets = spark.createDataFrame([("a.example", 0.5, 3), ("b.example", 0.5, 2)], "source string, target_share double, max_repeats int")
    keys = sorted(((r.doc_id, r.source, r.copy) for r in p9.mix(docs(spark, rows), targets).collect()), key=repr)
    texts_ = p9.mixed_texts(docs(spark, rows), targets).collect()
    assert keys == sorted(((r.doc_id, r.source, r.copy) for r in texts_), key=repr)
    assert 0 < sum(r.doc_id is None for r in texts_) and len({r.text for r in texts_ if r.doc_id is None}) > 1


def test_passages_say_what_pairs_say(spark):
    rnd = random.Random(6)
    shared = ["".join(rnd.choice("abcdefgh ") for _ in range(300)) for _ in range(3)]
    rows = [(i, "\n".join([shared[k] for k in range(3) if (i >> k) & 1] + [f"own {i}"])) for i in range(16)]
    of = {}
    for r in p10.passages(docs(spark, rows)).collect():
        of.setdefault(r.passage, set()).add(r.doc_id)
    pairs = {(a, b) for s in of.values() for a in s for b in s if a < b}
    assert pairs == {tuple(r) for r in p10.found(docs(spark, rows)).collect()} == {(a, b) for a in range(16) for b in range(16) if a < b and a & b & 7}
