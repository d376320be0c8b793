import hashlib
import os
import random

import pytest
from corpusloom.functions import constants as C
from corpusloom.functions import text as T
from corpusloom.functions import urls as U
from corpusloom.operators import candidates as K
from corpusloom.operators import dom as D
from corpusloom.operators import extract as E
from corpusloom.operators import paragraphs as P
from corpusloom.operators import replies as R
from corpusloom.operators import votes as V
from corpusloom.plans import catalogue, pipeline, sql
from corpusloom.plans import fixtures as X
from corpusloom.sources import manifest as M
from corpusloom.streaming.ingest import ingest
from pyspark.sql import functions as F

from .helpers import by_duckdb, by_spark

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_same_as_sql(spark, name):
    assert by_spark(catalogue.queries()[name](spark, DATA)) == by_duckdb(DATA, sql.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(sql.oracle_sql())))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, DATA).count() >= 0


def values(spark, rows, schema, *cols):
    return [tuple(r) if len(cols) > 1 else r[0] for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_urls(spark):
    got = {r.seq: r for r in spark.createDataFrame(X.URLS, "seq int, url string, base string").select("seq", U.normalize_url(F.col("url")).alias("n"), U.safe_filename(U.normalize_url(F.col("url"))).alias("f")).collect()}
    assert got[1].n == "https://www.ruv.is/frettir/some-slug-2026" and got[1].f == "ruv.is__some-slug-2026__4657ec88.txt"
    assert got[11].n == "https://example.com/x/y" and got[11].f == "example.com__y__26ae85f5.txt"
    assert got[12].f == "example.com__index__327c3fda.txt" and got[10].f == "Example.com__a-b-c-d__22dd19b4.txt"
    assert got[18].n is None


def test_articles(spark):
    prefixes = {d: p for d, _, _, p in C.SITES}
    rows = [(i, u, b, prefixes.get((u or "").split("/")[2].replace("www.", "") if u and "//" in u else "", [])) for i, u, b in X.URLS]
    got = values(spark, rows, "i int, u string, b string, p array<string>", U.looks_like_article(F.col("u"), F.col("b"), F.col("p")))
    assert got[:13] == [True, True, False, False, True, False, False, False, False, False, False, False, True] and got[13:15] == [True, False] and got[17] is False


def test_hash(spark):
    a, b, c = values(spark, [("  Hello   World\n",), ("hello world",), (None,)], "t string", T.content_hash(F.col("t")))
    assert a == b == "2aae6c35c94fcfb415dbe95f408b9ce91ee846ed" and c is None


def test_suspicion(spark):
    long = " ".join(["word"] * 50)
    texts = [" ".join(["w"] * 79), " ".join(["w"] * 80), f"{long}\n{long}\nFollow us", f"{long}\n{long}", f"{long}\na b\nc d\n{long}\n{long}", f"{long}\na b\n{long}\n{long}", None, ""]
    assert values(spark, [(t,) for t in texts], "t string", T.is_suspicious(F.col("t"))) == [True, False, True, False, True, False, True, True]


def test_boilerplate(spark):
    rows = ["SÍMI: 515-3000", "Efstaleiti 1, 103 Reykjavík", "Sign up here for our Newsletter", "We sign up here", "page non trouvée", "", None]
    assert values(spark, [(t,) for t in rows], "t string", T.looks_like_boilerplate(F.col("t"))) == [True, True, True, False, True, False, None]
    assert values(spark, [("x",)], "t string", T.matches(F.col("t"), [])) == [False]


def fold(paragraphs):
    out = []
    for p in paragraphs:
        short = None
        if out:
            last = out[-1].strip()
            if p.strip() == last:
                continue
            short = next((last[: -len(m)].strip() for m in C.READ_MORE if last.lower().endswith(m)), last)
            if short and short == p.strip():
                out[-1] = p
                continue
        out.append(p)
    return out


def test_dedupe_is_the_fold(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.choice(["A", "B", "A vis mere", " A ", "B lees meer", "", "vis mer"]) for _ in range(rnd.randrange(0, 9))]) for i in range(400)]
    got = dict(P.dedupe_consecutive(spark.createDataFrame(rows, "i int, ps array<string>"), "ps", "out").select("i", "out").collect())
    assert all(got[i] == fold(ps) for i, ps in rows)


def test_cascade(spark):
    long = "A sentence that is long enough to be kept in the article of this page."
    rows = [(1, ["Head", long, long, "så arbetar vi ", "junk"]), (2, []), (3, ["© x"])]
    got = dict(P.article(spark.createDataFrame(rows, "i int, ps array<string>"), "ps", "a", accept=10, min_chars=4).select("i", "a").collect())
    assert got == {1: f"Head\n\n{long}", 2: None, 3: None}


def test_votes(spark):
    rows = [
        ("v1", 0, "glotlid", "is", 0.9), ("v1", 1, "openlid", "is", 0.8), ("v1", 2, "lingua", "nb", 0.7),
        ("v2", 0, "glotlid", "en", 0.99), ("v2", 1, "lingua", "cy", 0.3), ("v3", 0, "glotlid", "kl", 0.95),
        ("v4", 0, "glotlid", "da", 0.5), ("v4", 1, "openlid", "nb", 0.5), ("v6", 0, "glotlid", "en", 0.9), ("v6", 1, "site_hint", "is", 0.65),
        ("v7", 0, "lingua", "nb", 0.6), ("v7", 1, "site_hint", "is", 0.65), ("v9", 0, "site_hint", "is", 0.65), ("v9", 1, "x", "is", None), ("v4", 1, "openlid", "nb", 0.5),
    ]
    votes = spark.createDataFrame(rows, "url string, seq int, judge string, code string, confidence double")
    got = {r.url: (r.winner_code, round(r.winner_share, 4), r.disputed) for r in V.resolve(V.panel(V.valid(votes))).collect()}
    assert got == {"v1": ("is", 0.8019, False), "v2": ("en", 0.8462, False), "v3": ("kl", 1.0, True), "v4": ("da", 0.5, True), "v6": ("en", 0.7347, False), "v7": ("nb", 0.5255, True)}
    extra = spark.createDataFrame([("v4", "nb", 0.6), ("v1", "nb", 1.0)], "url string, code string, confidence double")
    tied = {r.url: (r.winner_code, round(r.winner_share, 4), r.disputed) for r in V.tiebreak(votes, extra).collect()}
    assert tied["v4"] == ("nb", 0.6753, False) and tied["v1"] == got["v1"]
    assert {r.url: r.disputed for r in V.resolve(V.panel(V.valid(votes)), strict=True).collect()}["v2"] is True
    urls = spark.createDataFrame([("v4",), ("none",), ("v9",)], "url string")
    assert {r.url: r.code for r in V.verdicts(urls, V.resolve(V.panel(V.valid(votes)))).collect()} == {"v4": "disputed", "none": "unknown", "v9": "unknown"}


def test_patterns(spark):
    rows = [("a", "Additional reporting by Bob Howard for BBC"), ("a", "Additional reporting by Ann Lee for BBC"), ("b", "Additional reporting by Bob Howard."), ("b", "Additional reporting by Ann Lee."), ("c", "same text here"), ("c", "same text here"), ("d", "Read this"), ("d", "Other that"), ("e", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate([*rows, ("f", "Ab c"), ("f", " aB C"), (None, "alone (x)"), ("h", "Prefix one\\nthree suffix"), ("h", "Prefix two\\nfour suffix")])], "candidate_id int, g string, fragment string")
    assert {r.g: r.pattern for r in K.generalized(df, "g").collect()} == {"a": "^Additional reporting by.+for BBC$", "b": None, "c": None, "d": None, "f": None, None: None, "h": None}
    assert {r.g: (r.pattern, r.generalized) for r in K.suggestions(df, "g").collect()} == {"a": ("^Additional reporting by.+for BBC$", True), "c": ("^same text here$", False), "f": ("^Ab c$", False), None: ("^alone \\(x\\)$", False)}


def test_upsert(spark):
    log = spark.createDataFrame([("d", " Share "), (None, "x")], "domain string, fragment string")
    new = spark.createDataFrame([("d", "share", 1), ("d", "Mail", 2), ("d", " mail", 3), ("e", "share", 4), (None, "X", 5), ("d", " ", 6), ("d", None, 7)], "domain string, fragment string, n int")
    assert sorted(r.n for r in K.upsert(log, new, "n").collect()) == [2, 4]


def test_replies(spark):
    got = R.parsed(spark.createDataFrame(X.REPLIES, "batch_id bigint, n bigint, raw string")).orderBy("batch_id", "slot").collect()
    assert [(r.batch_id, r.slot, r.fragment, r.reason) for r in got] == [(1, 1, "C", ""), (4, 1, "D", "x")]
    codes = {r.id: (r.reply_code, r.reply_confidence) for r in R.language_reply(spark.createDataFrame(X.CODES, "id int, raw string")).collect()}
    assert codes == {1: ("is", 0.9), 2: ("da", 0.6), 3: ("nb", 0.6), 4: ("sv", 0.6), 5: (None, None), 6: (None, None), 7: (None, None), 8: ("fr", 0.25)}


def test_batches(spark):
    docs = spark.createDataFrame([(i, "short text") for i in range(31)], "doc_id bigint, text string")
    made = R.payloads(R.batches(docs))
    assert sorted(r.n for r in made.collect()) == [1, 15, 15]
    asked = R.asked(made, lambda payload: "[]" if len(payload) > 100 else 1 / 0)
    assert sorted(str(r.raw) for r in asked.collect()) == ["None", "[]", "[]"]


def test_retry():
    calls, slept = [], []

    def call(key, prompt):
        calls.append(key)
        if key == "a":
            raise RuntimeError("quota")
        return prompt

    made = R.Retry(["a", "a", "b"], call, lambda e: "quota" in str(e), slept.append)
    assert made("x") == "x" and calls == ["a", "a", "a", "b"] and slept == [5.0, 10.0]
    assert R.Retry(["a"], lambda k, p: 1 / 0, lambda e: False, slept.append)("x") is None


def test_pages(spark):
    pages = spark.createDataFrame(X.PAGES, "page_id bigint, url string, html string")
    dom = D.nodes(pages)
    ps = {r.page_id: r.ps for r in D.override_paragraphs(dom, "article", ["[class*='share']"]).collect()}
    assert len(ps[1]) == 3 and not any("Share this" in p for p in ps[1])
    whole = {r.page_id: r.ps for r in D.fallback_paragraphs(dom).collect()}
    assert len(whole[3]) == 1 and len(whole[1]) == 4
    links = [r.url for r in D.links(pages).where("page_id = 1").orderBy("seq").collect()]
    assert links == ["https://www.example.com/news/about-us", "https://www.example.com/news/story-one-two-three-2026", "https://other.org/a/b-c-d-e", "https://www.example.com/news/index.html#top"]


def test_containers(spark):
    assert values(spark, X.TOKENS[:8], "i int, t string", T.hash_like(F.col("t"))) == [True, True, True, False, False, False, False, False]
    ranked = spark.createDataFrame(X.RANKED, "page_id int, selector string, place int, total_len int, n_suspects int")
    assert {r.page_id: (r.selector, r.excludes) for r in D.pick_container(ranked).collect()} == {1: ("main", False), 2: ("article", False), 3: ("main", True), 4: ("main", False)}
    found = spark.createDataFrame([(1, 1, "promo promo-x7rtbd", "div"), (1, 2, "promo promo-x7rtbd b", "nav"), (2, 1, "a", "div"), (3, 1, "footer x", "footer"), (3, 2, None, "footer")], "page_id int, pre int, class string, tag string").withColumn("selector", F.lit("s"))
    tokens = {r.page_id: r.token for r in D.common_class_token(found, "page_id", "selector").collect()}
    assert tokens == {1: "promo-x7rtbd", 2: None, 3: "footer"}
    assert {r.page_id: r.exclude for r in D.exclude_selectors(found, "page_id", "selector").collect()} == {1: "[class*='promo-x7rtbd']", 2: "s", 3: "footer"}


def test_files(spark, tmp_path):
    path = str(tmp_path / "m")
    M.append_manifest(spark.createDataFrame([("u1", "h1"), ("u2", None)], "url string, content_hash string"), path)
    assert sorted(map(tuple, M.read_manifest(spark, path).collect())) == [("u1", "h1"), ("u2", None)]
    log = tmp_path / "log.json"
    log.write_text('[{"domain":"d","fragment":"f","reviewed":true},{"domain":"e"}]')
    assert [(r.domain, r.reviewed) for r in M.read_candidates(spark, str(log)).collect()] == [("d", True)]
    log.write_text("not json")
    assert M.read_candidates(spark, str(log)).count() == 0
    M.write_articles(spark.createDataFrame([("is", "raw", "a.txt", "t")], "lang_folder string, variant string, filename string, text string"), str(tmp_path / "out"))
    assert os.path.isdir(tmp_path / "out" / "lang_folder=is" / "variant=raw")
    assert not M.clear(spark, path) and M.clear(spark, path, confirmed=True) and not os.path.exists(path)


def test_reconcile(spark):
    from corpusloom.operators.ordering import reconcile

    keys = {u: hashlib.sha1(u.encode()).hexdigest()[:8] for u in ("u1", "u2", "u3")}
    files = spark.createDataFrame([(f"d__s__{keys['u1']}.txt",), (f"d__s__{keys['u2']}__lemma.txt",), (f"d__{keys['u3']}.md",)], "name string")
    assert sorted(r.url for r in reconcile(spark.createDataFrame([("u1",), ("u2",), ("u3",), (None,)], "url string"), files).collect()) == ["u1", "u2"]


def test_stream(spark, tmp_path):
    body = "The council met on Tuesday to discuss the repair of the long bridge over the river. " * 4
    schema = "doc_id bigint, url string, source string, text string"
    languages = spark.createDataFrame([("a.example", "", "is", True)], "domain string, prefix string, code string, locked boolean")
    votes = spark.createDataFrame([], "url string, seq int, judge string, code string, confidence double")
    for name, rows in (("a", [(1, "u1", "s", body), (2, "u2", "s", body.upper()), (3, "u3", "s", "short")]), ("b", [(4, "u4", "s", body), (5, "https://a.example/u5", "s", body + "More."), (6, None, "s", body + "Six.")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), schema, route=lambda df: V.route(df, languages, votes)).awaitTermination()
    articles = spark.read.parquet(str(tmp_path / "out" / "articles")).collect()
    assert {(r.url, r.lang_folder) for r in articles} == {("u1", "unknown"), ("https://a.example/u5", "is"), (None, "unknown")} and len(articles) == 3
    lines = spark.read.parquet(str(tmp_path / "out" / "manifest")).collect()
    assert sorted(str(r.url) for r in lines) == ["None", "https://a.example/u5", "u1"] and all(r.content_hash.startswith(r.prefix) for r in lines)


def review_log(spark):
    rows = [
        (1, "d", "r", "u2", "Additional reporting by Bob Howard for BBC"), (2, "d", "r", "u1", "Additional reporting by Ann Lee for BBC"),
        (3, "d", "x", "", "Read this"), (4, "d", "x", None, "Other that"), (5, None, None, "u5", "No domain here"), (6, "e", "r", "u6", None), (7, "e", "r", "u7", "all rights reserved"), (8, "f", "r", "u8", "Leave me"),
    ]
    return spark.createDataFrame([(*r, None, None, None, "clash") for r in rows], "candidate_id bigint, domain string, reason string, url string, fragment string, reviewed boolean, discarded boolean, promoted boolean, pattern string")


def test_review(spark):
    """Groups without a shared pattern are proposed fragment by fragment; null domains and reasons are a group too."""
    log = review_log(spark)
    made = {r.candidate_id: (r.pattern, r.generalized) for r in K.proposals(log).collect()}
    general = "^Additional reporting by.+for BBC$"
    assert made == {1: (general, True), 2: (general, True), 3: ("^Read this$", False), 4: ("^Other that$", False), 5: ("^No domain here$", False), 8: ("^Leave me$", False)}
    decisions = spark.createDataFrame([("d", "r", general, "y"), ("d", "x", "^Read this$", "n"), (None, None, "^No domain here$", "y"), ("f", "r", "^Leave me$", "q")], "domain string, reason string, pattern string, choice string")
    flagged, patterns = K.review(log, decisions)
    assert {r.candidate_id: (r.reviewed, r.promoted) for r in flagged.collect() if r.reviewed} == {1: (True, True), 2: (True, True), 3: (True, None), 5: (True, True)}
    assert {(r.pattern, r.n, r.example) for r in patterns.collect()} == {(general, 2, "u1"), ("^No domain here$", 1, "u5")}
    # Approved patterns are active in the next step.
    left = K.proposals(log, [r.pattern for r in patterns.collect()])
    assert {r.candidate_id for r in left.collect()} == {3, 4, 8}
    ends = {c: {r.candidate_id for r in K.end_of_run(log, c, decisions).collect() if r.discarded or r.reviewed} for c in "rdsq"}
    assert ends == {"r": {1, 2, 3, 5}, "d": {1, 2, 3, 4, 5, 8}, "s": set(), "q": set()}
    assert K.review(log.limit(0), decisions.limit(0))[0].count() == 0


def test_pattern_table(spark, tmp_path):
    path = str(tmp_path / "patterns")
    M.append_patterns(spark.createDataFrame([("d", "r", "^b$", False, 1, "u"), ("d", "r", "^(a$", False, 1, None)], "domain string, reason string, pattern string, generalized boolean, n bigint, example string"), path, "2026-01-02")
    M.append_patterns(spark.createDataFrame([("d", "r", "^a$", False, 1, "u"), ("e", "r", "^b$", True, 1, "u")], "domain string, reason string, pattern string, generalized boolean, n bigint, example string"), path, "2026-01-01")
    assert M.read_patterns(spark, path) == ["^a$", "^b$"]


def test_judges(spark):
    from corpusloom.functions import judges as J

    def fails():
        raise OSError("no model")

    seen = spark.createDataFrame([("u1", "x" * 3000, "is"), ("u2", "Línan\nönnur 2", "is"), ("u3", None, "is"), ("u4", "", None)], "url string, text string, lang_folder string")
    loaders = {"glotlid": lambda: lambda t: (f"__label__isl_Latn", 0.3 if len(t) == 2000 else 0.2), "openlid": fails, "lingua": lambda: lambda t: ("kl", 0.5) if "\n" in t else ("is", 0.5)}
    hints = spark.createDataFrame([("u1", "da"), ("u3", "da")], "url string, code string")
    got = sorted(tuple(r) for r in J.panel_votes(seen, loaders, hints, codes=["is"]).collect())
    assert got == [("u1", 0, "glotlid", "is", 0.3), ("u1", 2, "lingua", "is", 0.5), ("u1", 4, "site_hint", "da", 0.65), ("u2", 2, "lingua", "is", 0.5)]
    assert J.judge(seen, "openlid", lambda: lambda t: ("isl", 1.0) if t == "línan önnur " else None, preprocess=True).select("url", "code").collect() == [("u2", "is")]
    assert J.panel_votes(seen, {}).count() == 0 and J.panel_votes(seen.limit(0), loaders, hints).count() == 0
    assert [r.lemmas for r in J.lemmatize(seen.where("url = 'u2'")).collect()] == ["Línan önnur 2"]


def test_language_ask_stops_when_spent(spark):
    rows = spark.createDataFrame([(f"u{i}", "stop" if i == 2 else f"text {i}" * 900) for i in range(5)], "url string, text string").coalesce(1)
    got = {r.url: r.raw for r in R.ask_language(rows, lambda t: None if t == "stop" else str(len(t))).collect()}
    assert got == {"u0": "2000", "u1": "2000", "u2": None, "u3": None, "u4": None}
    assert {r.raw for r in R.ask_language(rows).collect()} == {None}


def sited(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, article_selector string, exclude_selectors array<string>, html_later string, article string")


def test_page_cascade(spark):
    """The first success wins: the site's selector, the general extractor (with a later snapshot), known containers."""
    s = "The council met on Tuesday to discuss the repair of the long bridge over the river."
    t = "Nobody voted against the plan, said the mayor of the town, and the work begins in May."
    ps = f"<p>{s}<p>{t}<p>{s} Again.<p>Short"
    rows = [
        (1, "u1", f"<article>{ps}<div class='share'><p>{s} share</p></div></article>", "article", ["[class*='share']"], None, None),
        (2, "u2", f"<main>{ps}</main>", "article", None, None, None),
        (3, "u3", f"<div id='article-body'><p>{s}<p>© {s}</div><p>{t}", None, None, None, None),
        (4, "u4", None, "article", [], None, None),
        (5, "u5", f"<div>{ps}</div>", None, None, f"<div>{ps}<p>{t} Later.</div>", None),
        (6, "u6", f"<p>{s}<p>All rights reserved", ".nothing", [], None, None),
    ]
    got = {r.page_id: (r.how, r.article) for r in E.cascade(sited(spark, rows)).collect()}
    assert got[1] == ("override", "\n\n".join([s, t, f"{s} Again."])) and got[2] == ("general", "\n\n".join([s, t, f"{s} Again."]))
    assert got[3] == ("fallback", s) and got[4] == (None, None) and got[6] == ("fallback", s)
    assert got[5][0] == "general" and got[5][1].endswith("Later.")
    own = {r.page_id: r.how for r in E.cascade(sited(spark, rows), lambda html, url: 1 / 0).collect()}
    assert own[1] == "override" and own[2] == own[5] == "fallback"
    assert E.cascade(sited(spark, rows).limit(0)).count() == 0


def test_scrape(spark, tmp_path):
    body = "".join(f"<p>The council met on day {i} to discuss the repair of the long bridge over the river.</p>" for i in range(5))
    rows = [(1, "https://a.example/one", f"<article>{body}</article>", "article", None, None, None), (2, "https://a.example/two", f"<article>{body.upper()}</article>", "article", None, None, None), (3, "https://a.example/three", "<p>Wait", None, None, None, None), (4, None, "<p>Wait", None, None, None, None)]
    later = [(3, "https://a.example/three", f"<main>{body}<p>And one more paragraph of the article.</main>", None, None, None, None)]
    languages = spark.createDataFrame([("a.example", "", "is", True)], "domain string, prefix string, code string, locked boolean")
    votes = spark.createDataFrame([], "url string, seq int, judge string, code string, confidence double")
    made = pipeline.scrape(sited(spark, rows), languages, votes, again=sited(spark, later))
    assert {(r.page_id, r.status, r.tries) for r in made.status.collect()} == {(1, "saved", 1), (2, "duplicate", 1), (3, "saved", 2), (4, "failed", 2)}
    files = {(r.page_id, r.variant): r for r in made.files.collect()}
    assert set(files) == {(1, "raw"), (1, "lemmatized"), (3, "raw"), (3, "lemmatized")} and files[1, "lemmatized"].filename.endswith("__lemma.txt") and files[1, "raw"].lang_folder == "is"
    assert made.manifest.count() == 3
    seen = made.manifest.where("url like '%one'")
    assert {r.page_id for r in pipeline.scrape(sited(spark, rows), languages, votes, seen=seen, lemmas=False).files.collect()} == set()


def test_inspector(spark):
    body = "".join(f"<p>The council met on day {i} to discuss the repair of the long bridge.</p>" for i in range(8))
    share = "<div class='share-box'><p>Share this article with all of your friends</p></div>"
    rows = [(1, "https://www.A.example/x", f"<main>{body}{share}{share}<footer><p>All rights reserved by us</p></footer></main>"), (2, "https://b.example/", "<div><p>Please wait</p></div>"), (3, "https://c.example/", f"<div>{body}</div>"), (4, None, None), (5, "u", f"<main>{share}<article>{body}</article></main>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in D.inspect(D.nodes(pages), pages).collect()}
    assert (got[1].article_selector, got[1].exclude_selectors, got[1].n_checks, got[1].domain) == ("main", ["footer", "[class*='share-box']"], 0, "a.example")
    assert got[5].article_selector == "article" and got[5].exclude_selectors == []
    assert [got[i].diagnosis for i in (1, 2, 3, 4)] == ["ok", "no_text", "no_container", "no_text"]


def test_command_line(spark, tmp_path):
    from corpusloom import __main__ as cli

    out, body = str(tmp_path / "out"), "".join(f"<p>The council met on day {i} to discuss the repair of the long bridge over the river.</p>" for i in range(5))
    spark.createDataFrame([(1, "https://www.ruv.is/frettir", "<a href='/frettir/one-two-three-four/'>x</a><a href='/um'>y</a>")], "page_id bigint, url string, html string").write.parquet(str(tmp_path / "listings"))
    pages = [(1, "https://www.ruv.is/frettir/one-two-three-four", f"<div class='article-body'>{body}</div>"), (2, "https://www.ruv.is/um", body), (3, "https://b.example/c", f"<main>{body}More</main>")]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages"))
    assert cli.main(["auto", "--pages", str(tmp_path / "pages"), "--listings", str(tmp_path / "listings"), "--out", out], spark) == 0
    assert {(r.lang_folder, r.variant) for r in spark.read.parquet(f"{out}/articles").collect()} == {("is", "raw"), ("is", "lemmatized")}
    assert cli.auto(spark, str(tmp_path / "pages"), str(tmp_path / "listings"), out).count() == 0
    (tmp_path / "urls.txt").write_text("https://b.example/c/?x=1\n\nhttps://b.example/c\n")
    assert [tuple(r) for r in cli.given(spark, str(tmp_path / "pages"), str(tmp_path / "urls.txt"), out).collect()] == [("duplicate", 1)]
    M.append_log(review_log(spark).select("domain", "url", "fragment", "reason", "reviewed", "discarded", "promoted"), f"{out}/candidates")
    (tmp_path / "decisions.json").write_text('{"domain": "d", "reason": "x", "pattern": "^Read this$", "choice": "y"}\n')
    assert cli.main(["review", "--out", out, "--decisions", str(tmp_path / "decisions.json")], spark) == 0
    assert M.read_patterns(spark, f"{out}/patterns") == ["^Read this$"]
    assert cli.main(["clear", "--out", out], spark) == 1 and os.path.exists(f"{out}/articles")
    assert cli.main(["clear", "--out", out, "--yes"], spark) == 0 and not os.path.exists(f"{out}/articles") and cli.main(["delete", "--out", out, "--yes"], spark) == 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
