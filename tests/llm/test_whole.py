"""The training-text operators where a short cut once left something out."""

import random

import numpy as np
import pytest
from corpusloom.llm import p1_main_content as p1
from corpusloom.llm import p2_near as p2
from corpusloom.llm import p4_residue as p4
from corpusloom.llm import p6_lookalikes as p6
from pyspark.sql import functions as F


@pytest.mark.parametrize("word", ["undefined", "nan", "null undefined", "xxx", "typeerror", "error 500"])
def test_residue_of_one_long_line(word):
    short = " ".join([word] * 3)
    long = " ".join([word] * (400 // len(word)))
    assert len(long) > p4.BESIDE_CHARS and p4.is_residue(short) and p4.is_residue(long)


def test_long_sentences_are_no_residue():
    assert not p4.is_residue("The value was undefined and the reply came back null after the error 500 that the council met on Tuesday. " * 4)


def test_rare_followers_are_told_from_all_documents(spark):
    body = "The council met on Tuesday to discuss the repair of the long bridge over the river, and the harbour stayed closed all day."
    rows = [(i, f"Headline of day {chr(97 + i)}\n{body}\n{body}\nRead also\nThe ferry waits for a new {chr(97 + i // 2)} captain", "s") for i in range(20)]
    made = spark.createDataFrame(rows, "doc_id int, text string, source string")
    whole, split = ({(r.kind, r.item): (r.n, r.m, r.k) for r in p1.learn(made.orderBy(key).repartitionByRange(parts, key)).collect()} for parts, key in ((1, "doc_id"), (10, F.col("doc_id") % 10)))
    assert whole == split and whole["line", "read also"] == (20, 0, 20)


def test_teasers_that_recur_in_a_large_source_stay_behind_their_label(spark):
    body = "The council met on Tuesday to discuss the repair of the long bridge over the river, and the harbour stayed closed all day."
    word = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    rows = [(i, f"Headline of day {word(i)}\n{body}\n{body}\nRead also\nThe ferry waits for a new {word(i // 3)} captain", "s") for i in range(450)]
    made = spark.createDataFrame(rows, "doc_id int, text string, source string")
    assert {tuple(r) for r in p1.found(made).collect()} == {(i, n) for i in range(450) for n in (4, 5)}


def edited_addresses():
    """Addresses of few sites and sections, each with edited ones about the threshold, and the pairs of 0.75 and more."""
    rnd = random.Random(11)
    names = ["".join(rnd.choice(["ba", "ke", "lo", "stu", "vik", "dal", "mo"]) for _ in range(3)) for _ in range(60)]
    made = []
    for _ in range(250):
        words = [rnd.choice(names) for _ in range(6)]
        key = "".join(rnd.choice("abcdefgh0123456789") for _ in range(8))
        form = lambda w: f"post{rnd.randrange(2)}.example/news/2026/{'-'.join(w)}-{key}"  # noqa: B023, E731
        other = [*words[:2], rnd.choice(names), *words[3:]]
        made += [form(words), form(words) + f";sid={rnd.randrange(10**12)}", form(other), form([words[1], words[0], *words[2:]])]
    made = sorted(set(made))
    sets = [{x[i : i + 4] for i in range(len(x) - 3)} for x in made]
    pairs = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if len(a & b) / len(a | b) >= 0.75}
    return [(i, f"https://{x}") for i, x in enumerate(made)], {(j, i) for i, j in pairs}


@pytest.mark.parametrize("hot", [False, True])
def test_all_pairs_of_near_addresses(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(p2, "PROBE", 1)
        monkeypatch.setattr(p2, "HOT", 5)
        monkeypatch.setattr(p2, "PAIRS", 50)
    rows, true = edited_addresses()
    links, members = p2.url_links(spark.createDataFrame(rows, "seq bigint, url string"))
    assert {tuple(r) for r in p2.expand(links, members).collect()} == true and len(true) > 400


def test_lookalikes_are_found_by_the_repair(spark):
    rows = [(1, "the b\u0430nk was closed"), (2, "a bank and a school"), (3, "the \u0430zqv was closed"), (4, "x\u0302"), (5, "\u212b"), (6, None)]
    records = spark.createDataFrame(rows, "doc_id bigint, text string")
    none = spark.createDataFrame([], "candidate_id bigint, fragment string")
    made = {r.record_id: (r.text, r.changed, r.differed) for r in p6.repair(p6.texts(records)).collect()}
    assert made == {1: ("the bank was closed", True, True), 2: (rows[1][1], False, False), 3: (rows[2][1], False, True), 4: ("x\u0302", False, True), 5: ("\u00c5", True, False), 6: (None, False, False)}
    got = p6.found(records, none)
    assert {r.record_id for r in got.collect()} == {i for i, x in made.items() if x[2]}
    assert "MapInArrow" in got._jdf.queryExecution().toString() and "LeftSemi" in got._jdf.queryExecution().toString()


def test_documents_without_a_common_key_are_paired(spark, monkeypatch):
    """A single bundle a collection finds few of the pairs; all must come out all the same."""
    monkeypatch.setattr(p2, "DOC_BANDS", (3, 1))
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(40):
        base = [rnd.choice(words) for _ in range(80)]
        rows += [(len(rows) + k, " ".join(rnd.choice(words) if k and rnd.random() < 0.03 * k else w for w in base)) for k in range(3)]
    sets = {i: {tuple(w[j : j + 3]) for j in range(len(w) - 2)} for i, t in rows for w in [t.split()]}
    true = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7}
    links, members = p2.document_links(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {tuple(r) for r in p2.expand(links, members).collect()} == true and len(true) > 30


def test_texts_are_read_once_and_again_only_to_verify(spark, monkeypatch):
    read = []

    def spied(df, real=p2.cut):
        read.append("text#" in df._jdf.queryExecution().optimizedPlan().toString())
        return real(df)

    monkeypatch.setattr(p2, "cut", spied)
    rows = [(i, " ".join(f"w{(i // 2 * 60 + j) % 997}" for j in range(60 + i % 2))) for i in range(40)]
    links, members = p2.document_links(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {tuple(r) for r in p2.expand(links, members).collect()} >= {(i, i + 1) for i in range(0, 40, 2)}
    assert sum(read) == 2


@pytest.mark.parametrize("marks", [1, 64, 1 << 24])
def test_marks_leave_out_no_document(spark, monkeypatch, marks):
    """A bitmap that is full or too small only lets more rows through: copies, and an id that stands twice, among them."""
    monkeypatch.setattr(p2, "MARKS", marks)
    ids = spark.range(2000).select("id")
    told = p2.marked(ids, ids.where("id % 200 = 0"))
    maybe = {r.id for r in told.where("maybe").collect()}
    assert told.count() == 2000 and maybe >= set(range(0, 2000, 200)) and (marks > 64 or len(maybe) > 100) and (marks == 64 or len(maybe) == (10 if marks > 1 else 2000))
    rnd = random.Random(9)
    texts = [" ".join(f"w{rnd.randrange(300)}" for _ in range(80)) for _ in range(12)]
    rows = [(12 * k + i, t + (" more" if k == 2 else "")) for k in range(3) for i, t in enumerate(texts)]
    links, members = p2.document_links(spark.createDataFrame([*rows, rows[0]], "doc_id bigint, text string"))
    assert {tuple(r) for r in links.select("id_a", "id_b").collect()} == {(i, 24 + i) for i in range(12)}
    assert {tuple(r) for r in p2.expand(links, members).collect()} == {(12 * j + i, 12 * k + i) for i in range(12) for j, k in ((0, 1), (0, 2), (1, 2))}


@pytest.mark.parametrize("shared", [1, 3])
def test_pairs_of_rows_are_those_that_both_sizes_allow(shared):
    """Against all pairs: neither record has more rarer items than it may lack."""
    rnd, least = np.random.default_rng(3), 0.75
    size = np.sort(rnd.integers(8, 60, 400)).astype(np.int32)
    item = np.repeat([5, 9], 200)
    size = np.concatenate([size[::2], size[1::2]])
    place = (rnd.random(400) * (size * (1 - least) + shared)).astype(np.int32)
    rows = {"id": np.arange(400), "item": item, "place": place, "size": size}
    true = set()
    for a in range(400):
        for b in range(a):
            lacks = (1 - least) / (1 + least) * (int(size[a]) + int(size[b])) + 1e-6
            x, y, more = int(place[a]) - shared + 1, int(place[b]) - shared + 1, int(size[a]) - int(size[b])
            if item[a] == item[b] and min(size[a], size[b]) >= least * max(size[a], size[b]) - 1e-6 and x + y <= lacks and 2 * x <= lacks + more and 2 * y <= lacks - more:
                true.add((b, a))
    got = [p for batch in p2.fitting(rows, ["item"], least, shared) for p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
    assert set(got) == true and len(got) == len(true) > 1000
