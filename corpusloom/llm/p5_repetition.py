"""Problem 5: repetition inside a single document.

``repetition_profile`` measures the shares of repeated lines, sentences and word runs of every document.
``repeated_documents`` decides one threshold on word runs through a short-circuit cascade of sound rules:
each rule can only *reject* documents that cannot reach the threshold, so their order never changes the
result. Costs and selectivities are measured on a sample (``sample_rows`` documents, only for the order),
and the rules run by rejections per cost.

Nulls, empty and blank texts have no words: all shares are 0 and they are never cases. Extra columns pass
through ``repetition_profile`` untouched only if asked for by the caller through a join on the key.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_rows

SENTENCE = re.compile(r"[^.!?\n]+")


def share(items: list) -> float:
    """1 - distinct / all; 0 for nothing."""
    return 1.0 - len(set(items)) / len(items) if items else 0.0


def runs(words: list[str], n: int) -> list[tuple[str, ...]]:
    return list(zip(*(words[i:] for i in range(n))))


def distinct_runs(words: list[str], n: int) -> int:
    return len(set(zip(*(words[i:] for i in range(n)))))


# Rules. Each takes the words of a document and says whether it can be *rejected*. A document has
# total = words - n + 1 runs; it is a case if distinct < (1 - least) * total or equal. The number of distinct
# prefixes of the runs (their first word, or first two) is a lower bound of the number of distinct runs.


def first_word(words: list[str], n: int, room: float) -> bool:
    return len(set(words[: len(words) - n + 1])) > room


def first_two(words: list[str], n: int, room: float) -> bool:
    k = len(words) - n + 1
    return len(set(zip(words[:k], words[1:k + 1]))) > room


def no_repeated_run(words: list[str], n: int, room: float) -> bool:
    """Runs at every n-th place that are not enough for a case even if all others were repeats."""
    k = len(words) - n + 1
    sparse = set(zip(*(words[i : k + i : 2] for i in range(n))))
    return len(sparse) > room


RULES = {"first_word": first_word, "first_two": first_two, "every_second_run": no_repeated_run}


def rate_rules(texts: list[str | None], n: int, least: float, min_words: int) -> dict[str, tuple[int, float]]:
    """Rejections and seconds of each rule on some texts."""
    docs = [w for t in texts if t and len(w := t.lower().split()) >= max(min_words, n)]
    rated = {}
    for name, rule in RULES.items():
        began = time.perf_counter()
        rejected = sum(rule(w, n, (1 - least) * (len(w) - n + 1) + 1e-9) for w in docs)
        rated[name] = rejected, time.perf_counter() - began
    return rated


def order_rules(rated: dict[str, tuple[int, float]]) -> list[str]:
    """Names of the rules by rejections per second; in the order written where nothing tells them apart."""
    return sorted(RULES, key=lambda name: (-(rated[name][0] / rated[name][1]) if name in rated and rated[name][1] > 0 else 0.0, list(RULES).index(name)))


def measured(documents: DataFrame, n: int, least: float, min_words: int, sample_rows: int) -> dict[str, tuple[int, float]]:
    """The rules rated on a random sample of at most ``sample_rows`` texts, inside the workers."""

    def block(rows: dict) -> dict:
        rated = rate_rules(rows["text"], n, least, min_words)
        return {"rule": list(rated), "rejected": [r for r, _ in rated.values()], "cost": [c for _, c in rated.values()]}

    sample = documents.select("text").sample(False, 0.1, 11).limit(sample_rows)
    got = map_rows(sample, "rule string, rejected bigint, cost double", block).groupBy("rule").agg(F.sum("rejected").alias("rejected"), F.sum("cost").alias("cost"))
    return {r.rule: (r.rejected, r.cost) for r in got.collect()}


def repeated_documents(documents: DataFrame, n: int = 5, least: float = 0.3, min_words: int = 30, sample_rows: int = 500) -> DataFrame:
    """Documents of at least ``min_words`` words with 1 - distinct/all runs of ``n`` words >= ``least``.

    Gives doc_id and run_share, the exact share. The sample of ``sample_rows`` rows only orders the rules.
    """
    chosen = order_rules(measured(documents, n, least, min_words, sample_rows))

    def block(rows: dict) -> dict:
        ids, shares = [], []
        rules = [RULES[x] for x in chosen]
        for key, text in zip(rows["doc_id"], rows["text"]):
            if not text:
                continue
            words = text.lower().split()
            total = len(words) - n + 1
            if len(words) < min_words or total < 1:
                continue
            room = (1 - least) * total + 1e-9
            if any(rule(words, n, room) for rule in rules):
                continue
            got = 1 - distinct_runs(words, n) / total
            if got >= least - 1e-12:
                ids.append(key)
                shares.append(got)
        return {"doc_id": ids, "run_share": shares}

    return map_rows(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id bigint, run_share double", block)


def repetition_profile(documents: DataFrame) -> DataFrame:
    """Shares of repeated content of every document, one row each (0 for null and empty texts).

    line_share, sentence_share: repeated non-blank lines, sentences. run2_share .. run5_share: runs of two to
    five words. repeated_chars: share of characters in lines that stand more than once.
    """

    def block(rows: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_words", "line_share", "sentence_share", "run2_share", "run3_share", "run4_share", "run5_share", "repeated_chars")}
        for key, text in zip(rows["doc_id"], rows["text"]):
            low = (text or "").lower()
            words = low.split()
            lines = [s for x in low.split("\n") if (s := " ".join(x.split()))]
            seen: dict[str, int] = {}
            for x in lines:
                seen[x] = seen.get(x, 0) + 1
            chars = sum(map(len, lines))
            out["doc_id"].append(key)
            out["n_words"].append(len(words))
            out["line_share"].append(share(lines))
            out["sentence_share"].append(share([s for x in SENTENCE.findall(low) if (s := " ".join(x.split()))]))
            for k in (2, 3, 4, 5):
                total = len(words) - k + 1
                out[f"run{k}_share"].append(1 - distinct_runs(words, k) / total if total > 0 else 0.0)
            out["repeated_chars"].append(sum(len(x) * (c - 1) for x, c in seen.items()) / chars if chars else 0.0)
        return out

    schema = "doc_id bigint, n_words bigint, line_share double, sentence_share double, run2_share double, run3_share double, run4_share double, run5_share double, repeated_chars double"
    return map_rows(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), schema, block)


#: Shares at which a document is repetitive, by measure of the profile.
LIMITS = {"line_share": 0.3, "sentence_share": 0.3, "repeated_chars": 0.2, "run2_share": 0.75, "run3_share": 0.6, "run4_share": 0.45, "run5_share": 0.3}


def measure(name: str, low: str, words: list[str], lines: list[str]) -> float:
    """One measure of the profile, computed alone."""
    if name == "line_share":
        return share(lines)
    if name == "sentence_share":
        return share([s for x in SENTENCE.findall(low) if (s := " ".join(x.split()))])
    if name == "repeated_chars":
        chars = sum(map(len, lines))
        return 1.0 - sum(map(len, set(lines))) / chars if chars else 0.0
    k = int(name[3])
    total = len(words) - k + 1
    return 1 - distinct_runs(words, k) / total if total > 0 else 0.0


def repetitive(documents: DataFrame, limits: dict[str, float] = LIMITS, min_words: int = 30, sample_rows: int = 500) -> DataFrame:
    """doc_id of documents of at least ``min_words`` words in which any measure reaches its limit.

    The measures run as a short-circuit cascade, those first that tell most documents per second on a random sample;
    the first that reaches its limit ends it, and the order never changes the result.
    """

    def parts(text: str) -> tuple[str, list[str], list[str]]:
        low = text.lower()
        return low, low.split(), [s for x in low.split("\n") if (s := " ".join(x.split()))]

    def rate(rows: dict) -> dict:
        docs = [p for t in rows["text"] if t and len((p := parts(t))[1]) >= min_words]
        hit, cost = [], []
        for name, limit in limits.items():
            began = time.perf_counter()
            hit.append(sum(measure(name, *p) >= limit - 1e-12 for p in docs))
            cost.append(time.perf_counter() - began)
        return {"rule": list(limits), "rejected": hit, "cost": cost}

    sample = documents.select("text").sample(False, 0.1, 11).limit(sample_rows)
    rated = {r.rule: r.rejected / r.cost if r.cost else 0.0 for r in map_rows(sample, "rule string, rejected bigint, cost double", rate).groupBy("rule").agg(F.sum("rejected").alias("rejected"), F.sum("cost").alias("cost")).collect()}
    order = sorted(limits, key=lambda name: -rated.get(name, 0.0))

    def block(rows: dict) -> dict:
        ids = []
        for key, text in zip(rows["doc_id"], rows["text"]):
            if text and len((p := parts(text))[1]) >= min_words and any(measure(name, *p) >= limits[name] - 1e-12 for name in order):
                ids.append(key)
        return {"doc_id": ids}

    return map_rows(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id bigint", block).distinct()


def found(documents: DataFrame) -> DataFrame:
    return repeated_documents(documents).select("doc_id").distinct()
