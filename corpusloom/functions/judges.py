"""Adapters for external models. None ships here: each is given as a loader that gives a callable.

A judge is loaded once per worker (a failed load abstains for the whole run), sees at most ``LIMIT`` characters, and
gives (code, confidence) or None for abstention.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import constants as C
from . import text as T

LIMIT = 2000
#: Texts handled at once by the lemmatizer inside a worker.
ROWS = 256
Loader = Callable[[], Callable[[str], tuple[str, float] | None]]


def judge(documents: DataFrame, name: str, load: Loader, preprocess: bool = False, codes: list[str] | None = None) -> DataFrame:
    """Votes (url, seq, judge, code, confidence) of one model; rows below its threshold abstain.

    Labels such as ``__label__isl_Latn`` become two-letter codes; of a closed list (``codes``) all others abstain.
    """
    text = F.substring(F.coalesce("text", F.lit("")), 1, LIMIT)
    shown = documents.select("url", (T.openlid_preprocess(text) if preprocess else F.regexp_replace(text, "\n", " ")).alias("text"))
    least = C.JUDGE_THRESHOLDS.get(name, 0.0)
    place = [*C.JUDGE_WEIGHTS].index(name)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            model = load()
        except Exception:  # noqa: BLE001  a model that can't be loaded abstains
            model = None
        for f in frames:
            got = [(u, v) for u, t in zip(f["url"], f["text"]) if model and isinstance(t, str) and t and (v := model(t)) and v[1] >= least]
            strings = {"url": [u for u, _ in got], "judge": [name] * len(got), "code": [v[0] for _, v in got]}
            votes = pd.DataFrame({n: pd.Series(x, dtype=object) for n, x in strings.items()})
            yield votes.assign(seq=pd.Series([place] * len(got), dtype="int32"), confidence=pd.Series([float(v[1]) for _, v in got], dtype="float64"))[["url", "seq", "judge", "code", "confidence"]]

    voted = shown.mapInPandas(run, "url string, seq int, judge string, code string, confidence double").withColumn("code", T.iso_code(F.col("code")))
    return voted.where(F.col("code").isin(codes)) if codes else voted


def panel_votes(documents: DataFrame, loaders: dict[str, Loader], hints: DataFrame | None = None, codes: list[str] | None = None) -> DataFrame:
    """Votes of all judges that have a loader, and of the site's own language (``hints``: url, code) where a judge voted."""
    out = None
    for name, load in loaders.items():
        one = judge(documents, name, load, preprocess=name == "openlid", codes=codes if name == "lingua" else None)
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = documents.sparkSession.createDataFrame([], "url string, seq int, judge string, code string, confidence double")
    if hints is None:
        return out
    named = hints.join(out.select("url").distinct(), "url", "left_semi").where("code is not null")
    seq = [*C.JUDGE_WEIGHTS].index("site_hint")
    return out.unionByName(named.select("url", F.lit(seq).alias("seq"), F.lit("site_hint").alias("judge"), "code", F.lit(C.SITE_HINT_CONFIDENCE).alias("confidence")))


def split_words(code: str) -> Callable[[str], list[str]]:
    """The lemmatizer where no model is given: every word is its own lemma."""
    return str.split


def lemmatize(documents: DataFrame, load: Callable[[str], Callable[[str], list[str]]] = split_words) -> DataFrame:
    """Adds ``lemmas``: non-blank lemmas joined by spaces; one pipeline per language and worker."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loaded: dict[str, Callable] = {}
        for f in (whole.iloc[at : at + ROWS] for whole in frames for at in range(0, len(whole), ROWS)):
            out = []
            for code, t in zip(f["lang_folder"], f["text"]):
                if code not in loaded:
                    loaded[code] = load(code)
                out.append(" ".join(x for x in loaded[code](t if isinstance(t, str) else "") if x and x.strip()))
            yield f.assign(lemmas=pd.Series(out, dtype=object, index=f.index))

    schema = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes) + ", lemmas string"
    return documents.mapInPandas(run, schema)
