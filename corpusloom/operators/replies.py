"""Batches for an optional model, and its replies.

The model itself is an injected callable (``ask``); without one every article gets no candidates. Batch numbers need
an order over all rows: partitions are sorted by range and numbered from counts per partition, so no single task
sees everything.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T
from ..session import cut

FENCE = r"\A```(?:json)?\s*|\s*```\z"


def numbered(df: DataFrame, order: str | list[str], name: str) -> DataFrame:
    """``name``: place of each row from 0 by ``order`` (unique), without a global window.

    ``monotonically_increasing_id`` holds the partition and the place in it; a prefix sum over the partition counts
    (one row per partition) turns it into a dense number.
    """
    columns = [order] if isinstance(order, str) else order
    placed = cut(df.repartitionByRange(*map(F.col, columns)).sortWithinPartitions(*columns).withColumn("_id", F.monotonically_increasing_id()))
    split = placed.withColumn("_part", F.shiftrightunsigned("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = split.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.alias("a").join(F.broadcast(counts).alias("b"), F.col("b._part") < F.col("a._part"), "left").groupBy("a._part").agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before"))
    return split.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_id", "_part", "_at", "_before")


def batches(documents: DataFrame, size: int = C.BATCH) -> DataFrame:
    """Suspicious documents in order of doc_id: doc_id, batch_id, slot, sample."""
    chosen = documents.where(T.is_suspicious(F.col("text"))).select("doc_id", T.detection_sample(F.coalesce("text", F.lit(""))).alias("sample"))
    return numbered(chosen, "doc_id", "_n").select("doc_id", F.floor(F.col("_n") / size).alias("batch_id"), (F.col("_n") % size).cast("int").alias("slot"), "sample")


def payloads(batched: DataFrame) -> DataFrame:
    """batch_id, n, payload (JSON array of {id, text}), max_tokens of each batch."""
    items = F.array_sort(F.collect_list(F.struct(F.col("slot").alias("id"), F.col("sample").alias("text"))))
    return batched.groupBy("batch_id").agg(F.count("*").alias("n"), F.to_json(items).alias("payload")).withColumn("max_tokens", F.least(F.lit(8000), 200 + 300 * F.col("n")))


def asked(payload: DataFrame, ask: Callable[[str], str | None] | None = None) -> DataFrame:
    """batch_id, n, raw: the model's reply to each batch, null where there is no model or it fails."""

    def run(frames):
        for f in frames:
            raw = []
            for text in f["payload"]:
                try:
                    raw.append(ask(text) if ask else None)
                except Exception:  # noqa: BLE001  any failure is an empty reply
                    raw.append(None)
            yield pd.DataFrame({"batch_id": f["batch_id"], "n": f["n"], "raw": pd.Series(raw, dtype=object)})

    return payload.select("batch_id", "n", "payload").mapInPandas(run, "batch_id bigint, n bigint, raw string")


def parsed(replies: DataFrame) -> DataFrame:
    """batch_id, slot, pos, fragment, reason; malformed parts give nothing, of equal ids the last counts."""
    bare = replies.withColumn("_v", F.expr(f"try_parse_json(regexp_replace(trim(raw), r'{FENCE}', ''))"))
    items = bare.selectExpr("batch_id", "n", "_v").where("schema_of_variant(_v) like 'ARRAY%'")
    good = _items(items).where("kind in ('BIGINT', 'BOOLEAN') and id >= 0 and id < n and is_list")
    last = good.groupBy("batch_id", "id").agg(F.max_by("candidates", "item").alias("candidates"))
    return _candidates(last)


def logged(fragments: DataFrame, batched: DataFrame, documents: DataFrame) -> DataFrame:
    """Parsed candidates (batch_id, slot, pos, fragment, reason) as entries for the candidate log: doc_id, url, domain,
    fragment, reason, and ``place``, the order in which they came."""
    from ..functions import urls as U

    where = fragments.join(batched.select("batch_id", "slot", "doc_id"), ["batch_id", "slot"])
    place = F.col("batch_id") * 1_000_000_000 + F.col("slot") * 1_000_000 + F.col("pos")
    at = where.join(documents.select("doc_id", "url"), "doc_id")
    return at.select("doc_id", "url", U.raw_domain(U.netloc(F.col("url"))).alias("domain"), "fragment", "reason", place.alias("place"))


def ask_language(rows: DataFrame, ask: Callable[[str], str | None] | None = None, limit: int = 2000) -> DataFrame:
    """url, raw: the model's reply on the first ``limit`` characters of each text; null without a model or if it fails.

    Give it only rows that need one (disputed urls). One that gives None ran out of quota and isn't asked again in its
    partition.
    """

    def run(frames):
        spent = ask is None
        for f in frames:
            raw = []
            for text in f["text"]:
                got = None
                if not spent and isinstance(text, str) and text.strip():
                    try:
                        got = ask(text)
                        spent = got is None
                    except Exception:  # noqa: BLE001  any failure is no opinion
                        got = None
                raw.append(got)
            yield pd.DataFrame({"url": f["url"], "raw": pd.Series(raw, dtype=object)})

    return rows.select("url", F.substring("text", 1, limit).alias("text")).mapInPandas(run, "url string, raw string")


def _items(items: DataFrame) -> DataFrame:
    numbered_items = items.select("batch_id", "n", F.posexplode(F.expr("try_cast(_v as array<variant>)")).alias("item", "x"))
    id_ = F.expr("coalesce(try_variant_get(x, '$.id', 'bigint'), cast(try_variant_get(x, '$.id', 'boolean') as bigint))")
    kind = F.expr("schema_of_variant(try_variant_get(x, '$.id', 'variant'))")
    found = F.expr("try_variant_get(x, '$.candidates', 'variant')")
    return numbered_items.select("batch_id", "n", "item", kind.alias("kind"), F.when(kind.isin("BIGINT", "BOOLEAN"), id_).alias("id"), found.alias("candidates"), F.coalesce(F.expr("schema_of_variant(try_variant_get(x, '$.candidates', 'variant')) like 'ARRAY%'"), F.lit(False)).alias("is_list"))


def _candidates(last: DataFrame) -> DataFrame:
    rows = last.select("batch_id", F.col("id").alias("slot"), F.posexplode(F.expr("try_cast(candidates as array<variant>)")).alias("pos", "c"))
    fragment = F.expr("trim(try_variant_get(c, '$.fragment', 'string'))")
    return rows.select("batch_id", "slot", "pos", fragment.alias("fragment"), F.coalesce(F.expr("trim(try_variant_get(c, '$.reason', 'string'))"), F.lit("")).alias("reason")).where("fragment <> ''")


def language_reply(replies: DataFrame) -> DataFrame:
    """Adds reply_code and reply_confidence; both null where the reply is malformed or names no two-letter code."""
    v = f"try_parse_json(regexp_replace(trim(raw), r'{FENCE}', ''))"
    code = F.expr(f"lower(trim(try_variant_get({v}, '$.language_code', 'string')))")
    sure = F.expr(f"try_variant_get({v}, '$.confidence', 'double')")
    ok = F.coalesce(T.is_code(code), F.lit(False))
    kept = F.when(sure.isNull() | F.isnan(sure) | (sure < 0) | (sure > 1), F.lit(C.REPLY_CONFIDENCE)).otherwise(sure)
    return replies.withColumn("reply_code", F.when(ok, code)).withColumn("reply_confidence", F.when(ok, kept))


class Retry:
    """Calls a model with retries: other errors give up at once, quota errors wait and then try the next key."""

    def __init__(self, keys: list[str], call: Callable[[str, str], str], is_quota: Callable[[Exception], bool], sleep: Callable[[float], None], attempts: int = 3, wait: float = 5.0):
        self.keys, self.call, self.is_quota, self.sleep = list(dict.fromkeys(keys)), call, is_quota, sleep
        self.attempts, self.wait, self.at, self.exhausted = attempts, wait, 0, set()

    def __call__(self, prompt: str) -> str | None:
        while len(self.exhausted) < len(self.keys):
            key = self.keys[self.at]
            if key not in self.exhausted:
                for attempt in range(self.attempts):
                    try:
                        return self.call(key, prompt)
                    except Exception as error:  # noqa: BLE001
                        if not self.is_quota(error):
                            return None
                        if attempt + 1 < self.attempts:
                            self.sleep(self.wait * 2**attempt)
                self.exhausted.add(key)
            self.at = (self.at + 1) % len(self.keys)
        return None

    def reset(self) -> None:
        self.exhausted.clear()
