"""Problem 10: long exact spans shared between records.

Super-k-mer partitioning. Every window of ``length`` characters within a line has a minimiser, the least hash
of its ``k``-character pieces; consecutive windows with the same minimiser form one super-k-mer, and equal
windows have equal minimisers, so all their copies meet in one bucket.

1. ``minimisers`` lists the super-k-mers of every document as positions. Minimisers met in one document only
   are dropped by a pre-aggregated count; only documents left over send text on.
2. Their super-k-mers travel as packed strings to the minimiser's bucket, equal strings as one. Strings of
   buckets with several strings are opened into window hashes, which are grouped (sorted) and counted exactly.
3. Windows with the same set of strings are told by the count and the sum of hashes of their members; one
   window per set is kept, so a long shared passage makes each link once, not once per window.

Windows are compared by 64-bit hash within their 64-bit minimiser. Null, empty and short texts have no windows.
Spans never cross a line feed; a carriage return before it is left out. Long lines are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from ._common import MASK, list_array, map_rows, mix64, pairs_within

LENGTH = 250
K = 128
BASE = 0x9E3779B97F4A7C15 | 1
#: Characters handled by one numpy call.
CHUNK = 1 << 20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64, for i < n or more."""
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _powers:
        up, down = np.full(size, BASE, dtype=np.uint64), np.full(size, pow(BASE, -1, MASK + 1), dtype=np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def piece_hashes(chars: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of ``k`` code points."""
    up, down = powers(len(chars))
    sums = np.zeros(len(chars) + 1, dtype=np.uint64)
    values = mix64(chars.astype(np.uint64) + np.uint64(0x51ED270B))
    values *= up[: len(chars)]
    np.cumsum(values, out=sums[1:])
    got = sums[k:] - sums[:-k]
    got *= down[: len(got)]
    return mix64(got)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values, in linear time (prefix and suffix minima of blocks of w)."""
    n = len(x)
    pad = -n % w
    blocks = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, w)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - w + 1], head[w - 1 : n])


def super_kmers(lines: list[np.ndarray], length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lines of at least ``length`` code points: line, first character, past the last one, minimiser."""
    sizes = np.array([len(x) for x in lines])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    least = sliding_min(piece_hashes(np.concatenate(lines), k), length - k + 1)
    line = np.repeat(np.arange(len(lines)), sizes)[: len(least)]
    place = np.arange(len(least)) - starts[line]
    inside = place + length <= sizes[line]
    least, line, place = least[inside], line[inside], place[inside]
    new = np.ones(len(least), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (line[1:] != line[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(least)) - 1
    return line[first], place[first], place[last] + length, least[first]


def minimisers(documents: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """Per document lists of equal length: line_no, head, tail, minimiser of every super-k-mer (``head`` from 0, ``tail``
    exclusive). A document of more than CHUNK characters may come in several rows."""

    def block(rows: dict) -> dict:
        ids: list[int] = []
        sizes: list[np.ndarray] = []
        out: dict[str, list] = {n: [] for n in ("line_no", "head", "tail", "minimiser")}
        lines: list[np.ndarray] = []
        where: list[tuple[int, int]] = []
        held = 0

        def flush() -> None:
            nonlocal lines, where, held
            if lines:
                line, head, tail, least = super_kmers(lines, length, k)
                of = np.array(where, dtype=np.int64)[line]
                row, count = np.unique(of[:, 0], return_counts=True)
                ids.extend(rows["doc_id"][r] for r in row)
                sizes.append(count)
                for name, x in zip(out, (of[:, 1].astype(np.int32), head.astype(np.int32), tail.astype(np.int32), least.view(np.int64))):
                    out[name].append(x)
            lines, where, held = [], [], 0

        for at, (key, text) in enumerate(zip(rows["doc_id"], rows["text"])):
            if key is None or not text or len(text) < length:
                continue
            for no, line in enumerate(text.split("\n"), 1):
                line = line[:-1] if line.endswith("\r") else line
                if len(line) >= length:
                    lines.append(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
                    where.append((at, no))
                    held += len(line)
                    if held > CHUNK:
                        flush()
        flush()
        if not ids:
            return None
        counts = np.concatenate(sizes)
        return {"doc_id": ids} | {n: list_array(np.concatenate(x), counts, pa.int64() if n == "minimiser" else pa.int32()) for n, x in out.items()}

    schema = "doc_id bigint, line_no array<int>, head array<int>, tail array<int>, minimiser array<bigint>"
    return map_rows(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), schema, block)


def packed(documents: DataFrame, length: int, k: int) -> DataFrame:
    """The super-k-mers whose minimiser stands in several documents, with their text: one row per place."""
    lists = cut(minimisers(documents, length, k))
    places = lists.select("doc_id", F.explode(F.arrays_zip("line_no", "head", "tail", "minimiser")).alias("p")).select("doc_id", "p.*")
    shared = places.groupBy("minimiser").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("minimiser")
    kept = places.join(shared, "minimiser", "left_semi").groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "head", "tail", "minimiser")).alias("places"))
    doc = documents.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def block(rows: dict) -> dict:
        out: dict[str, list] = {n: [] for n in ("minimiser", "doc_id", "line_no", "head", "span")}
        for key, text, places_ in zip(rows["doc_id"], rows["text"], rows["places"]):
            lines = text.split("\n")
            for p in places_:
                out["minimiser"].append(p["minimiser"])
                out["doc_id"].append(key)
                out["line_no"].append(p["line_no"])
                out["head"].append(p["head"])
                out["span"].append(lines[p["line_no"] - 1][p["head"] : p["tail"]])
        return out

    spans = map_rows(doc.join(kept, "doc_id"), "minimiser bigint, doc_id bigint, line_no int, head int, span string", block)
    return spans.withColumn("span_id", F.xxhash64("span"))


def opened(strings: DataFrame, length: int) -> DataFrame:
    """minimiser, span_id, at, window (hash) of each window of distinct strings."""

    def block(rows: dict) -> dict:
        chars = [np.frombuffer(x.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for x in rows["span"]]
        sizes = np.array([len(x) for x in chars])
        hashes = piece_hashes(np.concatenate(chars), length)
        counts = sizes - length + 1
        row = np.repeat(np.arange(len(sizes)), counts)
        at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return {
            "minimiser": pa.array(np.array(rows["minimiser"], dtype=np.int64)[row]),
            "span_id": pa.array(np.array(rows["span_id"], dtype=np.int64)[row]),
            "at": pa.array(at.astype(np.int32)),
            "window": pa.array(hashes[first[row] + at].view(np.int64)),
        }

    return map_rows(strings, "minimiser bigint, span_id bigint, at int, window bigint", block)


def _shared(documents: DataFrame, length: int, k: int) -> tuple[DataFrame, DataFrame]:
    """The places with text, cut from their lineage; the windows met in several distinct strings of a bucket."""
    places = cut(packed(documents, length, k))
    strings = places.groupBy("minimiser", "span_id").agg(F.first("span").alias("span"))
    several = strings.groupBy("minimiser").agg(F.min("span_id").alias("a"), F.max("span_id").alias("b")).where("a <> b").select("minimiser")
    windows = opened(strings.join(several, "minimiser", "left_semi").select("minimiser", "span_id", "span"), length)
    counted = windows.groupBy("minimiser", "window").agg(F.count("*").alias("n"), F.min("span_id").alias("a"), F.max("span_id").alias("b"), F.sum(F.xxhash64("span_id").cast("decimal(20,0)")).alias("members")).where("a <> b")
    return places, cut(windows.join(counted.drop("a", "b"), ["minimiser", "window"]))


def passages(documents: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """passage, doc_id: all shared spans as membership, without pairs. Documents share a span if they stand in one
    passage together; the same set of documents stands once."""
    places, windows = _shared(documents, length, k)
    chosen = windows.groupBy("minimiser", "n", "members").agg(F.min("window").alias("window"))
    rare = windows.join(chosen.select("minimiser", "window"), ["minimiser", "window"], "left_semi").select("minimiser", "window", "span_id").distinct()
    at = places.select("minimiser", "span_id", "doc_id").distinct()
    copies = at.select("minimiser", F.lit(None).cast("bigint").alias("window"), "span_id", "doc_id")
    meet = copies.unionByName(rare.join(at, ["minimiser", "span_id"]).select("minimiser", "window", F.lit(None).cast("bigint").alias("span_id"), "doc_id"))
    # The same set of documents meets again and again along a passage: one meeting per set goes on.
    keyed = meet.withColumn("passage", F.xxhash64("minimiser", "window", "span_id")).select("passage", "doc_id").distinct()
    sets = keyed.groupBy("passage").agg(F.count("*").alias("n"), F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("members")).where("n > 1")
    one = sets.groupBy("n", "members").agg(F.min("passage").alias("passage"))
    return keyed.join(one.select("passage"), "passage", "left_semi")


def shared_pairs(documents: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """doc_id_a < doc_id_b of all documents with an identical span of ``length`` characters within a line.

    The pairs of a passage in many documents are written slice by slice; ``passages`` says the same without them.
    """
    return pairs_within(cut(passages(documents, length, k)), "passage", "doc_id", "doc_id_a", "doc_id_b").distinct()


def shared_share(documents: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """Of every document: n_chars, shared_chars in windows that stand in another document too, shared_share."""
    places, windows = _shared(documents, length, k)
    several = places.groupBy("minimiser", "span_id").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("minimiser", "span_id")
    whole = places.join(several, ["minimiser", "span_id"], "left_semi").select("doc_id", "line_no", "head", (F.col("head") + F.length("span")).alias("tail"))
    # A window of several strings counts where those strings come from more than one document.
    seen = windows.select("minimiser", "window", "span_id", "at").join(places.select("minimiser", "span_id", "doc_id", "line_no", "head"), ["minimiser", "span_id"])
    docs = seen.groupBy("minimiser", "window").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("minimiser", "window")
    parts = seen.join(docs, ["minimiser", "window"], "left_semi").select("doc_id", "line_no", (F.col("head") + F.col("at")).alias("head"), (F.col("head") + F.col("at") + length).alias("tail"))
    order = Window.partitionBy("doc_id", "line_no").orderBy("head", "tail").rowsBetween(Window.unboundedPreceding, -1)
    spans = whole.unionByName(parts).distinct().withColumn("before", F.coalesce(F.max("tail").over(order), F.lit(0)))
    covered = spans.groupBy("doc_id").agg(F.sum(F.greatest(F.lit(0), F.col("tail") - F.greatest("head", "before"))).cast("bigint").alias("shared_chars"))
    base = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"))
    got = base.join(covered, "doc_id", "left").withColumn("shared_chars", F.coalesce("shared_chars", F.lit(0)))
    return got.withColumn("shared_share", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(F.lit(0.0)))


def found(documents: DataFrame) -> DataFrame:
    return shared_pairs(documents)
