"""Problem 7: lines repeated across one site's documents.

Lines are compared trimmed, in lower case and with runs of white space as one space. A line is over-repeated in
a source if it stands in at least ``least_docs`` of its documents and in at least ``least_share`` of them.

A pre-aggregated count of places drops lines that cannot reach the threshold (a line has at least as many places
as documents), so what goes on is at most 1 / least_share times the mean lines of a document, per source. Documents are
numbered densely, source by source, whatever their keys are. For each spelling of a line its documents are stored as a
compressed bitmap: per ``CHUNK`` numbers the list of the 64-bit words that aren't empty, with their places. As a line
that goes on stands in a twentieth of its source's documents or more, a bit takes 4 bytes or less. The bitmaps of a
line's spellings are united word by word, their exact cardinality is held against the threshold, and a place is deleted
if its document's bit is set. A hot line is split by its words.

Null sources are no source, null and blank lines no lines; rows with a null doc_id count for their source's
documents but have no bit. Repeated rows count once per doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import BLANKS, collapse, spaced
from ..operators.replies import numbered
from ..session import cut
from ._common import site_key

#: Document numbers of one bitmap row: 512 words.
CHUNK = 1 << 15


def normal(column: str) -> F.Column:
    """The compared form of a line."""
    return F.trim(collapse(F.lower(F.col(column))))


def lines(documents: DataFrame) -> DataFrame:
    """source, doc_id, line_no of each non-blank line, with the hashes of its spelling and its compared form.

    Whole texts are brought to the compared form and split beside the original, as a line's form, once exploded, would
    be computed anew for the filter and for each hash.
    """
    squeezed = F.regexp_replace(spaced(F.lower("text"), BLANKS.replace("\n", "")), "  +", " ")
    both = F.arrays_zip(F.split("text", "\n").alias("line"), F.split(squeezed, "\n").alias("form"))
    split = documents.where("source is not null and text is not null and text <> ''").select("source", F.col("doc_id").cast("bigint").alias("doc_id"), F.posexplode(both).alias("at", "x"))
    formed = split.selectExpr("source", "doc_id", "at + 1 as line_no", "x.line", "trim(x.form) as form").where("form <> ''")
    return formed.selectExpr("source", "doc_id", "line_no", "xxhash64(line) as spelling", "xxhash64(form) as h1", "xxhash64(form, 7) as h2")


def document_numbers(documents: DataFrame) -> DataFrame:
    """source, doc_id, number: dense over all documents in order of source and key."""
    keys = documents.where("source is not null and doc_id is not null").select("source", F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    return numbered(keys, ["source", "doc_id"], "number").select("source", "doc_id", "number")


def pack(words: DataFrame, *keys: str) -> DataFrame:
    """Rows of (keys, word, bits) as bitmaps: keys, chunk, docs (the words that aren't empty, with their places)."""
    per = F.lit(CHUNK // 64)
    return words.groupBy(*keys, F.floor(F.col("word") / per).alias("chunk")).agg(F.collect_list(F.struct((F.col("word") % per).cast("smallint").alias("at"), "bits")).alias("docs"))


def unpack(bitmaps: DataFrame, *keys: str) -> DataFrame:
    return bitmaps.select(*keys, "chunk", F.explode("docs").alias("w")).select(*keys, (F.col("chunk") * (CHUNK // 64) + F.col("w.at")).alias("word"), "w.bits")


def repeated_places(documents: DataFrame, least_docs: int = 4, least_share: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """The places of lines that may be over-repeated, and the bitmaps of those that are.

    The first has source, doc_id, number, line_no, spelling, h1, h2, needed; the second source, h1, h2, chunk, docs and
    n_docs (of the whole line).
    """
    sizes = documents.where("source is not null").groupBy("source").agg(F.count("*").alias("n")).selectExpr("source", f"greatest({least_docs}, ceil(n * {least_share} - 1e-9)) as needed")
    all_lines = lines(documents)
    counted = all_lines.groupBy("source", "h1", "h2").agg(F.count("*").alias("places"))
    likely = cut(counted.join(sizes, "source").where("places >= needed").select("source", "h1", "h2", "needed"))
    places = all_lines.where("doc_id is not null").join(likely, ["source", "h1", "h2"])
    places = cut(places.join(document_numbers(documents), ["source", "doc_id"]))
    bit = F.expr("shiftleft(1L, cast(number % 64 as int))")
    keys = ("source", "h1", "h2", "needed")
    spelt = pack(places.groupBy(*keys, "spelling", F.floor(F.col("number") / 64).alias("word")).agg(F.bit_or(bit).alias("bits")), *keys, "spelling")
    united = cut(pack(unpack(spelt, *keys).groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits")), *keys))
    cardinality = F.aggregate("docs", F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w["bits"]))
    total = united.groupBy(*keys).agg(F.sum(cardinality).alias("n_docs")).where("n_docs >= needed").select("source", "h1", "h2", "n_docs")
    return places, united.join(total, ["source", "h1", "h2"]).select("source", "h1", "h2", "chunk", "docs", "n_docs")


def deletable(documents: DataFrame, least_docs: int = 4, least_share: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """(source, doc_id, line_no) of the lines to delete, by bitmap lookup; (source, h1, h2) of the repeated lines."""
    places, bitmaps = repeated_places(documents, least_docs, least_share)
    bitmaps = cut(bitmaps)
    words = unpack(bitmaps, "source", "h1", "h2")
    keyed = places.selectExpr("source", "h1", "h2", "doc_id", "line_no", "number div 64 as word", "cast(number % 64 as int) as bit")
    hit = keyed.join(words, ["source", "h1", "h2", "word"]).where(F.expr("getbit(bits, bit) = 1"))
    return hit.select("source", "doc_id", "line_no"), bitmaps.select("source", "h1", "h2").distinct()


def without_repeated_lines(documents: DataFrame, least_docs: int = 4, least_share: float = 0.05) -> DataFrame:
    """doc_id, source, text with the over-repeated lines taken out (other lines byte for byte), n_removed."""
    gone, _ = deletable(documents, least_docs, least_share)
    numbers = gone.groupBy("doc_id").agg(F.collect_set("line_no").alias("gone"))
    joined = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text").join(numbers, "doc_id", "left")
    kept = F.expr("array_join(transform(filter(transform(split(text, '\\n'), (x, i) -> struct(x as line, i + 1 as no)), p -> not array_contains(gone, p.no)), p -> p.line), '\\n')")
    return joined.select("doc_id", "source", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"))


def found(documents: DataFrame, candidates: DataFrame) -> DataFrame:
    gone, repeated = deletable(documents)
    of_docs = gone.selectExpr("'document' as record_kind", "doc_id as record_id", "line_no").distinct()
    shaped = candidates.where("domain is not null and fragment is not null").select(F.col("candidate_id").cast("bigint").alias("record_id"), site_key("domain").alias("source"), normal("fragment").alias("form")).where("form <> ''")
    hashed = shaped.selectExpr("record_id", "source", "xxhash64(form) as h1", "xxhash64(form, 7) as h2")
    of_candidates = hashed.join(repeated, ["source", "h1", "h2"], "left_semi").selectExpr("'candidate' as record_kind", "record_id", "0 as line_no").distinct()
    return of_docs.unionByName(of_candidates)
