"""Queries of the training-text operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import spread, table
from . import p1_main_content, p2_near, p3_language, p4_residue, p5_repetition, p6_lookalikes, p7_site_lines, p8_encode, p9_mix, p10_spans
from ._common import fragments, texts

Query = Callable[[SparkSession, str], DataFrame]


#: Tables that grow; where one lies in fewer files than there are cores it is spread over them.
LARGE = ("documents", "scraped_urls")


def over(fn: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: fn(*(spread(table(spark, sf_dir, t)) if t in LARGE else table(spark, sf_dir, t) for t in tables))


def queries() -> dict[str, Query]:
    docs, candidates = "documents", "boilerplate_candidates"
    return {
        "p1_found": over(p1_main_content.found, docs),
        "p1_text": over(p1_main_content.main_content, docs),
        "p2_found": over(p2_near.found, docs, "scraped_urls"),
        "p2_links": over(p2_near.link_counts, docs),
        "p2_groups": over(p2_near.document_groups, docs),
        "p3_found": over(p3_language.found, docs, "language_samples"),
        "p3_segments": over(p3_language.detect, docs, "language_samples"),
        "p4_found": over(p4_residue.found, docs, candidates),
        "p5_found": over(p5_repetition.found, docs),
        "p5_profile": over(p5_repetition.repetition_profile, docs),
        "p5_repetitive": over(p5_repetition.repetitive, docs),
        "p6_found": over(p6_lookalikes.found, docs, candidates),
        "p6_findings": over(lambda d, c: p6_lookalikes.findings(texts(d)).unionByName(p6_lookalikes.findings(fragments(c))), docs, candidates),
        "p6_text": over(lambda d, c: p6_lookalikes.consistent(texts(d).unionByName(fragments(c))), docs, candidates),
        "p7_found": over(p7_site_lines.found, docs, candidates),
        "p7_text": over(p7_site_lines.without_repeated_lines, docs),
        "p8_ids": over(p8_encode.encode_documents, docs),
        "p9_mix": over(p9_mix.mix, docs, "mix_targets"),
        "p9_report": over(p9_mix.report, docs, "mix_targets"),
        "p9_texts": over(p9_mix.mixed_texts, docs, "mix_targets"),
        "p10_found": over(p10_spans.found, docs),
        "p10_passages": over(p10_spans.passages, docs),
        "p10_share": over(p10_spans.shared_share, docs),
    }
