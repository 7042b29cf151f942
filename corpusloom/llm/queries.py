"""The queries of the corpus operators by name, and their SQL where SQL can state them on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import leakage, mixing, nearcopies, pairs, pieces, splitoverlap, subjects, truncation, visual
from .oracles import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": visual.p1_found,
    "p1_forms": visual.p1_forms,
    "p2_found": nearcopies.p2_found,
    "p2_groups": nearcopies.p2_groups,
    "p3_found": splitoverlap.p3_found,
    "p3_report": splitoverlap.p3_report,
    "p4_found": pieces.p4_found,
    "p4_pieces": pieces.p4_pieces,
    "p5_found": truncation.p5_found,
    "p5_lengths": truncation.p5_lengths,
    "p5_rates": truncation.p5_rates,
    "p6_found": pairs.p6_found,
    "p6_rates": pairs.p6_rates,
    "p7_found": leakage.p7_found,
    "p7_leaked_items": leakage.p7_leaked_items,
    "p7_clean_documents": leakage.p7_clean_documents,
    "p8_found": mixing.p8_found,
    "p8_mix": mixing.p8_mix,
    "p8_shares": mixing.p8_shares,
    "p9_found": subjects.p9_found,
    "p9_subjects": subjects.p9_subjects,
    "p9_composition": subjects.p9_composition,
}
