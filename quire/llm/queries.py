"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import consensus, format_copies, lookalikes, mixing, scan_noise, spans, split, tokens
from quire.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def _p1(spark: SparkSession, d: str) -> DataFrame:
    both = format_copies.inventory_cells(table(spark, d, "list_items")).unionByName(format_copies.trait_cells(table(spark, d, "race_traits")))
    return format_copies.collapse_copies(both)


def _p3_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.odd_rows(table(spark, d, "regions"), "regions", "region_id", "text").unionByName(lookalikes.odd_rows(table(spark, d, "extractions"), "extractions", "ext_id", "quote"))


def _p3_regions(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.consistent_text(table(spark, d, "regions").select("region_id", "text"), "text")


def _p3_text(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.consistent_rows(table(spark, d, "regions"), "regions", "region_id", "text").unionByName(lookalikes.consistent_rows(table(spark, d, "extractions"), "extractions", "ext_id", "quote"))


def _p4_found(spark: SparkSession, d: str) -> DataFrame:
    return split.oversized(table(spark, d, "pages"), "pages", "page_id", "full_text").unionByName(split.oversized(table(spark, d, "regions"), "regions", "region_id", "text"))


def _p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    a = split.pieces(table(spark, d, "pages"), "page_id", "full_text").withColumn("tbl", F.lit("pages"))
    return a.unionByName(split.pieces(table(spark, d, "regions"), "region_id", "text").withColumn("tbl", F.lit("regions")))


def _mix(spark: SparkSession, d: str, total: float | str | None = None) -> mixing.Mix:
    return mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"), total)


def queries() -> dict[str, Query]:
    return {
        "p1_found": lambda s, d: format_copies.copy_pairs(_p1(s, d)),
        "p1_counts": lambda s, d: format_copies.copy_counts(_p1(s, d)),
        "p1_inventory": lambda s, d: format_copies.copy_counts(format_copies.collapse_copies(format_copies.inventory_cells(table(s, d, "list_items")))),
        "p3_found": _p3_found,
        "p3_regions": _p3_regions,
        "p3_text": _p3_text,
        "p4_found": _p4_found,
        "p4_pieces": _p4_pieces,
        "p5_found": lambda s, d: scan_noise.noise_rows(table(s, d, "pages"), table(s, d, "regions")),
        "p5_repaired": lambda s, d: scan_noise.repaired(table(s, d, "pages"), table(s, d, "regions")),
        "p7_found": lambda s, d: consensus.doubtful(table(s, d, "worksheet"), table(s, d, "gold_traits")),
        "p7_labels": lambda s, d: consensus.consensus(consensus.worksheet_votes(table(s, d, "worksheet"))).labels,
        "p7_annotators": lambda s, d: consensus.consensus(consensus.worksheet_votes(table(s, d, "worksheet"))).annotators,
        "p8_ids": lambda s, d: tokens.token_ids(table(s, d, "documents"), "doc_id", "text"),
        "p8_ids_spread": lambda s, d: tokens.token_ids(table(s, d, "documents"), "doc_id", "text", spread=0),
        "p9_mix": lambda s, d: _mix(s, d).rows,
        "p9_mix_full": lambda s, d: _mix(s, d, 1e18).rows,
        "p9_budget": lambda s, d: _mix(s, d, "available").rows,
        "p9_budget_shares": lambda s, d: _mix(s, d, "available").shares,
        "p9_shares": lambda s, d: _mix(s, d).shares,
        "p10_found": lambda s, d: spans.shared_spans(table(s, d, "documents"), "doc_id", "text"),
        "p10_removed": lambda s, d: spans.spans_removed(table(s, d, "documents"), "doc_id", "text"),
        "p10_portions": lambda s, d: spans.shared_portions(table(s, d, "documents"), "doc_id", "text"),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": format_copies.FOUND_SQL,
        "p1_counts": format_copies.COUNTS_SQL,
        "p1_inventory": format_copies.INVENTORY_SQL,
        "p3_found": lookalikes.P3_SQL,
        "p4_found": split.P4_SQL,
        "p10_found": spans.FOUND_SQL,
        "p10_portions": spans.PORTIONS_SQL,
        "p10_removed": spans.REMOVED_SQL,
    }
