"""All core queries by name, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.operators import diff, nested_tables
from quire.plans import item_queries, stream_queries, table_queries, text_queries
from quire.sources.tables import table

MODULES = (text_queries, table_queries, item_queries, stream_queries)
Query = Callable[[SparkSession, str], DataFrame]


def _p2_found(spark: SparkSession, d: str) -> DataFrame:
    return diff.engine_differences(table(spark, d, "regions"), table(spark, d, "region_conflicts"))


def _p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nested_tables.damage_rows(nested_tables.effect_sources(table(spark, d, "race_traits"), table(spark, d, "extractions")))


def _p6_table(tag: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return nested_tables.stored_tables(nested_tables.effect_sources(table(spark, d, "race_traits"), table(spark, d, "extractions")))[tag]

    return run


def queries() -> dict[str, Query]:
    own = {"p2_found": _p2_found, "p6_found": _p6_found, "p6_effects": _p6_table("effect"), "p6_damage": _p6_table("damage"), "p6_abilities": _p6_table("ability"), "p6_skills": _p6_table("skill"), "p6_errors": _p6_table("error")}
    return {**own, **{k: v for m in MODULES for k, v in m.Q.items()}}


def oracle_sql() -> dict[str, str]:
    return {"p2_found": diff.P2_SQL, "p6_found": nested_tables.P6_SQL, **{k: v for m in MODULES for k, v in m.SQL.items()}}
