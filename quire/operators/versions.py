"""Versions, upserts and resumption on append-only tables: all are aggregations with partial combination, or anti-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the largest order (nulls first); ties give either row of equal order."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*")


def keep_first(df: DataFrame, key: list[str], order: list[str], replaced: list[str]) -> DataFrame:
    """Insert, on conflict replace only ``replaced``: the first row of each key with the last values of these columns."""
    rest = [c for c in df.columns if c not in key and c not in replaced]
    o = F.struct(*order)
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), o).alias("r"), *[F.max_by(c, o).alias(c) for c in replaced]).select(*key, "r.*", *replaced)


def coalesced(df: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Upsert by COALESCE(new, old): the last non-null value of each column."""
    o = ", ".join(order)
    return df.groupBy(*key).agg(*[F.expr(f"max_by({c}, struct({o})) filter (where {c} is not null)").alias(c) for c in columns])


def replace_partition(base: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """base with every partition (values of key) that occurs in batch replaced by batch's rows."""
    return base.join(batch.select(*key).distinct(), key, "left_anti").unionByName(batch)


def write_partitions(batch: DataFrame, path: str, key: list[str]) -> None:
    """The same as a sink: dynamic overwrite of the partitions that batch has, committed as a whole."""
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*key).parquet(path)


def corrected(df: DataFrame, key: list[str], corrections: DataFrame) -> DataFrame:
    """One new version for each correction (key, new_value): attempt one above the largest, validated with high confidence."""
    top = df.join(corrections.select(*key).distinct(), key, "left_semi").groupBy(*key).agg(F.max("attempt").alias("attempt"))
    return corrections.join(top, key, "left").select(*key, (F.coalesce("attempt", F.lit(0)) + 1).alias("attempt"), F.col("new_value").alias("value_json"), F.lit("validated").alias("status"), F.lit("high").alias("confidence"))


def remaining(todo: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """What is left to do after an interruption."""
    return todo.join(done.select(*key).distinct(), key, "left_anti")


def metadata_path(c: Column) -> Column:
    return c.contains("$")
