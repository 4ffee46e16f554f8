"""Sinks: JSON envelopes and one-row corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_definitions(df: DataFrame, path: str, errors: str = "errors") -> None:
    """Writes definitions as JSON lines, those with errors beside the valid ones under ``invalid=true``."""
    flagged = df.withColumn("invalid", F.coalesce(F.length(errors) > 0, F.lit(False)))
    flagged.write.mode("overwrite").partitionBy("invalid").json(path)


def write_corrections(df: DataFrame, path: str) -> None:
    """Appends corrections (doc_id, field_path, new_value) as JSON lines."""
    df.select("doc_id", "field_path", "new_value").write.mode("append").json(path)


METRICS = "array<struct<field: string, n: long, tp: long, fp: long, fn: long, precision: double, recall: double, exact: double>>"


def write_runs(metrics: DataFrame, finished: DataFrame, path: str) -> None:
    """Appends runs as JSON lines: run, finished_at, metrics (one entry for each field). metrics: run, field and numbers; finished: run,
    finished_at (null while a run goes on)."""
    entries = metrics.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("field", "n", "tp", "fp", "fn", "precision", "recall", "exact"))).alias("metrics"))
    finished.join(entries, "run", "left").write.mode("append").option("ignoreNullFields", "false").json(path)


def last_run(spark: SparkSession, path: str) -> DataFrame:
    """The finished run with the largest number: run, metrics; no row where none has finished."""
    runs = spark.read.schema(f"run long, finished_at string, metrics {METRICS}").json(path).where("finished_at is not null")
    return runs.agg(F.max_by(F.struct("run", "metrics"), "run").alias("r")).where("r is not null").select("r.*")
