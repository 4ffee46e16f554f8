"""Queries that run a stream to its end, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.tables import table
from quire.storage import shared_dir
from quire.streaming import ingest

Q, SQL = {}, {}


def _stream(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.readStream.schema(table(s, d, name).schema).parquet(f"{d.rstrip('/')}/{name}.parquet*")


def _event_windows(s: SparkSession, d: str) -> DataFrame:
    """Hourly counts of the event stream. Each batch writes the windows it changed; state older than the watermark is dropped."""
    base = f"{shared_dir(s)}/stream-{uuid.uuid4().hex}"
    counts = ingest.windowed_counts(_stream(s, d, "events"), "ts", "event_type", "value")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/updates/batch={number}")

    run = counts.writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(keep).start()
    run.awaitTermination()
    last = ingest.latest_updates(s.read.parquet(f"{base}/updates"), ["start", "event_type"])
    return last.withColumns({"total": F.round("total", 4), "start": F.col("start").cast("timestamp_ntz")})


Q["stream_event_windows"] = _event_windows
SQL["stream_event_windows"] = "select date_trunc('hour', ts) as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all"


def _ingested(s: SparkSession, d: str) -> DataFrame:
    """Regions ingested exactly once, counted by engine."""
    base = f"{shared_dir(s)}/ingest-{uuid.uuid4().hex}"
    ingest.ingest(_stream(s, d, "regions"), f"{base}/table", f"{base}/checkpoint", ["region_id"]).awaitTermination()
    return s.read.parquet(f"{base}/table").groupBy("engine").agg(F.count("*").alias("n"))


Q["stream_ingest_regions"] = _ingested
SQL["stream_ingest_regions"] = "select engine, count(*) as n from regions group by engine"
