"""Streams of regions and events: exactly-once ingestion and event-time counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet files of a folder as a stream, in bounded batches."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(path)


def ingest(stream: DataFrame, path: str, checkpoint: str, key: list[str]) -> StreamingQuery:
    """Appends a stream to a table, one folder for each batch, so that every key is stored once.

    A batch that is repeated after a failure overwrites its own folder. Repeated keys within a batch are one row; keys that the
    folders of earlier batches hold are left out by an anti join that reads their key columns only.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark, rows = batch.sparkSession, batch.dropDuplicates(key)
        if batch_id > 0 and _has(spark, path):
            earlier = spark.read.schema(T.StructType([*batch.select(*key).schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
            rows = rows.join(earlier.where(F.col("batch") < batch_id).select(*key), key, "left_anti")
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _has(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def latest_updates(updates: DataFrame, key: list[str]) -> DataFrame:
    """The last state of each key in the updates that a stream wrote with its batch number as ``batch``."""
    rest = [c for c in updates.columns if c not in (*key, "batch")]
    last = updates.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("last"))
    return last.select(*key, "last.*")


def windowed_counts(events: DataFrame, ts: str, kind: str, value: str, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums for each event-time window and kind; events later than ``late`` are dropped by the watermark."""
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))  # times without zone count in the session's
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")
