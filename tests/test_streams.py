"""Streams over several batches, storage of intermediate tables, sinks."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from quire import storage
from quire.sources import sinks
from quire.streaming import ingest


def test_keys_of_later_batches(spark, tmp_path, rows):
    """A region that is delivered again, in its batch or a later one, is stored once; a repeated run stores nothing."""
    parts = [[(1, "a"), (2, "a"), (2, "a")], [(2, "again"), (3, "b")], [(1, "again"), (3, "again")]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, "region_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = ingest.read_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
        ingest.ingest(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), ["region_id"]).awaitTermination()
        assert i < 3
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("region_id", "text")) == [(1, "a"), (2, "a"), (3, "b")]


def test_latest_updates(spark, rows):
    df = spark.createDataFrame([("k", 1, 10, 0), ("k", 5, 20, 2), ("k", 3, 15, 1), ("l", 7, None, 1)], "key string, n int, total int, batch int")
    assert rows(ingest.latest_updates(df, ["key"])) == [("k", 5, 20), ("l", 7, None)]


def test_temporary_tables(spark):
    with storage.temporary_tables():
        t = storage.shared_table(spark.range(3), "t")
        path = Path(t.inputFiles()[0].removeprefix("file://")).parent
        assert t.count() == 3 and path.exists()
    assert not path.exists()


def test_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "bad")], "i int, errors string")
    sinks.write_definitions(df, str(tmp_path / "d"))
    assert rows(spark.read.schema("i int, invalid boolean").json(str(tmp_path / "d"))) == [(1, False), (2, False), (3, True)]
    fix = spark.createDataFrame([("d", "p", "1", "x")], "doc_id string, field_path string, new_value string, more string")
    for _ in range(2):
        sinks.write_corrections(fix, str(tmp_path / "c"))
    assert rows(spark.read.json(str(tmp_path / "c")).select("doc_id", "field_path", "new_value")) == [("d", "p", "1")] * 2
    assert spark.read.json(str(tmp_path / "c")).where(F.col("new_value").isNull()).count() == 0
