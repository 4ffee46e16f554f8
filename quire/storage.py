"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``.

A written table cuts lineage, survives the loss of executors (its files are on shared storage) and, unlike a checkpoint of
rows, is columnar and compressed. A result reads such tables when it is used, so they live until the session ends; a long
job uses its results within ``temporary_tables``, or calls ``drop_tables`` after each, to free the disk earlier.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset and the master is local (tests), a temporary folder is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes with ``drop_tables``."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and returns the written table."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def discard(table: DataFrame) -> None:
    """Deletes a table of ``shared_table`` that nothing will read any more: all that was made of it has been written."""
    _delete(table.sparkSession, table._shared_path)
    _made[:] = [x for x in _made if x[1] != table._shared_path]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def temporary_tables() -> Iterator[None]:
    """Deletes, at its end, the tables written within it; results must have been used by then."""
    before = len(_made)
    try:
        yield
    finally:
        drop_tables(before)


def drop_tables(keep: int = 0) -> None:
    """Deletes the tables written so far, but for the first ``keep``. Results that read them must have been used before."""
    while len(_made) > keep:
        spark, path = _made.pop()
        try:
            _delete(spark, path)
        except Exception:  # the session is gone; nothing is left to do
            pass


atexit.register(drop_tables)
