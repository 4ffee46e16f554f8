"""External calls (models, services) as a slot that gives a payload or an error for each row, and logs."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def call(df: DataFrame, inputs: str, fn: Callable[[str], str], payload: str = "payload", error: str = "error") -> DataFrame:
    """df with the answer of fn to the column ``inputs``, or the error it raised (500 characters at most); null asks nothing.

    Rows are answered independently, as parallel as the partitions; what order they had is kept by their own columns.
    """
    result = T.StructType().add("payload", T.StringType()).add("error", T.StringType())

    @F.pandas_udf(result)
    def ask(s: pd.Series) -> pd.DataFrame:
        out = []
        for v in s.tolist():
            try:
                out.append((None if v is None else fn(v), None))
            except Exception as e:  # one row's failure must not end the others
                out.append((None, f"{type(e).__name__}: {e}"[:500]))
        return pd.DataFrame(out, columns=["payload", "error"])

    return df.withColumn("__r", ask(F.col(inputs))).withColumns({payload: F.col("__r.payload"), error: F.col("__r.error")}).drop("__r")


PATTERN = r"(?i)error|traceback|memory"


def excerpt(lines: DataFrame, pattern: str = PATTERN) -> DataFrame:
    """line, times of the distinct lines (column value) that match a pattern, outer blanks aside."""
    return lines.where(F.col("value").rlike(pattern)).groupBy(F.trim("value").alias("line")).agg(F.count("*").alias("times"))


def log_excerpt(spark: SparkSession, path: str, pattern: str = PATTERN) -> DataFrame:
    """``excerpt`` of text logs."""
    return excerpt(spark.read.text(path), pattern)
