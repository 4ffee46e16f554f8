"""Session defaults and settings."""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import Any

from pyspark.sql import SparkSession


def build_session(app: str = "quire", master: str | None = None, shuffle_partitions: int | None = None, **conf: Any) -> SparkSession:
    """A session with UTC, adaptive execution and Arrow. Cluster settings given from outside win over these."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@dataclass(frozen=True)
class Settings:
    """Thresholds of the extraction pipeline; ``from_session`` reads ``quire.<name>`` from the session over these."""

    iou_min: float = 0.5
    text_accept: float = 0.95
    grounding_min: int = 90
    anchor_min: int = 90
    localise_min: int = 80
    conflict_rate_warn: float = 0.05
    max_retries: int = 2
    window_chars: int = 8000  # a window of pages, by characters
    window_tokens: int = 13056  # a window of the enumeration: a context of 16,384 less 2,048 for the answer and 1,280 for the task
    block_chars: int = 2000  # a block of a page
    span_chars: int = 6000  # an item's span
    table_chars: int = 8000  # the tables beside an item's span
    page_table_chars: int = 400  # the tables of a page on their own
    fields_per_task: int = 8

    @classmethod
    def from_session(cls, spark: SparkSession) -> Settings:
        found = {}
        for f in fields(cls):
            raw = spark.conf.get(f"quire.{f.name}", None)
            if raw is not None:
                found[f.name] = type(f.default)(raw)
        return cls(**found)
