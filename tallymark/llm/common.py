"""Helpers of the training-data operators."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tallymark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)
CACHE = 1_000_000  # words whose figures a Python worker remembers before it starts afresh

_REMEMBERED: list[dict] = []


def remembered(cache: dict) -> dict:
    """Names a dict in which a Python worker keeps figures of words for the rows to come."""
    _REMEMBERED.append(cache)
    return cache


def forget_others(own: dict | None = None) -> None:
    """Empties the caches of other operators: workers are used again for the next one's tasks."""
    for cache in _REMEMBERED:
        if cache is not own:
            cache.clear()


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/documents.parquet")
