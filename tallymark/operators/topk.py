"""Top-k with ties, per group or overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_distinct_values(df: DataFrame, value: str, k: int) -> DataFrame:
    """Rows whose ``value`` is among the k highest distinct values.

    The k values are found by a distinct and a TakeOrdered, so they are at most k rows
    and may be broadcast; all ties stay, however many rows share a value.
    """
    best = df.select(value).distinct().orderBy(F.col(value).desc()).limit(k)
    return df.join(F.broadcast(best), value, "left_semi")


def top_rank(df: DataFrame, keys: Sequence[str], value: str, k: int, name: str = "rnk") -> DataFrame:
    """Rows with ``rank() <= k`` inside ``keys``.

    Spark drops rows beyond rank k on the map side (WindowGroupLimit), so only the
    leaders of every input partition are shuffled.
    """
    w = W.partitionBy(*keys).orderBy(F.col(value).desc())
    return df.withColumn(name, F.rank().over(w)).filter(F.col(name) <= k)
