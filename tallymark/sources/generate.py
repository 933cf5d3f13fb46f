"""Relations made of numbers: series, evenly spaced points, seeded random columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def inline_values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal relation with stated types."""
    return spark.createDataFrame(list(rows), schema)


def series(spark: SparkSession, start: int, stop: int, step: int = 1, name: str = "x") -> DataFrame:
    """start, start+step, ... up to and including ``stop``."""
    return spark.range(start, stop + (1 if step > 0 else -1), step).withColumnRenamed("id", name)


def linspace(spark: SparkSession, start: float, stop: float, n: int, endpoint: bool = True) -> DataFrame:
    """``n`` evenly spaced points; the last is ``stop`` only with ``endpoint``."""
    gaps = max(n - 1, 1) if endpoint else n
    step = (stop - start) / gaps
    x = F.lit(float(start)) + F.col("id") * F.lit(step)
    if endpoint and n > 1:
        x = F.when(F.col("id") == n - 1, F.lit(float(stop))).otherwise(x)
    return spark.range(n).select(F.col("id").alias("i"), x.alias("x"))


def uniform(seed: str, *key: str | Column) -> Column:
    """Uniform in [0, 1) from the row's key, so that a retried or moved row keeps its number."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(seed), *key)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def normal(seed: str, *key: str | Column) -> Column:
    """Standard normal by the Box-Muller transform of two uniforms."""
    u = F.lit(1.0) - uniform(seed + "u", *key)
    v = uniform(seed + "v", *key)
    return F.sqrt(F.lit(-2.0) * F.ln(u)) * F.cos(F.lit(2 * math.pi) * v)
