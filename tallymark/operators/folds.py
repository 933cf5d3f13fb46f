"""Order-dependent folds of a key's rows, for keys of any length.

A step x -> min(max(x + a, lo), hi) is described by (a, lo, hi), and two steps one after
the other are again such a step. So the rows are range-partitioned by (key, order), runs
of at most ``RUN`` rows are folded on their own, and the results are folded in turn: no
task ever holds all rows of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.ordered import range_buckets

RUN = 4096


def clamp(x: Column, lo: Column, hi: Column) -> Column:
    return F.least(F.greatest(x, lo), hi)


def compose(first: Column, then: Column) -> Column:
    """The step that does ``first`` and afterwards ``then``."""
    return F.struct(
        (first["a"] + then["a"]).alias("a"),
        clamp(first["lo"] + then["a"], then["lo"], then["hi"]).alias("lo"),
        clamp(first["hi"] + then["a"], then["lo"], then["hi"]).alias("hi"),
    )


def _fold_runs(df: DataFrame, keys: Sequence[str], place: str, identity: Column) -> DataFrame:
    """Compose the ``_step`` of the rows of each key in the order of ``place``."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), F.col("_step").alias("s"))))
    folded = F.aggregate(ordered, identity, lambda done, row: compose(done, row["s"]))
    return df.groupBy(*keys).agg(folded.alias("_step"))


def clamped_steps(df: DataFrame, keys: Sequence[str], order: Sequence[Column], delta: Column,
                  lo: int, hi: int) -> DataFrame:
    """Per key the one step (a, lo, hi) that all its rows amount to, in ``order``."""
    big = F.lit(lo).cast("bigint"), F.lit(hi).cast("bigint")
    step = F.struct(delta.cast("bigint").alias("a"), big[0].alias("lo"), big[1].alias("hi"))
    identity = F.struct(F.lit(0).cast("bigint").alias("a"), big[0].alias("lo"), big[1].alias("hi"))
    placed = range_buckets(df.withColumn("_step", step), [*map(F.col, keys), *order]).withColumn(
        "_run", F.floor(F.col("_pos") / RUN))
    runs = _fold_runs(placed, [*keys, "_bucket", "_run"], "_pos", identity)
    buckets = _fold_runs(runs, [*keys, "_bucket"], "_run", identity)
    return _fold_runs(buckets, keys, "_bucket", identity).select(*keys, "_step.*")


def apply_step(x: Column, prefix: str = "") -> Column:
    """A value after the step in the columns a, lo, hi."""
    return clamp(x + F.col(f"{prefix}a"), F.col(f"{prefix}lo"), F.col(f"{prefix}hi"))
