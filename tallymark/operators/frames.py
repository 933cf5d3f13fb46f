"""Data-frame jobs: slices, fills, descriptions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.joins import null_safe_join
from tallymark.operators.ordered import exact_quantiles, global_row_number

def row_slice(df: DataFrame, order: Sequence[Column], start: int = 0, stop: int | None = None,
              step: int = 1) -> DataFrame:
    """0-based rows start, start+step, ... below ``stop`` of the ordered rows.

    Rows after ``stop`` are cut off first; what is left is numbered range-partitioned.
    """
    numbered = global_row_number(df if stop is None else df.orderBy(*order).limit(stop), order)
    place = F.col("row_num") - 1
    return numbered.filter((place >= start) & ((place - start) % step == 0)).withColumn(
        "row_num", place)


def exact_mean(column: str | Column) -> Column:
    """Mean of whole numbers: the sum is exact, so no order of rows changes the result."""
    return F.sum(column) / F.count(column)


def fill_with(df: DataFrame, column: str, statistic: Column) -> DataFrame:
    """NULLs of ``column`` replaced by one statistic of the whole column."""
    return df.withColumn(column, F.coalesce(F.col(column), df.agg(statistic).scalar()))


def describe(df: DataFrame, keys: Sequence[str], value: str,
             quantiles: dict[str, float]) -> DataFrame:
    """count, mean, sample deviation, min, exact quantiles and max, also per group."""
    only = [*keys] or ["_all"]
    base = df if keys else df.withColumn("_all", F.lit(0))
    stats = base.groupBy(*only).agg(
        F.count(value).alias("count"), F.round(F.avg(value), 4).alias("mean"),
        F.round(F.stddev_samp(value), 4).alias("std"), F.min(value).alias("min"),
        F.max(value).alias("max"))
    points = exact_quantiles(base, only, value, quantiles)
    return null_safe_join(stats, points, only, "left").select(
        *keys, "count", "mean", "std", "min", *quantiles, "max")


#: Ranges that an interval of values is cut into at a scan.
RANGES = 1024


def describe_frame(df: DataFrame, columns: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    """A row per numeric column: count, mean, sample deviation, min, exact quantiles and max.

    One scan takes the plain figures of all columns. The quantiles of all columns are found together
    by selection: a scan counts the rows in RANGES ranges of the interval that holds a wanted rank, and
    keeps the least and greatest value of each; the range with the rank is the next interval, until it
    is one value. So a scan narrows every interval by a factor of RANGES or to the values there are, no
    column is sorted or written, and what reaches the driver are RANGES counts per interval. NULL and
    NaN are left out.
    """
    spark = df.sparkSession
    values = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    first = df.agg(*[agg.alias(f"{name}_{i}") for i, v in enumerate(values.values()) for name, agg in (
        ("n", F.count(v)), ("mean", F.avg(v)), ("std", F.stddev_samp(v)), ("min", F.min(v)), ("max", F.max(v)))]).first()
    plain = [{name: first[f"{name}_{i}"] for name in ("n", "mean", "std", "min", "max")} for i in range(len(columns))]

    # (column, rank) -> the interval of values that holds it, and how many rows lie below that
    open_, found = {}, {}
    for i, figures in enumerate(plain):
        for p in quantiles.values():
            if figures["n"]:
                spot = (figures["n"] - 1) * p
                for rank in {math.floor(spot), math.ceil(spot)}:
                    open_[i, rank] = (figures["min"], figures["max"], 0)
    while open_:
        for key, (low, high, _) in list(open_.items()):
            if low == high:
                found[key] = low
                del open_[key]
        intervals = sorted({(i, low, high) for (i, _), (low, high, _) in open_.items()})
        if not intervals:
            break
        places = []
        for number, (i, low, high) in enumerate(intervals):
            v = list(values.values())[i]
            part = F.least(F.floor((v - F.lit(low)) / F.lit((high - low) / RANGES)), F.lit(RANGES - 1))
            places.append(F.when((v >= low) & (v <= high), F.struct(
                F.lit(number).alias("interval"), part.cast("int").alias("part"), v.alias("v"))))
        counted = (
            df.select(F.explode(F.filter(F.array(*places), lambda x: x.isNotNull())).alias("x"))
            .groupBy("x.interval", "x.part").agg(F.count("*").alias("n"), F.min("x.v").alias("low"), F.max("x.v").alias("high"))
            .collect())  # at most RANGES rows per interval
        parts: dict[int, list] = {}
        for row in sorted(counted, key=lambda r: (r["interval"], r["part"])):
            parts.setdefault(row["interval"], []).append(row)
        for (i, rank), (low, high, below) in list(open_.items()):
            for row in parts[intervals.index((i, low, high))]:
                if rank < below + row["n"]:
                    open_[i, rank] = (row["low"], row["high"], below)
                    break
                below += row["n"]

    rows = []
    for i, (c, figures) in enumerate(zip(columns, plain)):
        points = []
        for p in quantiles.values():
            spot = (figures["n"] - 1) * p
            low, high = (found.get((i, rank)) for rank in (math.floor(spot), math.ceil(spot)))
            points.append(None if low is None else low + (high - low) * (spot - math.floor(spot)))
        rows.append((c, figures["n"], figures["mean"], figures["std"], figures["min"], *points, figures["max"]))
    kinds = "".join(f"`{q}` double, " for q in quantiles)
    return spark.createDataFrame(rows, f"column_name string, count bigint, mean double, std double, min double, {kinds}max double")


def row_extreme_flags(df: DataFrame, column: str) -> DataFrame:
    """Mark the rows that hold the largest and the smallest value of a column."""
    ends = df.agg(F.struct(F.max(column).alias("hi"), F.min(column).alias("lo"))).scalar()
    return df.withColumns({"is_max": F.col(column) == ends.getField("hi"),
                           "is_min": F.col(column) == ends.getField("lo")})
