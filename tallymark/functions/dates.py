"""Calendar expressions and calendar relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MICROSECONDS_A_DAY = 86_400_000_000


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def quarter_end(day: Column) -> Column:
    return F.date_sub(F.add_months(quarter_start(day), 3), 1)


def days_between(start: Column, end: Column) -> Column:
    """Days with fractions, from timestamps without zone."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(MICROSECONDS_A_DAY)


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day of [first, last] with ISO week, day name, month and year."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("time_id")
    )
    return days.select(
        "time_id",
        F.weekofyear("time_id").alias("calendar_week_number"),
        F.date_format("time_id", "EEEE").alias("day_name"),
        F.month("time_id").alias("calendar_month_number"),
        F.year("time_id").alias("calendar_year"),
    )
