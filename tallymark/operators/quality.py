"""Constraints as checks that return the rows breaking them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def primary_key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that repeat or have a missing part, with their number of rows."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.col("n") > 1) | any_null(key))


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that repeat; a missing value is never equal to another."""
    known = df.filter(~any_null(columns))
    return known.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def foreign_key_violations(child: DataFrame, columns: Sequence[str], parent: DataFrame,
                           parent_columns: Sequence[str]) -> DataFrame:
    """Child rows without a parent; a missing reference passes."""
    known = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_columns)])
    return child.filter(~any_null(columns)).join(known, [*columns], "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per required column with its number of missing values; one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def breaks(condition: Column) -> Column:
    """A CHECK is broken only where its condition is false; unknown passes."""
    return F.coalesce(~condition, F.lit(False))


def broken_rules(df: DataFrame, rules: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    """(kept columns, rule) for every CHECK a row breaks; all rules in one pass."""
    names = F.array_compact(F.array(*[F.when(breaks(c), F.lit(n)) for n, c in rules.items()]))
    return df.select(*keep, F.explode(names).alias("rule"))


def in_list(column: str, allowed: Sequence) -> Column:
    return F.col(column).isin(list(allowed))


def max_length(column: str, n: int) -> Column:
    return F.length(column) <= n


def adult_on(birth_date: str, day: str | Column) -> Column:
    """At least 18 years old on a day."""
    today = F.lit(day).cast("date") if isinstance(day, str) else day
    return F.col(birth_date) <= F.add_months(today, -12 * 18)
