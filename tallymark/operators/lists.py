"""Lists of a group's values, in chunks, so that no group has to fit in one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.ordered import row_number_in_group

CHUNK = 1000


def list_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str,
                name: str, chunk: int = CHUNK) -> DataFrame:
    """Per group its values in ``order``: arrays of ``chunk`` values numbered from 0.

    Most groups have the single chunk 0; a group with any number of rows has as many
    chunks as it needs, and their concatenation is the whole list.
    """
    placed = row_number_in_group(df, keys, order, "_n")
    whole = F.array_sort(F.collect_list(F.struct("_n", value)))
    return (
        placed.withColumn("chunk", F.floor((F.col("_n") - 1) / chunk))
        .groupBy(*keys, "chunk").agg(F.transform(whole, lambda s: s[value]).alias(name))
    )


def comma_lists(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str,
                name: str, chunk: int = CHUNK) -> DataFrame:
    chunks = list_chunks(df, keys, order, value, name, chunk)
    return chunks.withColumn(name, F.array_join(F.col(name).cast("array<string>"), ","))


def common_prefix(value: str | Column) -> Column:
    """Aggregate: longest common prefix of a group's strings.

    All strings share what the smallest and the largest share. '' for no common start.
    """
    low, high = F.min(value), F.max(value)
    short = F.least(F.length(low), F.length(high))
    halvings = F.sequence(F.lit(1), F.ceil(F.log2(short + 1)).cast("int") + 1)

    def halve(range_: Column, _: Column) -> Column:
        """The common start has at least `a` characters and at most `b`."""
        middle = F.ceil((range_["a"] + range_["b"]) / 2).cast("int")
        same = F.substr(low, F.lit(1), middle) == F.substr(high, F.lit(1), middle)
        return F.struct(F.when(same, middle).otherwise(range_["a"]).alias("a"),
                        F.when(same, range_["b"]).otherwise(F.greatest(middle - 1, range_["a"])).alias("b"))

    known = F.struct(F.lit(0).alias("a"), short.alias("b"))
    return F.coalesce(F.substr(low, F.lit(1), F.aggregate(halvings, known, halve)["a"]), F.lit(""))
