"""Window frames Spark's grammar has no words for, on top of those it has.

They are meant for rows that are already aggregated, where a partition is bounded by the
number of periods or categories in it; see ``ordered`` for partitions without a bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.operators.joins import null_safe_join


def with_group_ordinal(df: DataFrame, keys: Sequence[str], order: Column,
                       name: str = "_group") -> DataFrame:
    """Number the peer groups 1, 2, ...; a GROUPS frame is a RANGE frame on this number."""
    return df.withColumn(name, F.dense_rank().over(W.partitionBy(*keys).orderBy(order)))


def groups_frame(df: DataFrame, keys: Sequence[str], order: Column, value: Column, start: int,
                 end: int, name: str) -> DataFrame:
    """``sum(value) over (... groups between start and end)``, offsets in peer groups.

    EXCLUDE GROUP is the same with a frame that leaves out offset 0.
    """
    numbered = with_group_ordinal(df, keys, order)
    frame = W.partitionBy(*keys).orderBy("_group").rangeBetween(start, end)
    return numbered.withColumn(name, F.sum(value).over(frame)).drop("_group")


def with_group_total(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """``sum(value) over (partition by keys)`` as an aggregate joined back.

    The sums are combined on the map side and the join can be split when a key is hot; a
    window would bring the whole group into one task.
    """
    totals = df.groupBy(*keys).agg(F.sum(value).alias(name))
    return null_safe_join(df, totals, keys)


def latest_per_group(df: DataFrame, keys: Sequence[str], when: str) -> DataFrame:
    """Rows of the newest ``when`` of each group, ties kept; pruned before the shuffle."""
    w = W.partitionBy(*keys).orderBy(F.col(when).desc())
    return df.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def first_duplicate(df: DataFrame, keys: Sequence[str], value: str, position: str) -> DataFrame:
    """Per group the value whose second occurrence comes first; -1 where nothing repeats.

    At most two rows of a value leave an input partition, however often it occurs.
    """
    w = W.partitionBy(*keys, value).orderBy(position)
    seconds = df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= 2)
    second = F.when(F.col("_n") == 2, F.col(position))
    found = F.min_by(F.when(F.col("_n") == 2, F.col(value)), second)
    return seconds.groupBy(*keys).agg(F.coalesce(found, F.lit(-1)).alias("first_duplicate"))
