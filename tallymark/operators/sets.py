"""Set operations that keep an order or count lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators.bitmaps import in_all, numbers_of, to_bitmaps


def distinct_keep_order(df: DataFrame, value: str, position: str) -> DataFrame:
    """Each value once, with the place where it was first seen."""
    return df.groupBy(value).agg(F.min(position).alias("first_pos"))


def in_all_lists(members: DataFrame, item: str, list_name: str, lists: int) -> DataFrame:
    """Items (whole numbers) that are a member of each of ``lists`` lists."""
    sets = to_bitmaps(members, [list_name], item)
    return numbers_of(in_all(sets, [], F.lit(lists)), item)
