"""Join shapes that need more than ``df.join``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.session import scratch_path

KEY_BITS = 1 << 26


def densify(frame: DataFrame, facts: DataFrame, on: str, fill: dict[str, Column]) -> DataFrame:
    """``frame LEFT JOIN facts`` for a short ``frame`` (a calendar) and facts of any skew.

    An outer join could neither broadcast the preserved side nor split a hot fact key. So
    the facts are joined to the frame as an inner join, and the frame rows no fact has are
    added with the ``fill`` values.
    """
    columns = [on, *fill]
    matched = facts.join(frame.select(on), on, "left_semi").select(*columns)
    empty = frame.select(on).join(facts.select(on).distinct(), on, "left_anti")
    filled = empty.select(on, *[value.alias(name) for name, value in fill.items()])
    return matched.unionByName(filled)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the left side's keys stay."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_right_{k}" for k in keys])


def keep_keys(rows: DataFrame, on: str, keys: DataFrame, key: str) -> DataFrame:
    """Most of the rows whose key is not among ``keys`` left out, before any shuffle of ``rows``.

    The keys set bits in a map of KEY_BITS, which is broadcast: at most KEY_BITS / 64 rows of two
    numbers, however many keys there are. A key that shares its bit with another stays, so the
    join that follows decides; a NULL key goes.
    """
    place = F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(KEY_BITS))
    bits = (
        keys.filter(F.col(key).isNotNull()).select(place.alias("_bit"))
        .groupBy(F.expr("_bit div 64").alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("_bits"))
    )
    mine = F.pmod(F.xxhash64(F.col(on).cast("bigint")), F.lit(KEY_BITS))
    placed = rows.filter(F.col(on).isNotNull()).withColumn("_mine", mine)
    hit = (F.expr("_mine div 64") == F.col("_word")) & (
        F.getbit("_bits", (F.col("_mine") % 64).cast("int")) == 1)
    return placed.join(F.broadcast(bits), hit, "left_semi").drop("_mine")


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table, for a result expected to be a few rows of very many.

    The optimizer cannot guess that the leaders of a ranking are few and would shuffle the
    table their names are looked up in. Of a written table it knows the size, and it
    broadcasts it if that is below its threshold.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def earliest_pair_with_sum(df: DataFrame, keys: Sequence[str], value: str, position: str,
                           target: int) -> DataFrame:
    """Per group the pair of values adding up to ``target`` whose second member comes first.

    A value and its partner meet in the group of the smaller of the two, where only the
    first place of each matters; half of the target is its own partner and needs its two
    first places. So nothing is joined and no pairs of rows are formed. Groups without a
    pair are absent.
    """
    here, partner = F.col(value), target - F.col(value)
    low = F.least(here, partner)
    first_low = F.min(F.when(here < partner, F.col(position)))
    first_high = F.min(F.when(here > partner, F.col(position)))
    unequal = (
        df.filter(here != partner).groupBy(*keys, low.alias("_low"))
        .agg(first_low.alias("_l"), first_high.alias("_h"))
        .filter(F.col("_l").isNotNull() & F.col("_h").isNotNull())
    )
    low_first = F.col("_l") < F.col("_h")
    ordered = unequal.select(
        *keys,
        F.when(low_first, F.col("_low")).otherwise(target - F.col("_low")).alias("first_value"),
        F.when(low_first, target - F.col("_low")).otherwise(F.col("_low")).alias("second_value"),
        F.least("_l", "_h").alias("first_pos"), F.greatest("_l", "_h").alias("second_pos"))
    w = W.partitionBy(*keys).orderBy(position)
    halves = (
        df.filter(here == partner).withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= 2)
        .groupBy(*keys).agg(F.min(value).alias("first_value"), F.min(value).alias("second_value"),
                            F.min(position).alias("first_pos"), F.max(position).alias("second_pos"),
                            F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") == 2).drop("_n")
    )
    pairs = ordered.unionByName(halves)
    parts = ("first_value", "second_value", "first_pos", "second_pos")
    return pairs.groupBy(*keys).agg(F.min_by(F.struct(*parts), "second_pos").alias("_p")).select(*keys, "_p.*")
