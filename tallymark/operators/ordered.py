"""Ordered operators without an ordered single task.

A window without PARTITION BY, or with one huge partition, runs in one task. Here the
rows are range-partitioned by the whole order instead, so even a key that holds most of
the rows is spread over many buckets; each bucket is numbered or summed on its own and
what came before it is added from a table of at most one row per bucket.

``order`` must be a total order up to rows that are alike in every output column. Then a
lost executor cannot change a result. The buckets are written to a table in the shared
folder, because both the rows and the per-bucket totals are read from them and must see
the same buckets; the totals then read only the columns they need.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.operators.joins import null_safe_join
from tallymark.session import scratch_path

ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row position in 33 bits


def range_buckets(df: DataFrame, order: Sequence[Column], buckets: int | None = None) -> DataFrame:
    """Add ``_bucket`` (range partition in ``order``) and ``_pos`` (1-based place in it).

    Without a number of buckets it is spark.sql.shuffle.partitions, and adaptive execution
    joins neighbours that turn out small.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(buckets, *order) if buckets else df.repartitionByRange(*order)
    placed = (
        ranged.sortWithinPartitions(*order)
        .withColumn("_bucket", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)) + 1)
    )
    path = scratch_path(spark, "buckets")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_num") -> DataFrame:
    """``row_number() over (order by ...)`` for any number of rows."""
    placed = range_buckets(df, order)
    sizes = placed.groupBy("_bucket").agg(F.max("_pos").alias("_n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)  # one row per bucket
    starts = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_bucket")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_bucket", "_pos", "_start")
    )


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, name: str
) -> DataFrame:
    """``sum(value) over (partition by keys order by ... rows unbounded preceding)``."""
    placed = range_buckets(df.withColumn("_v", value), [*map(F.col, keys), *order])
    per_bucket = placed.groupBy(*keys, "_bucket").agg(F.sum("_v").alias("_s"))
    earlier = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    # Only the first key of a bucket can have begun in an earlier one: at most a row per bucket.
    carried = (
        per_bucket.select(*keys, "_bucket", F.sum("_s").over(earlier).alias("_carry"))
        .filter(F.col("_carry").isNotNull())
    )
    here = W.partitionBy("_bucket", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = placed.withColumn("_local", F.sum("_v").over(here)).alias("r")
    match = reduce(
        lambda a, b: a & b,
        [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_bucket"]],
    )
    total = F.coalesce(F.col("r._local"), F.lit(0)) + F.coalesce(F.col("c._carry"), F.lit(0))
    return (
        rows.join(F.broadcast(carried.alias("c")), match, "left")
        .select(*[F.col(f"r.{c}").alias(c) for c in df.columns], total.alias(name))
    )


def row_number_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "row_num"
) -> DataFrame:
    return running_total(df, keys, order, F.lit(1).cast("bigint"), name)


def running_total_of_peers(
    df: DataFrame, keys: Sequence[str], peer: str, value: Column, name: str
) -> DataFrame:
    """RANGE/GROUPS UNBOUNDED PRECEDING: rows with the same ``peer`` share one total.

    One row per (keys, peer) is left; join it back where the single rows are wanted.
    """
    peers = df.groupBy(*keys, peer).agg(F.sum(value).alias("_peer_sum"))
    return running_total(peers, keys, [F.col(peer)], F.col("_peer_sum"), name).drop("_peer_sum")


def rank_in_group(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "rnk", descending: bool = True
) -> DataFrame:
    """``rank()`` for groups of any size: rows of better value, plus one; NULL values come last
    in descending order and first in ascending, NULL keys are a group."""
    by = F.col(value).desc() if descending else F.col(value).asc()
    sizes = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_total(sizes, keys, [by], F.col("_n"), "_hi")
    ranks = ranks.select(*keys, value, (F.col("_hi") - F.col("_n") + 1).alias(name))
    return null_safe_join(df, ranks, [*keys, value])


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float]
) -> DataFrame:
    """Linear-interpolation quantiles from value counts; no group is held in one task.

    ``keys`` has at least one column; for a whole table that is a constant.
    """
    sizes = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = range_buckets(sizes, [*map(F.col, keys), F.col(value)])
    whole = W.partitionBy(*keys)
    so_far = whole.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    # A row per key and bucket: where the key's values of the bucket start and end.
    spans = placed.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_here")).select(
        *keys, "_bucket", (F.sum("_here").over(so_far) - F.col("_here")).alias("_before"),
        F.sum("_here").over(so_far).alias("_end"), F.sum("_here").over(whole).alias("_total"))

    def spot(p: float) -> Column:
        return (F.col("_total") - 1) * F.lit(p)

    places = [f(spot(p)) for p in probabilities.values() for f in (F.floor, F.ceil)]
    holds_one = reduce(
        lambda a, b: a | b, [(F.col("_before") <= at) & (at < F.col("_end")) for at in places])
    # Only buckets that hold a wanted place are looked into.
    looked_at = null_safe_join(placed, spans.filter(holds_one).drop("_end"), [*keys, "_bucket"])
    inside = W.partitionBy("_bucket", *keys).orderBy(value).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    values = looked_at.withColumn("_hi", F.col("_before") + F.sum("_n").over(inside))

    def at(index: Column) -> Column:
        here = (F.col("_hi") > index) & (F.col("_hi") - F.col("_n") <= index)
        return F.max(F.when(here, F.col(value).cast("double")))

    wanted, result = [], []
    for name, p in probabilities.items():
        wanted += [
            at(F.floor(spot(p))).alias(f"_lo_{name}"),
            at(F.ceil(spot(p))).alias(f"_hi_{name}"),
            F.max(spot(p) - F.floor(spot(p))).alias(f"_w_{name}"),
        ]
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        result.append((low + (high - low) * F.col(f"_w_{name}")).alias(name))
    return values.groupBy(*keys).agg(*wanted).select(*keys, *result)
