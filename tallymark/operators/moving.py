"""Moving frames and nearest values over plain rows, for keys that hold any share of them.

A window over a key brings all its rows into one task. Here the rows are range-partitioned by
(key, order) as in `ordered`, and a bucket gets what its frames need from its neighbours: for ROWS
frames the few rows next to it (a halo), for a value carried along one row. GROUPS frames are ROWS
frames over one row per peer group. A RANGE frame is the difference of two running totals, the
earlier of which is looked up as the last one before the frame, so its cost doesn't grow with the
width of the frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.operators.joins import null_safe_join, settled
from tallymark.operators.ordered import range_buckets, running_total_of_peers


def moving_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], before: int, after: int,
                columns: Callable[[Callable[[int, int], WindowSpec]], dict[str, Column]]) -> DataFrame:
    """Add columns over frames of rows of at most ``before`` rows back and ``after`` rows ahead.

    ``columns`` is given ``rows(start, end)``, a window over the rows of the same key (offsets as in
    ``rowsBetween``), and names the new columns. ``order`` is a total order up to rows that are alike.
    """
    placed = range_buckets(df, [*map(F.col, keys), *order])
    sizes = placed.groupBy("_bucket").agg(F.max("_pos").alias("_n"))
    so_far = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)  # one row per bucket, as all of `spans`
    end = F.sum("_n").over(so_far)
    spans = settled(sizes.select("_bucket", "_n", (end - F.col("_n")).alias("_start"), end.alias("_end")), "spans")
    numbered = placed.join(F.broadcast(spans), "_bucket").withColumn("_place", F.col("_start") + F.col("_pos"))
    rows = numbered.select(*df.columns, "_bucket", "_place", F.lit(False).alias("_halo"))

    def halo(sources: DataFrame, near: Column, needed: Column) -> DataFrame:
        """Rows of other buckets that a bucket's frames reach: at most ``before`` + ``after``."""
        pairs = sources.filter(F.col("_for").isNotNull()).select("_for", "_edge", F.explode("_from").alias("_bucket"))
        return numbered.filter(near).join(F.broadcast(pairs), "_bucket").filter(needed).select(
            *df.columns, F.col("_for").alias("_bucket"), "_place", F.lit(True).alias("_halo"))

    place, edge = F.col("_place"), F.col("_edge")
    if before:
        reach = F.collect_list("_bucket").over(W.orderBy("_end").rangeBetween(1 - before, 0))
        next_one = F.lead("_bucket").over(W.orderBy("_end"))
        rows = rows.unionByName(halo(
            spans.select(reach.alias("_from"), next_one.alias("_for"), F.col("_end").alias("_edge")),
            F.col("_pos") > F.col("_n") - before, place > edge - before))
    if after:
        reach = F.collect_list("_bucket").over(W.orderBy("_start").rangeBetween(0, after - 1))
        one_before = F.lag("_bucket").over(W.orderBy("_start"))
        rows = rows.unionByName(halo(
            spans.select(reach.alias("_from"), one_before.alias("_for"), F.col("_start").alias("_edge")),
            F.col("_pos") <= after, place <= edge + after))

    def frame(start: int, stop: int) -> WindowSpec:
        if start < -before or stop > after:
            raise ValueError(f"a frame from {start} to {stop} goes beyond {before} rows back and {after} ahead")
        return W.partitionBy("_bucket", *keys).orderBy("_place").rowsBetween(start, stop)

    new = columns(frame)
    return rows.select("*", *[c.alias(n) for n, c in new.items()]).filter(~F.col("_halo")).select(*df.columns, *new)


def moving_groups(df: DataFrame, keys: Sequence[str], peer: str, value: Column, start: int, end: int, name: str,
                  exclude_group: bool = False) -> DataFrame:
    """``sum(value) over (partition by keys order by peer groups between start and end)``.

    One row per (keys, peer) is left: rows of a peer group share the result. With ``exclude_group``
    the row's own group is left out of its frame (EXCLUDE GROUP); an empty frame gives NULL.
    """
    if start > end:
        raise ValueError("a frame that ends before it starts")
    groups = df.groupBy(*keys, peer).agg(F.sum(value).alias("_sum"))

    def total(frame: Callable[[int, int], WindowSpec]) -> dict[str, Column]:
        if not exclude_group or not start <= 0 <= end:
            return {name: F.sum("_sum").over(frame(start, end))}
        parts = [(a, b) for a, b in ((start, -1), (1, end)) if a <= b]
        sums = [F.sum("_sum").over(frame(a, b)) for a, b in parts]
        if not sums:
            return {name: F.lit(None).cast("bigint")}
        return {name: sums[0] if len(sums) == 1 else F.coalesce(sums[0] + sums[1], *sums)}

    moved = moving_rows(groups, keys, [F.col(peer)], max(0, -start), max(0, end), total)
    return moved.drop("_sum")


def carried(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, how: str, name: str) -> DataFrame:
    """A value carried along the rows of a key: ``how`` is last, min or max of the non-null values from
    the first row to the row itself. ``order`` is a total order up to rows that are alike.

    A bucket starts from what is known at its end by the buckets before it: a row per bucket and key,
    of which only a bucket's first key can have begun earlier.
    """
    if how not in ("last", "min", "max"):
        raise ValueError(f"nothing is known of carrying the {how}")
    placed = range_buckets(df.withColumn("_v", value), [*map(F.col, keys), *order])

    def over(column: str, window: WindowSpec) -> Column:
        return {"last": F.last(column, ignorenulls=True), "min": F.min(column), "max": F.max(column)}[how].over(window)

    newest = {"last": F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_pos"))),
              "min": F.min("_v"), "max": F.max("_v")}[how]
    ends = placed.groupBy(*keys, "_bucket").agg(newest.alias("_at_end"))
    earlier = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = ends.select(*keys, "_bucket", over("_at_end", earlier).alias("_carry")).filter("_carry is not null")
    here = W.partitionBy("_bucket", *keys).orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    local = placed.withColumn("_local", over("_v", here))
    joined = null_safe_join(local, F.broadcast(starts), [*keys, "_bucket"], "left")
    both = {"last": F.coalesce("_local", "_carry"), "min": F.least("_local", "_carry"),
            "max": F.greatest("_local", "_carry")}[how]
    return joined.select(*df.columns, both.alias(name))


def nearest_value(left: DataFrame, keys: Sequence[str], at: str, right: DataFrame, right_keys: Sequence[str],
                  right_at: str, name: str, direction: str = "later", allow_equal: bool = False) -> DataFrame:
    """``left LEFT JOIN right ON keys equal AND right_at > at`` with MIN(right_at), row by row.

    With ``direction`` earlier it is ``right_at < at`` with MAX; ``allow_equal`` takes >= or <=. Rows
    of both tables are put in one order and the last value of the right one is carried to the rows of
    the left: no pair of rows is formed. A null key or time finds nothing.
    """
    later = direction == "later"
    if direction not in ("later", "earlier"):
        raise ValueError(f"unknown direction {direction!r}")
    names = [f"_k{i}" for i in range(len(keys))]
    marks = right.select(*[F.col(k).alias(n) for k, n in zip(right_keys, names)], F.col(right_at).alias("_t"),
                         F.lit(1).alias("_mark")).dropna().distinct()
    rows = left.select("*", *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(at).alias("_t"),
                       F.lit(0).alias("_mark"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    when = F.col("_t").desc_nulls_last() if later else F.col("_t").asc_nulls_last()
    # among equal times the marks come first if they count, else last
    tie = F.col("_mark").desc() if allow_equal else F.col("_mark").asc()
    found = carried(both, names, [when, tie, *map(F.col, left.columns)],
                    F.when(F.col("_mark") == 1, F.col("_t")), "last", "_found")
    known = F.col("_t").isNotNull()
    for n in names:
        known &= F.col(n).isNotNull()
    return found.filter("_mark = 0").select(*left.columns, F.when(known, F.col("_found")).alias(name))


def range_total(df: DataFrame, keys: Sequence[str], at: str, value: Column, back: Column, name: str) -> DataFrame:
    """``sum(value) over (partition by keys order by at range between width preceding and current row)``.

    ``back`` is the start of a row's frame, such as ``at - interval``. One row per (keys, at) is left.
    """
    totals = running_total_of_peers(df, keys, at, value, "_total")
    peers = totals.withColumnsRenamed({k: f"_p{i}" for i, k in enumerate([*keys, at])})
    same = [f"_p{i}" for i in range(len(keys))]
    # the running total of the last peer before the frame, found as its row
    starts = totals.withColumn("_from", back)
    before = nearest_peer(starts, [*keys], "_from", peers, same, f"_p{len(keys)}")
    return before.select(*keys, at, (F.col("_total") - F.coalesce("_before", F.lit(0))).alias(name))


def nearest_peer(left: DataFrame, keys: Sequence[str], at: str, peers: DataFrame, peer_keys: Sequence[str],
                 peer_at: str) -> DataFrame:
    """The ``_total`` of the last peer strictly before ``at``, as ``_before``."""
    names = [f"_k{i}" for i in range(len(keys))]
    marks = peers.select(*[F.col(k).alias(n) for k, n in zip(peer_keys, names)], F.col(peer_at).alias("_t"),
                         F.col("_total").alias("_value"), F.lit(1).alias("_mark"))
    rows = left.select("*", *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(at).alias("_t"),
                       F.lit(0).alias("_mark"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    found = carried(both, names, [F.col("_t").asc_nulls_first(), F.col("_mark").asc()], F.col("_value"), "last", "_before")
    return found.filter("_mark = 0").select(*left.columns, "_before")
