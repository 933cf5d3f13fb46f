"""Moving frames and nearest values against plain windows and joins, with one key holding most rows."""

import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.operators import moving
from tallymark.plans import QUERIES


@pytest.fixture(scope="module", autouse=True)
def many_buckets(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.fixture(scope="module", params=[4, 31])
def skewed(spark, request):
    """2,000 rows, or 60 of which many a bucket has fewer than a frame; key 0 holds nine tenths."""
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    n = 2000 if request.param == 4 else 60
    key = F.when(F.col("id") % 10 < 9, F.lit(0)).when(F.col("id") % 20 == 9, F.lit(None)).otherwise(F.col("id") % 7 + 1)
    yield spark.range(n).select(
        "id", key.cast("int").alias("k"), (F.col("id") * 7919 % 101).alias("t"),
        F.when(F.col("id") % 13 > 0, F.col("id") * 31 % 97).alias("v")).cache()
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("before, after", [(0, 0), (2, 1), (0, 3), (7, 0), (40, 40)])
def test_frames_of_rows(skewed, before, after):
    order = [F.col("t"), F.col("id")]
    ours = moving.moving_rows(skewed, ["k"], order, before, after, lambda frame: {
        "s": F.sum("v").over(frame(-before, after)), "n": F.count("*").over(frame(-before, 0)),
        "m": F.max("v").over(frame(0, after))})
    w = W.partitionBy("k").orderBy(*order)
    plain = skewed.select("*", F.sum("v").over(w.rowsBetween(-before, after)), F.count("*").over(w.rowsBetween(-before, 0)),
                          F.max("v").over(w.rowsBetween(0, after)))
    assert rows(ours) == rows(plain)


def test_frames_without_a_key_and_frames_too_wide(skewed):
    ours = moving.moving_rows(skewed, [], [F.col("id")], 1, 1, lambda frame: {"s": F.sum("v").over(frame(-1, 1))})
    plain = skewed.select("*", F.sum("v").over(W.orderBy("id").rowsBetween(-1, 1)))
    assert rows(ours) == rows(plain)
    with pytest.raises(ValueError):
        moving.moving_rows(skewed, [], [F.col("id")], 1, 1, lambda frame: {"s": F.sum("v").over(frame(-2, 1))})


@pytest.mark.parametrize("start, end, exclude", [(-2, 0, False), (-1, 2, False), (-1, 2, True), (0, 2, True), (-3, -1, True),
                                                 (0, 0, True), (1, 2, False), (-5, -4, False)])
def test_frames_of_groups(skewed, start, end, exclude):
    ours = moving.moving_groups(skewed, ["k"], "t", F.col("v"), start, end, "s", exclude)
    groups = skewed.groupBy("k", "t").agg(F.sum("v").alias("g"))
    w = W.partitionBy("k").orderBy("t")
    whole = groups.withColumn("n", F.row_number().over(w))
    near = whole.alias("a").join(whole.alias("b"), F.expr(
        f"a.k <=> b.k and b.n - a.n between {start} and {end}" + (" and b.n <> a.n" if exclude else "")), "left")
    plain = near.groupBy("a.k", "a.t").agg(F.sum("b.g"))
    assert rows(ours.select("k", "t", "s")) == rows(plain)


@pytest.mark.parametrize("width", [0, 1, 3, 50, 1000])
def test_totals_of_a_range(skewed, width):
    ours = moving.range_total(skewed, ["k"], "t", F.col("v"), F.col("t") - width, "s")
    w = W.partitionBy("k").orderBy("t").rangeBetween(-width, 0)
    plain = skewed.select("k", "t", F.coalesce(F.sum("v").over(w), F.lit(0))).distinct()
    assert rows(ours) == rows(plain)


@pytest.mark.parametrize("how", ["last", "min", "max"])
def test_a_value_is_carried_along(skewed, how):
    order = [F.col("t"), F.col("id")]
    value = F.when(F.col("id") % 9 == 0, F.col("v"))
    ours = moving.carried(skewed, ["k"], order, value, how, "c")
    w = W.partitionBy("k").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    plain = {"last": F.last(value, ignorenulls=True), "min": F.min(value), "max": F.max(value)}[how].over(w)
    assert rows(ours) == rows(skewed.select("*", plain))


@pytest.mark.parametrize("direction, equal", [("later", False), ("later", True), ("earlier", False), ("earlier", True)])
def test_the_nearest_value_of_another_table(spark, skewed, direction, equal):
    other = skewed.filter("id % 3 = 0").select((F.col("k") + 0).alias("rk"), (F.col("t") + 2).alias("rt")).union(
        spark.createDataFrame([(0, None), (None, 5), (99, 1)], "rk int, rt bigint"))
    left = skewed.union(spark.createDataFrame([(9999, 0, None, 1), (9998, 77, 5, 1)], skewed.schema))
    ours = moving.nearest_value(left, ["k"], "t", other, ["rk"], "rt", "found", direction, equal)
    sign = {"later": ">", "earlier": "<"}[direction] + ("=" if equal else "")
    joined = left.join(other, F.expr(f"k = rk and rt {sign} t"), "left")
    plain = joined.groupBy("id", "k", "t", "v").agg((F.min if direction == "later" else F.max)("rt"))
    assert rows(ours) == rows(plain)


@pytest.mark.parametrize("key", ["e06_moving_rows", "e11_conditional_frame", "e12_next_value", "c03_theta_self_left",
                                 "c03b_theta_left"])
def test_no_task_gets_all_rows_of_a_key(spark, key):
    frame = QUERIES[key](spark, "/root/testdata/sf0.001")
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\).*\n(.*)", text)
    # by the key alone go at most the one row per bucket and key of what is carried
    assert dealt and all("_bucket" in keys or "HashAggregate(keys=[_k0" in child for keys, child in dealt)
