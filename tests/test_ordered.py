"""The distributed ordered operators against plain windows, with one key holding most rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.operators import folds, lists, ordered, windows
from tallymark.operators.frames import row_slice


@pytest.fixture(scope="module", autouse=True)
def many_buckets(spark):
    """Small as the tests are, their buckets must not be joined into one."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 rows; key 0 holds nine tenths of them, a tenth of the keys is NULL."""
    key = F.when(F.col("id") % 10 < 9, F.lit(0)).when(F.col("id") % 20 == 9, F.lit(None)).otherwise(F.col("id") % 7 + 1)
    return spark.range(5000).select(
        "id", key.cast("int").alias("k"), (F.col("id") * 7919 % 101).alias("v")).cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_global_row_number(skewed):
    order = [F.col("v").desc(), F.col("id")]
    ours = ordered.global_row_number(skewed, order).select("id", "row_num")
    plain = skewed.select("id", F.row_number().over(W.orderBy(*order)).cast("bigint").alias("row_num"))
    assert rows(ours) == rows(plain)


def test_running_total_with_a_hot_and_a_null_key(skewed):
    order = [F.col("v"), F.col("id")]
    ours = ordered.running_total(skewed, ["k"], order, F.col("v"), "s").select("id", "s")
    w = W.partitionBy("k").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    assert rows(ours) == rows(skewed.select("id", F.sum("v").over(w).alias("s")))


def test_running_total_skips_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 1)], "i int, v int")
    out = ordered.running_total(df, [], [F.col("i")], F.col("v"), "s").select("i", "s")
    assert rows(out) == [(1, 0), (2, 5), (3, 5), (4, 6)]


def test_peers_share_a_total(skewed):
    ours = ordered.running_total_of_peers(skewed, ["k"], "v", F.col("v"), "s")
    w = W.partitionBy("k").orderBy("v").rangeBetween(W.unboundedPreceding, 0)
    plain = skewed.select("k", "v", F.sum("v").over(w).alias("s")).distinct()
    assert rows(ours) == rows(plain)


@pytest.mark.parametrize("descending", [True, False])
def test_rank(skewed, descending):
    known = skewed.filter(F.col("k").isNotNull())
    order = F.col("v").desc() if descending else F.col("v").asc()
    ours = ordered.rank_in_group(known, ["k"], "v", descending=descending).select("id", "rnk")
    plain = known.select("id", F.rank().over(W.partitionBy("k").orderBy(order)).cast("bigint"))
    assert rows(ours) == rows(plain)


def test_quantiles_are_exact(skewed):
    known = skewed.filter(F.col("k").isNotNull())
    points = {"q1": 0.25, "q2": 0.5, "q9": 0.9}
    ours = ordered.exact_quantiles(known, ["k"], "v", points)
    plain = known.groupBy("k").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in points.items()])
    for a, b in zip(rows(ours), rows(plain)):
        assert a == pytest.approx(b)


def test_one_key_is_spread_over_buckets(skewed):
    placed = ordered.range_buckets(skewed, [F.col("k"), F.col("v"), F.col("id")], 8)
    sizes = [r["count"] for r in placed.groupBy("_bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 5000 / 8


def test_list_chunks_are_bounded_and_whole(skewed):
    out = lists.list_chunks(skewed, ["k"], [F.col("id")], "id", "ids", 100).collect()
    assert max(len(r.ids) for r in out) <= 100
    hot = [i for r in sorted((r for r in out if r.k == 0), key=lambda r: r.chunk) for i in r.ids]
    assert hot == [i for i in range(5000) if i % 10 < 9]


def test_group_total_equals_window(skewed):
    known = skewed.filter(F.col("k").isNotNull())
    ours = windows.with_group_total(known, ["k"], F.col("v"), "t").select("id", "t")
    assert rows(ours) == rows(known.select("id", F.sum("v").over(W.partitionBy("k"))))


def test_row_slices(spark):
    df = spark.range(50).select((F.lit(49) - F.col("id")).alias("x"))
    picked = row_slice(df, [F.col("x")], 3, 11).orderBy("x")
    assert [r.x for r in picked.collect()] == list(range(50))[3:11]
    stepped = row_slice(df, [F.col("x")], 2, 9, 3).orderBy("x")
    assert [r.x for r in stepped.collect()] == list(range(50))[2:9:3]
    assert [r.x for r in row_slice(df, [F.col("x")], 40).orderBy("x").collect()] == list(range(50))[40:]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-3, 3)), min_size=1, max_size=200))
def test_clamped_fold_equals_a_loop(spark, steps):
    data = [(i, k, d) for i, (k, d) in enumerate(steps)]
    df = spark.createDataFrame(data, "i long, k int, d int")
    folded = folds.clamped_steps(df, ["k"], [F.col("i")], F.col("d"), 0, 10)
    ours = {r.k: r.m for r in folded.select("k", folds.apply_step(F.lit(0)).alias("m")).collect()}
    expected = {}
    for _, k, d in data:
        expected[k] = min(max(expected.get(k, 0) + d, 0), 10)
    assert ours == expected


def test_fold_over_many_runs(spark, monkeypatch):
    monkeypatch.setattr(folds, "RUN", 7)
    df = spark.range(3000).select("id", F.lit(1).alias("k"), (F.col("id") * 31 % 7 - 3).alias("d"))
    out = folds.clamped_steps(df, ["k"], [F.col("id")], F.col("d"), 0, 10)
    mark = 0
    for i in range(3000):
        mark = min(max(mark + i * 31 % 7 - 3, 0), 10)
    assert out.select(folds.apply_step(F.lit(0))).first()[0] == mark
