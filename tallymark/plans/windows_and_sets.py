"""Window functions, sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.functions.money import cents, money
from tallymark.operators.moving import moving_groups, moving_rows, nearest_value, range_total
from tallymark.operators.ordered import (
    global_row_number, rank_in_group, running_total, running_total_of_peers)
from tallymark.operators.sets import distinct_keep_order, in_all_lists
from tallymark.operators.topk import top_distinct_values, top_rank
from tallymark.operators.windows import first_duplicate, latest_per_group, with_group_total
from tallymark.plans.registry import query
from tallymark.session import scratch_path
from tallymark.sources import files
from tallymark.sources.tables import table

PRICE = "CAST(o_totalprice AS DECIMAL(12,2))"


# --- e: window functions ------------------------------------------------------------------


@query("e01_rank", """
SELECT c_mktsegment, c_custkey, count(*) AS n,
       rank() OVER (PARTITION BY c_mktsegment ORDER BY count(*) DESC) AS rnk
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""")
def e01(spark: SparkSession, sf: str) -> DataFrame:
    """All customers of a segment ranked by their number of orders."""
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    totals = counts.join(customer, counts.o_custkey == customer.c_custkey).select(
        "c_mktsegment", "c_custkey", "n")
    return rank_in_group(totals, ["c_mktsegment"], "n")


@query("e02_row_number", """
SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS row_num, p_partkey, p_name FROM part""")
def e02(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return global_row_number(part, [F.col("p_name"), F.col("p_partkey")])


@query("e03_lag", f"""
WITH y AS (SELECT c_nationkey, year(o_orderdate) AS y, sum({PRICE}) AS total
           FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
SELECT c_nationkey, y, CAST(total AS DECIMAL(28,2)) AS total,
       CAST(coalesce(lag(total) OVER (PARTITION BY c_nationkey ORDER BY y), 0) AS DECIMAL(28,2)) AS previous FROM y""")
def e03(spark: SparkSession, sf: str) -> DataFrame:
    per_customer = table(spark, sf, "orders").groupBy(
        "o_custkey", F.year("o_orderdate").alias("y")).agg(F.sum(cents("o_totalprice")).alias("_c"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    yearly = per_customer.join(customer, per_customer.o_custkey == customer.c_custkey).groupBy(
        "c_nationkey", "y").agg(F.sum("_c").alias("_c"))
    before = F.coalesce(F.lag("_c").over(W.partitionBy("c_nationkey").orderBy("y")), F.lit(0))
    return yearly.select("c_nationkey", "y", money("_c").alias("total"), money(before).alias("previous"))


@query("e04_partition_total", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(sum(l_quantity) OVER (PARTITION BY l_suppkey) AS BIGINT) AS supplier_qty
FROM lineitem""")
def e04(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("q"))
    return with_group_total(lines, ["l_suppkey"], F.col("q"), "supplier_qty").drop("l_suppkey", "q")


@query("e05_running_rows", f"""
SELECT o_orderkey, CAST(sum({PRICE}) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS running FROM orders""")
def e05(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", cents("o_totalprice").alias("_c"))
    running = running_total(orders, ["o_orderpriority"], [F.col("o_orderdate"), F.col("o_orderkey")],
                            F.col("_c"), "running")
    return running.select("o_orderkey", money("running").alias("running"))


CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


@query("e06_moving_rows", f"""
SELECT o_orderkey, round(CAST(sum({CENTS}) OVER w AS DOUBLE) / count(*) OVER w, 4) AS moving_avg FROM orders
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)""")
def e06(spark: SparkSession, sf: str) -> DataFrame:
    """The average over an order and its neighbours, in cents."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", cents("o_totalprice").alias("_c"))
    moved = moving_rows(
        orders, ["o_orderpriority"], [F.col("o_orderdate"), F.col("o_orderkey")], 2, 1,
        lambda rows: {"moving_avg": mean_of("_c", rows(-2, 1))})
    return moved.select("o_orderkey", "moving_avg")


def mean_of(column: str, window: WindowSpec) -> Column:
    return F.round(F.sum(column).over(window).cast("double") / F.count(column).over(window), 4)


@query("e07_running_range", f"""
SELECT DISTINCT o_orderpriority, o_orderdate, CAST(sum({PRICE}) OVER (PARTITION BY o_orderpriority
  ORDER BY o_orderdate) AS DECIMAL(28,2)) AS running FROM orders""")
def e07(spark: SparkSession, sf: str) -> DataFrame:
    running = running_total_of_peers(
        table(spark, sf, "orders"), ["o_orderpriority"], "o_orderdate", cents("o_totalprice"), "running")
    return running.withColumn("running", money("running"))


LINE_CENTS = "CAST(l_extendedprice AS DECIMAL(12,2))"


def shipped_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", cents("l_extendedprice").alias("_c"))


@query("e08_range_interval", f"""
SELECT DISTINCT l_returnflag, l_shipdate, CAST(sum({LINE_CENTS}) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate
  RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS last_days FROM lineitem""")
def e08(spark: SparkSession, sf: str) -> DataFrame:
    sums = range_total(shipped_lines(spark, sf), ["l_returnflag"], "l_shipdate", F.col("_c"),
                       F.col("l_shipdate") - F.expr("INTERVAL '3' DAY"), "_s")
    return sums.select("l_returnflag", "l_shipdate", money("_s").alias("last_days"))


@query("e09_groups_frame", f"""
SELECT DISTINCT l_returnflag, l_shipdate, CAST(sum({LINE_CENTS}) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate
  GROUPS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS last_groups FROM lineitem""")
def e09(spark: SparkSession, sf: str) -> DataFrame:
    sums = moving_groups(shipped_lines(spark, sf), ["l_returnflag"], "l_shipdate", F.col("_c"), -2, 0, "_s")
    return sums.select("l_returnflag", "l_shipdate", money("_s").alias("last_groups"))


@query("e10_exclude_group", f"""
SELECT DISTINCT l_returnflag, l_shipdate, CAST(sum({LINE_CENTS}) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate
  GROUPS BETWEEN 1 PRECEDING AND 2 FOLLOWING EXCLUDE GROUP) AS DECIMAL(28,2)) AS groups_around FROM lineitem""")
def e10(spark: SparkSession, sf: str) -> DataFrame:
    sums = moving_groups(shipped_lines(spark, sf), ["l_returnflag"], "l_shipdate", F.col("_c"), -1, 2, "_s",
                         exclude_group=True)
    return sums.select("l_returnflag", "l_shipdate", money("_s").alias("groups_around"))


def centred(rows: str) -> str:
    window = f"(ORDER BY o_orderdate, o_orderkey ROWS BETWEEN {rows})"
    return f"round(CAST(sum({CENTS}) OVER {window} AS DOUBLE) / count(*) OVER {window}, 4)"


@query("e11_conditional_frame", f"""
SELECT o_orderkey, CASE dayname(o_orderdate) WHEN 'Monday' THEN {centred("2 PRECEDING AND 1 FOLLOWING")}
  WHEN 'Friday' THEN {centred("1 PRECEDING AND 2 FOLLOWING")}
  ELSE {centred("1 PRECEDING AND 1 FOLLOWING")} END AS centered FROM orders""")
def e11(spark: SparkSession, sf: str) -> DataFrame:
    """A frame per weekday over all orders in one order, without a key."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", cents("o_totalprice").alias("_c"))
    name = F.date_format("o_orderdate", "EEEE")
    moved = moving_rows(
        orders, [], [F.col("o_orderdate"), F.col("o_orderkey")], 2, 2,
        lambda rows: {"centered": F.when(name == "Monday", mean_of("_c", rows(-2, 1)))
                      .when(name == "Friday", mean_of("_c", rows(-1, 2))).otherwise(mean_of("_c", rows(-1, 1)))})
    return moved.select("o_orderkey", "centered")


@query("e12_next_value", """
WITH d AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders)
SELECT o_custkey, o_orderdate, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS next_date FROM d""")
def e12(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "orders").select("o_custkey", "o_orderdate").distinct()
    return nearest_value(days, ["o_custkey"], "o_orderdate", days, ["o_custkey"], "o_orderdate", "next_date")


@query("e13_latest_per_group", """
SELECT o_custkey, o_orderkey, o_orderdate FROM orders o
WHERE o_orderdate = (SELECT max(i.o_orderdate) FROM orders i WHERE i.o_custkey = o.o_custkey)""")
def e13(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest_per_group(orders, ["o_custkey"], "o_orderdate")


@query("e14_first_duplicate", """
WITH n AS (SELECT o_orderpriority, o_orderstatus, o_custkey, o_orderkey, row_number() OVER (
             PARTITION BY o_orderpriority, o_orderstatus, o_custkey ORDER BY o_orderkey) AS rn FROM orders)
SELECT o_orderpriority, o_orderstatus,
       coalesce(arg_min(o_custkey, o_orderkey) FILTER (WHERE rn = 2), -1) AS first_duplicate FROM n GROUP BY 1, 2""")
def e14(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderpriority", "o_orderstatus", "o_custkey", "o_orderkey")
    return first_duplicate(orders, ["o_orderpriority", "o_orderstatus"], "o_custkey", "o_orderkey")


# --- f: sorts, limits, top-k --------------------------------------------------------------


@query("f01_order_multi", """
SELECT o_orderstatus, o_orderdate, o_totalprice, o_orderkey FROM orders
ORDER BY o_orderstatus ASC NULLS LAST, o_totalprice DESC NULLS FIRST, o_orderkey""")
def f01(spark: SparkSession, sf: str) -> DataFrame:
    """The id at the end lets the range partitioning split a status that holds most rows."""
    return table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderdate", "o_totalprice", "o_orderkey"
    ).orderBy(F.col("o_orderstatus").asc_nulls_last(), F.col("o_totalprice").desc_nulls_first(),
              "o_orderkey")


@query("f02_limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def f02(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey").limit(5)


@query("f03_topk_keep_ties", """
WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT o_custkey, n FROM c WHERE n IN (SELECT DISTINCT n FROM c ORDER BY n DESC LIMIT 5)""")
def f03(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return top_distinct_values(counts, "n", 5)


@query("f04_topk_per_group", """
SELECT l_returnflag, l_orderkey, l_extendedprice, rnk FROM (
  SELECT *, rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice DESC) AS rnk FROM lineitem)
WHERE rnk <= 10""")
def f04(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_orderkey", "l_extendedprice")
    return top_rank(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", 10).drop("l_linestatus")


@query("f05_top3_keys", f"""
SELECT l_partkey AS key FROM lineitem GROUP BY l_partkey
ORDER BY sum(l_quantity) DESC, l_partkey LIMIT 3""")
def f05(spark: SparkSession, sf: str) -> DataFrame:
    totals = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("key")).agg(
        F.sum("l_quantity").alias("v"))
    return top_keys(totals, "key", "v", "key", 3)


def top_keys(df: DataFrame, key: str, value: str, position: str, k: int) -> DataFrame:
    """Keys of the k largest values; of equal values the earlier key; empty in, empty out."""
    return df.orderBy(F.col(value).desc(), F.col(position).asc()).limit(k).select(key)


@query("f06_order_to_sink", "SELECT p_partkey, p_retailprice FROM part")
def f06(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parts-by-price")
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    files.write_json_records(parts, path, [F.col("p_retailprice").desc(), F.col("p_partkey")])
    return spark.read.schema(parts.schema).json(path)


# --- g: sets ------------------------------------------------------------------------------


@query("g01_union_all", """
SELECT s_nationkey AS nation, s_name AS name FROM supplier UNION ALL SELECT c_nationkey, c_name FROM customer
UNION ALL SELECT s_nationkey, s_name FROM supplier WHERE s_acctbal > 0""")
def g01(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), "s_acctbal")
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    again = suppliers.filter(F.col("s_acctbal") > 0).drop("s_acctbal")
    return suppliers.drop("s_acctbal").unionByName(customers).unionByName(again)


@query("g02_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_shipdate FROM lineitem")
def g02(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_shipdate").distinct()


@query("g03_distinct_keep_order", """
WITH v AS (SELECT o_orderkey AS pos, CASE WHEN o_custkey % 2 = 0 THEN '"' || o_custkey || '"' ELSE CAST(o_custkey AS VARCHAR) END AS v
           FROM orders)
SELECT v AS value, min(pos) AS first_pos FROM v GROUP BY 1""")
def g03(spark: SparkSession, sf: str) -> DataFrame:
    """Values of mixed type are kept apart by writing text in quotes: "2" is not 2."""
    key = F.col("o_custkey").cast("string")
    mixed = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit('"'), key, F.lit('"'))).otherwise(key)
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("pos"), mixed.alias("value"))
    return distinct_keep_order(orders, "value", "pos").orderBy("first_pos")


@query("g04_set_intersection", """
SELECT l_partkey FROM lineitem WHERE l_suppkey IN (3, 5, 8) GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 3""")
def g04(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that each of three suppliers has delivered."""
    wanted = [3, 5, 8]
    lines = table(spark, sf, "lineitem").filter(F.col("l_suppkey").isin(wanted))
    return in_all_lists(lines, "l_partkey", "l_suppkey", len(wanted))
