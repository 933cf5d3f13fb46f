"""Joins and aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.functions.dates import calendar
from tallymark.functions.money import cents, money, share, sum_money
from tallymark.operators.frames import describe, describe_frame
from tallymark.operators.joins import densify, earliest_pair_with_sum
from tallymark.operators.moving import nearest_value
from tallymark.operators.lists import comma_lists, common_prefix, list_chunks
from tallymark.plans.registry import query
from tallymark.sources.tables import table

REVENUE = "CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(28,2))"

# --- c: joins -----------------------------------------------------------------------------


@query("c01_inner_equi", f"""
SELECT r_name, n_name, s_name, p_brand, {REVENUE} AS revenue, count(*) AS n
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey
WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3, 4""")
def c01(spark: SparkSession, sf: str) -> DataFrame:
    """Six tables; only the two large joins may shuffle, the rest are small by file size."""
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", cents("l_extendedprice").alias("_c"))
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part").select("p_partkey", "p_brand"),
              F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_suppkey", "p_brand").agg(F.sum("_c").alias("_c"), F.count(F.lit(1)).alias("n"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("r_name", "n_name", "s_name", "p_brand", money("_c").alias("revenue"), "n")
    )


@query("c02_left_outer", """
SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS lines
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def c02(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return orders.join(counts, orders.o_orderkey == counts.l_orderkey, "left").select(
        "o_orderkey", "o_orderstatus", F.coalesce("_n", F.lit(0)).alias("lines"))


@query("c03_theta_self_left", """
SELECT a.o_orderkey, a.o_orderdate, min(b.o_orderdate) AS next_date FROM orders a
LEFT JOIN orders b ON b.o_custkey = a.o_custkey AND b.o_orderdate > a.o_orderdate GROUP BY 1, 2""")
def c03(spark: SparkSession, sf: str) -> DataFrame:
    """``LEFT JOIN ... ON same id AND later date`` with MIN, for every order."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return nearest_value(orders, ["o_custkey"], "o_orderdate", orders, ["o_custkey"], "o_orderdate",
                         "next_date").drop("o_custkey")


@query("c03b_theta_left", """
SELECT l_orderkey, l_linenumber, (SELECT min(o_orderdate) FROM orders WHERE o_custkey = l_suppkey AND o_orderdate > l_shipdate)
  AS next_order FROM lineitem""")
def c03b(spark: SparkSession, sf: str) -> DataFrame:
    """The same between two tables: the next order by the customer with the number of a line's supplier."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    return nearest_value(lines, ["l_suppkey"], "l_shipdate", table(spark, sf, "orders"), ["o_custkey"], "o_orderdate",
                         "next_order").select("l_orderkey", "l_linenumber", "next_order")


@query("c04_cross", """
SELECT r_name, p_type, coalesce(n, 0) AS suppliers_with_type
FROM region CROSS JOIN (SELECT DISTINCT p_type FROM part)
LEFT JOIN (SELECT n_regionkey, p_type AS t, count(DISTINCT l_suppkey) AS n
           FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
           JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2) ON n_regionkey = r_regionkey AND t = p_type""")
def c04(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of two lists, filled with counts. The pairs are the result: Spark chooses how to form them."""
    regions = table(spark, sf, "region")
    types = table(spark, sf, "part").select("p_type").distinct()
    pairs = (
        table(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
        .join(table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("t")),
              F.col("l_partkey") == F.col("p_partkey"))
        .select("l_suppkey", "t").distinct()
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_regionkey", "t").agg(F.count(F.lit(1)).alias("_n"))
    )
    frame = types.crossJoin(regions)
    return frame.join(pairs, (F.col("n_regionkey") == F.col("r_regionkey"))
                      & (F.col("t") == F.col("p_type")), "left").select(
        "r_name", "p_type", F.coalesce("_n", F.lit(0)).alias("suppliers_with_type"))


@query("c05_semi", """
SELECT c_custkey, c_name FROM customer WHERE EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""")
def c05(spark: SparkSession, sf: str) -> DataFrame:
    large = table(spark, sf, "orders").filter(F.col("o_totalprice") > 450000).select("o_custkey").distinct()
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    return customer.join(large, customer.c_custkey == large.o_custkey, "left_semi")


@query("c06_anti", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def c06(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey").distinct()
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left_anti")


@query("c07_join_literal_key", """
SELECT p_partkey, p_name, n_nationkey AS origin FROM part JOIN nation ON n_name = 'NATION_7'""")
def c07(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup id fetched by a constant name; without such a name there are no rows."""
    origin = table(spark, sf, "nation").filter(F.col("n_name") == "NATION_7").select(
        F.col("n_nationkey").alias("origin"), F.lit(1).alias("_one"))
    part = table(spark, sf, "part").select("p_partkey", "p_name", F.lit(1).alias("_one"))
    return part.join(origin, "_one").drop("_one")


@query("c08_implicit_comma_join", """
SELECT c_mktsegment, n_name, count(*) AS n FROM orders, customer, nation
WHERE c_custkey = o_custkey AND n_nationkey = c_nationkey GROUP BY 1, 2""")
def c08(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("""
        SELECT c_mktsegment, n_name, count(*) AS n FROM {orders}, {customer}, {nation}
        WHERE c_custkey = o_custkey AND n_nationkey = c_nationkey GROUP BY 1, 2""",
                     **{t: table(spark, sf, t) for t in ("orders", "customer", "nation")})


INDEXED_SQL = """
WITH a AS (SELECT user_id AS key, count(*) AS visits FROM events GROUP BY 1),
     b AS (SELECT c_custkey AS key, c_name AS name FROM customer)
SELECT key, visits, name FROM a {how} JOIN b USING (key)"""


def indexed_join(spark: SparkSession, sf: str, how: str) -> DataFrame:
    """Visitors and customers by number: one visitor is no customer, and most customers never came."""
    a = table(spark, sf, "events").groupBy(F.col("user_id").alias("key")).agg(F.count(F.lit(1)).alias("visits"))
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return a.join(b, "key", how)


@query("c09_index_join_types", INDEXED_SQL.format(how="LEFT"))
def c09_left(spark: SparkSession, sf: str) -> DataFrame:
    return indexed_join(spark, sf, "left")


@query("c09_index_join_types_inner", INDEXED_SQL.format(how="INNER"))
def c09_inner(spark: SparkSession, sf: str) -> DataFrame:
    return indexed_join(spark, sf, "inner")


@query("c09_index_join_types_right", INDEXED_SQL.format(how="RIGHT"))
def c09_right(spark: SparkSession, sf: str) -> DataFrame:
    return indexed_join(spark, sf, "right")


@query("c09_index_join_types_outer", INDEXED_SQL.format(how="FULL"))
def c09_outer(spark: SparkSession, sf: str) -> DataFrame:
    return indexed_join(spark, sf, "outer")


@query("c10_merge_on_key", f"""
SELECT l_suppkey AS emp_id, s_name, {REVENUE} AS sale_amount
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2""")
def c10(spark: SparkSession, sf: str) -> DataFrame:
    sums = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("emp_id")).agg(
        sum_money("l_extendedprice").alias("sale_amount"))
    names = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("emp_id"), "s_name")
    return sums.join(names, "emp_id")


@query("c11_calendar_densify", """
WITH days AS (SELECT CAST(d AS DATE) AS day FROM generate_series(
       TIMESTAMP '1999-01-01', TIMESTAMP '1999-12-31', INTERVAL 1 DAY) t(d))
SELECT day, coalesce(CAST(o_totalprice AS DECIMAL(28,2)), 0) AS price FROM days LEFT JOIN orders
ON CAST(o_orderdate AS DATE) = day AND o_orderpriority = '1-URGENT'""")
def c11(spark: SparkSession, sf: str) -> DataFrame:
    """Every urgent order of a year; a day without one is there with 0."""
    days = calendar(spark, "1999-01-01", "1999-12-31").select(F.col("time_id").alias("day"))
    orders = table(spark, sf, "orders").filter(
        (F.col("o_orderpriority") == "1-URGENT")
        & (F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")))
    facts = orders.select(F.to_date("o_orderdate").alias("day"), money(cents("o_totalprice")).alias("price"))
    return densify(days, facts, "day", {"price": F.lit(0).cast("decimal(28,2)")})


@query("c12_natural_key_resolve", """
SELECT o_orderkey, c_custkey, n_nationkey, r_regionkey
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey""")
def c12(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that knows customers, nations and regions by name gets their ids."""
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    batch = (
        table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", F.col("c_name").alias("customer_name"),
                F.col("n_name").alias("nation_name"), F.col("r_name").alias("region_name"))
    )
    return (
        batch.join(customer.select("c_custkey", "c_name"), F.col("customer_name") == F.col("c_name"))
        .join(nation.select("n_nationkey", "n_name"), F.col("nation_name") == F.col("n_name"))
        .join(region, F.col("region_name") == F.col("r_name"))
        .select("o_orderkey", "c_custkey", "n_nationkey", "r_regionkey")
    )


@query("c13_pair_sum_join", """
WITH v AS (SELECT p_brand, p_partkey AS pos, p_size AS val FROM part),
pairs AS (SELECT a.p_brand, a.val AS first_value, b.val AS second_value, a.pos AS first_pos, b.pos AS second_pos,
                 row_number() OVER (PARTITION BY a.p_brand ORDER BY b.pos, a.pos) AS rn
          FROM v a JOIN v b ON a.p_brand = b.p_brand AND a.pos < b.pos AND a.val + b.val = 60)
SELECT p_brand, first_value, second_value, first_pos, second_pos FROM pairs WHERE rn = 1""")
def c13(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_brand", "p_partkey", "p_size")
    return earliest_pair_with_sum(part, ["p_brand"], "p_size", "p_partkey", 60)


# --- d: aggregations ----------------------------------------------------------------------


@query("d01_basic_aggs", f"""
SELECT l_returnflag, l_linestatus, {REVENUE} AS sum_price, count(*) AS n, min(l_shipdate) AS first_ship,
       max(l_extendedprice) AS max_price, round(avg(l_quantity), 4) AS avg_qty
FROM lineitem GROUP BY 1, 2""")
def d01(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        sum_money("l_extendedprice").alias("sum_price"), F.count(F.lit(1)).alias("n"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_extendedprice").alias("max_price"),
        F.round(F.avg("l_quantity"), 4).alias("avg_qty"))


@query("d02_count_distinct", """
SELECT l_suppkey, count(DISTINCT l_partkey) AS parts,
       count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned_parts
FROM lineitem GROUP BY l_suppkey""")
def d02(spark: SparkSession, sf: str) -> DataFrame:
    """Both counts from one distinct pass over (supplier, part)."""
    pairs = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("_returned"))
    return pairs.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("parts"), F.count_if("_returned").alias("returned_parts"))


@query("d03_conditional_agg", """
SELECT o_orderpriority, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS finished,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END)
            AS DECIMAL(28,2)) AS open_value,
       round(avg(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS avg_pending
FROM orders GROUP BY 1""")
def d03(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count(F.when(status == "F", 1)).alias("finished"),
        money(F.sum(F.when(status == "O", cents("o_totalprice")).otherwise(0))).alias("open_value"),
        F.round(F.avg(F.when(status == "P", F.col("o_totalprice"))), 2).alias("avg_pending"))


@query("d04_filter_clause", """
SELECT l_shipdate, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) FILTER (WHERE l_returnflag = 'A')
       AS DECIMAL(28,2)) AS a_sales, count(*) FILTER (WHERE l_tax > 0.05) AS taxed
FROM lineitem GROUP BY 1""")
def d04(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("c", cents("l_extendedprice"))
    sums = lines.groupBy("l_shipdate").agg(
        F.expr("sum(c) FILTER (WHERE l_returnflag = 'A')").alias("_a"),
        F.expr("count(*) FILTER (WHERE l_tax > 0.05D)").alias("taxed"))
    return sums.select("l_shipdate", money("_a").alias("a_sales"), "taxed")


@query("d05_having", """
SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS priorities FROM orders
GROUP BY o_custkey HAVING count(*) >= 12 AND count(DISTINCT o_orderpriority) = 5 AND sum(o_totalprice) > 1000000""")
def d05(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderpriority").alias("priorities"),
        F.sum(cents("o_totalprice")).alias("_c"),
    ).filter((F.col("n") >= 12) & (F.col("priorities") == 5) & (F.col("_c") > 100_000_000)).drop("_c")


@query("d06_agg_of_agg", """
SELECT p_type, p_brand, count(*) AS n, sum(count(*)) OVER (PARTITION BY p_type) AS type_n,
       rank() OVER (PARTITION BY p_type ORDER BY count(*) DESC) AS rnk
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type, p_brand""")
def d06(spark: SparkSession, sf: str) -> DataFrame:
    """Windows over the type x brand table, which is as small as the two lists of names."""
    per_part = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("_n"))
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    by_type = W.partitionBy("p_type")
    return (
        per_part.join(part, per_part.l_partkey == part.p_partkey)
        .groupBy("p_type", "p_brand").agg(F.sum("_n").alias("n"))
        .select("p_type", "p_brand", "n", F.sum("n").over(by_type).alias("type_n"),
                F.rank().over(by_type.orderBy(F.col("n").desc())).alias("rnk"))
    )


@query("d07_global_agg", """
SELECT count(*) AS n, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(12,2))), 0) AS DECIMAL(28,2)) AS total,
       coalesce(sum(CASE WHEN o_orderstatus = 'none' THEN o_custkey END), 0) AS nothing,
       max(o_orderdate) AS newest FROM orders""")
def d07(spark: SparkSession, sf: str) -> DataFrame:
    nothing = F.sum(F.when(F.col("o_orderstatus") == "none", F.col("o_custkey")))
    return table(spark, sf, "orders").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(sum_money("o_totalprice"), F.lit(0).cast("decimal(28,2)")).alias("total"),
        F.coalesce(nothing, F.lit(0)).alias("nothing"), F.max("o_orderdate").alias("newest"))


@query("d08_group_by_expression", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS year_month, quarter(o_orderdate) AS q,
       lower(o_orderstatus) AS status, count(*) AS n FROM orders GROUP BY 1, 2, 3""")
def d08(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy(
        F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM").alias("year_month"),
        F.quarter("o_orderdate").alias("q"), F.lower("o_orderstatus").alias("status"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("d09_value_counts", """
SELECT p_name AS value, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY 1 ORDER BY n DESC, value""")
def d09(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "part").select(F.col("p_name").alias("value")).na.drop()
        .groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "value")
    )


@query("d10_group_size", """
SELECT p_type, p_brand, count(*) AS n FROM part WHERE p_size >= 10 GROUP BY 1, 2""")
def d10(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter(F.col("p_size") >= 10).groupBy("p_type", "p_brand").agg(
        F.count(F.lit(1)).alias("n"))


MULTI = ("l_quantity", "l_discount", "l_tax")


@query("d11_multi_agg", "SELECT l_returnflag, " + ", ".join(
    f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std, min({c}) AS {c}_min, max({c}) AS {c}_max"
    for c in MULTI) + " FROM lineitem GROUP BY 1")
def d11(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [
        fn.alias(f"{c}_{label}") for c in MULTI for label, fn in (
            ("mean", F.round(F.avg(c), 6)), ("std", F.round(F.stddev_samp(c), 6)),
            ("min", F.min(c)), ("max", F.max(c)))
    ]
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(*wanted)


@query("d12_describe", """
SELECT count(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean,
       round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS min,
       round(quantile_cont(o_totalprice, 0.25), 4) AS q25, round(quantile_cont(o_totalprice, 0.5), 4) AS q50,
       round(quantile_cont(o_totalprice, 0.75), 4) AS q75, max(o_totalprice) AS max FROM orders""")
def d12(spark: SparkSession, sf: str) -> DataFrame:
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = describe(table(spark, sf, "orders"), [], "o_totalprice", quartiles)
    return found.withColumns({q: F.round(q, 4) for q in quartiles})


@query("d12b_describe_by_group", """
SELECT l_returnflag, count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
       round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS median, max(l_extendedprice) AS max
FROM lineitem GROUP BY 1""")
def d12b(spark: SparkSession, sf: str) -> DataFrame:
    found = describe(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", {"median": 0.5})
    return found.withColumn("median", F.round("median", 4))


FRAME = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey")


@query("d12c_describe_frame", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
  round(quantile_cont({c}, 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem""" for c in FRAME))
def d12c(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric columns of the lines described together, in a few scans and without a sort."""
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found = describe_frame(table(spark, sf, "lineitem"), FRAME, quartiles)
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "std", *quartiles)})


@query("d13_column_max", """
SELECT max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice, max(l_discount) AS l_discount,
       max(l_tax) AS l_tax, max(l_returnflag) AS l_returnflag, max(l_shipdate) AS l_shipdate FROM lineitem""")
def d13(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    return table(spark, sf, "lineitem").agg(*[F.max(c).alias(c) for c in columns])


@query("d14_crosstab_counts", """
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS "F", count(*) FILTER (WHERE l_linestatus = 'O') AS "O"
FROM lineitem GROUP BY 1""")
def d14(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(
        F.count(F.lit(1))).na.fill(0)


@query("d15_pivot_table_mean", """
SELECT l_linenumber, round(avg(l_quantity), 6) AS quantity, round(avg(l_discount), 6) AS discount, round(avg(l_tax), 6) AS tax
FROM lineitem GROUP BY 1""")
def d15(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("quantity", "discount", "tax")
    return table(spark, sf, "lineitem").groupBy("l_linenumber").agg(
        *[F.round(F.avg(f"l_{c}"), 6).alias(c) for c in columns])


@query("d16_string_agg", """
WITH n AS (SELECT o_orderpriority, o_orderkey,
                  (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 1000 AS chunk FROM orders)
SELECT o_orderpriority, chunk, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS keys
FROM n GROUP BY 1, 2""")
def d16(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    return comma_lists(orders, ["o_orderpriority"], [F.col("o_orderkey")], "o_orderkey", "keys")


@query("d16b_string_agg_distinct", """
SELECT l_partkey, string_agg(DISTINCT l_returnflag || l_linestatus, ',' ORDER BY l_returnflag || l_linestatus) AS states
FROM lineitem GROUP BY 1""")
def d16b(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct values of a short list per key: the built-in aggregate is enough.

    Two one-letter columns: a group has no more values than the two lists have pairs.
    """
    states = table(spark, sf, "lineitem").select(
        "l_partkey", F.concat("l_returnflag", "l_linestatus").alias("_s")).distinct()
    return states.groupBy("l_partkey").agg(
        F.expr("listagg(_s, ',') WITHIN GROUP (ORDER BY _s)").alias("states"))


@query("d17_collect_list_by_key", """
WITH n AS (SELECT event_type, event_id, ts,
                  (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 500 AS chunk FROM events)
SELECT event_type, chunk, string_agg(CAST(event_id AS VARCHAR), ';' ORDER BY ts, event_id) AS ids, count(*) AS n
FROM n GROUP BY 1, 2""")
def d17(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_type", "ts", "event_id")
    lists = list_chunks(events, ["event_type"], [F.col("ts"), F.col("event_id")], "event_id", "list", 500)
    return lists.select("event_type", "chunk",
                        F.array_join(F.col("list").cast("array<string>"), ";").alias("ids"),
                        F.size("list").cast("bigint").alias("n"))


@query("d18_merge_sum_maps", """
SELECT key, sum(v) AS v FROM (
  SELECT l_partkey AS key, CAST(sum(l_quantity) AS BIGINT) AS v FROM lineitem GROUP BY 1
  UNION ALL SELECT p_partkey, p_size FROM part) GROUP BY key""")
def d18(spark: SparkSession, sf: str) -> DataFrame:
    first = table(spark, sf, "lineitem").groupBy(
        F.col("l_partkey").alias("key")).agg(F.sum("l_quantity").cast("bigint").alias("v"))
    second = table(spark, sf, "part").select(
        F.col("p_partkey").alias("key"), F.col("p_size").cast("bigint").alias("v"))
    return merge_sum([first, second])


def merge_sum(maps: list[DataFrame]) -> DataFrame:
    """Key -> number relations added up on their common keys."""
    return reduce(DataFrame.unionByName, maps).groupBy("key").agg(F.sum("v").alias("v"))


@query("d19_mixed_sum", r"""
SELECT event_type,
       CAST(sum(CAST(value AS DECIMAL(12,2)) + CAST(regexp_extract(props, '(\d+)', 1) AS DECIMAL(12,2))) AS DECIMAL(28,2)) AS total,
       sum(TRY_CAST(CASE WHEN user_id % 2 = 0 THEN props ELSE CAST(user_id AS VARCHAR) END AS BIGINT)) AS lenient
FROM events GROUP BY 1""")
def d19(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and numeric strings; a bad string fails the sum unless it is asked to be skipped."""
    strict = F.col("value").cast("decimal(18,6)") + F.get_json_object("props", "$.k").cast("decimal(18,6)")
    mixed = F.when(F.col("user_id") % 2 == 0, F.col("props")).otherwise(F.col("user_id").cast("string"))
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.sum(strict).cast("decimal(28,2)").alias("total"), F.sum(mixed.try_cast("bigint")).alias("lenient"))


@query("d21_common_prefix", """
WITH g AS (SELECT p_type, min(p_brand || p_name) AS lo, max(p_brand || p_name) AS hi FROM part GROUP BY 1
           UNION ALL SELECT c_mktsegment, min(c_name), max(c_name) FROM customer GROUP BY 1
           UNION ALL SELECT p_brand || p_name, min(p_name), max(p_name) FROM part GROUP BY 1)
SELECT p_type AS grp, substr(lo, 1, (SELECT max(n) FROM generate_series(0, least(length(lo), length(hi))) t(n)
                                     WHERE substr(lo, 1, n) = substr(hi, 1, n))) AS prefix FROM g""")
def d21(spark: SparkSession, sf: str) -> DataFrame:
    part, customer = table(spark, sf, "part"), table(spark, sf, "customer")
    whole = F.concat("p_brand", "p_name")
    parts = [
        part.select(F.col("p_type").alias("grp"), whole.alias("s")),
        customer.select(F.col("c_mktsegment").alias("grp"), F.col("c_name").alias("s")),
        part.select(whole.alias("grp"), F.col("p_name").alias("s")),
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("grp").agg(common_prefix("s").alias("prefix"))


@query("d22_percent_of_total", """
WITH t AS (SELECT n_regionkey, n_name, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS v
           FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2)
SELECT n_name, round(CAST(v AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY n_regionkey) AS DOUBLE) * 100, 4) AS pct FROM t""")
def d22(spark: SparkSession, sf: str) -> DataFrame:
    """The window is over one row per nation."""
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum(cents("o_totalprice")).alias("_c"))
    per_nation = (
        per_customer.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey").agg(F.sum("_c").alias("_c"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    whole = F.sum("_c").over(W.partitionBy("n_regionkey"))
    return per_nation.select("n_name", share(F.col("_c"), whole, 4).alias("pct"))
