"""How the driver's tables play the parts of a rental shop and of a sales star.

Film: ``part``; its release year is 1970 + p_size (1971-2020), its rental duration
p_size days, its rate p_retailprice, its replacement cost twice that.
Actor and staff: ``supplier``; an actor plays in the parts it has supplied.
Rental and sale line: ``lineitem`` of an order; rented on the order date, returned on the
ship date, still out while l_linestatus is 'O'.
Channel: o_orderpriority; region and country: ``region`` and ``nation`` of the customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.money import cents
from tallymark.operators.joins import keep_keys
from tallymark.sources.stored import stored_table
from tallymark.sources.tables import table

# The film ratings in the order of increasing age.
RATINGS = ("G", "PG", "PG-13", "R", "NC-17")

FILM_SQL = """
  SELECT p_partkey AS film_id, p_name AS title, p_type AS category, 1970 + p_size AS release_year,
         p_retailprice AS rental_rate,
         CASE p_size % 5 WHEN 0 THEN 'G' WHEN 1 THEN 'PG' WHEN 2 THEN 'PG-13'
                         WHEN 3 THEN 'R' ELSE 'NC-17' END AS rating
  FROM part"""


def films(spark: SparkSession, sf: str) -> DataFrame:
    rating = F.element_at(F.array(*map(F.lit, RATINGS)), (F.col("p_size") % 5 + 1).cast("int"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        (F.lit(1970) + F.col("p_size")).alias("release_year"),
        F.col("p_retailprice").alias("rental_rate"),
        rating.alias("rating"),
    )


def film_actors(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.select(
        F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id")
    ).distinct()


def actors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("actor_id"), F.col("s_name").alias("full_name")
    )


def customer_regions(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer with its country and region names."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("country_region")
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
        F.col("c_custkey").alias("cust_id"), "country", "country_region"
    )


def orders_between(spark: SparkSession, sf: str, first: str, after: str) -> DataFrame:
    """Orders of [first, after); a plain range on the column, so it reaches the scan."""
    orders = table(spark, sf, "orders")
    return orders.filter(
        (F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit(after).cast("timestamp_ntz"))
    ).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("cust_id"),
        F.col("o_orderpriority").alias("channel_desc"),
        F.to_date("o_orderdate").alias("time_id"),
    )


def order_totals(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    """Sales per order, in cents; with ``orders`` little more than theirs.

    Added up before any join: partial sums shrink a hot order on the map side, and the
    following join on the order id reuses this partitioning.
    """
    lines = table(spark, sf, "lineitem")
    if orders is not None:
        lines = keep_keys(lines.select("l_orderkey", "l_extendedprice"), "l_orderkey", orders, "order_id")
    return (
        lines.groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.sum(cents("l_extendedprice")).alias("sold_cents"))
    )


def order_sales(spark: SparkSession, sf: str, first: str, after: str) -> DataFrame:
    """Order-level sales facts: cust_id, channel_desc, time_id, sold_cents."""
    orders = orders_between(spark, sf, first, after)
    wanted = None if (first, after) == ALL_TIME else orders
    return orders.join(order_totals(spark, sf, wanted), "order_id")


def stored_facts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Sale lines and orders, both stored by order."""
    lines = stored_table(spark, sf, "lineitem", "l_orderkey", ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"])
    orders = stored_table(spark, sf, "orders", "o_orderkey",
                          ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    return lines, orders


def stored_orders_between(orders: DataFrame, first: str, after: str) -> DataFrame:
    return orders.filter((F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
                         & (F.col("o_orderdate") < F.lit(after).cast("timestamp_ntz")))


def stored_order_sales(spark: SparkSession, sf: str, first: str, after: str) -> DataFrame:
    """`order_sales` on facts stored by order: lines are added up and meet their orders bucket by bucket."""
    lines, orders = stored_facts(spark, sf)
    wanted = stored_orders_between(orders, first, after)
    totals = lines.groupBy("l_orderkey").agg(F.sum(cents("l_extendedprice")).alias("sold_cents"))
    return wanted.join(totals, wanted.o_orderkey == totals.l_orderkey).select(
        F.col("o_custkey").alias("cust_id"), F.col("o_orderpriority").alias("channel_desc"),
        F.to_date("o_orderdate").alias("time_id"), "sold_cents")


def stored_product_sales(spark: SparkSession, sf: str, first: str, after: str, customers: DataFrame) -> DataFrame:
    """`product_sales` of some customers on facts stored by order.

    Orders are restricted first, which moves orders of the period alone; what is left of them is dealt as
    the lines are stored, and no line moves before it has met its order.
    """
    lines, orders = stored_facts(spark, sf)
    wanted = stored_orders_between(orders, first, after).select(
        "o_orderkey", F.col("o_custkey").alias("cust_id"), F.col("o_orderpriority").alias("channel_desc"),
        F.to_date("o_orderdate").alias("time_id")).join(customers, "cust_id", "left_semi")
    return lines.join(wanted, lines.l_orderkey == wanted.o_orderkey).select(
        "cust_id", "channel_desc", "time_id", F.col("l_partkey").alias("prod_id"),
        cents("l_extendedprice").alias("sold_cents"))


def product_sales(spark: SparkSession, sf: str, first: str, after: str, prods: DataFrame | None = None,
                  customers: DataFrame | None = None) -> DataFrame:
    """Sale lines with product id: cust_id, channel_desc, time_id, prod_id, sold_cents.

    ``prods(prod_id)`` and ``customers(cust_id)`` restrict the lines and the orders before they meet.
    """
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("prod_id"),
        cents("l_extendedprice").alias("sold_cents"),
    )
    orders = orders_between(spark, sf, first, after)
    if customers is not None:
        orders = orders.join(customers, "cust_id", "left_semi")
    if prods is not None:
        lines = keep_keys(lines, "prod_id", prods, "prod_id")
    if (first, after) != ALL_TIME or customers is not None:
        lines = keep_keys(lines, "order_id", orders, "order_id")
    return lines.join(orders, "order_id")


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("prod_id"),
        F.col("p_name").alias("prod_name"),
        F.col("p_type").alias("prod_category"),
        F.col("p_brand").alias("prod_subcategory"),
    )


# The widest date range the sales can have; used where a report has no period of its own.
ALL_TIME = ("0001-01-01", "9999-12-31")
