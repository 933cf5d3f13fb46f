"""Sales reports over the star of sales, customers, products and calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.functions.dates import calendar
from tallymark.functions.money import money, percent_text, share
from tallymark.operators.joins import null_safe_join, settled
from tallymark.operators.ordered import running_total
from tallymark.operators.topk import top_rank
from tallymark.operators.windows import groups_frame
from tallymark.plans.mapping import (
    ALL_TIME, customer_regions, order_sales, product_sales, products, stored_order_sales,
    stored_product_sales)
from tallymark.plans.registry import ORACLES, query
from tallymark.sources.tables import table

AMOUNT = "CAST(l_extendedprice AS DECIMAL(12,2))"
SALES_SQL = f"""
  SELECT o_custkey AS cust_id, o_orderpriority AS channel_desc, CAST(o_orderdate AS DATE) AS time_id,
         l_partkey AS prod_id, l_orderkey, {AMOUNT} AS amount_sold
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""
CUSTOMER_REGION_SQL = """
  SELECT c_custkey AS cust_id, n_name AS country, r_name AS country_region
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""


def customer_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("cust_name"))


# --- r09: the leading customers of every channel ------------------------------------------


def top_customers_per_channel(sales: DataFrame, names: DataFrame, k: int) -> DataFrame:
    """``sales(cust_id, channel_desc, sold_cents)``; ties at rank k are kept.

    The channel total is a plain aggregate joined to the few leaders, not a window over
    a handful of channel partitions that would each hold a share of all customers.
    """
    per_customer = sales.groupBy("channel_desc", "cust_id").agg(F.sum("sold_cents").alias("_cents"))
    per_channel = per_customer.groupBy("channel_desc").agg(F.sum("_cents").alias("_channel_cents"))
    leaders = top_rank(per_customer, ["channel_desc"], "_cents", k).join(per_channel, "channel_desc")
    return (
        settled(leaders, "leaders").join(names, "cust_id")
        .select(
            "channel_desc", "cust_id", "cust_name", money("_cents").alias("amount_sold"),
            percent_text(share(F.col("_cents"), F.col("_channel_cents"), 4), 4).alias("sales_percentage"))
        .orderBy("channel_desc", F.col("amount_sold").desc(), "cust_id")
    )


@query("r09_top5_customers_per_channel", f"""
WITH s AS ({SALES_SQL}),
t AS (SELECT channel_desc, cust_id, sum(amount_sold) AS amount_sold,
             sum(sum(amount_sold)) OVER (PARTITION BY channel_desc) AS channel_total,
             rank() OVER (PARTITION BY channel_desc ORDER BY sum(amount_sold) DESC) AS rnk
      FROM s GROUP BY channel_desc, cust_id)
SELECT channel_desc, cust_id, c_name AS cust_name, CAST(amount_sold AS DECIMAL(28,2)) AS amount_sold,
       CAST(CAST(round(CAST(amount_sold AS DOUBLE) / CAST(channel_total AS DOUBLE) * 100, 4)
            AS DECIMAL(18,4)) AS VARCHAR) || '%' AS sales_percentage
FROM t JOIN customer ON c_custkey = cust_id WHERE rnk BETWEEN 1 AND 5""")
def r09(spark: SparkSession, sf: str) -> DataFrame:
    return top_customers_per_channel(order_sales(spark, sf, *ALL_TIME), customer_names(spark, sf), 5)


# --- r10: product x quarter ----------------------------------------------------------------


def quarter_report_base(spark: SparkSession, sf: str, stored: bool = False) -> DataFrame:
    in_region = customer_regions(spark, sf).filter(F.col("country_region") == "ASIA").select("cust_id")
    in_category = products(spark, sf).filter(F.col("prod_category") == "PROMO")
    year = ("2000-01-01", "2001-01-01")
    sales = (stored_product_sales(spark, sf, *year, in_region) if stored
             else product_sales(spark, sf, *year, in_category, in_region))
    return (
        sales.join(in_category.select("prod_id", "prod_name"), "prod_id")
        .withColumn("quarter", F.quarter("time_id"))
    )


R10_SQL = f"""
WITH s AS ({SALES_SQL}), c AS ({CUSTOMER_REGION_SQL}),
q AS (SELECT p_name AS prod_name, quarter(time_id) AS quarter, sum(amount_sold) AS amount
      FROM s JOIN part ON p_partkey = prod_id JOIN c USING (cust_id)
      WHERE year(time_id) = 2000 AND p_type = 'PROMO' AND country_region = 'ASIA' GROUP BY 1, 2)
SELECT prod_name,
       CAST(coalesce(sum(amount) FILTER (WHERE quarter = 1), 0) AS DECIMAL(28,2)) AS q1,
       CAST(coalesce(sum(amount) FILTER (WHERE quarter = 2), 0) AS DECIMAL(28,2)) AS q2,
       CAST(coalesce(sum(amount) FILTER (WHERE quarter = 3), 0) AS DECIMAL(28,2)) AS q3,
       CAST(coalesce(sum(amount) FILTER (WHERE quarter = 4), 0) AS DECIMAL(28,2)) AS q4,
       CAST(sum(amount) AS DECIMAL(28,2)) AS year_sum
FROM q GROUP BY prod_name"""


def quarter_crosstab(sales: DataFrame) -> DataFrame:
    quarters = [
        money(F.sum(F.when(F.col("quarter") == q, F.col("sold_cents")).otherwise(0))).alias(f"q{q}")
        for q in range(1, 5)
    ]
    return sales.groupBy("prod_name").agg(
        *quarters, money(F.sum("sold_cents")).alias("year_sum")
    ).orderBy(F.col("year_sum").desc(), "prod_name")


@query("r10_quarter_crosstab", R10_SQL)
def r10(spark: SparkSession, sf: str) -> DataFrame:
    return quarter_crosstab(quarter_report_base(spark, sf))


@query("r10c_quarter_crosstab_stored", R10_SQL)
def r10_stored(spark: SparkSession, sf: str) -> DataFrame:
    """On facts stored by order: the lines don't move, however many orders are wanted."""
    return quarter_crosstab(quarter_report_base(spark, sf, stored=True))


@query("r10_quarter_crosstab_pivot", R10_SQL)
def r10_pivot(spark: SparkSession, sf: str) -> DataFrame:
    wide = (
        quarter_report_base(spark, sf).groupBy("prod_name")
        .pivot("quarter", [1, 2, 3, 4]).agg(F.sum("sold_cents")).na.fill(0)
        .toDF("prod_name", "q1", "q2", "q3", "q4")
    )
    total = F.col("q1") + F.col("q2") + F.col("q3") + F.col("q4")
    return wide.select(
        "prod_name", *[money(f"q{i}").alias(f"q{i}") for i in range(1, 5)],
        money(total).alias("year_sum"),
    ).orderBy(F.col("year_sum").desc(), "prod_name")


# --- r11: customers among the top 300 of a channel in all of three years ------------------


def yearly_leaders(sales: DataFrame, years: Sequence[int], k: int) -> DataFrame:
    yearly = (
        sales.withColumn("year_sales", F.year("time_id")).filter(F.col("year_sales").isin(list(years)))
        .groupBy("channel_desc", "year_sales", "cust_id").agg(F.sum("sold_cents").alias("_cents"))
    )
    return top_rank(yearly, ["channel_desc", "year_sales"], "_cents", k)


R11_SQL = f"""
WITH s AS ({SALES_SQL}),
top300 AS (
  SELECT cust_id, channel_desc, year(time_id) AS year_sales, sum(amount_sold) AS total_chan,
         rank() OVER (PARTITION BY channel_desc, year(time_id) ORDER BY sum(amount_sold) DESC) AS rnk
  FROM s WHERE year(time_id) IN (1998, 1999, 2001) GROUP BY 1, 2, 3)
SELECT channel_desc, cust_id, c_name AS cust_name, CAST(sum(total_chan) AS DECIMAL(28,2)) AS amount_sold
FROM top300 JOIN customer ON c_custkey = cust_id
WHERE rnk <= 300 GROUP BY channel_desc, cust_id, c_name HAVING count(DISTINCT year_sales) = 3"""


def leading_in_all(sales: DataFrame, years: Sequence[int], k: int, names: DataFrame) -> DataFrame:
    leaders = yearly_leaders(sales, years, k)
    always = (
        leaders.groupBy("channel_desc", "cust_id")
        .agg(F.sum("_cents").alias("_cents"), F.countDistinct("year_sales").alias("_years"))
        .filter(F.col("_years") == len(years))
    )
    return settled(always, "always-leading").join(names, "cust_id").select(
        "channel_desc", "cust_id", "cust_name", money("_cents").alias("amount_sold")
    ).orderBy(F.col("amount_sold").desc(), "channel_desc", "cust_id")


@query("r11_top300_in_all_years", R11_SQL)
def r11(spark: SparkSession, sf: str) -> DataFrame:
    sales = order_sales(spark, sf, "1998-01-01", "2002-01-01")
    return leading_in_all(sales, (1998, 1999, 2001), 300, customer_names(spark, sf))


@query("r11c_top300_stored", R11_SQL)
def r11_stored(spark: SparkSession, sf: str) -> DataFrame:
    """On facts stored by order."""
    sales = stored_order_sales(spark, sf, "1998-01-01", "2002-01-01")
    return leading_in_all(sales, (1998, 1999, 2001), 300, customer_names(spark, sf))


@query("r11_top300_in_all_years_joins", R11_SQL)
def r11_joins(spark: SparkSession, sf: str) -> DataFrame:
    years = (1998, 1999, 2001)
    leaders = settled(
        yearly_leaders(order_sales(spark, sf, "1998-01-01", "2002-01-01"), years, 300), "yearly-leaders")
    per_year = [
        leaders.filter(F.col("year_sales") == y).select(
            "channel_desc", "cust_id", F.col("_cents").alias(f"_c{y}"))
        for y in years
    ]
    joined = per_year[0]
    for other in per_year[1:]:
        joined = joined.join(other, ["channel_desc", "cust_id"])
    total = sum((F.col(f"_c{y}") for y in years[1:]), F.col(f"_c{years[0]}"))
    return joined.join(customer_names(spark, sf), "cust_id").select(
        "channel_desc", "cust_id", "cust_name", money(total).alias("amount_sold"))


# --- r12: month x category, one column per region -----------------------------------------


def month_category_region(spark: SparkSession, sf: str) -> DataFrame:
    regions = customer_regions(spark, sf).filter(F.col("country_region").isin("AMERICA", "EUROPE"))
    return (
        product_sales(spark, sf, "2000-01-01", "2000-04-01")
        .join(products(spark, sf).select("prod_id", "prod_category"), "prod_id")
        .join(regions.select("cust_id", "country_region"), "cust_id")
        .withColumn("calendar_month_desc", F.date_format("time_id", "yyyy-MM"))
    )


def region_sum(region: str) -> Column:
    return F.sum(F.when(F.col("country_region") == region, F.col("sold_cents")))


R12_BASE = f"""
WITH s AS ({SALES_SQL}), c AS ({CUSTOMER_REGION_SQL}),
m AS (SELECT strftime(time_id, '%Y-%m') AS calendar_month_desc, p_type AS prod_category,
             country_region, amount_sold
      FROM s JOIN part ON p_partkey = prod_id JOIN c USING (cust_id)
      WHERE time_id >= DATE '2000-01-01' AND time_id < DATE '2000-04-01'
        AND country_region IN ('EUROPE', 'AMERICA'))"""


@query("r12_month_category_region", R12_BASE + """
SELECT calendar_month_desc, prod_category,
       CAST(sum(amount_sold) FILTER (WHERE country_region = 'AMERICA') AS DECIMAL(28,2)) AS america_sales,
       CAST(sum(amount_sold) FILTER (WHERE country_region = 'EUROPE') AS DECIMAL(28,2)) AS europe_sales
FROM m GROUP BY 1, 2""")
def r12(spark: SparkSession, sf: str) -> DataFrame:
    return month_category_region(spark, sf).groupBy("calendar_month_desc", "prod_category").agg(
        money(region_sum("AMERICA")).alias("america_sales"),
        money(region_sum("EUROPE")).alias("europe_sales"),
    ).orderBy("calendar_month_desc", "prod_category")


@query("r12b_month_category_running", R12_BASE + """
SELECT DISTINCT calendar_month_desc, prod_category,
  CAST(sum(sum(amount_sold) FILTER (WHERE country_region = 'AMERICA'))
       OVER (PARTITION BY calendar_month_desc ORDER BY prod_category) AS DECIMAL(28,2)) AS america_sales,
  CAST(sum(sum(amount_sold) FILTER (WHERE country_region = 'EUROPE'))
       OVER (PARTITION BY calendar_month_desc ORDER BY prod_category) AS DECIMAL(28,2)) AS europe_sales
FROM m GROUP BY calendar_month_desc, prod_category, country_region""")
def r12b(spark: SparkSession, sf: str) -> DataFrame:
    """Running totals over the categories of a month (peers share one value)."""
    monthly = month_category_region(spark, sf).groupBy("calendar_month_desc", "prod_category").agg(
        region_sum("AMERICA").alias("_america"), region_sum("EUROPE").alias("_europe"))
    # One row per month and category is left, so a month's partition is the category list.
    w = W.partitionBy("calendar_month_desc").orderBy("prod_category").rangeBetween(
        W.unboundedPreceding, W.currentRow)
    return monthly.select(
        "calendar_month_desc", "prod_category",
        money(F.sum("_america").over(w)).alias("america_sales"),
        money(F.sum("_europe").over(w)).alias("europe_sales"),
    ).orderBy("prod_category", "calendar_month_desc")


# --- r13: share of the region's year and of the year before -------------------------------

REGIONS = ["AMERICA", "ASIA", "EUROPE"]


def region_year_channel(spark: SparkSession, sf: str, sales: DataFrame | None = None) -> DataFrame:
    """One year more than the report shows; regions x years x channels is a small table."""
    if sales is None:
        sales = order_sales(spark, sf, "1998-01-01", "2002-01-01")
    per_customer = (
        sales.groupBy("cust_id", F.year("time_id").alias("calendar_year"), "channel_desc")
        .agg(F.sum("sold_cents").alias("sold_cents"))
    )
    regions = customer_regions(spark, sf).filter(F.col("country_region").isin(REGIONS))
    return (
        per_customer.join(regions, "cust_id")
        .groupBy("country_region", "calendar_year", "channel_desc")
        .agg(F.sum("sold_cents").alias("total"))
    )


def amount_text(total_cents: str) -> Column:
    return F.concat(money(total_cents).cast("string"), F.lit("$"))


def share_of_region_year(df: DataFrame) -> DataFrame:
    w = W.partitionBy("country_region", "calendar_year")
    percent = share(F.col("total"), F.sum("total").over(w), 2).cast("decimal(18,2)")
    return df.withColumn("by_channels", percent)


def percent_vs_previous(df: DataFrame, first: int, last: int) -> DataFrame:
    """Previous = the last year the channel had sales in; none counts as 0."""
    w = W.partitionBy("country_region", "channel_desc").orderBy("calendar_year")
    shares = share_of_region_year(df).withColumn("_previous", F.lag("by_channels").over(w))
    zero = F.lit("0%")
    return shares.filter(F.col("calendar_year").between(first, last)).select(
        "country_region", "calendar_year", "channel_desc", amount_text("total").alias("amount_sold"),
        percent_text(F.col("by_channels"), 2).alias("pct_by_channels"),
        F.coalesce(percent_text(F.col("_previous"), 2), zero).alias("pct_previous_period"),
        F.coalesce(percent_text(F.col("by_channels") - F.col("_previous"), 2), zero).alias("pct_diff"),
    ).orderBy("country_region", "calendar_year", "channel_desc")


def percent_vs_previous_group(df: DataFrame, first: int, last: int) -> DataFrame:
    """Previous = the year group before, numerator and denominator each in its own partition."""
    year = F.col("calendar_year").asc()
    shares = groups_frame(share_of_region_year(df), ["country_region", "channel_desc"], year,
                          F.col("total"), -1, -1, "_channel_before")
    shares = groups_frame(shares, ["country_region"], year, F.col("total"), -1, -1, "_region_before")
    previous = share(F.col("_channel_before"), F.col("_region_before"), 2).cast("decimal(18,2)")
    return shares.filter(F.col("calendar_year").between(first, last)).select(
        "country_region", "calendar_year", "channel_desc", amount_text("total").alias("amount_sold"),
        percent_text(F.col("by_channels"), 2).alias("pct_by_channels"),
        percent_text(previous, 2).alias("pct_previous_period"),
        percent_text(F.col("by_channels") - previous, 2).alias("pct_diff"),
    ).orderBy("country_region", "calendar_year", "channel_desc")


R13_BASE = f"""
WITH s AS ({SALES_SQL}), c AS ({CUSTOMER_REGION_SQL}),
d AS (SELECT country_region, year(time_id) AS calendar_year, channel_desc, sum(amount_sold) AS total
      FROM s JOIN c USING (cust_id)
      WHERE time_id >= DATE '1998-01-01' AND time_id < DATE '2002-01-01'
        AND country_region IN ('AMERICA', 'ASIA', 'EUROPE') GROUP BY 1, 2, 3),
p AS (SELECT *, CAST(round(CAST(total AS DOUBLE) / CAST(sum(total) OVER (
               PARTITION BY country_region, calendar_year) AS DOUBLE) * 100, 2) AS DECIMAL(18,2)) AS by_channels"""


@query("r13_pct_vs_previous_period", R13_BASE + """ FROM d),
l AS (SELECT *, lag(by_channels) OVER (PARTITION BY country_region, channel_desc ORDER BY calendar_year) AS prev
      FROM p)
SELECT country_region, calendar_year, channel_desc,
       CAST(CAST(total AS DECIMAL(28,2)) AS VARCHAR) || '$' AS amount_sold,
       CAST(by_channels AS VARCHAR) || '%' AS pct_by_channels,
       coalesce(CAST(prev AS VARCHAR) || '%', '0%') AS pct_previous_period,
       coalesce(CAST(by_channels - prev AS VARCHAR) || '%', '0%') AS pct_diff
FROM l WHERE calendar_year BETWEEN 1999 AND 2001""")
def r13(spark: SparkSession, sf: str) -> DataFrame:
    return percent_vs_previous(region_year_channel(spark, sf), 1999, 2001)


@query("r13b_pct_prev_by_groups_frame", R13_BASE + """,
   CAST(round(CAST(sum(total) OVER (PARTITION BY country_region, channel_desc ORDER BY calendar_year
                GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW EXCLUDE GROUP) AS DOUBLE)
            / CAST(sum(total) OVER (PARTITION BY country_region ORDER BY calendar_year
                GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW EXCLUDE GROUP) AS DOUBLE) * 100, 2)
        AS DECIMAL(18,2)) AS prev FROM d)
SELECT country_region, calendar_year, channel_desc,
       CAST(CAST(total AS DECIMAL(28,2)) AS VARCHAR) || '$' AS amount_sold,
       CAST(by_channels AS VARCHAR) || '%' AS pct_by_channels,
       CAST(prev AS VARCHAR) || '%' AS pct_previous_period,
       CAST(by_channels - prev AS VARCHAR) || '%' AS pct_diff
FROM p WHERE calendar_year BETWEEN 1999 AND 2001""")
def r13b(spark: SparkSession, sf: str) -> DataFrame:
    return percent_vs_previous_group(region_year_channel(spark, sf), 1999, 2001)


@query("r13c_pct_vs_previous_stored", ORACLES["r13_pct_vs_previous_period"])
def r13c(spark: SparkSession, sf: str) -> DataFrame:
    """On facts stored by order: the lines are not shuffled."""
    sales = stored_order_sales(spark, sf, "1998-01-01", "2002-01-01")
    return percent_vs_previous(region_year_channel(spark, sf, sales), 1999, 2001)


# --- r14: weekly running sum and an average whose frame depends on the weekday ------------


def weekly_centered_average(days: DataFrame, daily: DataFrame, first_week: int,
                            last_week: int) -> DataFrame:
    """``days`` holds the margin weeks too, so that the frames at both ends are complete.

    The windows run over days, at most a few weeks of them, never over sales.
    """
    dense = days.join(daily, "time_id", "left").withColumn(
        "_cents", F.coalesce("sold_cents", F.lit(0)))
    in_week = W.partitionBy("calendar_week_number").orderBy("time_id").rowsBetween(
        W.unboundedPreceding, W.currentRow)

    def average(back: int, on: int) -> Column:
        return F.avg("_cents").over(W.orderBy("time_id").rowsBetween(-back, on))

    centered = (
        F.when(F.col("day_name") == "Monday", average(2, 1))
        .when(F.col("day_name") == "Friday", average(1, 2))
        .otherwise(average(1, 1))
    )
    return dense.select(
        "calendar_week_number", "time_id", "day_name", money("_cents").alias("sales"),
        money(F.sum("_cents").over(in_week)).alias("cum_sum"),
        money(F.round(centered).cast("bigint")).alias("centered_3_day_avg"),
    ).filter(F.col("calendar_week_number").between(first_week, last_week)).orderBy("time_id")


@query("r14_weekly_cumsum_centered_avg", """
WITH daily AS (
  SELECT CAST(o_orderdate AS DATE) AS time_id,
         sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
days AS (
  SELECT CAST(d AS DATE) AS time_id, week(d) AS calendar_week_number, dayname(d) AS day_name
  FROM generate_series(TIMESTAMP '1999-01-01', TIMESTAMP '1999-12-31', INTERVAL 1 DAY) t(d)
  WHERE week(d) BETWEEN 48 AND 52 AND month(d) > 1),
calc AS (
  SELECT calendar_week_number, days.time_id, day_name, coalesce(cents, 0) AS cents,
         sum(coalesce(cents, 0)) OVER (PARTITION BY calendar_week_number ORDER BY days.time_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         CASE WHEN day_name = 'Monday' THEN avg(coalesce(cents, 0)) OVER (ORDER BY days.time_id
                ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)
              WHEN day_name = 'Friday' THEN avg(coalesce(cents, 0)) OVER (ORDER BY days.time_id
                ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING)
              ELSE avg(coalesce(cents, 0)) OVER (ORDER BY days.time_id
                ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) END AS centered
  FROM days LEFT JOIN daily ON daily.time_id = days.time_id)
SELECT calendar_week_number, time_id, day_name,
       CAST(CAST(cents AS DECIMAL(28,2)) / 100 AS DECIMAL(28,2)) AS sales,
       CAST(CAST(cum AS DECIMAL(28,2)) / 100 AS DECIMAL(28,2)) AS cum_sum,
       CAST(round(centered) / 100 AS DECIMAL(28,2)) AS centered_3_day_avg
FROM calc WHERE calendar_week_number BETWEEN 49 AND 51""")
def r14(spark: SparkSession, sf: str) -> DataFrame:
    # 1999-01-01 belongs to ISO week 53 of the year before, so weeks 48-52 are all in the autumn.
    days = calendar(spark, "1999-01-01", "1999-12-31").filter(
        F.col("calendar_week_number").between(48, 52))
    daily = order_sales(spark, sf, "1999-11-01", "2000-01-01").groupBy("time_id").agg(
        F.sum("sold_cents").alias("sold_cents"))
    return weekly_centered_average(days, daily, 49, 51)


@query("r14b_weekly_stored", ORACLES["r14_weekly_cumsum_centered_avg"])
def r14b(spark: SparkSession, sf: str) -> DataFrame:
    """On facts stored by order."""
    days = calendar(spark, "1999-01-01", "1999-12-31").filter(F.col("calendar_week_number").between(48, 52))
    daily = stored_order_sales(spark, sf, "1999-11-01", "2000-01-01").groupBy("time_id").agg(
        F.sum("sold_cents").alias("sold_cents"))
    return weekly_centered_average(days, daily, 49, 51)


# --- r15, r16: ROWS, GROUPS and RANGE side by side ----------------------------------------


@query("r15_frame_modes_by_category", f"""
WITH s AS ({SALES_SQL}),
src AS (SELECT p_type AS prod_category, p_brand AS prod_subcategory, p_name AS prod_name,
               sum(amount_sold) AS total
        FROM s JOIN part ON p_partkey = prod_id
        WHERE time_id >= DATE '2000-01-01' AND time_id < DATE '2001-01-01' GROUP BY 1, 2, 3)
SELECT prod_category, prod_subcategory, prod_name, CAST(total AS DECIMAL(28,2)) AS total,
  CAST(sum(total) OVER (PARTITION BY prod_category ORDER BY prod_subcategory, prod_name
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS cum_rows,
  CAST(sum(total) OVER (PARTITION BY prod_category ORDER BY prod_subcategory
    GROUPS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS cum_groups,
  CAST(sum(total) OVER (PARTITION BY prod_category ORDER BY prod_subcategory
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS cum_range
FROM src""")
def r15(spark: SparkSession, sf: str) -> DataFrame:
    per_product = product_sales(spark, sf, "2000-01-01", "2001-01-01").groupBy("prod_id").agg(
        F.sum("sold_cents").alias("sold_cents"))
    totals = per_product.join(products(spark, sf), "prod_id").groupBy(
        "prod_category", "prod_subcategory", "prod_name").agg(F.sum("sold_cents").alias("total"))
    rows = running_total(
        totals, ["prod_category"], [F.col("prod_subcategory"), F.col("prod_name")],
        F.col("total"), "cum_rows")
    # The total of a peer group is the running total of its last row, for GROUPS and RANGE alike.
    peers = rows.groupBy("prod_category", "prod_subcategory").agg(
        F.max_by("cum_rows", F.struct(F.col("prod_name").isNotNull(), "prod_name")).alias("_peers"))
    return null_safe_join(rows, peers, ["prod_category", "prod_subcategory"]).select(
        "prod_category", "prod_subcategory", "prod_name", money("total").alias("total"),
        money("cum_rows").alias("cum_rows"), money("_peers").alias("cum_groups"),
        money("_peers").alias("cum_range"))


@query("r16_frame_modes_by_date", f"""
WITH s AS ({SALES_SQL}),
src AS (SELECT time_id, amount_sold FROM s JOIN part ON p_partkey = prod_id
        WHERE time_id >= DATE '1999-01-01' AND time_id < DATE '1999-02-01' AND p_type = 'LARGE'),
days AS (SELECT CAST(d AS DATE) AS d_time FROM generate_series(
           TIMESTAMP '1999-01-01', TIMESTAMP '1999-01-31', INTERVAL 1 DAY) t(d)),
r AS (SELECT d_time, coalesce(amount_sold, 0) AS amount_sold
      FROM days LEFT JOIN src ON time_id = d_time)
SELECT d_time, CAST(amount_sold AS DECIMAL(28,2)) AS amount_sold,
  CAST(sum(amount_sold) OVER (ORDER BY d_time, amount_sold
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS cum_sum_row,
  CAST(sum(amount_sold) OVER (ORDER BY d_time
    GROUPS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS cum_sum_group,
  CAST(sum(amount_sold) OVER (ORDER BY d_time
    RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS cum_sum_range_3_days
FROM r""")
def r16(spark: SparkSession, sf: str) -> DataFrame:
    large = products(spark, sf).filter(F.col("prod_category") == "LARGE").select("prod_id")
    sales = product_sales(spark, sf, "1999-01-01", "1999-02-01", large).join(large, "prod_id", "left_semi")
    days = calendar(spark, "1999-01-01", "1999-01-31").select(F.col("time_id").alias("d_time"))
    return frame_modes_by_date(days, sales)


SALES_CHUNK = 4096


def frame_modes_by_date(days: DataFrame, sales: DataFrame) -> DataFrame:
    """Every sale of every day, days without sales as 0, with three running sums.

    A row of 0 is put in for every day; those of days with sales are taken out at the end,
    when the sums are done. The ROWS sum is over single sales and is distributed; the two
    peer sums need one row per day. All of it reads the sales once, from the buckets of
    the running total.
    """
    facts = sales.select(F.col("time_id").alias("d_time"), F.col("sold_cents").alias("amount"))
    facts = facts.join(days, "d_time", "left_semi").groupBy("d_time", "amount").agg(
        F.count(F.lit(1)).alias("_n"), F.lit(1).alias("_sale"))
    put_in = days.select("d_time", F.lit(0).cast("bigint").alias("amount"), F.lit(1).cast("bigint").alias("_n"),
                         F.lit(0).alias("_sale"))
    # Equal amounts of a day are one row with their number until the sums are done.
    sums = running_total(facts.unionByName(put_in), [], [F.col("d_time"), F.col("amount"), F.col("_sale")],
                         F.col("amount") * F.col("_n"), "_to_here")
    # equal sales become rows again chunk by chunk, and chunks are dealt out: no array, and no task, holds
    # all sales of one amount
    chunks = sums.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"), F.lit(SALES_CHUNK)))).repartition(
        "d_time", "amount", "_sale", "_from")
    upto = F.least(F.col("_from") + SALES_CHUNK - 1, F.col("_n"))
    rows = chunks.withColumn("_i", F.explode(F.sequence(F.col("_from"), upto))).select(
        "d_time", "amount", "_sale",
        (F.col("_to_here") - F.col("amount") * (F.col("_n") - F.col("_i"))).alias("cum_sum_row"))
    per_day = sums.groupBy("d_time").agg(
        F.sum(F.col("amount") * F.col("_n")).alias("_day"), F.max("_sale").alias("_has_sales"))
    peers = per_day.selectExpr(
        "d_time AS _d", "_has_sales", "sum(_day) OVER (ORDER BY d_time RANGE UNBOUNDED PRECEDING) AS _group",
        "sum(_day) OVER (ORDER BY d_time RANGE BETWEEN INTERVAL '3' DAY PRECEDING AND CURRENT ROW) AS _range",
    )
    kept = rows.join(peers, rows.d_time == peers["_d"]).filter(
        F.col("_sale") == F.col("_has_sales"))
    return kept.select(
        "d_time", money("amount").alias("amount_sold"), money("cum_sum_row").alias("cum_sum_row"),
        money("_group").alias("cum_sum_group"), money("_range").alias("cum_sum_range_3_days"))
