"""Scalar functions, views, table functions, row filters and user-defined functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.dates import days_between, quarter_end
from tallymark.functions.money import cents, money, percent_text
from tallymark.functions.numbers import division_report, unit_price
from tallymark.functions.text import (
    ascii_words, brackets_balance, combinations, find_substring, title_case, words)
from tallymark.operators.aggregates import aggregate_by
from tallymark.operators.joins import null_safe_join
from tallymark.operators.lists import comma_lists
from tallymark.plans.registry import query
from tallymark.sources.tables import table

# --- h: scalar functions ------------------------------------------------------------------


@query("h01_case_when", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'middle' ELSE 'small' END AS size,
       CASE WHEN o_orderstatus = 'F' THEN 'done' END AS done FROM orders""")
def h01(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    size = F.when(price >= 300000, "large").when(price >= 100000, "middle").otherwise("small")
    return table(spark, sf, "orders").select(
        "o_orderkey", size.alias("size"), F.when(F.col("o_orderstatus") == "F", "done").alias("done"))


@query("h02_coalesce", """
SELECT o_orderkey, coalesce(CAST(n AS VARCHAR), '-') AS lines FROM orders
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def h02(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    orders = table(spark, sf, "orders").select("o_orderkey")
    return orders.join(counts, orders.o_orderkey == counts.l_orderkey, "left").select(
        "o_orderkey", F.coalesce(F.col("n").cast("string"), F.lit("-")).alias("lines"))


@query("h03_concat", """
SELECT c_custkey, c_name || ' ' || c_mktsegment AS both_parts, c_name || nullif(c_mktsegment, 'BUILDING') AS maybe,
       concat_ws(', ', c_name, nullif(c_mktsegment, 'BUILDING')) AS skipping FROM customer""")
def h03(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return table(spark, sf, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(" "), "c_mktsegment").alias("both_parts"),
        F.concat("c_name", segment).alias("maybe"), F.concat_ws(", ", "c_name", segment).alias("skipping"))


@query("h04_case_fold", """
SELECT p_partkey, lower(p_type) AS low, upper(p_name) AS up, lower(p_brand) = lower('BRAND#7') AS is_seven,
       array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM part""")
def h04(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", F.lower("p_type").alias("low"), F.upper("p_name").alias("up"),
        (F.lower("p_brand") == "brand#7").alias("is_seven"), F.initcap("p_name").alias("title"))


@query("h05_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt' OR p_name ILIKE '%RED%'")
def h05(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, sf, "part").filter(name.like("%bolt") | name.ilike("%RED%")).select(
        "p_partkey", "p_name")


@query("h06_trim_length", """
SELECT p_partkey, length(trim('  ' || p_name || ' ')) AS n, length('  ' || p_name) AS padded FROM part""")
def h06(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit("  "), "p_name")
    return table(spark, sf, "part").select(
        "p_partkey", F.length(F.trim(F.concat(padded, F.lit(" ")))).alias("n"),
        F.length(padded).alias("padded"))


@query("h07_replace", "SELECT c_custkey, CAST(replace(c_name, 'Customer#', '') AS BIGINT) AS n FROM customer")
def h07(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", F.replace("c_name", F.lit("Customer#"), F.lit("")).cast("bigint").alias("n"))


@query("h08_format_text", """
SELECT o_orderkey, 'TX-' || o_orderkey AS ref, 'order ' || o_orderkey || ' of ' || o_custkey AS label FROM orders""")
def h08(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", F.format_string("TX-%s", "o_orderkey").alias("ref"),
        F.format_string("order %d of %d", "o_orderkey", "o_custkey").alias("label"))


@query("h09_find_substring", """
SELECT p_partkey, instr(p_name, 'ring') - 1 AS ring_at, instr(p_name, split_part(p_name, ' ', 2)) - 1 AS noun_at,
       0 AS nothing_at FROM part""")
def h09(spark: SparkSession, sf: str) -> DataFrame:
    noun = F.split_part("p_name", F.lit(" "), F.lit(2))
    return table(spark, sf, "part").select(
        "p_partkey", find_substring("p_name", F.lit("ring")).alias("ring_at"),
        find_substring("p_name", noun).alias("noun_at"),
        find_substring("p_name", F.lit("")).alias("nothing_at"))


@query("h10_regex_words", r"""
SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z]+')) AS ascii_words,
       len(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda w: w <> '')) AS words,
       len(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda w: w <> ''))) AS distinct_words
FROM documents""")
def h10(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", F.size(ascii_words("text")).alias("ascii_words"),
        F.size(words("text")).alias("words"),
        F.size(F.array_distinct(words("text"))).alias("distinct_words"))


@query("h11_extract_parts", """
SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, quarter(o_orderdate) AS q FROM orders""")
def h11(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
        F.quarter("o_orderdate").alias("q"))


@query("h12_date_trunc", """
SELECT event_id, CAST(date_trunc('quarter', ts) AS DATE) AS q, CAST(date_trunc('month', ts) AS DATE) AS m,
       date_trunc('hour', ts) AS h FROM events""")
def h12(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.trunc("ts", "quarter").alias("q"), F.trunc("ts", "month").alias("m"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"))


@query("h13_to_char", """
SELECT event_id, strftime(ts, '%Y-%m') AS month, strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment FROM events""")
def h13(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM").alias("month"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query("h14_interval_math", """
SELECT o_orderkey, CAST(o_orderdate + INTERVAL 3 MONTH AS DATE) AS later, CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS before,
       last_day(CAST(o_orderdate AS DATE)) AS month_end,
       CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
       CAST(o_orderdate - INTERVAL 18 YEAR AS DATE) AS adult_before FROM orders""")
def h14(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.add_months(day, 3).alias("later"), F.date_sub(day, 1).alias("before"),
        F.last_day(day).alias("month_end"), quarter_end(day).alias("quarter_end"),
        F.add_months(day, -12 * 18).alias("adult_before"))


@query("h15_duration", """
SELECT l_orderkey, l_linenumber, l_partkey,
       date_diff('second', o_orderdate, l_shipdate) > 30 * 86400 AS over_30_days,
       CAST(floor(date_diff('second', o_orderdate, l_shipdate) / 86400.0) AS BIGINT) AS whole_days
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def h15(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    days = days_between(F.col("o_orderdate"), F.col("l_shipdate"))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", (days > 30).alias("over_30_days"),
        F.floor(days).alias("whole_days"))


@query("h16_now", """
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS age_days FROM orders""")
def h16(spark: SparkSession, sf: str) -> DataFrame:
    return order_ages(table(spark, sf, "orders"), "2002-01-01")


def order_ages(orders: DataFrame, as_of: str | None = None) -> DataFrame:
    """Age in days on a given day, today by default."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return orders.select("o_orderkey", F.date_diff(today, F.to_date("o_orderdate")).alias("age_days"))


@query("h17_date_of_ts", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def h17(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))


@query("h18_round", """
SELECT p_partkey, round(p_size / 8, 2) AS half_up, round_even(p_size / 8, 2) AS half_even, round(p_size / 7, 4) AS four
FROM part""")
def h18(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", F.round(F.col("p_size") / 8, 2).alias("half_up"),
        F.bround(F.col("p_size") / 8, 2).alias("half_even"),
        F.round(F.col("p_size") / 7, 4).alias("four"))


@query("h19_percent_money_text", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_discount * 100 AS DECIMAL(18,4)) AS VARCHAR) || '%' AS discount,
       CAST(CAST(l_extendedprice AS DECIMAL(28,2)) AS VARCHAR) || '$' AS price FROM lineitem""")
def h19(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        percent_text(F.col("l_discount") * 100, 4).alias("discount"),
        F.concat(money(cents("l_extendedprice")).cast("string"), F.lit("$")).alias("price"))


@query("h20_modulo_power", """
SELECT p_partkey, p_partkey % 3 AS rest, CAST(pow(p_size, 3) AS BIGINT) AS cube,
       CAST(pow(p_size, p_partkey % 4) AS BIGINT) AS by_column, CAST(pow(10, 7) AS BIGINT) AS ten_million FROM part""")
def h20(spark: SparkSession, sf: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", (key % 3).alias("rest"), F.pow(size, F.lit(3)).cast("bigint").alias("cube"),
        F.pow(size, key % 4).cast("bigint").alias("by_column"),
        F.pow(F.lit(10), F.lit(7)).cast("bigint").alias("ten_million"))


@query("h21_floor", "SELECT o_orderkey, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands FROM orders")
def h21(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", F.floor(F.col("o_totalprice") / 1000).alias("thousands"))


@query("h22_safe_division", """
WITH t AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS a,
             CASE WHEN o_orderpriority = '5-LOW' THEN 'aba' ELSE CAST(o_orderkey % 5 AS VARCHAR) END AS b FROM orders),
n AS (SELECT o_orderkey, TRY_CAST(a AS DOUBLE) AS x, TRY_CAST(b AS DOUBLE) AS y FROM t)
SELECT o_orderkey, CASE WHEN x IS NULL OR y IS NULL THEN 'Entered value is wrong' WHEN y = 0 THEN 'Can''t divide by zero'
  WHEN x / y = floor(x / y) THEN CAST(CAST(x / y AS BIGINT) AS VARCHAR) ELSE format('{:.3f}', x / y) END AS answer FROM n""")
def h22(spark: SparkSession, sf: str) -> DataFrame:
    low = F.col("o_orderpriority") == "5-LOW"
    texts = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("a"),
        F.when(low, "aba").otherwise((F.col("o_orderkey") % 5).cast("string")).alias("b"))
    return texts.select("o_orderkey", division_report("a", "b").alias("answer"))


@query("h23_unit_price", """
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN -1 ELSE round(p_retailprice / (p_size % 4), 2) END AS unit_price FROM part""")
def h23(spark: SparkSession, sf: str) -> DataFrame:
    houses = table(spark, sf, "part").withColumn("area", F.nullif(F.col("p_size") % 4, F.lit(0)))
    return houses.select("p_partkey", unit_price("p_retailprice", "area").alias("unit_price"))


@query("h26_balanced_brackets", """
WITH c AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '[^()]', '', 'g'), '')) AS ch,
                  generate_subscripts(string_split(regexp_replace(text, '[^()]', '', 'g'), ''), 1) AS i FROM documents),
b AS (SELECT doc_id, i, sum(CASE ch WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS depth FROM c),
s AS (SELECT doc_id, min(depth) >= 0 AND arg_max(depth, i) = 0 AS ok FROM b GROUP BY 1)
SELECT doc_id, coalesce(ok, TRUE) AS balanced FROM documents LEFT JOIN s USING (doc_id)""")
def h26(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", brackets_balance("text").alias("balanced"))


@query("h27_array_combinations", """
SELECT p_partkey, string_agg(w || k || s, ',' ORDER BY i, j, l) AS combinations FROM (
  SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part) a
JOIN (SELECT p_partkey AS pk, unnest([p_type, p_brand]) AS k, unnest([1, 2]) AS j FROM part) b ON pk = p_partkey
JOIN (SELECT p_partkey AS pl, unnest(string_split(CAST(p_size AS VARCHAR), '')) AS s,
             generate_subscripts(string_split(CAST(p_size AS VARCHAR), ''), 1) AS l FROM part) c ON pl = p_partkey
GROUP BY p_partkey""")
def h27(spark: SparkSession, sf: str) -> DataFrame:
    """One word of the name, type or brand, one digit of the size."""
    lists = F.array(F.split("p_name", " "), F.array("p_type", "p_brand"),
                    F.split(F.col("p_size").cast("string"), ""))
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(combinations(lists), ",").alias("combinations"))


@query("h28_transpose", """
SELECT i - 1 AS row, vec_id AS col, v AS value FROM (
  SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)""")
def h28(spark: SparkSession, sf: str) -> DataFrame:
    matrix = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row"), F.posexplode("embedding").alias("col", "value"))
    return transpose(matrix)


def transpose(matrix: DataFrame) -> DataFrame:
    """A matrix as (row, col, value) of any size."""
    return matrix.select(F.col("col").alias("row"), F.col("row").alias("col"), "value")


@query("h29_array_unnest", """
SELECT conv_id, turn, len(w) AS n, list_contains(w, 'the') AS has_the, u AS word FROM (
  SELECT conv_id, turn, string_split(text, ' ') AS w, unnest(string_split(text, ' ')) AS u FROM conversations)""")
def h29(spark: SparkSession, sf: str) -> DataFrame:
    split = table(spark, sf, "conversations").select("conv_id", "turn", F.split("text", " ").alias("w"))
    return split.select("conv_id", "turn", F.size("w").alias("n"),
                        F.array_contains("w", "the").alias("has_the"), F.explode("w").alias("word"))


# --- i: views, parameterised relations, row filters ---------------------------------------


@query("i01_cte_chain", """
WITH rich AS (SELECT c_custkey FROM customer WHERE c_acctbal > 5000),
theirs AS (SELECT o_orderkey, o_custkey FROM orders JOIN rich ON c_custkey = o_custkey),
lines AS (SELECT o_custkey, l_partkey FROM lineitem JOIN theirs ON o_orderkey = l_orderkey),
counted AS (SELECT o_custkey, count(DISTINCT l_partkey) AS parts FROM lines GROUP BY 1)
SELECT parts, count(*) AS customers FROM counted GROUP BY 1""")
def i01(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("""
        WITH rich AS (SELECT c_custkey FROM {customer} WHERE c_acctbal > 5000),
        theirs AS (SELECT o_orderkey, o_custkey FROM {orders} JOIN rich ON c_custkey = o_custkey),
        lines AS (SELECT o_custkey, l_partkey FROM {lineitem} JOIN theirs ON o_orderkey = l_orderkey),
        counted AS (SELECT o_custkey, count(DISTINCT l_partkey) AS parts FROM lines GROUP BY 1)
        SELECT parts, count(*) AS customers FROM counted GROUP BY 1""",
                     **{t: table(spark, sf, t) for t in ("customer", "orders", "lineitem")})


@query("i02_view", """
SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1""")
def i02(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "orders").filter(F.col("o_orderstatus") == "O").createOrReplaceTempView("open_orders")
    return spark.sql("SELECT o_orderpriority, count(*) AS n FROM open_orders GROUP BY 1")


@query("i03_table_function", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice >= 400000""")
def i03(spark: SparkSession, sf: str) -> DataFrame:
    return orders_of_status(table(spark, sf, "orders"), "P", 400000)


def orders_of_status(orders: DataFrame, status: str | None, least: float = 0) -> DataFrame:
    """A parameterised relation with a default; NULL gives no rows, a blank is refused."""
    if status is not None and not status.strip():
        raise ValueError('parameter "status" must not be empty')
    wanted = F.col("o_orderstatus") == F.lit(status).cast("string")
    return orders.filter(wanted & (F.col("o_totalprice") >= least)).select("o_orderkey", "o_totalprice")


@query("i04_row_level_filter", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = (
  SELECT c_custkey FROM customer WHERE lower('client_' || c_name) = 'client_customer#000000007')""")
def i04(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return own_rows(orders, table(spark, sf, "customer"), "client_customer#000000007").drop("o_custkey")


def own_rows(orders: DataFrame, customers: DataFrame, user: str | None = None) -> DataFrame:
    """Rows of the customer a user name stands for; the session's user by default."""
    name = F.session_user() if user is None else F.lit(user)
    me = customers.filter(F.lower(F.concat(F.lit("client_"), "c_name")) == F.lower(name)).select(
        F.col("c_custkey").alias("o_custkey"))
    return orders.join(me, "o_custkey", "left_semi")


# --- o: user-defined functions ------------------------------------------------------------


@query("o01_scalar_sql_function", """
SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS month_end, round(o_totalprice * 0.8, 2) AS reduced FROM orders""")
def o01(spark: SparkSession, sf: str) -> DataFrame:
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION month_end(d DATE) RETURNS DATE
        RETURN date_sub(add_months(trunc(d, 'month'), 1), 1)""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION reduced(price DOUBLE, rate DOUBLE DEFAULT 0.8D) RETURNS DOUBLE
        RETURN round(price * rate, 2)""")
    return spark.sql("""
        SELECT o_orderkey, month_end(CAST(o_orderdate AS DATE)) AS month_end, reduced(o_totalprice) AS reduced
        FROM {orders}""", orders=table(spark, sf, "orders"))


@query("o02_table_function", """
SELECT p_type AS film_category,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(28,2)) AS revenue_for_quarter
FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE l_shipdate >= DATE '1998-10-01' AND l_shipdate < DATE '1999-01-01' GROUP BY 1""")
def o02(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "lineitem").createOrReplaceTempView("sale_lines")
    table(spark, sf, "part").createOrReplaceTempView("sale_parts")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION revenue_of_quarter(day DATE DEFAULT NULL)
        RETURNS TABLE (film_category STRING, revenue_for_quarter DECIMAL(28,2))
        RETURN SELECT p_type, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) * 0.01BD AS DECIMAL(28,2))
               FROM sale_lines JOIN sale_parts ON p_partkey = l_partkey
               WHERE l_shipdate >= CAST(trunc(day, 'quarter') AS TIMESTAMP_NTZ)
                 AND l_shipdate < CAST(add_months(trunc(day, 'quarter'), 3) AS TIMESTAMP_NTZ)
               GROUP BY p_type""")
    return spark.sql("SELECT * FROM revenue_of_quarter(DATE '1998-11-15')")


@query("o03_custom_aggregate", """
WITH n AS (SELECT l_suppkey, l_partkey, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) - 1) // 100 AS chunk
           FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem))
SELECT l_suppkey, chunk, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts FROM n GROUP BY 1, 2""")
def o03(spark: SparkSession, sf: str) -> DataFrame:
    """``group_concat`` of the parts of every supplier, a hundred to a row."""
    pairs = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return comma_lists(pairs, ["l_suppkey"], [F.col("l_partkey")], "l_partkey", "parts", 100)


MODULUS = 1_000_000_007


def with_place(places: list, *place) -> list:
    places.append(place)
    return places


@query("o03b_own_aggregate", f"""
SELECT l_returnflag, l_suppkey, string_agg(CAST(l_linenumber AS VARCHAR), '' ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey)
  AS numbers, list_reduce(list(CAST(l_quantity AS BIGINT)), lambda a, b: (a * b) % {MODULUS}) AS product
FROM lineitem GROUP BY 1, 2""")
def o03b(spark: SparkSession, sf: str) -> DataFrame:
    """Two aggregates given as functions: a concatenation in the order of dates, and a product."""
    lines = table(spark, sf, "lineitem")
    numbers = aggregate_by(
        lines, ["l_returnflag", "l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"],
        start=list, step=with_place,
        merge=lambda a, b: a + b, finish=lambda state: "".join(str(p[2]) for p in sorted(state)),
        name="numbers", kind="string")
    products = aggregate_by(
        lines.select("l_returnflag", "l_suppkey", F.col("l_quantity").cast("bigint").alias("q")),
        ["l_returnflag", "l_suppkey"], ["q"], start=lambda: 1, step=lambda state, q: state * q % MODULUS,
        merge=lambda a, b: a * b % MODULUS, finish=lambda state: state, name="product", kind="bigint")
    return null_safe_join(numbers, products, ["l_returnflag", "l_suppkey"])


@query("o02b_table_function_lateral", """
SELECT date_trunc('quarter', CAST(l_shipdate AS DATE))::DATE AS quarter, p_type AS film_category,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(28,2)) AS revenue_for_quarter
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2""")
def o02b(spark: SparkSession, sf: str) -> DataFrame:
    """The table function of a quarter applied to a table of quarters, in one plan: a join and an aggregate.

    The quarter is compared for equality, which the optimizer turns into an equi-join with the arguments.
    """
    table(spark, sf, "lineitem").createOrReplaceTempView("sale_lines")
    table(spark, sf, "part").createOrReplaceTempView("sale_parts")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION revenue_in_quarter_of(day DATE)
        RETURNS TABLE (film_category STRING, revenue_for_quarter DECIMAL(28,2))
        RETURN SELECT p_type, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) * 0.01BD AS DECIMAL(28,2))
               FROM sale_lines JOIN sale_parts ON p_partkey = l_partkey
               WHERE trunc(CAST(l_shipdate AS DATE), 'quarter') = trunc(day, 'quarter') GROUP BY p_type""")
    return spark.sql("""
        WITH asked AS (SELECT DISTINCT trunc(CAST(l_shipdate AS DATE), 'quarter') AS quarter FROM sale_lines)
        SELECT quarter, film_category, revenue_for_quarter FROM asked, LATERAL revenue_in_quarter_of(asked.quarter)""")


@query("i03b_table_function_lateral", """
WITH asked AS (SELECT DISTINCT o_orderstatus AS status, o_orderpriority AS priority FROM orders)
SELECT status, priority, count(*) AS orders, max(o_totalprice) AS highest FROM asked
JOIN orders ON o_orderstatus = status AND o_orderpriority = priority GROUP BY 1, 2""")
def i03b(spark: SparkSession, sf: str) -> DataFrame:
    """A table function of two arguments, called for every row of a table of arguments, in SQL."""
    return spark.sql("""
        SELECT status, priority, orders, highest
        FROM (SELECT DISTINCT o_orderstatus AS status, o_orderpriority AS priority FROM {orders}) asked,
        LATERAL (SELECT count(*) AS orders, max(o_totalprice) AS highest FROM {orders}
                 WHERE o_orderstatus = asked.status AND o_orderpriority = asked.priority)""",
                     orders=table(spark, sf, "orders"))


@query("o04_lambda_udf", """
SELECT p_partkey, p_size * p_size * p_size AS cubed,
       array_to_string(list_transform(regexp_extract_all(lower(p_brand || '-' || p_name), '[a-z]+|[^a-z]+'),
                                      lambda x: upper(x[1]) || x[2:]), '') AS title
FROM part WHERE p_name LIKE 's%'""")
def o04(spark: SparkSession, sf: str) -> DataFrame:
    """Row lambdas are column expressions, title case too."""
    return table(spark, sf, "part").filter(F.col("p_name").startswith("s")).select(
        "p_partkey", (F.col("p_size") * F.col("p_size") * F.col("p_size")).alias("cubed"),
        title_case(F.lower(F.concat_ws("-", "p_brand", "p_name"))).alias("title"))
