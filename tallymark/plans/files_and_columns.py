"""Sources and sinks, projections, filters, and whole-column jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.money import cents, money
from tallymark.operators.frames import exact_mean, fill_with, row_slice
from tallymark.plans.registry import query
from tallymark.session import scratch_path
from tallymark.sources import files
from tallymark.sources.generate import inline_values, linspace, normal, series, uniform
from tallymark.sources.tables import table

# --- a: sources and sinks -----------------------------------------------------------------


@query("a01_read_csv", "SELECT * FROM orders")
def a01(spark: SparkSession, sf: str) -> DataFrame:
    path, orders = scratch_path(spark, "orders-csv"), table(spark, sf, "orders")
    files.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema)


@query("a02_write_csv", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 1000""")
def a02(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "customers-csv")
    small = table(spark, sf, "customer").filter(F.col("c_acctbal") < 1000).select(
        "c_custkey", "c_name", "c_acctbal")
    files.write_csv(small, path)
    return files.read_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query("a03_write_json_records", "SELECT doc_id, lang, text FROM documents")
def a03(spark: SparkSession, sf: str) -> DataFrame:
    """The texts hold accents, quotes and line breaks; records come out longest text first."""
    path = scratch_path(spark, "documents-json")
    documents = table(spark, sf, "documents")
    files.write_json_records(
        documents.select("doc_id", "lang", "text", "n_chars"), path,
        [F.col("n_chars").desc(), F.col("doc_id")])
    return spark.read.schema("doc_id bigint, lang string, text string").json(path)


@query("a04_write_parquet", "SELECT * FROM part")
def a04(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parts-parquet")
    files.write_table(table(spark, sf, "part"), path)
    return files.read_table(spark, path)


@query("a05_write_avro", """
SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, CAST(o_orderdate AS DATE) AS day, o_totalprice,
  CAST(o_totalprice AS DECIMAL(12,2)) AS price, [o_custkey, o_orderkey] AS keys FROM orders""")
def a05(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as Avro files and back: whole numbers, text with nulls, dates, decimals, lists."""
    path = scratch_path(spark, "orders-avro")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"), F.to_date("o_orderdate").alias("day"),
        "o_totalprice", F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.array("o_custkey", "o_orderkey").alias("keys"))
    files.write_table(orders, path, "avro")
    return files.read_table(spark, path, "avro")


ONE_LINE_SQL = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


@query("a06_read_delimited_docs", f"SELECT doc_id, lower({ONE_LINE_SQL}) AS text FROM documents")
def a06(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "documents-tsv")
    one_line = F.trim(F.regexp_replace("text", r"\s+", " "))
    lines = table(spark, sf, "documents").select(
        F.concat_ws("\t", F.col("doc_id").cast("string"), one_line).alias("value"))
    files.write_lines(lines, path)
    return files.read_delimited_docs(spark, path)


@query("a07_read_words", "SELECT lower(trim(p_name)) AS word FROM part")
def a07(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "words")
    padded = table(spark, sf, "part").select(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")))
    files.write_lines(padded.union(spark.range(3).select(F.lit("   "))), path)
    return files.read_words(spark, path)


@query("a08_write_lines", "SELECT c_name || ' ' || c_mktsegment AS value FROM customer")
def a08(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    files.write_lines(
        table(spark, sf, "customer").select(F.concat_ws(" ", "c_name", "c_mktsegment")), path)
    return spark.read.text(path)


@query("a09_inline_values", """
SELECT o_orderkey, label, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * weight AS DECIMAL(28,2)) AS weighted
FROM orders JOIN (VALUES ('1-URGENT', 'now', 3), ('2-HIGH', 'soon', 2), ('3-MEDIUM', 'later', 1))
  v(priority, label, weight) ON priority = o_orderpriority""")
def a09(spark: SparkSession, sf: str) -> DataFrame:
    weights = inline_values(
        spark, [("1-URGENT", "now", 3), ("2-HIGH", "soon", 2), ("3-MEDIUM", "later", 1)],
        "priority string, label string, weight int")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return orders.join(F.broadcast(weights), orders.o_orderpriority == weights.priority).select(
        "o_orderkey", "label", money(cents("o_totalprice") * F.col("weight")).alias("weighted"))


@query("a10_generate_series", """
SELECT 'veeeeeeery_long_string' || x AS col, x * x AS square
FROM generate_series(1, (SELECT count(*) FROM lineitem)) t(x)""")
def a10(spark: SparkSession, sf: str) -> DataFrame:
    """As many generated rows as there are sale lines."""
    rows = table(spark, sf, "lineitem").count()
    return series(spark, 1, rows).select(
        F.concat(F.lit("veeeeeeery_long_string"), F.col("x").cast("string")).alias("col"),
        (F.col("x") * F.col("x")).alias("square"))


@query("a11_linspace", """
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n FROM orders)
SELECT i, round(CASE WHEN i = n - 1 THEN hi ELSE lo + i * ((hi - lo) / (n - 1)) END, 6) AS x
FROM s, generate_series(0, n - 1) t(i)""")
def a11(spark: SparkSession, sf: str) -> DataFrame:
    """A grid over the range of order prices with a point per order."""
    ends = table(spark, sf, "orders").agg(
        F.min("o_totalprice"), F.max("o_totalprice"), F.count(F.lit(1))).first()
    grid = linspace(spark, ends[0], ends[1], ends[2])
    return grid.select("i", F.round("x", 6).alias("x"))


@query("a12_random_columns", """
WITH u AS (
  SELECT o_orderkey,
    CAST(('0x' || substr(md5('7|' || o_orderkey), 1, 13)) AS BIGINT) / 4503599627370496.0 AS flat,
    CAST(('0x' || substr(md5('7u|' || o_orderkey), 1, 13)) AS BIGINT) / 4503599627370496.0 AS a,
    CAST(('0x' || substr(md5('7v|' || o_orderkey), 1, 13)) AS BIGINT) / 4503599627370496.0 AS b
  FROM orders)
SELECT o_orderkey, round(flat, 9) AS uniform, round(sqrt(-2 * ln(1 - a)) * cos(2 * pi() * b), 9) AS normal
FROM u""")
def a12(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round(uniform("7", key), 9).alias("uniform"),
        F.round(normal("7", key), 9).alias("normal"))


# --- b: projections, filters, predicates --------------------------------------------------


@query("b01_compare_between", """
SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 AND o_custkey > 10
  AND o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'""")
def b01(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").filter(
        F.col("o_totalprice").between(1000.0, 200000.0) & (F.col("o_custkey") > 10)
        & (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))).select("o_orderkey")


@query("b02_in_list", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_linenumber IN (1, 3, 7)""")
def b02(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").filter(
        F.col("l_returnflag").isin("A", "R") & F.col("l_linenumber").isin(1, 3, 7)
    ).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("b03_row_value_in", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE (p_name, p_brand) IN (('red widget', 'Brand#17'), ('blue bolt', 'Brand#4'), ('hot plate', 'Brand#1'))""")
def b03(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_brand").filter(
        "(p_name, p_brand) IN (('red widget', 'Brand#17'), ('blue bolt', 'Brand#4'), ('hot plate', 'Brand#1'))")


@query("b04_in_subquery", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
  SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50)""")
def b04(spark: SparkSession, sf: str) -> DataFrame:
    richest = table(spark, sf, "customer").orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(50)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return orders.join(F.broadcast(richest), orders.o_custkey == richest.c_custkey, "left_semi")


@query("b05_scalar_subquery", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice >= (SELECT max(o_totalprice) * 0.9 FROM orders)
   OR o_orderdate = (SELECT min(o_orderdate) FROM orders)""")
def b05(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    limit = orders.agg(F.max("o_totalprice") * 0.9).scalar()
    first = orders.agg(F.min("o_orderdate")).scalar()
    return orders.filter((F.col("o_totalprice") >= limit) | (F.col("o_orderdate") == first)).select(
        "o_orderkey", "o_totalprice")


@query("b06_correlated_scalar", """
SELECT o.o_custkey, o.o_orderkey FROM orders o
WHERE o.o_totalprice = (SELECT max(i.o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)""")
def b06(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("""
        SELECT o.o_custkey, o.o_orderkey FROM {orders} o
        WHERE o.o_totalprice = (
          SELECT max(i.o_totalprice) FROM {orders} i WHERE i.o_custkey = o.o_custkey)""",
                     orders=table(spark, sf, "orders"))


@query("b07_not_exists", """
SELECT DISTINCT l_partkey, l_suppkey FROM lineitem a WHERE NOT EXISTS (
  SELECT 1 FROM lineitem b WHERE b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey
    AND b.l_returnflag = 'R')""")
def b07(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    returned = lines.filter(F.col("l_returnflag") == "R").select("l_partkey", "l_suppkey").distinct()
    pairs = lines.select("l_partkey", "l_suppkey").distinct()
    return pairs.join(returned, ["l_partkey", "l_suppkey"], "left_anti")


@query("b08_null_tests", """
SELECT o_orderkey, l_orderkey IS NULL AS has_no_lines, trim('  ' || o_orderstatus) <> '' AS has_status
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey
WHERE o_orderkey IS NOT NULL""")
def b08(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").filter(F.col("o_orderkey").isNotNull())
    with_lines = table(spark, sf, "lineitem").select("l_orderkey").distinct()
    return orders.join(with_lines, orders.o_orderkey == with_lines.l_orderkey, "left").select(
        "o_orderkey", F.col("l_orderkey").isNull().alias("has_no_lines"),
        (F.trim(F.concat(F.lit("  "), "o_orderstatus")) != "").alias("has_status"))


@query("b09_bool_mask", """
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3""")
def b09(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    mask = (customer.c_mktsegment == "BUILDING") & (customer.c_nationkey == 3)
    return customer.filter(mask).select("c_custkey", "c_name")


@query("b10_prefix_predicate", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'r%'")
def b10(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter(F.col("p_name").startswith("r")).select("p_partkey", "p_name")


@query("b11_row_slice", """
SELECT row_num, c_custkey, c_name FROM (
  SELECT row_number() OVER (ORDER BY c_name DESC, c_custkey) - 1 AS row_num, c_custkey, c_name FROM customer)
WHERE row_num BETWEEN 3 AND 10""")
def b11(spark: SparkSession, sf: str) -> DataFrame:
    """Rows 3 to 10, both included."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    return row_slice(customer, [F.col("c_name").desc(), F.col("c_custkey")], 3, 11)


@query("b11b_row_slice_step", """
SELECT row_num, o_orderkey FROM (
  SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_num, o_orderkey FROM orders)
WHERE row_num >= 2 AND (row_num - 2) % 3 = 0""")
def b11b(spark: SparkSession, sf: str) -> DataFrame:
    """Every third row from row 2 to the end."""
    orders = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    return row_slice(orders, order, 2, None, 3).drop("o_orderdate")


@query("b12_derived_column", """
SELECT l_orderkey, l_linenumber, l_partkey + l_suppkey + l_linenumber AS key_sum,
       CAST(round(CAST(round(l_extendedprice * 100) AS BIGINT) / l_quantity) / 100 AS DECIMAL(28,2)) AS unit_price
FROM lineitem""")
def b12(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_partkey") + F.col("l_suppkey") + F.col("l_linenumber")).alias("key_sum"),
        money(F.round(cents("l_extendedprice") / F.col("l_quantity")).cast("bigint")).alias("unit_price"))


@query("b13_drop_rename", "SELECT n_nationkey AS col_1, n_name AS col_2 FROM nation")
def b13(spark: SparkSession, sf: str) -> DataFrame:
    kept = table(spark, sf, "nation").drop("n_regionkey")
    return kept.toDF(*[f"col_{i}" for i in range(1, len(kept.columns) + 1)])


@query("b14_cast_column", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS BIGINT) AS whole_price, CAST(o_orderkey AS VARCHAR) AS key_text,
       CAST(o_orderdate AS DATE) AS day, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
       TRY_CAST(o_orderpriority AS INTEGER) AS no_number FROM orders""")
def b14(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round("o_totalprice").cast("bigint").alias("whole_price"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        F.col("o_orderpriority").try_cast("int").alias("no_number"))


@query("b15_map_values", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS is_final FROM orders""")
def b15(spark: SparkSession, sf: str) -> DataFrame:
    lookup = F.create_map(F.lit("F"), F.lit(True), F.lit("O"), F.lit(False))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.try_element_at(lookup, F.col("o_orderstatus")).alias("is_final"))


@query("b16_apply_elementwise", """
WITH m AS (SELECT sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*) AS mean FROM orders)
SELECT o_orderkey, round((o_totalprice * 100 + mean * 0.02) / 100, 4) AS raised,
       o_custkey * o_custkey * o_custkey AS cubed, round(exp(o_totalprice / 1000000), 9) AS grown
FROM orders, m""")
def b16(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    mean = orders.agg(exact_mean(cents("o_totalprice"))).scalar()
    return orders.select(
        "o_orderkey", F.round((F.col("o_totalprice") * 100 + mean * 0.02) / 100, 4).alias("raised"),
        (F.col("o_custkey") * F.col("o_custkey") * F.col("o_custkey")).alias("cubed"),
        F.round(F.exp(F.col("o_totalprice") / 1000000), 9).alias("grown"))


@query("b17_fillna", """
WITH g AS (SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS d,
                  CAST(round(nullif(l_discount, 0) * 100) AS BIGINT) AS pct FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(d, 0) AS with_zero,
       coalesce(d, (SELECT min(d) FROM g)) AS with_min,
       round(coalesce(pct, (SELECT sum(pct) / count(pct) FROM g)), 6) AS with_mean FROM g""")
def b17(spark: SparkSession, sf: str) -> DataFrame:
    discount = F.nullif(F.col("l_discount"), F.lit(0.0))
    gaps = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", discount.alias("with_zero"), discount.alias("with_min"),
        cents(discount).cast("double").alias("with_mean"))
    filled = fill_with(gaps.na.fill(0.0, ["with_zero"]), "with_min", F.min("with_min"))
    mean = exact_mean(F.col("with_mean").cast("bigint"))
    return fill_with(filled, "with_mean", mean).withColumn("with_mean", F.round("with_mean", 6))
