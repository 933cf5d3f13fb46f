"""Table maintenance jobs and constraint checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import maintenance as m
from tallymark.operators import quality as q
from tallymark.plans.registry import query
from tallymark.session import scratch_path
from tallymark.sources import files
from tallymark.sources.generate import inline_values
from tallymark.sources.tables import TABLES, table

# --- j: table maintenance -----------------------------------------------------------------


@query("j01_insert_if_absent", """
SELECT o_orderkey, o_custkey, 'old' AS origin FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, 'new' FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderstatus = 'F' AND e.o_orderkey = o.o_orderkey)""")
def j01(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    existing = orders.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", F.lit("old").alias("origin"))
    batch = orders.select("o_orderkey", "o_custkey", F.lit("new").alias("origin"))
    return m.insert_if_absent(existing, batch, ["o_orderkey"])


@query("j02_on_conflict_do_nothing", """
WITH batch AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                 ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem WHERE l_returnflag <> 'A')
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM batch b
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM lineitem e WHERE e.l_returnflag = 'A'
  AND e.l_orderkey = b.l_orderkey AND e.l_linenumber = b.l_linenumber)""")
def j02(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    batch = lines.filter(F.col("l_returnflag") != "A").select(*columns)
    existing = lines.filter(F.col("l_returnflag") == "A")
    return m.insert_on_conflict_do_nothing(
        existing, batch, ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])


@query("j03_update_from", """
WITH w AS (SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS qty FROM lineitem WHERE l_returnflag = 'R'
           GROUP BY 1 HAVING count(*) >= 200)
SELECT s_suppkey, CASE WHEN l_suppkey IS NOT NULL THEN 'busy' ELSE s_name END AS s_name,
       CASE WHEN l_suppkey IS NOT NULL THEN CAST(qty AS DOUBLE) ELSE s_acctbal END AS s_acctbal
FROM supplier LEFT JOIN w ON l_suppkey = s_suppkey""")
def j03(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return m.update_from(target, busy_suppliers(spark, sf), ["s_suppkey"], ["s_name", "s_acctbal"])


def busy_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    chosen = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").groupBy(
        F.col("l_suppkey").alias("s_suppkey")).agg(
        F.sum("l_quantity").alias("s_acctbal"), F.count(F.lit(1)).alias("_n"))
    return chosen.filter(F.col("_n") >= 200).select("s_suppkey", "s_acctbal", F.lit("busy").alias("s_name"))


@query("j03b_update_returning", """
SELECT s_suppkey, 'busy' AS s_name, CAST(sum(l_quantity) AS DOUBLE) AS s_acctbal
FROM supplier JOIN lineitem ON l_suppkey = s_suppkey WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(*) >= 200""")
def j03b(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that the update of j03 has set."""
    target = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return m.updated_rows(target, busy_suppliers(spark, sf), ["s_suppkey"], ["s_name", "s_acctbal"])


@query("j04_delete_where", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (
  SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING')""")
def j04(spark: SparkSession, sf: str) -> DataFrame:
    """Rows left when the sale lines of some customers are deleted."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return m.delete_matching(lines, building_orders(spark, sf), ["l_orderkey"])


def building_orders(spark: SparkSession, sf: str) -> DataFrame:
    buyers = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    orders = table(spark, sf, "orders")
    return orders.join(buyers, orders.o_custkey == buyers.c_custkey, "left_semi").select(
        F.col("o_orderkey").alias("l_orderkey"))


@query("j04c_delete_returning", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (
  SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING')""")
def j04c(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that the delete of j04 takes away."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return m.deleted_matching(lines, building_orders(spark, sf), ["l_orderkey"])


@query("j04b_delete_by_expression", """
WITH t AS (SELECT 'veeeeeeery_long_string' || l_partkey AS col, nullif(l_linenumber, 7) AS n FROM lineitem)
SELECT count(*) AS before, count(*) FILTER (WHERE coalesce(CAST(replace(col, 'veeeeeeery_long_string', '') AS BIGINT) % 3 = 0
  AND n > 2, FALSE)) AS deleted, count(*) FILTER (WHERE NOT coalesce(CAST(replace(col, 'veeeeeeery_long_string', '') AS BIGINT) % 3 = 0
  AND n > 2, FALSE)) AS remaining FROM t""")
def j04b(spark: SparkSession, sf: str) -> DataFrame:
    """The counts a delete reports, taken by the job that writes; an unknown condition deletes nothing."""
    prefix = "veeeeeeery_long_string"
    texts = table(spark, sf, "lineitem").select(
        F.concat(F.lit(prefix), F.col("l_partkey").cast("string")).alias("col"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("n"))
    number = F.replace("col", F.lit(prefix), F.lit("")).cast("bigint")
    seen, left = Observation("before"), Observation("after")
    kept = m.delete_where(texts.observe(seen, F.count(F.lit(1)).alias("n")), (number % 3 == 0) & (F.col("n") > 2))
    files.write_table(kept.observe(left, F.count(F.lit(1)).alias("n")), scratch_path(spark, "after-delete"))
    before, remaining = seen.get["n"], left.get["n"]
    return inline_values(spark, [(before, before - remaining, remaining)], "before bigint, deleted bigint, remaining bigint")


@query("j05_truncate", "SELECT count(*) AS rows_before, 0 AS rows_after, 3 AS columns_after FROM supplier")
def j05(spark: SparkSession, sf: str) -> DataFrame:
    """An emptied table keeps its schema."""
    path = scratch_path(spark, "truncated")
    suppliers = table(spark, sf, "supplier").drop("s_acctbal")
    files.write_table(suppliers.limit(0), path)
    empty = files.read_table(spark, path)
    return suppliers.agg(F.count(F.lit(1)).alias("rows_before")).select(
        "rows_before", empty.agg(F.count(F.lit(1))).scalar().alias("rows_after"),
        F.lit(len(empty.columns)).alias("columns_after"))


@query("j06_ctas", """
SELECT l_suppkey, year(l_shipdate) AS y, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def j06(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ctas")
    files.write_table(
        table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("y")).agg(
            F.count(F.lit(1)).alias("n")), path)
    return files.read_table(spark, path)


@query("j07_add_column_backfill", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, 0 AS null_count FROM {t}" for t in TABLES))
def j07(spark: SparkSession, sf: str) -> DataFrame:
    """Every table written with a dated column, its rows and missing dates counted by the job that writes."""
    counts = []
    for t in TABLES:
        dated = table(spark, sf, t).withColumn("record_ts", F.lit("2025-01-01").cast("date"))
        seen = Observation(t)
        files.write_table(
            dated.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col("record_ts").isNull()).alias("nulls")),
            scratch_path(spark, f"dated-{t}"))
        counts.append((t, seen.get["n"], seen.get["nulls"]))
    return inline_values(spark, counts, "table_name string, n_rows bigint, null_count bigint")


@query("j08_surrogate_key", """
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_name) AS c_custkey, s_name AS name FROM supplier""")
def j08(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers become customers, numbered after the last customer by their unique names."""
    batch = table(spark, sf, "supplier").select(F.col("s_name").alias("name"))
    return m.with_next_ids(table(spark, sf, "customer"), batch, "c_custkey", [F.col("name")])


@query("j09_generated_column", "SELECT o_orderkey, o_orderdate, year(o_orderdate) AS pay_year FROM orders")
def j09(spark: SparkSession, sf: str) -> DataFrame:
    """The derived year is also how the table is partitioned on disk."""
    path = scratch_path(spark, "orders-by-year")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    dated = orders.withColumn("pay_year", F.year("o_orderdate"))
    dated.write.partitionBy("pay_year").parquet(path)
    return spark.read.parquet(path)


@query("j10_touch_updated_at", """
WITH c AS (SELECT s_suppkey, s_nationkey AS old_nation, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey ELSE 24 END AS new_nation,
                  s_acctbal > 2000 AS listed FROM supplier)
SELECT s_suppkey, CASE WHEN listed THEN new_nation ELSE old_nation END AS s_nationkey,
       CASE WHEN listed AND new_nation <> old_nation THEN DATE '2025-03-01' ELSE DATE '2024-01-01' END AS updated_at FROM c""")
def j10(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier")
    target = supplier.select("s_suppkey", "s_nationkey", F.lit("2024-01-01").cast("date").alias("updated_at"))
    moved = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).otherwise(24)
    changes = supplier.filter(F.col("s_acctbal") > 2000).select("s_suppkey", moved.alias("s_nationkey"))
    return m.upsert_touching(target, changes, ["s_suppkey"], ["s_nationkey"], "updated_at",
                             F.lit("2025-03-01").cast("date"))


@query("j11_update_cell", """
SELECT c_custkey, c_name, CASE WHEN c_custkey = 42 THEN 1234.5 ELSE c_acctbal END AS c_acctbal FROM customer""")
def j11(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return m.update_cell(customer, "c_custkey", 42, "c_acctbal", "1234.5", ["c_name", "c_acctbal"])


J12_EXHIBITIONS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")


@query("j12_add_transaction", """
WITH visits AS (SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day, min(o_orderkey) AS visit_id
                FROM orders GROUP BY 1, 2, 3),
paid AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1),
batch AS (
  SELECT o_orderkey AS batch_id, CASE WHEN o_custkey % 29 = 0 THEN 'nobody' ELSE c_name END AS person, o_orderpriority AS title,
         CASE WHEN o_custkey % 31 = 0 THEN CAST(o_orderdate AS DATE) + 10000 ELSE CAST(o_orderdate AS DATE) END AS day,
         o_totalprice - 20000 AS amount, CASE WHEN o_custkey % 37 = 0 THEN '' ELSE 'card' END AS method, o_custkey,
         CASE WHEN o_orderstatus = 'F' THEN 'REF-' || o_orderkey END AS ref
  FROM orders JOIN customer ON c_custkey = o_custkey),
checked AS (
  SELECT batch_id, CASE WHEN person <> 'nobody' THEN visit_id END AS visit_id,
         amount, method, ref,
         CASE WHEN person = 'nobody' THEN 'nobody has this name'
              WHEN title = '4-NOT SPECIFIED' THEN 'no such exhibition'
              WHEN visit_id IS NULL THEN 'no visit on this day'
              WHEN l_orderkey IS NOT NULL THEN 'visit is paid'
              WHEN amount < 0 THEN 'amount is missing or negative'
              WHEN method = '' THEN 'no method given' END AS error
  FROM batch b LEFT JOIN visits v ON v.o_custkey = b.o_custkey AND v.o_orderpriority = title AND v.day = b.day
               LEFT JOIN paid ON l_orderkey = visit_id),
firsts AS (SELECT visit_id AS v, min(batch_id) AS first FROM checked WHERE error IS NULL GROUP BY 1)
SELECT batch_id, visit_id, amount, method, 'paid' AS status, TIMESTAMP '2025-01-01' AS paid_at,
       CASE WHEN visit_id IS NOT NULL THEN coalesce(ref, 'TX-' || visit_id) END AS ref,
       CASE WHEN error IS NULL AND batch_id <> first THEN 'visit is paid' ELSE error END AS error
FROM checked LEFT JOIN firsts ON v = visit_id""")
def j12(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a payment request; some name nobody, a wrong day, no method, too little."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    key = F.col("o_custkey")
    shift = F.when(key % 31 == 0, 10000).otherwise(0)
    batch = orders.join(customer, key == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("batch_id"),
        F.when(key % 29 == 0, "nobody").otherwise(F.col("c_name")).alias("person_name"),
        F.col("o_orderpriority").alias("exhibition_title"),
        F.date_add(F.to_date("o_orderdate"), shift).cast("timestamp_ntz").alias("visit_at"),
        (F.col("o_totalprice") - 20000).alias("amount"),
        F.when(key % 37 == 0, "").otherwise("card").alias("method"), F.lit("paid").alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.format_string("REF-%s", "o_orderkey")).alias("ref"),
        F.lit(None).cast("timestamp_ntz").alias("paid_at"))
    people = customer.select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("person_name"))
    exhibitions = orders.select(F.col("o_orderpriority").alias("exhibition_title")).distinct().filter(
        F.col("exhibition_title").isin(*J12_EXHIBITIONS))
    visits = orders.select(
        F.col("o_orderkey").alias("visit_id"), key.alias("person_id"),
        F.col("o_orderpriority").alias("exhibition_title"), F.col("o_orderdate").alias("visited_at"))
    payments = table(spark, sf, "lineitem").filter(
        (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    ).select(F.col("l_orderkey").alias("visit_id"))
    return m.add_transactions(batch, people, exhibitions, visits, payments,
                              F.lit("2025-01-01").cast("timestamp_ntz"))


@query("j13_lookup_or_create", """
WITH known AS (SELECT n_nationkey AS language_id, lower(n_name) AS name FROM nation WHERE n_regionkey < 3),
batch AS (SELECT p_partkey AS batch_id, p_name AS title, 1970 + p_size AS release_year, lower('NATION_' || (p_partkey % 30)) AS language FROM part),
unknown AS (SELECT language, min(batch_id) AS b FROM batch WHERE language NOT IN (SELECT name FROM known) GROUP BY 1),
created AS (SELECT (SELECT max(language_id) FROM known) + row_number() OVER (ORDER BY b) AS language_id, language AS name FROM unknown),
langs AS (SELECT * FROM known UNION ALL SELECT * FROM created),
films AS (SELECT p_partkey AS film_id, p_name AS title, 1970 + p_size AS release_year FROM part WHERE p_type = 'ECONOMY'),
fresh AS (SELECT *, row_number() OVER (PARTITION BY title, release_year ORDER BY batch_id) AS rn FROM batch b
          WHERE NOT EXISTS (SELECT 1 FROM films f WHERE f.title = b.title AND f.release_year = b.release_year))
SELECT (SELECT max(film_id) FROM films) + row_number() OVER (ORDER BY batch_id) AS film_id, title, release_year, language_id,
       3 AS rental_duration, CAST(4.99 AS DECIMAL(4,2)) AS rental_rate, CAST(19.99 AS DECIMAL(5,2)) AS replacement_cost
FROM fresh JOIN langs ON name = language WHERE rn = 1""")
def j13(spark: SparkSession, sf: str) -> DataFrame:
    nation, part = table(spark, sf, "nation"), table(spark, sf, "part")
    year = F.lit(1970) + F.col("p_size")
    languages = nation.filter(F.col("n_regionkey") < 3).select(
        F.col("n_nationkey").alias("language_id"), F.col("n_name").alias("name"))
    films = part.filter(F.col("p_type") == "ECONOMY").select(
        F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title"), year.alias("release_year"))
    batch = part.select(
        F.col("p_partkey").alias("batch_id"), F.col("p_name").alias("title"), year.alias("release_year"),
        F.format_string("Nation_%s", F.col("p_partkey") % 30).alias("language"))
    return m.create_films(batch, films, languages)[1]


@query("j14_defaults", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS status, coalesce(nullif(o_custkey, 7), 0) AS owner FROM orders""")
def j14(spark: SparkSession, sf: str) -> DataFrame:
    gaps = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.nullif(F.col("o_custkey"), F.lit(7)).alias("owner"))
    return m.with_defaults(gaps, {"status": F.lit("pending"), "owner": F.lit(0)})


# --- k: constraint checks -----------------------------------------------------------------


@query("k01_primary_key", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def k01(spark: SparkSession, sf: str) -> DataFrame:
    return q.primary_key_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("k02_unique", """
SELECT p_name, p_brand, count(*) AS n FROM part WHERE p_name IS NOT NULL AND p_brand IS NOT NULL
GROUP BY 1, 2 HAVING count(*) > 1""")
def k02(spark: SparkSession, sf: str) -> DataFrame:
    return q.unique_violations(table(spark, sf, "part"), ["p_name", "p_brand"])


@query("k03_foreign_key", """
SELECT doc_id, source FROM (SELECT doc_id, source, nullif(doc_id, 0) AS ref FROM documents) d
WHERE ref IS NOT NULL AND ref NOT IN (SELECT doc_id FROM labels)""")
def k03(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label; a missing reference passes."""
    children = table(spark, sf, "documents").select(
        "doc_id", "source", F.nullif(F.col("doc_id"), F.lit(0)).alias("ref"))
    labels = table(spark, sf, "labels")
    return q.foreign_key_violations(children, ["ref"], labels, ["doc_id"]).select("doc_id", "source")


@query("k04_not_null", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {e} IS NULL) AS null_count FROM lineitem"
    for c, e in (("l_orderkey", "l_orderkey"), ("l_shipdate", "l_shipdate"), ("discount", "nullif(l_discount, 0)"))))
def k04(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("discount", F.nullif(F.col("l_discount"), F.lit(0.0)))
    return q.null_counts(lines, ["l_orderkey", "l_shipdate", "discount"])


@query("k05_check_in_list", """
SELECT o_orderkey, 'status' AS rule FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT o_orderkey, 'priority' FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')""")
def k05(spark: SparkSession, sf: str) -> DataFrame:
    rules = {
        "status": q.in_list("o_orderstatus", ["F", "O"]),
        "priority": q.in_list("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]),
    }
    return q.broken_rules(table(spark, sf, "orders"), rules, ["o_orderkey"])


@query("k06_check_range_order", """
WITH t AS (SELECT *, nullif(l_tax, 0.05) AS t FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey, 'discount 0..0.09' AS rule FROM t WHERE NOT (l_discount BETWEEN 0 AND 0.09)
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'tax >= 0.01' FROM t WHERE NOT (t >= 0.01)
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'shipped after order' FROM t WHERE NOT (l_shipdate > o_orderdate)
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'ordered since 1996' FROM t WHERE NOT (o_orderdate >= DATE '1996-01-01')
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'adult' FROM t WHERE NOT (CAST(o_orderdate AS DATE) <= DATE '2018-06-30' - INTERVAL 18 YEAR)""")
def k06(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("t", F.nullif(F.col("l_tax"), F.lit(0.05)))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", F.to_date("o_orderdate").alias("born"))
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    rules = {
        "discount 0..0.09": F.col("l_discount").between(0.0, 0.09),
        "tax >= 0.01": F.col("t") >= 0.01,
        "shipped after order": F.col("l_shipdate") > F.col("o_orderdate"),
        "ordered since 1996": F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"),
        "adult": q.adult_on("born", "2018-06-30"),
    }
    return q.broken_rules(rows, rules, ["l_orderkey", "l_linenumber", "l_partkey"])


@query("k07_length", """
SELECT p_partkey, 'p_name' AS rule FROM part WHERE length(p_name) > 10
UNION ALL SELECT p_partkey, 'p_brand' FROM part WHERE length(p_brand) > 7""")
def k07(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"p_name": q.max_length("p_name", 10), "p_brand": q.max_length("p_brand", 7)}
    return q.broken_rules(table(spark, sf, "part"), rules, ["p_partkey"])
