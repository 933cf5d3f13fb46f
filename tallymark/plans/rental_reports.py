"""Rental-shop reports: titles, stores, actors, staff, popularity and gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallymark.functions.money import cents, money
from tallymark.operators.joins import keep_keys, settled
from tallymark.operators.topk import top_distinct_values
from tallymark.plans.mapping import FILM_SQL, actors, film_actors, films, stored_facts
from tallymark.plans.registry import query
from tallymark.sources.tables import table

# --- r01: titles of one category, in a period, above a rate -------------------------------


def titles_by_join(film: DataFrame, film_category: DataFrame, category: str, first: int, last: int,
                   rate: float) -> DataFrame:
    wanted = film_category.filter(F.lower("category") == category.lower())
    kept = film.filter(F.col("release_year").between(first, last) & (F.col("rental_rate") > rate))
    return (
        kept.join(wanted, "film_id").select("film_id", F.col("title").alias("film_title"))
        .orderBy("film_title", "film_id")
    )


def titles_by_membership(film: DataFrame, film_category: DataFrame, category: str, first: int,
                         last: int, rate: float) -> DataFrame:
    wanted = film_category.filter(F.lower("category") == category.lower())
    kept = film.filter(F.col("release_year").between(first, last) & (F.col("rental_rate") > rate))
    return (
        kept.join(wanted, "film_id", "left_semi")
        .select("film_id", F.col("title").alias("film_title"))
        .orderBy("film_title", "film_id")
    )


R01_SQL = f"""
WITH film AS ({FILM_SQL})
SELECT film_id, title AS film_title FROM film
WHERE lower(category) = 'economy' AND release_year BETWEEN 2005 AND 2015 AND rental_rate > 950
ORDER BY film_title, film_id"""


@query("r01_category_period_filter", R01_SQL)
def r01(spark: SparkSession, sf: str) -> DataFrame:
    film = films(spark, sf)
    return titles_by_join(film.drop("category"), film.select("film_id", "category"),
                          "Economy", 2005, 2015, 950)


@query("r01_category_period_filter_subquery", R01_SQL)
def r01_subquery(spark: SparkSession, sf: str) -> DataFrame:
    film = films(spark, sf)
    return titles_by_membership(film.drop("category"), film.select("film_id", "category"),
                                "Economy", 2005, 2015, 950)


@query("r01_category_period_filter_cte", R01_SQL)
def r01_cte(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """
        WITH in_category AS (
          SELECT film_id, title AS film_title, release_year, rental_rate
          FROM {film} WHERE lower(category) = 'economy')
        SELECT film_id, film_title FROM in_category
        WHERE release_year BETWEEN 2005 AND 2015 AND rental_rate > 950
        ORDER BY film_title, film_id""",
        film=films(spark, sf),
    )


# --- r02: revenue per store since a date --------------------------------------------------


def revenue_per_store(payments: DataFrame, stores: DataFrame, since: str) -> DataFrame:
    """``payments(store_id, amount, paid_at)``; a store is shown by its one or two address lines."""
    earned = (
        payments.filter(F.col("paid_at") >= F.lit(since).cast("timestamp_ntz"))
        .groupBy("store_id").agg(F.sum(cents("amount")).alias("_cents"))
    )
    return stores.join(earned, "store_id").select(
        "store_id",
        F.concat_ws(", ", "address", "address2").alias("store_address"),
        money("_cents").alias("revenue"),
    ).orderBy("revenue", "store_id")


def store_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as stores; the second address line is missing for the poorer half."""
    nation = table(spark, sf, "nation")
    supplier = table(spark, sf, "supplier")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("address"),
        F.when(F.col("s_acctbal") >= 5000, F.col("n_name")).alias("address2"),
    )


@query("r02_store_revenue_since", """
SELECT s_suppkey AS store_id,
       CASE WHEN s_acctbal >= 5000 THEN s_name || ', ' || n_name ELSE s_name END AS store_address,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(28,2)) AS revenue
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
WHERE CAST(l_shipdate AS DATE) >= DATE '2000-04-01'
GROUP BY s_suppkey, s_name, n_name, s_acctbal""")
def r02(spark: SparkSession, sf: str) -> DataFrame:
    payments = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("store_id"), F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("paid_at"))
    return revenue_per_store(payments, store_addresses(spark, sf), "2000-04-01")


# --- r03: the five highest counts, ties kept ----------------------------------------------


def busiest_actors(film: DataFrame, film_actor: DataFrame, actor: DataFrame, after_year: int,
                   k: int) -> DataFrame:
    recent = film.filter(F.col("release_year") > after_year).select("film_id")
    counts = (
        film_actor.join(recent, "film_id", "left_semi")
        .groupBy("actor_id").agg(F.count(F.lit(1)).alias("number_of_movies"))
    )
    busiest = settled(top_distinct_values(counts, "number_of_movies", k), "busiest")
    return (
        busiest.join(actor, "actor_id")
        .select("actor_id", "full_name", "number_of_movies")
        .orderBy(F.col("number_of_movies").desc(), "actor_id")
    )


@query("r03_top5_with_ties", """
WITH counts AS (
  SELECT l_suppkey AS actor_id, count(DISTINCT l_partkey) AS number_of_movies
  FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE 1970 + p_size > 2015 GROUP BY l_suppkey)
SELECT actor_id, s_name AS full_name, number_of_movies
FROM counts JOIN supplier ON s_suppkey = actor_id
WHERE number_of_movies IN (
  SELECT DISTINCT number_of_movies FROM counts ORDER BY number_of_movies DESC LIMIT 5)""")
def r03(spark: SparkSession, sf: str) -> DataFrame:
    return busiest_actors(films(spark, sf), film_actors(spark, sf), actors(spark, sf), 2015, 5)


# --- r04: a count column per category, per year -------------------------------------------


def category_counts_by_year(film: DataFrame, categories: Sequence[str]) -> DataFrame:
    folded = F.lower("category")
    columns = [
        F.count(F.when(folded == c.lower(), F.col("film_id"))).alias(f"number_of_{c.lower()}_movies")
        for c in categories
    ]
    return (
        film.filter(folded.isin([c.lower() for c in categories]))
        .groupBy("release_year").agg(*columns).orderBy(F.col("release_year").desc())
    )


R04_SQL = """
SELECT 1970 + p_size AS release_year,
       count(CASE WHEN p_type = 'PROMO' THEN 1 END) AS number_of_promo_movies,
       count(CASE WHEN p_type = 'SMALL' THEN 1 END) AS number_of_small_movies,
       count(CASE WHEN p_type = 'LARGE' THEN 1 END) AS number_of_large_movies
FROM part WHERE p_type IN ('PROMO', 'SMALL', 'LARGE')
GROUP BY 1"""


@query("r04_genre_counts_by_year", R04_SQL)
def r04(spark: SparkSession, sf: str) -> DataFrame:
    return category_counts_by_year(films(spark, sf), ["Promo", "Small", "Large"])


@query("r04_genre_counts_by_year_pivot", R04_SQL)
def r04_pivot(spark: SparkSession, sf: str) -> DataFrame:
    names = ["PROMO", "SMALL", "LARGE"]
    wide = (
        films(spark, sf).filter(F.col("category").isin(names))
        .groupBy("release_year").pivot("category", names).agg(F.count("film_id")).na.fill(0)
    )
    return wide.toDF("release_year", *[f"number_of_{n.lower()}_movies" for n in names]).orderBy(
        F.col("release_year").desc())


# --- r05: the three staff members with the highest revenue in a year ----------------------


def top_staff(payments: DataFrame, staff: DataFrame, k: int) -> DataFrame:
    """``payments(store_id, staff_id, _cents)`` per store and staff; ``staff`` knows its store now."""
    revenue = payments.groupBy("store_id", "staff_id").agg(F.sum("_cents").alias("_cents"))
    return (
        revenue.join(staff, "staff_id")
        .select("staff_id", "full_name", F.col("store_id").alias("store_received_revenue"),
                money("_cents").alias("revenue"), "current_staff_store")
        .orderBy(F.col("revenue").desc(), "staff_id", "store_received_revenue").limit(k)
    )


@query("r05_top3_staff_revenue", """
SELECT s_suppkey AS staff_id, s_name AS full_name, c_nationkey AS store_received_revenue,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(28,2)) AS revenue,
       s_nationkey AS current_staff_store
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey
WHERE l_shipdate >= DATE '2000-01-01' AND l_shipdate < DATE '2001-01-01'
GROUP BY s_suppkey, s_name, c_nationkey, s_nationkey
ORDER BY revenue DESC, staff_id, store_received_revenue LIMIT 3""")
def r05(spark: SparkSession, sf: str) -> DataFrame:
    paid = (
        table(spark, sf, "lineitem")
        .filter((F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
                & (F.col("l_shipdate") < F.lit("2001-01-01").cast("timestamp_ntz")))
        .groupBy("l_orderkey", "l_suppkey").agg(F.sum(cents("l_extendedprice")).alias("_cents"))
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    payments = (
        paid.join(orders, paid.l_orderkey == orders.o_orderkey)
        .join(customer, F.col("o_custkey") == customer.c_custkey)
        .select(F.col("c_nationkey").alias("store_id"), F.col("l_suppkey").alias("staff_id"), "_cents")
    )
    staff = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("staff_id"), F.col("s_name").alias("full_name"),
        F.col("s_nationkey").alias("current_staff_store"))
    return top_staff(payments, staff, 3)


# --- r06: the most rented films and the age of their audience -----------------------------

# The text shown for each film rating.
AGE_BY_RATING = {
    "G": "All ages admitted",
    "PG": "Around 8+ (with parental guidance)",
    "PG-13": "13 and older",
    "R": "17 and older (or with parent/guardian)",
    "NC-17": "18+",
}


def most_rented(rentals: DataFrame, film: DataFrame, k: int) -> DataFrame:
    counts = rentals.groupBy("film_id").agg(F.count(F.lit(1)).alias("film_rental_rate"))
    age = F.create_map(*[F.lit(x) for pair in AGE_BY_RATING.items() for x in pair])
    return (
        settled(top_distinct_values(counts, "film_rental_rate", k), "most-rented").join(film, "film_id")
        .select("film_id", F.col("title").alias("film_title"), "film_rental_rate",
                F.try_element_at(age, F.col("rating")).alias("age_movie_recommendation"))
        .orderBy(F.col("film_rental_rate").desc(), "film_title", "film_id")
    )


@query("r06_top5_rentals_rating_age", f"""
WITH film AS ({FILM_SQL}),
counts AS (SELECT l_partkey AS film_id, count(*) AS film_rental_rate FROM lineitem GROUP BY 1)
SELECT film_id, title AS film_title, film_rental_rate,
       CASE rating WHEN 'G' THEN 'All ages admitted'
                   WHEN 'PG' THEN 'Around 8+ (with parental guidance)'
                   WHEN 'PG-13' THEN '13 and older'
                   WHEN 'R' THEN '17 and older (or with parent/guardian)'
                   WHEN 'NC-17' THEN '18+' END AS age_movie_recommendation
FROM counts JOIN film USING (film_id)
WHERE film_rental_rate >= (SELECT min(n) FROM (
  SELECT DISTINCT film_rental_rate AS n FROM counts ORDER BY n DESC LIMIT 5))""")
def r06(spark: SparkSession, sf: str) -> DataFrame:
    rentals = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("film_id"))
    return most_rented(rentals, films(spark, sf), 5)


# --- r07, r08: inactivity of actors --------------------------------------------------------


def actor_years(film_actor: DataFrame, film: DataFrame) -> DataFrame:
    return film_actor.join(film.select("film_id", "release_year"), "film_id").select(
        "actor_id", "release_year").distinct()


def inactivity(film_actor: DataFrame, film: DataFrame, actor: DataFrame, as_of_year: int) -> DataFrame:
    latest = (
        film_actor.join(film.select("film_id", "release_year"), "film_id")
        .groupBy("actor_id").agg(F.max("release_year").alias("latest_release_year"))
    )
    return latest.join(actor, "actor_id").select(
        "actor_id", F.col("full_name").alias("actor_full_name"), "latest_release_year",
        F.lit(as_of_year).alias("current_year"),
        (F.lit(as_of_year) - F.col("latest_release_year")).alias("break_interval"),
    ).orderBy("actor_id")


@query("r07_inactivity_to_now", f"""
WITH film AS ({FILM_SQL})
SELECT s_suppkey AS actor_id, s_name AS actor_full_name, max(release_year) AS latest_release_year,
       2025 AS current_year, 2025 - max(release_year) AS break_interval
FROM lineitem JOIN film ON film_id = l_partkey JOIN supplier ON s_suppkey = l_suppkey
GROUP BY s_suppkey, s_name""")
def r07(spark: SparkSession, sf: str) -> DataFrame:
    return inactivity(film_actors(spark, sf), films(spark, sf), actors(spark, sf), 2025)


def release_gaps(film_actor: DataFrame, film: DataFrame, actor: DataFrame) -> DataFrame:
    """Next later year per actor and year; an actor has at most one row per calendar year."""
    w = W.partitionBy("actor_id").orderBy("release_year")
    following = F.lead("release_year").over(w)
    return (
        actor_years(film_actor, film)
        .select("actor_id", F.col("release_year").alias("prev_release_year"),
                following.alias("next_release_year"),
                (following - F.col("release_year")).alias("gap_between_films"))
        .join(actor, "actor_id")
        .select("actor_id", F.col("full_name").alias("actor_full_name"), "prev_release_year",
                "next_release_year", "gap_between_films")
    )


R08_BASE = f"""
WITH film AS ({FILM_SQL}),
years AS (SELECT DISTINCT l_suppkey AS actor_id, release_year
          FROM lineitem JOIN film ON film_id = l_partkey),
gaps AS (SELECT a.actor_id, a.release_year AS prev_release_year,
                min(b.release_year) AS next_release_year,
                min(b.release_year) - a.release_year AS gap_between_films
         FROM years a LEFT JOIN years b ON b.actor_id = a.actor_id AND b.release_year > a.release_year
         GROUP BY a.actor_id, a.release_year)"""


@query("r08_gap_between_events", R08_BASE + """
SELECT actor_id, s_name AS actor_full_name, prev_release_year, next_release_year, gap_between_films
FROM gaps JOIN supplier ON s_suppkey = actor_id""")
def r08(spark: SparkSession, sf: str) -> DataFrame:
    return release_gaps(film_actors(spark, sf), films(spark, sf), actors(spark, sf)).orderBy(
        "actor_full_name", "actor_id", "prev_release_year")


@query("r08b_gap_between_events_text", R08_BASE + """
SELECT actor_id, s_name AS actor_full_name, prev_release_year,
       coalesce(CAST(next_release_year AS VARCHAR), '-') AS next_release_year,
       coalesce(CAST(gap_between_films AS VARCHAR), '-') AS gap_between_films
FROM gaps JOIN supplier ON s_suppkey = actor_id""")
def r08_text(spark: SparkSession, sf: str) -> DataFrame:
    gaps = release_gaps(film_actors(spark, sf), films(spark, sf), actors(spark, sf))
    return gaps.withColumns({
        c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
        for c in ("next_release_year", "gap_between_films")
    })


# --- r18: the most popular film of each country -------------------------------------------


def most_popular(rentals: DataFrame, film: DataFrame, countries: Sequence[str] | None,
                 score: Column | None = None) -> DataFrame:
    """Per country the film(s) of the highest score; no countries, no rows.

    ``rentals(country, film_id, ...)``; the score is the number of rentals unless an
    aggregate is passed. rank() = 1 is pruned on the map side and keeps ties.
    """
    return leaders(rentals.filter(F.col("country").isin(list(countries or []))), film, score)


def most_popular_in_lists(rentals: DataFrame, film: DataFrame, lists: DataFrame, score: Column | None = None) -> DataFrame:
    """`most_popular` for a table of country lists, ``lists(list_id, country)``, all in one plan.

    The leaders of a country are the same in every list it is on: they are found once, in one scan of the
    rentals, and then joined with the lists. A list without a known country has no rows.
    """
    asked = lists.select("country").distinct()
    best = leaders(rentals.join(asked, "country", "left_semi"), film, score)
    return lists.select("list_id", "country").distinct().join(best, "country")


def leaders(rentals: DataFrame, film: DataFrame, score: Column | None) -> DataFrame:
    score = F.count(F.lit(1)) if score is None else score
    totals = rentals.groupBy("country", "film_id").agg(score.alias("_score"))
    w = W.partitionBy("country").orderBy(F.col("_score").desc())
    best = totals.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") == 1)
    return settled(best, "most-popular").join(film, "film_id").select(
        "country", "film_id", F.col("title").alias("film"), "rating", "release_year", "_score")


def orders_of_countries(spark: SparkSession, sf: str, orders: DataFrame, countries: Sequence[str]) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country")).filter(
        F.col("country").isin(list(countries)))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "country")
    return orders.select("o_orderkey", "o_custkey").join(
        customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "country")


def country_rentals(spark: SparkSession, sf: str, countries: Sequence[str]) -> DataFrame:
    """Rentals in the countries; orders are restricted before the lines meet them."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("film_id"), cents("l_extendedprice").alias("_cents"))
    wanted = orders_of_countries(spark, sf, table(spark, sf, "orders"), countries)
    lines = keep_keys(lines, "l_orderkey", wanted, "o_orderkey")
    return lines.join(wanted, lines.l_orderkey == wanted.o_orderkey).select("country", "film_id", "_cents")


def stored_country_rentals(spark: SparkSession, sf: str, countries: Sequence[str]) -> DataFrame:
    """`country_rentals` on facts stored by order: orders are dealt as the lines are stored, lines stay."""
    lines, orders = stored_facts(spark, sf)
    wanted = orders_of_countries(spark, sf, orders, countries)
    return lines.join(wanted, lines.l_orderkey == wanted.o_orderkey).select(
        "country", F.col("l_partkey").alias("film_id"), cents("l_extendedprice").alias("_cents"))


def r18_sql(score: str, shown: str) -> str:
    return f"""
WITH film AS ({FILM_SQL}),
country_scores AS (
  SELECT n_name AS country, l_partkey AS film_id, {score} AS score
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  WHERE n_name IN ('NATION_2', 'NATION_7', 'NATION_19')
  GROUP BY n_name, l_partkey)
SELECT country, film_id, title AS film, rating, release_year, {shown}
FROM country_scores r JOIN film USING (film_id)
WHERE score = (SELECT max(x.score) FROM country_scores x WHERE x.country = r.country)"""

R18_COUNTRIES = ["NATION_2", "NATION_7", "NATION_19"]


@query("r18_most_popular_by_group", r18_sql("count(*)", "score AS rentals"))
def r18(spark: SparkSession, sf: str) -> DataFrame:
    best = most_popular(country_rentals(spark, sf, R18_COUNTRIES), films(spark, sf), R18_COUNTRIES)
    return best.withColumnRenamed("_score", "rentals")


@query("r18b_most_popular_by_revenue", r18_sql(
    "sum(CAST(l_extendedprice AS DECIMAL(12,2)))", "CAST(score AS DECIMAL(28,2)) AS revenue"))
def r18b(spark: SparkSession, sf: str) -> DataFrame:
    best = most_popular(country_rentals(spark, sf, R18_COUNTRIES), films(spark, sf), R18_COUNTRIES, F.sum("_cents"))
    return best.withColumn("revenue", money("_score")).drop("_score")


@query("r18d_most_popular_stored", r18_sql(
    "sum(CAST(l_extendedprice AS DECIMAL(12,2)))", "CAST(score AS DECIMAL(28,2)) AS revenue"))
def r18d(spark: SparkSession, sf: str) -> DataFrame:
    """By revenue, on facts stored by order."""
    best = most_popular(stored_country_rentals(spark, sf, R18_COUNTRIES), films(spark, sf), R18_COUNTRIES, F.sum("_cents"))
    return best.withColumn("revenue", money("_score")).drop("_score")


@query("r18c_most_popular_in_lists", f"""
WITH film AS ({FILM_SQL}),
lists AS (SELECT r_name AS list_id, n_name AS country FROM nation JOIN region ON r_regionkey = n_regionkey
  UNION SELECT 'EVEN', n_name FROM nation WHERE n_nationkey % 2 = 0),
country_scores AS (
  SELECT n_name AS country, l_partkey AS film_id, count(*) AS score
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name, l_partkey)
SELECT list_id, country, film_id, title AS film, rating, release_year, score AS rentals
FROM lists JOIN country_scores r USING (country) JOIN film USING (film_id)
WHERE score = (SELECT max(x.score) FROM country_scores x WHERE x.country = r.country)""")
def r18c(spark: SparkSession, sf: str) -> DataFrame:
    """The lists of all regions, and one that overlaps with them, at once."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey", F.col("n_name").alias("country"))
    lists = nation.join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("list_id"), "country").union(
        nation.filter("n_nationkey % 2 = 0").select(F.lit("EVEN"), "country"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    at_home = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "country")
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("film_id"))
    rentals = lines.join(at_home, lines.l_orderkey == at_home.o_orderkey).select("country", "film_id")
    return most_popular_in_lists(rentals, films(spark, sf), lists).withColumnRenamed("_score", "rentals")
