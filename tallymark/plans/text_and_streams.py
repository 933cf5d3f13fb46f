"""Inverted index, word statistics, and keyed scores in batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import textindex
from tallymark.operators.indexlog import IndexLog
from tallymark.operators.ordered import global_row_number
from tallymark.operators.scores import trainee_scores
from tallymark.plans.registry import query
from tallymark.session import scratch_path
from tallymark.sources.generate import inline_values, uniform
from tallymark.sources.tables import table
from tallymark.streaming.appends import read_appended, stream_distinct, stream_insert_if_absent
from tallymark.streaming.scores import current_scores, stream_scores

WORDS_SQL = r"list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda w: w <> ''))"

# --- l: text index ------------------------------------------------------------------------

INDEX_SQL = f"""
WITH p AS (SELECT doc_id, unnest({WORDS_SQL}) AS word FROM documents)
SELECT word, doc_id // 512 AS block, count(*) AS n_docs, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids
FROM p GROUP BY 1, 2"""


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def with_id_text(index: DataFrame) -> DataFrame:
    return index.withColumn("doc_ids", F.array_join(F.col("doc_ids").cast("array<string>"), ","))


_INDEXES: dict[tuple[str, str, int], str] = {}


def saved_index(spark: SparkSession, sf: str, block: int = textindex.BLOCK) -> DataFrame:
    """Built and written once for a session's queries over one input; they read only the columns and
    blocks they need."""
    known = (spark.sparkContext.applicationId, sf, block)
    if known not in _INDEXES:
        path = scratch_path(spark, "index")
        textindex.save_index(textindex.build_index(documents(spark, sf), block), path, buckets=8)
        _INDEXES[known] = path
    return textindex.load_index(spark, _INDEXES[known])


@query("l01_build_inverted_index", INDEX_SQL)
def l01(spark: SparkSession, sf: str) -> DataFrame:
    return with_id_text(textindex.build_index(documents(spark, sf), block=512))


@query("a13_index_save_load", INDEX_SQL)
def a13(spark: SparkSession, sf: str) -> DataFrame:
    return with_id_text(saved_index(spark, sf, block=512))


@query("l01b_index_of_loads", INDEX_SQL)
def l01b(spark: SparkSession, sf: str) -> DataFrame:
    """The index grown load by load: even ids with other texts, their deletion, the odd ids, the even ones."""
    docs = documents(spark, sf)
    even, odd = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 <> 0")
    log = IndexLog(spark, scratch_path(spark, "index-log"), 512)
    log.add(even.withColumn("text", F.concat_ws(" ", "text", F.lit("draft"))))
    log.add(odd)
    log.delete(even.filter("doc_id % 4 = 0").select("doc_id"))
    log.merge()
    log.add(even)
    return with_id_text(log.index())


@query("l02_query_all_words", f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents), q AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark)
SELECT item_id AS query_id, doc_id FROM d, q WHERE len(q.w) > 0 AND list_has_all(d.w, q.w)""")
def l02(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with all words of a benchmark item, for all items at once."""
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    asked = textindex.postings(items).withColumnRenamed("doc_id", "query_id")
    return textindex.query_index(saved_index(spark, sf), asked)


@query("l03_query_batch", rf"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
lines AS (SELECT DISTINCT trim(unnest(regexp_split_to_array(text, '[.,\n]'))) AS line FROM benchmark),
q AS (SELECT line, list_distinct(list_filter(regexp_split_to_array(lower(line), '\s+'), lambda w: w <> '')) AS w FROM lines WHERE line <> ''),
hits AS (SELECT line, doc_id FROM d, q WHERE list_has_all(d.w, q.w))
SELECT line AS query, doc_id // 65536 AS block, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids
FROM hits GROUP BY 1, 2""")
def l03(spark: SparkSession, sf: str) -> DataFrame:
    """The phrases of the benchmark items as query lines."""
    phrases = F.transform(F.split("text", r"[.,\n]"), lambda line: F.trim(line))
    lines = table(spark, sf, "benchmark").select(F.explode(phrases).alias("query")).filter(
        F.col("query") != "").distinct()
    asked = textindex.query_words(lines.withColumn("query_id", F.col("query")))
    answers = textindex.query_index(saved_index(spark, sf), asked)
    return textindex.answer_lines(answers).withColumnRenamed("query_id", "query")


STOP_WORDS = ("the", "and", "of", "in", "to", "is", "on", "that", "it", "for", "with", "as", "by")


@query("l04_word_count_topk", f"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM documents),
u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w)
SELECT word, count(*) AS n FROM u WHERE word NOT IN {STOP_WORDS}
GROUP BY word ORDER BY n DESC, min(doc_id * 10000000 + pos) LIMIT 50""")
def l04(spark: SparkSession, sf: str) -> DataFrame:
    stop = inline_values(spark, [(w,) for w in STOP_WORDS], "word string")
    return textindex.top_words(documents(spark, sf), stop, 50)


def random_pairs(names: DataFrame, surnames: DataFrame, seed: str) -> DataFrame:
    """``names(id, name)`` in lower case and order, each with a surname drawn by its id."""
    numbered = global_row_number(surnames, [F.col("surname")], "_n")
    count = surnames.agg(F.count(F.lit(1))).scalar()
    drawn = names.withColumn("_n", F.floor(uniform(seed, F.col("id").cast("string")) * count) + 1)
    pairs = drawn.join(numbered, "_n")
    return pairs.select(
        "id", F.lower(F.concat_ws(" ", F.trim("name"), F.trim("surname"))).alias("full_name")
    ).orderBy("full_name", "id")


@query("l05_random_pairing", """
WITH s AS (SELECT surname, row_number() OVER (ORDER BY surname) AS n, count(*) OVER () AS k FROM (SELECT DISTINCT p_name AS surname FROM part))
SELECT c_custkey AS id, lower(c_name || ' ' || surname) AS full_name FROM customer JOIN s
ON n = floor(CAST(('0x' || substr(md5('1|' || c_custkey), 1, 13)) AS BIGINT) / 4503599627370496.0 * k) + 1""")
def l05(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    surnames = table(spark, sf, "part").select(F.col("p_name").alias("surname")).distinct()
    return random_pairs(names, surnames, "1")


# --- n: keyed scores and idempotent appends -----------------------------------------------

# Which event stands for which action of a trainee; the others change nothing.
ACTIONS = {"view": "visit_lecture", "purchase": "do_homework", "error": "miss_lecture", "signup": "miss_homework"}

SCORES_SQL = """
WITH RECURSIVE e AS (
  SELECT user_id, event_type, CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN -1
           WHEN 'signup' THEN -2 ELSE 0 END AS d, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
f AS (SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS rn, 0 AS mark FROM e
      UNION ALL SELECT e.user_id, e.rn, least(greatest(mark + d, 0), 10) FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1),
m AS (SELECT user_id, arg_max(mark, rn) AS mark FROM f GROUP BY 1)
SELECT user_id AS trainee, any_value(mark) AS mark, count(*) FILTER (WHERE event_type = 'view') AS visited_lectures,
       2 * count(*) FILTER (WHERE event_type = 'purchase') AS done_home_tasks, -count(*) FILTER (WHERE event_type = 'error') AS missed_lectures,
       -2 * count(*) FILTER (WHERE event_type = 'signup') AS missed_home_tasks, any_value(mark) >= 8 AS passed
FROM e JOIN m USING (user_id) GROUP BY user_id"""


def actions_of(events: DataFrame) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])
    return events.select(
        F.col("user_id").alias("trainee"), F.col("ts").alias("at"), F.col("event_id").alias("seq"),
        F.coalesce(F.try_element_at(names, F.col("event_type")), F.lit("none")).alias("action"))


@query("n01_clamped_score", SCORES_SQL)
def n01(spark: SparkSession, sf: str) -> DataFrame:
    return trainee_scores(actions_of(table(spark, sf, "events")))


@query("n01b_clamped_score_stream", SCORES_SQL)
def n01b(spark: SparkSession, sf: str) -> DataFrame:
    """The events arrive in three deliveries, each picked up by a run of the stream.

    Deliveries follow the time of the events, give or take an hour: every trainee's mark is carried
    from one to the next, and actions near the cuts come in the wrong order.
    """
    events = table(spark, sf, "events")
    inbox, marks, progress = (scratch_path(spark, f"scores-{p}") for p in ("inbox", "marks", "progress"))
    arrivals = spark.readStream.schema(events.schema).parquet(f"{inbox}/*")
    hour = 3_600_000_000
    due = events.withColumn("_due", F.coalesce(
        F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(hour)), F.lit(0)))
    cuts = due.agg(F.percentile_approx("_due", [1 / 3, 2 / 3])).first()[0] or [0, 0]
    part = F.when(F.col("_due") <= cuts[0], 0).when(F.col("_due") <= cuts[1], 1).otherwise(2)
    # spark.readStream needs the folder to be there before the first delivery.
    for n in range(3):
        due.filter(part == n).drop("_due").write.parquet(f"{inbox}/{n}")
        stream_scores(actions_of(arrivals), marks, progress, delay="1 hour").awaitTermination()
    return current_scores(spark, marks)


@query("n02_idempotent_append", "SELECT event_id, ts, user_id, event_type, value FROM events")
def n02(spark: SparkSession, sf: str) -> DataFrame:
    """All events are delivered, and then delivered again."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    inbox, target, progress = (scratch_path(spark, f"append-{p}") for p in ("inbox", "table", "progress"))
    for delivery in ("first", "again"):
        events.write.parquet(f"{inbox}/{delivery}")
        arrivals = spark.readStream.schema(events.schema).parquet(f"{inbox}/*")
        stream_insert_if_absent(arrivals, target, progress, ["event_id"], ["ts"]).awaitTermination()
    return read_appended(spark, target, events.schema).drop("batch")


@query("n02b_distinct_within_watermark", "SELECT event_id, ts, user_id, event_type, value FROM events")
def n02b(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the repeats arriving together, dropped by the state store."""
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    inbox, target, progress = (scratch_path(spark, f"distinct-{p}") for p in ("inbox", "table", "progress"))
    for delivery in ("first", "again"):
        events.write.parquet(f"{inbox}/{delivery}")
    arrivals = spark.readStream.schema(events.schema).parquet(f"{inbox}/*")
    stream_distinct(arrivals, target, progress, ["event_id"], "ts", "2 hours").awaitTermination()
    return spark.read.parquet(target).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
