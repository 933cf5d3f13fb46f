"""Documents resampled towards a target collection by importance weights of hashed n-grams.

Every run of one or two words is a feature, and its hash picks a bucket. One pass over all texts
counts the buckets; the gain of a bucket is the log ratio of its shares in the target and in the
documents. A second pass scores every text against the array of gains, which has one number per
bucket whatever the input. Gumbel noise from a hash of the id turns the best scores into a draw
without replacement, and the scores are persisted.

How many are drawn is exact. The cutoff is found by bisection on the number line, first on the
score, then on the id of the documents tied at it: every probe is an exact count over the persisted
scores (one job counts the probes of several halvings). No score is sorted but those of drawn rows,
which are range-partitioned to get their ranks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import written
from tallymark.operators.ordered import global_row_number

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Probes of one counting job; 15 of them are four halvings.
PROBES = 15
LAST_ID = (1 << 63) - 1

#: Bytes of words once A-Z are lower case; every other ASCII byte becomes a space.
WORD_BYTES = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b > 127 else 32
                   for b in range(256))


def features(text: str | None, buckets: int) -> np.ndarray:
    """Buckets of all runs of one and two words of a text, repeats included."""
    words = (text or "").encode().lower().translate(WORD_BYTES).split()
    if not words:
        return np.empty(0, np.int64)
    single = list(map(crc32, words))
    pairs = map(crc32, words[1:], map(crc32, repeat(b" "), single))
    return np.array([*single, *pairs], np.int64) % buckets


def bucket_counts(texts: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """(bucket, n) over all texts; a task adds up its rows before anything is shuffled."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(features(text, buckets), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    return (texts.select(text_col).mapInArrow(counted, "bucket bigint, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str, target_col: str,
                 buckets: int) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of every bucket: B numbers, however long the texts."""
    counts = bucket_counts(docs, text_col, buckets).withColumn("of", F.lit("s")).unionByName(
        bucket_counts(target, target_col, buckets).withColumn("of", F.lit("t")))
    per_bucket = counts.groupBy("bucket").pivot("of", ["s", "t"]).agg(F.sum("n"))
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for row in per_bucket.collect():  # at most one row per bucket
        s[row.bucket], t[row.bucket] = row.s or 0, row.t or 0
    ratio = ((t + 1.0) * float(s.sum() + buckets)) / ((s + 1.0) * float(t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, n_features, weight): the floored mean gain of a document's features, 0 without any."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weight = [], []
            for text in batch.column(1).to_pylist():
                found = features(text, len(gains))
                n.append(len(found))
                weight.append(int(gains[found].sum()) // len(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                names=[id_col, "n_features", "weight"])

    return docs.select(id_col, text_col).mapInArrow(
        scored, f"`{id_col}` {kind}, n_features bigint, weight bigint")


def gumbel(id_col: str, seed: int) -> Column:
    """Noise of an id in thousandths, from the first 32 bits of a SHA-256; a null id hashes as ''."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def least(low: int, high: int, enough: Callable[[list[int]], list[bool]]) -> int:
    """The least number of [low, high] that is enough, if `high` is and what is above enough is too."""
    while low < high:
        gap = high - low
        probes = sorted({low + gap * i // (PROBES + 1) for i in range(1, PROBES + 1)} | {low})
        for probe, reached in zip(probes, enough(probes)):
            if reached:
                high = probe
                break
            low = probe + 1
    return low


def drawn(scores: DataFrame, eligible: Column, share: int, id_col: str) -> tuple[Column | None, int]:
    """A condition for the documents drawn, and how many they are; rows that repeat the very last
    drawn (score, id) satisfy it too."""
    pool = scores.where(eligible).select("score", F.coalesce(id_col, F.lit(LAST_ID)).alias("key"))

    def counts(rows: DataFrame, conditions: list[Column]) -> list[int]:
        return list(rows.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions)]).first())

    n, low, high = pool.agg(F.count("*"), F.min("score"), F.max("score")).first()
    wanted = n * share // 100
    if not wanted:
        return None, 0
    score, key = F.col("score"), F.col("key")
    # on -score the documents at or above a score grow with the number
    cut = -least(-high, -low, lambda at: [c >= wanted for c in counts(pool, [score >= -a for a in at])])
    above, tied, first, last = pool.agg(
        F.count_if(score > cut), F.count_if(score == cut),
        F.min(F.when(score == cut, key)), F.max(F.when(score == cut, key))).first()
    missing = wanted - above
    if missing < tied:
        ties = pool.where(score == cut)
        last = least(first, last, lambda at: [c >= missing for c in counts(ties, [key <= a for a in at])])
    own = F.coalesce(F.col(id_col), F.lit(LAST_ID))
    return eligible & ((score > cut) | ((score == cut) & (own <= last))), wanted


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        target_col: str = "text", buckets: int = BUCKETS, min_words: int = MIN_WORDS,
                        percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; a rank for those drawn, else null.

    Ids are whole numbers. Null and empty texts have no features, weight 0, and are never drawn, as
    texts of fewer than `min_words` words are not. A null id is hashed as an empty one and comes after
    all others among ties. Ties of score go to the smaller id; rows that share both are drawn in the
    order of their features and weight, and rows alike in all of these are interchangeable. Texts of
    any length are read whole, by one task each; further columns are neither read nor returned. An
    empty table gives no rows; an empty target gives every bucket the gain of an unseen one.
    """
    gains = bucket_gains(docs, target, text_col, target_col, buckets)
    noisy = weighted(docs, gains, id_col, text_col).withColumn(
        "score", F.col("weight") + gumbel(id_col, seed))
    scores = written(noisy, "scores")
    long_enough = F.col("n_features") >= 2 * min_words - 1  # n words have n + (n - 1) features
    chosen, wanted = drawn(scores, long_enough, percent, id_col)
    none = F.lit(None).cast("bigint")
    if chosen is None:
        return scores.withColumn("rank", none)
    # the place in the persisted table lets even rows that are alike be dealt to several tasks
    rows = scores.where(chosen).withColumn("__place", F.monotonically_increasing_id())
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(),
             *map(F.col, ("n_features", "weight", "__place"))]
    ranked = global_row_number(rows, order, "rank").drop("__place").withColumn(
        "rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return scores.where(~chosen).withColumn("rank", none).unionByName(ranked)


RESAMPLING_SQL = r"""
WITH crc AS (  -- the table of the CRC-32 polynomial, by its rule
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
target_words AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
doc_features AS (
  SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM doc_words),
target_features AS (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM target_words),
names AS (SELECT DISTINCT f FROM (SELECT f FROM doc_features UNION ALL SELECT f FROM target_features)),
octets AS (
  SELECT f, list_transform(range(len(hex(encode(f))) // 2),
    lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT) AS bytes FROM names),
hashed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295], bytes), lambda c, b:
    xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM octets, crc),
source_counts AS (SELECT bucket, count(*) AS s FROM doc_features JOIN hashed USING (f) GROUP BY bucket),
target_counts AS (SELECT bucket, count(*) AS t FROM target_features JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(
    (coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM source_counts) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM target_counts), 0) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM source_counts LEFT JOIN target_counts USING (bucket)),
weights AS (
  SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM doc_features JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY r),
scores AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
    (('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE
    )))::BIGINT AS score
  FROM doc_words LEFT JOIN weights USING (r)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 39 ORDER BY score DESC, doc_id, n_features, weight) AS place,
    count(*) OVER (PARTITION BY n_features >= 39) AS n
  FROM scores)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
  CASE WHEN n_features >= 39 AND place <= 25 * n // 100 THEN place END::BIGINT AS rank
FROM ranked
"""
