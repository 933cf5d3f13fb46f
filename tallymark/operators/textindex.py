"""Inverted index over documents, all-words queries in batches, and word counts.

A posting list is kept in blocks of the document id, so the list of a word that occurs
everywhere is many bounded rows, never one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.text import ascii_words, words
from tallymark.operators.bitmaps import in_all, lists_to_bitmaps, numbers_of
from tallymark.operators.joins import null_safe_join

BLOCK = 65_536
BUCKETS = 64
#: Ids whose documents are inverted at once; a larger block is put together from such runs.
RUN = 2_048

LISTS = "word string, block long, n_docs long, doc_ids array<long>"


def dealt(docs: DataFrame) -> DataFrame:
    """Documents dealt out by id before their words are cut, whatever row groups they are read from."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartition(partitions, "doc_id")


def postings(docs: DataFrame) -> DataFrame:
    """(word, doc_id), each pair once; repeats are dropped inside the document, so this is
    a scan without a shuffle. ``docs(doc_id, text)`` has one row per id."""
    return docs.select(F.explode(F.array_distinct(words("text"))).alias("word"), "doc_id")


def lists_of(words: pa.Array, codes: np.ndarray, ids: np.ndarray, block: int | None) -> pa.Table:
    """Lists of one block: ``ids[i]`` goes to the word ``words[codes[i]]``. Words without ids are left out."""
    low, high = (int(ids.min()), int(ids.max())) if len(ids) else (0, 0)
    span = high - low + 1
    # word and id in one number: the ids of a block are near each other
    order = np.sort(codes.astype(np.int64) * span + (ids - low))
    sizes = np.bincount(codes, minlength=len(words))
    some = np.flatnonzero(sizes)
    ends = np.concatenate(([0], np.cumsum(sizes[some])))
    return pa.table({
        "word": words.take(pa.array(some)), "block": pa.array([block] * len(some), pa.int64()),
        "n_docs": pa.array(sizes[some], pa.int64()),
        "doc_ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(order % span + low, pa.int64()))})


def flat(lists: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The items of all lists, and the row that each comes from; a null list has none."""
    whole = lists.combine_chunks()
    return pc.list_flatten(whole), pc.list_parent_indices(whole).to_numpy()


def _invert(key: tuple, docs: pa.Table) -> pa.Table:
    words, row = flat(docs["words"])
    coded = words.dictionary_encode()
    return lists_of(coded.dictionary, coded.indices.to_numpy(), docs["doc_id"].to_numpy()[row], key[0].as_py())


def merge_lists(block: int | None, lists: pa.Table, gone: pa.Table | None = None) -> pa.Table:
    """One list a word; ``gone(_s, ids)`` are taken from the lists of their segment ``_s``."""
    ids, row = flat(lists["doc_ids"])
    ids = ids.to_numpy()
    coded = lists["word"].combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy()[row]
    if gone is not None and gone.num_rows:
        segment, keep = lists["_s"].to_numpy()[row], np.ones(len(ids), bool)
        for s, old in zip(gone["_s"].to_pylist(), gone["ids"], strict=True):
            keep &= (segment != s) | ~np.isin(ids, old.values.to_numpy())
        ids, codes = ids[keep], codes[keep]
    return lists_of(coded.dictionary, codes, ids, block)


def shares(block: int) -> int:
    """Groups by hash of the word that the lists of a block are merged in."""
    return -(-block // RUN)


def share_of(word: Column, block: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(shares(block)))


def placed(docs: DataFrame, block: int) -> DataFrame:
    """``docs(doc_id, text)`` with the block and the run of the id, dealt out by them."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.col("doc_id").cast("long")
    return docs.select(
        number.alias("doc_id"), "text", F.floor(number / block).alias("block"),
        F.floor(number / min(block, RUN)).alias("run")).repartition(partitions, "block", "run")


def inverted(docs: DataFrame, block: int) -> DataFrame:
    """The lists of what `placed` gives, no id null.

    All documents of a run are in one task, so its words meet there; texts are put in order before
    their words are cut. Lists of runs are merged where a block has several.
    """
    cut = docs.sortWithinPartitions("block", "run").select(
        "block", "run", "doc_id", F.array_distinct(words("text")).alias("words"))
    lists = cut.groupBy("block", "run").applyInArrow(_invert, LISTS)
    if shares(block) == 1:
        return lists

    def merged(key: tuple, some: pa.Table) -> pa.Table:
        return merge_lists(key[0].as_py(), some)

    return lists.withColumn("_share", share_of(F.col("word"), block)).groupBy("block", "_share").applyInArrow(merged, LISTS)


def build_index(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, block, n_docs, doc_ids): ids ascending, at most ``block`` of them in a row.

    Documents are dealt by runs of ids and inverted where they arrive; what is sent afterwards are
    lists of runs. Documents without an id are counted in a null block without ids.
    """
    docs = docs.select("doc_id", "text")
    lists = inverted(placed(docs.filter("doc_id is not null"), block), block)
    nameless = postings(docs.filter("doc_id is null")).groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))
    return lists.unionByName(nameless.select(
        "word", F.lit(None).cast("long").alias("block"), "n_docs", F.array().cast("array<long>").alias("doc_ids")))


def save_index(index: DataFrame, path: str, buckets: int = BUCKETS, fmt: str = "parquet") -> None:
    """Partitioned by a hash of the word; the blocks of one word spread over the writers.

    ``fmt`` may be "json" for lines other programs can read.
    """
    placed = index.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int"))
    placed.repartition("bucket", "block").sortWithinPartitions("bucket", "word").write.partitionBy(
        "bucket").format(fmt).save(path)


INDEX_SCHEMA = "word string, block long, n_docs long, doc_ids array<long>, bucket int"


def load_index(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).format(fmt).load(path).drop("bucket")


def query_words(queries: DataFrame) -> DataFrame:
    """``queries(query_id, query)``: a line is split at white space only, as a user types it."""
    parts = F.filter(F.split(F.lower("query"), r"\s+"), lambda w: w != "")
    return queries.select("query_id", F.explode(F.array_distinct(parts)).alias("word"))


def query_index(index: DataFrame, asked: DataFrame) -> DataFrame:
    """(query_id, doc_id) for the documents with all words of each query.

    ``asked(query_id, word)``, no pair twice. A query with a word the index does not know has no rows.
    Which blocks have every word of a query is known from the index without its lists; the lists of
    those blocks alone are read, each once for all queries, and turned into bitmaps, and one aggregate
    intersects all words of a query.
    """
    vocabulary = asked.select("word").distinct()
    relevant = index.join(vocabulary, "word", "left_semi")
    sizes = asked.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_words"))
    found = asked.join(relevant.select("word", "block"), "word").groupBy("query_id", "block").agg(
        F.count(F.lit(1)).alias("n_found"))
    whole = null_safe_join(found, sizes, ["query_id"]).filter("n_found = n_words").drop("n_found")
    wanted = null_safe_join(asked, whole, ["query_id"])
    lists = relevant.join(wanted.select("word", "block").distinct(), ["word", "block"], "left_semi")
    bits = lists_to_bitmaps(lists, ["word", "block"], "doc_ids")
    sets = wanted.join(bits, ["word", "block"])
    return numbers_of(in_all(sets, ["query_id", "block"], F.col("n_words")), "doc_id").select("query_id", "doc_id")


def answer_lines(answers: DataFrame, block: int = BLOCK) -> DataFrame:
    """The comma-joined ids of every query, a line per block of ids."""
    placed = answers.withColumn("block", F.floor(F.col("doc_id") / block))
    ids = F.array_sort(F.collect_list("doc_id"))
    return placed.groupBy("query_id", "block").agg(
        F.array_join(ids.cast("array<string>"), ",").alias("doc_ids"))


def top_words(docs: DataFrame, stop_words: DataFrame, k: int) -> DataFrame:
    """The k most frequent ``[a-z]+`` words that are no stop words; of equals the one seen
    first. ``stop_words(word)``."""
    # Document and place in one exact number: a struct as buffer would sort all words.
    document = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)")
    seen = dealt(docs.select("doc_id", "text")).select(document.alias("document"), F.posexplode(ascii_words("text")).alias("pos", "word"))
    counts = seen.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("document") + F.col("pos")).alias("first"))
    kept = counts.join(stop_words.select("word"), "word", "left_anti")
    return kept.orderBy(F.col("n").desc(), "first").limit(k).select("word", "n")
