"""An inverted index that takes new, changed and deleted documents.

Every load is a segment: the postings of its documents, and their ids. A document counts in the last
segment that names it, so a repeated id replaces the document and a deletion is a segment of ids
without postings; no older segment is rewritten. Merging turns neighbouring segments into one, in which
only what still counts is left. Which segments make up the index is told by the newest state
file, written after them: a load that fails halfway changes nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.textindex import BLOCK, LISTS, inverted, merge_lists, placed, share_of, shares

IDS = "doc_id long"
STATE = "version long, place long, segment string"


class IndexLog:
    """``add``, ``delete``, ``merge`` and ``index`` of an index below ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, block: int = BLOCK):
        self.spark, self.path, self.block = spark, path.rstrip("/"), block
        if not self._exists(f"{self.path}/state"):
            self._set_state([])

    def _exists(self, folder: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(folder)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def segments(self) -> list[str]:
        """Names of the segments of the newest state, oldest first."""
        states = self.spark.read.schema(STATE).parquet(f"{self.path}/state")
        newest = states.filter(F.col("version") == states.agg(F.max("version")).scalar())
        return [r.segment for r in newest.orderBy("place").collect() if r.segment is not None]

    def _set_state(self, segments: list[str]) -> None:
        folder = f"{self.path}/state"
        version = 0
        if self._exists(folder):
            version = self.spark.read.schema(STATE).parquet(folder).agg(F.max("version")).first()[0] + 1
        rows = [(version, i, s) for i, s in enumerate(segments)] or [(version, 0, None)]
        self.spark.createDataFrame(rows, STATE).coalesce(1).write.mode("append").parquet(folder)

    def _lists(self, segment: str) -> DataFrame:
        return self.spark.read.schema(LISTS).parquet(f"{self.path}/{segment}/lists")

    def _ids(self, segment: str) -> DataFrame:
        return self.spark.read.schema(IDS).parquet(f"{self.path}/{segment}/ids")

    def _write(self, lists: DataFrame, ids: DataFrame | None = None) -> str:
        """``ids`` are those of the lists unless given."""
        segment = f"segment-{uuid.uuid4().hex}"
        lists.write.parquet(f"{self.path}/{segment}/lists")
        if ids is None:  # from what is written: the lists are made once
            ids = self._lists(segment).select(F.explode("doc_ids").alias("doc_id")).distinct()
        ids.write.parquet(f"{self.path}/{segment}/ids")
        return segment

    def add(self, docs: DataFrame) -> None:
        """``docs(doc_id, text)``; of rows with one id in a load the greatest text counts, a null id none."""
        known = docs.filter("doc_id is not null")
        # the texts of an id meet where its block is inverted
        one = placed(known, self.block).groupBy("block", "run", "doc_id").agg(F.max("text").alias("text"))
        ids = known.select(F.col("doc_id").cast("long")).distinct()
        segment = self._write(inverted(one, self.block), ids)
        self._set_state([*self.segments(), segment])

    def delete(self, ids: DataFrame) -> None:
        """``ids(doc_id)``; an id that the index does not have is no error."""
        nothing = self.spark.createDataFrame([], LISTS)
        segment = self._write(nothing, ids.select(F.col("doc_id").cast("long")).filter("doc_id is not null").distinct())
        self._set_state([*self.segments(), segment])

    def _merged(self, segments: list[str]) -> DataFrame:
        """The lists of these neighbouring segments with what still counts among them."""
        numbered = list(enumerate(segments))
        owners = reduce(DataFrame.union, [self._ids(s).select("doc_id", F.lit(i).alias("_s")) for i, s in numbered])
        # ids that a later segment names again, by the segment and block of the lists they go from
        twice = owners.groupBy("doc_id").agg(F.max("_s").alias("_last"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        gone = (
            owners.join(twice, "doc_id").filter("_s < _last")
            .groupBy("_s", F.floor(F.col("doc_id") / self.block).alias("block"))
            .agg(F.collect_set("doc_id").alias("ids"))  # at most a block of ids
            .withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares(self.block) - 1).cast("long")))))
        lists = reduce(DataFrame.unionByName, [self._lists(s).withColumn("_s", F.lit(i)) for i, s in numbered])
        shared = lists.select("word", "block", "doc_ids", "_s", share_of(F.col("word"), self.block).alias("_share"))

        def merged(key: tuple, some: pa.Table, old: pa.Table) -> pa.Table:
            return merge_lists(key[0].as_py(), some, old)

        return shared.groupBy("block", "_share").cogroup(gone.groupBy("block", "_share")).applyInArrow(merged, LISTS)

    def index(self) -> DataFrame:
        """(word, block, n_docs, doc_ids) of the documents that count, as ``build_index`` gives it."""
        segments = self.segments()
        if not segments:
            return self.spark.createDataFrame([], LISTS)
        return self._lists(segments[0]) if len(segments) == 1 else self._merged(segments)

    def merge(self, small: int = 1 << 20) -> None:
        """Make one segment of the newest ones up to and without the first of more than ``small`` documents.

        Ids that were deleted are still named by the new segment, as older ones may hold them; the first
        segment of all forgets them.
        """
        segments = self.segments()
        start = len(segments)
        while start and self._ids(segments[start - 1]).count() <= small:
            start -= 1
        newest = segments[start:]
        if len(newest) < 2:
            return
        lists = self._merged(newest)
        ids = reduce(DataFrame.union, map(self._ids, newest)).distinct() if start else None
        self._set_state([*segments[:start], self._write(lists, ids)])
