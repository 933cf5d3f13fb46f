"""Fact tables stored so that rows of one key meet without a shuffle.

A stored form is cut into buckets by a hash of the key and sorted by it in each. Tables with the same key
type and number of buckets are joined, and added up by the key, bucket by bucket: neither is shuffled.
It pays when a join is asked for again and again: writing it is the one shuffle. The tables are
registered in the session's catalog and lie in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallymark.session import scratch_path
from tallymark.sources.tables import table

_STORED: dict[tuple, str] = {}


def store_by_key(df: DataFrame, key: str, label: str, buckets: int | None = None) -> str:
    """Write ``df`` in buckets of ``key``, a file each, and name the table.

    Without a number of buckets it is spark.sql.shuffle.partitions. Each bucket is written by one task: a key
    is in one bucket however many rows it has, so take a key whose rows are few, such as an order's.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stored_{label}_{uuid.uuid4().hex[:12]}"
    # dealt as the buckets are, so that a bucket is one file
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
     .option("path", scratch_path(spark, f"stored-{label}")).saveAsTable(name))
    return name


def stored_table(spark: SparkSession, root: str, name: str, key: str, columns: Sequence[str]) -> DataFrame:
    """These columns of one of the driver's tables, stored by a key once in a session."""
    known = (spark.sparkContext.applicationId, root, name, key, tuple(columns))
    if known not in _STORED:
        _STORED[known] = store_by_key(table(spark, root, name).select(*columns), key, name)
    return spark.table(_STORED[known])
