"""Appends that may be delivered again without leaving a row twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallymark.operators.maintenance import insert_on_conflict_do_nothing


#: Key buckets of a table; a batch reads the keys of those it has rows for.
BUCKETS = 64


def key_bucket(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


def stream_insert_if_absent(rows: DataFrame, path: str, checkpoint: str, key: Sequence[str],
                            order: Sequence[str]) -> StreamingQuery:
    """Append rows whose key the table below ``path`` does not have yet, whatever else differs.

    Every micro-batch writes its own ``batch=N`` folder, replaced if the batch is run again, with a
    folder for each bucket of keys in it. It compares with the folders of other batches only, and of
    these with the buckets that its own keys fall in; there it reads the key.
    """
    schema = rows.schema

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        placed = batch.withColumn("bucket", key_bucket(key)).persist()  # read for the buckets and the rows
        touched = [r.bucket for r in placed.select("bucket").distinct().collect()]  # at most BUCKETS
        existing = read_appended(spark, path, schema, before=batch_id, buckets=touched)
        fresh = insert_on_conflict_do_nothing(existing, placed.drop("bucket"), key, order)
        (fresh.withColumn("bucket", key_bucket(key)).repartition("bucket")  # a file per bucket
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch={batch_id}"))
        placed.unpersist()

    return (
        rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_appended(spark: SparkSession, path: str, schema, before: int | None = None,
                  buckets: Sequence[int] | None = None) -> DataFrame:
    """The table so far, or some buckets of it as they were before a batch."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    layout = T.StructType([*schema, T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())])
    table = spark.read.schema(layout).option("basePath", path).parquet(path)
    if buckets is not None:
        table = table.filter(F.col("bucket").isin(*buckets))
    table = table.drop("bucket")
    return table if before is None else table.filter(F.col("batch") < before).drop("batch")


def stream_distinct(rows: DataFrame, path: str, checkpoint: str, key: Sequence[str], event_time: str,
                    delay: str) -> StreamingQuery:
    """Append rows with repeats dropped that arrive within ``delay`` of event time.

    The state store only holds keys younger than the watermark.
    """
    first = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([*key])
    return (
        first.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
