"""File readers and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.sources.avro import read_avro, write_avro

MULTILINE_CSV = {"header": True, "escape": '"', "multiLine": True, "mode": "FAILFAST"}


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header line. The schema is given: inferring it would read the data twice."""
    return spark.read.schema(schema).csv(path, **MULTILINE_CSV)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, escape='"')


def write_json_records(df: DataFrame, path: str, order: Sequence[Column] = ()) -> None:
    """One JSON record per line, NULLs kept; ``order`` holds within and across the part files."""
    (df.orderBy(*order) if order else df).write.option("ignoreNullFields", "false").json(path)


def has_format(spark: SparkSession, name: str) -> bool:
    """Whether the data source is on the class path."""
    try:
        spark.read.format(name).schema("x int").load([])
    except (AnalysisException, Py4JJavaError):  # the latter wraps a class that is not found
        return False
    return True


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet, ORC, JSON or Avro; for the last Spark has no module here, so `sources/avro.py` writes it."""
    if fmt == "avro":
        write_avro(df, path)
        return
    if not has_format(df.sparkSession, fmt):
        raise ValueError(f"no data source for {fmt!r} on the class path of this session")
    df.write.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | str | None = None) -> DataFrame:
    if fmt == "avro":
        return read_avro(spark, path, schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def read_delimited_docs(spark: SparkSession, path: str) -> DataFrame:
    """``id<TAB>text`` lines, lower-cased; of a repeated id the last line wins.

    A line's place is its file, the block Spark read it from, and its order in that block.
    A line without a tab or with a bad id is an error.
    """
    lines = spark.read.text(path).select(
        F.regexp_replace("value", r"^\s+|\s+$", "").alias("line"),
        F.struct("_metadata.file_path", "_metadata.file_block_start",
                 F.monotonically_increasing_id().alias("n")).alias("place"),
    )
    parts = F.split(F.lower("line"), "\t", 2)
    docs = lines.filter(F.col("line") != "").select(
        parts[0].cast("bigint").alias("doc_id"), parts[1].alias("text"), "place")
    return docs.groupBy("doc_id").agg(F.max_by("text", "place").alias("text"))


def read_words(spark: SparkSession, path: str) -> DataFrame:
    word = F.lower(F.trim("value"))
    return spark.read.text(path).select(word.alias("word")).filter(F.col("word") != "")


def write_lines(lines: DataFrame, path: str) -> None:
    """A single string column as text lines; a value with a line break in it is refused."""
    column = F.col(lines.columns[0])
    broken = F.raise_error(F.lit("a line must not hold a line break"))
    lines.select(F.when(column.rlike("[\\r\\n]"), broken).otherwise(column).alias("value")).write.text(path)
