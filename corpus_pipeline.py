"""From raw documents to packed training sequences, as stages that each write their rows.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of `docs`. Rows with a null text pass the filters like empty ones, repeated
rows are treated alike, an empty table gives no rows, further columns pass through to the mix.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import documents, written
from tallymark.llm.line_chunks import line_dedup
from tallymark.llm.mixing import copies, mix
from tallymark.llm.packing import best_fit_packing
from tallymark.llm.quality_classifier import classify
from tallymark.llm.shingle_join import without_near_copies

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def same_columns(found: DataFrame, docs: DataFrame) -> DataFrame:
    """`found` with the columns of `docs`; a known n_chars counts the text as it is now."""
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), length))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`docs` with columns of these names renamed, and what gives them their names back."""
    other = {c: f"__own_{c}" for c in docs.columns if c in names}
    return docs.withColumnsRenamed(other), lambda df: df.drop(*names).withColumnsRenamed(
        {new: old for old, new in other.items()})


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    own, back = set_aside(docs, "held_out", "score", "predicted")
    return same_columns(back(classify(spark, own, labels).where("predicted = 1")), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the line chunks that stand elsewhere already; documents left empty by that go."""
    own, back = set_aside(docs, "n_removed")
    return same_columns(back(line_dedup(own, fold=True).where("n_removed = 0 or text != ''")), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    own, back = set_aside(docs, "size", "source_size", "target", "taken")
    return same_columns(back(copies(mix(own, keep=own.columns))), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 1024 tokens."""
    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: The classifier's fit and the tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each one before it is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
