"""Sets of whole numbers as bitmaps: 32,768 numbers in 4 KB, intersected by one aggregate."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

#: Numbers of a bitmap, as Spark's bitmap functions have them.
SPAN = 32_768


def span_of(number: Column) -> Column:
    return F.floor(number / SPAN)


def to_bitmaps(members: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """(keys, span, bits): the set of a key, a row per span of numbers it has any in.

    Repeats are merged where they are read, so a set that holds most of the rows is sent as bitmaps.
    """
    place = F.pmod(F.col(number), F.lit(SPAN)).cast("bigint")
    return members.groupBy(*keys, span_of(F.col(number)).alias("span")).agg(
        F.bitmap_construct_agg(place).alias("bits"))


def lists_to_bitmaps(lists: DataFrame, keys: Sequence[str], numbers: str) -> DataFrame:
    """`to_bitmaps` of numbers that come as lists: a list becomes bitmaps as a whole, and its numbers
    are neither made rows nor sorted; what is merged by key are bitmaps."""
    schema = StructType([*(lists.schema[k] for k in keys), StructField("span", LongType()), StructField("bits", BinaryType())])

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, spans, bits = [], [], []
            for i, one in enumerate(batch.column(numbers)):
                each = one.values.drop_null().to_numpy() if one.is_valid else np.empty(0, np.int64)
                of = each // SPAN
                for span in np.unique(of):
                    marks = np.zeros(SPAN, np.uint8)
                    marks[each[of == span] - span * SPAN] = 1
                    row.append(i)
                    spans.append(int(span))
                    bits.append(np.packbits(marks, bitorder="little").tobytes())
            held = batch.select(list(keys)).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*held.columns, pa.array(spans, pa.int64()), pa.array(bits, pa.binary())], names=schema.names)

    made = lists.select(*keys, F.col(numbers).cast("array<long>")).mapInArrow(bitmaps, schema)
    return made.groupBy(*keys, "span").agg(F.bitmap_or_agg("bits").alias("bits"))


def in_all(sets: DataFrame, keys: Sequence[str], of: Column) -> DataFrame:
    """(keys, span, bits) of the numbers that ``of`` sets share, given one row per set and span."""
    met = sets.groupBy(*keys, "span").agg(
        F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("_sets"), F.max(of).alias("_of"))
    return met.filter((F.col("_sets") == F.col("_of")) & (F.bitmap_count("bits") > 0)).drop("_sets", "_of")


def numbers_of(sets: DataFrame, number: str) -> DataFrame:
    """The numbers of bitmaps, a row each, in place of ``span`` and ``bits``."""
    others = [c for c in sets.columns if c not in ("span", "bits")]
    digits = sets.select(*others, "span", F.posexplode(F.split(F.hex("bits"), "")).alias("_at", "_digit"))
    some = digits.filter(~F.col("_digit").isin("0", "")).withColumn("_half", F.instr(F.lit("123456789ABCDEF"), F.col("_digit")))
    each = some.withColumn("_bit", F.explode(F.array(*map(F.lit, range(4)))))
    set_bits = each.filter(F.getbit(F.col("_half").cast("int"), F.col("_bit")) == 1)
    # two digits a byte, the upper half first; within a byte the lowest bit comes first
    place = F.expr("_at div 2") * 8 + F.when(F.col("_at") % 2 == 0, 4).otherwise(0) + F.col("_bit")
    return set_bits.select(*others, (F.col("span") * SPAN + place).cast("bigint").alias(number))
