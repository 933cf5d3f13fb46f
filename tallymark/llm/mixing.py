"""Mixing sources to target weights, in DataFrame functions only.

Efraimidis-Spirakis sampling: a document's key is an exponential variate divided by its quality
weight. Complete epochs of a source come first; for the rest of its budget the documents are
sorted by key and their sizes prefix-summed until the budget is spent, the last one in part.
Sources are sorted and summed in ranges of their keys, so none of them, and no key, is one task's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import WORD, written
from tallymark.operators.ordered import running_total

SEED = "mix"
LEAST_WEIGHT = 0.05


def let_words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def draw(doc_id: Column, seed: str) -> Column:
    """A number between 0 and 1, the same in every run."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """`sizes` (a row per source: src, source_size) with the target of each source.

    Sources by code point, the null one last, weigh `weights` in turn. Whoever reaches `most` times
    its size first, in order of size over weight, is capped; the others share what is left.
    """
    weight = F.array(*[F.lit(float(w)) for w in weights])
    rank = F.row_number().over(Window.orderBy("src")) - 1
    filled = Window.orderBy(F.col("source_size") / F.col("w"), "src")
    everyone = Window.partitionBy()
    total = F.sum("source_size").over(everyone).cast("double") * share
    capped = F.sum(F.col("source_size") * F.lit(most)).over(filled.rowsBetween(Window.unboundedPreceding, -1))
    first_free = F.min(F.when(~F.col("full"), F.struct("at", "room", "others"))).over(everyone)
    return (
        sizes.withColumn("w", F.get(weight, F.pmod(rank, F.lit(len(weights)))))
        .withColumn("at", F.row_number().over(filled))
        .withColumn("room", total - F.coalesce(capped, F.lit(0.0)))
        .withColumn("others", F.sum("w").over(filled.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("full", F.col("source_size") * most * F.col("others") <= F.col("room") * F.col("w"))
        .withColumn("free", first_free)
        .select("src", "source_size", F.when(
            F.col("free").isNull() | (F.col("at") < F.col("free.at")), F.col("source_size") * F.lit(most))
            .otherwise(F.col("free.room") * F.col("w") / F.col("free.others")).alias("target"))
    )


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        seed: str = SEED, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken per row; and the columns of `keep`.

    size: words of the text (null: 0). Quality weight: the share of distinct words among a
    document's words, `LEAST_WEIGHT` at least. target: of its source. taken: words the mix takes,
    repeats counted; a source's add up to its target, rounded down. Rows with one doc_id draw the
    same key and are taken in order of size; texts of any length count whole; a null doc_id or source is a value like any other;
    empty texts take nothing; an empty table gives no rows. A kept column that is named like one
    of the results gives way to it.
    """
    if not weights or min(weights) <= 0 or not 0 <= share <= most:
        raise ValueError("weights must be positive, and the share no more than sources may give")
    keep = [c for c in keep if c not in ("doc_id", "size", "source_size", "target", "taken")]
    packed = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None).cast("string")
    text_words = docs.select(
        "doc_id", F.concat(F.lit("s"), F.col("source")).alias("src"), packed.alias("row"),
        let_words(F.col("text")).alias("words"))
    rows = written(
        text_words.select(
            "doc_id", F.coalesce("src", F.lit("t")).alias("src"), "row",  # "t": after all others
            F.size("words").cast("bigint").alias("size"),
            F.greatest(F.size(F.array_distinct("words")) / F.greatest(F.size("words"), F.lit(1)),
                       F.lit(LEAST_WEIGHT)).alias("weight"))
        .withColumn("key", -F.log(draw(F.col("doc_id"), seed)) / F.col("weight"))
        .withColumn("place", F.monotonically_increasing_id()).drop("weight"), "mix-rows")
    targets = source_targets(rows.groupBy("src").agg(F.sum("size").alias("source_size")), weights, share, most)
    # sorted and summed without what is kept of the rows
    order = [F.col(c) for c in ("key", "doc_id", "size", "place")]
    summed = running_total(rows.select("src", "key", "doc_id", "size", "place"), ["src"], order, F.col("size"), "upto")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = F.floor("target") - epochs * F.col("source_size")
    part = F.greatest(F.least(rest - (F.col("upto") - F.col("size")), F.col("size")), F.lit(0))
    mixed = summed.join(targets, "src").select(
        "doc_id", "size", "source_size", "target", (epochs * F.col("size") + part).cast("bigint").alias("taken"), "place")
    if not keep:
        return mixed.drop("place")
    return mixed.join(rows.select("place", "row"), "place").select(
        *mixed.drop("place").columns, *[F.col(f"row.`{c}`").alias(c) for c in keep])


def copies(mixed: DataFrame) -> DataFrame:
    """The rows of a mix as often as they are taken: whole copies, then the leading words of a part.

    A part is the document's first words with single blanks between them; there is at most one
    per source. Rows of which nothing is taken go.
    """
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    words = F.concat(F.array_repeat(F.lit(-1), whole), F.when(rest > 0, F.array(rest)).otherwise(
        F.array().cast("array<int>")))
    first = F.array_join(F.slice(let_words(F.col("text")), 1, F.col("__words")), " ")
    return mixed.withColumn("__words", F.explode(words)).withColumn(
        "text", F.when(F.col("__words") > 0, first).otherwise(F.col("text"))).drop("__words")


MIXING_SQL = rf"""
WITH words AS (
    SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
rows_ AS (
    SELECT doc_id, source, len(words)::BIGINT AS size,
           greatest(len(list_distinct(words)) / greatest(len(words), 1), {LEAST_WEIGHT}::DOUBLE) AS weight,
           (('0x' || md5('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:13])::BIGINT::DOUBLE + 0.5)
               / 4503599627370496.0::DOUBLE AS u
    FROM words),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows_ GROUP BY source),
weighed AS (
    SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM sources),
filled AS (
    SELECT *, row_number() OVER o AS pos,
           (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER (
               o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
           sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others
    FROM weighed WINDOW o AS (ORDER BY source_size / w, source NULLS LAST)),
free AS (
    SELECT pos, room, others FROM filled WHERE source_size * 2.0::DOUBLE * others > room * w ORDER BY pos LIMIT 1),
targets AS (
    SELECT source, source_size, CASE WHEN free.pos IS NULL OR filled.pos < free.pos THEN source_size * 2.0::DOUBLE
           ELSE free.room * w / free.others END AS target
    FROM filled LEFT JOIN free ON true),
budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
           floor(target)::BIGINT AS words FROM targets),
placed AS (
    SELECT r.*, source_size, target, epochs, words - epochs * source_size AS rest,
           coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY -ln(u) / weight, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM rows_ r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(least(rest - ahead, size), 0))::BIGINT AS taken
FROM placed
"""
