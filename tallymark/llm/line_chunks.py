"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

A rolling hash over the hashes of a line and the one before it decides whether a chunk ends
there, so that equal passages are cut alike wherever they stand. Chunks of several lines that
occur more than once in the corpus are found by hash, compared byte by byte, and all but the
first (smallest doc_id, then place) are removed. With `fold`, chunks with less than two worded lines
are also judged together with the chunks after them, so that no worded line goes unjudged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import WORD, written

BASE = 31  # of the rolling hash
ONE_IN = 3  # a chunk has so many lines on average


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("bigint")


def chunks_of(text: Column, one_in: int = ONE_IN) -> Column:
    """The text's lines as an array of chunks, each an array of lines."""

    def cut(lines: Column, hashes: Column) -> Column:
        def ends(i: Column) -> Column:
            rolled = F.get(hashes, i - 1) * BASE + F.coalesce(F.get(hashes, i - 2), F.lit(0))
            return (i == F.size(lines)) | (rolled % one_in == 0)

        return let(
            F.filter(F.sequence(F.lit(1), F.size(lines)), ends),
            lambda edges: F.transform(edges, lambda end, k: let(
                F.coalesce(F.get(edges, k - 1), F.lit(0)),
                lambda start: F.slice(lines, start + 1, end - start))))

    return let(F.split(text, "\n", -1), lambda lines: let(
        F.transform(lines, line_hash), lambda hashes: cut(lines, hashes)))


def joined(lines: Column) -> Column:
    return F.array_join(lines, "\n")


def counts(lines: Column) -> Column:
    """Whether a chunk of these lines is judged."""
    return F.size(F.filter(lines, lambda line: line.rlike(WORD))) >= 2


def folds_of(chunks: Column) -> Column:
    """(first, last) places of the chunks that are judged as one.

    A chunk that doesn't count goes with the next one that does, those at the end with the last that
    does: where a fold ends depends on its last chunk alone, so equal passages are folded alike.
    """
    n = F.size(chunks)
    return let(
        F.filter(F.sequence(F.lit(1), n), lambda i: counts(F.get(chunks, i - 1))),
        lambda ends: F.transform(
            F.when(F.size(ends) == 0, F.array(n)).otherwise(ends), lambda end, k: F.struct(
                F.coalesce(F.get(ends, k - 1), F.lit(0)).alias("first"),
                (F.when(k + 1 < F.size(ends), end).otherwise(n) - 1).alias("last"))))


def folded(chunks: Column, fold: Column) -> Column:
    """All lines of a fold."""
    return F.flatten(F.slice(chunks, fold["first"] + 1, fold["last"] - fold["first"] + 1))


def mark(no: Column, last: Column, key: Column) -> Column:
    return F.concat_ws(":", no.cast("string"), last.cast("string"), key)


def judged_chunks(docs: DataFrame, one_in: int, fold: bool) -> DataFrame:
    """The columns of `docs` but text, with chunk and mark (places and MD5) of what is judged; with `fold`, folds too."""

    def units(chunks: Column) -> Column:
        own = F.transform(chunks, lambda lines, i: F.struct(i.alias("no"), i.alias("last"), lines.alias("lines")))
        if not fold:
            return own
        several = F.filter(folds_of(chunks), lambda f: f["last"] > f["first"])
        return F.concat(own, F.transform(several, lambda f: F.struct(
            f["first"].alias("no"), f["last"].alias("last"), folded(chunks, f).alias("lines"))))

    others = [c for c in docs.columns if c != "text"]
    # no filter on the text here: it would part this use of the rows' shuffle from the other
    return (
        docs.select(*others, F.inline(F.when(
            F.col("text").isNotNull(), let(chunks_of(F.col("text"), one_in), units))))
        .where(counts(F.col("lines")))
        .select(*others, "no", "last", joined(F.col("lines")).alias("chunk"))
        .withColumn("key", F.md5("chunk"))
        .withColumn("mark", mark(F.col("no"), F.col("last"), F.col("key")))
    )


def repeated_chunks(rows: DataFrame, one_in: int, fold: bool) -> DataFrame:
    """(__row, __drops): per text the marks of its chunks to remove, from (doc_id, text, __row).

    Keys are counted without the chunks. Chunks are cut again from the texts that have a repeated key, and
    compared; the shuffle that brings these texts their keys is the one that brings all texts their marks.
    """
    keys = written(judged_chunks(rows, one_in, fold).select("__row", "key", "mark"), "chunk-keys")
    often = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    marks = keys.join(often, "key").groupBy("__row").agg(F.collect_set("mark").alias("__marks"))
    candidates = judged_chunks(rows.join(marks, "__row"), one_in, fold).where(
        F.array_contains("__marks", F.col("mark"))).select("doc_id", "__row", "no", "key", "chunk", "mark")
    firsts = candidates.groupBy("key", "chunk").agg(F.min(F.struct("doc_id", "no")).alias("first"))
    return (
        candidates.join(firsts, ["key", "chunk"])
        .where(F.struct("doc_id", "no") != F.col("first"))
        .groupBy("__row").agg(F.collect_set("mark").alias("__drops"))
    )


def line_dedup(docs: DataFrame, one_in: int = ONE_IN, fold: bool = False) -> DataFrame:
    """`docs` with `text` less its repeated chunks, and `n_removed`, the lines taken out.

    A chunk counts if at least two of its lines have a word; with `fold`, those that don't are also
    judged as one with their neighbours, and a later copy of a text with two worded lines goes whole.
    What goes stands at an earlier place, and what stands first stays. Texts without repeated chunks, null
    and empty ones too, stay as they are; a text of which nothing is left becomes empty. Rows that
    share a doc_id are one document with several texts: equal chunks at the same place in them
    stay; a null doc_id is the smallest. All other columns pass through (an n_removed among them
    is replaced); an empty table gives no rows.
    """
    place = lambda m, k: F.split(m, ":")[k].cast("int")
    # marks belong to a text of an id, so that they are no more than its chunks, however often the id comes
    rows = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    drops = repeated_chunks(rows.select("doc_id", "text", "__row"), one_in, fold)

    def left_of(chunks: Column) -> Column:
        marks = F.transform(chunks, lambda c, i: mark(i, i, F.md5(joined(c))))
        if fold:
            whole = F.transform(folds_of(chunks), lambda f: mark(f["first"], f["last"], F.md5(joined(folded(chunks, f)))))
            marks = let(marks, lambda own: F.flatten(F.transform(
                F.array_except(whole, F.col("__drops")),
                lambda m: F.slice(own, place(m, 0) + 1, place(m, 1) - place(m, 0) + 1))))
        return F.transform(F.array_except(marks, F.col("__drops")), lambda m: F.get(chunks, place(m, 0)))

    kept = F.flatten(let(chunks_of(F.col("text"), one_in), left_of))
    columns = [c for c in docs.columns if c != "n_removed"]
    return (
        rows.select(*columns, "__row").join(drops, "__row", "left")
        .withColumn("__kept", F.when(F.col("__drops").isNotNull(), kept))
        .select(
            *[F.coalesce(joined(F.col("__kept")), F.col("text")).alias("text") if c == "text" else F.col(c)
              for c in columns],
            F.coalesce(F.size(F.split("text", "\n", -1)) - F.size("__kept"), F.lit(0)).cast("bigint")
            .alias("n_removed"))
    )


LINE_DEDUP_SQL = rf"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS i, len(string_split(text, chr(10))) AS n
    FROM documents),
hashed AS (SELECT *, ('0x' || md5(line)[1:7])::BIGINT AS h FROM lines),
edges AS (
    SELECT *, (i = n OR (h * {BASE} + coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % {ONE_IN} = 0)::INT
        AS edge FROM hashed),
numbered AS (SELECT *, sum(edge) OVER (PARTITION BY doc_id ORDER BY i) - edge AS no FROM edges),
chunks AS (
    SELECT doc_id, no, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n_lines,
           count(*) FILTER (WHERE regexp_matches(line, '{WORD}')) AS worded
    FROM numbered GROUP BY doc_id, no),
dealt AS (
    SELECT *, coalesce(min(CASE WHEN worded >= 2 THEN no END) OVER (
                           PARTITION BY doc_id ORDER BY no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                       max(CASE WHEN worded >= 2 THEN no END) OVER (PARTITION BY doc_id), 0) AS fold
    FROM chunks),
folds AS (
    SELECT doc_id, min(no) AS no, max(no) AS last, string_agg(chunk, chr(10) ORDER BY no) AS chunk,
           sum(worded) AS worded
    FROM dealt GROUP BY doc_id, fold),
units AS (
    SELECT doc_id, no, no AS last, chunk FROM chunks WHERE worded >= 2
    UNION ALL SELECT doc_id, no, last, chunk FROM folds WHERE last > no AND worded >= 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, no) AS nth FROM units),
gone_chunks AS (
    SELECT DISTINCT doc_id, unnest(generate_series(no::BIGINT, last::BIGINT)) AS no FROM ranked WHERE nth > 1),
judged AS (
    SELECT c.*, g.no IS NOT NULL AS repeated FROM chunks c LEFT JOIN gone_chunks g ON g.doc_id = c.doc_id AND g.no = c.no),
kept AS (
    SELECT doc_id, string_agg(chunk, chr(10) ORDER BY no) FILTER (WHERE NOT repeated) AS kept,
           coalesce(sum(n_lines) FILTER (WHERE repeated), 0) AS gone
    FROM judged GROUP BY doc_id)
SELECT doc_id, gone::BIGINT AS n_removed, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text
FROM documents LEFT JOIN kept USING (doc_id)
"""
